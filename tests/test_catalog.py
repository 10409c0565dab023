"""Every query with an SQL counterpart gives DuckDB's rows; invariants of the feature table hold."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from pipecast.plans.dates import RunDates
from pipecast.plans.features import build_features
from pipecast.plans.slices import build_slice
from pipecast.queries import oracle_sql, queries
from pipecast.queries import workspace as ws
from pipecast.schemas import FEATURE_COLUMNS
from pipecast.sources.orders_mapping import derive_sources
from tests.compare import connect, duckdb_result, spark_result
from tests.conftest import SMALL

ORACLES = oracle_sql()


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    columns, rows = spark_result(queries()[name](spark, SMALL))
    expected_columns, expected = duckdb_result(connect(SMALL), ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_feature_table_invariants(spark):
    features = ws.stored_features(spark, SMALL)
    assert tuple(features.columns) == FEATURE_COLUMNS
    assert features.where("day_of_qtr < 2 or day_of_qtr > 92").count() == 0
    assert features.groupBy("dt", "sales_div").count().where("count > 1").count() == 0
    off = F.abs(F.col("pipe_coverage") * F.col("pct_pipe_remain_to_close") - 1) > 1e-9
    assert features.where(off).count() == 0


def test_current_day_is_part_of_the_running_quarter(spark):
    current = ws.stored_slice(spark, SMALL, "current_day")
    assert current.count() == 4
    assert current.exceptAll(ws.stored_slice(spark, SMALL, "test")).count() == 0


def test_last_days_of_a_quarter(spark):
    """On day 92 short quarters are passed over, and few divisions have bookings on that very day."""
    cfg = replace(ws.CONFIG, as_of=date(2001, 7, 31))
    src = derive_sources(spark, SMALL)
    dates = RunDates.resolve(src, cfg)
    counts = {
        name: build_slice(name, src, cfg, dates).count() for name in ("train", "test", "stlq", "stl4q_avg")
    }
    assert counts == {"train": 7240, "test": 323, "stlq": 1, "stl4q_avg": 2}
    features = build_features(src, cfg)
    assert features.count() == 7563 and features.where(F.col("dt") > cfg.as_of).count() == 0


def test_back_dated_run_holds_one_quarter(spark):
    rows = queries()["view_test_backdated"](spark, SMALL).select("fy_quarter", "dt").distinct().collect()
    assert len({r.fy_quarter for r in rows}) == 1
    assert max(r.dt for r in rows) <= ws.BACK_DATED.as_of


def test_bookings_source_has_every_line(spark):
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    assert ws.sources(spark, SMALL).bookings.count() == lines


def test_small_slices_read_few_orders(spark, capsys):
    """The bounds reach the scan of orders."""
    build_slice("test", ws.sources(spark, SMALL), ws.CONFIG, ws.dates(spark, SMALL)).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(o_orderdate" in plan or "o_orderdate" in plan.split("PushedFilters")[1]


def test_whole_numbers_are_those_of_a_cast(spark):
    """Texts that cannot be a number are not tried, and all that can be are."""
    from pipecast.queries.catalog import _whole_number

    texts = ["7", "-7", "+7", " 7", "7 ", "\t7\n", "\x7f7", "\x007", "gone7", "7a", "7.5", "", ":", "é7", "9" * 30, None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    both = rows.select("t", _whole_number("t").alias("found"), F.expr("try_cast(t as bigint)").alias("cast")).collect()
    assert [r["found"] for r in both] == [r["cast"] for r in both]

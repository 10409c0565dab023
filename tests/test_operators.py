from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from pipecast import schemas
from pipecast.config import ForecastConfig
from pipecast.operators import aggregates, joins, metrics, windows
from pipecast.plans.features import build_features, snapshot_cells
from pipecast.plans.slices import SLICES, RunDates, build_slice
from pipecast.sources.orders_mapping import OrderTables
from pipecast.sources.readers import Sources
from pipecast.sources.sinks import run_folder

CFG = ForecastConfig(as_of=date(2001, 6, 15), min_dt=date(2001, 2, 1))
QUARTERS = [("FY02 Q1", date(2001, 2, 1), date(2001, 4, 30)), ("FY02 Q2", date(2001, 5, 1), date(2001, 7, 31))]


def days(start, n):
    return [start + timedelta(days=i) for i in range(n)]


def quarters(spark):
    return spark.createDataFrame(QUARTERS, schemas.QUARTER_MAPPING)


def calendar(spark):
    rows = [(d, (d - s).days + 1) for _, s, e in QUARTERS for d in days(s, (e - s).days + 1)]
    return spark.createDataFrame(rows, schemas.CALENDAR)


def division_map(spark, rows=(("emea-1", "EMEA"), ("emea-2", "EMEA"), ("quota.emea", "EMEA"))):
    return spark.createDataFrame(list(rows), schemas.DIVISION_MAP)


def opportunity(key, day, stage="3. Solution", amount=100, owner="emea-1", touched=True, **other):
    seen = datetime.combine(day if touched else day - timedelta(days=400), datetime.min.time())
    row = {
        "id": key, "dt": day, "stagename": stage, "amount": Decimal(amount), "currencyisocode": None,
        "accountid": "1", "lastactivitydate": seen, "lastmodifieddate": None, "isdeleted": False,
        "isclosed": False, "closedate": date(2001, 7, 1) if day.month >= 5 else date(2001, 4, 1),
        "owner_division__c": owner, **other,
    }
    return tuple(row[f.name] for f in schemas.OPPORTUNITY_HISTORY)


def booking(key, day, amount, owner="emea-1", exception="N"):
    return (key, day, Decimal(amount), owner, "New", None, exception, "ann", "1", False)


def make_sources(spark, opportunities, bookings, quota=1000):
    lines = [
        (datetime(2001, 2, 1), "quota.emea", Decimal(quota), "Segment"),
        (datetime(2001, 5, 1), "quota.emea", Decimal(quota), "Segment"),
        (datetime(2001, 5, 1), "quota.emea", Decimal(quota), "Rep"),
    ]
    return Sources(
        opportunity_history=spark.createDataFrame(opportunities, schemas.OPPORTUNITY_HISTORY),
        bookings=spark.createDataFrame(bookings, schemas.BOOKINGS),
        quota=spark.createDataFrame(lines, schemas.QUOTA),
        quarter_mapping=quarters(spark),
        calendar=calendar(spark),
        division_map=division_map(spark),
    )


def test_pipeline_totals(spark):
    day = date(2001, 5, 10)
    rows = [
        opportunity("1", day, "1. Qualification", 5),
        opportunity("2", day, "4. POC", 10001),
        opportunity("3", day, "5. Contract", 20000, owner="emea-2"),
        opportunity("4", day, "5. Contract", 10000),
        opportunity("5", day, "5. Contract", 30000, touched=False),
        opportunity("6", day, "Renewal talk", 7, owner="nobody"),
        opportunity("7", day, amount=0),
        opportunity("8", day, isclosed=True),
        opportunity("9", day, isdeleted=None),
        opportunity("10", day, closedate=date(2001, 8, 1)),
        opportunity(CFG.excluded_opportunity_ids[0], day),
        opportunity("11", day + timedelta(days=1), touched=False),
    ]
    df = spark.createDataFrame(rows, schemas.OPPORTUNITY_HISTORY)
    totals = aggregates.pipeline_totals(df, quarters(spark), division_map(spark), CFG)
    touched = {r["sales_div"]: r for r in aggregates.touched_pipeline(totals).collect()}
    assert set(touched) == {"EMEA", "UnDefined"}
    emea = touched["EMEA"]
    assert (emea["stage_1_count"], emea["stage_4_count"], emea["stage_5_count"]) == (1, 1, 2)
    assert (emea["stage_5_amount"], emea["stage_3_amount"]) == (30000, 0)
    assert [emea[c] for c in schemas.LARGE_DEALS] == [30001, 30001, 20000]
    assert sum(touched["UnDefined"][c] for c in schemas.STAGE_COUNTS) == 0
    everything = aggregates.open_pipeline(totals).where("sales_div = 'EMEA'").orderBy("dt").collect()
    assert [r["stage_5_amount_all"] for r in everything] == [60000, 0]
    assert [r["stage_3_amount_all"] for r in everything] == [0, 100]


def test_duplicate_labels_multiply_like_a_plain_join(spark):
    df = spark.createDataFrame([opportunity("1", date(2001, 5, 10))], schemas.OPPORTUNITY_HISTORY)
    twice = division_map(spark, [("emea-1", "EMEA"), ("emea-1", "EMEA")])
    totals = aggregates.pipeline_totals(df, quarters(spark), twice, CFG).first()
    assert (totals["stage_3_count"], totals["stage_3_amount"]) == (2, 200)
    assert [tuple(r) for r in joins.duplicate_keys(twice, "sales_div_dirty").collect()] == [("emea-1", 2)]


def test_quarter_lookup_equals_range_join(spark):
    dates = spark.createDataFrame(
        [(d,) for d in (date(2001, 1, 31), date(2001, 2, 1), date(2001, 4, 30), date(2001, 8, 1))], "d date"
    )
    looked_up = joins.join_quarter(dates, quarters(spark), "d").select("d", "fy_quarter")
    ranged = dates.join(quarters(spark), F.col("d").between(F.col("qtr_start"), F.col("qtr_end")), "left")
    assert sorted(map(tuple, looked_up.collect()), key=str) == sorted(
        map(tuple, ranged.select("d", "fy_quarter").collect()), key=str
    )


def test_feature_rows_of_a_quarter(spark):
    start = date(2001, 5, 1)
    opps = [opportunity("1", d) for d in days(start, 60)]
    bks = [
        booking("first day", start, 50),
        booking("b", start + timedelta(days=4), 200),
        booking("refund", start + timedelta(days=5), -100, exception="Y"),
        booking("unmapped", start + timedelta(days=5), 500, owner="nobody"),
        booking("rest", start + timedelta(days=50), 850),
    ]
    src = make_sources(spark, opps, bks)
    assert max(r["dt"] for r in build_features(src, CFG).collect()) == CFG.as_of  # later days are unknown
    cfg = replace(CFG, as_of=date(2001, 7, 31))
    rows = {r["day_of_qtr"]: r for r in build_features(src, cfg).collect()}
    assert min(rows) == 2 and len(rows) == 60
    assert rows[2]["bookings_qtd"] == 0  # the booking of day 1 has no row to be carried from
    assert rows[5]["bookings_qtd"] == 250
    assert rows[6]["bookings_qtd"] == 150
    assert rows[7]["bookings_qtd"] == 250  # the fill is the peak before the refund
    assert rows[36]["bookings_qtd"] == 150  # day 5 has left the window of 31 rows
    assert rows[37]["bookings_qtd"] == 0  # and now day 6 as well
    assert rows[51]["bookings_qtd"] == 1000
    assert rows[51]["pipe_coverage"] is None and rows[51]["pct_pipe_remain_to_close"] == 0
    assert rows[51]["bookings_pct_finish"] == 1.0
    assert {r["quota"] for r in rows.values()} == {1000.0}
    assert rows[6]["qtr_pct"] == 6 / 92
    assert rows[6]["s345_bk_qtd_quota_ratio"] == 0.25
    assert list(build_features(src, CFG).columns) == list(schemas.FEATURE_COLUMNS)


@pytest.mark.parametrize(
    ("day", "expected"),
    [
        (date(2001, 6, 15), [date(2001, 3, 18), date(2000, 12, 16), date(2000, 9, 15), date(2000, 6, 15)]),
        (date(2001, 7, 31), [date(2001, 1, 31), date(2000, 10, 31), date(2000, 7, 31), date(2000, 1, 31)]),
        (date(2001, 7, 28), [date(2001, 4, 30), date(2001, 1, 28), date(2000, 10, 28), date(2000, 7, 28)]),
        (date(2001, 7, 29), [date(2001, 1, 29), date(2000, 10, 29), date(2000, 7, 29), date(2000, 4, 30)]),
    ],
)
def test_same_day_lags_jump_over_short_quarters(spark, day, expected):
    starts = [date(1999, 11, 1), date(2000, 2, 1), date(2000, 5, 1), date(2000, 8, 1), date(2000, 11, 1),
              date(2001, 2, 1), date(2001, 5, 1), date(2001, 8, 1)]
    rows = [(d, (d - a).days + 1) for a, b in zip(starts, starts[1:]) for d in days(a, (b - a).days)]
    lags = windows.same_day_lags(spark.createDataFrame(rows, schemas.CALENDAR), F.lit(day), 4)
    assert list(lags.first())[1:] == expected
    assert sorted(r["dt"] for r in windows.lag_days(lags).collect()) == sorted(expected)


def test_slices_are_the_same_cut_or_built(spark):
    opps = [opportunity("1", d) for d in days(date(2001, 2, 1), 140)]
    bks = [booking(str(d), d, 20) for d in days(date(2001, 2, 3), 130)]
    src = make_sources(spark, opps, bks)
    features = build_features(src, CFG)
    for dates in (RunDates.resolve(src, CFG), RunDates.lazy(src, CFG)):
        for name, cut in SLICES.items():
            whole = sorted(map(tuple, cut(features, dates).collect()))
            built = sorted(map(tuple, build_slice(name, src, CFG, dates).collect()))
            assert whole == built and whole, name


def test_scan_reads_only_the_days_a_slice_needs(spark):
    opps = [opportunity("1", d) for d in days(date(2001, 2, 1), 140)]
    bks = [booking(str(d), d, 20) for d in days(date(2001, 2, 3), 130)]
    src = make_sources(spark, opps, bks)
    path = run_folder(spark, "snapshots")
    src.opportunity_history.write.partitionBy("dt").parquet(path)
    stored = spark.read.schema(schemas.OPPORTUNITY_HISTORY).parquet(path)
    src = Sources(**{**src.__dict__, "opportunity_history": stored})
    df = build_slice("test", src, CFG)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt#" in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "snapshots" in line)
    assert "currencyisocode" not in scan and "accountid" not in scan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_correlations_skip_missing_pairs(spark):
    rng = np.random.default_rng(7)
    table = rng.normal(size=(200, 3))
    rows = [tuple(None if rng.random() < 0.1 else float(x) for x in row) for row in table]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    found = {(r["col_a"], r["col_b"]): r["r"] for r in aggregates.correlation_matrix(df, ("a", "b", "c")).collect()}
    assert len(found) == 9
    pair = np.array([(r[0], r[2]) for r in rows if r[0] is not None and r[2] is not None])
    assert found[("a", "c")] == pytest.approx(np.corrcoef(pair.T)[0, 1])
    assert found[("a", "a")] == pytest.approx(1.0)


def test_scores(spark):
    df = spark.createDataFrame([(1.0, 0.5), (2.0, 2.5), (0.0, 1.0)], "y double, p double")
    scores = metrics.score(df, "y", "p").first()
    assert scores["r2_score"] == pytest.approx(1 - 1.5 / 2.0)
    assert scores["avg_abs_var_finish"] == pytest.approx(2 / 3)
    assert scores["avg_abs_var_pct"] == pytest.approx((0.5 + 0.25) / 2)
    assert (scores["rows_without_pct"], scores["n_rows"]) == (1, 3)


def test_feature_rows_of_later_days(spark):
    """On demand every day with snapshots has its row, the ones after the run's day, too."""
    start = date(2001, 5, 1)
    src = make_sources(spark, [opportunity("1", d) for d in days(start, 60)], [booking("b", start, 50)])
    rows = build_features(src, CFG, later_days=True).select("dt").collect()
    assert sorted(r["dt"] for r in rows) == days(start + timedelta(days=1), 60)


def test_accounts_are_looked_up_without_sorting_or_grouping_snapshots(spark):
    start = date(2001, 5, 1)
    rows = [opportunity(k, start, accountid=a) for k, a in (("1", "7"), ("2", "7"), ("3", "8"), ("4", None), ("5", "9"))]
    accounts = spark.createDataFrame([("7",), ("9",), ("9",), (None,)], schemas.ACCOUNT)
    known = joins.join_account(spark.createDataFrame(rows, schemas.OPPORTUNITY_HISTORY), accounts)
    assert sorted((r["id"], r["account_id"]) for r in known.select("id", "account_id").collect() if r["account_id"]) == [
        ("1", "7"), ("2", "7"), ("5", "9"), ("5", "9")
    ]
    assert sorted(r["id"] for r in known.where("account_id is null").select("id").collect()) == ["3", "4"]
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort " not in plan


def test_quarters_are_looked_up_by_number(spark):
    dates = spark.createDataFrame([(date(2001, 2, 1),), (date(2001, 8, 1),), (None,)], "d date")
    looked_up = joins.join_quarter(dates, quarters(spark), "d")
    assert {r["d"]: r["fy_quarter"] for r in looked_up.collect()} == {
        date(2001, 2, 1): "FY02 Q1", date(2001, 8, 1): None, None: None
    }
    assert "[unix_date(" in looked_up._jdf.queryExecution().executedPlan().toString()


def test_features_from_stored_sums(spark):
    """Sums per raw label give the same rows; a day whose bookings all do not count is still a day of bookings."""
    start = date(2001, 5, 1)
    opps = [opportunity(str(k), d, "4. POC", 100 * k, f"emea-{k}") for k in (1, 2) for d in days(start, 45)]
    bks = [booking("b", start + timedelta(days=4), 200), booking("c", start + timedelta(days=9), 50, owner="emea-2"),
           booking("small", start + timedelta(days=20), 1), booking("later", start + timedelta(days=50), 850)]
    src = make_sources(spark, opps, bks)
    booked = aggregates.label_bookings(src.bookings, CFG)
    assert RunDates.resolve(replace(src, bookings=booked), CFG) is not None
    assert aggregates.latest_booking_day(booked, CFG).first()["dt"] == start + timedelta(days=20)
    from_sums = build_features(src, CFG, cells=snapshot_cells(src, CFG), booked=booked)
    assert sorted(map(str, from_sums.collect())) == sorted(map(str, build_features(src, CFG).collect()))
    assert from_sums.count() == 45


def test_orders_and_customers_do_not_pass_through_the_driver(spark, tmp_path):
    """They are joined where they lie, however small the planner takes them; keys may repeat or be missing."""
    tables = {
        "region": ([(0, "R0"), (1, "R1")], "r_regionkey long, r_name string"),
        "nation": ([(0, "N0", 0), (1, "N1", 1)], "n_nationkey long, n_name string, n_regionkey long"),
        "customer": ([(1, 0), (2, 1), (2, 0), (None, 1), (3, None)], "c_custkey long, c_nationkey long"),
        "orders": (
            [(10, 1, datetime(2001, 3, 1)), (11, 2, datetime(2001, 3, 2)), (12, None, datetime(2001, 3, 3)), (13, 3, None)],
            "o_orderkey long, o_custkey long, o_orderdate timestamp",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    orders = OrderTables(spark, str(tmp_path)).orders()
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [o_custkey" in plan and "BroadcastHashJoin [o_custkey" not in plan
    broadcast = [part.split("Scan parquet")[1] for part in plan.split("BroadcastExchange")[1:]]
    assert not any("c_custkey" in part.split("\n")[0] for part in broadcast)
    found = sorted((r.o_orderkey, r.n_name, r.r_name) for r in orders.collect())
    assert found == [(10, "N0", "R0"), (11, "N0", "R0"), (11, "N1", "R1")]

"""The registered queries. Each takes (spark, folder of the given tables) and returns a DataFrame.

All of them run over whole tables. Snapshot-level operators are reported per day,
because a day is the grain every later step works on.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pipecast import schemas
from pipecast.config import ForecastConfig
from pipecast.functions import fiscal, labels, predicates
from pipecast.operators import aggregates, joins, metrics, model_frames, windows
from pipecast.plans import dates as run_dates
from pipecast.plans import features as feature_plan
from pipecast.plans import models, slices, tree_tables
from pipecast.queries import workspace as ws
from pipecast.queries.workspace import CONFIG
from pipecast.sources.readers import Sources, read_features_csv
from pipecast.sources.sinks import export_csv, run_folder

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under the function's name."""
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _double(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def _with_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the type results are compared in."""
    return df.select(
        *[_double(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema]
    )


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles that depend on summation order, without their last digits."""
    return df.select(
        *[
            F.round(F.col(f.name), 4 if f.name in schemas.MONEY_COLUMNS else 6).alias(f.name)
            if f.dataType.typeName() == "double"
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _rows_and_amount(df: DataFrame, *keys: str | Column, amount: str = "amount") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(amount).cast("double").alias("total_amount")
    )


def _booking_rows(df: DataFrame) -> DataFrame:
    return df.select("id", "booking_date__c", _double("amount__c"))


# --- scans, sources and sinks -------------------------------------------------------------------


def _whole_number(name: str) -> Column:
    """``try_cast(... as bigint)``, which raises an exception inside for each text that is no number.

    No number begins with a character after the digits but, as it is trimmed, DEL; those are not tried.
    """
    first = F.col(name)
    return F.when((first < ":") | (first >= "\x7f"), first.try_cast("bigint"))


@query
def src_opportunity_history(spark: SparkSession, folder: str) -> DataFrame:
    history = ws.sources(spark, folder).opportunity_history
    return history.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(_whole_number("id")).alias("sum_of_ids"),
        *[F.count_if(F.col("stagename") == name).alias(f"n_stage_{k}") for k, name in enumerate(CONFIG.stages, 1)],
        F.sum("amount").cast("double").alias("total_amount"),
        F.count("currencyisocode").alias("n_currency"),
        F.sum(_whole_number("accountid")).alias("sum_of_accounts"),
        F.count("lastactivitydate").alias("n_activity"),
        F.max(F.to_date("lastmodifieddate")).alias("last_modified"),
        F.count_if("isdeleted").alias("n_deleted"),
        F.count_if("isclosed").alias("n_closed"),
        F.max("closedate").alias("last_close"),
        F.sum(F.length("owner_division__c")).alias("owner_letters"),
    )


@query
def src_bookings(spark: SparkSession, folder: str) -> DataFrame:
    return _with_doubles(ws.sources(spark, folder).bookings)


@query
def src_quota(spark: SparkSession, folder: str) -> DataFrame:
    quota = ws.sources(spark, folder).quota
    return _with_doubles(quota.withColumn("start_date__c", F.to_date("start_date__c")))


@query
def src_quarter_mapping(spark: SparkSession, folder: str) -> DataFrame:
    return ws.sources(spark, folder).quarter_mapping


@query
def src_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return ws.sources(spark, folder).calendar


@query
def src_division_map(spark: SparkSession, folder: str) -> DataFrame:
    apart = ws.sources(spark, folder).division_map.withColumn("variant", F.lit("separated"))
    merged = ws.sources(spark, folder, True).division_map.withColumn("variant", F.lit("together"))
    return apart.unionByName(merged)


@query
def src_currency(spark: SparkSession, folder: str) -> DataFrame:
    return ws.sources(spark, folder).currency


@query
def src_account(spark: SparkSession, folder: str) -> DataFrame:
    return ws.sources(spark, folder).account


@query
def src_csv_training(spark: SparkSession, folder: str) -> DataFrame:
    path = export_csv(ws.stored_slice(spark, folder, "train"), run_folder(spark, "training"))
    return read_features_csv(spark, path)


@query
def src_csv_current(spark: SparkSession, folder: str) -> DataFrame:
    path = export_csv(ws.stored_slice(spark, folder, "test"), run_folder(spark, "current"))
    return read_features_csv(spark, path)


@query
def sink_named_view(spark: SparkSession, folder: str) -> DataFrame:
    counts = []
    for together in (False, True):
        features = ws.stored_features(spark, folder, together)
        for name in slices.publish_slices(features, ws.dates(spark, folder), together):
            rows = spark.table(name).agg(F.count(F.lit(1)).alias("n_rows"))
            counts.append(rows.select(F.lit(name).alias("view_name"), "n_rows"))
    result = counts[0]
    for rows in counts[1:]:
        result = result.unionByName(rows)
    return result


@query
def sink_named_view_contents(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of the ten slices, stored as tables and read back by name."""
    rows = []
    for together in (False, True):
        features = ws.stored_features(spark, folder, together)
        for name in slices.publish_slices(features, ws.dates(spark, folder), together, materialize=True):
            spark.catalog.dropTempView(name)  # a temporary view would hide the table
            values = [F.col(c) if c in ("dt", "fy_quarter", "sales_div") else _double(c) for c in schemas.FEATURE_COLUMNS]
            rows.append(spark.table(name).select(F.lit(name).alias("view_name"), *values))
    averages = [_rounded(df) if "stl4q" in name else df for df, name in zip(rows, [*slices.view_names(False), *slices.view_names(True)])]
    return reduce(DataFrame.unionByName, averages)


@query
def src_read_view(spark: SparkSession, folder: str) -> DataFrame:
    slices.publish_slices(ws.stored_features(spark, folder), ws.dates(spark, folder))
    return slices.read_view(spark, "test")


def _rounded_prediction(df: DataFrame) -> DataFrame:
    """The solver's last digits depend on the order of its sums."""
    return df.withColumn("prediction", F.round("prediction", 4))


@query
def sink_csv_compare(spark: SparkSession, folder: str) -> DataFrame:
    _, holdout = ws.holdout_split(spark, folder)
    compared = models.compare_with_actual(ws.model(spark, folder, "linear"), holdout)
    path = export_csv(compared, run_folder(spark, "results_compare"), CONFIG.as_of)
    return _rounded_prediction(spark.read.csv(path, header=True, schema=compared.schema))


@query
def sink_csv_prediction(spark: SparkSession, folder: str) -> DataFrame:
    running = ws.stored_slice(spark, folder, "test")
    predicted = models.predict_current_quarter(ws.model(spark, folder, "linear"), running)
    path = export_csv(predicted, run_folder(spark, "curr_quarter_prediction"), CONFIG.as_of)
    return _rounded_prediction(spark.read.csv(path, header=True, schema=predicted.schema))


@query
def model_save(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(spark, "model")
    models.save_model(ws.model(spark, folder, "forest"), path)
    return spark.read.text(f"{path}/metadata")


@query
def model_load(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(spark, "model")
    models.save_model(ws.model(spark, folder, "forest"), path)
    _, holdout = ws.holdout_split(spark, folder)
    predicted = models.predict(models.load_model(path), holdout)
    return predicted.select("dt", "sales_div", schemas.LABEL, "prediction")


# --- projections --------------------------------------------------------------------------------


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return ws.sources(spark, folder).opportunity_history


def _spine(spark: SparkSession, folder: str) -> DataFrame:
    src = ws.sources(spark, folder)
    return joins.calendar_spine(src.quarter_mapping, src.calendar)


@query
def proj_amount_usd(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts are taken as they are in every currency."""
    usd = _history(spark, folder).withColumn("amount_usd", F.col("amount"))
    return _rows_and_amount(usd, "dt", "currencyisocode", amount="amount_usd")


@query
def proj_default_currency(spark: SparkSession, folder: str) -> DataFrame:
    return _rows_and_amount(
        _history(spark, folder), "dt", labels.currency_or_default().alias("currency")
    )


@query
def proj_undefined_division(spark: SparkSession, folder: str) -> DataFrame:
    src = ws.sources(spark, folder)
    mapped = joins.join_division(src.bookings, src.division_map, "owner_division__c")
    return _rows_and_amount(mapped, labels.division_or_undefined().alias("sales_div"), amount="amount__c")


@query
def proj_day_of_qtr(spark: SparkSession, folder: str) -> DataFrame:
    return _spine(spark, folder)


@query
def proj_qtr_pct(spark: SparkSession, folder: str) -> DataFrame:
    share = fiscal.quarter_elapsed(F.col("day_of_qtr"), F.col("fy_quarter"))
    return _spine(spark, folder).select("dt", "fy_quarter", share.alias("qtr_pct"))


@query
def proj_feature_ratios(spark: SparkSession, folder: str) -> DataFrame:
    """The ratios of every day that has snapshots, also of those after the run's day."""
    features = feature_plan.build_features(ws.sources(spark, folder), CONFIG, later_days=True)
    return features.select("dt", "sales_div", *schemas.RATIO_COLUMNS)


@query
def proj_drop_columns(spark: SparkSession, folder: str) -> DataFrame:
    return model_frames.drop_unused(ws.stored_slice(spark, folder, "train"))


@query
def proj_select_label(spark: SparkSession, folder: str) -> DataFrame:
    return model_frames.label_only(ws.stored_slice(spark, folder, "train"))


@query
def proj_normalise_headers(spark: SparkSession, folder: str) -> DataFrame:
    raw = ws.stored_slice(spark, folder, "train").select(
        F.col("dt").alias(" Snapshot Day "),
        F.col("sales_div").alias("Sales Div"),
        F.col("stage_1_amount").alias("Stage 1 (Amount)"),
    )
    return labels.normalise_headers(raw)


# --- filters ------------------------------------------------------------------------------------


@query
def flt_touched_120d(spark: SparkSession, folder: str) -> DataFrame:
    return _rows_and_amount(_history(spark, folder).where(predicates.touched_recently(CONFIG)), "dt")


@query
def flt_touched_nonzero(spark: SparkSession, folder: str) -> DataFrame:
    literal = ForecastConfig(as_of=CONFIG.as_of, min_dt=CONFIG.min_dt, touched_mode="nonzero")
    return _rows_and_amount(_history(spark, folder).where(predicates.touched_recently(literal)), "dt")


@query
def flt_open_opps(spark: SparkSession, folder: str) -> DataFrame:
    return _rows_and_amount(_history(spark, folder).where(predicates.open_opportunity()), "dt")


@query
def flt_closing_in_qtr(spark: SparkSession, folder: str) -> DataFrame:
    src = ws.sources(spark, folder)
    dated = joins.join_quarter(src.opportunity_history, src.quarter_mapping, "dt", how="inner")
    return _rows_and_amount(dated.where(predicates.closing_in_quarter()), "dt", "fy_quarter")


@query
def flt_exclude_ids(spark: SparkSession, folder: str) -> DataFrame:
    kept = predicates.not_excluded("id", CONFIG.excluded_opportunity_ids)
    return _rows_and_amount(_history(spark, folder).where(kept), "dt")


@query
def flt_qualified_booking(spark: SparkSession, folder: str) -> DataFrame:
    return _booking_rows(ws.sources(spark, folder).bookings.where(predicates.qualified_booking(CONFIG)))


@query
def flt_not_integration(spark: SparkSession, folder: str) -> DataFrame:
    return _booking_rows(ws.sources(spark, folder).bookings.where(predicates.not_integration_owner()))


@query
def flt_has_account(spark: SparkSession, folder: str) -> DataFrame:
    return _booking_rows(ws.sources(spark, folder).bookings.where(predicates.has_account()))


@query
def flt_segment_quota(spark: SparkSession, folder: str) -> DataFrame:
    quota = ws.sources(spark, folder).quota.where(predicates.segment_quota())
    return _with_doubles(quota.withColumn("start_date__c", F.to_date("start_date__c")))


@query
def flt_min_date(spark: SparkSession, folder: str) -> DataFrame:
    return _spine(spark, folder).where(F.col("dt") >= F.lit(CONFIG.min_dt))


@query
def flt_excluded_divisions(spark: SparkSession, folder: str) -> DataFrame:
    kept = _quarter_bookings(spark, folder).where(predicates.forecast_division(CONFIG))
    return _with_doubles(kept)


@query
def flt_quota_nonzero(spark: SparkSession, folder: str) -> DataFrame:
    return _with_doubles(_quota(spark, folder).where(F.col("quota") != 0))


@query
def flt_before_current_qtr(spark: SparkSession, folder: str) -> DataFrame:
    quarters = ws.sources(spark, folder).quarter_mapping
    start = run_dates.current_quarter_start(quarters, CONFIG)
    return _spine(spark, folder).where(F.col("dt") < start)


@query
def flt_in_current_qtr(spark: SparkSession, folder: str) -> DataFrame:
    quarters = ws.sources(spark, folder).quarter_mapping
    start = run_dates.current_quarter_start(quarters, CONFIG)
    return _spine(spark, folder).where(F.col("dt") >= start)


@query
def flt_until_last_booking(spark: SparkSession, folder: str) -> DataFrame:
    last = run_dates.latest_day(ws.sources(spark, folder).bookings, CONFIG)
    return _spine(spark, folder).where(F.col("dt") <= last)


@query
def flt_current_day(spark: SparkSession, folder: str) -> DataFrame:
    last = run_dates.latest_day(ws.sources(spark, folder).bookings, CONFIG)
    return _spine(spark, folder).where(F.col("dt") == last)


@query
def flt_fillna_zero(spark: SparkSession, folder: str) -> DataFrame:
    return model_frames.fill_missing(ws.stored_slice(spark, folder, "test"))


# --- joins --------------------------------------------------------------------------------------


@query
def join_quarter_range(spark: SparkSession, folder: str) -> DataFrame:
    src = ws.sources(spark, folder)
    dated = joins.join_quarter(src.bookings, src.quarter_mapping, "booking_date__c")
    return _rows_and_amount(dated, "booking_date__c", "fy_quarter", "qtr_start", amount="amount__c")


@query
def join_calendar_spine(spark: SparkSession, folder: str) -> DataFrame:
    return _spine(spark, folder)


@query
def join_division_map(spark: SparkSession, folder: str) -> DataFrame:
    src = ws.sources(spark, folder, True)
    owners = joins.join_division(src.opportunity_history, src.division_map, "owner_division__c")
    return _rows_and_amount(owners, "owner_division__c", "sales_div_clean")


@query
def join_quota_quarter(spark: SparkSession, folder: str) -> DataFrame:
    src = ws.sources(spark, folder)
    dated = joins.join_quota_quarter(src.quota, src.quarter_mapping)
    return dated.select("email__c", "quota_owner_type__c", "fy_quarter", _double("gross_quota__c"))


@query
def join_currency(spark: SparkSession, folder: str) -> DataFrame:
    src = ws.sources(spark, folder)
    # A row per day and code meets the rates: three codes are no key to shuffle snapshots on.
    daily = src.opportunity_history.groupBy("dt", "currencyisocode").agg(
        F.count(F.lit(1)).alias("snapshots"), F.sum("amount").alias("amount")
    )
    rated = joins.join_currency(daily, src.currency)
    return rated.groupBy("dt", "alphabeticcode", "rate").agg(
        F.sum("snapshots").alias("n_rows"), F.sum("amount").cast("double").alias("total_amount")
    )


@query
def join_account(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots meet the accounts row by row: few of a day share an account, so grouping first saves nothing."""
    src = ws.sources(spark, folder)
    known = joins.join_account(src.opportunity_history, src.account)
    return known.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("account_id").alias("n_known_accounts")
    )


def _assembled(src: Sources) -> DataFrame:
    daily = _daily(src)
    pipeline = _totals(src).where("touched_deals > 0").where(predicates.forecast_division(CONFIG))
    return joins.assemble_features(
        quota=aggregates.quota_by_quarter(src.quota, src.quarter_mapping, src.division_map),
        spine=joins.calendar_spine(src.quarter_mapping, src.calendar).where(predicates.known_by(CONFIG, "dt")),
        pipeline=pipeline,
        qtd=windows.bookings_to_date(daily),
        quarter_total=aggregates.quarter_bookings(daily),
    )


@query
def join_feature_assembly(spark: SparkSession, folder: str) -> DataFrame:
    parts = ("quota", "stage_1_amount", "stage_5_amount_all", "bookings_qtd", "direct_bookings")
    return _assembled(ws.sources(spark, folder)).select(
        *schemas.KEY_COLUMNS, *[_double(name) for name in parts]
    )


@query
def join_prior_day_pipe(spark: SparkSession, folder: str) -> DataFrame:
    touched = aggregates.touched_pipeline(_totals(ws.sources(spark, folder)))
    dated = joins.shift_to_next_day(touched).join(_spine(spark, folder), ["fy_quarter", "dt"])
    return _with_doubles(dated.select(*schemas.KEY_COLUMNS, *schemas.STAGE_AMOUNTS))


def _lags(spark: SparkSession, folder: str, quarters: int) -> DataFrame:
    # The last day is looked up more than once in the plan, so it comes from the stored days of bookings.
    latest = run_dates.latest_day(ws.booked(spark, folder), CONFIG)
    return windows.same_day_lags(ws.sources(spark, folder).calendar, latest, quarters)


@query
def join_semi_in_subquery(spark: SparkSession, folder: str) -> DataFrame:
    days = windows.lag_days(_lags(spark, folder, 4))
    return joins.on_days(ws.stored_features(spark, folder), days)


@query
def join_concat_predictions(spark: SparkSession, folder: str) -> DataFrame:
    _, holdout = ws.holdout_split(spark, folder)
    return _rounded_prediction(models.compare_with_actual(ws.model(spark, folder, "linear"), holdout))


# --- aggregations -------------------------------------------------------------------------------


def _totals(src: Sources) -> DataFrame:
    return aggregates.pipeline_totals(
        src.opportunity_history, src.quarter_mapping, src.division_map, CONFIG
    )


def _daily(src: Sources) -> DataFrame:
    return aggregates.daily_bookings(src.bookings, src.quarter_mapping, src.division_map, CONFIG)


def _quarter_bookings(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.quarter_bookings(_daily(ws.sources(spark, folder)))


def _quota(spark: SparkSession, folder: str) -> DataFrame:
    src = ws.sources(spark, folder)
    return aggregates.quota_by_quarter(src.quota, src.quarter_mapping, src.division_map)


@query
def agg_stage_pipe(spark: SparkSession, folder: str) -> DataFrame:
    touched = aggregates.touched_pipeline(_totals(ws.sources(spark, folder)))
    return _with_doubles(touched.drop(*schemas.LARGE_DEALS))


@query
def agg_large_deals(spark: SparkSession, folder: str) -> DataFrame:
    touched = aggregates.touched_pipeline(_totals(ws.sources(spark, folder)))
    return _with_doubles(touched.select(*aggregates.PIPELINE_KEYS, *schemas.LARGE_DEALS))


@query
def agg_stage_pipe_all(spark: SparkSession, folder: str) -> DataFrame:
    return _with_doubles(aggregates.open_pipeline(_totals(ws.sources(spark, folder))))


@query
def agg_daily_bookings(spark: SparkSession, folder: str) -> DataFrame:
    return _with_doubles(_daily(ws.sources(spark, folder)))


@query
def agg_quarter_bookings(spark: SparkSession, folder: str) -> DataFrame:
    return _with_doubles(_quarter_bookings(spark, folder))


@query
def agg_quota(spark: SparkSession, folder: str) -> DataFrame:
    return _with_doubles(_quota(spark, folder))


@query
def agg_max_booking_date(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.latest_booking_day(ws.sources(spark, folder).bookings, CONFIG)


@query
def agg_stl4q_average(spark: SparkSession, folder: str) -> DataFrame:
    """The mean over all of a division's history instead of four days."""
    return _rounded(aggregates.four_quarter_average(ws.stored_features(spark, folder)))


@query
def agg_corr_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(aggregates.correlation_matrix(ws.stored_slice(spark, folder, "train")))


# --- windows, sorts, set operations, subqueries -------------------------------------------------


@query
def win_bookings_qtd(spark: SparkSession, folder: str) -> DataFrame:
    return _with_doubles(windows.bookings_to_date(_daily(ws.sources(spark, folder))))


@query
def win_qtd_fill(spark: SparkSession, folder: str) -> DataFrame:
    assembled = _assembled(ws.sources(spark, folder))
    filled = windows.filled_bookings(CONFIG.fill_rows).cast("double")
    return assembled.select("dt", "fy_quarter", "sales_div", filled.alias("bookings_qtd"))


@query
def win_lag_same_day(spark: SparkSession, folder: str) -> DataFrame:
    return _lags(spark, folder, 1)


@query
def win_lag_1_to_4(spark: SparkSession, folder: str) -> DataFrame:
    return _lags(spark, folder, 4)


@query
def sort_output(spark: SparkSession, folder: str) -> DataFrame:
    """The published order, with each row's place in it."""
    ordered = feature_plan.sort_for_output(ws.stored_slice(spark, folder, "train"))
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return ordered.select("sales_div", "dt", place.alias("place"))


@query
def setop_union_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return windows.lag_days(_lags(spark, folder, 4))


@query
def sub_scalar(spark: SparkSession, folder: str) -> DataFrame:
    """Every date of the run, each a scalar subquery, beside the number of bookings they rest on."""
    src = ws.sources(spark, folder)
    lazy = run_dates.RunDates.lazy(src, CONFIG)
    return src.bookings.agg(F.count(F.lit(1)).alias("n_bookings")).select(
        "n_bookings",
        lazy.quarter_start.alias("quarter_start"),
        lazy.latest_booking.alias("latest_booking"),
        *[day.alias(f"lag_{k}") for k, day in enumerate(lazy.lags, start=1)],
    )


@query
def sub_cte(spark: SparkSession, folder: str) -> DataFrame:
    """Nested common table expressions in Spark SQL over published frames."""
    src = ws.sources(spark, folder)
    src.bookings.createOrReplaceTempView("sub_cte_bookings")
    src.quarter_mapping.createOrReplaceTempView("sub_cte_quarters")
    return spark.sql(
        """
        WITH per_quarter AS (
            WITH per_day AS (
                SELECT booking_date__c AS dt, count(*) AS n_bookings FROM sub_cte_bookings GROUP BY booking_date__c
            )
            SELECT fy_quarter, max(n_bookings) AS busiest_day, sum(n_bookings) AS n_bookings
            FROM (SELECT fy_quarter, explode(sequence(qtr_start, qtr_end)) AS dt FROM sub_cte_quarters)
            JOIN per_day USING (dt)
            GROUP BY fy_quarter
        )
        SELECT fy_quarter, busiest_day, n_bookings FROM per_quarter
        """
    )


# --- scalar functions ---------------------------------------------------------------------------


@query
def fn_case_when(spark: SparkSession, folder: str) -> DataFrame:
    late = F.when(F.col("stagename").isin("4. POC", "5. Contract"), "late").otherwise("early")
    return _rows_and_amount(_history(spark, folder), "dt", late.alias("phase"))


@query
def fn_null_tests(spark: SparkSession, folder: str) -> DataFrame:
    return ws.sources(spark, folder).bookings.groupBy("booking_date__c").agg(
        F.count_if(F.col("coupon__c").isNull()).alias("n_no_coupon"),
        F.count_if(F.col("coupon__c").isNotNull()).alias("n_coupon"),
    )


@query
def fn_lower_like(spark: SparkSession, folder: str) -> DataFrame:
    owner = F.lower("owner_name")
    return ws.sources(spark, folder).bookings.groupBy(owner.alias("owner")).agg(
        F.count_if(owner.like("%integration%")).alias("n_integration"),
        F.count_if(~owner.like("%integration%")).alias("n_people"),
    )


@query
def fn_in_between(spark: SparkSession, folder: str) -> DataFrame:
    small = F.col("amount__c").between(0, CONFIG.min_order_amount)
    return ws.sources(spark, folder).bookings.groupBy("booking_date__c").agg(
        F.count_if(F.col("order_type__c").isin("New", "New Order")).alias("n_new"),
        F.count_if(~F.col("order_type__c").isin("New", "New Order")).alias("n_other"),
        F.count_if(small).alias("n_small"),
    )


@query
def fn_date_diff_add(spark: SparkSession, folder: str) -> DataFrame:
    age = F.datediff("closedate", "dt")
    return _history(spark, folder).groupBy(F.date_add("dt", 1).alias("next_day")).agg(
        F.min(age).alias("least_days_to_close"), F.max(age).alias("most_days_to_close")
    )


@query
def fn_cast(spark: SparkSession, folder: str) -> DataFrame:
    spine = _spine(spark, folder)
    return ws.sources(spark, folder).quota.select(
        F.col("start_date__c").cast("date").alias("start_date"),
        "email__c",
        "quota_owner_type__c",
        _double("gross_quota__c"),
    ).join(
        spine.select(F.col("dt").alias("start_date"), F.col("day_of_qtr").cast("double").alias("day_number")),
        "start_date",
    )


@query
def fn_to_char_mmdd(spark: SparkSession, folder: str) -> DataFrame:
    bookings = ws.sources(spark, folder).bookings
    return _rows_and_amount(bookings, fiscal.month_day(F.col("booking_date__c")).alias("month_day"),
                            amount="amount__c")


@query
def fn_arith(spark: SparkSession, folder: str) -> DataFrame:
    features = ws.stored_features(spark, folder)
    late, gap = F.col("stage_4_amount") + F.col("stage_5_amount"), F.col("quota") - F.col("bookings_qtd")
    return features.select(
        "dt", "sales_div", late.alias("late"), gap.alias("gap"), F.try_divide(late, gap).alias("cover")
    )


@query
def fn_current_date(spark: SparkSession, folder: str) -> DataFrame:
    today = fiscal.as_of_day(CONFIG.as_of)
    bookings = ws.sources(spark, folder).bookings
    return bookings.groupBy(F.datediff(today, "booking_date__c").alias("days_ago")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def fn_str_clean(spark: SparkSession, folder: str) -> DataFrame:
    raw = ws.stored_features(spark, folder).select(
        F.col("dt").alias("DT"), F.col("sales_div").alias(" Sales Div"), F.col("quota").alias("Quota (USD) ")
    )
    return labels.normalise_headers(raw)


@query
def fn_abs_mean(spark: SparkSession, folder: str) -> DataFrame:
    off = F.avg(F.abs(F.col("bookings_pct_finish") - F.col("bookings_pct_qtd")))
    return _rounded(ws.stored_features(spark, folder).groupBy("sales_div").agg(off.alias("mean_gap")))


@query
def fn_date_and_text(spark: SparkSession, folder: str) -> DataFrame:
    calendar = ws.sources(spark, folder).calendar
    return calendar.select(
        "dt",
        F.date_add("dt", 1).alias("next_day"),
        F.datediff("dt", fiscal.quarter_start(F.col("dt"))).alias("days_into_quarter"),
        fiscal.month_day(F.col("dt")).alias("month_day"),
        F.lower(fiscal.quarter_label(fiscal.quarter_start(F.col("dt")))).alias("quarter_key"),
    )


# --- published slices ---------------------------------------------------------------------------


def _register_views() -> None:
    def slice_query(name: str, together: bool) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            src = ws.sources(spark, folder, together)
            df = slices.build_slice(name, src, CONFIG, ws.dates(spark, folder))
            return _rounded(df) if name == "stl4q_avg" else df

        run.__name__ = f"view_{name}" + ("_together" if together else "")
        run.__doc__ = slices.SLICES[name].__doc__
        return run

    for together in (False, True):
        for name in slices.SLICES:
            query(slice_query(name, together))


_register_views()


@query
def view_test_backdated(spark: SparkSession, folder: str) -> DataFrame:
    """The running quarter of a run a year earlier, over the same sources."""
    return slices.build_slice("test", ws.sources(spark, folder), ws.BACK_DATED)


# --- models -------------------------------------------------------------------------------------


@query
def ml_split(spark: SparkSession, folder: str) -> DataFrame:
    return model_frames.with_holdout(ws.stored_slice(spark, folder, "train")).select(
        "dt", "sales_div", "is_test"
    )


@query
def ml_one_hot(spark: SparkSession, folder: str) -> DataFrame:
    """The levels come from the fitted encoder of the linear model."""
    fitted = ws.model(spark, folder, "linear").stages[0]
    train = ws.stored_slice(spark, folder, "train").select("dt", "sales_div", "qtr_pct")
    return model_frames.one_hot(train, "sales_div", list(fitted.labelsArray[0]))


@query
def ml_assemble(spark: SparkSession, folder: str) -> DataFrame:
    train = models.model_rows(ws.stored_slice(spark, folder, "train"))
    *encoders, _ = ws.model(spark, folder, "linear").stages
    encoded = train
    for stage in encoders:
        encoded = stage.transform(encoded)
    slots = vector_to_array("features")
    return encoded.select(
        "dt",
        F.col("sales_div").alias("division"),
        *[slots[i].alias(name) for i, name in enumerate(models.feature_names(ws.model(spark, folder, "linear")))],
    )


@query
def ml_linear_regression(spark: SparkSession, folder: str) -> DataFrame:
    _, holdout = ws.holdout_split(spark, folder)
    scored = models.score_model(ws.model(spark, folder, "linear"), holdout)
    return scored.withColumns({c: F.round(c, 4) for c in ("r2_score", "avg_abs_var_finish", "avg_abs_var_pct")})


@query
def ml_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    """A feature that is a combination of earlier ones has 0."""
    found = models.coefficients(spark, ws.model(spark, folder, "linear"))
    return found.withColumn("coefficient", F.round("coefficient", 3) + 0.0)


@query
def ml_random_forest(spark: SparkSession, folder: str) -> DataFrame:
    _, holdout = ws.holdout_split(spark, folder)
    return models.score_model(ws.model(spark, folder, "forest"), holdout)


@query
def ml_random_forest_together(spark: SparkSession, folder: str) -> DataFrame:
    _, holdout = ws.holdout_split(spark, folder, True)
    return models.score_model(ws.model(spark, folder, "forest", True), holdout)


@query
def ml_gradient_boosting(spark: SparkSession, folder: str) -> DataFrame:
    _, holdout = ws.holdout_split(spark, folder)
    return models.score_model(ws.model(spark, folder, "boosting"), holdout)


@query
def ml_gradient_boosting_together(spark: SparkSession, folder: str) -> DataFrame:
    _, holdout = ws.holdout_split(spark, folder, True)
    return models.score_model(ws.model(spark, folder, "boosting", True), holdout)


@query
def ml_grid_search(spark: SparkSession, folder: str) -> DataFrame:
    return ws.search(spark, folder).to_frame(spark, "mae")


@query
def ml_grid_search_r2(spark: SparkSession, folder: str) -> DataFrame:
    return ws.search(spark, folder).to_frame(spark, "r2")


@query
def ml_best_params(spark: SparkSession, folder: str) -> DataFrame:
    return ws.search(spark, folder).to_frame(spark, "mae").where("is_best")


@query
def ml_grid_search_points(spark: SparkSession, folder: str) -> DataFrame:
    """Every point of the search, with what holds for exact cuts of the same forests whatever the data.

    A split needs twice the leaf size, so smaller least split sizes change nothing.
    """
    points = ml_grid_search(spark, folder)
    plain = points.where("min_split = 2").select(
        F.col("max_depth").alias("depth"), F.col("min_leaf").alias("leaf"), F.col("score").alias("plain")
    )
    met = points.join(plain, F.col("depth").eqNullSafe(F.col("max_depth")) & (F.col("leaf") == F.col("min_leaf")))
    no_effect = F.col("min_split") <= 2 * F.col("min_leaf")
    return met.select(
        "max_depth",
        "min_split",
        "min_leaf",
        (F.col("score") > 0).alias("has_score"),
        F.when(no_effect, F.col("score") == F.col("plain")).otherwise(True).alias("split_size_fits"),
    )


@query
def ml_predict(spark: SparkSession, folder: str) -> DataFrame:
    _, holdout = ws.holdout_split(spark, folder)
    predicted = models.predict(ws.model(spark, folder, "forest"), holdout)
    return predicted.select("dt", "sales_div", schemas.LABEL, "prediction")


@query
def ml_predict_current_quarter(spark: SparkSession, folder: str) -> DataFrame:
    running = ws.stored_slice(spark, folder, "test")
    return models.predict_current_quarter(ws.model(spark, folder, "forest"), running)


@query
def ml_train_score(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = ws.holdout_split(spark, folder)
    return models.score_model(ws.model(spark, folder, "forest"), train)


@query
def ml_feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    return models.feature_importance(spark, ws.model(spark, folder, "forest"))


@query
def ml_scale_lasso(spark: SparkSession, folder: str) -> DataFrame:
    return models.coefficients(spark, ws.lasso(spark, folder))


@query
def ml_scale_lasso_optimal(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each coefficient is where the lasso's penalty balances the slope of the squared error."""
    train, _ = ws.holdout_split(spark, folder)
    return models.lasso_conditions(spark, ws.lasso(spark, folder), train, ws.LASSO_ALPHA)


@query
def ml_predict_walk(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out rows whose forest prediction is the mean that joins with the node table find."""
    return _walked(spark, folder, "forest")


@query
def ml_gradient_boosting_walk(spark: SparkSession, folder: str) -> DataFrame:
    return _walked(spark, folder, "boosting")


def _walked(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    _, holdout = ws.holdout_split(spark, folder)
    fitted = ws.model(spark, folder, kind)
    scored = fitted.transform(models.model_rows(holdout)).select("dt", "sales_div", models.FEATURES, "prediction")
    trees = fitted.stages[-1]
    walked = tree_tables.predictions_by_walk(
        tree_tables.node_table(trees), tree_tables.tree_weights(trees), scored, "dt", "sales_div"
    )
    same = F.abs(F.col("prediction") - F.col("by_walk")) < 1e-9
    return scored.drop(models.FEATURES).join(walked, ["dt", "sales_div"], "left").select("dt", "sales_div", same.alias("same"))

# --- properties of model results that hold exactly, whatever solver or seed ----------------------


def _has_prediction(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.col("prediction").isNotNull().alias("has_prediction"))


@query
def sink_csv_compare_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _has_prediction(sink_csv_compare(spark, folder), "dt", "sales_div")


@query
def sink_csv_prediction_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _has_prediction(sink_csv_prediction(spark, folder), "dt", "sales_div")


@query
def join_concat_predictions_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _has_prediction(join_concat_predictions(spark, folder), "dt", "sales_div", "day_of_qtr")


@query
def model_load_same(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out rows that the stored and reloaded forest predicts like the one in memory."""
    keys = ["dt", "sales_div"]
    before = ml_predict(spark, folder).select(*keys, F.col("prediction").alias("before"))
    return model_load(spark, folder).join(before, keys).select(*keys, (F.col("prediction") == F.col("before")).alias("same"))


@query
def ml_predict_range(spark: SparkSession, folder: str) -> DataFrame:
    """A forest predicts averages of training labels, so it stays within their range."""
    train, _ = ws.holdout_split(spark, folder)
    label = F.col(schemas.LABEL)
    low, high = train.agg(F.min(label), F.max(label)).first()
    return ml_predict(spark, folder).select(
        "dt", "sales_div", F.col("prediction").between(low - 1e-9, high + 1e-9).alias("in_range")
    )


@query
def ml_predict_current_quarter_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _has_prediction(ml_predict_current_quarter(spark, folder), "dt", "sales_div")


def _beats_mean(scored: DataFrame) -> DataFrame:
    return scored.select(F.col("n_rows").cast("long").alias("n_rows"), (F.col("r2_score") > 0).alias("beats_mean"))


@query
def ml_linear_regression_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _beats_mean(ml_linear_regression(spark, folder))


@query
def ml_random_forest_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _beats_mean(ml_random_forest(spark, folder))


@query
def ml_gradient_boosting_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _beats_mean(ml_gradient_boosting(spark, folder))


@query
def ml_train_score_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _beats_mean(ml_train_score(spark, folder))


@query
def ml_feature_importance_total(spark: SparkSession, folder: str) -> DataFrame:
    importance = F.col("importance")
    return ml_feature_importance(spark, folder).agg(
        F.count("*").alias("n_features"),
        F.round(F.sum(importance), 6).alias("total"),
        (F.min(importance) >= 0).alias("none_negative"),
    )


def _scored(spark: SparkSession, folder: str, *names: str) -> DataFrame:
    """Scores of a forecast that needs no model: the quarter ends where it stands today."""
    train = model_frames.fill_missing(ws.stored_slice(spark, folder, "train"))
    return _rounded(metrics.score(train, schemas.LABEL, "bookings_pct_qtd").select(*names))


@query
def metric_r2(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, "r2_score")


@query
def metric_avg_abs_var_finish(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, "avg_abs_var_finish")


@query
def metric_avg_abs_var_pct(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, "avg_abs_var_pct", "rows_without_pct", "n_rows")

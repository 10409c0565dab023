"""The registered queries as SQL for another engine, to check results against.

Written in the plain shape of the definition, not in the shape of the Spark plans:
day lookups are range joins, touched and unfiltered pipeline are two passes, a
slice's conditions are applied ahead of the window. Agreement therefore also
checks that the plans' shortcuts change nothing.
"""

from __future__ import annotations

from pipecast import schemas
from pipecast.operators.model_frames import HOLDOUT_BUCKETS
from pipecast.queries.workspace import BACK_DATED, CONFIG

AS_OF = f"DATE '{CONFIG.as_of}'"
MIN_DT = f"DATE '{CONFIG.min_dt}'"


def _in_list(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{value}'" for value in values)


STAGE_LIST = _in_list(CONFIG.stages)
EXCLUDED = _in_list(CONFIG.excluded_divisions)
OPPORTUNITY_ID = CONFIG.excluded_opportunity_ids[0]
BOOKING_ID = CONFIG.excluded_booking_ids[0]

# --- the source tables, derived from the given ones ---------------------------------------------

# labelled_orders is materialised because DuckDB 2.0.0 can fail with an internal error when
# dictionary-encoded strings straight from a parquet scan reach a grouping through unnest.

_SOURCES = f"""
labelled_orders AS MATERIALIZED (
    SELECT o.*, CAST(o_orderdate AS DATE) AS od, n_name, r_name, 20 + (o_orderkey * 37) % 131 AS life
    FROM orders o
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
),
quarter_starts AS (
    SELECT unnest(generate_series(
        date_trunc('quarter', min(CAST(o_orderdate AS DATE)) - INTERVAL 1 MONTH) + INTERVAL 1 MONTH,
        date_trunc('quarter', max(CAST(o_orderdate AS DATE)) + 150 - INTERVAL 1 MONTH) + INTERVAL 1 MONTH,
        INTERVAL 3 MONTH)) AS s
    FROM orders
),
quarter_mapping AS (
    SELECT 'FY' || lpad(CAST((year(s) + CASE WHEN month(s) >= 2 THEN 1 ELSE 0 END) % 100 AS VARCHAR), 2, '0')
               || ' Q' || CAST((month(s) - 2) // 3 + 1 AS VARCHAR) AS fy_quarter,
           CAST(s AS DATE) AS qtr_start,
           CAST(s + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS qtr_end
    FROM quarter_starts
),
calendar AS (
    SELECT CAST(day AS DATE) AS dt, CAST(CAST(day AS DATE) - qtr_start + 1 AS INTEGER) AS day_of_fiscal_quarter
    FROM (SELECT qtr_start, unnest(generate_series(
              CAST(qtr_start AS TIMESTAMP), CAST(qtr_end AS TIMESTAMP), INTERVAL 1 DAY)) AS day
          FROM quarter_mapping)
),
opportunity_history AS (
    SELECT CASE WHEN o_orderkey = 1 THEN '{OPPORTUNITY_ID}' ELSE CAST(o_orderkey AS VARCHAR) END AS id,
           od + CAST(k AS INTEGER) AS dt,
           [{STAGE_LIST}][k * 5 // life + 1] AS stagename,
           CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18, 2)) END AS amount,
           CASE o_orderkey % 4 WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' WHEN 3 THEN 'GBP' END AS currencyisocode,
           CASE WHEN o_orderkey % 17 = 0 THEN 'gone' ELSE '' END || o_custkey AS accountid,
           CASE WHEN o_orderkey % 7 <> 0 THEN od END AS lastactivitydate,
           CASE WHEN o_orderkey % 3 = 0 THEN od ELSE od + CAST(k // 60 * 60 AS INTEGER) END AS lastmodifieddate,
           o_orderkey % 50 = 0 AS isdeleted,
           o_orderstatus = 'F' AND k * 4 >= life * 3 AS isclosed,
           od + CAST(life AS INTEGER) AS closedate,
           n_name AS owner_division__c
    FROM (SELECT *, unnest(range(0, life)) AS k FROM labelled_orders)
),
bookings AS (
    SELECT CASE WHEN l_orderkey = 1 AND l_linenumber = 1 THEN '{BOOKING_ID}'
                ELSE l_orderkey || '-' || l_linenumber END AS id,
           CAST(l_shipdate AS DATE) AS booking_date__c,
           CAST(CASE WHEN l_partkey % 5 = 0 THEN l_quantity ELSE l_extendedprice END AS DECIMAL(18, 2))
               * CASE WHEN l_tax = 0.08 AND l_quantity = 50 THEN -1 ELSE 1 END AS amount__c,
           n_name AS owner_division__c,
           CASE WHEN l_linenumber = 7 THEN 'Renewal' WHEN l_returnflag = 'A' THEN 'New'
                WHEN l_returnflag = 'N' THEN 'New Order' ELSE 'Upsell' END AS order_type__c,
           CASE WHEN l_discount > 0.08 THEN 'C10' WHEN l_discount = 0 THEN '' END AS coupon__c,
           CASE WHEN l_tax = 0.08 THEN 'Y' ELSE 'N' END AS bookingexception__c,
           CASE WHEN l_suppkey % 20 = 0 THEN 'API Integration User' ELSE 'sup' || l_suppkey END AS owner_name,
           CASE WHEN o_custkey % 41 = 0 THEN '' WHEN o_custkey % 43 <> 0 THEN CAST(o_custkey AS VARCHAR)
               END AS account__c,
           l_linestatus = 'F' AND l_orderkey % 30 = 0 AS isdeleted
    FROM lineitem JOIN labelled_orders ON o_orderkey = l_orderkey
),
quota AS (
    SELECT start_date__c, email__c, gross_quota__c, unnest(['Segment', 'Rep']) AS quota_owner_type__c
    FROM (SELECT CAST(date_trunc('quarter', od - INTERVAL 1 MONTH) + INTERVAL 1 MONTH AS DATE) AS start_date__c,
                 'quota.' || r_name AS email__c,
                 CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(18, 2)) * 0.5
                     AS DECIMAL(18, 2)) AS gross_quota__c
          FROM labelled_orders GROUP BY ALL)
),
currency AS (
    SELECT code AS alphabeticcode,
           CAST(CASE code WHEN 'USD' THEN 1.0 WHEN 'EUR' THEN 1.1 ELSE 1.3 END AS DOUBLE) AS rate
    FROM (SELECT DISTINCT currencyisocode AS code FROM opportunity_history) WHERE code IS NOT NULL
),
account AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer),
map_separated AS (
    SELECT n_name AS sales_div_dirty, CASE WHEN r_regionkey = 4 THEN 'Channel' ELSE r_name END AS sales_div_clean
    FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey <> 24
    UNION ALL
    SELECT 'quota.' || r_name, CASE WHEN r_regionkey = 4 THEN 'Channel' ELSE r_name END FROM region
),
map_together AS (
    SELECT sales_div_dirty, CASE WHEN sales_div_clean IN (SELECT r_name FROM region WHERE r_regionkey IN (1, 2, 3))
                                 THEN 'Intl' ELSE sales_div_clean END AS sales_div_clean
    FROM map_separated
)"""

# --- the steps of the feature table -------------------------------------------------------------

_COUNTABLE = f"""
    FROM opportunity_history o
    JOIN quarter_mapping q ON o.dt BETWEEN q.qtr_start AND q.qtr_end
    LEFT JOIN division_map m ON m.sales_div_dirty = o.owner_division__c
    WHERE NOT isdeleted AND NOT isclosed AND amount > 0
      AND closedate BETWEEN q.qtr_start AND q.qtr_end AND id <> '{OPPORTUNITY_ID}'"""

_TOUCHED = (
    f"(dt - lastactivitydate < {CONFIG.touched_days} OR dt - lastmodifieddate < {CONFIG.touched_days})"
)


def _money(expression: str, condition: str) -> str:
    return f"coalesce(sum({expression}) FILTER (WHERE {condition}), 0)"


def _stage_sums(suffix: str = "", counts: bool = True) -> str:
    parts = []
    for k, stage in enumerate(CONFIG.stages, start=1):
        if counts:
            parts.append(f"count(*) FILTER (WHERE stagename = '{stage}') AS stage_{k}_count")
        parts.append(_money("amount", f"stagename = '{stage}'") + f" AS stage_{k}_amount{suffix}")
    return ",\n           ".join(parts)


def _large_sums() -> str:
    parts = []
    for first, name in zip((3, 4, 5), schemas.LARGE_DEALS):
        late = f"stagename IN ({_in_list(CONFIG.stages[first - 1:])}) AND amount > {CONFIG.large_deal}"
        parts.append(_money("amount", late) + f" AS {name}")
    return ",\n           ".join(parts)


_COUNTED = f"""
      NOT isdeleted
      AND ((order_type__c IN ('New', 'New Order')
            AND (amount__c >= {CONFIG.min_order_amount} OR (amount__c < {CONFIG.min_order_amount} AND coupon__c <> '')))
           OR (order_type__c = 'Upsell' AND amount__c >= 0)
           OR bookingexception__c = 'Y')
      AND lower(owner_name) NOT LIKE '%integration%' AND account__c <> '' AND id <> '{BOOKING_ID}'"""

_KNOWN_DAYS = f" AND e.dt <= {AS_OF}"

_STEPS = f"""
touched_pipe AS (
    SELECT o.dt, q.fy_quarter, coalesce(m.sales_div_clean, 'UnDefined') AS sales_div,
           {_stage_sums()},
           {_large_sums()}
    {_COUNTABLE} AND {_TOUCHED.replace("dt -", "o.dt -")}
    GROUP BY 1, 2, 3
),
open_pipe AS (
    SELECT o.dt, q.fy_quarter, coalesce(m.sales_div_clean, 'UnDefined') AS sales_div,
           {_stage_sums("_all", counts=False)}
    {_COUNTABLE}
    GROUP BY 1, 2, 3
),
counted_bookings AS (
    SELECT booking_date__c, fy_quarter, sales_div_clean, amount__c
    FROM bookings b
    LEFT JOIN quarter_mapping q ON b.booking_date__c BETWEEN q.qtr_start AND q.qtr_end
    LEFT JOIN division_map m ON m.sales_div_dirty = b.owner_division__c
    WHERE {_COUNTED} AND booking_date__c <= {AS_OF}
),
daily AS (
    SELECT booking_date__c, fy_quarter, sales_div_clean, sum(amount__c) AS bookings
    FROM counted_bookings GROUP BY ALL
),
qtd AS (
    SELECT booking_date__c AS dt, fy_quarter, coalesce(sales_div_clean, 'UnDefined') AS sales_div,
           sum(bookings) OVER (PARTITION BY fy_quarter, sales_div_clean ORDER BY booking_date__c
                               ROWS UNBOUNDED PRECEDING) AS bookings_qtd
    FROM daily
),
finish AS (
    SELECT fy_quarter, coalesce(sales_div_clean, 'UnDefined') AS sales_div, sum(amount__c) AS direct_bookings
    FROM counted_bookings GROUP BY ALL
),
goal AS (
    SELECT fy_quarter, coalesce(sales_div_clean, 'UnDefined') AS sales_div, sum(gross_quota__c) AS quota
    FROM quota
    LEFT JOIN quarter_mapping ON qtr_start = CAST(start_date__c AS DATE)
    LEFT JOIN division_map ON sales_div_dirty = email__c
    WHERE quota_owner_type__c = 'Segment' AND gross_quota__c > 0
    GROUP BY ALL
),
spine AS (
    SELECT fy_quarter, dt, CAST(dt - qtr_start + 1 AS INTEGER) AS day_of_qtr
    FROM quarter_mapping LEFT JOIN calendar ON dt BETWEEN qtr_start AND qtr_end
),
assembled AS (
    SELECT e.dt, p.fy_quarter, e.day_of_qtr, p.sales_div, g.quota,
           p.* EXCLUDE (dt, fy_quarter, sales_div),
           a.* EXCLUDE (dt, fy_quarter, sales_div),
           b.bookings_qtd, c.direct_bookings
    FROM goal g
    LEFT JOIN spine e ON e.fy_quarter = g.fy_quarter
    LEFT JOIN qtd b ON b.dt = e.dt AND b.sales_div = g.sales_div AND b.fy_quarter = g.fy_quarter
    LEFT JOIN finish c ON c.sales_div = g.sales_div AND c.fy_quarter = g.fy_quarter
    LEFT JOIN touched_pipe p ON p.dt + 1 = e.dt AND p.sales_div = g.sales_div AND p.fy_quarter = g.fy_quarter
    LEFT JOIN open_pipe a ON a.dt + 1 = e.dt AND a.sales_div = g.sales_div AND a.fy_quarter = g.fy_quarter
    WHERE p.sales_div NOT IN ({EXCLUDED}){_KNOWN_DAYS}
),
latest AS (SELECT max(booking_date__c) AS day FROM bookings WHERE booking_date__c <= {AS_OF}),
running AS (SELECT qtr_start FROM quarter_mapping WHERE {AS_OF} BETWEEN qtr_start AND qtr_end),
same_days AS (
    SELECT dt, lag(dt, 1) OVER w AS lag_1, lag(dt, 2) OVER w AS lag_2,
           lag(dt, 3) OVER w AS lag_3, lag(dt, 4) OVER w AS lag_4
    FROM calendar
    WHERE day_of_fiscal_quarter = (SELECT day_of_fiscal_quarter FROM calendar WHERE dt = (SELECT day FROM latest))
    WINDOW w AS (ORDER BY dt)
),
lags AS (SELECT * FROM same_days WHERE dt = (SELECT day FROM latest)),
lag_days AS (
    SELECT lag_1 AS dt FROM lags UNION SELECT lag_2 FROM lags
    UNION SELECT lag_3 FROM lags UNION SELECT lag_4 FROM lags
)"""


def _features(condition: str) -> str:
    """The 36 columns over the rows that meet ``condition``, which applies ahead of the gap filling."""
    doubles = ["quota", *schemas.STAGE_AMOUNTS, *schemas.STAGE_AMOUNTS_ALL, *schemas.LARGE_DEALS, "direct_bookings"]
    numbers = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in doubles)

    def total(names: list[str]) -> str:
        return "(" + " + ".join(names) + ")"

    def stage_range(first: int) -> list[str]:
        return [f"stage_{k}_amount" for k in range(first, 6)]

    ratios = [f"stage_{k}_amount / quota AS s{k}_quota_ratio" for k in range(1, 6)]
    ratios.append(f"{total(stage_range(4))} / quota AS s45_quota_ratio")
    for first in range(1, 6):
        digits = "".join(map(str, range(first, 6)))
        ratios.append(f"{total([*stage_range(first), 'bookings_qtd'])} / quota AS s{digits}_bk_qtd_quota_ratio")
    for digits in ("345", "45", "5"):
        ratios.append(f"stage{digits}_large_deals / quota AS s{digits}_lg_deal_quota_ratio")
    everything = total(list(schemas.STAGE_AMOUNTS_ALL))
    ratios += [
        f"{everything} / nullif(quota - bookings_qtd, 0) AS pipe_coverage",
        f"(quota - bookings_qtd) / nullif({everything}, 0) AS pct_pipe_remain_to_close",
        "bookings_qtd / quota AS bookings_pct_qtd",
        "direct_bookings / quota AS bookings_pct_finish",
    ]
    return f"""
    SELECT dt, fy_quarter, day_of_qtr, sales_div, quota, {", ".join(schemas.STAGE_COLUMNS)},
           bookings_qtd, direct_bookings,
           CAST(day_of_qtr AS DOUBLE) / CASE WHEN fy_quarter LIKE '%Q1' THEN 89 ELSE 92 END AS qtr_pct,
           {", ".join(ratios)}
    FROM (
        SELECT dt, fy_quarter, day_of_qtr, sales_div, {", ".join(schemas.STAGE_COUNTS)}, {numbers},
               CAST(coalesce(bookings_qtd, max(bookings_qtd) OVER (
                   PARTITION BY fy_quarter, sales_div ORDER BY dt ROWS BETWEEN 30 PRECEDING AND CURRENT ROW), 0)
                   AS DOUBLE) AS bookings_qtd
        FROM assembled
        WHERE dt >= {MIN_DT} AND {condition}
    )"""


_PAST = "quota <> 0 AND dt < (SELECT qtr_start FROM running)"
_RUNNING = "dt >= (SELECT qtr_start FROM running)"
_TRAIN = _features(_PAST)
_TEST = _features(f"{_RUNNING} AND dt <= (SELECT day FROM latest)")
_AVERAGES = ", ".join(
    f"round(avg({c}), {4 if c in schemas.MONEY_COLUMNS else 6}) AS {c}" for c in schemas.MEASURE_COLUMNS
)
_SLICES = {
    "train": _TRAIN,
    "test": _TEST,
    "current_day": f"SELECT * FROM ({_features(_RUNNING)}) WHERE dt = (SELECT day FROM latest)",
    "stlq": f"SELECT * FROM ({_TRAIN}) WHERE dt = (SELECT lag_1 FROM lags)",
    "stl4q_avg": f"""SELECT min(dt) AS dt, 'STL4Q' AS fy_quarter, sales_div, {_AVERAGES}
        FROM ({_TRAIN}) WHERE dt IN (SELECT dt FROM lag_days) GROUP BY sales_div""",
}
_HISTORY = _features("true")


def _sql(body: str, together: bool = False) -> str:
    mapped = "map_together" if together else "map_separated"
    return f"WITH {_SOURCES},\ndivision_map AS (SELECT * FROM {mapped}),{_STEPS}\n{body}"


def _rows_and_amount(source: str, keys: dict[str, str], amount: str = "amount", where: str = "true") -> str:
    columns = ", ".join(f"{expression} AS {name}" for name, expression in keys.items())
    return f"""SELECT {columns}, count(*) AS n_rows, CAST(sum({amount}) AS DOUBLE) AS total_amount
        FROM {source} WHERE {where} GROUP BY ALL"""


def _as_doubles(relation: str, names: tuple[str, ...] | list[str]) -> str:
    replaced = ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in names)
    return f"SELECT * REPLACE ({replaced}) FROM {relation}"


def _by_day(where: str, *keys: str) -> str:
    return _rows_and_amount("opportunity_history", {key: key for key in ("dt", *keys)}, where=where)


def _bookings_where(where: str) -> str:
    return f"SELECT id, booking_date__c, CAST(amount__c AS DOUBLE) AS amount__c FROM bookings WHERE {where}"


_TOUCH_DAYS = f"dt - lastactivitydate < {CONFIG.touched_days}"
_TRAIN_FILLED = (
    f"SELECT coalesce(bookings_pct_finish, 0) AS y, coalesce(bookings_pct_qtd, 0) AS p FROM ({_TRAIN})"
)
_TEST_FILLED = "SELECT * REPLACE (" + ", ".join(
    f"coalesce({c}, 0) AS {c}" for c in ("pipe_coverage", "pct_pipe_remain_to_close", "direct_bookings", schemas.LABEL)
) + f") FROM ({_TEST})"
_HASHED = "('0x' || substr(md5(sales_div || '|' || dt), 1, 2))"
_HOLDOUT = f"SELECT * FROM ({_TRAIN}) WHERE CAST({_HASHED} AS INTEGER) < {HOLDOUT_BUCKETS}"
_TRAINING = f"SELECT * FROM ({_TRAIN}) WHERE CAST({_HASHED} AS INTEGER) >= {HOLDOUT_BUCKETS}"
_ASSEMBLED_KEYS = "dt, fy_quarter, day_of_qtr, sales_div"
_DIVISIONS = "(SELECT DISTINCT sales_div FROM goal)"


def _correlations() -> str:
    columns = schemas.MEASURE_COLUMNS
    pairs = ", ".join(
        f"struct_pack(col_a := '{a}', col_b := '{b}', r := round(corr({a}, {b}), 6))" for a in columns for b in columns
    )
    return f"SELECT pair.* FROM (SELECT unnest([{pairs}]) AS pair FROM ({_TRAIN}))"


def _view_counts() -> str:
    from pipecast.plans.slices import view_name

    parts = []
    for together in (False, True):
        for name, body in _SLICES.items():
            inner = _sql(body, together)
            parts.append(f"SELECT '{view_name(name, together)}' AS view_name, count(*) AS n_rows FROM ({inner})")
    return "\nUNION ALL\n".join(parts)


def _view_contents() -> str:
    from pipecast.plans.slices import view_name

    keys = ("dt", "fy_quarter", "sales_div")
    columns = ", ".join(c if c in keys else f"CAST({c} AS DOUBLE) AS {c}" for c in schemas.FEATURE_COLUMNS)
    return "\nUNION ALL\n".join(
        f"SELECT '{view_name(name, together)}' AS view_name, {columns} FROM ({_sql(body, together)})"
        for together in (False, True)
        for name, body in _SLICES.items()
    )


# --- least squares, solved by elimination --------------------------------------------------------

# Divisions of the training rows in the order their columns have.
_LEVELS = ("AFRICA", "AMERICA", "ASIA", "EUROPE")
_FIT_COLUMNS = [
    *(f"coalesce({c}, 0)" for c in schemas.MODEL_FEATURES),
    *(f"CASE WHEN sales_div = '{level}' THEN 1 ELSE 0 END" for level in _LEVELS),
]
_VECTOR = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in _FIT_COLUMNS) + "]"
_SIZE = len(_FIT_COLUMNS)
_PIVOT = "m[k + 1][k + 1]"
# Gauss-Jordan elimination of the scaled products; a column without a pivot depends on earlier ones.
_LEAST_SQUARES = f"""WITH RECURSIVE fit_rows AS MATERIALIZED (
    SELECT list_append({_VECTOR}, coalesce({schemas.LABEL}, 0)) AS x FROM ({_TRAINING})
),
products AS (
    SELECT i, j, sum(x[i] * x[j]) AS v FROM fit_rows, range(1, {_SIZE + 2}) a(i), range(1, {_SIZE + 2}) b(j) GROUP BY i, j
),
sizes AS (SELECT i, sqrt(v) AS size FROM products WHERE i = j),
matrix AS (
    SELECT list(r ORDER BY i) AS m FROM (
        SELECT p.i, list(v / (a.size * b.size) ORDER BY p.j) AS r
        FROM products p JOIN sizes a ON a.i = p.i JOIN sizes b ON b.i = p.j GROUP BY p.i)
),
eliminated(k, m) AS (
    SELECT 0, m FROM matrix
    UNION ALL
    SELECT k + 1, [[CASE WHEN {_PIVOT} <= 1e-10 THEN CASE WHEN i = k + 1 OR j = k + 1 THEN 0 ELSE m[i][j] END
                         WHEN i = k + 1 THEN m[i][j] / {_PIVOT}
                         ELSE m[i][j] - m[i][k + 1] * m[k + 1][j] / {_PIVOT} END
                    FOR j IN range(1, {_SIZE + 2})] FOR i IN range(1, {_SIZE + 2})]
    FROM eliminated WHERE k < {_SIZE}
),
fitted AS (
    SELECT m, (SELECT list(size ORDER BY i) FROM sizes) AS s FROM eliminated WHERE k = {_SIZE}
),
weights AS (
    SELECT [m[i][{_SIZE + 1}] * s[{_SIZE + 1}] / s[i] FOR i IN range(1, {_SIZE + 1})] AS b FROM fitted
)
"""


def _filled(rows: str) -> str:
    gaps = [c for c in schemas.FEATURE_COLUMNS if c not in schemas.KEY_COLUMNS]
    return "SELECT * REPLACE (" + ", ".join(f"coalesce({c}, 0) AS {c}" for c in gaps) + f") FROM ({rows})"


def _predicted(rows: str, columns: str = "*", digits: int | None = 4) -> str:
    value = f"list_sum([b[i] * {_VECTOR}[i] FOR i IN range(1, {_SIZE + 1})])"
    value = value if digits is None else f"round({value}, {digits})"
    return f"SELECT {columns} FROM ({_LEAST_SQUARES} SELECT r.*, {value} AS prediction FROM ({_filled(rows)}) r, weights)"


_MISSED = f"{schemas.LABEL} - prediction"
_LINEAR_SCORES = f"""SELECT round(1 - sum(pow({_MISSED}, 2)) / (var_pop({schemas.LABEL}) * count(*)), 4) AS r2_score,
    round(avg(abs({_MISSED})), 4) AS avg_abs_var_finish,
    round(avg(abs(({_MISSED}) / nullif({schemas.LABEL}, 0))), 4) AS avg_abs_var_pct,
    count(*) FILTER (WHERE {schemas.LABEL} = 0) AS rows_without_pct, count(*) AS n_rows
    FROM ({_predicted(_HOLDOUT, digits=None)})"""


def _feature_labels() -> list[str]:
    return [*schemas.MODEL_FEATURES, *(f"sales_div_{level.lower()}" for level in _LEVELS)]


def _coefficients() -> str:
    names = "[" + ", ".join(f"'{name}'" for name in _feature_labels()) + "]"
    zeros = "SELECT 'sales_div_unseen', CAST(0 AS DOUBLE) UNION ALL SELECT 'intercept', CAST(0 AS DOUBLE)"
    found = f"{_LEAST_SQUARES} SELECT unnest({names}) AS feature, round(unnest(b), 3) + 0.0 AS coefficient FROM weights"
    return f"SELECT feature, coefficient FROM ({found}) UNION ALL {zeros}"


def _grid_points() -> str:
    from pipecast.plans.models import GRID_DEPTHS, GRID_LEAVES
    from pipecast.plans.tree_tables import GRID_SPLITS

    depths = ", ".join("NULL" if d is None else str(d) for d in GRID_DEPTHS)
    return f"""SELECT CAST(max_depth AS INTEGER) AS max_depth, min_split, min_leaf, true AS has_score, true AS split_size_fits
        FROM (SELECT unnest([{depths}]) AS max_depth), (SELECT unnest({list(GRID_SPLITS)}) AS min_split),
             (SELECT unnest({list(GRID_LEAVES)}) AS min_leaf)"""


def oracle_sql() -> dict[str, str]:
    plain = {
        "join_concat_predictions": _predicted(_HOLDOUT),
        "sink_csv_compare": _predicted(_HOLDOUT),
        "sink_csv_prediction": _predicted(_TEST, f"* EXCLUDE (direct_bookings, {schemas.LABEL})"),
        "ml_linear_regression": _LINEAR_SCORES,
        "ml_coefficients": _coefficients(),
        "ml_scale_lasso_optimal": "SELECT unnest(["
        + ", ".join(f"'{name}'" for name in [*_feature_labels(), "sales_div_unseen"])
        + "]) AS feature, true AS optimal",
        "ml_predict_walk": f"SELECT dt, sales_div, true AS same FROM ({_HOLDOUT})",
        "ml_gradient_boosting_walk": f"SELECT dt, sales_div, true AS same FROM ({_HOLDOUT})",
        "ml_grid_search_points": _grid_points(),
        "sink_csv_compare_rows": f"SELECT dt, sales_div, true AS has_prediction FROM ({_HOLDOUT})",
        "sink_csv_prediction_rows": f"SELECT dt, sales_div, true AS has_prediction FROM ({_TEST})",
        "join_concat_predictions_rows": f"SELECT dt, sales_div, day_of_qtr, true AS has_prediction FROM ({_HOLDOUT})",
        "model_load_same": f"SELECT dt, sales_div, true AS same FROM ({_HOLDOUT})",
        "ml_predict_range": f"SELECT dt, sales_div, true AS in_range FROM ({_HOLDOUT})",
        "ml_predict_current_quarter_rows": f"SELECT dt, sales_div, true AS has_prediction FROM ({_TEST})",
        "ml_linear_regression_rows": f"SELECT count(*) AS n_rows, true AS beats_mean FROM ({_HOLDOUT})",
        "ml_random_forest_rows": f"SELECT count(*) AS n_rows, true AS beats_mean FROM ({_HOLDOUT})",
        "ml_gradient_boosting_rows": f"SELECT count(*) AS n_rows, true AS beats_mean FROM ({_HOLDOUT})",
        "ml_train_score_rows": f"SELECT count(*) AS n_rows, true AS beats_mean FROM ({_TRAINING})",
        # The divisions' levels and one for unseen ones follow the numeric features.
        "ml_feature_importance_total": f"""SELECT count(DISTINCT sales_div) + {len(schemas.MODEL_FEATURES) + 1} AS n_features,
            CAST(1 AS DOUBLE) AS total, true AS none_negative FROM ({_TRAINING})""",
        "src_opportunity_history": """SELECT dt, count(*) AS n_rows,
            CAST(sum(TRY_CAST(id AS BIGINT)) AS BIGINT) AS sum_of_ids, """
        + ", ".join(f"count(*) FILTER (WHERE stagename = '{s}') AS n_stage_{k}" for k, s in enumerate(CONFIG.stages, 1))
        + """, CAST(sum(amount) AS DOUBLE) AS total_amount,
            count(currencyisocode) AS n_currency, CAST(sum(TRY_CAST(accountid AS BIGINT)) AS BIGINT) AS sum_of_accounts,
            count(lastactivitydate) AS n_activity, max(lastmodifieddate) AS last_modified,
            count(*) FILTER (WHERE isdeleted) AS n_deleted, count(*) FILTER (WHERE isclosed) AS n_closed,
            max(closedate) AS last_close, CAST(sum(length(owner_division__c)) AS BIGINT) AS owner_letters
            FROM opportunity_history GROUP BY dt""",
        "src_bookings": _as_doubles("bookings", ["amount__c"]),
        "src_quota": _as_doubles("quota", ["gross_quota__c"]),
        "src_quarter_mapping": "SELECT * FROM quarter_mapping",
        "src_calendar": "SELECT * FROM calendar",
        "src_division_map": """SELECT *, 'separated' AS variant FROM map_separated
            UNION ALL SELECT *, 'together' FROM map_together""",
        "src_currency": "SELECT * FROM currency",
        "src_account": "SELECT * FROM account",
        "src_csv_training": _TRAIN,
        "src_csv_current": _TEST,
        "src_read_view": _TEST,
        "proj_amount_usd": _by_day("true", "currencyisocode"),
        "proj_default_currency": _rows_and_amount(
            "opportunity_history", {"dt": "dt", "currency": "coalesce(currencyisocode, 'USD')"}
        ),
        "proj_undefined_division": _rows_and_amount(
            "bookings LEFT JOIN division_map ON sales_div_dirty = owner_division__c",
            {"sales_div": "coalesce(sales_div_clean, 'UnDefined')"},
            amount="amount__c",
        ),
        "proj_day_of_qtr": "SELECT * FROM spine",
        "proj_qtr_pct": """SELECT dt, fy_quarter, CAST(day_of_qtr AS DOUBLE)
            / CASE WHEN fy_quarter LIKE '%Q1' THEN 89 ELSE 92 END AS qtr_pct FROM spine""",
        "proj_feature_ratios": f"SELECT dt, sales_div, {', '.join(schemas.RATIO_COLUMNS)} FROM ({_HISTORY})",
        "proj_drop_columns": f"""SELECT sales_div, {', '.join(schemas.MODEL_FEATURES)}, {schemas.LABEL}
            FROM ({_TRAIN})""",
        "proj_select_label": f"SELECT {schemas.LABEL} FROM ({_TRAIN})",
        "proj_normalise_headers": f"""SELECT dt AS snapshot_day, sales_div, stage_1_amount AS stage_1_amount
            FROM ({_TRAIN})""",
        "flt_touched_120d": _by_day(_TOUCHED),
        "flt_touched_nonzero": _by_day(f"({_TOUCH_DAYS} OR dt <> lastmodifieddate)"),
        "flt_open_opps": _by_day("NOT isdeleted AND NOT isclosed AND amount > 0"),
        "flt_closing_in_qtr": _rows_and_amount(
            "opportunity_history JOIN quarter_mapping ON dt BETWEEN qtr_start AND qtr_end",
            {"dt": "dt", "fy_quarter": "fy_quarter"},
            where="closedate BETWEEN qtr_start AND qtr_end",
        ),
        "flt_exclude_ids": _by_day(f"id <> '{OPPORTUNITY_ID}'"),
        "flt_qualified_booking": _bookings_where(
            f"""(order_type__c IN ('New', 'New Order') AND amount__c >= {CONFIG.min_order_amount})
                OR (order_type__c = 'Upsell' AND amount__c >= 0)
                OR (order_type__c IN ('New', 'New Order') AND amount__c < {CONFIG.min_order_amount}
                    AND length(coupon__c) > 0)
                OR bookingexception__c = 'Y'"""
        ),
        "flt_not_integration": _bookings_where("lower(owner_name) NOT LIKE '%integration%'"),
        "flt_has_account": _bookings_where("account__c <> ''"),
        "flt_segment_quota": _as_doubles("quota", ["gross_quota__c"])
        + " WHERE quota_owner_type__c = 'Segment' AND gross_quota__c > 0",
        "flt_min_date": f"SELECT * FROM spine WHERE dt >= {MIN_DT}",
        "flt_excluded_divisions": _as_doubles("finish", ["direct_bookings"])
        + f" WHERE sales_div NOT IN ({EXCLUDED})",
        "flt_quota_nonzero": _as_doubles("goal", ["quota"]) + " WHERE quota <> 0",
        "flt_before_current_qtr": "SELECT * FROM spine WHERE dt < (SELECT qtr_start FROM running)",
        "flt_in_current_qtr": "SELECT * FROM spine WHERE dt >= (SELECT qtr_start FROM running)",
        "flt_until_last_booking": "SELECT * FROM spine WHERE dt <= (SELECT day FROM latest)",
        "flt_current_day": "SELECT * FROM spine WHERE dt = (SELECT day FROM latest)",
        "flt_fillna_zero": _TEST_FILLED,
        "join_quarter_range": _rows_and_amount(
            "bookings LEFT JOIN quarter_mapping ON booking_date__c BETWEEN qtr_start AND qtr_end",
            {"booking_date__c": "booking_date__c", "fy_quarter": "fy_quarter", "qtr_start": "qtr_start"},
            amount="amount__c",
        ),
        "join_calendar_spine": "SELECT * FROM spine",
        "join_quota_quarter": """SELECT email__c, quota_owner_type__c, fy_quarter,
            CAST(gross_quota__c AS DOUBLE) AS gross_quota__c
            FROM quota LEFT JOIN quarter_mapping ON qtr_start = start_date__c""",
        "join_currency": _rows_and_amount(
            "opportunity_history LEFT JOIN currency ON alphabeticcode = coalesce(currencyisocode, 'USD')",
            {"dt": "dt", "alphabeticcode": "alphabeticcode", "rate": "rate"},
        ),
        "join_account": """SELECT dt, count(*) AS n_rows, count(account.id) AS n_known_accounts
            FROM opportunity_history LEFT JOIN account ON account.id = accountid GROUP BY dt""",
        "join_feature_assembly": f"""SELECT {_ASSEMBLED_KEYS}, CAST(quota AS DOUBLE) AS quota,
            CAST(stage_1_amount AS DOUBLE) AS stage_1_amount,
            CAST(stage_5_amount_all AS DOUBLE) AS stage_5_amount_all,
            CAST(bookings_qtd AS DOUBLE) AS bookings_qtd,
            CAST(direct_bookings AS DOUBLE) AS direct_bookings FROM assembled""",
        "join_prior_day_pipe": "SELECT e.dt, e.fy_quarter, day_of_qtr, sales_div, "
        + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in schemas.STAGE_AMOUNTS)
        + " FROM spine e JOIN touched_pipe p ON p.dt + 1 = e.dt AND p.fy_quarter = e.fy_quarter",
        "join_semi_in_subquery": f"SELECT * FROM ({_HISTORY}) WHERE dt IN (SELECT dt FROM lag_days)",
        "agg_stage_pipe": _as_doubles(
            f"(SELECT * EXCLUDE ({', '.join(schemas.LARGE_DEALS)}) FROM touched_pipe)", schemas.STAGE_AMOUNTS
        ),
        "agg_large_deals": _as_doubles(
            f"(SELECT dt, fy_quarter, sales_div, {', '.join(schemas.LARGE_DEALS)} FROM touched_pipe)",
            schemas.LARGE_DEALS,
        ),
        "agg_stage_pipe_all": _as_doubles("open_pipe", schemas.STAGE_AMOUNTS_ALL),
        "agg_daily_bookings": _as_doubles("daily", ["bookings"]),
        "agg_quarter_bookings": _as_doubles("finish", ["direct_bookings"]),
        "agg_quota": _as_doubles("goal", ["quota"]),
        "agg_max_booking_date": "SELECT day AS dt FROM latest",
        "agg_stl4q_average": f"""SELECT min(dt) AS dt, 'STL4Q' AS fy_quarter, sales_div, {_AVERAGES}
            FROM ({_HISTORY}) GROUP BY sales_div""",
        "agg_corr_matrix": _correlations(),
        "win_bookings_qtd": _as_doubles("qtd", ["bookings_qtd"]),
        "win_qtd_fill": """SELECT dt, fy_quarter, sales_div, CAST(coalesce(bookings_qtd, max(bookings_qtd) OVER (
            PARTITION BY fy_quarter, sales_div ORDER BY dt ROWS BETWEEN 30 PRECEDING AND CURRENT ROW), 0)
            AS DOUBLE) AS bookings_qtd FROM assembled""",
        "win_lag_same_day": "SELECT dt, lag_1 FROM lags",
        "win_lag_1_to_4": "SELECT * FROM lags",
        "sort_output": f"""SELECT sales_div, dt,
            CAST(row_number() OVER (ORDER BY sales_div, dt, fy_quarter, day_of_qtr) AS INTEGER) AS place
            FROM ({_TRAIN})""",
        "setop_union_distinct": "SELECT * FROM lag_days WHERE dt IS NOT NULL",
        "sub_scalar": """SELECT (SELECT count(*) FROM bookings) AS n_bookings,
            (SELECT qtr_start FROM running) AS quarter_start, day AS latest_booking, lag_1, lag_2, lag_3, lag_4
            FROM latest JOIN lags ON dt = day""",
        "sub_cte": """SELECT fy_quarter, max(n) AS busiest_day, CAST(sum(n) AS BIGINT) AS n_bookings
            FROM (SELECT booking_date__c, count(*) AS n FROM bookings GROUP BY 1)
            JOIN quarter_mapping ON booking_date__c BETWEEN qtr_start AND qtr_end GROUP BY fy_quarter""",
        "fn_case_when": _rows_and_amount(
            "opportunity_history",
            {"dt": "dt", "phase": "CASE WHEN stagename IN ('4. POC', '5. Contract') THEN 'late' ELSE 'early' END"},
        ),
        "fn_null_tests": """SELECT booking_date__c, count(*) FILTER (WHERE coupon__c IS NULL) AS n_no_coupon,
            count(coupon__c) AS n_coupon FROM bookings GROUP BY 1""",
        "fn_lower_like": """SELECT lower(owner_name) AS owner,
            count(*) FILTER (WHERE lower(owner_name) LIKE '%integration%') AS n_integration,
            count(*) FILTER (WHERE lower(owner_name) NOT LIKE '%integration%') AS n_people
            FROM bookings GROUP BY 1""",
        "fn_in_between": f"""SELECT booking_date__c,
            count(*) FILTER (WHERE order_type__c IN ('New', 'New Order')) AS n_new,
            count(*) FILTER (WHERE order_type__c NOT IN ('New', 'New Order')) AS n_other,
            count(*) FILTER (WHERE amount__c BETWEEN 0 AND {CONFIG.min_order_amount}) AS n_small
            FROM bookings GROUP BY 1""",
        "fn_date_diff_add": """SELECT dt + 1 AS next_day, CAST(min(closedate - dt) AS INTEGER) AS least_days_to_close,
            CAST(max(closedate - dt) AS INTEGER) AS most_days_to_close FROM opportunity_history GROUP BY 1""",
        "fn_cast": """SELECT start_date__c AS start_date, email__c, quota_owner_type__c,
            CAST(gross_quota__c AS DOUBLE) AS gross_quota__c, CAST(day_of_qtr AS DOUBLE) AS day_number
            FROM quota JOIN spine ON spine.dt = start_date__c""",
        "fn_to_char_mmdd": _rows_and_amount(
            "bookings", {"month_day": "strftime(booking_date__c, '%m-%d')"}, amount="amount__c"
        ),
        "fn_arith": f"""SELECT dt, sales_div, stage_4_amount + stage_5_amount AS late, quota - bookings_qtd AS gap,
            (stage_4_amount + stage_5_amount) / nullif(quota - bookings_qtd, 0) AS cover FROM ({_HISTORY})""",
        "fn_current_date": f"""SELECT CAST({AS_OF} - booking_date__c AS INTEGER) AS days_ago, count(*) AS n_rows
            FROM bookings GROUP BY 1""",
        "fn_str_clean": f"SELECT dt, sales_div, quota AS quota_usd FROM ({_HISTORY})",
        "fn_abs_mean": f"""SELECT sales_div, round(avg(abs(bookings_pct_finish - bookings_pct_qtd)), 6) AS mean_gap
            FROM ({_HISTORY}) GROUP BY 1""",
        "fn_date_and_text": """SELECT dt, dt + 1 AS next_day, CAST(dt - qtr_start AS INTEGER) AS days_into_quarter,
            strftime(dt, '%m-%d') AS month_day, lower(fy_quarter) AS quarter_key
            FROM calendar JOIN quarter_mapping ON dt BETWEEN qtr_start AND qtr_end""",
        "ml_split": f"SELECT dt, sales_div, CAST({_HASHED} AS INTEGER) < 51 AS is_test FROM ({_TRAIN})",
        "ml_one_hot": "SELECT dt, qtr_pct, "
        + ", ".join(
            f"CAST(sales_div = '{d.upper()}' AS INTEGER) AS sales_div_{d}"
            for d in ("africa", "america", "asia", "europe")
        )
        + f" FROM ({_TRAIN})",
        "ml_assemble": "SELECT dt, sales_div AS division, "
        + ", ".join(f"coalesce({c}, 0) AS {c}" for c in schemas.MODEL_FEATURES)
        + ", "
        + ", ".join(
            f"CAST(sales_div = '{d.upper()}' AS DOUBLE) AS sales_div_{d}"
            for d in ("africa", "america", "asia", "europe")
        )
        + f", CAST(0 AS DOUBLE) AS sales_div_unseen FROM ({_TRAIN})",
        "metric_r2": f"""SELECT round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2_score
            FROM ({_TRAIN_FILLED})""",
        "metric_avg_abs_var_finish": f"""SELECT round(avg(abs(y - p)), 6) AS avg_abs_var_finish
            FROM ({_TRAIN_FILLED})""",
        "metric_avg_abs_var_pct": f"""SELECT round(avg(abs((y - p) / nullif(y, 0))), 6) AS avg_abs_var_pct,
            count(*) FILTER (WHERE y = 0) AS rows_without_pct, count(*) AS n_rows FROM ({_TRAIN_FILLED})""",
    }
    oracles = {name: _sql(body) for name, body in plain.items()}
    oracles["join_division_map"] = _sql(
        _rows_and_amount(
            "opportunity_history LEFT JOIN division_map ON sales_div_dirty = owner_division__c",
            {"owner_division__c": "owner_division__c", "sales_div_clean": "sales_div_clean"},
        ),
        together=True,
    )
    oracles["view_test_backdated"] = _sql(_SLICES["test"]).replace(AS_OF, f"DATE '{BACK_DATED.as_of}'")
    # The ratios are those of every day, as they were before rows ended at the run's day.
    oracles["proj_feature_ratios"] = oracles["proj_feature_ratios"].replace(_KNOWN_DAYS, "")
    oracles["sink_named_view"] = _view_counts()
    oracles["sink_named_view_contents"] = _view_contents()
    for name, body in _SLICES.items():
        oracles[f"view_{name}"] = _sql(body)
        oracles[f"view_{name}_together"] = _sql(body, together=True)
    return oracles

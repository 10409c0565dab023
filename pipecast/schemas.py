"""Schemas of the source tables and of the 36-column feature table.

Sources are read with these schemas instead of inferring them: inference costs a
pass over the data and lets one odd file change a column's type.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


OPPORTUNITY_HISTORY = _struct(
    id=T.StringType(),
    dt=T.DateType(),
    stagename=T.StringType(),
    amount=MONEY,
    currencyisocode=T.StringType(),
    accountid=T.StringType(),
    lastactivitydate=T.TimestampType(),
    lastmodifieddate=T.TimestampType(),
    isdeleted=T.BooleanType(),
    isclosed=T.BooleanType(),
    closedate=T.DateType(),
    owner_division__c=T.StringType(),
)

BOOKINGS = _struct(
    id=T.StringType(),
    booking_date__c=T.DateType(),
    amount__c=MONEY,
    owner_division__c=T.StringType(),
    order_type__c=T.StringType(),
    coupon__c=T.StringType(),
    bookingexception__c=T.StringType(),
    owner_name=T.StringType(),
    account__c=T.StringType(),
    isdeleted=T.BooleanType(),
)

QUOTA = _struct(
    start_date__c=T.TimestampType(),
    email__c=T.StringType(),
    gross_quota__c=MONEY,
    quota_owner_type__c=T.StringType(),
)

QUARTER_MAPPING = _struct(fy_quarter=T.StringType(), qtr_start=T.DateType(), qtr_end=T.DateType())
CALENDAR = _struct(dt=T.DateType(), day_of_fiscal_quarter=T.IntegerType())
DIVISION_MAP = _struct(sales_div_dirty=T.StringType(), sales_div_clean=T.StringType())
CURRENCY = _struct(alphabeticcode=T.StringType(), rate=T.DoubleType())
ACCOUNT = _struct(id=T.StringType())

SOURCE_SCHEMAS = {
    "opportunity_history": OPPORTUNITY_HISTORY,
    "bookings": BOOKINGS,
    "quota": QUOTA,
    "quarter_mapping": QUARTER_MAPPING,
    "calendar": CALENDAR,
    "division_map": DIVISION_MAP,
    "currency": CURRENCY,
    "account": ACCOUNT,
}

KEY_COLUMNS = ("dt", "fy_quarter", "day_of_qtr", "sales_div")
STAGE_COUNTS = tuple(f"stage_{k}_count" for k in range(1, 6))
STAGE_AMOUNTS = tuple(f"stage_{k}_amount" for k in range(1, 6))
STAGE_AMOUNTS_ALL = tuple(f"stage_{k}_amount_all" for k in range(1, 6))
LARGE_DEALS = ("stage345_large_deals", "stage45_large_deals", "stage5_large_deals")

# The published order of the feature columns after quota and stages.
RATIO_COLUMNS = (
    "s1_quota_ratio",
    "s2_quota_ratio",
    "s3_quota_ratio",
    "s4_quota_ratio",
    "s5_quota_ratio",
    "s45_quota_ratio",
    "s12345_bk_qtd_quota_ratio",
    "s2345_bk_qtd_quota_ratio",
    "s345_bk_qtd_quota_ratio",
    "s45_bk_qtd_quota_ratio",
    "s5_bk_qtd_quota_ratio",
    "s345_lg_deal_quota_ratio",
    "s45_lg_deal_quota_ratio",
    "s5_lg_deal_quota_ratio",
    "pipe_coverage",
    "pct_pipe_remain_to_close",
    "bookings_pct_qtd",
    "bookings_pct_finish",
)

LABEL = "bookings_pct_finish"

STAGE_COLUMNS = tuple(name for pair in zip(STAGE_COUNTS, STAGE_AMOUNTS) for name in pair)
FEATURE_COLUMNS = (
    KEY_COLUMNS + ("quota",) + STAGE_COLUMNS + ("bookings_qtd", "direct_bookings", "qtr_pct") + RATIO_COLUMNS
)

MONEY_COLUMNS = ("quota", *STAGE_AMOUNTS, "bookings_qtd", "direct_bookings")

# Everything numeric: what the four-quarter mean and the correlation matrix run over.
MEASURE_COLUMNS = tuple(c for c in FEATURE_COLUMNS if c not in ("dt", "fy_quarter", "sales_div"))

# Columns kept out of the model: keys, raw amounts, and the answer itself.
DROPPED_FOR_MODEL = (
    ("dt", "fy_quarter", "day_of_qtr", "quota")
    + STAGE_COLUMNS
    + ("bookings_qtd", "direct_bookings")
    + tuple(f"s{k}_quota_ratio" for k in range(1, 6))
)
MODEL_FEATURES = tuple(
    c for c in FEATURE_COLUMNS if c not in DROPPED_FOR_MODEL and c not in ("sales_div", LABEL)
)


def _feature_type(name: str) -> T.DataType:
    if name == "dt":
        return T.DateType()
    if name in ("fy_quarter", "sales_div"):
        return T.StringType()
    if name == "day_of_qtr":
        return T.IntegerType()
    return T.LongType() if name in STAGE_COUNTS else T.DoubleType()


FEATURES = _struct(**{name: _feature_type(name) for name in FEATURE_COLUMNS})

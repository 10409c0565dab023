"""Row filters of the forecast, as boolean columns.

All of them follow SQL's three-valued logic: a NULL operand gives NULL, and
``filter`` then drops the row. None is wrapped in ``coalesce`` for that reason.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pipecast.config import (
    INTEGRATION_OWNER,
    NEW_ORDER_TYPES,
    SEGMENT_OWNER_TYPE,
    UPSELL_ORDER_TYPE,
    ForecastConfig,
)


def touched_recently(cfg: ForecastConfig) -> Column:
    """The opportunity saw activity or an edit within ``touched_days`` of its snapshot."""
    since_activity = F.datediff("dt", F.to_date("lastactivitydate"))
    since_edit = F.datediff("dt", F.to_date("lastmodifieddate"))
    edited = since_edit < cfg.touched_days if cfg.touched_mode == "intent" else since_edit != 0
    return (since_activity < cfg.touched_days) | edited


def open_opportunity() -> Column:
    live = (F.col("isdeleted") == F.lit(False)) & (F.col("isclosed") == F.lit(False))
    return live & (F.col("amount") > 0)


def closing_in_quarter() -> Column:
    """Expected to close in the fiscal quarter of its own snapshot."""
    return F.col("closedate").between(F.col("qtr_start"), F.col("qtr_end"))


def not_excluded(column: str, ids: tuple[str, ...]) -> Column:
    return ~F.col(column).isin(*ids) if ids else F.col(column).isNotNull()


def qualified_booking(cfg: ForecastConfig) -> Column:
    """Large enough or couponed new order, any non-negative upsell, or a flagged exception."""
    amount, kind, coupon = F.col("amount__c"), F.col("order_type__c"), F.col("coupon__c")
    is_new = kind.isin(*NEW_ORDER_TYPES)
    couponed = (amount < cfg.min_order_amount) & (coupon != "") & coupon.isNotNull()
    return (
        (is_new & (amount >= cfg.min_order_amount))
        | ((kind == UPSELL_ORDER_TYPE) & (amount >= 0))
        | (is_new & couponed)
        | (F.col("bookingexception__c") == "Y")
    )


def not_integration_owner() -> Column:
    return ~F.lower("owner_name").like(INTEGRATION_OWNER)


def has_account() -> Column:
    return (F.col("account__c") != "") & F.col("account__c").isNotNull()


def counted_booking(cfg: ForecastConfig) -> Column:
    """Every condition a booking must meet to enter the totals."""
    return (
        (F.col("isdeleted") == F.lit(False))
        & qualified_booking(cfg)
        & not_integration_owner()
        & has_account()
        & not_excluded("id", cfg.excluded_booking_ids)
    )


def known_by(cfg: ForecastConfig, day: str) -> Column:
    """Whether a run pinned to ``as_of`` can know of ``day``; an unpinned run knows everything it reads."""
    return F.lit(True) if cfg.as_of is None else F.col(day) <= F.lit(cfg.as_of)


def segment_quota() -> Column:
    return (F.col("quota_owner_type__c") == SEGMENT_OWNER_TYPE) & (F.col("gross_quota__c") > 0)


def forecast_division(cfg: ForecastConfig) -> Column:
    return ~F.col("sales_div").isin(*cfg.excluded_divisions)

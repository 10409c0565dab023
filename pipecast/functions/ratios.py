"""The quota-relative measures of a feature row."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(*names: str) -> Column:
    return reduce(add, (F.col(name) for name in names))


def _from_stage(first: int) -> list[str]:
    return [f"stage_{k}_amount" for k in range(first, 6)]


def feature_ratios() -> dict[str, Column]:
    """Name to expression, in output order.

    Inputs are doubles: ``quota``, the stage and large-deal sums, ``open_amount``
    (all open pipeline, touched or not), ``bookings_qtd`` and ``direct_bookings``.
    ``try_divide`` turns a zero denominator (quota already met, or no open
    pipeline) into NULL instead of an error.
    """
    quota = F.col("quota")
    remaining = quota - F.col("bookings_qtd")
    over_quota: dict[str, Column] = {f"s{k}_quota_ratio": F.col(f"stage_{k}_amount") for k in range(1, 6)}
    over_quota["s45_quota_ratio"] = _total(*_from_stage(4))
    for first in range(1, 6):
        stages = "".join(str(k) for k in range(first, 6))
        over_quota[f"s{stages}_bk_qtd_quota_ratio"] = _total(*_from_stage(first), "bookings_qtd")
    for stages in ("345", "45", "5"):
        over_quota[f"s{stages}_lg_deal_quota_ratio"] = F.col(f"stage{stages}_large_deals")

    ratios = {name: F.try_divide(part, quota) for name, part in over_quota.items()}
    ratios["pipe_coverage"] = F.try_divide(F.col("open_amount"), remaining)
    ratios["pct_pipe_remain_to_close"] = F.try_divide(remaining, F.col("open_amount"))
    ratios["bookings_pct_qtd"] = F.try_divide(F.col("bookings_qtd"), quota)
    ratios["bookings_pct_finish"] = F.try_divide(F.col("direct_bookings"), quota)
    return ratios

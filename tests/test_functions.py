from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pipecast import schemas
from pipecast.config import ForecastConfig
from pipecast.functions import fiscal, labels, predicates

CFG = ForecastConfig(as_of=date(2001, 6, 15), min_dt=date(1995, 8, 1))


def kept(df, condition, column="id"):
    return sorted(row[column] for row in df.where(condition).select(column).collect())


@pytest.mark.parametrize(
    ("day", "start", "label"),
    [
        (date(2001, 5, 1), date(2001, 5, 1), "FY02 Q2"),
        (date(2001, 7, 31), date(2001, 5, 1), "FY02 Q2"),
        (date(2001, 1, 31), date(2000, 11, 1), "FY01 Q4"),
        (date(2000, 2, 29), date(2000, 2, 1), "FY01 Q1"),
        (date(1999, 12, 31), date(1999, 11, 1), "FY00 Q4"),
    ],
)
def test_fiscal_quarter(spark, day, start, label):
    found = spark.createDataFrame([(day,)], "d date").select(
        fiscal.quarter_start(F.col("d")), fiscal.quarter_label(fiscal.quarter_start(F.col("d")))
    )
    assert tuple(found.first()) == (start, label)


def test_quarter_share_exceeds_one_in_a_leap_first_quarter(spark):
    rows = [(90, "FY01 Q1"), (89, "FY02 Q1"), (46, "FY02 Q2")]
    df = spark.createDataFrame(rows, "n int, q string").select(fiscal.quarter_elapsed(F.col("n"), F.col("q")))
    assert [r[0] for r in df.collect()] == [90 / 89, 1.0, 0.5]


def test_headers():
    assert labels.clean_header(" Stage 1 (USD) ") == "stage_1_usd"


OPPORTUNITY = "id string, dt date, lastactivitydate timestamp, lastmodifieddate timestamp"


def test_touched_rule_with_missing_dates(spark):
    day, recent, old = date(2001, 6, 15), datetime(2001, 6, 1), datetime(2000, 6, 1)
    df = spark.createDataFrame(
        [
            ("recent activity, no edit", day, recent, None),
            ("no activity, recent edit", day, None, recent),
            ("both old", day, old, old),
            ("old activity, no edit", day, old, None),
            ("nothing known", day, None, None),
            ("119 days", day, datetime(2001, 2, 16), None),
            ("120 days", day, datetime(2001, 2, 15), None),
            ("edited today", day, old, datetime(2001, 6, 15)),
        ],
        OPPORTUNITY,
    )
    assert kept(df, predicates.touched_recently(CFG)) == [
        "119 days",
        "edited today",
        "no activity, recent edit",
        "recent activity, no edit",
    ]
    nonzero = ForecastConfig(touched_mode="nonzero")
    assert "edited today" not in kept(df, predicates.touched_recently(nonzero))
    assert "both old" in kept(df, predicates.touched_recently(nonzero))


BOOKING = [
    # id, amount, type, coupon, exception, owner, account, deleted
    ("new at 18", 18, "New", None, "N", "ann", "1", False),
    ("new below 18", 17, "New", None, "N", "ann", "1", False),
    ("new below 18, blank coupon", 17, "New Order", "", "N", "ann", "1", False),
    ("new below 18, coupon", 17, "New Order", "C10", "N", "ann", "1", False),
    ("free upsell", 0, "Upsell", None, "N", "ann", "1", False),
    ("negative upsell", -1, "Upsell", None, "N", "ann", "1", False),
    ("excepted renewal", -5, "Renewal", None, "Y", "ann", "1", False),
    ("plain renewal", 50, "Renewal", None, "N", "ann", "1", False),
    ("unknown exception", 50, "Renewal", None, None, "ann", "1", False),
    ("no owner", 50, "New", None, "N", None, "1", False),
    ("integration", 50, "New", None, "N", "The INTEGRATION user", "1", False),
    ("blank account", 50, "New", None, "N", "ann", "", False),
    ("no account", 50, "New", None, "N", "ann", None, False),
    ("deleted", 50, "New", None, "N", "ann", "1", True),
    ("unknown deleted", 50, "New", None, "N", "ann", "1", None),
]


def booking_frame(spark):
    rows = [
        (i, date(2001, 6, 1), Decimal(a), "N", t, c, x, o, acc, d) for i, a, t, c, x, o, acc, d in BOOKING
    ]
    return spark.createDataFrame(rows, schemas.BOOKINGS)


def test_counted_bookings(spark):
    assert kept(booking_frame(spark), predicates.counted_booking(CFG)) == [
        "excepted renewal",
        "free upsell",
        "new at 18",
        "new below 18, coupon",
    ]


def test_excluded_and_missing_ids(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    assert kept(df, predicates.not_excluded("id", ("b",))) == ["a"]


def test_config_is_checked():
    with pytest.raises(ValueError):
        ForecastConfig(touched_mode="other")

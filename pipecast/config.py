"""Parameters of one forecast run."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# The published defaults of the forecast definition.
STAGES = ("1. Qualification", "2. Discovery", "3. Solution", "4. POC", "5. Contract")
EXCLUDED_DIVISIONS = ("Channel", "ISV", "Online Team", "UnDefined", "API", "Network Alliance")
EXCLUDED_OPPORTUNITY_IDS = ("0060W00000y3J2PQAU",)
EXCLUDED_BOOKING_IDS = ("a1j0W000008kbLlQAI",)
UNDEFINED_DIVISION = "UnDefined"
DEFAULT_CURRENCY = "USD"
NEW_ORDER_TYPES = ("New", "New Order")
UPSELL_ORDER_TYPE = "Upsell"
SEGMENT_OWNER_TYPE = "Segment"
INTEGRATION_OWNER = "%integration%"
Q1_DAYS = 89
OTHER_QUARTER_DAYS = 92


@dataclass(frozen=True)
class ForecastConfig:
    """What a run counts and which day it is run on.

    ``as_of`` stands for "today": it picks the running quarter; snapshots and bookings after it
    are unknown, and no feature row is later. ``None`` means the session's current date and all
    rows read, so a scheduled run needs no argument while tests and back-dated runs pin it.

    ``touched_mode`` chooses how the "touched recently" rule reads the
    last-modified date. ``"intent"`` compares both dates with ``touched_days``;
    ``"nonzero"`` keeps any row whose last-modified date is another day than the
    snapshot, for parity with warehouses that coerce a number to a boolean.
    """

    as_of: date | None = None
    min_dt: date = date(2018, 8, 1)
    touched_days: int = 120
    touched_mode: str = "intent"
    large_deal: int = 10000
    min_order_amount: int = 18
    fill_rows: int = 30
    excluded_divisions: tuple[str, ...] = EXCLUDED_DIVISIONS
    excluded_opportunity_ids: tuple[str, ...] = EXCLUDED_OPPORTUNITY_IDS
    excluded_booking_ids: tuple[str, ...] = EXCLUDED_BOOKING_IDS
    stages: tuple[str, ...] = field(default=STAGES)

    def __post_init__(self) -> None:
        if self.touched_mode not in ("intent", "nonzero"):
            raise ValueError(f"touched_mode must be 'intent' or 'nonzero', not {self.touched_mode!r}")
        if len(self.stages) != 5:
            raise ValueError("exactly five sales stages are expected")

"""Business constants and the clock. Everything time-dependent takes a ``Terms``."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# Order states that count as using the credit.
ACTIVE_STATES = ("COMPLETED", "CREATED", "IN_DELIVERY")
# Both spellings of a cancelled order.
CANCELLED_STATES = ("CANCELED", "CANCELLED")
# Order states that no longer change.
FINAL_STATES = ("COMPLETED", "REJECTED", "CANCELLED", "NO_VISITED")
# Delinquency buckets from 30 / 60 / 90 days on.
PAR30 = ("DQ 30-59", "DQ 60-89", "DQ 90+")
PAR60 = ("DQ 60-89", "DQ 90+")
PAR90 = ("DQ 90+",)
# Display order of the buckets.
BUCKET_ORDER = (
    ("PaidPrev", 0), ("Paid", 1), ("Ongoing", 2), ("DQ 1-6", 3), ("DQ 7-14", 4),
    ("DQ 15-29", 5), ("DQ 30-59", 6), ("DQ 60-89", 7), ("DQ 90+", 8),
)
# Display order of the roll-rate stages and of the stages they lead to.
STAGE_ORDER = (
    ("Ongoing", 1), ("DQ 1-6", 2), ("DQ 7-14", 3), ("DQ 15-29", 4),
    ("DQ 30-59", 5), ("DQ 60-89", 6), ("DQ 90+", 7), ("Paid", 8),
)
LEAD_STAGE_ORDER = (
    ("DQ 1-6", 1), ("DQ 7-14", 2), ("DQ 15-29", 3), ("DQ 30-59", 4),
    ("DQ 60-89", 5), ("DQ 90+", 6), ("Paid", 7),
)
# Stage walk of a mature loan, (step, days past due from, stage when reached).
STAGE_STEPS = (
    (2, 1, "DQ 1-6"), (3, 7, "DQ 7-14"), (4, 15, "DQ 15-29"),
    (5, 30, "DQ 30-59"), (6, 60, "DQ 60-89"), (7, 90, "DQ 90+"),
)
# Rejection reasons that mean a keyword problem.
KEYWORD_REASONS = ("No tiene palabra clave", "Palabra clave incorrecta")
# Distance cut in metres per loan range.
DISTANCE_CUTS = (("1", 8.980613), ("2", 8.312551), ("3+", 7.240108))
# Thresholds of the order-count funnel.
FUNNEL_STEPS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 15, 20, 30)


@dataclass(frozen=True)
class Terms:
    """Product terms plus the local clock of the run."""

    as_of: dt.date = dt.date(2001, 8, 15)
    now: dt.datetime = dt.datetime(2001, 8, 15, 12, 0)
    credit_days: int = 15
    revenue_share: float = 0.142
    amount_commission: float = 0.04
    weekly_penalty: int = 200
    waiver_from: dt.date = dt.date(2024, 4, 22)
    inactive_days: int = 30
    cut_days: int = 8
    tax: float = 1.16
    mature_days: int = 115
    mutable_days: int = 60
    full_reload_days: int = 30
    stale_load_days: int = 90
    history_from: dt.date = dt.date(2021, 4, 1)
    new_amounts_from: int = 2025
    corrupt_month: dt.date = dt.date(2023, 12, 1)
    corrupt_divisor: float = 20.0
    contest_from: dt.date = dt.date(2026, 8, 18)
    contest_to: dt.date = dt.date(2026, 8, 30)
    min_order_amount: float = 10.0
    field_channel: str = "Fuerza de Ventas"

    def at(self, **changes) -> "Terms":
        return replace(self, **changes)


# The supplied tables end in 2001, so the dated rules move to that range.
SAMPLE = Terms().at(
    waiver_from=dt.date(1999, 4, 22),
    history_from=dt.date(1995, 4, 1),
    new_amounts_from=1999,
    corrupt_month=dt.date(1997, 12, 1),
    contest_from=dt.date(2001, 6, 18),
    contest_to=dt.date(2001, 6, 30),
)

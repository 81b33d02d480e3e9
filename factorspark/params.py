"""Run parameters shared by every stage."""

from __future__ import annotations

from dataclasses import dataclass

# Trailing windows in observations, and the calendar spans (days, inclusive) a
# row offset must cover to be usable.
MONTH_ROWS = 21
VOL_ROWS = 63
YEAR_ROWS = 252
MONTH_SPAN_DAYS = (26, 40)
YEAR_SPAN_DAYS = (340, 400)
WINSOR_LIMIT = 3.0
QUINTILES = 5
MONTHS_PER_YEAR = 12


@dataclass(frozen=True)
class Params:
    """``min_universe``: fewest valid names per date / factor-month. ``max_gap_days``: a daily
    return over a longer calendar gap is NULL. ``daily_buckets``: fewest buckets by ticker of the
    stored daily tables; large ones have a bucket per ``staging.TASK_ROWS`` rows. The number is stored
    with the tables, so readers need not know it."""

    schema: str = "core"
    min_universe: int = 30
    max_gap_days: int = 5
    daily_buckets: int = 64

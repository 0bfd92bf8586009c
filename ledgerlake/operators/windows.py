"""Cumulative look-back windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.calendar import month_end, months_before
from ledgerlake.functions.features import flag

# Look-back of the five windows.
WINDOW_MONTHS = (1, 3, 6, 9, 12)


def window_flag(months: int) -> str:
    return f"flg_u{months}m"


def recency_windows(
    stage: DataFrame,
    as_of: date,
    months: Sequence[int] = WINDOW_MONTHS,
    day: str = "date",
    *,
    include_future: bool = True,
) -> DataFrame:
    """Add one 0/1 flag per window: is the date at most that many months before the month end?

    For a month end, "months between the two is at most k" is the same as "not
    before the day k months earlier", a comparison with a constant. A NULL date
    is in no window; a date after the month end is in every one, or in none with
    `include_future=False`.
    """
    end = month_end(as_of)
    until_end = F.lit(True) if include_future else F.col(day) <= F.lit(end)
    return stage.withColumns(
        {
            window_flag(k): flag((F.col(day) >= F.lit(months_before(end, k))) & until_end)
            for k in months
        }
    )

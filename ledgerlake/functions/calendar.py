"""Reference month and window bounds, always derived from an explicit date."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_end(day: date) -> date:
    return day.replace(day=calendar.monthrange(day.year, day.month)[1])


def months_before(day: date, months: int) -> date:
    """Same day `months` earlier, clipped to the length of that month."""
    serial = day.year * 12 + (day.month - 1) - months
    year, month = serial // 12, serial % 12 + 1
    return date(year, month, min(day.day, calendar.monthrange(year, month)[1]))


@dataclass(frozen=True)
class ReferencePeriod:
    """The month a book describes and the twelve months it looks back on."""

    end: date
    start: date

    @classmethod
    def of(cls, as_of: date) -> "ReferencePeriod":
        end = month_end(as_of)
        return cls(end=end, start=months_before(end, 12))

    @property
    def ref(self) -> str:
        return f"{self.end:%Y%m}"

    @property
    def start_ref(self) -> str:
        return f"{self.start:%Y%m}"


def reference_period_columns(day: Column) -> list[Column]:
    """The same period for a whole column of dates."""
    end = F.last_day(day)
    start = F.add_months(end, -12)
    return [
        F.date_format(end, "yyyyMM").alias("ref"),
        F.date_format(start, "yyyyMM").alias("start_ref"),
        end.alias("month_end"),
    ]

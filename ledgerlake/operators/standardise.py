"""Raw to trusted."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import exact_rows
from ledgerlake.sources.subjects import SubjectSpec


def standardise(
    raw: DataFrame,
    spec: SubjectSpec,
    dt_proc: str,
    as_of: date | None = None,
    dedup: str = "business",
    distinct: Callable[[DataFrame], DataFrame] = DataFrame.distinct,
) -> DataFrame:
    """Drop exact duplicates, rename to the trusted names, add derived columns and the stamp.

    `dedup="business"` compares the business columns only, so a row that came in
    with several loads is kept once. `dedup="with_load"` compares the raw load
    stamp too and keeps one copy per load.
    """
    return exact_rows(raw, dedup, distinct=distinct).select(
        *spec.trusted_columns(as_of), F.lit(dt_proc).alias("dt_proc")
    )

"""Exact-duplicate removal, latest load per business key, new load stamp."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_rows(
    df: DataFrame,
    dedup: str = "business",
    version: str = "dt_proc",
    distinct: Callable[[DataFrame], DataFrame] = DataFrame.distinct,
) -> DataFrame:
    """Whole-row distinct. Equal rows are merged in each task before the shuffle.

    `distinct` may be `seen.distinct_rows`, for rows that are stored: it reads them first.
    """
    if dedup == "business":
        return distinct(df.drop(version))
    if dedup == "with_load":
        return distinct(df)
    raise ValueError(f"unknown dedup mode {dedup!r}")


# A stamp and its width share one bigint in `latest_version`, which leaves room for 17 digits.
MAX_STAMP_DIGITS = 17
_WIDTH = 32
FEW_KEYS = 100_000  # keys that are sent to every task


def _stamp(df: DataFrame, version: str) -> Column:
    """Load stamps as numbers where they are strings of digits.

    A maximum over a number is kept in a hash table; one over a string would
    make Spark sort all rows by key, before the shuffle and after it. A string
    that is anything else stops the query, whatever the ANSI setting.
    """
    stamp = F.col(version)
    if dict(df.dtypes)[version] != "string":
        return stamp
    no_digits_left = F.translate(stamp, "0123456789", "") == ""
    is_number = no_digits_left & F.length(stamp).between(1, MAX_STAMP_DIGITS)
    refused = F.raise_error(F.concat(F.lit("load stamp is not a string of digits: "), stamp))
    return F.when(stamp.isNull() | is_number, stamp.try_cast("bigint")).otherwise(
        refused.cast("bigint")
    )


def latest_version(df: DataFrame, keys: Sequence[str], version: str = "dt_proc") -> DataFrame:
    """One row per key with its newest load stamp in `newest_version`, as it was written.

    Of stamps that are the same number the one with more leading zeros counts as newer.
    """
    if dict(df.dtypes)[version] != "string":
        return df.groupBy(*keys).agg(F.max(version).alias("newest_version"))
    with_width = _stamp(df, version) * _WIDTH + F.length(version)
    newest = df.groupBy(*keys).agg(F.max(with_width).alias("_newest"))
    number = F.expr(f"CAST(_newest DIV {_WIDTH} AS STRING)")
    width = F.expr(f"CAST(_newest % {_WIDTH} AS INT)")
    return newest.select(*keys, F.lpad(number, width, F.lit("0")).alias("newest_version"))


def latest_load(
    df: DataFrame,
    keys: Sequence[str] | str,
    version: str = "dt_proc",
    *,
    null_keys: str = "drop",
    strategy: str = "join",
) -> DataFrame:
    """Every row that carries the newest version of its key; ties are all kept.

    `strategy="join"` reduces (key, version) to one row per key before its
    shuffle and keeps the matching rows with a semi join. A key that holds a
    large part of the table is cut into several tasks by the adaptive skew
    join, and a small set of keys is broadcast if its measured size allows it.
    `strategy="mixed"` is for rows that are stored. It looks first for keys that have more than one
    version; the other keys' rows stay in their tasks, and up to 100,000 keys are sent to
    every task. Beyond that it is the join.
    `strategy="rank"` needs one scan and one shuffle, but all newest rows of a
    key meet in one task: only for keys known to have few rows.

    The version is a number, a date, a timestamp or a string of up to 17 digits, which
    is compared as a number; another string is an error.

    Rows with a NULL key part are dropped, or with `null_keys="keep"` form a key
    of their own. Rows whose key has no version at all are dropped in any case.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if null_keys not in ("drop", "keep"):
        raise ValueError(f"unknown null_keys mode {null_keys!r}")

    if strategy == "rank":
        candidates = df.where(F.col(version).isNotNull())
        if null_keys == "drop":
            candidates = candidates.dropna("any", subset=keys)
        newest_first = Window.partitionBy(*keys).orderBy(_stamp(df, version).desc())
        return (
            candidates.withColumn("_rank", F.rank().over(newest_first))
            .where("_rank = 1")
            .drop("_rank")
        )
    if strategy not in ("join", "mixed"):
        raise ValueError(f"unknown strategy {strategy!r}")

    stamps = df.groupBy(*keys).agg(F.max(_stamp(df, version)).alias("_newest"), F.min(_stamp(df, version)).alias("_oldest"))
    newest = stamps.drop("_oldest").alias("newest")
    # The aggregate sees every row and refuses bad stamps; here a plain cast will do.
    is_text = dict(df.dtypes)[version] == "string"
    number = F.col(version).try_cast("bigint") if is_text else F.col(version)
    rows = df.withColumn("_stamp", number).alias("rows")
    same_key = [
        F.col(f"rows.{key}").eqNullSafe(F.col(f"newest.{key}"))
        if null_keys == "keep"
        else F.col(f"rows.{key}") == F.col(f"newest.{key}")
        for key in keys
    ]
    if strategy == "mixed":
        mixed = stamps.where("_newest <> _oldest").drop("_oldest")
        found = mixed.count()
        if found <= FEW_KEYS:
            rows = rows.where("_stamp IS NOT NULL")
            if null_keys == "drop":
                rows = rows.dropna("any", subset=keys)
            if found:
                is_older = F.col("rows._stamp") < F.col("newest._newest")
                older = F.broadcast(mixed).alias("newest")
                rows = rows.alias("rows").join(older, reduce(and_, [*same_key, is_older]), "left_anti")
            return rows.drop("_stamp")
    is_newest = F.col("rows._stamp") == F.col("newest._newest")
    return rows.join(newest, reduce(and_, [*same_key, is_newest]), "left_semi").drop("_stamp")


def restamp(df: DataFrame, dt_proc: str) -> DataFrame:
    """Replace the load stamp; it stays the last column."""
    return df.drop("dt_proc").withColumn("dt_proc", F.lit(dt_proc))

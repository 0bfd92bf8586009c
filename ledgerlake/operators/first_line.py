"""Exactly one marked line per invoice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def line_order(df: DataFrame, invoice: str, order_by: Sequence[str]) -> list[Column]:
    """`order_by` with NULLs last, then all other columns.

    With every column in the order only exact copies tie, and those are
    interchangeable: the choice is the same in every run and every retry.
    """
    rest = [name for name in df.columns if name != invoice and name not in order_by]
    return [F.col(name).asc_nulls_last() for name in [*order_by, *rest]]


def _per_invoice(df: DataFrame, invoice: str, order_by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(invoice).orderBy(*line_order(df, invoice, order_by))


def first_lines(df: DataFrame, invoice: str, order_by: Sequence[str]) -> DataFrame:
    """Only the first line of each invoice.

    Spark keeps one line per invoice in each task before the shuffle, so this
    is safe for an invoice of any size.
    """
    return (
        df.withColumn("_rn", F.row_number().over(_per_invoice(df, invoice, order_by)))
        .where("_rn = 1")
        .drop("_rn")
    )


def mark_first_lines(
    df: DataFrame, invoice: str, order_by: Sequence[str], marker: str
) -> DataFrame:
    """All lines, with 1 in `marker` on the first line of each invoice and NULL on the others.

    One plan for invoices of every size. The lines of an invoice are first numbered within
    the input partition they come from, so that a group is never larger than such a
    partition. The firsts of an invoice, one per input partition, then meet and the
    very first of them is marked; the other lines are shuffled in the groups they had. Lines
    pass unchanged: signed zeros, NaN and exact copies come out as they came in.

    The number of an input partition does not depend on the order of its rows, so a task that
    is computed again puts every line into the same group.
    """
    order = line_order(df, invoice, order_by)
    per_part = Window.partitionBy(invoice, "_part").orderBy(*order)
    numbered = df.withColumn("_part", F.spark_partition_id()).withColumn(
        "_first", F.row_number().over(per_part) == 1
    )
    grouped = numbered.withColumn("_group", F.when(~F.col("_first"), F.col("_part")))
    per_group = Window.partitionBy(invoice, "_group").orderBy(*order)
    is_first = F.col("_first") & (F.row_number().over(per_group) == 1)
    return grouped.withColumn(marker, F.when(is_first, 1)).drop("_part", "_first", "_group")

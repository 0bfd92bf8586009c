"""Refined snapshot to stage: one row of features per transaction line."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.calendar import ReferencePeriod
from ledgerlake.functions.features import (
    CURRENCIES,
    DAY_PERIODS,
    PAYMENT_METHODS,
    RETURN_TYPE,
    banded,
    flag,
    recoded,
    weekday_label,
)
from ledgerlake.operators.first_line import first_lines, mark_first_lines

# The columns of a transaction line that the stage depends on, and the order of
# the lines of an invoice when `line` is there to tell them apart.
INPUT_COLUMNS = (
    "invoice_id", "customer_id", "date", "hour", "discount", "currency",
    "transaction_type", "payment_method", "line_total",
)
LINE_ORDER = ("customer_id", "line")


def _input_lines(transactions: DataFrame) -> tuple[DataFrame, list[str]]:
    order = [name for name in LINE_ORDER if name in transactions.columns]
    narrow = [*INPUT_COLUMNS, *(name for name in order if name not in INPUT_COLUMNS)]
    return transactions.select(*narrow), order


def categories() -> list[Column]:
    return [
        weekday_label(F.col("date")).alias("fbc_dia_compra"),
        banded(F.col("hour"), DAY_PERIODS).alias("fbc_periodo_compra"),
        recoded(F.col("payment_method"), PAYMENT_METHODS).alias("fbc_metodo_pagamento"),
        recoded(F.col("currency"), CURRENCIES).alias("fbc_moeda"),
    ]


def flags() -> list[Column]:
    return [
        flag(F.col("discount") > 0).alias("flg_desconto"),
        flag(F.col("transaction_type") == RETURN_TYPE).alias("flg_retorno"),
    ]


def _stage_columns(dt_proc: str, as_of: date) -> list[Column]:
    return [
        F.col("customer_id"),
        F.lit(dt_proc).cast("bigint").alias("dt_proc"),
        F.lit(ReferencePeriod.of(as_of).ref).cast("int").alias("ref"),
        F.col("date"),
        *categories(),
        *flags(),
        F.col("line_total").alias("fvl_invoice_total"),
        F.col("fvl_qtd_transacoes"),
        F.lit(1).alias("fvl_qtd_itens_transacao"),
    ]


def stage_features(transactions: DataFrame, dt_proc: str, as_of: date) -> DataFrame:
    """Thirteen stage columns for every line; one line per invoice counts as the transaction.

    Takes whatever lines it is given: pass one snapshot to count each sale once.
    """
    lines, order = _input_lines(transactions)
    marked = mark_first_lines(lines, "invoice_id", order, "fvl_qtd_transacoes")
    return marked.select(*_stage_columns(dt_proc, as_of))


def book_lines(
    transactions: DataFrame, dt_proc: str, as_of: date, *, count_sales: bool = True
) -> DataFrame:
    """Stage rows that give the same book as `stage_features`, made with less shuffling.

    The book never needs to know which of the lines carries the transaction
    count, only that the category values of the first line get it. So all lines
    pass without a window and the first lines come in a second time with
    nothing but their count; every other measure of theirs is NULL, which
    SUM, AVG, MIN and MAX skip. A book without the transaction count needs no first
    lines: `count_sales=False` leaves that second pass out.
    """
    lines, order = _input_lines(transactions)
    marker = "fvl_qtd_transacoes"
    plain = lines.withColumn(marker, F.lit(None).cast("int"))
    if not count_sales:
        return plain.select(*_stage_columns(dt_proc, as_of))
    counted = first_lines(lines, "invoice_id", order).withColumn(marker, F.lit(1))
    staged = plain.unionByName(counted).select(*_stage_columns(dt_proc, as_of))
    is_plain = F.col(marker).isNull()
    silent = ("flg_desconto", "flg_retorno", "fvl_invoice_total", "fvl_qtd_itens_transacao")
    return staged.withColumns({name: F.when(is_plain, F.col(name)) for name in silent})

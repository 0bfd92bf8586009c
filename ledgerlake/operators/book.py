"""Customer feature book: conditional aggregates per customer and reference month."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.features import (
    CURRENCIES,
    DAY_PERIODS,
    PAYMENT_METHODS,
    WEEKDAYS,
    first_match,
)
from ledgerlake.operators.windows import WINDOW_MONTHS, window_flag

SUM, AVG, MIN, MAX = "SUM", "AVG", "MIN", "MAX"


@dataclass(frozen=True)
class Feature:
    """One column of the book."""

    var: str
    dim: str
    value: str
    measure: str
    window: str
    agg: str


@dataclass(frozen=True)
class BookSpec:
    """Which values, measures and windows the book crosses.

    `months` are cumulative windows in ascending order. A column is numbered by
    the place of its combination in dims > values > measures > windows > aggregates.

    Measures in `exact` are amounts with at most that many decimals. They are added up as whole
    numbers of the last decimal, so sums and averages do not depend on the order of the rows;
    an amount that is not finite, or a sum beyond 64 bits, is an error. Other
    measures are added up in the type they have.
    """

    dims: tuple[tuple[str, tuple[str, ...]], ...]
    measures: tuple[tuple[str, tuple[str, ...]], ...]
    months: tuple[int, ...] = WINDOW_MONTHS
    keys: tuple[str, ...] = ("customer_id", "ref")
    first_var: int = field(default=0)
    exact: tuple[tuple[str, int], ...] = ()

    def __post_init__(self) -> None:
        if list(self.months) != sorted(set(self.months)):
            raise ValueError("windows have to be given in ascending order")

    @property
    def values(self) -> list[tuple[str, str]]:
        return [(dim, value) for dim, values in self.dims for value in values]

    @property
    def value_features(self) -> list[tuple[str, int, str]]:
        """(measure, window number, aggregate) of the columns each value has."""
        return [
            (measure, number, agg)
            for measure, aggs in self.measures
            for number, agg in product(range(len(self.months)), aggs)
        ]

    def var_name(self, value_number: int, feature_number: int) -> str:
        return f"VAR_{self.first_var + value_number * len(self.value_features) + feature_number}"

    def features(self) -> list[Feature]:
        return [
            Feature(
                var=self.var_name(v, f),
                dim=dim.upper(),
                value=value,
                measure=measure.upper(),
                window=window_flag(self.months[number]).upper(),
                agg=agg,
            )
            for v, (dim, value) in enumerate(self.values)
            for f, (measure, number, agg) in enumerate(self.value_features)
        ]

    def only(self, dim: str, measures: Sequence[str]) -> "BookSpec":
        """A part of the book: one dimension, some of the measures."""
        return BookSpec(
            dims=tuple(d for d in self.dims if d[0] == dim),
            measures=tuple(m for m in self.measures if m[0] in measures),
            months=self.months,
            keys=self.keys,
            exact=self.exact,
        )


# Order and content decide the numbering of the columns.
BOOK = BookSpec(
    dims=(
        ("fbc_dia_compra", WEEKDAYS),
        ("fbc_periodo_compra", tuple(label for _, label in DAY_PERIODS)),
        ("fbc_metodo_pagamento", tuple(PAYMENT_METHODS.values())),
        ("fbc_moeda", tuple(CURRENCIES.values())),
    ),
    measures=(
        ("fvl_invoice_total", (SUM, AVG, MIN, MAX)),
        ("fvl_qtd_transacoes", (SUM,)),
        ("fvl_qtd_itens_transacao", (SUM,)),
        ("flg_desconto", (SUM,)),
        ("flg_retorno", (SUM,)),
    ),
    exact=(("fvl_invoice_total", 4),),
)
AMOUNT_MEASURES = ("fvl_invoice_total",)
COUNT_MEASURES = ("fvl_qtd_transacoes", "fvl_qtd_itens_transacao", "flg_desconto", "flg_retorno")


def feature_dictionary(spark: SparkSession, spec: BookSpec = BOOK) -> DataFrame:
    """What each column of the book stands for; its size is that of the specification."""
    rows = [(f.var, f.dim, f.value, f.measure, f.window, f.agg) for f in spec.features()]
    return spark.createDataFrame(
        rows, "var string, dim string, value string, measure string, window string, agg string"
    )


def feature_coverage(windows: DataFrame, spec: BookSpec = BOOK) -> DataFrame:
    """The feature dictionary with the number of customers that have a value in each column.

    Counted on the totals per value, before they are laid side by side.
    """
    places = range(len(spec.value_features))
    filled = _value_totals(_cells(windows, spec), spec).groupBy("_value").agg(
        *(F.expr(f"count(f{place}) AS `{place}`") for place in places)
    )
    number = F.col("_value") * len(places) + F.col("_place").cast("int") + spec.first_var
    counted = filled.unpivot("_value", [f"{place}" for place in places], "_place", "customers").select(
        F.concat(F.lit("VAR_"), number.cast("string")).alias("var"), "customers"
    )
    dictionary = feature_dictionary(windows.sparkSession, spec)
    return dictionary.join(counted, "var", "left").withColumn(
        "customers", F.coalesce("customers", F.lit(0).cast("bigint"))
    )


def feature_book(windows: DataFrame, spec: BookSpec = BOOK, form: str = "cells") -> DataFrame:
    """One row per customer and reference month with every column of `spec`.

    Customers without a sale in any window keep a row of NULLs.

    `form="cells"` aggregates in two steps. First to one row per customer,
    youngest window and combination of category values: few, narrow columns,
    merged in each task before the shuffle, and everything older than the last
    window melts to one row per customer. The number of rows of a customer is
    then bounded by the specification, whatever the customer bought, and they
    can safely meet in one task. There each row is counted in for each of its
    values, and the values are laid side by side.

    `form="wide"` is the direct formulation, every column as one conditional
    aggregate over the rows.
    """
    if form == "wide":
        return windows.groupBy(*spec.keys).agg(*_wide_columns(spec))
    if form != "cells":
        raise ValueError(f"unknown form {form!r}")
    return book_of_cells(_cells(windows, spec), spec)


def book_of_cells(cells: DataFrame, spec: BookSpec) -> DataFrame:
    """The book from rows that carry parts of aggregates; there may be several for a cell."""
    return _side_by_side(_value_totals(cells, spec), spec)


_AGGREGATES: dict[str, Callable[[Column], Column]] = {
    SUM: F.sum, AVG: F.avg, MIN: F.min, MAX: F.max,
}


def _wide_columns(spec: BookSpec) -> list[Column]:
    columns = []
    for feature in spec.features():
        matches = (F.col(feature.dim) == feature.value) & (F.col(feature.window) == 1)
        scale = dict(spec.exact).get(feature.measure.lower())
        if scale is not None and feature.agg in (SUM, AVG):
            picked = F.when(matches, F.expr(_units(feature.measure, scale)))
            total = F.sum(picked) / F.lit(float(10**scale))
            column = total if feature.agg == SUM else F.try_divide(total, F.count(picked))
        else:
            column = _AGGREGATES[feature.agg](F.when(matches, F.col(feature.measure)))
        columns.append(column.alias(feature.var))
    return columns


def _youngest_window(spec: BookSpec) -> Column:
    """Number of the shortest window that holds the row; NULL if none does."""
    return first_match(
        (F.col(window_flag(months)) == 1, number) for number, months in enumerate(spec.months)
    )


def value_number(dim: str, spec: BookSpec) -> Column:
    """Place of the row's value among all values of the book; NULL if it has none there."""
    return first_match(
        (F.col(dim) == value, number)
        for number, (owner, value) in enumerate(spec.values)
        if owner == dim
    )


# Parts an aggregate is put together from, each of which can be merged again.
_PARTS = {SUM: ("sum",), AVG: ("sum", "count"), MIN: ("min",), MAX: ("max",)}
_MERGE = {"sum": "sum", "count": "sum", "min": "min", "max": "max"}


def _units(measure: str, scale: int) -> str:
    """An amount as a whole number of its last decimal."""
    return f"CAST(rint(`{measure}` * {10**scale}D) AS BIGINT)"


def parts_of_rows(spec: BookSpec) -> list[Column]:
    """The parts of all aggregates, as aggregates over rows."""
    exact = dict(spec.exact)
    columns = []
    for measure, part in _measure_parts(spec):
        whole = part == "sum" and measure in exact
        value = _units(measure, exact[measure]) if whole else f"`{measure}`"
        columns.append(F.expr(f"{part}({value}) AS `{measure}_{part}`"))
    return columns


def merged_parts(spec: BookSpec) -> list[str]:
    """Names of the parts."""
    return [f"{measure}_{part}" for measure, part in _measure_parts(spec)]


def _measure_parts(spec: BookSpec) -> list[tuple[str, str]]:
    parts = [
        (measure, part) for measure, aggs in spec.measures for agg in aggs for part in _PARTS[agg]
    ]
    return list(dict.fromkeys(parts))


def _cells(windows: DataFrame, spec: BookSpec) -> DataFrame:
    dims = [dim for dim, _ in spec.dims]
    rows = windows.withColumn("_window", _youngest_window(spec))
    in_window = F.col("_window").isNotNull()
    measures = [measure for measure, _ in spec.measures]
    narrow = rows.select(
        *spec.keys,
        "_window",
        *(F.when(in_window, value_number(dim, spec)).alias(dim) for dim in dims),
        *measures,
    )
    return narrow.groupBy(*spec.keys, "_window", *dims).agg(*parts_of_rows(spec))


def _value_totals(cells: DataFrame, spec: BookSpec) -> DataFrame:
    """One row per customer and value with all its window aggregates.

    The rows are brought together by customer alone. That also serves the
    groupings that follow, and unlike the reference month, which is often one
    constant, it stays a column of the plan. Each row grows to many columns
    from here on, so their number of tasks is fixed: adaptive execution would
    join partitions by the size they have before that.
    """
    values = F.array_compact(F.array(*(dim for dim, _ in spec.dims)))
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_value = cells.repartition(tasks, spec.keys[0]).select(
        *spec.keys, "_window", F.explode_outer(values).alias("_value"),
        *merged_parts(spec),
    )
    exact = dict(spec.exact)

    def total(measure: str, part: str, number: int) -> str:
        picked = f"CASE WHEN _window <= {number} THEN `{measure}_{part}` END"
        merged = f"{_MERGE[part]}({picked})"
        return f"({merged} / {10 ** exact[measure]}D)" if part == "sum" and measure in exact else merged

    columns = []
    for place, (measure, number, agg) in enumerate(spec.value_features):
        parts = [total(measure, part, number) for part in _PARTS[agg]]
        column = f"try_divide({', '.join(parts)})" if agg == AVG else parts[0]
        columns.append(F.expr(f"{column} AS f{place}"))
    return per_value.groupBy(*spec.keys, "_value").agg(*columns)


def _side_by_side(totals: DataFrame, spec: BookSpec) -> DataFrame:
    """One row per customer: its value rows, as many as the book has values at most, by number."""
    places = range(len(spec.value_features))
    numbers = range(len(spec.values))
    totals_of_value = F.struct(*(f"f{p}" for p in places))
    per_customer = totals.groupBy(*spec.keys).agg(
        F.collect_list(F.struct("_value", totals_of_value.alias("totals"))).alias("_values")
    )
    by_number = F.expr("map_from_entries(filter(_values, v -> v._value IS NOT NULL))")
    return (
        per_customer.select(*spec.keys, by_number.alias("_by_number"))
        .selectExpr(*spec.keys, *(f"_by_number[{v}] AS _v{v}" for v in numbers))
        .selectExpr(
            *spec.keys, *(f"_v{v}.f{p} AS {spec.var_name(v, p)}" for v in numbers for p in places)
        )
    )

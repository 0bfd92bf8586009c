"""Monthly states of the book: kept per customer and month, merged for any reference month.

A window looks back from a month end by whole months, so it begins on the 28th to the 31st of a
month or on the first days behind. Rows of one month are therefore kept in five parts, days up
to the 27th and each later day, and every window is a union of parts. A state holds sums, counts,
minima and maxima per customer, part and combination of category values; these merge, so a book
is made from the states of its twelve months without the lines, and late lines change the
states of their own months only.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.calendar import ReferencePeriod, month_end, months_before
from ledgerlake.functions.features import first_match
from ledgerlake.operators.book import (
    BOOK,
    BookSpec,
    book_of_cells,
    merged_parts,
    parts_of_rows,
    value_number,
)
from ledgerlake.operators.stage import stage_features
from ledgerlake.sources.manifest import committed, current, open_loads, write_load, write_loads

MONTH, PART = "month", "part"
FIRST_PART = 27  # all days up to this one are one part
NO_MONTH = 0  # rows without a date: in no window, but their customer is in the book


def month_of(day: Column) -> Column:
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(NO_MONTH))


def monthly_states(lines: DataFrame, spec: BookSpec = BOOK, day: str = "date") -> DataFrame:
    """Cells of stage lines: customer, month, part, category values, parts of the aggregates.

    Rows are merged in each task before the shuffle. A customer has as many cells in a month as
    there are combinations of values and parts, whatever the number of lines.
    """
    customer = spec.keys[0]
    dims = [dim for dim, _ in spec.dims]
    narrow = lines.select(
        customer,
        month_of(F.col(day)).alias(MONTH),
        F.greatest(F.dayofmonth(day), F.lit(FIRST_PART)).alias(PART),
        *(value_number(dim, spec).alias(dim) for dim in dims),
        *(measure for measure, _ in spec.measures),
    )
    return narrow.groupBy(customer, MONTH, PART, *dims).agg(*parts_of_rows(spec))


def oldest_month(as_of: date, spec: BookSpec = BOOK) -> int:
    """The first month a book of `as_of` looks at."""
    first = months_before(month_end(as_of), spec.months[-1])
    return first.year * 100 + first.month


def _youngest_window(as_of: date, spec: BookSpec, include_future: bool) -> Column:
    end = month_end(as_of)
    place = F.col(MONTH) * 100 + F.coalesce(PART, F.lit(0))
    # The 28th is the earliest first day of a window, so no bound cuts the first part.
    bounds = [months_before(end, k) for k in spec.months]
    until_end = F.lit(True) if include_future else F.col(MONTH) <= end.year * 100 + end.month
    return first_match(
        ((place >= b.year * 10_000 + b.month * 100 + b.day) & until_end, number)
        for number, b in enumerate(bounds)
    )


def book_from_states(
    states: DataFrame, customers: DataFrame, as_of: date, spec: BookSpec = BOOK, *,
    include_future: bool = True,
) -> DataFrame:
    """The book of a reference month from monthly states.

    States of older months are skipped (a filter on the month, which prunes folders where the
    states are stored by it). `customers` has one row for each customer that should be in the
    book; one without sales in any window keeps a row of NULLs.
    """
    customer = spec.keys[0]
    dims = [dim for dim, _ in spec.dims]
    window = _youngest_window(as_of, spec, include_future)
    recent = states.where(F.col(MONTH) >= oldest_month(as_of, spec)).withColumn("_window", window)
    cells = recent.where("_window IS NOT NULL").select(
        customer, "_window", *dims, *merged_parts(spec)
    )
    # A customer counts as one cell without values and windows.
    roster = customers.select(customer).distinct()
    missing = [f for f in cells.schema.fields if f.name != customer]
    silent = roster.select(customer, *(F.lit(None).cast(f.dataType).alias(f.name) for f in missing))
    ref = F.lit(int(ReferencePeriod.of(as_of).ref)).cast("int")
    everything = cells.unionByName(silent).withColumn("ref", ref)
    return book_of_cells(everything, spec)


class StateStore:
    """States and known customers below `path`, each month a load that is replaced as a whole."""

    def __init__(self, spark: SparkSession, path: str, spec: BookSpec = BOOK):
        self.spark, self.spec = spark, spec
        self.months_path, self.customers_path = f"{path}/months", f"{path}/customers"

    def months(self) -> list[int]:
        return sorted(int(m) for m in current(committed(self.spark, self.months_path) or []))

    def replace(self, lines: DataFrame, months: Collection[int] | None = None) -> list[int]:
        """Compute the states of `months` anew from all lines of these months; the others stay.

        `lines` are stage lines and may hold other months as well. Without `months` all months
        that `lines` has are replaced. One job writes the states of all of them and one
        commit makes them count. Returns the months.
        """
        if months is None:
            months = [r[0] for r in lines.select(month_of(F.col("date")).alias(MONTH)).distinct().collect()]
        months = sorted(months)
        if not months:
            return []
        chosen = lines.where(month_of(F.col("date")).isin(months))
        states = monthly_states(chosen, self.spec).hint("rebalance", MONTH)
        write_loads(states, self.months_path, MONTH, [str(m) for m in months])
        self._add_customers()
        return months

    def refresh(self, transactions: DataFrame, late: DataFrame, dt_proc: str, as_of: date) -> list[int]:
        """Compute the months anew that `late` rows change, from the transactions as they are now.

        Only invoices with a line in these months are staged, each with all of its lines, so that
        the transaction count is on the line that carries it in the whole.
        """
        months = touched_months(late, transactions)
        if not months:
            return []
        in_months = transactions.where(month_of(F.col("date")).isin(months))
        invoices = in_months.select(F.col("invoice_id").alias("_invoice")).distinct()
        lines = transactions.join(invoices, F.col("invoice_id").eqNullSafe(F.col("_invoice")), "left_semi")
        return self.replace(stage_features(lines, dt_proc, as_of), months)

    def _add_customers(self) -> None:
        """Keep customers that are new; one stays known when its lines are gone."""
        customer = self.spec.keys[0]
        ids = self.states().select(customer).distinct()
        known = current(committed(self.spark, self.customers_path) or [])
        if known:
            older = self.customers().withColumnRenamed(customer, "_known")
            ids = ids.join(older, F.col(customer).eqNullSafe(F.col("_known")), "left_anti")
        write_load(ids, self.customers_path, str(len(known) + 1))

    def states(self) -> DataFrame:
        loads = current(committed(self.spark, self.months_path) or [])
        return open_loads(self.spark, self.months_path, loads).withColumnRenamed("dt_proc", MONTH)

    def customers(self) -> DataFrame:
        loads = current(committed(self.spark, self.customers_path) or [])
        return open_loads(self.spark, self.customers_path, loads).drop("dt_proc")

    def book(self, as_of: date, **options) -> DataFrame:
        """The book from the stored states; only folders of months in its windows are opened."""
        loads = current(committed(self.spark, self.months_path) or [])
        first = oldest_month(as_of, self.spec)
        recent = {m: v for m, v in loads.items() if int(m) >= first}
        if not recent:
            recent = dict([max(loads.items(), key=lambda item: int(item[0]))])
        states = open_loads(self.spark, self.months_path, recent).withColumnRenamed("dt_proc", MONTH)
        return book_from_states(states, self.customers(), as_of, self.spec, **options)


def touched_months(late: DataFrame, lines: DataFrame, invoice: str = "invoice_id", day: str = "date") -> list[int]:
    """Months whose states late lines change: theirs, and those of all lines of their invoices.

    The line that carries an invoice's transaction count may be another one now, in another month.
    There are as many months as the lake has, whatever the number of lines.
    """
    invoices = late.select(invoice).distinct()
    same = F.col(f"lines.{invoice}").eqNullSafe(F.col(f"late.{invoice}"))
    theirs = lines.alias("lines").join(invoices.alias("late"), same, "left_semi").select(
        month_of(F.col(day)).alias(MONTH)
    )
    late_months = late.select(month_of(F.col(day)).alias(MONTH))
    found = reduce(DataFrame.unionByName, [theirs, late_months]).distinct().collect()
    return sorted(r[MONTH] for r in found)

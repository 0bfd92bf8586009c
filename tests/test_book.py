"""The feature book against brute force, both forms, and its dictionary."""

import random
from collections import defaultdict
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_stage import AS_OF, DT_PROC, line, lines

from ledgerlake.operators.book import (
    BOOK,
    BookSpec,
    feature_book,
    feature_coverage,
    feature_dictionary,
)
from ledgerlake.operators.stage import book_lines, stage_features
from ledgerlake.operators.windows import recency_windows


def some_lines(seed, count, customers):
    """One customer with a third of all lines, dormant ones, unmapped values, NULL dates."""
    pick = random.Random(seed)
    days = [date(2025, 4, 20), date(2025, 3, 30), date(2025, 2, 3), date(2024, 12, 7),
            date(2024, 8, 15), date(2024, 5, 1), date(2020, 1, 1), date(2026, 1, 2), None]
    return [
        line(
            f"I{n // 3}", n % 3,
            0 if pick.random() < 0.34 else pick.randint(1, customers),
            pick.choice(days), pick.choice([3, 9, 15, 21, None]), pick.choice([0.0, 0.2, None]),
            pick.choice(["USD", "EUR", "GBP", "CNY", "JPY", None]), pick.choice(["Sale", "Return", None]),
            pick.choice(["Cash", "Credit Card", "Voucher", None]), pick.choice([None, 0.25, 1.5, 8.0]),
        )
        for n in range(count)
    ] + [line("OLD", 1, 999, date(2020, 1, 1))]


def windowed(spark, data):
    return recency_windows(stage_features(lines(spark, data), DT_PROC, AS_OF), AS_OF)


def brute_force(windows):
    """All features straight from their definition. The amounts are exact in binary."""
    groups = defaultdict(list)
    for r in windows.collect():
        groups[r.customer_id, r.ref].append(r.asDict())
    out = {}
    for key, members in groups.items():
        values = []
        for f in BOOK.features():
            picked = [
                m[f.measure.lower()]
                for m in members
                if m[f.dim.lower()] == f.value and m[f.window.lower()] == 1
            ]
            picked = [v for v in picked if v is not None]
            apply = {"SUM": sum, "MIN": min, "MAX": max, "AVG": lambda v: sum(v) / len(v)}
            values.append(apply[f.agg](picked) if picked else None)
        out[key] = values
    return out


@pytest.mark.parametrize("form", ["cells", "wide"])
def test_book_against_brute_force(spark, form):
    windows = windowed(spark, some_lines(1, 900, 12))
    expected = brute_force(windows)
    book = feature_book(windows, form=form)
    assert book.columns == ["customer_id", "ref", *(f"VAR_{n}" for n in range(680))]
    got = {(r[0], r[1]): list(r[2:]) for r in book.collect()}
    assert got == expected


def test_book_from_lines_equals_book_from_stage(spark):
    data = some_lines(2, 900, 12)
    from_lines = feature_book(recency_windows(book_lines(lines(spark, data), DT_PROC, AS_OF), AS_OF))
    assert rows(from_lines) == rows(feature_book(windowed(spark, data)))


def test_types_are_the_same_in_both_forms(spark):
    windows = windowed(spark, some_lines(3, 30, 3))
    cells, wide = feature_book(windows), feature_book(windows, form="wide")
    assert cells.dtypes == wide.dtypes
    types = dict(cells.dtypes)
    assert {types[f.var] for f in BOOK.features() if f.measure == "FVL_INVOICE_TOTAL"} == {"double"}
    assert {types[f.var] for f in BOOK.features() if f.measure != "FVL_INVOICE_TOTAL"} == {"bigint"}


def test_dormant_customer_has_a_row_of_nulls(spark):
    book = feature_book(windowed(spark, some_lines(4, 60, 4))).where("customer_id = 999").collect()
    assert len(book) == 1 and set(book[0][2:]) == {None}


@pytest.mark.parametrize("source", [stage_features, book_lines])
def test_customers_meet_only_after_merging(spark, source):
    """Cells are merged in each task, spread by all their keys, and only then by customer."""
    windows = recency_windows(source(lines(spark, some_lines(5, 60, 4)), DT_PROC, AS_OF), AS_OF)
    plan = feature_book(windows)._jdf.queryExecution().executedPlan().toString()
    by_customer = plan.index("Exchange hashpartitioning(customer_id")
    by_cell = plan.index("Exchange hashpartitioning(customer_id", by_customer + 1)
    assert "REPARTITION_BY_NUM" in plan[by_customer:by_cell]
    assert "partial_sum" in plan[by_cell:]


def test_rows_of_a_customer_are_bounded_by_the_specification(spark):
    from ledgerlake.operators.book import _cells

    many = some_lines(6, 6000, 2)
    largest = _cells(windowed(spark, many), BOOK).groupBy("customer_id").count().agg(F.max("count"))
    assert largest.first()[0] <= 8 * 5 * 3 * 5 * 5 + 1


def test_dictionary_numbering(spark):
    """Names against the closed formula: 40 columns per value, 20 of them amounts."""
    got = {r["var"]: tuple(r)[1:] for r in feature_dictionary(spark).collect()}
    assert len(got) == 680
    values = [
        ("FBC_DIA_COMPRA", ["DOMINGO", "SEGUNDA", "TERCA", "QUARTA", "QUINTA", "SEXTA", "SABADO"]),
        ("FBC_PERIODO_COMPRA", ["MADRUGADA", "MANHA", "TARDE", "NOITE"]),
        ("FBC_METODO_PAGAMENTO", ["DINHEIRO", "CARTAO"]),
        ("FBC_MOEDA", ["DOLAR", "EURO", "LIBRA", "YUAN"]),
    ]
    flat = [(dim, value) for dim, labels in values for value in labels]
    counted = ["FVL_QTD_TRANSACOES", "FVL_QTD_ITENS_TRANSACAO", "FLG_DESCONTO", "FLG_RETORNO"]
    for v, (dim, value) in enumerate(flat):
        for w, months in enumerate([1, 3, 6, 9, 12]):
            window = f"FLG_U{months}M"
            for a, agg in enumerate(["SUM", "AVG", "MIN", "MAX"]):
                assert got[f"VAR_{40 * v + 4 * w + a}"] == (
                    dim, value, "FVL_INVOICE_TOTAL", window, agg,
                )
            for m, measure in enumerate(counted):
                assert got[f"VAR_{40 * v + 20 + 5 * m + w}"] == (dim, value, measure, window, "SUM")


def test_coverage_counts_the_filled_columns(spark):
    windows = windowed(spark, some_lines(7, 300, 9))
    book = feature_book(windows)
    filled = book.agg(*(F.count(f.var).alias(f.var) for f in BOOK.features())).first().asDict()
    coverage = feature_coverage(windows)
    assert {r["var"]: r["customers"] for r in coverage.collect()} == filled
    assert coverage.columns == ["var", "dim", "value", "measure", "window", "agg", "customers"]


def test_part_of_a_book(spark):
    spec = BOOK.only("fbc_moeda", ["fvl_invoice_total"])
    windows = windowed(spark, some_lines(8, 200, 5))
    part = feature_book(windows, spec)
    full = feature_book(windows).select(
        "customer_id", "ref",
        *(f"VAR_{40 * v + n}" for v in range(13, 17) for n in range(20)),
    )
    assert part.columns[2:] == [f"VAR_{n}" for n in range(80)]
    assert rows(part) == rows(full)


def test_windows_have_to_ascend():
    with pytest.raises(ValueError):
        BookSpec(dims=(), measures=(), months=(3, 1))


def test_sums_grow_with_the_window_and_averages_lie_between(spark):
    book = feature_book(windowed(spark, some_lines(9, 900, 12))).collect()
    for row in book:
        for v in range(17):
            for first in (20, 25, 30, 35):
                sums = [row[f"VAR_{40 * v + first + w}"] or 0 for w in range(5)]
                assert sums == sorted(sums)
            for w in range(5):
                total, mean, low, high = (row[f"VAR_{40 * v + 4 * w + a}"] for a in range(4))
                assert (total is None) == (mean is None)
                if mean is not None:
                    assert low <= mean <= high


def test_amount_books_need_no_first_lines(spark):
    """One pass over the lines and no window, and the same book."""
    data = lines(spark, some_lines(8, 300, 6))
    spec = BOOK.only("fbc_moeda", ("fvl_invoice_total",))
    with_sales, without = (
        feature_book(recency_windows(book_lines(data, DT_PROC, AS_OF, count_sales=c), AS_OF), spec)
        for c in (True, False)
    )
    assert rows(with_sales) == rows(without)
    assert "Window" not in without._jdf.queryExecution().executedPlan().toString()

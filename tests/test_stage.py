"""Stage rows, first-line marker, look-back windows."""

import random
from collections import Counter, defaultdict
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerlake.operators.first_line import first_lines, mark_first_lines
from ledgerlake.operators.stage import INPUT_COLUMNS, book_lines, stage_features
from ledgerlake.operators.windows import recency_windows

AS_OF = date(2025, 4, 11)
DT_PROC = "20250411080000"
SCHEMA = (
    "invoice_id string, line int, customer_id bigint, date date, hour int, discount double,"
    " currency string, transaction_type string, payment_method string, line_total double,"
    " sku string"
)


def line(invoice, number, customer=1, day=date(2025, 4, 6), hour=9, discount=0.0,
         currency="USD", kind="Sale", payment="Cash", total=10.0, sku="s"):
    return (invoice, number, customer, day, hour, discount, currency, kind, payment, total, sku)


def lines(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_one_invoice_with_four_lines(spark):
    data = [line("I", n, discount=0.1 if n > 2 else 0.0) for n in range(1, 5)]
    stage = stage_features(lines(spark, data), DT_PROC, AS_OF)
    assert stage.columns == [
        "customer_id", "dt_proc", "ref", "date", "fbc_dia_compra", "fbc_periodo_compra",
        "fbc_metodo_pagamento", "fbc_moeda", "flg_desconto", "flg_retorno",
        "fvl_invoice_total", "fvl_qtd_transacoes", "fvl_qtd_itens_transacao",
    ]
    assert dict(stage.dtypes) | {"dt_proc": "bigint", "ref": "int"} == dict(stage.dtypes)
    got = stage.collect()
    assert Counter(r.fvl_qtd_transacoes for r in got) == {1: 1, None: 3}
    assert sum(r.fvl_qtd_itens_transacao for r in got) == 4
    assert sum(r.flg_desconto for r in got) == 2
    assert {(r.dt_proc, r.ref, r.fbc_dia_compra, r.fbc_moeda) for r in got} == {
        (int(DT_PROC), 202504, "DOMINGO", "DOLAR")
    }


def test_unfiltered_snapshots_double_the_amount_but_not_the_transaction(spark):
    data = [line("I", n) for n in (1, 2)]
    once = stage_features(lines(spark, data), DT_PROC, AS_OF)
    twice = stage_features(lines(spark, data * 2), DT_PROC, AS_OF)
    total = lambda df, name: df.agg(F.sum(name)).first()[0]
    assert (total(once, "fvl_invoice_total"), total(twice, "fvl_invoice_total")) == (20.0, 40.0)
    assert total(once, "fvl_qtd_transacoes") == total(twice, "fvl_qtd_transacoes") == 1


def random_lines(seed, count=600):
    """Half of the lines in one invoice, many exact copies, NULL invoices and customers."""
    pick = random.Random(seed)
    out = []
    for _ in range(count):
        invoice = pick.choice(["HOT"] * 5 + [None] * 2 + [f"I{n}" for n in range(40)])
        out.append(
            line(
                invoice, pick.randint(1, 3), pick.choice([None, 1, 2]),
                date(2025, pick.randint(1, 4), 1), pick.choice([3, 9, 15, 21]),
                pick.choice([0.0, 0.2]), pick.choice(["USD", "EUR", "BRL"]),
                pick.choice(["Sale", "Return"]), pick.choice(["Cash", "Credit Card"]),
                float(pick.randint(1, 4)),
            )
        )
    return out + [line("HOT", 1, 1, total=1.0)] * 200


def brute_force(data):
    """Invoice, line content, marker - one line per invoice, the first in full order."""
    order = lambda r: [(v is None, v) for v in (r[2], r[1], *r[3:])]
    groups = defaultdict(list)
    for r in data:
        groups[r[0]].append(r)
    out = []
    for members in groups.values():
        members.sort(key=order)
        out += [(*r, 1 if n == 0 else None) for n, r in enumerate(members)]
    return sorted(out, key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("parts", [1, 7])
def test_marker_against_brute_force(spark, parts):
    data = random_lines(11)
    spread = lines(spark, data).repartition(parts)
    marked = mark_first_lines(spread, "invoice_id", ("customer_id", "line"), "m")
    assert rows(marked) == brute_force(data)


def test_marker_passes_lines_unchanged(spark):
    """Signed zeros, NaN, NULL and exact copies come out as they came in."""
    totals = [-0.0, -0.0, 0.0, float("nan"), float("nan"), None, None]
    data = [line(invoice, 1, total=t) for invoice in ("I", None) for t in totals]
    marked = mark_first_lines(
        lines(spark, data).repartition(5), "invoice_id", ("customer_id", "line"), "m"
    ).collect()
    text = lambda found: Counter((r[0], str(r[1])) for r in found)
    assert text((r.invoice_id, r.line_total) for r in marked) == text((r[0], r[9]) for r in data)
    assert [r.m for r in marked].count(1) == 2


def test_many_hot_invoices(spark):
    """2,000 invoices of 200 lines and one of a ten-thousandth of all lines, none special."""
    row = F.col("id")
    made = spark.range(0, 400_000, 1, 16).select(
        F.when(row % 10_000 == 0, "few").otherwise((row % 2_000).cast("string")).alias("invoice_id"),
        (row % 7).alias("line"), (row % 3).alias("amount"),
    )
    marked = mark_first_lines(made, "invoice_id", ("line",), "m")
    counted = marked.agg(F.count("*"), F.sum("m"), F.count_distinct(F.when(F.col("m") == 1, F.col("invoice_id"))))
    assert counted.first() == (400_000, 2_001, 2_001)
    smallest = made.groupBy("invoice_id").agg(F.min(F.struct("line", "amount")).alias("first"))
    chosen = marked.where("m = 1").select("invoice_id", F.struct("line", "amount").alias("first"))
    assert chosen.exceptAll(smallest).count() == 0


def test_an_invoice_never_meets_in_one_task(spark):
    """The widest group of a window holds the lines one input partition has of an invoice."""
    data = lines(spark, [line("HOT", 1) for _ in range(800)]).repartition(8)
    marked = mark_first_lines(data, "invoice_id", ("customer_id", "line"), "m")
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "hashpartitioning(invoice_id" in plan and "_part" in plan and "_group" in plan
    assert marked.where("m = 1").count() == 1


def test_first_lines_keeps_one_per_invoice_before_the_shuffle(spark):
    data = random_lines(12)
    first = first_lines(lines(spark, data), "invoice_id", ("customer_id", "line"))
    expected = [r[:-1] for r in brute_force(data) if r[-1] == 1]
    assert rows(first) == sorted(expected, key=lambda r: [(x is None, str(x)) for x in r])
    plan = first._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below


def test_stage_reads_only_the_columns_it_needs(spark, tmp_path):
    lines(spark, random_lines(14)).write.parquet(str(tmp_path / "t"))
    stage = stage_features(spark.read.parquet(str(tmp_path / "t")), DT_PROC, AS_OF)
    plan = stage._jdf.queryExecution().executedPlan().toString()
    assert "sku" not in plan[plan.index("ReadSchema"):]
    assert all(name in plan for name in INPUT_COLUMNS)


def test_book_lines_hold_the_same_totals(spark):
    data = lines(spark, random_lines(15))
    measures = [
        "fvl_invoice_total", "fvl_qtd_transacoes", "fvl_qtd_itens_transacao", "flg_desconto",
        "flg_retorno",
    ]
    keys = ["customer_id", "date", "fbc_periodo_compra", "fbc_moeda"]
    total = lambda df: rows(df.groupBy(*keys).agg(*(F.sum(m) for m in measures)))
    assert total(book_lines(data, DT_PROC, AS_OF)) == total(stage_features(data, DT_PROC, AS_OF))


def test_windows_on_golden_dates(spark):
    days = [date(2025, 3, 31), date(2025, 3, 30), date(2025, 3, 29), date(2025, 6, 1), None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, date date")
    got = recency_windows(df, AS_OF).orderBy("i").collect()
    assert [r.flg_u1m for r in got] == [1, 1, 0, 1, 0]
    past = recency_windows(df, AS_OF, include_future=False).orderBy("i").collect()
    assert [r.flg_u1m for r in past] == [1, 1, 0, 0, 0]
    assert [r.flg_u12m for r in past] == [1, 1, 1, 0, 0]
    assert got[0].asDict().keys() == {
        "i", "date", "flg_u1m", "flg_u3m", "flg_u6m", "flg_u9m", "flg_u12m",
    }


def test_windows_equal_months_between_for_every_month_end(spark):
    """The constant bound against the function, for all days of four years and all month ends."""
    days = spark.range(1461).select(F.date_add(F.lit(date(2022, 1, 1)), F.col("id").cast("int")).alias("date"))
    for end in [date(2024, 2, 29), date(2025, 2, 28), date(2025, 3, 31), date(2025, 4, 30)]:
        flagged = recency_windows(days, end)
        wrong = flagged.where(
            " or ".join(
                f"flg_u{k}m <> if(months_between(date'{end}', date) <= {k}, 1, 0)"
                for k in (1, 3, 6, 9, 12)
            )
        )
        assert wrong.count() == 0


def test_windows_are_nested(spark):
    days = spark.range(800).select(F.date_add(F.lit(date(2023, 6, 1)), F.col("id").cast("int")).alias("date"))
    flagged = recency_windows(days, AS_OF)
    assert flagged.where(
        "flg_u1m > flg_u3m or flg_u3m > flg_u6m or flg_u6m > flg_u9m or flg_u9m > flg_u12m"
    ).count() == 0

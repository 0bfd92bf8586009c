"""Category columns, flags and derived fields on golden rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import features as fx
from ledgerlake.functions.calendar import ReferencePeriod, month_end, months_before
from ledgerlake.functions.calendar import reference_period_columns


def one_column(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_weekdays(spark):
    days = [date(2024, 5, d) for d in range(5, 12)] + [None]
    assert one_column(spark, days, "date", fx.weekday_label) == [*fx.WEEKDAYS, None]


def test_hours(spark):
    hours = [-1, 0, 6, 7, 12, 13, 18, 19, 23, 24, 25, None]
    expected = (
        ["MADRUGADA"] * 3 + ["MANHA"] * 2 + ["TARDE"] * 2 + ["NOITE"] * 3 + [None] * 2
    )
    assert one_column(spark, hours, "int", lambda c: fx.banded(c, fx.DAY_PERIODS)) == expected


def test_recodes(spark):
    assert one_column(
        spark, ["Cash", "Credit Card", "cash", None], "string",
        lambda c: fx.recoded(c, fx.PAYMENT_METHODS),
    ) == ["DINHEIRO", "CARTAO", None, None]
    assert one_column(
        spark, ["USD", "EUR", "GBP", "CNY", "BRL", None], "string",
        lambda c: fx.recoded(c, fx.CURRENCIES),
    ) == ["DOLAR", "EURO", "LIBRA", "YUAN", None, None]


def test_flags(spark):
    discounts = [0.2, 0.0, -0.1, None]
    assert one_column(spark, discounts, "double", lambda c: fx.flag(c > 0)) == [1, 0, 0, 0]
    kinds = ["Return", "Sale", None]
    assert one_column(
        spark, kinds, "string", lambda c: fx.flag(c == fx.RETURN_TYPE)
    ) == [1, 0, 0]


@pytest.mark.parametrize(
    "value, kind",
    [
        (date(2024, 2, 3), "date"),
        (datetime(2024, 2, 3, 23, 59), "timestamp_ntz"),
        ("2024-02-03", "string"),
    ],
)
def test_month_code(spark, value, kind):
    assert one_column(spark, [value, None], kind, fx.month_code) == ["202402", None]


def test_age(spark):
    as_of = date(2024, 3, 15)
    births = [date(2000, 3, 15), date(2000, 3, 16), date(2024, 3, 16), None]
    assert one_column(spark, births, "date", lambda c: fx.age_in_years(c, as_of)) == [
        24, 23, -1, None,
    ]


def test_dashed_is_null_with_a_null_part(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("a", None, "c")], "x string, y string, z string")
    out = df.select(fx.dashed(F.col("x"), F.col("y"), F.col("z"))).collect()
    assert [r[0] for r in out] == ["a - b - c", None]


def test_wall_clock_does_not_depend_on_the_session_zone(spark, conf):
    df = spark.createDataFrame([(datetime(2024, 3, 31, 2, 30),)], "t timestamp_ntz")
    for zone in ("UTC", "America/Sao_Paulo", "Europe/Berlin", "Asia/Shanghai"):
        conf(spark__sql__session__timeZone=zone)
        got = df.select(
            F.hour("t"), fx.weekday_label(F.to_date("t")), fx.month_code(F.col("t"))
        ).first()
        assert tuple(got) == (2, "DOMINGO", "202403")


def test_reference_period():
    period = ReferencePeriod.of(date(2025, 4, 11))
    assert (period.ref, period.start_ref, period.end) == ("202504", "202404", date(2025, 4, 30))
    assert ReferencePeriod.of(date(2024, 2, 1)).start == date(2023, 2, 28)
    assert months_before(date(2025, 3, 31), 1) == date(2025, 2, 28)
    assert months_before(date(2025, 1, 31), 1) == date(2024, 12, 31)
    assert month_end(date(2024, 2, 29)) == date(2024, 2, 29)


def test_reference_period_of_a_column_is_that_of_each_date(spark):
    days = [date(2023, 12, 31), date(2024, 2, 29), date(2025, 4, 11)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select("d", *reference_period_columns(F.col("d"))).collect()
    for row in got:
        period = ReferencePeriod.of(row["d"])
        assert (row["ref"], row["start_ref"], row["month_end"]) == (
            period.ref, period.start_ref, period.end,
        )

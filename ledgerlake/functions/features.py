"""Expressions behind the categorical columns, the flags and the derived fields."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and codes that results have to match exactly.
WEEKDAYS = ("DOMINGO", "SEGUNDA", "TERCA", "QUARTA", "QUINTA", "SEXTA", "SABADO")
DAY_PERIODS = ((6, "MADRUGADA"), (12, "MANHA"), (18, "TARDE"), (24, "NOITE"))
PAYMENT_METHODS = {"Cash": "DINHEIRO", "Credit Card": "CARTAO"}
CURRENCIES = {"USD": "DOLAR", "EUR": "EURO", "GBP": "LIBRA", "CNY": "YUAN"}
RETURN_TYPE = "Return"


def first_match(cases: Iterable[tuple[Column, Any]]) -> Column:
    """Value of the first condition that holds, NULL if none does."""
    cases = list(cases)
    out = F.when(*cases[0])
    for condition, value in cases[1:]:
        out = out.when(condition, value)
    return out


def weekday_label(day: Column) -> Column:
    """Label of the weekday, Sunday first; NULL for a NULL date."""
    number = F.dayofweek(day)
    return first_match((number == i, label) for i, label in enumerate(WEEKDAYS, start=1))


def banded(value: Column, bands: Sequence[tuple[int, str]]) -> Column:
    """Label of the first band whose upper bound is not exceeded, else NULL."""
    return first_match((value <= upper, label) for upper, label in bands)


def recoded(value: Column, mapping: Mapping[str, str]) -> Column:
    """`mapping[value]`, NULL for values outside the mapping."""
    return first_match((value == source, target) for source, target in mapping.items())


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def month_code(moment: Column) -> Column:
    """yyyyMM of a date, a timestamp or an ISO string."""
    return F.substring(F.replace(moment.cast("string"), F.lit("-"), F.lit("")), 1, 6)


def age_in_years(birthdate: Column, as_of: date) -> Column:
    return F.floor(F.months_between(F.lit(as_of), birthdate) / 12).cast("int")


def dashed(*parts: Column) -> Column:
    """Parts joined by ' - '; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit(" - "), part] if pieces else [part]
    return F.concat(*pieces)

"""The six subjects: landing headers with types, business key, trusted projection."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.features import age_in_years, dashed, month_code


def _source(header: str) -> Column:
    return F.col(f"`{header}`")


@dataclass(frozen=True)
class SubjectSpec:
    """What a subject looks like in the landing file and in the trusted layer.

    `landing` lists (header, type, trusted name) in file order. `derived` maps a
    trusted column to an expression over the landing headers; `order` is the
    trusted column order, without the load stamp that always comes last. `restated` gives
    the columns that depend on the day of the run, from trusted columns.
    """

    name: str
    key: str
    landing: tuple[tuple[str, str, str], ...]
    order: tuple[str, ...]
    derived: Callable[[date | None], dict[str, Column]] = lambda as_of: {}
    restated: Callable[[date], dict[str, Column]] = lambda as_of: {}
    partition_by: tuple[str, ...] = ("dt_proc",)

    @property
    def landing_schema(self) -> str:
        return ", ".join(f"`{header}` {kind}" for header, kind, _ in self.landing)

    def trusted_columns(self, as_of: date | None) -> list[Column]:
        available = {target: _source(header) for header, _, target in self.landing}
        available.update(self.derived(as_of))
        return [available[name].alias(name) for name in self.order]


def _customer_age(as_of: date | None) -> dict[str, Column]:
    if as_of is None:
        raise ValueError("customers need an as_of date for the age")
    return {"age": age_in_years(_source("Date Of Birth"), as_of)}


def _discount_fields(_: date | None) -> dict[str, Column]:
    return {
        "ref": month_code(_source("Start")),
        "discount_id": dashed(
            _source("Description"), _source("Category"), _source("Sub category")
        ),
    }


def _transaction_fields(_: date | None) -> dict[str, Column]:
    return {
        "date": F.to_date(_source("Date")),
        "hour": F.hour(_source("Date")),
        "ref": month_code(_source("Date")),
    }


# Headers of the landing files and column names of the trusted tables.
# Moments are wall-clock times of the shop, hence TIMESTAMP_NTZ: weekday and hour do
# not depend on the session time zone.
CUSTOMERS = SubjectSpec(
    name="customers",
    key="customer_id",
    landing=(
        ("Customer ID", "BIGINT", "customer_id"),
        ("Name", "STRING", "name"),
        ("Email", "STRING", "email"),
        ("Telephone", "STRING", "telephone"),
        ("City", "STRING", "city"),
        ("Country", "STRING", "country"),
        ("Gender", "STRING", "gender"),
        ("Date Of Birth", "DATE", "birthdate"),
        ("Job Title", "STRING", "job_title"),
    ),
    order=(
        "customer_id", "name", "email", "telephone", "city", "country", "gender",
        "job_title", "birthdate", "age",
    ),
    derived=_customer_age,
    restated=lambda as_of: {"age": age_in_years(F.col("birthdate"), as_of)},
)

DISCOUNTS = SubjectSpec(
    name="discounts",
    key="discount_id",
    landing=(
        ("Start", "DATE", "start"),
        ("End", "DATE", "end"),
        ("Discont", "DOUBLE", "discount"),
        ("Description", "STRING", "description"),
        ("Category", "STRING", "category"),
        ("Sub category", "STRING", "subcategory"),
    ),
    order=(
        "start", "end", "ref", "discount", "description", "category", "subcategory",
        "discount_id",
    ),
    derived=_discount_fields,
)

EMPLOYEES = SubjectSpec(
    name="employees",
    key="employee_id",
    landing=(
        ("Employee ID", "BIGINT", "employee_id"),
        ("Store ID", "BIGINT", "store_id"),
        ("Name", "STRING", "name"),
        ("Position", "STRING", "position"),
    ),
    order=("employee_id", "store_id", "name", "position"),
)

PRODUCTS = SubjectSpec(
    name="products",
    key="product_id",
    landing=(
        ("Product ID", "BIGINT", "product_id"),
        ("Category", "STRING", "category"),
        ("Sub Category", "STRING", "subcategory"),
        ("Description PT", "STRING", "description_pt"),
        ("Description DE", "STRING", "description_de"),
        ("Description FR", "STRING", "description_fr"),
        ("Description ES", "STRING", "description_es"),
        ("Description EN", "STRING", "description_en"),
        ("Description ZH", "STRING", "description_zh"),
        ("Color", "STRING", "color"),
        ("Sizes", "STRING", "sizes"),
        ("Production Cost", "DOUBLE", "production_cost"),
    ),
    order=(
        "product_id", "category", "subcategory", "description_pt", "description_de",
        "description_fr", "description_es", "description_en", "description_zh", "color",
        "sizes", "production_cost",
    ),
)

STORES = SubjectSpec(
    name="stores",
    key="store_id",
    landing=(
        ("Store ID", "BIGINT", "store_id"),
        ("Country", "STRING", "country"),
        ("City", "STRING", "city"),
        ("Store Name", "STRING", "store_name"),
        ("Number of Employees", "INT", "number_of_employees"),
        ("ZIP Code", "STRING", "zip_code"),
        ("Latitude", "DOUBLE", "latitude"),
        ("Longitude", "DOUBLE", "longitude"),
    ),
    order=(
        "store_id", "country", "city", "store_name", "number_of_employees", "zip_code",
        "latitude", "longitude",
    ),
)

TRANSACTIONS = SubjectSpec(
    name="transactions",
    key="invoice_id",
    landing=(
        ("Invoice ID", "STRING", "invoice_id"),
        ("Line", "INT", "line"),
        ("Customer ID", "BIGINT", "customer_id"),
        ("Product ID", "BIGINT", "product_id"),
        ("Size", "STRING", "size"),
        ("Color", "STRING", "color"),
        ("Unit Price", "DOUBLE", "unit_price"),
        ("Quantity", "INT", "quantity"),
        ("Date", "TIMESTAMP_NTZ", "date_hour"),
        ("Discount", "DOUBLE", "discount"),
        ("Line Total", "DOUBLE", "line_total"),
        ("Store ID", "BIGINT", "store_id"),
        ("Employee ID", "BIGINT", "employee_id"),
        ("Currency", "STRING", "currency"),
        ("Currency Symbol", "STRING", "currency_symbol"),
        ("SKU", "STRING", "sku"),
        ("Transaction Type", "STRING", "transaction_type"),
        ("Payment Method", "STRING", "payment_method"),
        ("Invoice Total", "DOUBLE", "invoice_total"),
    ),
    order=(
        "invoice_id", "line", "customer_id", "product_id", "size", "color", "unit_price",
        "quantity", "date_hour", "date", "hour", "ref", "discount", "line_total",
        "store_id", "employee_id", "currency", "currency_symbol", "sku",
        "transaction_type", "payment_method", "invoice_total",
    ),
    derived=_transaction_fields,
    partition_by=("ref",),
)

SUBJECTS = {
    spec.name: spec
    for spec in (CUSTOMERS, DISCOUNTS, EMPLOYEES, PRODUCTS, STORES, TRANSACTIONS)
}

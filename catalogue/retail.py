"""The test tables in the shape of the six landing subjects.

Nothing is made up: every column is taken or derived from the given tables, and
every table is used as a whole.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.features import first_match, month_code

AS_OF = date(2001, 8, 31)
DT_PROC = "20010831000000"

CURRENCY_OF_REGION = ("USD", "EUR", "GBP", "CNY", "JPY")
SYMBOL_OF_REGION = ("$", "€", "£", "¥", "円")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_region(labels: tuple[str, ...]) -> Column:
    return first_match((F.col("n_regionkey") == i, label) for i, label in enumerate(labels))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as invoice lines.

    Orders meet their customers first, so that the long table of lines is
    shuffled once, by order. The invoice id is text, so what follows does not
    build on the partitions of that join, and adaptive execution stays free to
    cut an order that holds a large part of the lines into several tasks.
    """
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    lines = table(spark, sf_dir, "lineitem")
    hour = (F.col("l_orderkey") % 24).cast("int")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").cast("string").alias("Invoice ID"),
        F.col("l_linenumber").alias("Line"),
        F.col("o_custkey").alias("Customer ID"),
        F.col("l_partkey").alias("Product ID"),
        F.col("l_linestatus").alias("Size"),
        F.col("o_orderpriority").alias("Color"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("Unit Price"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hour)).alias("Date"),
        F.col("l_discount").alias("Discount"),
        F.col("l_extendedprice").alias("Line Total"),
        F.col("l_suppkey").alias("Store ID"),
        (F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("Employee ID"),
        _by_region(CURRENCY_OF_REGION).alias("Currency"),
        _by_region(SYMBOL_OF_REGION).alias("Currency Symbol"),
        F.concat_ws("-", "l_partkey", "l_suppkey").alias("SKU"),
        F.when(F.col("l_returnflag") == "R", "Return").otherwise("Sale").alias("Transaction Type"),
        F.when(F.col("o_orderstatus") == "F", "Cash")
        .when(F.col("o_orderstatus") == "O", "Credit Card")
        .otherwise("Voucher")
        .alias("Payment Method"),
        F.col("o_totalprice").alias("Invoice Total"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("Customer ID"),
            F.col("c_name").alias("Name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("Email"),
            F.concat(F.lit("+"), key.cast("string")).alias("Telephone"),
            F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("City"),
            F.col("n_name").alias("Country"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("Gender"),
            F.date_add(F.lit(date(1950, 1, 1)), (key * 37 % 18000).cast("int")).alias(
                "Date Of Birth"
            ),
            F.col("c_mktsegment").alias("Job Title"),
        )
    )


def raw_discounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.date_add(F.lit(date(1995, 1, 1)), F.col("p_partkey").cast("int"))
    return table(spark, sf_dir, "part").select(
        start.alias("Start"),
        F.date_add(start, F.col("p_size")).alias("End"),
        (F.col("p_size") / 100).alias("Discont"),
        F.col("p_type").alias("Description"),
        F.col("p_brand").alias("Category"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_name")).alias("Sub category"),
    )


def raw_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, so the same employee comes in many times."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("Employee ID"),
        F.col("l_suppkey").alias("Store ID"),
        F.concat(F.lit("Employee "), F.col("l_linenumber").cast("string")).alias("Name"),
        F.concat(F.lit("Desk "), F.col("l_linenumber").cast("string")).alias("Position"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    languages = ("PT", "DE", "FR", "ES")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Product ID"),
        F.col("p_brand").alias("Category"),
        F.col("p_type").alias("Sub Category"),
        *(F.concat(F.lit(f"{x} "), F.col("p_name")).alias(f"Description {x}") for x in languages),
        F.col("p_name").alias("Description EN"),
        F.concat(F.lit("ZH "), F.col("p_name")).alias("Description ZH"),
        F.substring_index("p_name", " ", 1).alias("Color"),
        F.col("p_size").cast("string").alias("Sizes"),
        F.col("p_retailprice").alias("Production Cost"),
    )


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("Store ID"),
            F.col("n_name").alias("Country"),
            F.concat(F.lit("City "), F.col("s_nationkey").cast("string")).alias("City"),
            F.col("s_name").alias("Store Name"),
            (F.col("s_suppkey") % 50).cast("int").alias("Number of Employees"),
            F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("ZIP Code"),
            (F.col("s_nationkey") + F.lit(0.5)).alias("Latitude"),
            (F.col("s_acctbal") / 100).alias("Longitude"),
        )
    )


RAW = {
    "customers": raw_customers,
    "discounts": raw_discounts,
    "employees": raw_employees,
    "products": raw_products,
    "stores": raw_stores,
    "transactions": raw_transactions,
}


def shipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the month of shipping as their load stamp."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("line_total"),
        F.concat(month_code(F.col("l_shipdate")), F.lit("01000000")).alias("dt_proc"),
    )

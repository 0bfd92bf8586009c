"""Registered queries: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.retail import (
    AS_OF,
    DT_PROC,
    RAW,
    raw_transactions,
    shipped_lines,
    table,
)
from ledgerlake.functions.calendar import reference_period_columns
from ledgerlake.functions.features import DAY_PERIODS, banded, first_match
from ledgerlake.operators.audit import load_audit, read_audit
from ledgerlake.operators.book import (
    AMOUNT_MEASURES,
    AVG,
    BOOK,
    COUNT_MEASURES,
    SUM,
    BookSpec,
    feature_book,
    feature_coverage,
)
from ledgerlake.operators.dedup import exact_rows, latest_load, latest_version, restamp
from ledgerlake.operators.first_line import first_lines, mark_first_lines
from ledgerlake.operators.ingest import ingest_subject, stamp_load
from ledgerlake.operators.seen import distinct_rows
from ledgerlake.operators.snapshot import SnapshotStore
from ledgerlake.operators.stage import book_lines, categories, flags, stage_features
from ledgerlake.operators.standardise import standardise
from ledgerlake.operators.states import StateStore
from ledgerlake.operators.windows import recency_windows
from ledgerlake.plans.monthly_run import RunFailed, run_month
from ledgerlake.sources.drift import EXTRA, read_drifting
from ledgerlake.sources.landing import BAD_ROW
from ledgerlake.sources.layers import (
    LakePaths,
    append_table,
    read_table,
    register_layer,
    spread_by,
)
from ledgerlake.sources.manifest import committed_files, write_load, write_version
from ledgerlake.sources.scratch import scratch_dir, shuffles_removed
from ledgerlake.sources.subjects import SUBJECTS
from ledgerlake.streaming.landing import land_new_files

Query = Callable[[SparkSession, str], DataFrame]
FIRST_LOAD, SECOND_LOAD = "20010731000000", "20010831000000"
THIRD_LOAD = "20010831120000"


# Raw to trusted

def trusted(spark: SparkSession, sf_dir: str, subject: str) -> DataFrame:
    raw = stamp_load(RAW[subject](spark, sf_dir), DT_PROC)
    return standardise(raw, SUBJECTS[subject], DT_PROC, AS_OF)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted transactions before duplicate removal: the input of stage and book."""
    return raw_transactions(spark, sf_dir).select(
        *SUBJECTS["transactions"].trusted_columns(None), F.lit(DT_PROC).alias("dt_proc")
    )


def _loaded_twice(df: DataFrame) -> DataFrame:
    return stamp_load(df, FIRST_LOAD).unionByName(stamp_load(df, SECOND_LOAD))


def dedup_rows(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    return exact_rows(_loaded_twice(table(spark, sf_dir, "lineitem")), mode)


# Trusted to snapshot

def latest_load_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_version(shipped_lines(spark, sf_dir), ["invoice_id"])


def dedup_latest_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_load(shipped_lines(spark, sf_dir), "invoice_id")


def dedup_latest_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest day of each user and event type; events of type 'error' have no key."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        "value",
        F.substring(F.replace(F.col("ts").cast("string"), F.lit("-"), F.lit("")), 1, 8).alias(
            "dt_proc"
        ),
    )
    return latest_load(events, ["user_id", "event_type"])


def dedup_latest_discounts(spark: SparkSession, sf_dir: str, null_keys: str) -> DataFrame:
    """Campaigns repeat under one id, and those without a subcategory have none."""
    discounts = trusted(spark, sf_dir, "discounts")
    return latest_load(discounts.withColumn("dt_proc", F.col("ref")), "discount_id", null_keys=null_keys)


def refined_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restamp(latest_load(shipped_lines(spark, sf_dir), "invoice_id"), DT_PROC)


# Stage

def _with(spark: SparkSession, sf_dir: str, column: Column) -> DataFrame:
    keys = ("invoice_id", "line", "product_id")
    return transactions(spark, sf_dir).select(*keys, column)


def stage_category(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    return _with(spark, sf_dir, categories()[number])


def stage_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).select("invoice_id", "line", "product_id", *flags())


def stage_period_of_day_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("hour", F.hour("ts"))
    return events.select(
        "event_id", "hour", banded(F.col("hour"), DAY_PERIODS).alias("fbc_periodo_compra")
    )


def _marker_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("invoice_id", "customer_id", "line", "product_id", "store_id", "line_total")
    return transactions(spark, sf_dir).select(*columns)


def txn_first_line_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_first_lines(
        _marker_lines(spark, sf_dir), "invoice_id", ("customer_id", "line"), "fvl_qtd_transacoes"
    )


def txn_first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_lines(_marker_lines(spark, sf_dir), "invoice_id", ("customer_id", "line"))


def stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_features(transactions(spark, sf_dir), DT_PROC, AS_OF)


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recency_windows(
        transactions(spark, sf_dir).select("invoice_id", "line", "product_id", "date"), AS_OF
    )


def book_reference_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference period for every day of the calendar that orders were placed on."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("as_of"))
    return days.groupBy("as_of").agg(F.count("*").alias("orders")).select(
        "as_of", *reference_period_columns(F.col("as_of")), "orders"
    )


# Book

def rounded(book: DataFrame, spec: BookSpec) -> DataFrame:
    """Sums to cents and averages to six places: the order of addition then does not show."""
    amounts = {
        f.var: 2 if f.agg == SUM else 6
        for f in spec.features()
        if f.measure.lower() in AMOUNT_MEASURES and f.agg in (SUM, AVG)
    }
    return book.selectExpr(
        *(
            f"round({name}, {amounts[name]}) AS {name}" if name in amounts else name
            for name in book.columns
        )
    )


def book(spark: SparkSession, sf_dir: str, spec: BookSpec = BOOK) -> DataFrame:
    count_sales = any(measure == "fvl_qtd_transacoes" for measure, _ in spec.measures)
    lines = book_lines(transactions(spark, sf_dir), DT_PROC, AS_OF, count_sales=count_sales)
    return rounded(feature_book(recency_windows(lines, AS_OF), spec), spec)


def book_from_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feature_book(recency_windows(stage(spark, sf_dir), AS_OF)), BOOK)


def book_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The amounts as they are: exact sums need no rounding to be compared."""
    spec = replace(BOOK, measures=tuple(m for m in BOOK.measures if m[0] in AMOUNT_MEASURES))
    lines = book_lines(transactions(spark, sf_dir), DT_PROC, AS_OF, count_sales=False)
    return feature_book(recency_windows(lines, AS_OF), spec)


def book_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book from stored monthly states."""
    store = StateStore(spark, LakePaths(scratch_dir(spark, "states")).states)
    store.replace(stage(spark, sf_dir))
    return rounded(store.book(AS_OF), BOOK)


def book_after_late_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of all but the first lines of every other month, and then these lines as well."""
    store = StateStore(spark, LakePaths(scratch_dir(spark, "states")).states)
    lines = transactions(spark, sf_dir)
    is_late = (F.col("line") == 1) & (F.col("ref").cast("int") % 2 == 1)
    store.replace(stage_features(lines.where(~is_late), DT_PROC, AS_OF))
    store.refresh(lines, lines.where(is_late), DT_PROC, AS_OF)
    return rounded(store.book(AS_OF), BOOK)


def book_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each column stands for and for how many customers it has a value."""
    lines = book_lines(transactions(spark, sf_dir), DT_PROC, AS_OF)
    return feature_coverage(recency_windows(lines, AS_OF))


# Control, round trips, whole runs

def _written(df: DataFrame, path: str) -> DataFrame:
    with shuffles_removed(df.sparkSession):
        append_table(df, path)
    return df.sparkSession.read.parquet(path)


def _standardised(raw: DataFrame, subject: str) -> DataFrame:
    """Of a stored raw table; its copies are found by fingerprints."""
    return standardise(raw, SUBJECTS[subject], DT_PROC, AS_OF, distinct=distinct_rows)


def control_all_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the layers themselves. Each is built once; the next one reads what was written.

    Subjects go through the layers side by side, the stage beside the layers after raw.
    """
    paths = LakePaths(scratch_dir(spark, "control"))

    def raw_layer(subject: str) -> DataFrame:
        return _written(stamp_load(RAW[subject](spark, sf_dir), DT_PROC), paths.raw(subject))

    def later_layers(subject: str, raw: DataFrame) -> list[DataFrame]:
        standardised = _written(_standardised(raw, subject), paths.trusted(subject))
        snapshot = latest_load(standardised, SUBJECTS[subject].key, strategy="mixed")
        return [
            load_audit(raw, f"tb_raw_{subject}", DT_PROC),
            load_audit(standardised, f"tb_trusted_{subject}", DT_PROC),
            load_audit(snapshot, f"tb_refined_data_viz_{subject}", DT_PROC),
        ]

    def stage_layer(raw: DataFrame) -> DataFrame:
        lines = raw.select(*SUBJECTS["transactions"].trusted_columns(None), "dt_proc")
        return _written(stage_features(lines, DT_PROC, AS_OF), paths.stage)

    with shuffles_removed(spark), ThreadPoolExecutor(max_workers=len(RAW) + 1) as pool:
        raw_tables = dict(zip(RAW, pool.map(raw_layer, RAW)))
        layers = pool.map(later_layers, RAW, raw_tables.values())
        staged = pool.submit(stage_layer, raw_tables["transactions"]).result()
        rows = [row for subject in layers for row in subject]
    rows += [
        load_audit(staged, "tb_refined_stage", DT_PROC),
        load_audit(feature_book(recency_windows(staged, AS_OF)), "tb_refined_book", DT_PROC),
    ]
    return reduce(DataFrame.unionByName, rows)


def refined_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One SQL question over layers that are registered as views."""
    paths = LakePaths(scratch_dir(spark, "views"))
    for subject in ("customers", "transactions"):
        raw = _written(stamp_load(RAW[subject](spark, sf_dir), DT_PROC), paths.raw(subject))
        snapshot = latest_load(_standardised(raw, subject), SUBJECTS[subject].key, strategy="mixed")
        append_table(restamp(snapshot, DT_PROC), paths.snapshot(subject), ("dt_proc",))
    register_layer(
        spark, {f"tb_refined_{s}": paths.snapshot(s) for s in ("customers", "transactions")}
    )
    return spark.sql(
        """
        SELECT c.country, t.payment_method, t.dt_proc, count(*) AS lines,
               count(DISTINCT t.invoice_id) AS invoices, sum(t.quantity) AS items
        FROM tb_refined_transactions t JOIN tb_refined_customers c USING (customer_id)
        GROUP BY ALL
        """
    )


def _write_csv(df: DataFrame, path: str) -> None:
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def ingest_csv_roundtrip(spark: SparkSession, sf_dir: str, subject: str) -> DataFrame:
    """Table to CSV landing file to raw Parquet, read back with its load as partition."""
    paths = LakePaths(scratch_dir(spark, "ingest"))
    _write_csv(RAW[subject](spark, sf_dir), paths.landing(subject))
    raw = ingest_subject(spark, paths.landing(subject), SUBJECTS[subject], DT_PROC)
    append_table(raw, paths.raw(subject), ("dt_proc",))
    return read_table(spark, paths.raw(subject), DT_PROC)


def write_by_ref_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = LakePaths(scratch_dir(spark, "by-ref")).trusted("transactions")
    append_table(spread_by(transactions(spark, sf_dir), "ref"), path, ("ref",))
    return spark.read.parquet(path).select(
        "invoice_id", "line", "product_id", "line_total", "dt_proc", "ref"
    )


def load_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that is written again, and a later write that never came to its commit."""
    path = LakePaths(scratch_dir(spark, "replaced")).raw("orders")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    wrong = orders.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_load(orders, path, FIRST_LOAD, ("o_orderpriority",))
    write_load(wrong, path, SECOND_LOAD, ("o_orderpriority",))
    write_load(orders, path, SECOND_LOAD, ("o_orderpriority",))
    write_version(wrong, path, SECOND_LOAD, ("o_orderpriority",))
    return read_table(spark, path, SECOND_LOAD)


def _deliver(
    spark: SparkSession, paths: LakePaths, subject: str, deliveries: Sequence[tuple[str, date, DataFrame]],
    **options,
) -> None:
    """One monthly run after the other, each with a landing file of its own."""
    for load, as_of, rows in deliveries:
        _write_csv(rows, paths.landing(subject))
        run_month(spark, paths, load, as_of, subjects=(SUBJECTS[subject],), **options)


def _three_deliveries(df: DataFrame, number: Column) -> list[tuple[str, date, DataFrame]]:
    """Two parts that overlap, and then everything; `number` goes from 1 to 7."""
    return [
        (FIRST_LOAD, date(2001, 7, 31), df.where(number <= 3)),
        (SECOND_LOAD, AS_OF, df.where(number.between(2, 5))),
        (THIRD_LOAD, AS_OF, df),
    ]


def trusted_new_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries that share rows: each row once, under the load that brought it first."""
    paths = LakePaths(scratch_dir(spark, "new-loads"))
    lines = RAW["transactions"](spark, sf_dir)
    _deliver(
        spark, paths, "transactions", _three_deliveries(lines, F.col("Line")), steps=("raw", "trusted")
    )
    return read_table(spark, paths.trusted("transactions"))


def snapshot_new_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot after three deliveries; the age is that of the last run in every row."""
    paths = LakePaths(scratch_dir(spark, "new-loads"))
    customers = RAW["customers"](spark, sf_dir)
    number = (F.col("Customer ID") % 7 + 1).cast("int")
    _deliver(
        spark, paths, "customers", _three_deliveries(customers, number),
        steps=("raw", "trusted", "refined"),
    )
    return read_table(spark, paths.snapshot("customers"), THIRD_LOAD)


YEARS = ((1994, FIRST_LOAD), (1997, SECOND_LOAD), (9999, THIRD_LOAD))


def snapshot_by_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads merged one after the other; the seventh lines have no key."""
    key = F.when(F.col("l_linenumber") != 7, F.col("l_orderkey"))
    lines = table(spark, sf_dir, "lineitem").select(
        key.alias("invoice_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"), F.col("l_extendedprice").alias("line_total"),
        first_match((F.year("l_shipdate") < year, load) for year, load in YEARS).alias("dt_proc"),
    )
    path = LakePaths(scratch_dir(spark, "changes")).snapshot("transactions")
    store = SnapshotStore(spark, path, "invoice_id", buckets=8, null_keys="keep")
    for _, load in YEARS:
        store.apply(lines.where(F.col("dt_proc") == load), load)
    return store.rows()


def _layer_tables(paths: LakePaths) -> dict[str, str]:
    layers = (("tb_raw", paths.raw), ("tb_trusted", paths.trusted), ("tb_refined_data_viz", paths.snapshot))
    tables = {f"{prefix}_{subject}": path(subject) for prefix, path in layers for subject in SUBJECTS}
    return tables | {"tb_refined_stage": paths.stage, "tb_refined_book": paths.book}


def control_against_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a whole run committed, and rows in the files, by their footers."""
    paths = _lake_after_run(spark, sf_dir)
    counted = [
        committed_files(spark, path).select(
            F.lit(name).alias("tb_name"), F.col("dt_proc").cast("bigint").alias("dt_proc"),
            F.col("committed_rows").alias("qtd_registros"), "found_rows",
        )
        for name, path in _layer_tables(paths).items()
    ]
    return reduce(DataFrame.unionByName, counted)


def _control_rows(spark: SparkSession, paths: LakePaths) -> DataFrame:
    layers = [read_audit(spark, paths.control(x)) for x in ("raw", "trusted", "refined")]
    return reduce(DataFrame.unionByName, layers)


def _run_without_products(spark: SparkSession, sf_dir: str) -> LakePaths:
    paths = LakePaths(scratch_dir(spark, "faulty"))
    for subject, raw in RAW.items():
        if subject != "products":
            _write_csv(raw(spark, sf_dir), paths.landing(subject))
    try:
        run_month(spark, paths, DT_PROC, AS_OF)
    except RunFailed as failed:
        if set(failed.report.failures) != {"tb_raw_products"}:
            raise
    return paths


def faulty_run_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run in which one subject has no landing file: the others go through all layers."""
    return _control_rows(spark, _run_without_products(spark, sf_dir))


def resumed_run_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run, gone on with after the missing file came."""
    paths = _run_without_products(spark, sf_dir)
    _write_csv(RAW["products"](spark, sf_dir), paths.landing("products"))
    report = run_month(spark, paths, DT_PROC, AS_OF, resume=True)
    if [name for name in report.rows if "products" not in name] != report.resumed:
        raise AssertionError("a step was done again")
    return _control_rows(spark, paths)


def landing_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of files in which the seventh lines have no number: both tables, after two runs."""
    paths = LakePaths(scratch_dir(spark, "rejected"))
    spec = SUBJECTS["employees"]
    employees = RAW["employees"](spark, sf_dir)
    key = F.col("Employee ID").cast("string")
    broken = employees.withColumn(
        "Employee ID", F.when(F.col("Employee ID") % 10 == 7, F.concat(F.lit("no "), key)).otherwise(key)
    )
    _write_csv(broken, paths.landing("employees-1"))
    for load in (FIRST_LOAD, SECOND_LOAD):
        land_new_files(
            spark, paths.landing_drops("employees"), spec, load, paths.raw("employees"),
            f"{paths.root}/checkpoint", on_bad_row="reject", rejected_path=paths.rejected("employees"),
        )
    fitting = read_table(spark, paths.raw("employees")).withColumn(BAD_ROW, F.lit(None).cast("string"))
    return fitting.unionByName(read_table(spark, paths.rejected("employees")))


def landing_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drops of products: as specified, in another order with a new column, and without one."""
    folder = LakePaths(scratch_dir(spark, "drift")).landing("products")
    products = RAW["products"](spark, sf_dir)
    key = F.col("Product ID")
    other_order = products.select(*reversed(products.columns)).withColumn(
        "Season", F.when(key % 2 == 0, F.concat(F.lit("S"), (key % 4).cast("string")))
    ).withColumnRenamed("Sub Category", "sub_category")
    _write_csv(products.where(key % 3 == 0), f"{folder}/first")
    _write_csv(other_order.where(key % 3 == 1), f"{folder}/second")
    _write_csv(products.where(key % 3 == 2).drop("Color"), f"{folder}/third")
    fitting, rejected = read_drifting(spark, f"{folder}/*", SUBJECTS["products"])
    return fitting.unionByName(rejected.drop(BAD_ROW)).withColumn(
        EXTRA, F.col(EXTRA)["Season"]
    ).withColumnRenamed(EXTRA, "season")


def landing_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of CSV files, two incremental runs: each file is taken in once."""
    paths = LakePaths(scratch_dir(spark, "landing"))
    spec = SUBJECTS["products"]
    products = RAW["products"](spark, sf_dir)
    for number, load in enumerate((FIRST_LOAD, SECOND_LOAD)):
        drop = paths.landing(f"products-{number}")
        _write_csv(products, drop)
        land_new_files(
            spark, paths.landing_drops("products"), spec, load,
            paths.raw("products"), f"{paths.root}/checkpoint",
        )
    return spark.read.parquet(paths.raw("products"))


def _lake_after_run(spark: SparkSession, sf_dir: str, runs: int = 1) -> LakePaths:
    paths = LakePaths(scratch_dir(spark, "lake"))
    for subject, raw in RAW.items():
        _write_csv(raw(spark, sf_dir), paths.landing(subject))
    for _ in range(runs):
        run_month(spark, paths, DT_PROC, AS_OF)
    return paths


def monthly_run_control(spark: SparkSession, sf_dir: str, runs: int = 1) -> DataFrame:
    """Control rows of all layers after a whole run from CSV files to the book."""
    return _control_rows(spark, _lake_after_run(spark, sf_dir, runs))


def monthly_run_book(spark: SparkSession, sf_dir: str, runs: int = 1) -> DataFrame:
    paths = _lake_after_run(spark, sf_dir, runs)
    return rounded(read_table(spark, paths.book, DT_PROC).drop("dt_proc"), BOOK)


BOOK_PARTS: dict[str, tuple[str, Sequence[str]]] = {
    f"book_{kind}_{name}": (dim, measures)
    for kind, measures in (("amount", AMOUNT_MEASURES), ("counts", COUNT_MEASURES))
    for name, dim in (
        ("day", "fbc_dia_compra"),
        ("period", "fbc_periodo_compra"),
        ("payment", "fbc_metodo_pagamento"),
        ("currency", "fbc_moeda"),
    )
}

QUERIES: dict[str, Query] = {
    **{f"trusted_{subject}": partial(trusted, subject=subject) for subject in RAW},
    "dedup_exact_rows": partial(dedup_rows, mode="business"),
    "dedup_exact_rows_per_load": partial(dedup_rows, mode="with_load"),
    "latest_load_per_key": latest_load_per_key,
    "dedup_latest_transactions": dedup_latest_transactions,
    "dedup_latest_dims": dedup_latest_dims,
    "dedup_latest_discounts": partial(dedup_latest_discounts, null_keys="drop"),
    "dedup_latest_discounts_null_key": partial(dedup_latest_discounts, null_keys="keep"),
    "refined_snapshot": refined_snapshot,
    "stage_day_of_week": partial(stage_category, number=0),
    "stage_period_of_day": partial(stage_category, number=1),
    "stage_payment_recode": partial(stage_category, number=2),
    "stage_currency_recode": partial(stage_category, number=3),
    "stage_flags": stage_flags,
    "stage_period_of_day_events": stage_period_of_day_events,
    "txn_first_line_marker": txn_first_line_marker,
    "txn_first_lines": txn_first_lines,
    "stage_features": stage,
    "recency_windows": windows,
    "book_reference_period": book_reference_period,
    **{
        name: partial(book, spec=BOOK.only(dim, measures))
        for name, (dim, measures) in BOOK_PARTS.items()
    },
    "book_full": book,
    "book_full_from_stage": book_from_stage,
    "book_exact": book_exact,
    "book_from_states": book_from_states,
    "book_after_late_lines": book_after_late_lines,
    "book_dictionary": book_dictionary,
    "control_all_layers": control_all_layers,
    "refined_views": refined_views,
    **{
        f"ingest_csv_{subject}": partial(ingest_csv_roundtrip, subject=subject)
        for subject in RAW
        if subject != "transactions"
    },
    "ingest_csv_roundtrip": partial(ingest_csv_roundtrip, subject="transactions"),
    "write_by_ref_roundtrip": write_by_ref_roundtrip,
    "landing_incremental": landing_incremental,
    "landing_rejected": landing_rejected,
    "landing_drift": landing_drift,
    "load_replaced": load_replaced,
    "trusted_new_loads": trusted_new_loads,
    "snapshot_new_loads": snapshot_new_loads,
    "snapshot_by_change": snapshot_by_change,
    "control_against_files": control_against_files,
    "faulty_run_control": faulty_run_control,
    "resumed_run_control": resumed_run_control,
    "monthly_run_control": monthly_run_control,
    "monthly_run_book": monthly_run_book,
    "monthly_run_repeated": partial(monthly_run_book, runs=2),
    "monthly_run_repeated_control": partial(monthly_run_control, runs=2),
}

"""Control rows: how many records each load wrote."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CONTROL_SCHEMA = "tb_name string, dt_proc bigint, qtd_registros bigint"


def load_audit(table: DataFrame, tb_name: str, dt_proc: str) -> DataFrame:
    """One control row, counted from the table itself."""
    return table.agg(F.count("*").alias("qtd_registros")).select(
        F.lit(tb_name).alias("tb_name"),
        F.lit(dt_proc).cast("bigint").alias("dt_proc"),
        "qtd_registros",
    )


def audit_rows(spark: SparkSession, counts: Iterable[tuple[str, str, int]]) -> DataFrame:
    """Control rows from counts that are already known, always with the same types."""
    rows = [(name, int(dt_proc), count) for name, dt_proc, count in counts]
    return spark.createDataFrame(rows, CONTROL_SCHEMA)


def counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write `df` and return how many rows the write itself saw; no second pass."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def write_audit(rows: DataFrame | Iterable[DataFrame], path: str) -> None:
    """Control rows as small files, one row per table and load: a later one replaces it."""
    if not isinstance(rows, DataFrame):
        rows = reduce(DataFrame.unionByName, rows)
    (
        rows.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("tb_name", "dt_proc")
        .parquet(path)
    )


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONTROL_SCHEMA).parquet(path).select(
        "tb_name", "dt_proc", "qtd_registros"
    )

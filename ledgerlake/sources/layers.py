"""Directory layout of the lake and the Parquet readers and writers of its layers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.manifest import CODEC, committed, current, open_loads


@dataclass(frozen=True)
class LakePaths:
    """Every location below one root; works for any file system Spark can reach."""

    root: str

    # Directory and table names of the layers.

    def landing(self, subject: str) -> str:
        return f"{self.root}/01_transient/{subject}.csv"

    def landing_drops(self, subject: str) -> str:
        """Pattern of all files dropped for a subject, for incremental landing."""
        return f"{self.root}/01_transient/{subject}*.csv"

    def landing_archive(self, subject: str) -> str:
        return f"{self.root}/00_archive/{subject}"

    def rejected(self, subject: str) -> str:
        """Landing rows that do not fit the schema."""
        return f"{self.root}/02_raw/_rejected/tb_{subject}"

    def seen(self, subject: str) -> str:
        """Index of the rows that earlier loads brought."""
        return f"{self.root}/03_trusted/_seen/tb_{subject}"

    def landing_checkpoint(self, subject: str) -> str:
        return f"{self.root}/02_raw/_landed/tb_{subject}"

    def raw(self, subject: str) -> str:
        return f"{self.root}/02_raw/tb_{subject}"

    def trusted(self, subject: str) -> str:
        return f"{self.root}/03_trusted/tb_{subject}"

    def snapshot(self, subject: str) -> str:
        return f"{self.root}/04_refined/data_viz/tb_{subject}"

    @property
    def stage(self) -> str:
        return f"{self.root}/04_refined/stage"

    @property
    def states(self) -> str:
        """Monthly states that books are put together from."""
        return f"{self.root}/04_refined/states"

    @property
    def book(self) -> str:
        return f"{self.root}/04_refined/book"

    def control(self, layer: str) -> str:
        return f"{self.root}/05_controle/{layer}"


def read_table(spark: SparkSession, path: str, dt_proc: str | None = None) -> DataFrame:
    """A whole layer table, or one load of it.

    Of a table whose writes are committed in a log, only what counts is opened. `dt_proc` prunes directories where the load is the partition column and is
    pushed into the Parquet scan where it is a file column. Comparing with a
    number or a string literal depends on which of the two it is. `ref` is a
    number even where only loads without rows are there to infer it from.
    """
    versions = committed(spark, path)
    df = open_loads(spark, path, current(versions), dt_proc) if versions else spark.read.parquet(path)
    if dict(df.dtypes).get("ref", "int") != "int":
        df = df.withColumn("ref", F.col("ref").cast("int"))
    if dt_proc is None:
        return df
    is_text = dict(df.dtypes)["dt_proc"] == "string"
    return df.where(F.col("dt_proc") == F.lit(dt_proc if is_text else int(dt_proc)))


def newest_load(df: DataFrame, version: str = "dt_proc") -> DataFrame:
    """Only the rows of the newest load of the table.

    The newest stamp is a scalar subquery: with a partition column it reads no
    data columns, and the main scan then opens only the matching directories.
    """
    newest = df.agg(F.max(version)).scalar()
    return df.where(F.col(version) == newest)


def spread_by(df: DataFrame, *columns: str) -> DataFrame:
    """Group rows by the partition columns they will be written under.

    For partition columns with many values: without it every task writes a file
    into every directory. Adaptive execution cuts a directory that holds most of
    the rows into several tasks, so one hot month does not become one hot task.
    """
    return df.hint("rebalance", *columns)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path, compression=CODEC)


def load_folder(path: str, dt_proc: str) -> str:
    return f"{path}/dt_proc={dt_proc}"


def replace_load(
    df: DataFrame, path: str, dt_proc: str, partition_by: Sequence[str] = ()
) -> None:
    """Write one load of a table in place of what an earlier run left of it.

    The folder of the load is written anew, so a repeated run changes nothing and other
    loads stay untouched, empty loads included. The stamp becomes the partition column.
    A write that dies has already deleted the earlier load; `manifest.write_load` keeps it.
    """
    (
        df.drop("dt_proc")
        .write.mode("overwrite")
        .partitionBy(*partition_by)
        .parquet(load_folder(path, dt_proc))
    )


def register_layer(spark: SparkSession, locations: dict[str, str]) -> None:
    """Publish Parquet tables as temp views for SQL users, replacing older ones."""
    for view, path in locations.items():
        read_table(spark, path).createOrReplaceTempView(view)

"""Written tables in the cluster's shared folder: lineage is cut where executors may be lost."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.sources.scratch import CLEANUP, scratch_dir, shuffles_removed  # noqa: F401


def written(df: DataFrame, purpose: str, made: dict[str, str] | None = None) -> DataFrame:
    """`df` as a Parquet table below spark.checkpoint.dir, read again. `made` gets its folder by purpose."""
    path = scratch_dir(df.sparkSession, purpose)
    if made is not None:
        made[purpose] = path
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 2_000) -> Iterator[None]:
    """Jobs in this block hand whole texts to Python in batches of fewer rows, which both sides hold at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(spark: SparkSession, made: dict[str, str], *purposes: str) -> None:
    """Removes written tables that nothing reads any more: what came of them is written itself."""
    for purpose in purposes:
        folder = spark._jvm.org.apache.hadoop.fs.Path(made.pop(purpose))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

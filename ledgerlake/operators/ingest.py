"""Landing to raw."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.landing import read_landing
from ledgerlake.sources.subjects import SubjectSpec


def stamp_load(df: DataFrame, dt_proc: str) -> DataFrame:
    """Add the load stamp as last column."""
    return df.withColumn("dt_proc", F.lit(dt_proc))


def ingest_subject(
    spark: SparkSession, path: str, spec: SubjectSpec, dt_proc: str, **reader_options
) -> DataFrame:
    return stamp_load(read_landing(spark, path, spec, **reader_options), dt_proc)

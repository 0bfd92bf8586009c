"""CSV landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.subjects import SubjectSpec

BAD_ROW = "rejected_row"


def read_landing(
    spark: SparkSession,
    path: str,
    spec: SubjectSpec,
    *,
    infer: bool = False,
    on_bad_row: str = "FAILFAST",
    **options: str,
) -> DataFrame:
    """A landing file with the subject's schema, or with an inferred one.

    The header has to match the schema by name, so reordered columns are an
    error and not a silent mix-up. Inference costs a second pass over the file
    and lets types drift from month to month; it is opt-in.
    """
    reader = spark.read.option("header", True).options(**options)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return (
        reader.schema(spec.landing_schema)
        .option("enforceSchema", False)
        .option("mode", on_bad_row)
        .csv(path)
    )


def split_landing(
    spark: SparkSession, path: str, spec: SubjectSpec, **options: str
) -> tuple[DataFrame, DataFrame]:
    """Rows of a landing file that fit the subject's schema, and those that do not.

    A rejected row has its text in `rejected_row` and the values that could be read.
    """
    with_text = f"{spec.landing_schema}, `{BAD_ROW}` STRING"
    rows = (
        spark.read.option("header", True)
        .options(**options)
        .schema(with_text)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_ROW)
        # The whole row decides whether it fits, not only the columns that are asked for.
        .option("columnPruning", False)
        .csv(path)
    )
    bad = F.col(BAD_ROW).isNotNull()
    return rows.where(~bad).drop(BAD_ROW), rows.where(bad)

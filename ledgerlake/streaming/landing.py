"""Landing files as a stream: each file is taken in exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators.ingest import stamp_load
from ledgerlake.sources.landing import BAD_ROW
from ledgerlake.sources.manifest import commit, committed, write_version
from ledgerlake.sources.subjects import SubjectSpec


def land_new_files(
    spark: SparkSession,
    drops: str,
    spec: SubjectSpec,
    dt_proc: str,
    raw_path: str,
    checkpoint: str,
    *,
    clean: str = "off",
    archive_dir: str | None = None,
    files_per_batch: int | None = None,
    on_bad_row: str = "FAILFAST",
    rejected_path: str | None = None,
) -> StreamingQuery:
    """Append all files that are new since the last call to raw, and stop.

    The checkpoint remembers the files that were taken in and the sink commits a
    batch as a whole, so a run that died is simply repeated. `clean` removes
    ("delete") or moves ("archive") a landing file, and Spark does so only after
    the batch that read it was committed - as a rule in the following run.

    `on_bad_row` is the mode of the CSV reader: a row that does not fit the schema stops the
    run, or is read with NULLs ("PERMISSIVE") or left out ("DROPMALFORMED"). With "reject" it goes
    to the table at `rejected_path` with its text, and the others on. Both tables are then
    written through their logs (`sources.manifest`), a batch at a time. A raw table keeps to
    one of the two ways, and to its checkpoint.
    """
    reject = on_bad_row == "reject"
    if reject and rejected_path is None:
        raise ValueError("rejected rows need a rejected_path")
    schema = f"{spec.landing_schema}, `{BAD_ROW}` STRING" if reject else spec.landing_schema
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE" if reject else on_bad_row)
        .option("cleanSource", clean)
    )
    if reject:
        reader = reader.option("columnNameOfCorruptRecord", BAD_ROW).option("columnPruning", False)
    if archive_dir is not None:
        reader = reader.option("sourceArchiveDir", archive_dir)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    landed = stamp_load(reader.csv(drops), dt_proc)
    if reject:
        writer = landed.writeStream.foreachBatch(
            lambda batch, number: take_batch(batch, number, dt_proc, raw_path, rejected_path)
        )
    else:
        writer = landed.writeStream.format("parquet").partitionBy("dt_proc").option("path", raw_path)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def take_batch(batch: DataFrame, number: int, dt_proc: str, raw_path: str, rejected_path: str) -> None:
    """Add the rows of a batch that fit to raw and the others to the rejected rows.

    A batch that comes again, because the run died before its checkpoint, finds itself in the
    logs: what was committed is not written twice, under whatever stamp the run is repeated, and
    what was not is written anew. Both tables get a version even from a batch without rows for them.
    """
    spark, version = batch.sparkSession, f"batch-{number}"
    bad = F.col(BAD_ROW).isNotNull()
    for rows, path in ((batch.where(bad), rejected_path), (batch.where(~bad).drop(BAD_ROW), raw_path)):
        if version not in [v.version for v in committed(spark, path) or []]:
            commit(spark, path, write_version(rows, path, dt_proc, version=version, adds=True))

"""Loads that are replaced as a whole: every write has a folder of its own, and a log says which count.

    <table>/dt_proc=20010831000000/version=v4f.../[ref=200108/]*.parquet
    <table>/_loads/*.json          one row for each committed write

A write that died left a folder without a row in the log: no reader looks there, and the load
it should have replaced is still the one that counts. A row of the log is one small file that
appears by a single rename or put, so a reader sees either the old load or the new one.
One writer at a time per table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.operators.audit import counted_write

CODEC = "zstd"  # of the files of all tables with a log; readers take any
PARTS, PART_ROWS = 6, 1_000_000  # of a table that is worked through part by part
LOG_SCHEMA = "entry bigint, dt_proc string, version string, adds boolean, rows bigint"


@dataclass(frozen=True)
class Version:
    """A written folder of a load. `adds` puts it beside what the load has, else it replaces that."""

    dt_proc: str
    version: str
    rows: int
    adds: bool = False


def _log(path: str) -> str:
    return f"{path}/_loads"


def _file_system(spark: SparkSession, path: str):
    """A path of any file system that Spark reaches, and that file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def version_folder(path: str, dt_proc: str, version: str) -> str:
    return f"{path}/dt_proc={dt_proc}/version={version}"


def committed(spark: SparkSession, path: str) -> list[Version] | None:
    """Every committed write in order; None for a table without a log.

    The log has one row per write of a load: a few for each month.
    """
    folder, files = _file_system(spark, _log(path))
    if not files.exists(folder):
        return None
    log = spark.read.schema(LOG_SCHEMA).json(_log(path))
    return [
        Version(r["dt_proc"], r["version"], r["rows"], r["adds"])
        for r in sorted(log.collect(), key=lambda r: r["entry"])
    ]


def current(versions: Iterable[Version]) -> dict[str, list[Version]]:
    """The versions that count, by load: the last one that replaces, and those added since."""
    loads: dict[str, list[Version]] = {}
    for version in versions:
        if version.adds:
            known = loads.setdefault(version.dt_proc, [])
            if version.version not in [v.version for v in known]:
                known.append(version)
        else:
            loads[version.dt_proc] = [version]
    return loads


def in_parts(df: DataFrame, *columns: str, rows: int | None = None) -> list[DataFrame]:
    """Deal out a table of so many rows by a hash of `columns`, to be worked through part by part.

    A shuffle then holds the rows of one part at a time. Each part reads the table once more, so
    there are `PARTS` of them at most, whatever the size, and fewer or one where `rows` are few.
    """
    parts = PARTS if rows is None else min(max(rows // PART_ROWS, 1), PARTS)
    if parts == 1:
        return [df]
    number = F.pmod(F.xxhash64(*columns), F.lit(parts))
    return [df.where(number == part) for part in range(parts)]


def _write(df: DataFrame, folder: str, mode: str, partition_by: Sequence[str]) -> int:
    return counted_write(
        df.drop("dt_proc"),
        lambda counted: counted.write.mode(mode).partitionBy(*partition_by).parquet(folder, compression=CODEC),
    )


def write_version(
    df: DataFrame | Sequence[DataFrame], path: str, dt_proc: str, partition_by: Sequence[str] = (), *,
    version: str | None = None, adds: bool = False,
) -> Version:
    """Write the rows of a load into a new folder, which counts once it is committed.

    Several tables, the parts of a load, are written one after the other, each by a job of its own.
    A partitioned write without rows leaves no file; a file without rows in the NULL partition
    then keeps the names and types of the columns.
    """
    version = version or f"v{uuid4().hex}"
    folder = version_folder(path, dt_proc, version)
    first, *others = [df] if isinstance(df, DataFrame) else df
    rows = _write(first, folder, "overwrite", partition_by)
    rows += sum(_write(part, folder, "append", partition_by) for part in others)
    if rows == 0 and partition_by:
        null_partition = "/".join(f"{name}=__HIVE_DEFAULT_PARTITION__" for name in partition_by)
        empty = first.limit(0).drop("dt_proc", *partition_by)
        empty.write.mode("overwrite").parquet(f"{folder}/{null_partition}")
    return Version(dt_proc, version, rows, adds)


def counting_rows(spark: SparkSession, path: str) -> int:
    """Rows of all loads of a table, by its log."""
    return sum(v.rows for versions in current(committed(spark, path) or []).values() for v in versions)


def commit(spark: SparkSession, path: str, *versions: Version) -> None:
    """Let versions count from now on, several of them at once."""
    entry = len(committed(spark, path) or [])
    rows = [(entry + k, v.dt_proc, v.version, v.adds, v.rows) for k, v in enumerate(versions)]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").json(_log(path))


def write_load(
    df: DataFrame | Sequence[DataFrame], path: str, dt_proc: str, partition_by: Sequence[str] = ()
) -> int:
    """Write one load in place of what the table has of it; returns its number of rows."""
    version = write_version(df, path, dt_proc, partition_by)
    spark = df.sparkSession if isinstance(df, DataFrame) else df[0].sparkSession
    commit(spark, path, version)
    return version.rows


def write_loads(
    df: DataFrame, path: str, column: str, loads: Sequence[str], *, version_prefix: str = "v"
) -> dict[str, int]:
    """Write several loads in one job, by the values of `column`, and commit them together.

    A load without rows is written empty. Returns the rows of each.
    """
    spark, name = df.sparkSession, f"{version_prefix}{uuid4().hex}"
    named = df.withColumnRenamed(column, "dt_proc").withColumn("version", F.lit(name))
    total = counted_write(
        named,
        lambda counted: counted.write.mode("append").partitionBy("dt_proc", "version").parquet(path, compression=CODEC),
    )
    rows = {}
    if total:
        written = spark.read.option("basePath", path).parquet(version_folder(path, "*", name))
        rows = {str(r["dt_proc"]): r["count"] for r in written.groupBy("dt_proc").count().collect()}
    versions = [Version(load, name, n) for load, n in rows.items()]
    empty = df.limit(0).drop(column)
    versions += [
        write_version(empty, path, load, version=name) for load in loads if load not in rows
    ]
    commit(spark, path, *versions)
    return {v.dt_proc: v.rows for v in versions}


def open_loads(
    spark: SparkSession, path: str, loads: dict[str, list[Version]], dt_proc: str | None = None
) -> DataFrame:
    """The committed folders of a table, or of one load of it, and no others."""
    chosen = {dt_proc: loads[dt_proc]} if dt_proc in loads else loads
    folders = [
        version_folder(path, load, v.version) for load, versions in chosen.items() for v in versions
    ]
    return spark.read.option("basePath", path).parquet(*folders).drop("version")


def committed_files(spark: SparkSession, path: str) -> DataFrame:
    """What the files of a table hold against what was committed: one row for each version that counts.

    dt_proc, version, committed_rows, found_files, found_rows. Only the footers of the files
    are read. Files that nobody committed are left out, a version without files counts as 0.
    """
    versions = [v for loads in current(committed(spark, path) or []).values() for v in loads]
    schema = "dt_proc string, version string, committed_rows bigint"
    expected = spark.createDataFrame([(v.dt_proc, v.version, v.rows) for v in versions], schema)
    name = F.col("_metadata.file_path")
    part = lambda key: F.regexp_extract(name, f"/{key}=([^/]+)/", 1).alias(key)
    found = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        .schema(StructType([])).parquet(path).select(part("dt_proc"), part("version"), name.alias("file"))
        .groupBy("dt_proc", "version", "file").agg(F.count("*").alias("rows"))
        .groupBy("dt_proc", "version")
        .agg(F.count("*").alias("found_files"), F.sum("rows").alias("found_rows"))
    )
    joined = expected.join(found, ["dt_proc", "version"], "left")
    return joined.fillna(0, ["found_files", "found_rows"])


def remove_replaced(spark: SparkSession, path: str, dt_proc: str = "*") -> list[str]:
    """Delete the folders of a table, or of one load, that no longer count or never did; returns their names.

    Not while someone writes to the table or reads an older version of it.
    """
    counting = {
        (load, v.version) for load, versions in current(committed(spark, path) or []).items()
        for v in versions
    }
    if not counting:
        return []
    pattern, files = _file_system(spark, version_folder(path, dt_proc, "*"))
    removed = []
    for status in files.globStatus(pattern):
        folder = status.getPath()
        load = folder.getParent().getName().removeprefix("dt_proc=")
        if (load, folder.getName().removeprefix("version=")) not in counting:
            files.delete(folder, True)
            removed.append(folder.getName())
    return removed

"""Landing files whose headers differ from drop to drop.

Files are grouped by their header line; every group is read with a schema in the order of its
own header, and all groups come out with the subject's columns. What a file lacks is NULL, what it
has besides is kept as text in a map.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.landing import BAD_ROW
from ledgerlake.sources.subjects import SubjectSpec

EXTRA = "extra_columns"


@dataclass(frozen=True)
class HeaderGroup:
    """Files with one header, and how it compares with the subject's."""

    header: tuple[str, ...]
    files: tuple[str, ...]
    missing: tuple[str, ...]
    extra: tuple[str, ...]
    reordered: bool


class HeaderMismatch(ValueError):
    """A file lacks a column that has to be there, or names one twice."""


def _name(header: str) -> str:
    """Headers that differ only in case, blanks or underscores are one."""
    return re.sub(r"[\s_]+", " ", header.strip().lstrip("﻿")).casefold()


def header_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """file and header: the first line of every file.

    Lines are numbered as they are read, so the first line of a file is that with the smallest
    number among the lines of its first block. Of every task only one line for each file goes on.
    """
    lines = spark.read.option("encoding", encoding).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("number"), "value",
    )
    first = F.min_by("value", "number").alias("header")
    return lines.where("start = 0").groupBy("file").agg(first)


def reconcile(header: tuple[str, ...], files: tuple[str, ...], spec: SubjectSpec, required: tuple[str, ...]) -> HeaderGroup:
    wanted = {_name(h): h for h, _, _ in spec.landing}
    found = [_name(h) for h in header]
    twice = {h for h in found if h in wanted and found.count(h) > 1}
    missing = tuple(h for name, h in wanted.items() if name not in found)
    lacking = [h for h in missing if h in required]
    if twice or lacking:
        what = f"names {sorted(twice)} twice" if twice else f"lacks {lacking}"
        raise HeaderMismatch(f"{files[0]} {what}")
    known = [name for name in found if name in wanted]
    return HeaderGroup(
        header, files, missing, tuple(h for h, name in zip(header, found) if name not in wanted),
        known != [name for name in wanted if name in known],
    )


def header_groups(
    spark: SparkSession, path: str, spec: SubjectSpec, *, required: tuple[str, ...] | None = None,
    separator: str = ",",
) -> list[HeaderGroup]:
    """The files below `path` by their header; empty files have none and are left out.

    What comes to the driver is one line for each file. `required` headers may not be missing; without
    it that is the header of the subject's key, if the key is a landing column.
    """
    if required is None:
        required = tuple(h for h, _, target in spec.landing if target == spec.key)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for row in header_lines(spark, path).orderBy("file").collect():
        header = tuple(next(csv.reader([row["header"]], delimiter=separator)))
        by_header.setdefault(header, []).append(row["file"])
    return [reconcile(h, tuple(files), spec, required) for h, files in by_header.items()]


def _read_group(spark: SparkSession, group: HeaderGroup, spec: SubjectSpec, separator: str) -> DataFrame:
    """The rows of one group with the subject's columns, the extra ones and the text of bad rows."""
    kinds = {_name(h): (h, kind) for h, kind, _ in spec.landing}
    places, columns = [], {}
    for number, header in enumerate(group.header):
        known = kinds.get(_name(header))
        places.append(f"`c{number}` {known[1] if known else 'STRING'}")
        if known:
            columns[known[0]] = F.col(f"c{number}")
    rows = (
        spark.read.schema(", ".join([*places, f"`{BAD_ROW}` STRING"]))
        .option("header", True).option("sep", separator).option("mode", "PERMISSIVE")
        # The header was compared already, by name and not by place.
        .option("enforceSchema", True)
        .option("columnNameOfCorruptRecord", BAD_ROW).option("columnPruning", False)
        .csv(list(group.files))
    )
    wanted = [columns.get(h, F.lit(None)).cast(kind).alias(h) for h, kind, _ in spec.landing]
    extra = [
        (header, F.col(f"c{number}")) for number, header in enumerate(group.header) if header in group.extra
    ]
    return rows.select(*wanted, _extra_map(extra).alias(EXTRA), BAD_ROW)


def _extra_map(extra: list[tuple[str, Column]]) -> Column:
    if not extra:
        return F.lit(None).cast("map<string,string>")
    entries = [F.struct(F.lit(name).alias("key"), value.alias("value")) for name, value in extra]
    present = F.filter(F.array(*entries), lambda e: e["value"].isNotNull())
    return F.when(F.size(present) > 0, F.map_from_entries(present))


def read_drifting(
    spark: SparkSession, path: str, spec: SubjectSpec, *, required: tuple[str, ...] | None = None,
    separator: str = ",",
) -> tuple[DataFrame, DataFrame]:
    """Rows of all files that fit the subject, and those that do not.

    Both have the subject's landing columns, `extra_columns` (a map of the other columns' texts that
    are there, else NULL), and the second `rejected_row`. Columns may stand in any order, be
    missing (NULL) or be added from file to file; names are compared without case, blanks and
    underscores. A file without a `required` column stops the run before anything is read. There is
    one scan for each distinct header, not for each file.
    """
    groups = header_groups(spark, path, spec, required=required, separator=separator)
    if groups:
        rows = reduce(DataFrame.unionByName, [_read_group(spark, g, spec, separator) for g in groups])
    else:
        schema = f"{spec.landing_schema}, `{EXTRA}` MAP<STRING, STRING>, `{BAD_ROW}` STRING"
        rows = spark.createDataFrame([], schema)
    bad = F.col(BAD_ROW).isNotNull()
    return rows.where(~bad).drop(BAD_ROW), rows.where(bad)


def drift_report(spark: SparkSession, path: str, spec: SubjectSpec, **options) -> DataFrame:
    """One row for each header: files, missing, extra, reordered."""
    rows = [
        (list(g.header), len(g.files), list(g.missing), list(g.extra), g.reordered)
        for g in header_groups(spark, path, spec, **options)
    ]
    schema = "header array<string>, files int, missing array<string>, extra array<string>, reordered boolean"
    return spark.createDataFrame(rows, schema)

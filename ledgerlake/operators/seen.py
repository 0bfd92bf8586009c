"""Rows that no earlier load brought, found through a kept index instead of the history.

The index holds every distinct row once, under the load that brought it first, with its
fingerprint. A Bloom filter over all fingerprints is kept beside it, as blocks of 32,768 bits.
The fingerprints of a new load are tested against the filter, and those it may hold are looked up
among the fingerprints of the index; only rows with one of these are compared, by all columns.
Copies within a load are found in the same way. So a row moves between tasks only if its
fingerprint is there a second time, or if there are too many of these to send them to every task;
then load and index are compared part by part, by fingerprint, and a part is shuffled at a time.
A false alarm of the filter or two rows with one fingerprint cost time and nothing else.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.manifest import (
    Version,
    commit,
    committed,
    current,
    in_parts,
    open_loads,
    remove_replaced,
    write_load,
    write_version,
)

FINGERPRINT, BUCKET = "_fingerprint", "_bucket"  # indexes written before have a bucket
SENT = 1_000_000  # so many fingerprints, 8 MB, are sent to every task
BLOCK_BITS = 15  # a block of the filter has 2^15 bits
ROWS_PER_BLOCK = 2_048
BITS_PER_ROW = 4
BLOCKS_PER_TASK = 1_024  # of a filter that is built: 2 million rows at most, on average
GROWTH = 4  # a filter that is full is built anew with room for this many times the rows


def _canonical(df: DataFrame, name: str) -> Column:
    """Equal values hash alike: both zeros are one value for `distinct` and for `<=>`."""
    column = F.col(f"`{name}`")
    if dict(df.dtypes)[name] in ("double", "float"):
        return F.when(column == 0, F.lit(0.0)).otherwise(column)
    return column


def fingerprinted(rows: DataFrame) -> DataFrame:
    """Add a 64-bit hash of the whole row. NULLs count by their place."""
    parts = []
    for name in rows.columns:
        parts += [_canonical(rows, name), F.col(f"`{name}`").isNull()]
    return rows.withColumn(FINGERPRINT, F.xxhash64(*parts))


def _bit_places() -> Column:
    """The places of a fingerprint's bits within its block."""
    other = F.xxhash64(F.col(FINGERPRINT), F.lit(1))
    mask = (1 << BLOCK_BITS) - 1
    return F.array(
        *(F.shiftright(other, BLOCK_BITS * n).bitwiseAND(mask) for n in range(BITS_PER_ROW))
    )


def _block(blocks: int) -> Column:
    return F.pmod(F.col(FINGERPRINT), F.lit(blocks))


def filter_bits(fingerprints: DataFrame, blocks: int, parts: int = 1) -> DataFrame:
    """The filter of a column of fingerprints: block, bits.

    Fingerprints meet by block before bits are set: the rows of any task fall into most blocks, so
    blocks begun before the shuffle would be as many as tasks times blocks, of 4 KB each.
    Of one of several `parts` by block a task takes less, so that a part has tasks enough.
    """
    tasks = max(blocks // (BLOCKS_PER_TASK * max(parts // 4, 1)), 1)
    dealt = fingerprints.select(_block(blocks).alias("block"), FINGERPRINT).repartition(tasks, "block")
    places = dealt.select("block", F.explode(_bit_places()).alias("place"))
    return places.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))


def _either(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Blocks with the bits of two filters."""
    return older.unionByName(newer).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _bit_is_set(bits: str, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    number = place.bitwiseAND(7).cast("int")
    return F.call_function("shiftright", byte.cast("int"), number).bitwiseAND(1) == 1


def may_be_held(rows: DataFrame, bits: DataFrame, blocks: int) -> DataFrame:
    """Fingerprinted rows with a flag `_maybe`: false if the filter proves that the row is new."""
    blocked = rows.withColumn("block", _block(blocks))
    tested = blocked.join(bits, "block", "left")
    all_set = F.forall(_bit_places(), lambda place: _bit_is_set("bits", place))
    return tested.withColumn("_maybe", F.col("bits").isNotNull() & F.coalesce(all_set, F.lit(False))).drop(
        "block", "bits"
    )


def _few(fingerprints: DataFrame) -> bool | None:
    """Whether there are so few that every task can have them; None if there are none."""
    found = fingerprints.count()
    return found <= SENT if found else None


def _with_and_without(hashed: DataFrame, fingerprints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose fingerprint is among a few, and the others, which stay in their tasks."""
    few = F.broadcast(fingerprints)
    return hashed.join(few, FINGERPRINT, "left_semi"), hashed.join(few, FINGERPRINT, "left_anti")


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Whole-row distinct; rows whose fingerprint is there once are not shuffled for it.

    Where most rows are copies a plain distinct moves little: it merges them in each task first.
    """
    # As `distinct` gives them: a zero has no sign.
    rows = rows.select(*(_canonical(rows, name).alias(name) for name in rows.columns))
    hashed = fingerprinted(rows)
    counted = hashed.groupBy(FINGERPRINT).agg(F.count("*").alias("copies"))
    found = counted.agg(
        F.count_if(F.col("copies") > 1).alias("repeated"), F.count("*").alias("all"), F.sum("copies").alias("rows")
    ).first()
    if not found["repeated"]:
        return rows
    if found["repeated"] > SENT or found["all"] < found["rows"] / 2:
        return rows.distinct()
    copies, single = _with_and_without(hashed, counted.where("copies > 1").select(FINGERPRINT))
    return single.unionByName(copies.distinct()).select(*(f"`{name}`" for name in rows.columns))


def _same_row(left: str, right: str, columns: list[str]) -> Column:
    hashes = F.col(f"{left}.{FINGERPRINT}") == F.col(f"{right}.{FINGERPRINT}")
    values = [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns]
    return reduce(and_, [hashes, *values])


def _not_in(rows: DataFrame, index: DataFrame, columns: list[str]) -> DataFrame:
    return rows.alias("new").join(index.alias("held"), _same_row("new", "held", columns), "left_anti")


class SeenIndex:
    """The index of one subject below `path`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.filter_path = spark, path, f"{path}/_filter"

    def loads(self, dt_proc: str | None = None) -> dict[str, list[Version]]:
        """The indexed loads, without that of `dt_proc`."""
        known = current(committed(self.spark, self.path) or [])
        return {load: versions for load, versions in known.items() if load != dt_proc}

    def previous(self, dt_proc: str) -> str | None:
        """Stamp of the load before `dt_proc`."""
        earlier = [load for load in self.loads() if int(load) < int(dt_proc)]
        return max(earlier, key=int, default=None)

    def rows(self, dt_proc: str) -> DataFrame:
        """The rows that a load was the first to bring."""
        index = open_loads(self.spark, self.path, self.loads(), dt_proc)
        return index.where(F.col("dt_proc") == int(dt_proc)).drop(FINGERPRINT, BUCKET, "dt_proc")

    def _filter(self) -> tuple[DataFrame, int] | None:
        versions = current(committed(self.spark, self.filter_path) or [])
        if not versions:
            return None
        blocks = max(versions, key=int)
        return open_loads(self.spark, self.filter_path, versions, blocks).select("block", "bits"), int(blocks)

    def new_rows(self, rows: DataFrame, dt_proc: str) -> DataFrame:
        """Distinct rows that no other load brought, with their fingerprints."""
        return reduce(DataFrame.unionByName, self.new_parts(rows, dt_proc))

    def new_parts(self, rows: DataFrame, dt_proc: str) -> list[DataFrame]:
        """The same in parts that are written one after the other: each shuffles its share alone."""
        hashed = fingerprinted(rows)
        loads, kept = self.loads(dt_proc), self._filter()
        if not loads or kept is None:
            return [hashed]
        index = open_loads(self.spark, self.path, loads).drop("dt_proc")
        maybe = may_be_held(hashed.select(FINGERPRINT), *kept).where("_maybe")
        known = index.select(FINGERPRINT).join(maybe, FINGERPRINT, "left_semi").distinct()
        few = _few(known)
        if few is None:
            return [hashed]
        if not few:
            both = (in_parts(df, FINGERPRINT) for df in (hashed, index))
            return [_not_in(new, old, rows.columns) for new, old in zip(*both)]
        doubtful, new = _with_and_without(hashed, known)
        held = index.join(F.broadcast(known), FINGERPRINT, "left_semi")
        return [new.unionByName(_not_in(doubtful, held, rows.columns))]

    def _write_filter(self, new: DataFrame, new_rows: int, dt_proc: str) -> None:
        kept, loads = self._filter(), self.loads(dt_proc)
        total = new_rows + sum(v.rows for versions in loads.values() for v in versions)
        fingerprints = new.select(FINGERPRINT)
        has_room = kept is not None and total <= kept[1] * ROWS_PER_BLOCK
        blocks = kept[1] if has_room else max(GROWTH * total // ROWS_PER_BLOCK, 1)
        if loads and not has_room:
            older = open_loads(self.spark, self.path, loads).select(FINGERPRINT)
            fingerprints = fingerprints.unionByName(older)
        parts = in_parts(fingerprints.withColumn("block", _block(blocks)), "block", rows=total)
        bits = [filter_bits(part, blocks, len(parts)) for part in parts]
        if has_room:
            both = zip(in_parts(kept[0], "block", rows=total), bits)
            bits = [_either(older, newer) for older, newer in both]
        write_load(bits, self.filter_path, str(blocks))

    def take(self, rows: DataFrame, dt_proc: str) -> int:
        """Index the distinct rows of a load that no other load brought; returns their number.

        The filter is committed before the rows it is about: it may hold rows that are not there,
        never the other way round, wherever the run dies. A load that is taken again replaces
        its own rows. Replaced versions are removed then; only runs read the index, one at a time.
        """
        version = write_version(self.new_parts(distinct_rows(rows), dt_proc), self.path, dt_proc)
        written = open_loads(self.spark, self.path, {dt_proc: [version]})
        self._write_filter(written, version.rows, dt_proc)
        commit(self.spark, self.path, version)
        for path, load in ((self.path, dt_proc), (self.filter_path, "*")):
            remove_replaced(self.spark, path, load)
        return version.rows

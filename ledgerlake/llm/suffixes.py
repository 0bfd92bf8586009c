"""Suffix-array dedup: byte strings that also start in a text with a smaller id.

Strings of 50 bytes come in runs that share an anchor (see anchors); runs whose
anchor was met once are dropped. A run that is equal in another text needs no more
than its hashes. Where an anchor has several different runs their bytes are read
in a second pass; these runs are dealt out by anchor, and each task sorts their
suffixes with deep-shallow sorting: equal strings then lie next to each other and the
smallest id among them is known.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerlake.llm.anchors import (
    Runs,
    Spans,
    as_signed,
    byte_runs,
    byte_units,
    marked_cells,
    met_twice,
    mixed,
    repeated_cells,
    sketch_size,
)
from ledgerlake.llm.arrow import record_batch, text_slices
from ledgerlake.llm.deep_shallow import sorted_groups
from ledgerlake.llm.substrings import unpacked_slices, with_covers
from ledgerlake.llm.tables import discard, short_batches, written

LENGTH = 50
GRAM = 24
BYTES_PER_ANCHOR = 14
LARGEST_SKETCH = 28  # log2 of the cells of one of the two rows: 32 MB as bits
REMEMBERED = 300_000
SORTED_AT_ONCE = 4 << 20  # bytes of runs that one task sorts together, about
RUNS_AT_ONCE = 10_000
HOT_RUNS = 100_000  # different runs of one anchor, beyond which they are dealt out singly
NO_ID = (1 << 63) - 1


def string_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> Runs:
    return byte_runs(data, offsets, length, min(GRAM, length))


def run_batches(
    batches: Iterator[pa.RecordBatch], bits, size: int, length: int, schema: pa.Schema, bytes_too: bool
) -> Iterator[pa.RecordBatch]:
    """Runs whose anchor is set in the bits: their places, or their bytes, mostly once per task."""
    cells = bits.value
    seen: set[int] = set()
    for batch in batches:
        for rows, data, offsets in text_slices(batch):
            runs = string_runs(data, offsets, length)
            kept = met_twice(runs.anchor, cells, size)
            if not kept.any():
                continue
            start, n, anchor, owner = (a[kept] for a in (runs.start, runs.n, runs.anchor, runs.owner))
            end = start + n + length - 1
            h1 = as_signed(Spans(byte_units(data), 0).hashes(start, end))
            if not bytes_too:
                at = pa.array(owner)
                own = [rows.column(0).take(at), rows.column(1).take(at), start - offsets[owner], n]
                yield record_batch(schema, [*own, as_signed(anchor), h1])
                continue
            if len(seen) > REMEMBERED:
                seen.clear()
            _, new = np.unique(h1, return_index=True)
            new = np.array([k for k in new.tolist() if int(h1[k]) not in seen], np.int64)
            seen.update(h1[new].tolist())
            raw = data.tobytes()
            content = [raw[b:e] for b, e in zip(start[new].tolist(), end[new].tolist())]
            own = [as_signed(anchor[new]), h1[new], content, (runs.place[kept] - start)[new]]
            yield record_batch(schema, own)


def alike(
    anchor: np.ndarray, text: np.ndarray, begin: np.ndarray, end: np.ndarray, place: np.ndarray, length: int
) -> np.ndarray:
    """Which runs might share a string with another: with an equal anchor and an equal side of it, or without a place.

    A string is longer than its anchor by `length - gram` bytes, of which at least half lie before
    the anchor or at least half behind it; so runs that share a string agree in so many bytes there.
    """
    gram = min(GRAM, length)
    half = (length - gram + 1) // 2
    out = place < 0
    for shift in (-half, gram):
        low = begin + place + shift
        there = np.flatnonzero((place >= 0) & (low >= begin) & (low + half <= end))
        side = np.empty(len(there), np.uint64)
        for at in range(0, len(there), RUNS_AT_ONCE):
            own = low[there[at : at + RUNS_AT_ONCE]]
            spans = Spans(byte_units(text[own[0] : own[-1] + half]), 0)
            side[at : at + RUNS_AT_ONCE] = spans.hashes(own - own[0], own - own[0] + half)
        _, number, times = np.unique(mixed(side ^ anchor[there].view(np.uint64)), return_inverse=True, return_counts=True)
        out[there] |= times[number] > 1
    return out


def sorted_batches(batches: Iterator[pa.RecordBatch], length: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Smallest id of every string of every run, over all runs of the task.

    Runs whose strings are met first in them are left out, save those that were dealt out singly.
    """
    table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    content = table["content"].cast(pa.large_binary()).combine_chunks()
    offsets = np.frombuffer(content.buffers()[1], np.int64)[content.offset : content.offset + len(content) + 1]
    text = np.frombuffer(content.buffers()[2], np.uint8)[: offsets[-1]]
    place = table["place"].fill_null(-1).to_numpy()
    some = alike(table["anchor"].to_numpy(), text, offsets[:-1], offsets[1:], place, length)
    table, begin, n, single = table.filter(pa.array(some)), offsets[:-1][some], (np.diff(offsets) - length + 1)[some], place[some] < 0
    if not len(n):
        return
    owner = np.repeat(np.arange(len(n)), n)
    places = begin[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    _, group = sorted_groups(text, places, length)
    own = table["first"].to_numpy()[owner]
    least = np.full(int(group.max()) + 1, NO_ID, np.int64)
    np.minimum.at(least, group, own)
    least = least[group]
    told = single | (np.bincount(owner, weights=least < own, minlength=len(n)) > 0)
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(least))
    columns = [table[c].combine_chunks() for c in ("anchor", "h1")]
    whole = pa.RecordBatch.from_arrays([*columns, lists], schema=schema).filter(pa.array(told))
    for at in range(0, whole.num_rows, 10_000):
        yield whole.slice(at, 10_000)


def marked_windows(cover: pa.ListArray, offsets: np.ndarray) -> np.ndarray:
    """Which places of all texts begin a window that a mask marks."""
    out = np.zeros(int(offsets[-1]) + 64, bool)
    items = cover.flatten()
    owner = np.repeat(np.arange(len(cover)), pc.list_value_length(cover).fill_null(0).to_numpy())
    start = items.field("start").to_numpy() + offsets[owner]
    bits = np.unpackbits(items.field("mask").to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    run, k = np.nonzero(bits)
    out[start[run] + k] = True
    return out[: int(offsets[-1])]


def kept_bytes(
    batches: Iterator[pa.RecordBatch], length: int, schema: pa.Schema, digest: bool
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in unpacked_slices(batch):
            marked = np.cumsum(marked_windows(rows.column(1), offsets))
            gone = marked > np.append(np.zeros(length, np.int64), marked)[: len(marked)]
            first = gone & ~np.append(False, gone[:-1])[: len(gone)]
            begins = offsets[:-1][np.diff(offsets) > 0]
            first[begins] = gone[begins]
            removed, spans = (np.diff(np.append(0, np.cumsum(a))[offsets]) for a in (gone, first))
            left = data[~gone].tobytes()
            ends = offsets - np.append(0, np.cumsum(removed))
            kept = [left[b:e] for b, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
            if digest:
                kept = [hashlib.sha256(k).hexdigest() for k in kept]
            yield record_batch(schema, [rows.column(0), np.diff(offsets), removed, spans, kept])


def smallest_ids(
    keys: DataFrame, hot: DataFrame | None, contents: DataFrame, length: int, made: dict[str, str]
) -> DataFrame:
    """anchor, h1 and per string of the run the smallest id, where it is another than the run's.

    `keys` are those of anchors with several runs. A `hot` anchor with very many different
    runs, say a passage in many surroundings, is taken apart: its strings are made distinct
    first and dealt out one by one.
    """
    with short_batches(keys.sparkSession):
        distinct = written(
            contents.groupBy("anchor", "h1").agg(F.first("content").alias("content"), F.first("place").alias("place"))
            .join(keys.select("anchor", "h1", "first"), ["anchor", "h1"]),
            "byte-runs-distinct", made,
        )
    total = distinct.agg(F.sum(F.length("content"))).first()[0] or 0
    tasks = max(1, total // SORTED_AT_ONCE)
    ddl = "anchor bigint, h1 bigint, ids array<bigint>"
    sort = partial(sorted_batches, length=length, schema=to_arrow_schema(StructType.fromDDL(ddl)))
    if hot is None:
        return written(distinct.repartition(int(tasks), "anchor").mapInArrow(sort, ddl), "byte-runs-sorted", made)

    single = (
        distinct.join(hot, "anchor", "left_semi")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.length("content") - (length - 1))))
        .select("anchor", "h1", "k", "first", F.expr(f"substring(content, k, {length})").alias("content"))
    )
    names = {"s1": F.xxhash64("content"), "s2": F.xxhash64(F.lit(1), "content")}
    strings = (
        single.groupBy("content").agg(F.min("first").alias("first"))
        .select(names["s1"].alias("anchor"), names["s2"].alias("h1"), "content", F.lit(None).alias("place"), "first")
    )
    ordinary = distinct.join(hot, "anchor", "left_anti")
    dealt = ordinary.unionByName(strings).repartition(int(tasks), "anchor")
    found = written(dealt.mapInArrow(sort, ddl), "byte-runs-sorted", made)
    whole = found.join(ordinary.select("anchor", "h1"), ["anchor", "h1"], "left_semi")
    apart = (
        single.withColumns(names).select("k", "s1", "s2", F.col("anchor").alias("r"), F.col("h1").alias("r1"))
        .join(found, (F.col("s1") == F.col("anchor")) & (F.col("s2") == F.col("h1")))
        .groupBy("r", "r1").agg(F.sort_array(F.collect_list(F.struct("k", F.col("ids")[0].alias("id")))).alias("l"))
        .select(F.col("r").alias("anchor"), F.col("r1").alias("h1"), F.col("l.id").alias("ids"))
    )
    return whole.unionByName(apart)


def suffix_dedup(docs: DataFrame, length: int = LENGTH, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of every text.

    A byte goes if a string of `length` bytes that covers it also starts in a text
    with a smaller id. `digest` gives kept_sha256 in place of kept. Null and empty
    texts have no bytes, shorter texts lose nothing. Texts with equal ids, null
    among them, don't remove anything from each other; a null id is larger than all
    others. Repeated rows are treated alike. An empty table gives an empty result,
    further columns play no part.

    Runs are told apart by 128 bits of hash, strings by their bytes. All groupings
    combine before the shuffle; what a task sorts is bounded, see `smallest_ids`.
    """
    spark = docs.sparkSession
    size = sketch_size(docs, BYTES_PER_ANCHOR, LARGEST_SKETCH)
    kind = docs.schema["doc_id"].dataType.simpleString()
    body = F.xxhash64("text").alias("body")

    def read_runs(bits: np.ndarray, ddl: str, bytes_too: bool) -> DataFrame:
        schema = to_arrow_schema(StructType.fromDDL(ddl))
        shared = spark.sparkContext.broadcast(bits)
        run = partial(run_batches, bits=shared, size=size, length=length, schema=schema, bytes_too=bytes_too)
        return docs.select("doc_id", body, "text").mapInArrow(run, ddl)

    repeated = repeated_cells(docs, partial(string_runs, length=length), size)
    ddl = f"doc_id {kind}, body bigint, start bigint, n bigint, anchor bigint, h1 bigint"
    made: dict[str, str] = {}
    with short_batches(spark):
        runs = written(read_runs(repeated, ddl, bytes_too=False), "byte-runs", made)
    id_ = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    ends = runs.groupBy("anchor", "h1").agg(F.min(id_).alias("first"), F.max(id_).alias("last"))
    keys = written(ends, "byte-runs-keys", made)
    several = written(keys.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "byte-runs-several", made)
    of_several = written(keys.join(several, "anchor", "left_semi"), "byte-runs-of-several", made)
    ddl = "anchor bigint, h1 bigint, content binary, place bigint"
    contents = read_runs(marked_cells(several.select("anchor"), size), ddl, bytes_too=True)
    hot = several.where(F.col("n") > HOT_RUNS).select("anchor")

    strings = smallest_ids(of_several, None if hot.isEmpty() else hot, contents, length, made)
    first = keys.where("first < last").select("anchor", "h1", "first")
    known = written(first.join(strings, ["anchor", "h1"], "full_outer"), "byte-runs-known", made)
    discard(spark, made, *[m for m in made if m not in ("byte-runs", "byte-runs-known")])
    bit = "aggregate(ids, struct(0L as m, 0 as k), (a, x) -> struct(a.m | if(x < id, shiftleft(1L, a.k), 0L) as m, a.k + 1 as k), a -> a.m)"
    masks = written(
        runs.join(known, ["anchor", "h1"]).withColumn("id", id_)
        .select("doc_id", "body", "start", F.expr(f"if(first < id, shiftleft(1L, int(n)) - 1, if(ids is null, 0L, {bit}))").alias("mask"))
        .where("mask != 0"),
        "byte-runs-masks",
    )
    discard(spark, made, *list(made))
    covers = masks.groupBy("doc_id", "body").agg(F.collect_list(F.struct("start", "mask")).alias("cover"))
    last = "kept_sha256 string" if digest else "kept binary"
    ddl = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, {last}"
    keep = partial(kept_bytes, length=length, digest=digest, schema=to_arrow_schema(StructType.fromDDL(ddl)))
    return with_covers(docs, covers).mapInArrow(keep, ddl)

"""Substring dedup: repeated windows of words behind a count-min prefilter.

First pass: every task counts its windows in a sketch, the sketches are merged. The
estimate of a window is that of its anchor, which is never less than its own count.
Second pass: only windows with an estimate of two or more are emitted and grouped
exactly, in runs: equal runs first, then single windows where one anchor has
different runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerlake.llm.anchors import (
    Runs,
    Spans,
    as_signed,
    met_twice,
    repeated_cells,
    runs_of,
    sketch_size,
    word_spans,
    word_units,
)
from ledgerlake.llm.arrow import record_batch, text_slices
from ledgerlake.llm.tables import written

WINDOW = 35
GRAM = 8
BYTES_PER_ANCHOR = 70
REMEMBERED = 500_000


def word_runs(data: np.ndarray, offsets: np.ndarray, window: int) -> Runs:
    begin, end, texts = word_spans(data, offsets)
    return runs_of(word_units(data, begin, end), texts, window, min(GRAM, window))


def run_batches(
    batches: Iterator[pa.RecordBatch], bits, size: int, window: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Runs with estimated repeats; the window hashes of a run come once per task."""
    cells = bits.value
    seen: set[int] = set()
    for batch in batches:
        for rows, data, offsets in text_slices(batch):
            begin, end, texts = word_spans(data, offsets)
            units = word_units(data, begin, end)
            runs = runs_of(units, texts, window, min(GRAM, window))
            kept = met_twice(runs.anchor, cells, size)
            start, n, anchor, owner = (a[kept] for a in (runs.start, runs.n, runs.anchor, runs.owner))
            if not len(start):
                continue
            spans = Spans(units, 0)
            content = spans.hashes(start, start + n + window - 1)
            if len(seen) > REMEMBERED:
                seen.clear()
            new = np.zeros(len(start), bool)
            for k, h in enumerate(content.tolist()):
                if h not in seen:
                    seen.add(h)
                    new[k] = True
            first = np.repeat(start[new], n[new])
            ends = np.cumsum(n[new])
            place = first + np.arange(len(first)) - np.repeat(ends - n[new], n[new])
            values = as_signed(spans.hashes(place, place + window))
            sizes = np.where(new, n, 0)
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values), mask=pa.array(~new)
            )
            at = pa.array(owner)
            yield record_batch(schema, [
                rows.column(0).take(at), rows.column(1).take(at), start - texts[owner], n,
                as_signed(anchor), as_signed(content), lists,
            ])


def packed_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, for the one shuffle they go through."""
    pack = zstandard.ZstdCompressor(level=6).compress
    for batch in batches:
        for rows, data, offsets in text_slices(batch):
            raw = data.tobytes()
            packed = [pack(raw[b:e]) for b, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield record_batch(schema, [rows.column(0), rows.column(1), packed])


def with_covers(docs: DataFrame, covers: DataFrame) -> DataFrame:
    """doc_id, packed text and cover of every row; `covers` by doc_id and hash of the text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, body bigint, packed binary"
    pack = partial(packed_batches, schema=to_arrow_schema(StructType.fromDDL(ddl)))
    rows = docs.select("doc_id", F.xxhash64("text").alias("body"), "text").mapInArrow(pack, ddl)
    of = covers.toDF("_id", "_body", "cover")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body"))
    return rows.join(of, same, "left").select("doc_id", "packed", "cover")


def unpacked_slices(batch: pa.RecordBatch, rows: int = 256):
    """As `text_slices`, of packed texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    for begin in range(0, batch.num_rows, rows):
        part = batch.slice(begin, rows)
        texts = pa.array([unpack(t) for t in part.column(1).to_pylist()], pa.binary()).cast(pa.string())
        yield from text_slices(pa.RecordBatch.from_arrays(
            [part.column(0), part.column(2), texts], names=["doc_id", "cover", "text"]
        ))


def kept_words(
    batches: Iterator[pa.RecordBatch], window: int, schema: pa.Schema, digest: bool
) -> Iterator[pa.RecordBatch]:
    """Takes the covered words out of each text; masks come as (start, mask) lists."""
    for batch in batches:
        for rows, data, offsets in unpacked_slices(batch):
            begin, end, texts = word_spans(data, offsets)
            covers = rows.column(1).to_pylist()
            out = []
            for k, cover in enumerate(covers):
                b, e = begin[texts[k] : texts[k + 1]], end[texts[k] : texts[k + 1]]
                gone = covered(cover, len(b), window)
                raw = data[offsets[k] : offsets[k + 1]].tobytes()
                left = np.flatnonzero(~gone)
                o = int(offsets[k])
                text = b" ".join([raw[x:y] for x, y in zip((b[left] - o).tolist(), (e[left] - o).tolist())])
                out.append((len(b), len(b) - len(left), hashlib.sha256(text).hexdigest() if digest else text.decode()))
            yield record_batch(schema, [rows.column(0), *[list(c) for c in zip(*out)]])


def covered(cover: list[dict] | None, n: int, window: int) -> np.ndarray:
    """Which of n units lie in a window that a mask marks."""
    if not cover:
        return np.zeros(n, bool)
    start = np.array([c["start"] for c in cover], np.int64)
    mask = np.array([c["mask"] for c in cover], np.int64)
    marked = (mask[:, None] >> np.arange(64)) & 1 > 0
    places = (start[:, None] + np.arange(64))[marked]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, places, 1)
    np.add.at(change, places + window, -1)
    return np.cumsum(change[:-1]) > 0


def substring_dedup(docs: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words, joined by one space, of every text.

    A word goes if a window of `window` words that covers it also starts at any
    other place, of the same text or another. `digest` gives kept_sha256 in place of
    kept. Null and empty texts have no words; a text shorter than a window loses
    nothing. Every row is a text of its own, also one that repeats an id or a whole
    row; null ids are kept. An empty table gives an empty result, further columns
    play no part. `window` is 64 at most beyond the anchor's length.

    Windows are compared by 128 bits. All groupings combine before the shuffle, all
    joins are plain ones between large and reduced sides that adaptive execution can
    cut: a passage in a third of all texts is no hot key. Beyond the sketch's bound
    more windows are estimated repeated than are, which costs time and nothing else.
    """
    spark = docs.sparkSession
    size = sketch_size(docs, BYTES_PER_ANCHOR)
    bits = spark.sparkContext.broadcast(repeated_cells(docs, partial(word_runs, window=window), size))
    kind = docs.schema["doc_id"].dataType.simpleString()
    body = F.xxhash64("text").alias("body")
    ddl = f"doc_id {kind}, body bigint, start bigint, n bigint, anchor bigint, content bigint, windows array<bigint>"
    run = partial(run_batches, bits=bits, size=size, window=window, schema=to_arrow_schema(StructType.fromDDL(ddl)))
    runs = written(docs.select("doc_id", body, "text").mapInArrow(run, ddl), "word-runs")

    # Runs are equal if anchor and content are, windows if anchor and hash are.
    counted = runs.groupBy("anchor", "content").agg(F.count("*").alias("times"), F.max("n").alias("n"))
    full = counted.where("times > 1").select(
        F.xxhash64("anchor").alias("of"), "content", F.expr("shiftleft(1L, int(n)) - 1").alias("mask")
    )
    several = runs.groupBy("anchor").agg(F.min("content").alias("a"), F.max("content").alias("b")).where("a != b")
    single = (
        runs.where(F.col("windows").isNotNull()).join(several.select("anchor"), "anchor", "left_semi")
        .select(F.xxhash64("anchor").alias("of"), "content", F.posexplode("windows").alias("k", "w"))
    )
    shared = (
        single.groupBy("w", "of").agg(F.min("content").alias("a"), F.max("content").alias("b"))
        .where("a != b").select("w", "of")
    )
    parts = single.join(shared, ["w", "of"]).groupBy("of", "content").agg(F.expr("bit_or(shiftleft(1L, k))").alias("mask"))
    masks = written(full.unionByName(parts).groupBy("of", "content").agg(F.bit_or("mask").alias("mask")), "word-masks")
    covers = (
        runs.select("doc_id", "body", "start", F.xxhash64("anchor").alias("of"), "content")
        .join(masks, ["of", "content"])
        .groupBy("doc_id", "body").agg(F.collect_list(F.struct("start", "mask")).alias("cover"))
    )
    ddl = f"doc_id {kind}, n_words bigint, n_removed bigint, {'kept_sha256' if digest else 'kept'} string"
    keep = partial(kept_words, window=window, digest=digest, schema=to_arrow_schema(StructType.fromDDL(ddl)))
    return with_covers(docs, covers).mapInArrow(keep, ddl)

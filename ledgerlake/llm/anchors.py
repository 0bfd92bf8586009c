"""Fixed-length windows in runs that share an anchor, and a count-min sketch of the anchors.

Units are words or bytes, each with a 64-bit value. The anchor of a window is the
gram (a shorter window) in it whose hash is smallest, the first one of equals: it
depends on nothing but the window. Neighbouring windows mostly share theirs and form
a run, so that a text has some ten to twenty times fewer runs than windows, and
equal windows always lie in runs with equal anchors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.arrow import record_batch, text_slices
from ledgerlake.llm.tables import short_batches, shuffles_removed

BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
BLOCK = 1 << 20  # cells that are sent and merged together
PART = 1 << 16  # cells of a block whose numbers share their upper bits
WORD = 8
WINDOWS_AT_ONCE = 1 << 15
PLACE = np.uint64(0xFFFF)  # bits of a gram's place beside its hash
LONGEST_SHORT_WORD = 64
LARGEST_SKETCH = 27  # log2 of the cells of one of the two rows: 16 MB as bits
TASKS_AT_ONCE = 256


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, up to what was asked for so far."""

    def __init__(self, base: np.uint64):
        inverse = pow(int(base), -1, 1 << 64)
        self.bases = (base, np.uint64(inverse))
        self.powers = [np.ones(1, np.uint64)] * 2

    def upto(self, n: int) -> list[np.ndarray]:
        if len(self.powers[0]) < n:
            size = max(n, 1 << 16)
            self.powers = [
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b)]), dtype=np.uint64)
                for b in self.bases
            ]
        return [p[:n] for p in self.powers]


_powers = [Powers(b) for b in BASES]


class Spans:
    """Hashes of any stretch of units, in constant time each."""

    def __init__(self, units: np.ndarray, base: int):
        power, self.inverse = _powers[base].upto(len(units) + 1)
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * power[: len(units)], out=self.sums[1:])

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.inverse[begin])


_byte_values = mixed(np.arange(1, 257, dtype=np.uint64) * BASES[0])


def byte_units(data: np.ndarray) -> np.ndarray:
    return _byte_values[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of all words [^\\x20\\x09-\\x0D]+ and, per text, the number of words before it."""
    solid = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    before = np.append(False, solid[:-1])[: len(solid)]
    starts = offsets[:-1][offsets[:-1] < len(data)]
    before[starts] = False
    begin = np.flatnonzero(solid & ~before)
    after = np.append(solid[1:], False)[: len(solid)]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    end = np.flatnonzero(solid & ~after) + 1
    return begin, end, np.searchsorted(begin, offsets)


def word_units(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word.

    Polynomials modulo 2^64 tell short words apart; from about a thousand letters on there are
    words that collide under every base, so longer words have another hash.
    """
    units = Spans(byte_units(data), 0).hashes(begin, end) ^ mixed((end - begin).astype(np.uint64))
    for k in np.flatnonzero(end - begin > LONGEST_SHORT_WORD).tolist():
        units[k] = xxhash.xxh3_64_intdigest(data[begin[k] : end[k]].tobytes())
    return units


@dataclass
class Runs:
    start: np.ndarray  # first unit of the first window
    n: np.ndarray  # windows
    anchor: np.ndarray  # hash of the anchor
    owner: np.ndarray  # text
    place: np.ndarray  # first unit of the anchor


def smallest_grams(
    grams: Callable[[int, int], np.ndarray], texts: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, anchor and place of the anchor of all runs; also of windows that span two texts.

    `grams` gives the hashes of the grams that begin in a range. Grams are ordered by the upper 48 bits
    of their hash and then by place, which lie in one word; blocks are small enough for the CPU's cache.
    """
    width, windows = window - gram + 1, int(texts[-1]) - window + 1
    begins = texts[:-1][np.diff(texts) >= window]
    starts, anchors, places = [], [], []
    last = -1
    for b in range(0, windows, WINDOWS_AT_ONCE):
        e = min(b + WINDOWS_AT_ONCE, windows)
        value = grams(b, e + width - 1)
        key = (value & ~PLACE) | np.arange(len(value), dtype=np.uint64)
        reach = 1
        while reach < width:
            step = min(reach, width - reach)
            key = np.minimum(key[:-step], key[step:])
            reach += step
        key &= PLACE
        new = np.empty(len(key), bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
        new[0] = int(key[0]) + b != last
        last = int(key[-1]) + b
        low, high = np.searchsorted(begins, [b, e])
        new[begins[low:high] - b] = True
        start = np.flatnonzero(new)
        place = key[start].astype(np.int64)
        starts.append(start + b)
        anchors.append(value[place])
        places.append(place + b)
    return np.concatenate(starts), np.concatenate(anchors), np.concatenate(places)


def runs_by(grams: Callable[[int, int], np.ndarray], texts: np.ndarray, window: int, gram: int) -> Runs:
    """All runs of texts that lie behind each other; `texts` holds where each begins and the end."""
    if int(texts[-1]) < window:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none.astype(np.uint64), none, none)
    start, anchor, place = smallest_grams(grams, texts, window, gram)
    owner = np.searchsorted(texts, start, side="right") - 1
    n = np.minimum(np.append(start[1:], texts[-1]), texts[owner + 1] - window + 1) - start
    inside = n > 0
    return Runs(*(a[inside] for a in (start, n, anchor, owner, place)))


def runs_of(units: np.ndarray, texts: np.ndarray, window: int, gram: int) -> Runs:
    """Runs of units that have a value each."""
    spans = Spans(units, 0)

    def grams(begin: int, end: int) -> np.ndarray:
        place = np.arange(begin, end)
        return spans.hashes(place, place + gram)

    return runs_by(grams, texts, window, gram)


def byte_grams(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the gram at each place, from the words of eight bytes that make it up."""
    count = len(data) - gram + 1
    padded = np.append(data, np.zeros(WORD - 1, np.uint8)) if gram < WORD else data
    words = np.empty(len(padded) - WORD + 1, np.uint64)
    for k in range(WORD):
        n = (len(padded) - k) // WORD
        words[k::WORD] = padded[k : k + WORD * n].view("<u8")
    if gram < WORD:
        words &= np.uint64((1 << 8 * gram) - 1)
    value, shifted = np.zeros(count, np.uint64), np.empty(count, np.uint64)
    for at in sorted({*range(0, gram - WORD + 1, WORD), max(0, gram - WORD)}):
        value += words[at : at + count]
        value *= BASES[0]
        value ^= np.right_shift(value, np.uint64(32), out=shifted)
    value *= BASES[1]
    value ^= np.right_shift(value, np.uint64(29), out=shifted)
    return value


def byte_runs(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> Runs:
    return runs_by(lambda begin, end: byte_grams(data[begin : end + gram - 1], gram), offsets, window, gram)


def sketch_size(docs: DataFrame, bytes_per_anchor: int, largest: int = LARGEST_SKETCH) -> int:
    """log2 of the cells of a sketch row: a few for each anchor, within a fixed bound."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(np.clip(np.ceil(np.log2(4 * total / bytes_per_anchor + 1)), 16, largest))


def cells(anchor: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << size) - 1)
    return anchor & mask, (anchor >> np.uint64(32)) & mask


def packed(cell: np.ndarray) -> bytes:
    """Cells of one block, in order: listed by parts, or as bits if they are many."""
    if len(cell) < BLOCK // 16 - 2 * BLOCK // PART:
        sizes = np.bincount(cell // PART, minlength=BLOCK // PART)
        return sizes.astype("<u4").tobytes() + (cell % PART).astype("<u2").tobytes() if len(cell) else b""
    bits = np.zeros(BLOCK, bool)
    bits[cell] = True
    return np.packbits(bits).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    if len(data) < BLOCK // 8:
        parts = BLOCK // PART
        sizes = np.frombuffer(data, "<u4", parts)
        return np.frombuffer(data, "<u2", offset=4 * parts) + np.repeat(np.arange(parts) * PART, sizes)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8)))


def task_sketch(anchors: list[np.ndarray], size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The sketch of some anchors by blocks: cells that were met once or more, and twice or more."""
    group = TaskContext.get().partitionId() // TASKS_AT_ONCE
    found = np.concatenate(anchors) if anchors else np.zeros(0, np.uint64)
    for row, cell in enumerate(cells(found, size)):
        cell, counts = np.unique(cell.astype(np.int64), return_counts=True)
        blocks, begin = np.unique(cell // BLOCK, return_index=True)
        out = []
        for block, b, e in zip(blocks, begin, np.append(begin[1:], len(cell))):
            own = cell[b:e] % BLOCK
            out.append((row, int(block), group, packed(own), packed(own[counts[b:e] > 1])))
        if out:
            yield record_batch(schema, [list(c) for c in zip(*out)])


def merge_blocks(part: pd.DataFrame) -> pd.DataFrame:
    once, twice = np.zeros(BLOCK, bool), np.zeros(BLOCK, bool)
    for met, again in zip(part["once"], part["twice"]):
        met = unpacked(met)
        twice[met[once[met]]] = True
        once[met] = True
        twice[unpacked(again)] = True
    merged = part.iloc[:1].copy()
    merged["once"], merged["twice"] = [packed(np.flatnonzero(once))], [packed(np.flatnonzero(twice))]
    return merged


SKETCH = "row int, block int, part int, once binary, twice binary"
HASHES_AT_ONCE = 1_000_000


def sketch_batches(batches, anchors_of, size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        for _, data, offsets in text_slices(batch):
            held.append(anchors_of(data, offsets).anchor)
            n += len(held[-1])
            if n >= HASHES_AT_ONCE:
                yield from task_sketch(held, size, schema)
                held, n = [], 0
    yield from task_sketch(held, size, schema)


def anchor_batches(batches, size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        held.append(batch.column(0).to_numpy().view(np.uint64))
        n += len(held[-1])
        if n >= HASHES_AT_ONCE:
            yield from task_sketch(held, size, schema)
            held, n = [], 0
    yield from task_sketch(held, size, schema)


def merged_bits(rows: DataFrame, mapper, size: int, column: str) -> np.ndarray:
    """Sketches of all tasks as the bits of one: cells met `once` or more, or `twice` or more.

    Every task sends its own sketch by blocks, those of up to 256 tasks are merged
    first and then all of a block. Only the merged bits, whose number `size` bounds,
    come to the driver.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(SKETCH))
    with shuffles_removed(rows.sparkSession):
        merged = (
            rows.mapInArrow(partial(mapper, size=size, schema=schema), SKETCH)
            .groupBy("row", "block", "part").applyInPandas(merge_blocks, SKETCH)
            .groupBy("row", "block").applyInPandas(merge_blocks, SKETCH)
            .where(F.length(column) > 0).select("row", "block", column).toArrow()
        )
    bits = np.zeros((2, (1 << size) // 8), np.uint8)
    width = min(BLOCK, 1 << size)
    for batch in merged.to_batches():
        for row, block, cell in zip(*[c.to_pylist() for c in batch.columns]):
            full = np.zeros(width, bool)
            full[unpacked(cell)] = True
            bits[row, block * width // 8 : (block + 1) * width // 8] = np.packbits(full)
    return bits


def repeated_cells(docs: DataFrame, anchors_of, size: int) -> np.ndarray:
    """Count-min sketch over all anchors of all texts: which cells of the two rows were met twice."""
    with short_batches(docs.sparkSession):
        return merged_bits(docs.select("text"), partial(sketch_batches, anchors_of=anchors_of), size, "twice")


def marked_cells(anchors: DataFrame, size: int) -> np.ndarray:
    """The cells of some anchors, given as one column of signed numbers."""
    return merged_bits(anchors, anchor_batches, size, "once")


def met_twice(anchor: np.ndarray, bits: np.ndarray, size: int) -> np.ndarray:
    """Whether all cells of an anchor are set: true for every anchor that was met twice (or marked)."""
    out = np.ones(len(anchor), bool)
    for row, cell in enumerate(cells(anchor, size)):
        cell = cell.astype(np.int64)
        out &= (bits[row, cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0
    return out


def as_signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)

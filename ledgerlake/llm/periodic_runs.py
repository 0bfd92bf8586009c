"""Periodic runs of words by an online sparse diagonal recurrence.

Word i and word j = i - q lie on diagonal q. Along a diagonal the matches in a row are counted:
every earlier occurrence of a word raises the count of its lag by one, a lag without an
occurrence ends, and an ended diagonal that is long enough is a run of period q.

Only occurrences that can belong to a run are looked at. A run of period q and at least `least`
words has max(least - q, q) matches in a row, so an occurrence counts if the following words
agree as well, up to the least such number among the lags from q's power of two to the next.
That is exact, and a word that is merely frequent adds nothing. Places of one repeated stretch
that lie at most half its length apart form a progression whose step is a smaller period; lags
inside it repeat the run of that step and are left out. Two progressions can only share a run
if they touch or if their first or last members are q apart. Each word therefore has a few
occurrences per power of two, in a text of one repeated word as in any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.arrow import text_slices

LEAST_WORDS = 12
SHORT_LAGS = 8  # lags below this are taken together
Words = list[bytes]
Run = tuple[int, int, int]


class Stretches:
    """Ranks of equal stretches of words, for those that occur more than once in their text."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray):
        self.size = len(ids)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        words = int(ids.max(initial=0)) + 1
        self.ranks = {1: self._repeated(self.text * words + ids, np.arange(self.size))}

    def _repeated(self, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        _, rank, count = np.unique(keys, return_inverse=True, return_counts=True)
        ranks = np.full(self.size, -1, np.int64)
        again = count[rank] > 1
        ranks[places[again]] = rank[again]
        return ranks

    def of(self, length: int) -> np.ndarray:
        """Rank of the stretch of `length` words that begins at each place, -1 for single ones.

        It is put together from two of half the length or more, which may overlap.
        """
        if length not in self.ranks:
            half = 1 << (length - 1).bit_length() - 1
            part, shift = self.of(half), length - half
            places = np.flatnonzero(part[: max(self.size - shift, 0)] >= 0)
            fits = (part[places + shift] >= 0) & (self.text[places + shift] == self.text[places])
            places = places[fits]
            self.ranks[length] = self._repeated(part[places] * self.size + part[places + shift], places)
        return self.ranks[length]


def by_rank(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of repeated stretches, equal ones together and in order, and their ranks."""
    places = np.flatnonzero(ranks >= 0)
    places = places[np.argsort(ranks[places], kind="stable")]
    return places, ranks[places]


def short_occurrences(places: np.ndarray, ranks: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """begin, end and lag of all matches with a lag below SHORT_LAGS."""
    for back in range(1, SHORT_LAGS):
        lag = places[back:] - places[:-back]
        near = (ranks[back:] == ranks[:-back]) & (lag < SHORT_LAGS)
        if not near.any():
            return
        begin = places[back:][near]
        yield np.stack([begin, begin + length, lag[near]])


def occurrences(places: np.ndarray, ranks: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """begin, end and lag of the matches with a lag from `length` to twice that, as far as needed."""
    gap = np.diff(places)
    joined = (ranks[1:] == ranks[:-1]) & (gap <= length // 2)
    start = np.flatnonzero(np.append(True, ~joined))
    size = np.diff(np.append(start, len(places)))
    first, last, rank = places[start], places[start + size - 1], ranks[start]
    step = np.where(size > 1, np.append(gap, 0)[start], 0)

    def matches(one: np.ndarray, two: np.ndarray, lag: np.ndarray) -> np.ndarray:
        begin = np.maximum(first[two], first[one] + lag)
        end = np.minimum(last[two], last[one] + lag)
        kept = (begin <= end) & (lag >= length) & (lag < 2 * length)
        return np.stack([begin, end + length, lag])[:, kept]

    for back in range(1, 4):
        two = np.arange(back, len(first))
        two = two[rank[two] == rank[two - back]]
        one = two - back
        if not len(two):
            return
        yield matches(one, two, first[two] - first[one])
        yield matches(one, two, last[two] - last[one])
        if back == 1:
            stride = np.maximum(step[one], step[two])
            touch = (stride > 0) & (first[two] - last[one] <= length + 2 * stride - 2)
            one, two, stride = one[touch], two[touch], stride[touch]
            nearest = first[two] - last[one]
            # From the first lag that is long enough to the last one that is short enough.
            skipped = np.maximum(-((nearest - length) // stride), 0)
            until = np.minimum(last[two] - first[one], 2 * length - 1)
            lags = np.maximum((until - nearest) // stride + 1 - skipped, 0)
            number = np.arange(lags.sum()) - np.repeat(np.cumsum(lags) - lags, lags)
            lag = np.repeat(nearest + skipped * stride, lags) + number * np.repeat(stride, lags)
            yield matches(np.repeat(one, lags), np.repeat(two, lags), lag)


def all_occurrences(ids: np.ndarray, offsets: np.ndarray, least: int) -> np.ndarray:
    """begin, end and lag of every match that a run may need, in order of begin."""
    stretches = Stretches(ids, offsets)
    needed = min(max(least - lag, lag) for lag in range(1, SHORT_LAGS))
    found = list(short_occurrences(*by_rank(stretches.of(needed)), needed))
    length = SHORT_LAGS
    while length <= len(ids):
        places, ranks = by_rank(stretches.of(length))
        if not len(places):
            break
        found += occurrences(places, ranks, length)
        length *= 2
    if not found:
        return np.zeros((3, 0), np.int64)
    found = np.concatenate(found, axis=1)
    return found[:, np.argsort(found[0], kind="stable")]


def runs_of_slice(ids: np.ndarray, offsets: np.ndarray, least: int) -> list[list[Run]]:
    """(start, length, period) of all runs of each text, by start and period."""
    found: list[dict[tuple[int, int], int]] = [{} for _ in offsets[1:]]
    begins, ends, lags = all_occurrences(ids, offsets, least)
    owners = np.searchsorted(offsets, begins, side="right") - 1
    active: dict[int, list[int]] = {}
    owner = -1

    def emit(lag: int, begin: int, end: int) -> None:
        if end - begin >= max(least - lag, lag):
            # A stretch with several periods is a run of the smallest one.
            key, runs = (begin - lag, end), found[owner]
            runs[key] = min(runs.get(key, lag), lag)

    def close() -> None:
        for lag, (begin, end) in active.items():
            emit(lag, begin, end)
        active.clear()

    for text, begin, end, lag in zip(owners.tolist(), begins.tolist(), ends.tolist(), lags.tolist()):
        if text != owner:
            close()
            owner = text
        diagonal = active.get(lag)
        if diagonal is None:
            active[lag] = [begin, end]
        elif begin <= diagonal[1]:
            diagonal[1] = max(diagonal[1], end)
        else:
            emit(lag, *diagonal)
            active[lag] = [begin, end]
    close()
    return [
        sorted((start - base, end - start, lag) for (start, end), lag in runs.items())
        for runs, base in zip(found, offsets.tolist())
    ]


def collapsed(words: Words, runs: list[Run]) -> Words:
    """Words that no run holds behind its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [word for word, n in zip(words, np.cumsum(gone).tolist()) if n == 0]


def longest(runs: list[Run]) -> Run | tuple[None, None, None]:
    return min(runs, key=lambda run: (-run[1], run[0], run[2])) if runs else (None, None, None)


def run_batches(
    batches: Iterator[pa.RecordBatch], least: int, rewrite: Callable[[object, Words], Words] | None,
    schema: pa.Schema,
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in text_slices(batch, batch.schema.names[1]):
            keys = part.column(0).to_pylist()
            texts = [data[a:b].tobytes().split() for a, b in zip(offsets[:-1], offsets[1:])]
            if rewrite is not None:
                texts = [rewrite(key, words) for key, words in zip(keys, texts)]
            flat = pa.array([w for words in texts for w in words], pa.large_binary())
            ids = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
            bounds = np.append(0, np.cumsum([len(words) for words in texts]))
            runs = runs_of_slice(ids, bounds, least)
            best = [longest(found) for found in runs]
            rows = [
                {"start": s, "length": n, "period": p} for found in runs for s, n, p in found
            ]
            run_bounds = np.append(0, np.cumsum([len(found) for found in runs])).astype(np.int32)
            listed = pa.ListArray.from_arrays(
                pa.array(run_bounds), pa.array(rows, schema.field("runs").type.value_type)
            ).cast(schema.field("runs").type)
            columns = [
                part.column(0),
                pa.array([len(found) for found in runs], pa.int64()),
                *(pa.array([run[k] for run in best], pa.int64()) for k in range(3)),
                pa.array([n and 1000 * n // p for _, n, p in best], pa.int64()),
                listed,
                pa.array([b" ".join(collapsed(*x)).decode() for x in zip(texts, runs)], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *,
    least: int = LEAST_WORDS, rewrite: Callable[[object, Words], Words] | None = None,
) -> DataFrame:
    """Runs of words `[^\\x20\\x09-\\x0D]+` in every whole text.

    A run is a stretch of words with smallest period q and at least max(`least`, 2 q) words that
    no neighbouring word extends keeping the period. Per row: id, n_runs; start, length, period
    and exponent_milli of the longest run (of several the first, then that of the smallest
    period; NULL without a run); runs, all of them by start and period; collapsed, the words
    that no run holds behind its first period, joined by one space. Words are numbered from 0.

    Null and empty texts have no runs and an empty `collapsed`. Null ids and repeated rows are
    kept as they are, an empty table gives an empty result, further columns play no part.
    `rewrite` gives the words to search in place of those of a row, by id. Nothing is shuffled;
    a task holds texts of about a MB together, and a longer one by itself (some 200 bytes of
    memory a word).
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType

    kind = docs.schema[id_column].dataType
    rest = StructType.fromDDL(
        "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
        "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    )
    schema = StructType([StructField(id_column, kind), *rest.fields])
    run = partial(run_batches, least=least, rewrite=rewrite, schema=to_arrow_schema(schema))
    return docs.select(id_column, text_column).mapInArrow(run, schema)


def run_lines() -> Column:
    """All runs of a row as lines `start,length,period`, each with its line feed."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")


def planted_periods(key: object, words: Words) -> Words:
    """Every tenth text by the hash of its id repeats a part of itself up to its end."""
    n = len(words)
    if key is None or n == 0:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * (-(-(n - a) // p)))[: n - a]

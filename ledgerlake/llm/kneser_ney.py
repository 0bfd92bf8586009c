"""Interpolated modified Kneser-Ney bigram model over sorted arrays that workers map into memory.

Spark counts in three steps, each of which deals out what the tasks have already added up:

1. words, dealt by the range of their 64-bit hash. A block of the range is one sorted array of
   hashes with counts; the place of a word among all blocks is its number.
2. bigrams, as one 64-bit key (number of the word in front, number of the word). Keys are dealt
   by where they lie on a line on which every word has as much room as it has occurrences and
   the words behind it divide that room alike. So shards are ranges of keys with about equal
   counts, and a word that is in front of a third of all others is divided over many of them.
3. per word, how many bigrams it begins with one, two or more occurrences, and how many it ends.

The arrays are files in the shared folder. Workers map them into memory, so that a task holds
only pages it has looked at. A text's score is looked up in the same arrays, its distinct
bigrams in order of their keys.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache, partial
from urllib.parse import urlsplit
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.arrow import record_batch, text_slices
from ledgerlake.llm.tables import written
from ledgerlake.sources.scratch import scratch_dir

END = b" "  # stands behind the last word; no word has a blank
FOLDS, HELD_OUT = 7, 2
# Bytes of text for each block of words and each shard of bigrams: their number follows the input.
BLOCK_BYTES, SHARD_BYTES = 256 << 20, 64 << 20
PENDING = 2_000_000  # occurrences a task adds up before it hands them on
MOST_WORDS = 3_000_000_000  # two word numbers have to fit in one 64-bit key
FALLBACK_DISCOUNTS = (0.5, 1.0, 1.5)


# Arrays on their way between tasks

def packed(values: np.ndarray) -> bytes:
    """Whole numbers, compressed byte plane by byte plane; ascending ones by their differences."""
    planes = np.ascontiguousarray(values.astype("<i8")).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()


def packed_ascending(values: np.ndarray) -> bytes:
    return packed(np.diff(values.astype(np.int64), prepend=0))


def unpacked_ascending(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data))


def added_up(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order with the sums of their values (by row)."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(values, first, axis=0) if len(keys) else values


def groups(owner: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Stretches of equal entries of an ascending array."""
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[: len(owner)])
    for begin, end in zip(first, np.append(first[1:], len(owner))):
        yield int(owner[begin]), slice(begin, end)


# Arrays on disk

def mounted(path: str) -> str:
    parts = urlsplit(path)
    if parts.scheme not in ("", "file"):
        raise RuntimeError(f"arrays that are mapped into memory need a mounted folder, not {path}")
    return parts.path


def store(path: str, name: str, values: np.ndarray) -> None:
    """Write a file whole or not at all; a task that runs again writes the same content."""
    os.makedirs(path, exist_ok=True)
    part = f"{path}/.{name}-{uuid4().hex}"
    np.save(part, values, allow_pickle=False)
    os.replace(f"{part}.npy", f"{path}/{name}.npy")


@lru_cache(maxsize=4096)
def mapped(path: str, name: str) -> np.ndarray:
    file = f"{path}/{name}.npy"
    if not os.path.exists(file):
        return np.zeros(0, np.int64)
    values = np.load(file, mmap_mode="r")
    return np.asarray(values) if len(values) else np.zeros(0, np.int64)


# Tokens

def signed(hashes: list[int]) -> np.ndarray:
    """64-bit hashes as signed numbers in the same order."""
    return (np.array(hashes, np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


@dataclass
class Tokens:
    """Tokens of some texts behind each other, each text with its end."""

    hashes: np.ndarray  # of the distinct words
    place: np.ndarray  # of each token among these
    begin: np.ndarray  # first token of each text
    size: np.ndarray  # tokens of each text

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Tokens:
        texts = [data[a:b].tobytes().lower().split() for a, b in zip(offsets[:-1], offsets[1:])]
        for words in texts:
            words.append(END)
        flat = pa.array([w for words in texts for w in words], pa.large_binary()).dictionary_encode()
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        return cls(
            signed([xxhash.xxh3_64_intdigest(w) for w in flat.dictionary.to_pylist()]),
            flat.indices.to_numpy().astype(np.int64), np.cumsum(size) - size, size,
        )


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Tokens]]:
    for batch in batches:
        for part, data, offsets in text_slices(batch, batch.schema.names[1]):
            yield part, Tokens.of(data, offsets)


# The model

@dataclass
class Model:
    """What a worker has to know to open the arrays."""

    path: str
    blocks: int  # a power of two
    shards: int
    tokens: int = 0
    texts: int = 0
    sizes: list[int] = field(default_factory=list)  # words of each block
    totals: list[int] = field(default_factory=list)  # tokens of each block
    lower: tuple[float, float, float] = FALLBACK_DISCOUNTS
    upper: tuple[float, float, float] = FALLBACK_DISCOUNTS
    bigrams: int = 0
    lower_share: float = 1.0  # what single words leave to the uniform distribution

    @property
    def words(self) -> int:
        return sum(self.sizes)

    def block_of_hash(self, hashes: np.ndarray) -> np.ndarray:
        if self.blocks == 1:
            return np.zeros(len(hashes), np.int64)
        high = np.uint64(64 - (self.blocks.bit_length() - 1))
        return ((hashes.view(np.uint64) ^ np.uint64(1 << 63)) >> high).astype(np.int64)

    def bases(self) -> np.ndarray:
        """Number of the first word of each block, and behind them the beginning of a text."""
        return np.append(0, np.cumsum(self.sizes, dtype=np.int64))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the words with these hashes, -1 for unknown ones."""
        out, bases = np.full(len(hashes), -1, np.int64), self.bases()
        block = self.block_of_hash(hashes)
        order = np.argsort(hashes)
        for b, part in groups(block[order]):
            known, wanted = mapped(self.path, f"words-{b}"), hashes[order[part]]
            if len(known):
                at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                out[order[part]] = np.where(known[at] == wanted, bases[b] + at, -1)
        return out

    def of_words(self, name: str, numbers: np.ndarray, at_begin: int = 0) -> np.ndarray:
        """Values of words by number; `at_begin` is that of the beginning of a text."""
        bases = self.bases()
        order = np.argsort(numbers)
        out = np.zeros(len(numbers), np.int64)
        for b, part in groups(np.searchsorted(bases, numbers[order], side="right") - 1):
            chosen = order[part]
            out[chosen] = at_begin if b == self.blocks else mapped(self.path, f"{name}-{b}")[numbers[chosen] - bases[b]]
        return out

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        return self.of_words("counts", numbers, self.texts)

    def before(self, numbers: np.ndarray) -> np.ndarray:
        """Occurrences of all words with smaller numbers."""
        blocks = np.append(np.cumsum([0, *self.totals])[: self.blocks], 0)
        block = np.searchsorted(self.bases(), numbers, side="right") - 1
        return self.of_words("before", numbers, self.tokens) + blocks[block]

    def of_followers(self, numbers: np.ndarray) -> np.ndarray:
        """Bigrams begun with 1, 2 and more occurrences, and bigrams ended, by word number."""
        bases = self.bases()
        order = np.argsort(numbers)
        out = np.zeros((len(numbers), 4), np.int64)
        for b, part in groups(np.searchsorted(bases, numbers[order], side="right") - 1):
            chosen = order[part]
            values = mapped(self.path, f"followers-{b}")
            if len(values):
                out[chosen] = values[numbers[chosen] - bases[b]]
        return out

    def shard_of(self, keys: np.ndarray) -> np.ndarray:
        """Shards of ascending bigram keys; never descending."""
        width = self.words + 1
        front, front_of = np.unique(keys // width, return_inverse=True)
        word, word_of = np.unique(keys % width, return_inverse=True)
        room = self.counts(front).astype(float)[front_of]
        share = (self.before(word) / max(self.tokens, 1))[word_of]
        line = self.before(front).astype(float)[front_of] + room * share
        place = (line / (self.tokens + self.texts) * self.shards).astype(np.int64)
        return np.minimum(place, self.shards - 1)

    def bigram_counts(self, keys: np.ndarray) -> np.ndarray:
        """Occurrences of ascending bigram keys."""
        out = np.zeros(len(keys), np.int64)
        for s, part in groups(self.shard_of(keys)):
            known = mapped(self.path, f"bigrams-{s}")
            if len(known):
                at = np.minimum(np.searchsorted(known, keys[part]), len(known) - 1)
                out[part] = np.where(known[at] == keys[part], mapped(self.path, f"bigram-counts-{s}")[at], 0)
        return out

    def word_values(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per distinct word: number, occurrences, probability by itself, and weight of that behind it."""
        numbers = self.numbers(tokens.hashes)
        known = numbers >= 0
        counts, followers = np.zeros(len(numbers), np.int64), np.zeros((len(numbers), 4), np.int64)
        counts[known] = self.counts(numbers[known])
        followers[known] = self.of_followers(numbers[known])
        alone = discounted(followers[:, 3], self.lower) / max(self.bigrams, 1)
        alone = alone + self.lower_share / (self.words + 1)
        weight = np.where(counts > 0, followers[:, :3] @ np.array(self.upper) / np.maximum(counts, 1), 1.0)
        return numbers, counts, alone, weight

    def token_logs(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences and log10 probability of every token."""
        numbers, counts, alone, weight = self.word_values(tokens)
        number, width = numbers[tokens.place], self.words + 1
        front = np.append(-1, number[:-1])
        front[tokens.begin] = self.words
        front_count = np.append(0, counts[tokens.place][:-1])
        front_count[tokens.begin] = self.texts
        begin = self.of_followers(np.array([self.words]))[0, :3] @ np.array(self.upper)
        front_weight = np.append(1.0, weight[tokens.place][:-1])
        front_weight[tokens.begin] = begin / self.texts if self.texts else 1.0
        seen = (number >= 0) & (front >= 0) & (front_count > 0)
        keys, key_of = np.unique(front[seen] * width + number[seen], return_inverse=True)
        together = np.zeros(len(number), np.int64)
        if len(keys):
            together[seen] = self.bigram_counts(keys)[key_of]
        first = np.where(together > 0, discounted(together, self.upper) / np.maximum(front_count, 1), 0.0)
        return counts[tokens.place], np.log10(first + front_weight * alone[tokens.place])


def discounted(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    taken = np.array([0.0, *discounts])[np.minimum(counts, 3)]
    return np.maximum(counts - taken, 0.0)


def discounts_of(n: list[int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and more from the numbers of counts 1 to 4."""
    ratio = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    out = []
    for k, fallback in enumerate(FALLBACK_DISCOUNTS):
        value = k + 1 - (k + 2) * ratio * n[k + 1] / n[k] if n[k] and ratio else fallback
        out.append(value if 0 < value <= k + 1 else fallback)
    return tuple(out)


def numbers_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in range(1, 5)]


# Counting

def count_words(batches: Iterator[pa.RecordBatch], model: Model, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def dealt(pending: list) -> pa.RecordBatch:
        hashes, counts = added_up(*map(np.concatenate, zip(*pending)))
        parts = list(groups(model.block_of_hash(hashes)))
        return record_batch(schema, [
            [b for b, _ in parts],
            [packed_ascending(hashes[part]) for _, part in parts],
            [packed(counts[part]) for _, part in parts],
        ])

    pending, size = [], 0
    for _, tokens in slices(batches):
        pending.append((tokens.hashes, np.bincount(tokens.place, minlength=len(tokens.hashes))))
        size += len(tokens.hashes)
        if size > PENDING:
            yield dealt(pending)
            pending, size = [], 0
    if pending:
        yield dealt(pending)


def merged(table: pa.Table, keys: str, values: str) -> tuple[np.ndarray, np.ndarray]:
    return added_up(
        np.concatenate([unpacked_ascending(b) for b in table[keys].to_pylist()]),
        np.concatenate([unpacked(b) for b in table[values].to_pylist()]),
    )


def store_words(block: int, table: pa.Table, model: Model, schema: pa.Schema) -> pa.Table:
    hashes, counts = merged(table, "keys", "numbers")
    store(model.path, f"words-{block}", hashes)
    store(model.path, f"counts-{block}", counts)
    store(model.path, f"before-{block}", np.cumsum(counts) - counts)
    return pa.Table.from_batches([record_batch(schema, [[block], [len(hashes)], [int(counts.sum())]])])


def count_bigrams(batches: Iterator[pa.RecordBatch], model: Model, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    width = model.words + 1

    def dealt(pending: list) -> pa.RecordBatch:
        keys, counts = added_up(*map(np.concatenate, zip(*pending)))
        parts = list(groups(model.shard_of(keys)))
        return record_batch(schema, [
            [s for s, _ in parts],
            [packed_ascending(keys[part]) for _, part in parts],
            [packed(counts[part]) for _, part in parts],
        ])

    pending, size = [], 0
    for _, tokens in slices(batches):
        number = model.numbers(tokens.hashes)[tokens.place]
        front = np.append(0, number[:-1])
        front[tokens.begin] = model.words
        pending.append(np.unique(front * width + number, return_counts=True))
        size += len(pending[-1][0])
        if size > PENDING:
            yield dealt(pending)
            pending, size = [], 0
    if pending:
        yield dealt(pending)


def store_bigrams(shard: int, table: pa.Table, model: Model, schema: pa.Schema) -> pa.Table:
    """Store a shard; returns its numbers of counts (block -1) and what it says of words, by block."""
    keys, counts = merged(table, "keys", "numbers")
    store(model.path, f"bigrams-{shard}", keys)
    store(model.path, f"bigram-counts-{shard}", counts.astype(np.min_scalar_type(int(counts.max()))))
    width, bases = model.words + 1, model.bases()
    ends, ended = np.unique(keys % width, return_counts=True)
    begun = np.stack([counts == 1, counts == 2, counts > 2, np.zeros(len(counts), bool)], axis=1)
    words, values = added_up(
        np.concatenate([keys // width, ends]),
        np.concatenate([begun.astype(np.int64), np.pad(ended[:, None], ((0, 0), (3, 0)))]),
    )
    parts = list(groups(np.searchsorted(bases, words, side="right") - 1))
    return pa.Table.from_batches([record_batch(schema, [
        [-1, *(b for b, _ in parts)],
        [packed_ascending(np.zeros(1)), *(packed_ascending(words[part]) for _, part in parts)],
        [packed(np.zeros(4)), *(packed(values[part].ravel()) for _, part in parts)],
        [[*numbers_of_counts(counts), len(keys)], *([0] * 5 for _ in parts)],
    ])])


def store_followers(block: int, table: pa.Table, model: Model, schema: pa.Schema) -> pa.Table:
    bases = np.append(model.bases(), model.words + 1)
    words, values = added_up(
        np.concatenate([unpacked_ascending(b) for b in table["keys"].to_pylist()]),
        np.concatenate([unpacked(b).reshape(-1, 4) for b in table["numbers"].to_pylist()]),
    )
    all_values = np.zeros((int(bases[block + 1] - bases[block]), 4), np.uint32)
    all_values[words - bases[block]] = values
    store(model.path, f"followers-{block}", all_values)
    ended = values[:, 3]
    more = int((ended > 2).sum())
    return pa.Table.from_batches([record_batch(schema, [[block], [[*numbers_of_counts(ended), more]]])])


def _per_group(
    rows: DataFrame, key: str, store_group: Callable[..., pa.Table], model: Model, ddl: str
) -> DataFrame:
    schema = _arrow(ddl)

    def run(table: pa.Table) -> pa.Table:
        return store_group(table[key][0].as_py(), table, model=model, schema=schema)

    return rows.groupBy(key).applyInArrow(run, ddl)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _power_of_two(n: int) -> int:
    return 1 << max(n - 1, 0).bit_length()


def fit(texts: DataFrame) -> Model:
    """Count the texts (id, text) and store the model's arrays in the shared folder."""
    spark = texts.sparkSession
    text = texts.columns[1]
    rows, size = texts.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    blocks = _power_of_two(-(-(size or 0) // BLOCK_BYTES))
    shards = max(-(-(size or 0) // SHARD_BYTES), 1)
    model = Model(mounted(scratch_dir(spark, "kneser-ney")), blocks, shards, texts=rows)
    if rows == 0:
        model.sizes, model.totals = [0] * blocks, [0] * blocks
        return model

    parts = "part int, keys binary, numbers binary"
    counted = texts.mapInArrow(partial(count_words, model=model, schema=_arrow(parts)), parts)
    ddl = "block int, words bigint, tokens bigint"
    stored = _per_group(counted, "part", store_words, model, ddl).collect()
    by_block = {r["block"]: (r["words"], r["tokens"]) for r in stored}
    model.sizes = [by_block.get(b, (0, 0))[0] for b in range(blocks)]
    model.totals = [by_block.get(b, (0, 0))[1] for b in range(blocks)]
    model.tokens = sum(model.totals)
    if model.words > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} distinct words")

    counted = texts.mapInArrow(partial(count_bigrams, model=model, schema=_arrow(parts)), parts)
    ddl = "block int, keys binary, numbers binary, totals array<bigint>"
    stored = written(_per_group(counted, "part", store_bigrams, model, ddl), "bigram-followers")
    numbers = stored.where("block = -1").agg(*(F.sum(F.col("totals")[k]) for k in range(5))).first()
    model.upper, model.bigrams = discounts_of(list(numbers[:4])), numbers[4]
    ddl = "block int, totals array<bigint>"
    by_word = _per_group(stored.where("block >= 0"), "block", store_followers, model, ddl)
    numbers = by_word.agg(*(F.sum(F.col("totals")[k]) for k in range(5))).first()
    model.lower = discounts_of(list(numbers[:4]))
    taken = sum(d * n for d, n in zip(model.lower, (numbers[0], numbers[1], numbers[4])))
    model.lower_share = taken / model.bigrams
    return model


# Scoring

def held_out(id_column: str) -> Column:
    """Whether a row takes no part in the fit; a null id does."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def score_batches(
    batches: Iterator[pa.RecordBatch], model: Model, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    unknown = model.tokens + model.words + 1
    for part, tokens in slices(batches):
        counts, logs = model.token_logs(tokens)
        base = np.log10((counts + 1) / unknown)
        score = np.add.reduceat(logs, tokens.begin)
        yield record_batch(schema, [
            part.column(0), part.column(2), tokens.size,
            np.add.reduceat((counts > 0).astype(np.int64), tokens.begin),
            np.full(len(score), model.tokens), np.add.reduceat(base, tokens.begin), score,
            10 ** np.minimum(-score / tokens.size, 300.0),
        ])


def lm_scores(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """log10 probability and perplexity of every whole text under a model of the texts not held out.

    Tokens are the words `[^\\x20\\x09-\\x0D]+`, A to Z in lower case, and one end. Per row: id,
    held_out (crc32 of the id as text modulo 7 is 2), n_tokens, n_known (tokens that the fitted
    texts have), train_tokens, base_score (single words, one added to each count), score
    (interpolated modified Kneser-Ney bigrams), perplexity.

    Null and empty texts are an end alone. Rows with a null id are not held out. Repeated rows
    are counted and scored each; without any text to fit, every token has probability 1, the
    share of the one unknown word. An empty table gives an empty result, further columns play
    no part. Words are told apart by 64-bit hashes; more than 3,000,000,000 distinct ones are an
    error. The shared folder has to be mounted on every executor; the arrays stay there as long
    as the result may be read.
    """
    from pyspark.sql.types import StructField, StructType

    kind = docs.schema[id_column].dataType
    texts = docs.select(F.col(id_column), F.col(text_column), held_out(id_column).alias("held_out"))
    model = fit(texts.where("NOT held_out").select(id_column, text_column))
    schema = StructType([
        StructField(id_column, kind),
        *StructType.fromDDL(
            "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
            "base_score double, score double, perplexity double"
        ).fields,
    ])
    from pyspark.sql.pandas.types import to_arrow_schema

    return texts.mapInArrow(partial(score_batches, model=model, schema=to_arrow_schema(schema)), schema)

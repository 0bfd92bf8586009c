"""Approximate nearest neighbours by multi-index hashing over learned rotated binary codes.

A vector becomes a binary code: the signs after rotations learned on a bounded
sample. A code is cut into substrings and each substring indexed. Two codes
within Hamming radius r agree in at least one substring within r // m bits
(pigeonhole), so probing all substring values that near finds every code within
the radius; what is found is ranked by the inner product of the vectors.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 10_000  # vectors that rotations and radius are learned on
SAMPLE_QUERIES = 200
COVERAGE = 0.97  # share of the true neighbours in the sample that lie within the radius
CODE_BITS, SUBSTRING_BITS = 256, 16
BLOCK_ROWS, BLOCK_QUERIES = 8_192, 4_096
SALTS = 32
MARGIN = 1e-9  # products of vectors of length 1 at most are exact to this


@dataclass(frozen=True)
class Coder:
    rotation: np.ndarray  # (dimensions + 1, CODE_BITS)
    top: float  # binary logarithm of the longest indexed vector's length
    radius: int

    def scaled(self, vectors: np.ndarray) -> np.ndarray:
        """Lengths of 1 at most. Codes are taken from these: squares of huge entries don't overflow."""
        whole = int(np.floor(self.top))
        return np.ldexp(vectors, -whole) / 2 ** (self.top - whole)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """One more dimension gives all vectors the same length: largest inner product
        becomes smallest angle. Queries get 0 there."""
        rest = np.maximum(1 - (vectors**2).sum(1), 0)
        return np.hstack([vectors, np.sqrt(rest)[:, None]])

    def codes(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Substrings of the codes, (rows, substrings) of 16 bits."""
        vectors = self.scaled(vectors)
        lifted = np.pad(vectors, ((0, 0), (0, 1))) if query else self.lifted(vectors)
        bits = (lifted @ self.rotation) > 0
        return np.packbits(bits, axis=1).view(">u2").astype(np.uint16)


def learn_rotation(sample: np.ndarray, bits: int, rounds: int = 20) -> np.ndarray:
    """Iterative quantisation: as many rotations as the bits need, each turned so that the
    signs of the rotated sample lie near the rotated sample itself."""
    width = sample.shape[1]
    generator = np.random.default_rng(7)
    parts = []
    for begin in range(0, bits, width):
        turn = np.linalg.qr(generator.normal(size=(width, width)))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(sample.T @ np.sign(sample @ turn))
            turn = left @ right
        parts.append(turn[:, : bits - begin])
    return np.hstack(parts)


_popcount = np.bitwise_count(np.arange(1 << SUBSTRING_BITS, dtype=np.uint16))
_ball = np.argsort(_popcount, kind="stable").astype(np.uint16)
_ball_sizes = np.cumsum(np.bincount(_popcount))


class Table:
    """One substring of a block of codes: its distinct values and the rows that carry each."""

    def __init__(self, column: np.ndarray):
        self.column = np.ascontiguousarray(column)
        self.rows = np.argsort(column, kind="stable")
        self.values, self.starts = np.unique(column[self.rows], return_index=True)
        self.starts = np.append(self.starts, len(column))

    def mark(self, found: np.ndarray, value: int, begin: int, end: int) -> None:
        """Mark the rows whose substring has a distance from `begin` to before `end` to the value.

        The values in the ball are looked up one by one if they are far fewer than those of
        the table; otherwise those are compared with the value, which finds the same.
        """
        ball = _ball[(_ball_sizes[begin - 1] if begin else 0) : _ball_sizes[end - 1]]
        if 16 * len(ball) >= len(self.values):
            found |= np.bitwise_count(self.column ^ np.uint16(value)) < end
            return
        sought = ball ^ np.uint16(value)
        at = np.minimum(np.searchsorted(self.values, sought), len(self.values) - 1)
        at = at[self.values[at] == sought]
        size = self.starts[at + 1] - self.starts[at]
        skip = np.repeat(self.starts[at] - (np.cumsum(size) - size), size)
        found[self.rows[np.arange(len(skip)) + skip]] = True


class MultiIndex:
    """Substring tables of a block of codes."""

    def __init__(self, codes: np.ndarray):
        self.packed = np.ascontiguousarray(codes).view(np.uint64)
        self.tables = [Table(column) for column in codes.T]

    def within(self, code: np.ndarray, radius: int, at_least: int) -> np.ndarray:
        """All rows within the radius; the radius grows while they are fewer than `at_least`."""
        many, rows = len(self.tables), len(self.packed)
        found = np.zeros(rows, bool)
        reached = [0] * many
        at_least = min(at_least, rows)
        packed = np.ascontiguousarray(code).view(np.uint64)
        while True:
            for t, table in enumerate(self.tables):
                end = min(radius // many - (t > radius % many), SUBSTRING_BITS) + 1
                if end > reached[t]:
                    table.mark(found, int(code[t]), reached[t], end)
                    reached[t] = end
            near = np.flatnonzero(found)
            distance = np.bitwise_count(self.packed[near] ^ packed).sum(axis=1, dtype=np.int64)
            near = near[distance <= radius]
            if len(near) >= at_least or radius >= many * SUBSTRING_BITS:
                return near
            radius += many


def learn(vectors: np.ndarray, top: float, k: int) -> Coder:
    width = vectors.shape[1]
    coder = Coder(np.zeros((width + 1, CODE_BITS)), top, 0)
    scaled = coder.scaled(vectors)
    rotation = learn_rotation(coder.lifted(scaled), CODE_BITS)
    coder = Coder(rotation, top, 0)
    queries = np.linspace(0, len(vectors) - 1, min(SAMPLE_QUERIES, len(vectors))).astype(int)
    codes, sought = coder.codes(vectors), coder.codes(vectors[queries], query=True)
    distances = []
    for n, q in enumerate(queries):
        scores = scaled @ scaled[q]
        scores[q] = -np.inf
        nearest = np.argsort(-scores)[: min(k, len(vectors) - 1)]
        distances.append(np.bitwise_count(codes[nearest] ^ sought[n]).sum(axis=1, dtype=np.int64))
    distances = np.concatenate(distances) if distances else np.zeros(0)
    radius = int(np.quantile(distances, COVERAGE)) + 1 if len(distances) else CODE_BITS
    return Coder(rotation, top, radius)


def search_block(
    rows: pd.DataFrame, queries: pd.DataFrame, coder, k: int
) -> pd.DataFrame:
    """The best k of one block of vectors for one block of queries."""
    out: list[tuple] = []
    if len(rows) and len(queries):
        own: Coder = coder.value
        vectors = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
        members = [np.asarray(m, np.int64) for m in rows["members"]]
        index = MultiIndex(own.codes(vectors))
        sought = np.stack(queries["embedding"].to_numpy()).astype(np.float64)
        codes = own.codes(sought, query=True)
        scaled, asked = own.scaled(vectors), own.scaled(sought)
        for n, query_id in enumerate(queries["query_id"].to_numpy()):
            near = index.within(codes[n], own.radius, k + 1)
            if len(near) > k + 1:
                # A first ranking, whose sums may differ in their last bits, keeps a margin.
                rough = scaled[near] @ asked[n]
                least = np.partition(rough, -(k + 1))[-(k + 1)]
                near = near[rough >= least - MARGIN]
            with np.errstate(over="ignore", invalid="ignore"):
                scores = (vectors[near] * sought[n]).sum(axis=1)
            ids = np.concatenate([members[r] for r in near])
            scores = np.repeat(scores, [len(members[r]) for r in near])
            scores, ids = scores[ids != query_id], ids[ids != query_id]
            for r in np.lexsort((ids, -scores))[:k]:
                out.append((query_id, ids[r], scores[r]))
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
        {"query_id": "int64", "vec_id": "int64", "score": "float64"}
    )


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """Rows with an id and a finite non-zero vector of the most frequent length."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("embedding").alias("d")).count()
    first = lengths.orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("embedding") == (first["d"] if first else 0))


def length_log(column: str) -> Column:
    """Binary logarithm of the vector's length, without overflow."""
    top = F.array_max(F.transform(column, lambda x: F.abs(x.cast("double"))))
    shares = F.transform(column, lambda x: x.cast("double") / top)
    return F.log2(top) + F.log2(F.aggregate(shares, F.lit(0.0), lambda a, x: a + x * x)) / 2


def nearest_neighbours(embeddings: DataFrame, k: int = 20, query_step: int = 20) -> DataFrame:
    """The k nearest vectors of each query row: query_id, rank, vec_id, score.

    Queries are the rows whose vec_id is divisible by `query_step`, candidates all
    rows with another id. Vectors that are null, zero or of an unusual length, or
    hold null or non-finite components, and rows without an id take no part.
    Repeated rows count once, equal vectors of different ids are all found, ties
    go to the smaller id. An empty table gives an empty result; further columns
    play no part.

    Equal vectors are one entry that carries its k + 1 smallest ids: no more of
    them can be among k results. Those ids are found in salted steps, so that a
    vector that a third of all rows hold does not meet in one task. Entries are
    dealt into blocks of bounded size, each with an index of its own, and each
    block of queries visits each of them; only k rows per query and block go on.
    """
    spark = embeddings.sparkSession
    rows = usable_vectors(embeddings)
    number = rows.agg(
        F.count("*").alias("n"), F.sum((F.col("vec_id") % query_step == 0).cast("long")).alias("q"),
        F.max(length_log("embedding")).alias("top"),
    ).first()
    share = min(1.0, SAMPLE_ROWS / max(number["n"], 1))
    place = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000))
    sample = (
        rows.where(place < int(1e6 * share) + 1).orderBy(F.xxhash64("vec_id")).limit(2 * SAMPLE_ROWS)
        .select("embedding").toArrow()["embedding"].to_pylist()
    )
    if not sample:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    coder = spark.sparkContext.broadcast(learn(np.array(sample, np.float64), number["top"], k))

    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))
    smallest = lambda *keys: Window.partitionBy("embedding", *keys).orderBy("vec_id")
    entries = (
        rows.distinct()
        .withColumn("salt", salt)
        .withColumn("n", F.row_number().over(smallest("salt"))).where(F.col("n") <= k + 1)
        .withColumn("n", F.row_number().over(smallest())).where(F.col("n") <= k + 1)
        .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    )
    blocks = -(-number["n"] // BLOCK_ROWS)
    chunks = max(1, -(-(number["q"] or 0) // BLOCK_QUERIES))
    dealt = entries.withColumn(
        "block", F.pmod(F.xxhash64(F.element_at("members", 1)), F.lit(blocks))
    ).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<bigint>")))
    queries = (
        rows.where(F.col("vec_id") % query_step == 0).distinct()
        .withColumnRenamed("vec_id", "query_id")
        .withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
    )
    found = dealt.groupBy("block", "chunk").cogroup(queries.groupBy("block", "chunk")).applyInPandas(
        partial(search_block, coder=coder, k=k), "query_id bigint, vec_id bigint, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

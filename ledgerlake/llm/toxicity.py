"""Toxicity by two class-conditional Kneser-Ney bigram models over shared backoff counts.

A toxic and an ordinary model are fitted on a bounded sample of labelled rows.
Both discount their bigrams, back off to the single words of their class and from
there to one shared distribution: in how many texts of the whole corpus a word
stands. As in any model of this kind the lower orders count contexts (here texts),
not occurrences.
A text is judged by the difference of its two log-likelihoods per word, turned
into a probability on labelled rows that neither model has seen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.arrow import record_batch

# Bounds of the fit: rows of each class for the models and for the calibration,
# and the longest text that takes part in the fit. Every text is scored whole.
FIT_ROWS = 2_500
CALIBRATION_ROWS = 2_000
FIT_TEXT_LENGTH = 100_000
# Discounts by order: an expression counted this often in a class or less says
# nothing by itself and gets its backed-off probability, and so does one that is
# not at least EXPECTED times as frequent as the next lower order predicts.
WORD_DISCOUNT, BIGRAM_DISCOUNT = 4.0, 60.0
EXPECTED = 3.0
FOLDS, HELD_OUT, CALIBRATION = 4, 2, 3
THRESHOLD = 0.3

_words = re.compile(r"[^\W_]+").findall


def words(text: str | None) -> list[str]:
    return _words(text.lower()) if text else []


@dataclass
class ClassTables:
    """Per class: bigram terms, context weights and unigram values, ready for look-up."""

    bigram: np.ndarray  # discounted probability of the seen bigrams, by bigram key
    weight: np.ndarray  # backoff weight by context word, last entry for unknown words
    unigram: np.ndarray  # discounted share of the texts by word
    share: float  # what a word gets from the shared distribution


@dataclass
class Model:
    vocab: dict[str, int]
    keys: np.ndarray
    toxic: ClassTables
    ordinary: ClassTables
    shared: np.ndarray
    slope: float = 0.0
    offset: float = 0.0
    prior: float = 0.0

    def ratios(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Difference of the log-likelihoods per word and number of words of each text.

        A word that no fitted text has gets nothing but its shared probability in
        both models; it cancels out, whatever it is.
        """
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        size, total = len(self.vocab), int(lengths.sum())
        get = self.vocab.get
        ids = np.fromiter((get(w, size) for ws in texts for w in ws), np.int64, total)
        before = np.append(size, ids[:-1])[:total]
        before[(np.cumsum(lengths) - lengths)[lengths > 0]] = size
        pair = before * (size + 1) + ids
        at = np.searchsorted(self.keys, pair)
        at[at == len(self.keys)] = 0
        seen = self.keys[at] == pair if len(self.keys) else np.zeros(total, bool)
        logs = []
        for own in (self.toxic, self.ordinary):
            lower = own.unigram[ids] + own.share * self.shared[ids]
            upper = np.where(seen, own.bigram[at], 0.0) if len(self.keys) else 0.0
            logs.append(np.log(upper + own.weight[before] * lower))
        owner = np.repeat(np.arange(len(texts)), lengths)
        sums = np.bincount(owner, logs[0] - logs[1], minlength=len(texts))
        return sums / np.maximum(lengths, 1), lengths

    def scores(self, texts: list[list[str]]) -> np.ndarray:
        """Texts without words get the share of toxic rows among the labelled ones."""
        ratio, lengths = self.ratios(texts)
        value = 1 / (1 + np.exp(-np.clip(self.slope * ratio + self.offset, -500, 500)))
        return np.where(lengths > 0, value, self.prior)


def class_tables(
    texts: list[np.ndarray], size: int, keys: np.ndarray, shared: np.ndarray
) -> ClassTables:
    """Discounted probabilities of one class.

    A count is the number of texts or, if less, of different words in front: neither
    a long text nor a passage that was copied many times speaks for a class. It
    is discounted by a constant of its order plus `EXPECTED` times what the next lower
    order predicts; all mass taken away goes to that lower order.
    """
    single = [np.unique(a) for a in texts]
    in_texts = np.bincount(np.concatenate(single), minlength=size + 1) if single else np.zeros(size + 1)
    of = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    pairs = [a[:-1] * (size + 1) + a[1:] for a in texts]
    types, counts = np.unique(of([np.unique(p) for p in pairs]), return_counts=True)
    first, second = types // (size + 1), types % (size + 1)
    found = np.minimum(in_texts, np.bincount(second, minlength=size + 1))
    total = max(float(found.sum()), 1.0)
    expected = total * np.append(shared[:size], 0.0)
    unigram = np.maximum(found - WORD_DISCOUNT - EXPECTED * expected, 0) / total
    share = 1 - unigram.sum()

    place = np.searchsorted(types, of([p[1:] for p in pairs]))
    triples = np.unique(place * (size + 1) + of([a[:-2] for a in texts]))
    counts = np.minimum(counts, np.bincount(triples // (size + 1), minlength=len(types)))
    context = np.bincount(first, counts, minlength=size + 1)
    lower = unigram[second] + share * shared[second]
    kept = np.maximum(counts - BIGRAM_DISCOUNT - EXPECTED * context[first] * lower, 0)
    bigram = np.zeros(len(keys))
    bigram[np.searchsorted(keys, types)] = kept / np.maximum(context[first], 1)
    used = np.bincount(first, kept, minlength=size + 1)
    weight = np.where(context > 0, 1 - used / np.maximum(context, 1), 1.0)
    return ClassTables(bigram, weight, unigram, share)


def balanced(labels: list[int]) -> list[int]:
    """Places of as many rows of either class, the first ones, where there are both.

    Of two models the one that has read more would know more expressions, which
    tells the classes apart by size.
    """
    of = {y: [n for n, label in enumerate(labels) if label == y] for y in (0, 1)}
    n = min(map(len, of.values())) or len(labels)
    return of[0][:n] + of[1][:n]


def numbered(texts: list[str]) -> tuple[dict[str, int], list[np.ndarray]]:
    """All words of the texts with numbers, and the texts in these numbers."""
    vocab: dict[str, int] = {}
    ids = []
    for text in texts:
        ws = words(text)
        ids.append(np.fromiter((vocab.setdefault(w, len(vocab)) for w in ws), np.int64, len(ws)))
    return vocab, ids


def fit(
    ids: list[np.ndarray], labels: list[int], vocab: dict[str, int], shared: np.ndarray
) -> Model:
    """The two models over one shared distribution."""
    size = len(vocab)
    keys = [np.unique(a[:-1] * (size + 1) + a[1:]) for a in ids if len(a) > 1]
    keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    toxic, ordinary = (
        class_tables([a for a, y in zip(ids, labels) if y == k], size, keys, shared) for k in (1, 0)
    )
    return Model(vocab, keys, toxic, ordinary, shared)


def calibrate(model: Model, rows: list[tuple[str, int, float]], step: int = 64) -> None:
    """Logistic curve over the ratio; rows carry how many rows of their class they stand for."""
    parts = [model.ratios([words(r[0]) for r in rows[n : n + step]]) for n in range(0, len(rows), step)]
    x, lengths = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in (0, 1))
    y = np.array([r[1] for r in rows], float)[lengths > 0]
    weight = np.array([r[2] for r in rows], float)[lengths > 0]
    x = x[lengths > 0]
    if not len(x) or y.min() == y.max():
        model.slope, model.offset = 10.0, 0.0
        return
    spread = x.std() or 1.0
    design = np.stack([x / spread, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - 1e-3 * beta
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    model.slope, model.offset = float(beta[0] / spread), float(beta[1])


def fold(id_column: str) -> Column:
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(FOLDS))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[list, list, float]:
    """Rows for the models, rows for the calibration, and the share of toxic rows.

    Of ids with contradicting labels the larger label counts. The sample is
    chosen by a hash of the id; its ids, some 9,000 at most, are the only thing
    that is broadcast.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("part", fold("doc_id") == CALIBRATION)
        .where(fold("doc_id") != HELD_OUT)
    )
    counts = {(r["part"], r["toxic"]): r["n"] for r in known.groupBy("part", "toxic").agg(F.count("*").alias("n")).collect()}
    limit = {True: CALIBRATION_ROWS, False: FIT_ROWS}
    kept = {k: min(1.0, limit[k[0]] / n) for k, n in counts.items()}
    if not kept:
        return [], [], 0.0
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    of = lambda values: F.create_map(*[x for k, v in values.items() for x in (F.lit(f"{k[0]} {k[1]}".lower()), F.lit(v))])[
        F.concat_ws(" ", F.col("part").cast("string"), F.col("toxic").cast("string"))
    ]
    ids = known.where(place < of({k: 1e6 * v for k, v in kept.items()}))
    sample = (
        docs.select("doc_id", "text")
        .where(F.length("text") <= FIT_TEXT_LENGTH)
        .join(F.broadcast(ids), "doc_id")
        .select("part", "toxic", "text", F.xxhash64("doc_id", "text").alias("h"))
        .toArrow().to_pylist()
    )
    sample.sort(key=lambda r: (r["h"], r["text"]))
    model = [(r["text"], r["toxic"]) for r in sample if not r["part"]]
    rest = [(r["text"], r["toxic"], 1 / kept[r["part"], r["toxic"]]) for r in sample if r["part"]]
    toxic = sum(n for k, n in counts.items() if k[1] == 1)
    return model, rest, toxic / sum(counts.values())


def count_batches(batches: Iterator[pa.RecordBatch], vocab, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Of each task: in how many texts every fitted word occurs, and all other words together."""
    known = vocab.value
    size = len(known)
    total = np.zeros(size + 1, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            ids = [known.get(w, size) for w in set(words(text))]
            np.add.at(total, ids, 1)
    found = np.flatnonzero(total)
    yield record_batch(schema, [found, total[found]])


def score_batches(
    batches: Iterator[pa.RecordBatch], model, schema: pa.Schema, rows: int = 256
) -> Iterator[pa.RecordBatch]:
    own = model.value
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            part = batch.slice(begin, rows)
            scores = own.scores([words(t) for t in part.column(part.num_columns - 1).to_pylist()])
            yield record_batch(schema, [*part.columns[:-1], scores])


def toxicity_model(docs: DataFrame, labels: DataFrame) -> Model:
    """Both models with the shared counts of all documents, and their calibration."""
    rows, rest, prior = labelled_sample(docs, labels)
    rows = [rows[n] for n in balanced([y for _, y in rows])]
    classes = [y for _, y in rows]
    known, ids = numbered([text for text, _ in rows])
    del rows
    size = len(known)
    spark = docs.sparkSession
    vocab = spark.sparkContext.broadcast(known)
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])
    counts = (
        docs.select("text")
        .mapInArrow(partial(count_batches, vocab=vocab, schema=schema), "word bigint, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n"))
        .toArrow()
    )
    shared = np.zeros(size + 1)
    shared[counts["word"].to_numpy()] = counts["n"].to_numpy()
    shared = (shared + 1) / (shared.sum() + size + 1)
    shared[size] = 1.0  # cancels out, see Model.ratios
    model = fit(ids, classes, known, shared)
    model.prior = prior
    calibrate(model, rest)
    return model


def with_scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of `docs` and the score of its text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    run = partial(score_batches, model=shared, schema=to_arrow_schema(schema))
    return docs.select("*", F.col("text").alias("_scored")).mapInArrow(run, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` with a score below the threshold, see `toxicity`."""
    name = "_score"
    while name in docs.columns:
        name += "_"
    return with_scores(docs, toxicity_model(docs, labels), name).where(F.col(name) < threshold).drop(name)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`.

    Labels are taken from rows of the folds other than `HELD_OUT` only; ids decide
    the fold and nothing else. Null and empty texts, and texts without words, get
    the share of toxic rows as their score. Repeated rows are scored each, null
    labels and labels without a document are ignored, an empty table gives an
    empty result and without labels every score is 0.5 or the prior 0. A null id has a
    null held_out. Further columns play no part. What is broadcast, the models, is
    bounded by the sample; the corpus counts cover every text.
    """
    scored = with_scores(docs.select("doc_id", "text"), toxicity_model(docs, labels))
    return scored.select(
        "doc_id", (fold("doc_id") == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

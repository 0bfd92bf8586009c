"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over neighbouring words; masked-out words may differ. The
seed hashes of all places of all texts are joined with those of the benchmark
items, and around each hit text and item are laid side by side: an overlap counts
if one stretch of words agrees in `AGREEMENT` of its places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Masks of equal span; 1 is compared, 0 is any word.
MASKS = ("110111010011", "101101110101", "111001011011")
SPAN = len(MASKS[0])
STRETCH = 20
AGREEMENT = 0.8
BROADCAST_SEEDS = 1_000_000


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s\p{Punct}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds_at(hashes: Column, place: Column, masks: list[str]) -> Column:
    """Per mask the hash of its words from `place` on, null where the text ends before."""
    out = []
    for n, mask in enumerate(masks):
        picked = [F.get(hashes, place + k) for k, bit in enumerate(mask) if bit == "1"]
        seed = F.xxhash64(F.lit(n), *picked)
        out.append(F.when(place + len(mask) <= F.size(hashes), seed))
    return F.array(*out)


def placed_seeds(rows: DataFrame, masks: list[str], place: str, seed: str) -> DataFrame:
    """One row for each place and mask; `words` stays with every row."""
    places = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1))
    return (
        rows.withColumn(place, F.explode(places))
        .withColumn(seed, F.explode(seeds_at(F.col("words"), F.col(place), masks)))
        .where(F.col(seed).isNotNull())
    )


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each text and item that overlap: doc_id, item_id, n_hits, agreement.

    n_hits counts the seeds that led to an overlap, agreement is the best share of equal
    words in a stretch of `STRETCH` words (the whole item, if shorter). Items with
    fewer words than a mask are sought word for word, items without words not at
    all. Null and empty texts overlap with nothing; rows with a null id are
    reported under it, repeated rows count once, further columns play no part.

    The seeds of the benchmark are broadcast only if they are counted to be
    `BROADCAST_SEEDS` or fewer; beyond that Spark joins by shuffle. A passage that
    very many texts share gives them one row each and is counted before the
    shuffle.
    """
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("item")).where(F.size("item") > 0)
    sizes = [r["n"] for r in items.where(F.size("item") < SPAN).select(F.size("item").alias("n")).distinct().collect()]
    short = ["1" * n for n in sorted(sizes)]
    masks = [*MASKS, *short]
    long_items = placed_seeds(items.withColumnRenamed("item", "words"), masks, "at", "seed")
    # An item is sought by the long masks or, as a whole, by the one of its own length.
    long_items = long_items.where((F.size("words") >= SPAN) | (F.col("at") == 0)).withColumnRenamed("words", "item")
    seeds = long_items.distinct()
    if seeds.count() <= BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    texts = docs.select("doc_id", word_hashes(F.col("text")).alias("words"))
    hits = placed_seeds(texts, masks, "place", "seed").join(seeds, "seed")

    # The part of the text that lies beside the item leaves the row of the whole text
    # right behind the join, in generated code.
    start = F.col("place") - F.col("at")
    begin = F.greatest(start, F.lit(0))
    hits = hits.select(
        "doc_id", "item_id", start.alias("start"), "at", "item",
        F.slice("words", begin + 1, F.size("item") - (begin - start)).alias("beside"),
    )
    length = F.size("item")
    equal = F.concat(
        F.array_repeat(F.lit(0), F.greatest(-F.col("start"), F.lit(0))),
        F.zip_with(
            F.slice("item", F.greatest(-F.col("start"), F.lit(0)) + 1, length), F.col("beside"),
            lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)),
        ),
    )
    hits = hits.select(
        "doc_id", "item_id", "start", "at", F.least(length, F.lit(STRETCH)).alias("stretch"),
        length.alias("n"), equal.alias("equal"),
    )
    lowest = F.greatest(F.lit(0), F.col("at") + F.least(F.lit(SPAN), F.col("n")) - F.col("stretch"))
    highest = F.greatest(lowest, F.least(F.col("at"), F.col("n") - F.col("stretch")))
    agreed = lambda s: F.aggregate(F.slice("equal", s + 1, F.col("stretch")), F.lit(0), lambda a, x: a + x)
    best = F.array_max(F.transform(F.sequence(lowest, highest), agreed)) / F.col("stretch")
    # Filtered only behind the grouping: as a condition of the join it would take the
    # join, and with it all places of all texts, out of generated code.
    return (
        hits.select("doc_id", "item_id", best.alias("agreement"))
        .groupBy("doc_id", "item_id")
        .agg(F.count_if(F.col("agreement") >= AGREEMENT).alias("n_hits"), F.max("agreement").alias("agreement"))
        .where(F.col("agreement") >= AGREEMENT)
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that overlap with no benchmark item, by id and text.

    Of rows with one id, or with none, those go whose own text overlaps.
    """
    keyed = docs.select(
        F.struct(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text")).alias("doc_id"), "text"
    )
    leaked = benchmark_leaks(keyed, benchmark).select(F.col("doc_id").alias("key")).distinct().alias("leaked")
    own = docs.alias("own")
    same = F.col("own.doc_id").eqNullSafe(F.col("leaked.key.doc_id")) & (
        F.xxhash64("own.text") == F.col("leaked.key.text")
    )
    return own.join(leaked, same, "left_anti")

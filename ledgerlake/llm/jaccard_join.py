"""N-gram Jaccard join by grouped prefixes.

The shingles of a document are put in one global order, rarest first. Two sets with
a Jaccard similarity of t or more share a shingle among the first n - ceil(t n) + 1
of each (prefix). Documents with equal prefixes and sizes form one group; groups
that share prefix shingles are filtered by size, by position and by how many prefix
shingles they share, then the pairs that are left are expanded to members and verified on
the whole sets of their texts. Until then no set is written or shuffled: texts are read once
more, and only those of the pairs.

Of two prefixes the one that ends first in the global order can meet the other set only in
the other prefix. So if c shingles are in both prefixes, the sets share at most c and
what the longer remainder behind a prefix holds: mere chance meetings do not get any further.
Bit masks of the prefixes bound c from above already where prefixes meet.

Only what is connected matters, so verification comes in two rounds. In the first
every group is compared with the group it shares most shingles with among the
first holders of its shingles: one pair for each group, however many copies there
are. The second looks at all pairs that are not connected by then.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerlake.llm.anchors import (
    Spans,
    as_signed,
    met_twice,
    mixed,
    repeated_cells,
    sketch_size,
    word_spans,
    word_units,
)
from ledgerlake.llm.arrow import record_batch, text_slices
from ledgerlake.llm.components import components
from ledgerlake.llm.tables import written

SHINGLE = 5
TENTHS = 8  # similarity of 0.8, as whole tenths
LISTED = 200_000  # most frequent shingles whose order is known; the others count as rare
COUNTED_AT_ONCE = 2_000_000
BYTES_PER_SHINGLE = 30  # of text, per shingle that is counted
MASK_WORDS = 8  # of 64 bits, for the prefix shingles of a set


class Sets:
    """Distinct shingles of some texts, one after the other, and which text each is of."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, shingle: int):
        upper = (data >= 65) & (data <= 90)
        data = data | (upper.astype(np.uint8) << 5)
        begin, end, texts = word_spans(data, offsets)
        spans = Spans(word_units(data, begin, end), 0)
        words = np.diff(texts)
        owner = np.repeat(np.arange(len(words)), words)
        start = np.arange(len(owner))
        last = np.minimum(start + shingle, texts[owner + 1])
        whole = (start + shingle <= texts[owner + 1]) | (start == texts[owner])
        value, owner = spans.hashes(start[whole], last[whole]), owner[whole]
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        new = np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]))[: len(value)]
        self.value, self.owner = value[new], owner[new]
        self.sizes = np.bincount(self.owner, minlength=len(words))
        self.ends = np.cumsum(self.sizes)


def frequent_batches(batches: Iterator[pa.RecordBatch], shingle: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Shingles that several texts of a stretch of a task have."""
    held, n = [], 0

    def counted():
        value, times = np.unique(np.concatenate(held), return_counts=True)
        often = np.argsort(-times, kind="stable")[:LISTED]
        often = often[times[often] > 2]
        return record_batch(schema, [as_signed(value[often]), times[often]])

    for batch in batches:
        for _, data, offsets in text_slices(batch):
            held.append(Sets(data, offsets, shingle).value)
            n += len(held[-1])
            if n >= COUNTED_AT_ONCE:
                yield counted()
                held, n = [], 0
    if held:
        yield counted()


def frequencies(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles and in how many texts they are, about.

    They only settle the order of shingles. Any order gives the same links; this one
    keeps what very many texts share out of the prefixes.
    """
    ddl = "shingle bigint, n bigint"
    run = partial(frequent_batches, shingle=shingle, schema=to_arrow_schema(StructType.fromDDL(ddl)))
    table = (
        docs.select("text").mapInArrow(run, ddl).groupBy("shingle").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "shingle").limit(LISTED).toArrow()
    )
    shingle, n = table["shingle"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(shingle)
    return shingle[order], n[order]


class Prefixes:
    """The prefix of every set in the global order.

    At most `spare` shingles of a set may be missing in a set that is linked to it;
    the prefix is one longer. `anchor` are the shingles, in order of the sets.
    """

    def __init__(self, sets: Sets, listed: tuple[np.ndarray, np.ndarray], tenths: int):
        shingle, n = listed
        often = np.zeros(len(sets.value), np.int64)
        if len(shingle):
            at = np.minimum(np.searchsorted(shingle, sets.value), len(shingle) - 1)
            often = np.where(shingle[at] == sets.value, n[at], 0)
        order = np.lexsort((sets.value, often, sets.owner))
        place = np.arange(len(order)) - (sets.ends - sets.sizes)[sets.owner]
        self.spare = sets.sizes - (tenths * sets.sizes + 9) // 10
        inside = place <= self.spare[sets.owner]
        self.anchor, self.owner, self.place = sets.value[order][inside], sets.owner[inside], place[inside]


def prefix_shingles(data: np.ndarray, offsets: np.ndarray, listed, shingle: int, tenths: int) -> Prefixes:
    return Prefixes(Sets(data, offsets, shingle), listed.value, tenths)


def document_batches(
    batches: Iterator[pa.RecordBatch], listed, bits, size: int, shingle: int, tenths: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Per text its set's size and hash, and the shingles of its prefix that another text may have."""
    for batch in batches:
        for rows, data, offsets in text_slices(batch):
            sets = Sets(data, offsets, shingle)
            prefix = Prefixes(sets, listed.value, tenths)
            many = rows.num_rows
            sums = np.zeros((2, many), np.uint64)
            np.add.at(sums[0], sets.owner, mixed(sets.value))
            np.add.at(sums[1], sets.owner, mixed(sets.value ^ np.uint64(0x5851F42D4C957F2D)))
            group = np.zeros(many, np.uint64)
            np.add.at(group, prefix.owner, mixed(prefix.anchor + np.uint64(1)))
            group = mixed(group ^ sets.sizes.astype(np.uint64))
            kept = met_twice(prefix.anchor, bits.value, size)
            # Linked sets share a shingle of both prefixes, whatever their sizes: it is met twice.
            owner, anchor, place = prefix.owner[kept], prefix.anchor[kept], prefix.place[kept]
            ends = pa.array(np.append(0, np.cumsum(np.bincount(owner, minlength=many))).astype(np.int32))
            yield record_batch(schema, [
                rows.column(0), sets.sizes, as_signed(sums[0]), as_signed(sums[1]), as_signed(group),
                pa.ListArray.from_arrays(ends, pa.array(as_signed(anchor))),
                pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int64))),
                masks(anchor, owner, many),
            ])


def masks(anchor: np.ndarray, owner: np.ndarray, many: int) -> pa.ListArray:
    """One bit for each prefix shingle of each set."""
    bit = mixed(anchor)
    words = np.zeros((many, MASK_WORDS), np.uint64)
    at = ((bit >> np.uint64(6)) % np.uint64(MASK_WORDS)).astype(np.int64)
    np.bitwise_or.at(words, (owner, at), np.uint64(1) << (bit & np.uint64(63)))
    ends = pa.array(np.arange(0, many * MASK_WORDS + 1, MASK_WORDS, dtype=np.int32))
    return pa.ListArray.from_arrays(ends, pa.array(as_signed(words.ravel())))


def shared_by_masks() -> Column:
    """No fewer prefix shingles than a and b share: a bit that only one mask has is a shingle
    of that prefix that the other one does not hold."""
    only = lambda x, y: " + ".join(f"bit_count(mask_{x}[{n}] & ~mask_{y}[{n}])" for n in range(MASK_WORDS))
    return F.expr(f"least(many_a - ({only('a', 'b')}), many_b - ({only('b', 'a')}))")


def shingle_set(text: str, shingle: int) -> set:
    """The distinct shingles of a text as words, without hashes."""
    words = text.encode().lower().split()
    if len(words) < shingle:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(shingle))))


def verified_batches(
    batches: Iterator[pa.RecordBatch], shingle: int, tenths: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good, known, of_known = [], None, set()
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if a != known:  # neighbouring pairs often have a text in common
                known, of_known = a, shingle_set(a, shingle)
            other = shingle_set(b, shingle)
            shared = len(of_known & other)
            good.append(10 * shared >= tenths * (len(of_known) + len(other) - shared))
        yield record_batch(schema, list(batch.filter(pa.array(good, pa.bool_())).columns[:2]))


def verified(pairs: DataFrame, docs: DataFrame, kind: str, shingle: int, tenths: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough, as a written table.

    Pairs are written first: few of them are then broadcast by Spark, by their size, and all
    texts but theirs are left out before anything is shuffled.
    """
    ddl = f"a {kind}, b {kind}"
    run = partial(
        verified_batches, shingle=shingle, tenths=tenths, schema=to_arrow_schema(StructType.fromDDL(ddl))
    )
    pairs = written(pairs, "jaccard-pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
    texts = written(
        docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(ids, "doc_id", "left_semi"),
        "jaccard-texts",
    )
    with_texts = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b")
    checked = with_texts.select("a", "b", "x", "y").mapInArrow(run, ddl)
    return written(checked.distinct(), "jaccard-links")


def most_shared(tenths: int, c: Column) -> Column:
    """Shingles that sets of n_a and n_b can have in common, if `c` are in both prefixes."""
    behind = lambda n: F.greatest(F.expr(f"({tenths} * {n} + 9) div 10 - 1"), F.lit(0))
    return c + F.greatest(behind("n_a"), behind("n_b"))


def needed(tenths: int) -> Column:
    """Shingles that linked sets of n_a and n_b have in common at least."""
    return F.expr(f"({tenths} * (n_a + n_b) + {tenths + 9}) div {tenths + 10}")


def fitting_sizes(tenths: int) -> Column:
    return F.expr(f"10 * least(n_a, n_b) >= {tenths} * greatest(n_a, n_b)")


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, tenths: int = TENTHS) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row.

    Shingles have `shingle` words, a similarity of `tenths` tenths or more is a link.
    Words are lower-cased in A-Z; a text with fewer words is one shingle, one without words or a null text has none, links with nothing and is a component of
    its own. Rows with the same set are linked; rows that repeat an id are the same
    document. A row without an id takes no part and has a null component. An empty
    table gives an empty result, further columns play no part.

    Pairs are compared by the words of their shingles. Rows whose sets have equal sizes and
    equal 128-bit sums of hashes count as copies: they are one node from the
    start; no step emits the pairs within a group of similar texts that are already
    connected.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    broadcast = spark.sparkContext.broadcast
    listed = broadcast(frequencies(docs, shingle))
    size = sketch_size(docs, BYTES_PER_SHINGLE)
    front = partial(prefix_shingles, listed=listed, shingle=shingle, tenths=tenths)
    bits = broadcast(repeated_cells(docs, front, size))
    ddl = (
        f"doc_id {kind}, n bigint, s1 bigint, s2 bigint, g bigint,"
        " shingles array<bigint>, places array<bigint>, mask array<bigint>"
    )
    run = partial(
        document_batches, listed=listed, bits=bits, size=size, shingle=shingle, tenths=tenths,
        schema=to_arrow_schema(StructType.fromDDL(ddl)),
    )
    rows = written(docs.select("doc_id", "text").mapInArrow(run, ddl), "shingle-sets")

    usable = rows.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = usable.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("id"))
    kept = usable.where(F.size("shingles") > 0)
    nodes = written(
        kept.select("doc_id", "n", "s1", "s2", "g", "shingles", "places", "mask")
        .join(classes, ["n", "s1", "s2"]).where(F.col("doc_id") == F.col("id"))
        .select("id", "n", "g", "shingles", "places", "mask"),
        "shingle-nodes",
    )
    groups = nodes.groupBy("g").agg(F.min("id").alias("gid"))
    members = written(nodes.select("id", "n", "g").distinct().join(groups, "g"), "shingle-groups")
    posts = written(
        nodes.join(groups, (nodes["g"] == groups["g"]) & (F.col("id") == F.col("gid")))
        .select("gid", "n", F.explode(F.arrays_zip("shingles", "places")).alias("p"))
        .select("gid", "n", F.col("p.shingles").alias("shingle"), F.col("p.places").alias("place")),
        "shingle-posts",
    )
    first = posts.groupBy("shingle").agg(F.min("gid").alias("hub"), F.max("gid").alias("last")).where("hub != last")
    nearest = (
        posts.join(first, "shingle").where("gid != hub")
        .groupBy("gid", "hub").agg(F.count("*").alias("met"))
        .groupBy("gid").agg(F.max_by("hub", F.struct("met", "hub")).alias("hub"))
    )
    of_group = nodes.select(F.col("id").alias("gid"), "n", "shingles")
    chosen = (
        nearest.join(of_group.withColumnsRenamed({"n": "n_a", "shingles": "a"}), "gid")
        .join(of_group.toDF("hub", "n_b", "b"), "hub")
        .select("gid", "hub", "n_a", "n_b", F.size(F.array_intersect("a", "b")).alias("c"))
        .where(fitting_sizes(tenths)).where(most_shared(tenths, F.col("c")) >= needed(tenths))
    )
    pairs = chosen.select(F.col("hub").alias("a"), F.col("gid").alias("b")).unionByName(
        members.where("id != gid").select(F.col("gid").alias("a"), F.col("id").alias("b"))
    )
    links = verified(pairs, docs, kind, shingle, tenths)
    labels = components(nodes.select("id").distinct(), links)

    labelled = members.join(labels, "id")
    cells = labelled.select("gid", "label").distinct()
    open_posts = posts.join(cells, "gid")
    split = open_posts.groupBy("shingle").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a != b")
    open_posts = open_posts.join(split.select("shingle"), "shingle", "left_semi")
    of_mask = nodes.select(F.col("id").alias("gid"), F.size("shingles").alias("many"), "mask")
    open_posts = written(open_posts.join(of_mask, "gid"), "open-posts")
    left = open_posts.select([F.col(c).alias(f"{c}_a") if c != "shingle" else F.col(c) for c in open_posts.columns])
    right = open_posts.select([F.col(c).alias(f"{c}_b") if c != "shingle" else F.col(c) for c in open_posts.columns])
    behind = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    cell_pairs = (
        left.join(right, "shingle")
        .where("label_a < label_b").where(fitting_sizes(tenths))
        # Shingles in front of the first shared one can't be shared; any other shared one
        # only makes this bound smaller, and the pair comes by its first one as well.
        .where(behind >= needed(tenths))
        .where(most_shared(tenths, shared_by_masks()) >= needed(tenths))
        .select("gid_a", "label_a", "gid_b", "label_b").distinct()
    )
    cell_pairs = (
        cell_pairs.join(of_group.toDF("gid_a", "n_a", "first"), "gid_a").join(of_group.toDF("gid_b", "n_b", "second"), "gid_b")
        .withColumn("c", F.size(F.array_intersect("first", "second")))
        .where(most_shared(tenths, F.col("c")) >= needed(tenths)).select("gid_a", "label_a", "gid_b", "label_b")
    )
    of = labelled.select("gid", "label", "id")
    open_pairs = (
        cell_pairs.join(of.toDF("gid_a", "label_a", "a"), ["gid_a", "label_a"])
        .join(of.toDF("gid_b", "label_b", "b"), ["gid_b", "label_b"])
        .select("a", "b").distinct()
    )
    more = verified(open_pairs, docs, kind, shingle, tenths)
    relabelled = components(
        labels.select(F.col("label").alias("id")).distinct(),
        more.join(labels.toDF("a", "la"), "a").join(labels.toDF("b", "lb"), "b")
        .select(F.col("la").alias("a"), F.col("lb").alias("b")),
    )
    final = labels.join(relabelled.toDF("label", "component"), "label").select("id", "component")
    of_class = classes.join(final, "id", "left").select(
        "n", "s1", "s2", F.coalesce("component", "id").alias("component_id")
    )
    out = rows.where("n > 0").select("doc_id", "n", "s1", "s2").join(of_class, ["n", "s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
    return out.unionByName(
        rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    )


def one_of_each_component(docs: DataFrame, shingle: int = SHINGLE, tenths: int = TENTHS) -> DataFrame:
    """The document with the smallest id of each component; rows without an id all stay.

    Of rows that repeat id and text one stays; different texts under one id are one document
    and stay or go together.
    """
    first = (
        jaccard_components(docs, shingle, tenths).where("doc_id = component_id").select("doc_id").distinct()
    )
    text_hash = "_text"
    while text_hash in docs.columns:
        text_hash += "_"
    named = docs.where(F.col("doc_id").isNotNull()).join(first, "doc_id", "left_semi")
    named = named.withColumn(text_hash, F.xxhash64("text")).dropDuplicates(["doc_id", text_hash])
    return named.drop(text_hash).unionByName(docs.where(F.col("doc_id").isNull()))

"""Line dedup over content-defined chunks of lines.

A rolling hash over the hashes of two neighbouring lines decides behind which lines a
chunk may end: these boundaries depend on the lines around them only and move with
them. A chunk begins at every line and goes on to the first boundary behind its second
line. So chunks overlap, and a repeated passage is found from its own first line on,
whatever stands before it. Lines of chunks that occur before, in a text with a smaller
id or further up in the same one, are removed after the chunks' bytes have been compared
with those of the first occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.tables import written

OPEN_EVERY = 4  # one line in so many is no boundary
LEAST_LINES = 2  # lines of a chunk that are not blank
MOST_LINES = 8  # a chunk without a boundary ends here


def chunk_spans(hashes: Column, solid: Column) -> Column:
    """begin, n and two hashes of all chunks; `solid` are the numbers of lines that are not blank.

    Blank lines belong to a chunk where they stand between its lines, and play no other part.
    """
    own = F.transform(solid, lambda n: F.get(hashes, n))
    rolled = F.zip_with(F.slice(own, 1, F.size(own) - 1), F.slice(own, 2, F.size(own) - 1), lambda x, y: F.xxhash64(x, y))
    # Of the line that follows the n-th one (from 0): does a chunk end behind it?
    ends = F.transform(rolled, lambda h: F.pmod(h, F.lit(OPEN_EVERY)) != 0)

    def of_block(block: Column) -> Column:
        def span(at: Column) -> Column:
            end = F.array_position(F.slice(block["ends"], at + 1, MOST_LINES - LEAST_LINES + 1), True).cast("int")
            latest = F.least(at + MOST_LINES - 1, F.size(block["solid"]) - 1)
            last = F.get(block["solid"], F.when(end > 0, at + LEAST_LINES - 2 + end).otherwise(latest))
            begin = F.get(block["solid"], at)
            return F.struct(begin.alias("begin"), (last - begin + 1).alias("n"))

        return F.transform(F.sequence(F.lit(0), F.size(block["solid"]) - LEAST_LINES), span)

    # Bound once as one value, so that no element of the arrays is computed more than once.
    block = F.array(F.struct(ends.alias("ends"), solid.alias("solid")))
    return F.flatten(F.transform(block, of_block))


def placed_chunks(rows: DataFrame) -> DataFrame:
    """doc_id, body, begin, n, h1, h2 of all chunks."""
    lines = F.split("text", "\n")
    solid = F.filter(
        F.transform(lines, lambda line, n: F.when(F.trim(line) != "", n)), lambda n: n.isNotNull()
    )
    bound = F.explode(F.array(F.struct(F.transform(lines, lambda x: F.xxhash64(x)).alias("hashes"), solid.alias("solid"))))
    cut = rows.select("doc_id", "body", bound.alias("of")).where(F.size("of.solid") >= LEAST_LINES)
    spans = F.transform(
        F.array(F.struct(F.col("of.hashes").alias("hashes"), chunk_spans(F.col("of.hashes"), F.col("of.solid")).alias("spans"))),
        lambda b: F.transform(b["spans"], lambda s: F.struct(
            s["begin"].alias("begin"), s["n"].alias("n"),
            F.xxhash64(F.slice(b["hashes"], s["begin"] + 1, s["n"])).alias("h1"),
            F.xxhash64(F.lit(1), F.slice(b["hashes"], s["begin"] + 1, s["n"])).alias("h2"),
        )),
    )
    return cut.select("doc_id", "body", F.explode(F.flatten(spans)).alias("span")).select("doc_id", "body", "span.*")


def line_dedup(docs: DataFrame) -> DataFrame:
    """All columns of `docs` with the new text, and n_lines and n_removed.

    Of equal chunks the one of the smallest (doc_id, text hash, place) stays; a
    null id comes first. Lines of all others go, with the blank lines between them. Rows that
    repeat both id and text are one text and treated alike. A null text stays null and has no
    lines, an empty one has one line. A text whose lines are all removed becomes empty. An empty
    table gives an empty result, further columns are kept, but for ones named n_lines or n_removed,
    which are replaced.

    Counting goes over hashes and is combined before the shuffle; a chunk that a
    third of all texts hold meets its first occurrence in a join that adaptive
    execution can cut. Texts are read again for the bytes of repeated chunks only. Work is
    linear in the lines of a text, since a chunk has `MOST_LINES` lines at most that are not blank.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # The given columns travel as one, so that no name of theirs meets one of the plan's.
    rows = docs.select(F.struct(*kept).alias("row")).withColumn("body", F.xxhash64("row.text"))
    named = rows.select(F.col("row.doc_id").alias("doc_id"), "body", F.col("row.text").alias("text"))
    named = named.where(F.col("text").isNotNull())
    placed = placed_chunks(named)
    where = F.struct("doc_id", "body", "begin")
    repeated = (
        placed.groupBy("h1", "h2")
        .agg(F.min(where).alias("first"), F.max(where).alias("last"))
        .where("first != last").select("h1", "h2", "first")
    )
    found = written(
        placed.join(repeated, ["h1", "h2"])
        .select(
            F.col("doc_id").alias("_id"), F.col("body").alias("_body"), "begin", "n", "h1", "h2",
            where.eqNullSafe(F.col("first")).alias("is_first"),
        )
        .groupBy("_id", "_body")
        .agg(F.array_sort(F.collect_set(F.struct("begin", "n", "h1", "h2", "is_first"))).alias("spans")),
        "line-spans",
    )
    same = named["doc_id"].eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body"))
    chunk = F.array_join(F.slice("lines", F.col("span.begin") + 1, F.col("span.n")), "\n")
    chunks = written(
        named.join(found, same).select("_id", "_body", F.explode(F.array(F.split("text", "\n"))).alias("lines"), "spans")
        .select("_id", "_body", "lines", F.explode("spans").alias("span"))
        .select("_id", "_body", "span.*", chunk.alias("chunk")),
        "line-chunks",
    )
    originals = chunks.where("is_first").select("h1", "h2", F.col("chunk").alias("original")).distinct()
    removed = (
        chunks.where(~F.col("is_first")).join(originals, ["h1", "h2"])
        .where(F.col("chunk") == F.col("original"))
        .groupBy("_id", "_body")
        .agg(F.array_sort(F.collect_set(F.struct("begin", (F.col("begin") + F.col("n")).alias("end")))).alias("spans"))
    )
    same = rows["row.doc_id"].eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body"))
    joined = rows.join(removed, same, "left").select(
        "row", F.explode(F.array(F.split("row.text", "\n"))).alias("lines"), between("spans").alias("gaps")
    )
    text = F.when(F.col("gaps").isNull(), F.col("row.text")).otherwise(F.array_join(kept_lines(), "\n"))
    gone = F.size("lines") - F.size(kept_lines())
    changed = joined.select(
        "row",
        F.struct(
            text.alias("text"),
            F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("bigint").alias("n_lines"),
            F.when(F.col("gaps").isNull(), 0).otherwise(gone).cast("bigint").alias("n_removed"),
        ).alias("new"),
    )
    return changed.select(
        *[F.col("new.text") if c == "text" else F.col("row").getField(c).alias(c) for c in kept],
        F.col("new.n_lines"), F.col("new.n_removed"),
    )


def between(spans: str) -> Column:
    """The stretches without a span, as begin and end; spans are in order and may overlap.

    A stretch reaches from where a span ends to where the next one begins; one that is
    inside another span has no lines. No span is contained in an earlier one but for its end.
    """
    begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["begin"]), F.array(F.lit(None).cast("int")))
    return F.zip_with(begins, ends, lambda b, e: F.named_struct(F.lit("begin"), b, F.lit("end"), e))


def kept_lines() -> Column:
    """The lines of the stretches between removed spans, each looked at once."""
    upto = lambda g: F.coalesce(g["end"], F.size("lines"))
    return F.flatten(F.transform(
        F.filter("gaps", lambda g: upto(g) > g["begin"]),
        lambda g: F.slice("lines", g["begin"] + 1, upto(g) - g["begin"]),
    ))

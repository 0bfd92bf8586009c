"""License scan: phrases, and an exact set-similarity join of text blocks with templates.

A block is one line of a text, a template a license notice. Both are sets of
words, ordered by how often a word occurs in the whole corpus, rarest first. A
block meets a template if it contains `CONTAINMENT` of the template's words.
Prefix filter: such a block holds one of the template's rarest words. Length
filter: it has at least as many words as must be shared. Positional filter: what
stands behind the shared word in both orders suffices for the rest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTAINMENT = 0.9

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# License notices and their labels.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-case words. Letters other than A-Z never become one of the phrases' letters
    alone, so lower() finds the same phrases as lower-casing A-Z does."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NO_WORD), "")


def word_counts(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """Occurrences of some fixed words in all texts."""
    counts = (
        docs.select(F.explode(words_of(F.col("text"))).alias("w"))
        .where(F.col("w").isin(words)).groupBy("w").agg(F.count("*").alias("n"))
    )
    return dict.fromkeys(words, 0) | {r["w"]: r["n"] for r in counts.collect()}


def phrase_places(words: Column, phrase: str) -> Column:
    """Words at which the phrase starts; looked for only where the joined words hold it."""
    parts = phrase.split(" ")
    last = F.size(words) - len(parts)
    matches = lambda i: F.array_position(
        F.array(F.slice(words, i + 1, len(parts)) == F.array(*map(F.lit, parts))), True
    ) > 0
    places = F.filter(F.sequence(F.lit(0), last), matches)
    padded = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    return F.when(padded.contains(f" {phrase} "), places).otherwise(F.array().cast("array<int>"))


def block_matches(lines: Column, ranked: list[str], templates: list[tuple[str, list[int], int]]) -> Column:
    """Label and containment of every template that a line meets.

    `ranked` are all template words, rarest first; templates hold ranks in order
    and the number of ranks that must be shared.
    """
    rank_of = F.create_map(*[x for n, w in enumerate(ranked) for x in (F.lit(w), F.lit(n))])
    kind = "array<struct<label:string,ranks:array<int>,need:int,at:int>>"
    index: dict[int, list[tuple]] = {}
    for label, ranks, need in templates:
        for at, rank in enumerate(ranks[: len(ranks) - need + 1]):
            index.setdefault(rank, []).append((label, ranks, need, at))
    entry = lambda e: F.struct(
        F.lit(e[0]).alias("label"), F.array(*map(F.lit, e[1])).alias("ranks"),
        F.lit(e[2]).alias("need"), F.lit(e[3]).alias("at"),
    )
    by_rank = F.create_map(*[
        x for r, entries in sorted(index.items())
        for x in (F.lit(r), F.array(*map(entry, entries)).cast(kind))
    ])
    prefixes = F.array(*map(F.lit, sorted(index)))

    def of_line(line: Column) -> Column:
        words = F.array_distinct(words_of(line))
        ranks = F.array_sort(F.filter(F.transform(words, lambda w: rank_of[w]), lambda r: r.isNotNull()))
        block = F.array(F.struct(ranks.alias("ranks"), F.size(words).alias("size")))
        return F.flatten(F.transform(block, of_block))

    def of_block(block: Column) -> Column:
        ranks = block["ranks"]

        def of_rank(rank: Column) -> Column:
            behind = F.size(ranks) - F.array_position(ranks, rank)
            fits = lambda e: (
                (block["size"] >= e["need"])
                & (1 + F.least(behind, F.size(e["ranks"]) - e["at"] - 1) >= e["need"])
                & (F.size(F.array_intersect(e["ranks"], ranks)) >= e["need"])
            )
            share = lambda e: F.size(F.array_intersect(e["ranks"], ranks)) / F.size(e["ranks"])
            return F.transform(
                F.filter(by_rank[rank], fits),
                lambda e: F.struct(e["label"].alias("label"), share(e).alias("share")),
            )

        return F.flatten(F.transform(F.array_intersect(ranks, prefixes), of_rank))

    return F.array_distinct(F.flatten(F.transform(lines, of_line)))


def license_scan(docs: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """Words, phrase places and labels of every whole text.

    n_words, n_base (places of all phrases), first_word and last_word (smallest
    and largest place, null without any), base_labels, labels (with those of the
    blocks that meet a template) and score: 1 with a phrase, else the largest
    containment found, else 0. Null and empty texts have no words and no labels.
    Repeated rows and null ids are kept as they are, an empty table gives an empty
    result, further columns play no part. Apart from the counts of the template
    words, whose number is fixed, every row is judged by itself: nothing is
    shuffled and no row can be a hot key.
    """
    vocabulary = sorted({w for _, t in TEMPLATES for w in t.split(" ")})
    counts = word_counts(docs, vocabulary)
    ranked = sorted(vocabulary, key=lambda w: (counts[w], w))
    rank = {w: n for n, w in enumerate(ranked)}
    templates = []
    for label, text in TEMPLATES:
        ranks = sorted({rank[w] for w in text.split(" ")})
        templates.append((label, ranks, math.ceil(containment * len(ranks) - 1e-9)))
    rare = sorted({ranked[r] for _, ranks, need in templates for r in ranks[: len(ranks) - need + 1]})

    rows = docs.select("doc_id", "text", words_of(F.col("text")).alias("words"))
    places = {p: phrase_places(F.col("words"), p) for p in PHRASES}
    rows = rows.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"),
        *[place.alias(f"at{n}") for n, place in enumerate(places.values())],
        F.when(
            F.arrays_overlap("words", F.array(*map(F.lit, rare))),
            block_matches(F.split(F.col("text"), "\n"), ranked, templates),
        ).otherwise(F.array().cast("array<struct<label:string,share:double>>")).alias("met"),
    )
    at = [F.col(f"at{n}") for n in range(len(PHRASES))]
    own = F.array(*[
        F.when(F.size(a) > 0, F.lit(label)) for a, label in zip(at, PHRASES.values())
    ])
    every = F.concat(own, F.transform("met", lambda m: m["label"]))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(F.array_compact(labels))), ",")
    n_base = sum((F.size(a) for a in at), F.lit(0))
    return rows.select(
        "doc_id", "n_words", n_base.cast("bigint").alias("n_base"),
        F.array_min(F.concat(*at)).cast("bigint").alias("first_word"),
        F.array_max(F.concat(*at)).cast("bigint").alias("last_word"),
        joined(own).alias("base_labels"), joined(every).alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(
            F.coalesce(F.array_max(F.transform("met", lambda m: m["share"])), F.lit(0.0))
        ).alias("score"),
    )

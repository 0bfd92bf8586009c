"""Operators of the training-data subpackage against brute force and the tokenizer library."""

import hashlib
import re
from collections import Counter, defaultdict
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import anchors
from ledgerlake.llm.anchors import byte_units, runs_of
from ledgerlake.llm.bpe import bpe_digests, bpe_round_trip
from ledgerlake.llm.decontamination import benchmark_leaks, without_leaks
from ledgerlake.llm.deep_shallow import sorted_groups
from ledgerlake.llm.jaccard_join import jaccard_components, one_of_each_component
from ledgerlake.llm.licenses import license_scan
from ledgerlake.llm.lines import line_dedup
from ledgerlake.llm.neighbours import nearest_neighbours
from ledgerlake.llm.queries import QUERIES, vocabulary_path
from ledgerlake.llm.substrings import substring_dedup
from ledgerlake.llm.suffixes import suffix_dedup
from ledgerlake.llm.tables import CLEANUP, shuffles_removed, written
from ledgerlake.llm.token_counts import token_counts
from ledgerlake.llm.toxicity import fold, toxicity, without_toxic

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
WORDS = re.compile("[^\x20\x09-\x0d]+").findall
SCHEMA = "doc_id bigint, text string, n bigint, score double"
PASSAGE = " ".join(f"w{n}" for n in range(60))
ODD = [
    (1, PASSAGE + " end of one", 1, 0.0),
    (2, "start of two " + PASSAGE, None, None),
    (2, "start of two " + PASSAGE, None, None),
    (3, None, 3, 1.0),
    (4, "", 4, 1.0),
    (None, PASSAGE, 5, 1.0),
    (5, "A b", 6, 1.0),
    (6, "a B", 7, 1.0),
    (7, "x" * 400 + "é" * 60 + " <|endoftext|> \n\n tail", 8, None),
    (8, "Released under the MIT License.\n" + "lorem ipsum " * 3000, 9, None),
    (9, "\n \t\n", 10, None),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def documents(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def brute_components(rows, size, tenths):
    sets = {}
    for key, text in rows:
        words = WORDS((text or "").translate(LOWER))
        shingles = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]
        sets[key] = frozenset(shingles or ([tuple(words)] if words else []))
    parent = {key: key for key in sets}

    def top(key):
        while parent[key] != key:
            key = parent[key]
        return key

    having = defaultdict(list)
    for key, own in sets.items():
        for shingle in own:
            having[shingle].append(key)
    for pair in {(a, b) for keys in having.values() for a in keys for b in keys if a < b}:
        a, b = (sets[k] for k in pair)
        if 10 * len(a & b) >= tenths * len(a | b):
            low, high = sorted(map(top, pair))
            parent[high] = low
    return {key: (len(own), top(key)) for key, own in sets.items()}


def test_jaccard_components_equal_brute_force(spark, sf_dir, documents):
    expected = [(k, *v) for k, v in brute_components(documents, 3, 9).items()]
    assert got(QUERIES["op1_jaccard_join"](spark, sf_dir)) == sorted(expected, key=str)


def test_jaccard_components_link_chains_and_many_copies(spark):
    base = [f"t{n}" for n in range(200)]
    rows = [(n, " ".join(base[: 150 + n])) for n in range(40)] + [(100 + n, " ".join(base)) for n in range(50)]
    rows += [(200, "other words that link with nothing at all")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = [(k, *v) for k, v in brute_components(rows, 5, 8).items()]
    assert got(jaccard_components(docs)) == sorted(expected, key=str)
    assert {r["doc_id"] for r in one_of_each_component(docs).collect()} == {0, 200}


def test_jaccard_components_of_odd_rows(odd, none):
    found = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard_components(odd).collect()}
    assert found[(3, 0)] == 3 and found[(4, 0)] == 4 and found[(9, 0)] == 9
    assert found[(5, 1)] == found[(6, 1)] == 5
    assert found[(None, 56)] is None
    assert jaccard_components(none).collect() == []


def test_jaccard_components_link_all_size_pairs_at_the_threshold(spark):
    for tenths in (8, 9):
        rows = []
        for n in range(1, 101):
            for m in range(1, n + 1):
                shared, rest = divmod(tenths * (n + m), 10 + tenths)
                if rest == 0 and shared <= m:
                    shingles = [(n - shared, "a"), (m - shared, "b")]
                    common = [sha(f"{n} {m} {i}".encode())[:12] for i in range(shared + 4)]
                    for extra, side in shingles:
                        own = [sha(f"{n} {m} {i} {side}".encode())[:12] for i in range(extra)]
                        rows.append((len(rows), " ".join(common + own)))
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        found = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs, 5, tenths).collect()}
        assert found == {i: i - i % 2 for i, _ in rows}


def test_toxicity_finds_marked_words_of_held_out_rows(spark):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for n in range(1200):
        words = [f"v{k}" for k in rng.integers(0, 300, 80)]
        bad = n % 5 == 0
        for at in rng.integers(0, 80, 4) if bad else []:
            words[at] = "scoundrel"
        rows.append((n, " ".join(words)))
        labels.append((n, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marked = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = toxicity(docs, marked).join(marked, "doc_id").where("held_out").collect()
    assert len(found) > 200
    assert sum(r["predicted"] == r["toxic"] for r in found) >= 0.95 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)
    held = {r["doc_id"] for r in docs.where(fold("doc_id") == 2).select("doc_id").collect()}
    assert {r["doc_id"] for r in found} == held
    unseen = marked.withColumn("toxic", F.when(fold("doc_id") == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert got(toxicity(docs, unseen)) == got(toxicity(docs, marked))


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (99, 1)], "doc_id bigint, toxic int")
    found = toxicity(odd, labels)
    assert found.count() == len(ODD)
    assert found.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity(none, labels).collect() == []
    assert toxicity(odd, labels.where("false")).count() == len(ODD)
    assert without_toxic(odd, labels, 1.1).columns == odd.columns


def test_line_dedup_removes_later_chunks_only(spark):
    block = "\n".join(f"shared line {n}" for n in range(200))
    rows = [(1, "own 1\n" + block), (2, block + "\nown 2"), (3, "a\nb"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in line_dedup(docs).collect()}
    assert found[1]["text"] == rows[0][1] and found[1]["n_removed"] == 0
    assert found[2]["n_removed"] >= 120 and found[2]["text"].endswith("own 2")
    assert found[3]["text"] == "a\nb" and found[4]["text"] is None and found[4]["n_lines"] == 0
    assert found[5]["text"] == "" and found[5]["n_lines"] == 1


def test_line_dedup_of_odd_rows(odd, none):
    found = line_dedup(odd)
    assert found.columns == [*odd.columns, "n_lines", "n_removed"]
    assert found.count() == len(ODD)
    assert line_dedup(none).collect() == []


def test_neighbours_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(600, 32))
    rows = [(n, v.tolist()) for n, v in enumerate(vectors)]
    rows += [(1000 + n, vectors[0].tolist()) for n in range(50)]
    rows += [(2000, None), (2020, [0.0] * 32), (2040, [float("nan")] * 32), (2060, [1.0]), (None, vectors[1].tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = defaultdict(list)
    for r in nearest_neighbours(df).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    good = [(k, np.array(v)) for k, v in rows[:650]]
    hits = total = 0
    assert set(found) == {k for k, _ in good if k % 20 == 0}
    for key, own in found.items():
        vector = dict(good)[key]
        exact = sorted((-float((v * vector).sum()), k) for k, v in good if k != key)[:20]
        hits += len({k for _, k in exact} & {k for k, _ in own})
        total += 20
        assert [k for k, _ in own] == [k for _, k in sorted((-s, k) for k, s in own)]
    assert hits >= 0.9 * total
    assert [k for k, _ in found[0]] == list(range(1000, 1020))
    assert nearest_neighbours(df.where("false")).collect() == []


def test_leaks_tolerate_substitutions(spark, odd, none):
    item = [f"q{n}" for n in range(30)]
    changed = list(item)
    changed[7] = changed[19] = "other"
    benchmark = spark.createDataFrame(
        [(1, " ".join(item)), (2, "short one here"), (3, None), (4, "")], "item_id bigint, text string"
    )
    rows = [(1, "lead in " + " ".join(item) + " out"), (2, " ".join(changed)), (3, "x short one here y"),
            (4, " ".join(item[:8])), (5, None), (6, " ".join(reversed(item)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in benchmark_leaks(docs, benchmark).collect()}
    assert found == {(1, 1), (2, 1), (3, 2)}
    assert {r["doc_id"] for r in without_leaks(docs, benchmark).collect()} == {4, 5, 6}
    assert benchmark_leaks(odd, benchmark).collect() == []
    assert without_leaks(odd, benchmark).count() == len(ODD)
    assert without_leaks(none, benchmark).collect() == []


def test_bpe_and_counts_equal_the_library(odd, none, documents, spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    rows = [(r[0], r[1]) for r in ODD] + documents[:60] + [(0, "a" * 3000), (0, "日本  \x1c 12³")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    expected = [
        (k, len(i), sha(np.array(i, "<u4").tobytes()), sha(library.decode(i, skip_special_tokens=False).encode()))
        for (k, _), i in zip(rows, ids)
    ]
    assert got(bpe_digests(docs, vocabulary_path())) == sorted(expected, key=str)
    counts = [(k, len((t or "").encode()), len(i), len(i) > 1024) for (k, t), i in zip(rows, ids)]
    assert got(token_counts(docs, vocabulary_path())) == sorted(counts, key=str)
    assert sorted(r["decoded"] for r in bpe_round_trip(odd, vocabulary_path()).collect()) == sorted(r[1] or "" for r in ODD)
    assert token_counts(none, vocabulary_path()).collect() == bpe_digests(none, vocabulary_path()).collect() == []


def brute_words(rows, window=35):
    split = [WORDS(t or "") for _, t in rows]
    starts = Counter(tuple(w[k : k + window]) for w in split for k in range(len(w) - window + 1))
    out = []
    for (key, _), words in zip(rows, split):
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if starts[tuple(words[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((key, len(words), sum(gone), sha(kept.encode())))
    return sorted(out, key=str)


def test_substring_dedup_equals_brute_force(spark, documents, odd, none):
    rows = documents + [(r[0], r[1]) for r in ODD]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(substring_dedup(docs, digest=True)) == brute_words(rows)
    assert substring_dedup(none).collect() == []
    assert substring_dedup(odd).where("doc_id = 3").first()["kept"] == ""


def brute_bytes(rows, length=50):
    raw = [(2**63 - 1 if k is None else k, (t or "").encode()) for k, t in rows]
    least = {}
    for key, data in raw:
        for k in range(len(data) - length + 1):
            string = data[k : k + length]
            least[string] = min(key, least.get(string, key))
    out = []
    for (key, _), (order, data) in zip(rows, raw):
        gone, end = bytearray(len(data)), 0
        for k in range(len(data) - length + 1):
            if least[data[k : k + length]] < order:
                gone[max(k, end) : k + length] = b"\1" * (k + length - max(k, end))
                end = k + length
        spans = sum(1 for j, g in enumerate(gone) if g and (not j or not gone[j - 1]))
        out.append((key, len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g))))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [0, 100_000])
def test_suffix_dedup_equals_brute_force(spark, documents, none, monkeypatch, hot):
    monkeypatch.setattr("ledgerlake.llm.suffixes.HOT_RUNS", hot)
    rows = documents[:120] + [(r[0], r[1]) for r in ODD]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(suffix_dedup(docs, digest=True)) == brute_bytes(rows)
    assert suffix_dedup(none).collect() == []


def test_sorted_groups_order_all_suffixes():
    rng = np.random.default_rng(1)
    text = np.tile(rng.integers(97, 99, 3_000).astype(np.uint8), 2)
    places = np.arange(len(text) - 50)
    order, group = sorted_groups(text, places, 50)
    strings = [text[p : p + 50].tobytes() for p in places]
    assert [strings[k] for k in order] == sorted(strings)
    assert len(set(strings)) == group.max() + 1
    assert len({(s, g) for s, g in zip(strings, group.tolist())}) == group.max() + 1


def test_runs_cover_every_window_once():
    data = np.frombuffer(b"abracadabra" * 30 + b"xyz" * 5 + b"q" * 200, np.uint8)
    texts = np.array([0, 330, 345, 345, 545])
    runs = runs_of(byte_units(data), texts, 50, 24)
    windows = [(o, s + k) for o, s, n in zip(runs.owner, runs.start, runs.n) for k in range(n)]
    assert windows == [(0, k) for k in range(281)] + [(3, 345 + k) for k in range(151)]


def test_runs_have_the_smallest_gram_at_block_borders(monkeypatch):
    monkeypatch.setattr(anchors, "WINDOWS_AT_ONCE", 64)
    lengths = [0, 49, 50, 51, 0, 400, 90]
    data = np.random.default_rng(2).integers(97, 100, sum(lengths)).astype(np.uint8)
    data[100:250] = 97
    texts = np.cumsum([0, *lengths])
    runs = anchors.byte_runs(data, texts, 50, 24)
    windows = [(o, s + k, p) for o, s, n, p in zip(runs.owner, runs.start, runs.n, runs.place) for k in range(n)]
    value = anchors.byte_grams(data, 24)
    smallest = lambda s: min((int(value[p]) >> 16, p) for p in range(s, s + 27))[1]
    assert windows == [(o, s, smallest(s)) for o in range(7) for s in range(texts[o], texts[o + 1] - 49)]
    assert (runs.anchor == value[runs.place]).all()


def test_a_task_sends_its_sketch_in_few_blocks(monkeypatch):
    monkeypatch.setattr(anchors.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    values = np.random.default_rng(3).integers(0, 1 << 63, 20_000)
    schema = pa.schema([(c, pa.int32()) for c in ("row", "block", "part")] + [(c, pa.binary()) for c in ("once", "twice")])
    batches = (pa.RecordBatch.from_arrays([pa.array(v)], names=["anchor"]) for v in np.split(values, 40))
    sent = pa.Table.from_batches(anchors.anchor_batches(batches, 22, schema))
    assert sent.num_rows == 8
    for row, cell in enumerate(anchors.cells(values.view(np.uint64), 22)):
        met = [b * (1 << 20) + anchors.unpacked(x) for r, b, x in zip(*(sent[c].to_pylist() for c in ("row", "block", "once"))) if r == row]
        assert (np.concatenate(met) == np.unique(cell)).all()


def test_suffix_dedup_leaves_no_table_that_is_not_read_again(spark, odd):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(folder.iterdir())
    result = suffix_dedup(odd.select("doc_id", "text"))
    assert [p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before] == ["byte-runs-masks"]
    assert result.count() == len(ODD)


def test_license_phrases_and_notices(spark, odd, none):
    rows = [
        (1, "x MIT-License mit license"), (2, "Released under the MIT License."), (3, None), (4, ""),
        (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files to deal in the Software without restriction"),
        (6, "cc by cc by\nGNU General Public License"), (7, "commit licenses apache licensed"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in license_scan(docs).collect()}
    places = lambda k: (found[k]["n_base"], found[k]["first_word"], found[k]["last_word"], found[k]["base_labels"])
    assert places(1) == (2, 1, 3, "mit") and places(2) == (1, 3, 3, "mit")
    assert places(3) == places(4) == places(7) == (0, None, None, "")
    assert places(5) == (0, None, None, "") and found[5]["labels"] == "mit" and found[5]["score"] >= 0.9
    assert places(6) == (3, 0, 4, "cc-by,gpl")
    assert found[3]["n_words"] == 0 and found[3]["score"] == 0
    assert license_scan(odd).count() == len(ODD)
    assert license_scan(none).collect() == []


def test_pipeline_keeps_columns_and_removes_what_it_finds(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = set(r[0] for r in documents)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, sf_dir), "test")
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= seen
        if name == "n-gram Jaccard join":
            rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
            assert now == {k for k, (_, top) in brute_components(rows, 5, 8).items() if k == top}
        if name == "line dedup":
            assert now == seen
        seen = now
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
    texts = dict(before.select("doc_id", "text").collect())
    assert {r["doc_id"]: r["decoded"] for r in docs.collect()} == texts


def test_written_tables_leave_the_setting_as_it_was(spark, odd):
    before = spark.conf.get(CLEANUP, None)
    table = written(odd.groupBy("doc_id").count(), "test")
    assert spark.conf.get(CLEANUP, None) == before
    assert sorted(table.collect(), key=str) == sorted(odd.groupBy("doc_id").count().collect(), key=str)
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark):
        assert spark.conf.get(CLEANUP) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(CLEANUP, None) == before

"""Periodic runs, whitening and language-model scores against brute-force versions."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import kneser_ney
from ledgerlake.llm.decontamination import without_leaks
from ledgerlake.llm.jaccard_join import jaccard_components, one_of_each_component
from ledgerlake.llm.kneser_ney import lm_scores
from ledgerlake.llm.lines import line_dedup
from ledgerlake.llm.periodic_runs import periodic_runs, runs_of_slice
from ledgerlake.llm.queries import QUERIES
from ledgerlake.llm.substrings import substring_dedup
from ledgerlake.llm.toxicity import without_toxic
from ledgerlake.llm.whitening import PART_BITS, parts_of, scatter, whiten

WORDS = re.compile(rb"[^\x20\x09-\x0d]+").findall
CLASHING = "doc_id bigint, text string, runs string, period int, score double, held_out int, _x int"


@pytest.fixture
def odd(spark):
    loop = "one two three " * 5
    rows = [
        (1, "x y " + loop + "z", "r", 1, 0.5, 1, 1), (2, None, None, None, None, None, None),
        (3, "", "", 0, 0.0, 0, 0), (None, "Same words", "a", 1, 1.0, 1, 1),
        (4, "\n \t\x0b\n", "a", 1, 1.0, 1, 1), (5, "Same words", "a", 1, 1.0, 1, 1),
        (5, "Same words", "a", 1, 1.0, 1, 1), (6, "a b É\x1f\x85 " * 20, "a", 1, 1.0, 1, 1),
        (7, "w " * 300_000, "a", 1, 1.0, 1, 1),
    ]
    return spark.createDataFrame(rows, CLASHING)


def texts_of(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


# Periodic runs

def brute_runs(words, least):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = q
        while i < len(words):
            begin = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i - begin + q >= max(least, 2 * q) and i > begin:
                found.setdefault((begin - q, i), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def made_text(rng):
    kind, size = rng.randrange(5), rng.randint(0, 130)
    some = lambda n, k: [rng.randrange(k) for _ in range(n)]
    out = []
    if kind == 0:
        return some(size, rng.randint(1, 4))
    if kind == 1:
        short, long = [0], [0, 1]
        while len(long) < size:
            short, long = long, long + short
        return long
    unit, rest = some(rng.randint(1, 30), 3), some(20, 4)
    while len(out) < size:
        if kind == 2:
            out += unit[:9] * rng.randint(1, 12) + rest[: rng.randint(0, 3)]
        elif kind == 3:
            out += [0] * len(unit) + [1]
        else:
            out += unit * rng.randint(1, 4) + some(rng.randint(0, 2), 5)
    return out


@pytest.mark.parametrize("least", [12, 2, 5, 20])
def test_runs_of_made_texts(least):
    rng = random.Random(least)
    for _ in range(60):
        texts = [made_text(rng) for _ in range(8)]
        ids = np.array([w for t in texts for w in t], np.int64)
        offsets = np.append(0, np.cumsum([len(t) for t in texts]))
        assert runs_of_slice(ids, offsets, least) == [brute_runs(t, least) for t in texts]


def test_runs_of_every_document(spark, sf_dir):
    got = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    sha = lambda data: hashlib.sha256(data).hexdigest()
    rewritten = 0
    for key, text in texts_of(spark, sf_dir):
        words = WORDS((text or "").encode())
        n, h = len(words), zlib.crc32(str(key).encode())
        if h % 10 == 0 and n:
            rewritten += 1
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words, 12)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        assert tuple(got[key]) == (
            key, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
        )
    assert rewritten > 5


def test_runs_of_odd_rows(spark, odd):
    rows = [r for r in periodic_runs(odd).collect()]
    assert len(rows) == odd.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append(r)
    one = by_id[1][0]
    assert (one["n_runs"], one["start"], one["length"], one["period"], one["exponent_milli"]) == (1, 2, 15, 3, 5000)
    assert one["collapsed"] == "x y one two three z"
    for key in (2, 3, 4):
        assert by_id[key][0][1:] == (0, None, None, None, None, [], "")
    assert len(by_id[5]) == 2 and by_id[None][0]["collapsed"] == "Same words"
    assert by_id[6][0]["collapsed"] == "a b É\x1f\x85"
    assert by_id[7][0][1:] == (1, 0, 300_000, 1, 300_000_000, [(0, 300_000, 1)], "w")
    assert periodic_runs(odd.limit(0)).collect() == []
    renamed = odd.withColumnsRenamed({"doc_id": "key", "text": "body"})
    assert periodic_runs(renamed, "key", "body").columns[0] == "key"


def test_very_long_periodic_texts_take_linear_time():
    texts = {
        "one word": [0] * 400_000, "blocks": ([0] * 1000 + [1]) * 400,
        "joints": ([0, 1] * 1000 + [0]) * 200, "lines": [1, 2, 3, 4, 5, 6, 7] * 50_000,
    }
    for words in texts.values():
        begin = time.time()
        runs_of_slice(np.array(words, np.int64), np.array([0, len(words)]), 12)
        assert time.time() - begin < 30


# Whitening

def test_scatter_is_exact():
    rng = np.random.default_rng(1)
    huge = 1 << 61
    for rows in (
        rng.integers(-40, 41, (3000, 12)), rng.integers(-3, 4, (5, 2)), np.zeros((9, 3), np.int64),
        np.array([[huge, -huge, 5], [-huge, 3, 5], [7, 8, 9]]), np.full((1, 1), -7),
    ):
        exact = rows.astype(object)
        sums, products = scatter(rows)
        assert (sums == exact.sum(axis=0)).all() and (products == exact.T @ exact).all()
    for number in (0, 5, -5, 1 << 140, 3 - (1 << 170)):
        assert sum(part << PART_BITS * k for k, part in enumerate(parts_of(number))) == number


def brute_whitening(vectors, most=16):
    x = np.floor(64 * vectors.astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1][:most], directions[:, ::-1][:, :most]
    white = (x - sums / n) @ directions / np.sqrt(values)
    return n, ((n * x - sums) ** 2).sum(axis=1), white, values / np.trace(covariance)


def test_whitening_of_every_embedding(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").toPandas()
    n, deviation, white, explained = brute_whitening(np.array(rows["embedding"].tolist()))
    got = QUERIES["op12_whitening"](spark, sf_dir).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 16 * len(rows) and set(got["n"]) == {n}
    assert got["vec_id"].tolist() == np.repeat(rows["vec_id"], 16).tolist()
    assert got["deviation"].tolist() == np.repeat(deviation, 16).tolist()
    assert np.allclose(np.abs(got["whitened"].to_numpy().reshape(-1, 16)), np.abs(white), atol=1e-8)
    assert np.allclose(got["explained"].to_numpy().reshape(-1, 16), explained, rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-9
    signs = got["whitened"].to_numpy().reshape(-1, 16) * white
    assert all((s > -1e-6).all() or (s < 1e-6).all() for s in signs.T)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, 1.0, -2.0], [0.25, -1.0, 3.0], [0.125, 2.0, 0.5], [7.0, 1.0, 1.0], [0.0, 0.0, 0.0]]
    rows = [(k, v, 1, "n") for k, v in enumerate(good)] + [
        (None, good[0], 1, "n"), (0, good[0], 2, "n"), (10, None, 1, "n"), (11, [], 1, "n"),
        (12, [nan, 1.0, 1.0], 1, "n"), (13, [inf, 1.0, 1.0], 1, "n"), (14, [None, 1.0, 1.0], 1, "n"),
        (15, [1e200, 1.0, 1.0], 1, "n"), (16, [1.0, 2.0], 1, "n"),
    ]
    schema = "vec_id bigint, embedding array<double>, n int, _x string"
    vectors = spark.createDataFrame(rows, schema)
    got = whiten(vectors).toPandas()
    n, deviation, white, _ = brute_whitening(np.array(good))
    assert set(got["n"]) == {5} and len(got) == 3 * 7
    assert Counter(got["vec_id"].fillna(-1)) == {0: 6, 1: 3, 2: 3, 3: 3, 4: 3, -1: 3}
    first = got[got["vec_id"] == 0].drop_duplicates(["component"]).sort_values("component")
    assert set(first["deviation"]) == {deviation[0]}
    assert np.allclose(np.abs(first["whitened"]), np.abs(white[0]))
    assert whiten(vectors.limit(0)).collect() == []
    assert whiten(vectors.where("vec_id = 0")).collect() == []  # copies of one vector
    flat = spark.createDataFrame([(1, [1.0, 5.0]), (2, [2.0, 5.0])], "vec_id bigint, embedding array<double>")
    assert sorted((r["vec_id"], r["component"], round(abs(r["whitened"]), 9)) for r in whiten(flat).collect()) == [
        (1, 1, 1.0), (2, 1, 1.0)
    ]
    # Entries near the end of the range: exact sums that 64 bits do not hold are NULL.
    wide = spark.createDataFrame([(1, [1e16, 1.0]), (2, [-1e16, 2.0]), (3, [0.0, 4.0])], "vec_id bigint, embedding array<double>")
    got = whiten(wide).toPandas()
    assert got["identity_error"].max() < 1e-4 and got[got["vec_id"] == 1]["deviation"].isna().all()


# Language model

def brute_model(train):
    """Plain interpolated modified Kneser-Ney over token lists; returns p(word, word in front)."""
    counts = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip([None, *t], t))
    front, ends, followers = Counter(), Counter(), defaultdict(list)
    for (h, w), n in pairs.items():
        front[h] += n
        ends[w] += 1
        followers[h].append(n)

    def discounts(values):
        n = Counter(values)
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        out = [0.0]
        for k, otherwise in ((1, 0.5), (2, 1.0), (3, 1.5)):
            d = k - (k + 1) * y * n[k + 1] / n[k] if n[k] and y else otherwise
            out.append(d if 0 < d <= k else otherwise)
        return out

    upper, lower = discounts(pairs.values()), discounts(ends.values())
    off = lambda n, d: n - d[min(n, 3)]
    left = sum(lower[min(n, 3)] for n in ends.values()) / len(pairs) if pairs else 1.0

    def alone(w):
        return (off(ends[w], lower) / len(pairs) if w in ends else 0.0) + left / (len(counts) + 1)

    def p(w, h):
        if h not in front:
            return alone(w)
        weight = sum(upper[min(n, 3)] for n in followers[h]) / front[h]
        return (off(pairs[h, w], upper) / front[h] if (h, w) in pairs else 0.0) + weight * alone(w)

    return counts, p


def tokens_of(text):
    return [w.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
            for w in WORDS((text or "").encode())] + [b"</s>"]


def check_scores(rows, got):
    folds = lambda k: zlib.crc32(str(k).encode()) % 7
    tokens = [(k, tokens_of(text)) for k, text in rows]
    counts, p = brute_model([t for k, t in tokens if k is None or folds(k) != 2])
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(k), k is not None and folds(k) == 2, len(t), sum(w in counts for w in t), n,
         sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t),
         sum(math.log10(p(w, h)) for h, w in zip([None, *t], t)))
        for k, t in tokens
    )
    got = sorted((str(r[0]), *r[1:7]) for r in got)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)
    return want


@pytest.mark.parametrize("small", [False, True])
def test_scores_of_every_document(spark, sf_dir, small, monkeypatch):
    if small:  # many blocks and shards, several hand-overs in each task
        monkeypatch.setattr(kneser_ney, "BLOCK_BYTES", 60_000)
        monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 30_000)
    want = check_scores(texts_of(spark, sf_dir), QUERIES["op13_lm_scores"](spark, sf_dir).collect())
    held_out = [r for r in want if r[1]]
    size = sum(r[2] for r in held_out)
    assert sum(r[6] for r in held_out) / size > sum(r[5] for r in held_out) / size + 0.3


def test_probabilities_sum_to_one(spark):
    rows = [(k, t) for k, t in enumerate(["a b c", "a b d a b c", "c c c c a", "b a", "d d e a b f", "a b c d"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = kneser_ney.fit(docs)
    known = sorted({w for _, t in rows for w in t.split()})
    for front in ("a", "c", "zzz"):
        texts = [f"{front} {w}".encode() for w in [*known, "unseen"]]
        size = np.append(0, np.cumsum([len(t) for t in texts]))
        data = np.frombuffer(b"".join(texts), np.uint8)
        _, logs = model.token_logs(kneser_ney.Tokens.of(data, size))
        _, last = model.token_logs(kneser_ney.Tokens.of(np.frombuffer(front.encode(), np.uint8), np.array([0, len(front)])))
        assert abs((10 ** logs[1::3]).sum() + 10 ** last[1] - 1) < 1e-12


def test_scores_of_odd_rows(spark, odd):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    check_scores(rows, lm_scores(odd).collect())
    assert lm_scores(odd.limit(0)).collect() == []
    # Nothing to fit: the one unknown word has all of the probability.
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    held_out = spark.createDataFrame([(k, "a b") for k in ids], "doc_id bigint, text string")
    assert [tuple(r)[1:7] for r in lm_scores(held_out).collect()] == [(True, 3, 0, 0, 0.0, 0.0)] * 2


def test_arrays_need_a_mounted_folder():
    assert kneser_ney.mounted("file:///shared/x") == "/shared/x" == kneser_ney.mounted("/shared/x")
    with pytest.raises(RuntimeError):
        kneser_ney.mounted("hdfs://host/x")


def test_packed_numbers_come_back():
    rng = np.random.default_rng(3)
    for values in (np.zeros(0, np.int64), rng.integers(-(1 << 62), 1 << 62, 1000), np.arange(5)):
        assert (kneser_ney.unpacked(kneser_ney.packed(values)) == values).all()
        ascending = np.sort(values)
        assert (kneser_ney.unpacked_ascending(kneser_ney.packed_ascending(ascending)) == ascending).all()


# Words and sets that only an exact comparison tells apart

def thue_morse(n, one="a", two="b"):
    return "".join((one, two)[bin(k).count("1") % 2] for k in range(n))


def test_words_that_polynomials_confuse(spark):
    """Long words whose polynomial hashes are equal modulo 2^64 under every odd base."""
    one, two = thue_morse(1024), thue_morse(1024, "b", "a")
    docs = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id bigint, text string")
    got = {r[0]: r[2] for r in jaccard_components(docs, 3, 9).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    around = [f"w{k}" for k in range(40)]
    texts = [" ".join([*around[:20], word, *around[20:]]) for word in (one, two)]
    docs = spark.createDataFrame([(1, texts[0]), (2, texts[1])], "doc_id bigint, text string")
    assert [r["n_removed"] for r in substring_dedup(docs, digest=True).collect()] == [0, 0]


@pytest.mark.parametrize("shingle, tenths", [(3, 9), (5, 8)])
def test_links_at_the_threshold_for_all_sizes(spark, shingle, tenths):
    """Pairs of sets with exactly the similarity asked for, and one shingle less."""
    rows, want = [], {}
    for n in range(1, 41):
        for m in range(max(1, tenths * n // 10), n + 1):
            shared = next((s for s in range(m, -1, -1) if 10 * s <= tenths * (n + m - s)), 0)
            for s in (shared, shared - 1):
                if s < 0 or m - s > n:
                    continue
                # Words in a row: s shingles at the beginning of both, and different ones behind.
                base = [f"{n}x{m}x{s}w{k}" for k in range(s + shingle - 1)]
                texts = [base + [f"{n}x{m}x{s}{c}{k}" for k in range(size - s)] for c, size in (("p", n), ("q", m))]
                if s == 0:
                    texts = [t[:] for t in texts]
                first = len(rows) + 1
                rows += [(first, " ".join(texts[0])), (first + 1, " ".join(texts[1]))]
                sets = [set(zip(*(t[k:] for k in range(shingle)))) or {tuple(t)} for t in texts]
                both = len(sets[0] & sets[1])
                linked = 10 * both >= tenths * len(sets[0] | sets[1])
                want[first], want[first + 1] = first, first if linked else first + 1
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sum(k != v for k, v in want.items()) > 5
    assert {r[0]: r[2] for r in jaccard_components(docs, shingle, tenths).collect()} == want


def test_different_texts_under_one_id_stay_together(spark):
    rows = [(1, "a b c d e f"), (1, "q r s t u v"), (1, "a b c d e f"), (2, "z z z z y y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("_text", F.lit(1))
    kept = one_of_each_component(docs)
    assert sorted((r[0], r[1]) for r in kept.collect()) == [rows[0], rows[1], rows[3]]
    assert kept.columns == docs.columns


def test_stages_keep_columns_whose_names_they_use(spark, sf_dir):
    docs = spark.createDataFrame(
        [(1, "a line\nsecond line\nthird line\nfourth\nfifth one", 7, "g", "s", "i", "b", 0.5, 3, "r"),
         (2, "a line\nsecond line\nthird line\nfourth\nfifth one", 8, "g", "s", "i", "b", 0.5, 3, "r"),
         (None, "none", 8, "g", "s", "i", "b", 0.5, 3, "r")],
        "doc_id bigint, text string, body int, _gone string, spans string, _id string, _body string,"
        " _score double, _leaked int, row string",
    )
    found = line_dedup(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_removed"]
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert [by_id[k][2:10] for k in (1, 2, None)] == [
        (n, "g", "s", "i", "b", 0.5, 3, "r") for n in (7, 8, 8)
    ]
    assert by_id[1]["n_removed"] == 0 and by_id[1]["n_lines"] == by_id[2]["n_lines"] == 5
    kept = by_id[2]["text"].split("\n") if by_id[2]["text"] else []
    assert len(kept) == 5 - by_id[2]["n_removed"] < 5
    benchmark = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(30)))], "item_id bigint, text string")
    leak = spark.createDataFrame(
        [(None, " ".join(f"w{k}" for k in range(30)), 1, "x"), (None, "clean text", 1, "y"), (5, None, 1, "z")],
        "doc_id bigint, text string, _leaked int, key string",
    )
    assert sorted(r["key"] for r in without_leaks(leak, benchmark).collect()) == ["y", "z"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert without_toxic(docs, labels).columns == docs.columns


def test_many_short_lines_take_linear_time(spark):
    text = "\n".join(f"line {k}" for k in range(120_000))
    docs = spark.createDataFrame([(1, text), (2, "in front\n" + text)], "doc_id bigint, text string")
    begin = time.time()
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in line_dedup(docs).collect()}
    assert got[1] == (120_000, 0) and got[2][0] == 120_001 and got[2][1] > 50_000
    assert time.time() - begin < 60


def test_long_pre_tokens_are_counted_as_the_library_does():
    import random
    import time

    import tokenizers

    from ledgerlake.llm.queries import vocabulary_path
    from ledgerlake.llm.token_counts import long_count, merge_counts
    from ledgerlake.llm.vocabulary import vocabulary

    vocab = vocabulary(vocabulary_path())
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    draw = random.Random(3)
    words = ["the", "and", "aaaa", "a", "ing", "ab", "therefore", "zzq", "é", "ß", "tion", "xx"]
    texts = ["".join(draw.choice(words) for _ in range(n)) for n in (1, 2, 5, 30, 300, 900)]
    texts += ["a" * n for n in (2, 3, 7, 64, 2_047, 5_000)] + ["ab" * 2_000, "aab" * 1_500, "é" * 1_111]
    texts += ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6_000))]
    expected = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [long_count(vocab, t.encode()) for t in texts] == expected
    assert merge_counts(vocab, [t.encode() for t in texts]).tolist() == expected
    megabyte = "".join(draw.choice(words) for _ in range(300_000))[:1_000_000].encode()
    start = time.monotonic()
    long_count(vocab, megabyte)
    assert time.monotonic() - start < 60


def test_neighbours_of_huge_and_tiny_vectors(spark):
    import numpy as np

    from ledgerlake.llm.neighbours import nearest_neighbours

    draw = np.random.default_rng(2)
    vectors = {n: v for n, v in enumerate(draw.normal(size=(60, 8)))}
    vectors |= {n: vectors[n] * 1e200 for n in range(50, 55)} | {n: vectors[n] * 1e-200 for n in range(55, 60)}
    df = spark.createDataFrame([(n, v.tolist()) for n, v in vectors.items()], "vec_id bigint, embedding array<double>")
    got = nearest_neighbours(df).collect()
    for query in (0, 20, 40):
        own = sorted((r for r in got if r["query_id"] == query), key=lambda r: r["rank"])
        exact = sorted((-float((v * vectors[query]).sum()), n) for n, v in vectors.items() if n != query)[:20]
        assert [(r["vec_id"], r["score"]) for r in own] == [(n, -s) for s, n in exact]


def test_neighbours_recall_on_the_table(spark, sf_dir):
    import numpy as np

    from ledgerlake.llm.neighbours import nearest_neighbours
    from ledgerlake.llm.queries import table

    df = table(spark, sf_dir, "embeddings")
    rows = {r["vec_id"]: np.array(r["embedding"]) for r in df.collect()}
    ids = np.array(sorted(rows))
    vectors = np.stack([rows[n] for n in ids])
    found: dict[int, set] = {}
    for r in nearest_neighbours(df).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for query, own in found.items():
        scores = np.where(ids == query, -np.inf, vectors @ rows[query])
        hits += len(own & set(ids[np.argsort(-scores)[:20]].tolist()))
    assert len(found) == (ids % 20 == 0).sum()
    assert hits >= 0.9 * 20 * len(found)


def brute_lines(rows):
    """Kept text of every (doc_id, text) by the rule itself; ids are unique."""
    import xxhash

    hash_of = lambda data, seed: xxhash.xxh64_intdigest(data, seed & (2**64 - 1))
    chunks, first = [], {}
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        own = [hash_of(x.encode(), 42) for x in lines]
        solid = [n for n, x in enumerate(lines) if x.strip(" ")]
        ends = [False]
        for a, b in zip(solid, solid[1:]):
            h = hash_of(own[b].to_bytes(8, "little"), hash_of(own[a].to_bytes(8, "little"), 42))
            ends.append((h - (h >> 63 << 64)) % 4 != 0)
        for k in range(len(solid) - 1):
            last = next((j for j in range(k + 1, min(k + 8, len(solid))) if ends[j]), min(k + 7, len(solid) - 1))
            chunk = "\n".join(lines[solid[k] : solid[last] + 1])
            chunks.append((doc_id, solid[k], solid[last] + 1, chunk))
            first[chunk] = min(first.get(chunk, (doc_id, solid[k])), (doc_id, solid[k]))
    gone = {doc_id: set() for doc_id, _ in rows}
    for doc_id, begin, end, chunk in chunks:
        if first[chunk] != (doc_id, begin):
            gone[doc_id].update(range(begin, end))
    return {
        i: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) for i, t in rows
    }


def test_line_dedup_equals_brute_force(spark, sf_dir):
    from ledgerlake.llm.lines import line_dedup
    from ledgerlake.llm.queries import table

    docs = table(spark, sf_dir, "documents")
    got = {r["doc_id"]: r["text"] for r in line_dedup(docs).collect()}
    assert got == brute_lines([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_line_dedup_finds_short_passages_in_new_surroundings(spark):
    from ledgerlake.llm.lines import line_dedup

    rows, sizes = [], (2, 3, 4, 6, 10, 20)
    for n in range(300):
        for size in sizes:
            passage = "\n".join(f"passage {size} {n} line {k}" for k in range(size))
            rows.append((len(rows), f"before {size} {n}\nown {size} {n}\n{passage}\nafter {size} {n}\n\nend {n} {size}"))
            rows.append((len(rows), f"other {size} {n}\n\n{passage}\nlater {n} {size}\nlast {n} {size}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in line_dedup(docs).collect()}
    expected = brute_lines(rows)
    assert {k: r["text"] for k, r in got.items()} == expected
    for at, least in zip(range(len(sizes)), (0.65, 0.85, 0.9, 0.93, 0.95, 0.97)):
        removed = sum(got[i]["n_removed"] for i in range(2 * at + 1, len(rows), 2 * len(sizes)))
        print(sizes[at], removed / (300 * sizes[at]))
        assert removed >= least * 300 * sizes[at]
    assert all(r["n_removed"] == 0 for i, r in got.items() if i % 2 == 0)


def test_line_dedup_is_linear_in_the_lines_of_a_text(spark):
    import time

    from ledgerlake.llm.lines import line_dedup

    text = "\n".join(f"l{n % 50_000}" for n in range(160_000))
    same = "\n".join(["same"] * 160_000)
    blank = "\n".join(["x", *[""] * 160_000, "y"])
    docs = spark.createDataFrame([(1, text), (2, text), (3, same), (4, blank)], "doc_id bigint, text string")
    start = time.monotonic()
    got = {r["doc_id"]: r for r in line_dedup(docs).collect()}
    assert time.monotonic() - start < 60
    assert got[2]["text"] == "" and got[2]["n_removed"] == 160_000
    assert got[3]["n_removed"] == 159_999 and got[4]["n_removed"] == 0


def test_line_dedup_keeps_columns_with_names_of_the_plan(spark):
    from ledgerlake.llm.lines import line_dedup

    names = ["_id", "_body", "body", "spans", "lines", "gaps", "row", "chunk", "begin", "h1"]
    ddl = "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names)
    rows = [(n, "one line\nand one more\nthird here\nfourth", *names) for n in (1, 2)]
    got = line_dedup(spark.createDataFrame(rows, ddl)).orderBy("doc_id").collect()
    assert [tuple(r[n] for n in names) for r in got] == [tuple(names)] * 2
    assert got[0]["n_removed"] == 0 and got[1]["n_removed"] >= 2

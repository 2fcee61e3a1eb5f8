"""Similarity joins: Jaccard regions, spelling variants, hard negatives,
against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import helpers
import numpy as np
import pytest
from pyspark.sql import functions as F

from pipewatch.llm import hard_negatives, jaccard_regions, spelling_trie
from pipewatch.llm.queries import op12_spelling_variants, op13_hard_negatives


# ------------------------------------------------------------------ documents
def near_corpus(seed: int, groups: int, near: int, edits: int, apart: int) -> list[tuple[int, str]]:
    """Bases with edited copies, documents that share one passage, and short ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 6)))
    passage = [word() for _ in range(25)]
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(6, 150))]
        for _ in range(near):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = [word()]
            texts.append(" ".join(copy))
    for _ in range(apart):
        own = [word() for _ in range(rng.randint(0, 60))]
        at = rng.randint(0, len(own))
        texts.append(" ".join(own[:at] + passage + own[at:]))
        texts.append(" ".join(word() for _ in range(rng.randint(0, 9))))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(
    ("pivots", "small", "levels", "n"),
    [(256, 64, 2, 5), (4, 6, 2, 5), (0, 2, 1, 2)],
)
def test_linked_documents_against_all_pairs(spark, monkeypatch, pivots, small, levels, n):
    """Many pivots, few of them in several levels, none at all (runs only)."""
    monkeypatch.setattr(jaccard_regions, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard_regions, "SMALL", small)
    monkeypatch.setattr(jaccard_regions, "LEVELS", levels)
    rows = near_corpus(pivots + n, 8, 14, 4, 60)
    got = jaccard_regions.linked(spark.createDataFrame(rows, "doc_id bigint, text string"), n=n).collect()
    assert {r.doc_id: r.component_id for r in got} == helpers.near_components(dict(rows), n)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(helpers.shingles(t, n)) for i, t in rows}


def test_linked_odd_documents(spark, odd, no_docs):
    clash = odd.withColumn("cid", F.lit("x")).withColumn("n", F.lit("x")).withColumn("first", F.lit("x")).withColumn("region", F.lit("x"))
    got = jaccard_regions.linked(clash, n=2).collect()
    texts = {d[0]: d[1] for d in helpers.odd_documents() if d[0] is not None}
    assert len(got) == odd.count()
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == helpers.near_components(texts, 2)
    assert {(r.n_shingles, r.component_id) for r in got if r.doc_id is None} == {(0, None), (2, 0)}
    assert jaccard_regions.linked(no_docs).collect() == []
    with pytest.raises(ValueError):
        jaccard_regions.linked(odd, percent=70)


def test_far_copies_and_passages_make_few_pairs(spark, monkeypatch):
    """Copies too far from each other for links, and documents of one passage:
    the pairs to compare grow no faster than they do."""
    found = []
    cross = jaccard_regions._cross

    def spy(members, key, percent, window=None):
        out = cross(members, key, percent, window)
        found.append(out.count())
        return out

    monkeypatch.setattr(jaccard_regions, "_cross", spy)
    monkeypatch.setattr(jaccard_regions, "PIVOTS", 0)
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    base, passage = [word() for _ in range(150)], [word() for _ in range(60)]
    texts = [" ".join(base)]
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.randint(0, 14)):
            copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    for _ in range(150):
        texts.append(" ".join(passage + [word() for _ in range(rng.randint(20, 40))]))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = jaccard_regions.linked(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == helpers.near_components(dict(rows), 5)
    assert sum(found) < 3 * len(rows)


def test_linked_documents_share_a_run():
    """Whatever 4 in 5 shared shingles: some run of them is unbroken."""
    rng = np.random.default_rng(5)
    for _ in range(3000):
        united = int(rng.integers(5, 80))
        lost = rng.choice(united, size=united // 5, replace=False)
        mine = rng.random(len(lost)) < rng.random()
        values = np.sort(rng.integers(-(2**62), 2**62, united))
        x, y = np.delete(values, lost[mine]), np.delete(values, lost[~mine])
        assert np.intersect1d(jaccard_regions._runs(x), jaccard_regions._runs(y)).size, (united, lost)


def test_hash_order_prefixes_meet():
    rng = np.random.default_rng(6)
    for _ in range(2000):
        united = int(rng.integers(1, 60))
        lost = rng.choice(united, size=united // 5, replace=False)
        mine = rng.random(len(lost)) < rng.random()
        values = np.sort(rng.integers(-(2**62), 2**62, united))
        x, y = np.delete(values, lost[mine]), np.delete(values, lost[~mine])
        assert np.intersect1d(jaccard_regions._first_shingles(x, 80), jaccard_regions._first_shingles(y, 80)).size


# ---------------------------------------------------------------------- words
def brute_variants(counts: dict[str, int]) -> dict[str, tuple]:
    skips = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            skips[w[:i], w[i + 1 :]].add(w)
    near = defaultdict(set)
    for (a, b), held in skips.items():
        for x in held:
            near[x] |= held - {x}
            if a + b in counts:
                near[x].add(a + b)
                near[a + b].add(x)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts.get(form[w]))
    return out


def brute_counts(rows, least_length=5, least_count=3, damage=97) -> dict[str, int]:
    seen = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(helpers.UPPER)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= least_count}


def as_dict(df) -> dict[str, tuple]:
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_spelling_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{helpers.SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_variants(brute_counts(rows))
    assert len(want) > 1000 and any(r[0] for r in want.values())
    assert as_dict(op12_spelling_variants(spark, helpers.SF)) == want


@pytest.mark.parametrize("seed", range(3))
def test_variants_of_crowded_words(spark, seed):
    """A small alphabet: words with many near words, chains of forms, ties."""
    rng = random.Random(seed)
    words = {"".join(rng.choices("aàb", k=rng.randint(1, 6))) for _ in range(250)}
    counts = {w: 2 ** rng.randint(0, 9) for w in words}
    long = "xy" * 4000
    counts |= {long: 8, long[:-1]: 16, long[:3000] + "z" + long[3000:]: 2, long[:50] + "q" + long[51:]: 1}
    df = spark.createDataFrame([*counts.items(), (None, 5), ("", 9), ("aaa", None)], "word string, n bigint")
    assert as_dict(spelling_trie.variants(df.withColumn("wid", F.lit("x")).withColumn("p", F.lit(1)))) == brute_variants(counts)


def test_words_of_odd_texts(spark, no_docs):
    odd = [(1, "Été ÉTÉ été Straße STRASSE 日本 x×y÷z aaaaa Aaaaa aAAAA"), (None, "aaaaa Größe"), (2, None), (3, ""), (1, "aaaaa " * 5), (4, "b" * 100_000)]
    df = spark.createDataFrame(odd, "doc_id bigint, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit("x"))
    for damage in (None, 2):
        got = {r.word: r.n for r in spelling_trie.word_counts(df, least_length=1, least_count=1, damage=damage).collect()}
        assert got == brute_counts(odd, 1, 1, damage)
    empty = spelling_trie.word_counts(no_docs)
    assert empty.collect() == [] and spelling_trie.variants(empty).collect() == []
    assert as_dict(spelling_trie.variants(spark.createDataFrame([("abc", 1), ("abc", 2)], "word string, n int"))) == {"abc": (None, "abc", 3, 0, None)}
    with pytest.raises(ValueError):
        spelling_trie.variants(empty, ratio=1)


# -------------------------------------------------------------------- vectors
def brute_negatives(rows: dict[int, tuple[int, list[int]]], anchors: set[int], k: int = 5) -> set[tuple]:
    out = set()
    for a in anchors & set(rows):
        label, v = rows[a]
        ranked = sorted(((-sum(x * y for x, y in zip(v, w, strict=True)), i, lab) for i, (lab, w) in rows.items() if i != a))
        for ps, p, _ in [r for r in ranked if r[2] == label][:k]:
            fit = [(s, i) for s, i, lab in ranked if lab != label and 80 * -ps <= 100 * -s <= 100 * -ps][:k]
            out |= {(a, p, rank, i, -ps, -s) for rank, (s, i) in enumerate(fit, 1)}
    return out


def mined(df) -> set[tuple]:
    rows = [tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


@pytest.mark.parametrize(("seed", "spread", "block"), [(1, 3, 16_384), (2, 40, 20), (3, 1 << 27, 40)])
def test_mined_negatives_against_brute_force(spark, monkeypatch, seed, spread, block):
    """Ties, zero and negative scores, a frequent vector, scores beyond 2^53; small blocks."""
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", block // 2)
    rng = random.Random(seed)
    rows = {i: (rng.randint(0, 3), [rng.randint(-spread, spread) for _ in range(18)]) for i in range(150)}
    same = [rng.randint(0, spread) for _ in range(18)]
    rows |= {i: (rng.randint(0, 1), same) for i in range(150, 200)} | {200: (1, [0] * 18), 201: (9, same), 202: (2, [0] * 18)}
    listed = [(i, lab, v) for i, (lab, v) in rows.items()]
    odd = [(None, 1, same), (300, None, same), (301, 1, None), (302, 1, [None] * 18), (303, 1, []), (304, 1, [1, 2]), (305, 1, [1 << 40] * 18)]
    df = spark.createDataFrame(listed + odd + listed[:20], "id bigint, label int, v array<bigint>")
    got = hard_negatives.mine(df.withColumn("anchor", F.lit("x")).withColumn("score", F.lit(1)).withColumn("ib", F.lit(2)), F.col("id") % 5 == 0)
    want = brute_negatives(rows, {i for i in rows if i % 5 == 0})
    assert want and mined(got) == want


def test_negatives_of_small_tables(spark):
    schema = "id bigint, label int, v array<bigint>"
    assert hard_negatives.mine(spark.createDataFrame([], schema), F.lit(True)).collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(1, 1, [2])], schema), F.lit(True)).collect() == []
    rows = [(1, 1, [2]), (2, 1, [2]), (3, 2, [2]), (3, 1, [3])]  # of id 3 the lesser label stands
    assert mined(hard_negatives.mine(spark.createDataFrame(rows, schema), F.col("id") == 1)) == set()
    assert mined(hard_negatives.mine(spark.createDataFrame([*rows[:3], (4, 2, [2])], schema), F.col("id") == 1)) == {(1, 2, 1, 3, 4, 4), (1, 2, 2, 4, 4, 4)}
    assert hard_negatives.mine(spark.createDataFrame(rows, schema), F.lit(False)).collect() == []


def test_whole_components(spark):
    df = spark.createDataFrame([([0.5, -0.001],), ([float("nan")],), ([float("inf")],), ([None],), (None,), ([],)], "v array<float>")
    assert [r[0] for r in df.select(hard_negatives.whole_components(F.col("v"))).collect()] == [[128, -1], None, None, None, None, []]


def test_negatives_query_against_brute_force(spark):
    rows = {}
    for r in spark.read.parquet(f"{helpers.SF}/embeddings.parquet").collect():
        if r.label is not None and r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding):
            label = (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label
            rows[r.vec_id] = (label, [int(np.floor(256 * float(x))) for x in r.embedding])
    want = brute_negatives(rows, {i for i in rows if i % 100 == 0})
    assert want and mined(op13_hard_negatives(spark, helpers.SF)) == want

"""Exact and near deduplication, components, against brute force."""

import random

import helpers
import pytest
from pyspark.sql import functions as F

from pipewatch.llm import block_naming, bottomk_dedup
from pipewatch.llm.components import components


def by_id(df):
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    extra = [(1, 1), (3, 2), (2, 3), (None, 4)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star + extra, "a bigint, b bigint")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {7: 7} | {i: 7 for i in range(200, 260)} | {2: 2, 3: 2}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("block", [2, 3, 4096])
def test_block_names_are_equal_exactly_for_equal_texts(spark, block):
    texts = ["", None, " ", "a", "ab", "abc", "abca", "abcab", "abcabc", "ab\n\tab", "ab ab", "abcabcabcabc", "abcabcabcabd", "ab", "abab", "ba"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = block_naming.identities(docs, block=block).collect()
    assert len(got) == len(texts)
    import re

    norm = {i: re.sub("[\x20\x09-\x0d]+", " ", t or "") for i, t in enumerate(texts)}
    for x in got:
        for y in got:
            assert ((x["blocks"], x["name"]) == (y["blocks"], y["name"])) == (norm[x.doc_id] == norm[y.doc_id])


def test_digest_clashes_are_settled_by_content(spark):
    # Made-up digests: all four blocks share one.
    blocks = spark.createDataFrame([(0, 0, "x"), (1, 0, "y"), (2, 0, "x"), (3, 0, "z"), (4, 0, "q")], "row bigint, idx int, block string")
    blocks = blocks.withColumn("d1", F.when(F.col("block") == "q", 2).otherwise(1).cast("long")).withColumn("d2", F.lit(1).cast("long"))
    got = {r.row: r.name for r in block_naming._name_blocks(blocks, blocks.drop("block")).collect()}
    assert got[0] == got[2] and len({got[i] for i in (0, 1, 3, 4)}) == 4


def test_exact_groups_of_odd_documents(spark, odd, no_docs):
    got = block_naming.groups(odd).collect()
    assert len(got) == odd.count()
    mine = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got if r.doc_id not in (None, 13)}
    assert mine[0] == (0, 4, True) and mine[1] == (0, 4, False) and mine[2] == (0, 4, False)
    assert mine[3] == (3, 3, True) and mine[4] == (3, 3, False) and mine[5] == (5, 2, True) and mine[6] == (5, 2, False)
    assert mine[7] == (7, 2, True) and mine[8] == (7, 2, False) and mine[9][1] == 1
    assert sorted((r.keep_id, r.group_size, r.kept) for r in got if r.doc_id == 13) == [(13, 2, False), (13, 2, True)]
    assert sorted((r.keep_id, r.kept) for r in got if r.doc_id is None) == [(0, False), (3, False)]
    assert block_naming.groups(no_docs).collect() == []
    stay = block_naming.deduplicated(odd)
    assert stay.columns == odd.columns
    assert sorted(r.doc_id for r in stay.collect()) == [0, 3, 5, 7, 9, 10, 11, 12, 13, 14]


def test_near_duplicates_of_odd_documents(spark, odd, no_docs):
    got = bottomk_dedup.near_duplicates(odd, n=2)
    assert got.count() == odd.count()
    mine = by_id(got)
    texts = {d[0]: d[1] for d in helpers.odd_documents() if d[0] is not None}
    want = helpers.near_components(texts, 2)
    assert {i: r.component_id for i, r in mine.items()} == want
    assert {i: r.n_shingles for i, r in mine.items()} == {i: len(helpers.shingles(t, 2)) for i, t in texts.items()}
    assert all(r.kept == (i == r.component_id) for i, r in mine.items())
    assert bottomk_dedup.near_duplicates(no_docs, n=5).collect() == []
    assert bottomk_dedup.deduplicated(no_docs).collect() == []
    clash = odd.withColumn("cid", F.lit("x")).withColumn("n", F.lit("x")).withColumn("set", F.lit("x"))
    assert bottomk_dedup.deduplicated(clash, n=2).columns == clash.columns


def corpus(seed: int, n_words: int, near: int, edits: int, apart: int) -> list[tuple[int, str]]:
    """A base with ``near`` copies of ``edits`` changed words each, and
    unrelated documents that share one common phrase."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 6)))
    base = [word() for _ in range(n_words)]
    texts = [" ".join(base)]
    for _ in range(near):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(n_words)] = word()
        texts.append(" ".join(copy))
    for _ in range(apart):
        texts.append("it is of the " + " ".join(word() for _ in range(rng.randint(0, 25))))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("long_list", "n", "edits"), [(256, 2, 9), (3, 2, 9), (3, 5, 4)])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, long_list, n, edits):
    """Short lists by sketches, and very long lists by full sets: same links."""
    monkeypatch.setattr(bottomk_dedup, "LONG_LIST", long_list)
    rows = corpus(long_list + n, 90, 60, edits, 60) + [(1000 + i, t) for i, t in corpus(5, 14, 40, 1, 0)]
    got = by_id(bottomk_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), n=n))
    assert {i: r.component_id for i, r in got.items()} == helpers.near_components(dict(rows), n)


def test_pairs_of_short_lists_meet_once(spark, monkeypatch):
    """Two documents that share many lists are compared in the first of them only."""
    found = []
    meetings = bottomk_dedup._meetings

    def spy(members, key, extra, percent):
        out = meetings(members, key, extra, percent)
        if key == "v":
            found.append((out.count(), out.distinct().count()))
        return out

    monkeypatch.setattr(bottomk_dedup, "_meetings", spy)
    rows = corpus(11, 90, 40, 9, 20)
    got = by_id(bottomk_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), n=5))
    assert {i: r.component_id for i, r in got.items()} == helpers.near_components(dict(rows), 5)
    (made, pairs), = found
    assert made == pairs > 0


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_shingles_of_any_width(n):
    for t in ("a b a b a", "A b", "x", "", None, "\xa0 \x0b\x1c É é", "b a b a b c"):
        assert len(bottomk_dedup.shingle_hashes(t, n)) == len(helpers.shingles(t, n))
    assert bottomk_dedup.shingle_hashes("a b", 2).tolist() == bottomk_dedup.shingle_hashes("A\nB", 2).tolist()
    assert bottomk_dedup.shingle_hashes("a b", 2).tolist() != bottomk_dedup.shingle_hashes("b a", 2).tolist()


def test_near_dedup_settles_repeated_ids_by_text(spark):
    rng = random.Random(9)
    a, b, c, d = (" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(60)) for _ in range(4))
    rows = [(1, a, "x"), (2, b, "x"), (2, a + " more", "x"), (3, c, "x"), (3, c + " more", "x"), (3, c, "y"), (None, d, "x"), (None, d + " more", "x"), (None, b + " more", "x")]
    rows += [(4, None, "x"), (4, None, "x"), (4, a + " less", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, doc string")
    got = bottomk_dedup.deduplicated(docs)
    assert got.columns == docs.columns
    got = [tuple(r) for r in got.collect()]
    assert set(got) <= set(rows)
    assert sorted((i, t) for i, t, _ in got if i in (1, 2)) == [(1, a), (2, b)]
    assert [t in (c, c + " more") for i, t, _ in got if i == 3] == [True]
    assert [t in (d, d + " more") for i, t, _ in got if i is None] == [True]
    assert [t for i, t, _ in got if i == 4] == [None, None]


def test_low_thresholds_are_refused(spark, odd):
    with pytest.raises(ValueError):
        bottomk_dedup.near_duplicates(odd, percent=70)

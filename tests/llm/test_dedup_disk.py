"""What near deduplication leaves on disk while it runs and when it ends."""

import os
import random
import time

import helpers
import numpy as np
import pytest
from pyspark.sql import functions as F

from pipewatch.llm import bottomk_dedup, common

DOCS = "doc_id bigint, text string"


def unlike_documents(seed: int, count: int) -> list[tuple[int, str]]:
    """Documents of about one size, of which any two share a few word pairs, and close copies of the first."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(25)]
    texts = [" ".join(rng.choices(words, k=rng.randint(58, 62))) for _ in range(count)]
    return list(enumerate(texts + [texts[0] + " one", texts[0] + " two more"]))


def test_unlike_members_of_short_lists_make_no_pairs(spark, monkeypatch):
    """Lists bring unlike documents together; the join itself sorts them out."""
    made = []
    meetings, by_sketch = bottomk_dedup._meetings, bottomk_dedup._by_sketch

    def spy(members, key, extra, percent):
        out = meetings(members, key, extra, percent)
        made.append(out.count())
        return out

    def weighed(pairs, classes):
        made.append(pairs.count())
        return by_sketch(pairs, classes)

    monkeypatch.setattr(bottomk_dedup, "_meetings", spy)
    monkeypatch.setattr(bottomk_dedup, "_by_sketch", weighed)
    rows = unlike_documents(3, 40)
    got = {r.doc_id: r.component_id for r in bottomk_dedup.near_duplicates(spark.createDataFrame(rows, DOCS), n=2).collect()}
    assert got == helpers.near_components(dict(rows), 2)
    assert sum(made) <= 100  # 1501 where sizes alone decide


def test_marks_lose_no_pair_that_sketches_accept(spark):
    rng = np.random.default_rng(4)
    sketches = []
    for _ in range(60):
        base = rng.integers(-(2**63), 2**63, 48)
        for _ in range(4):  # from equal sketches to unlike ones, of full and of smaller size
            own = rng.integers(-(2**63), 2**63, rng.integers(0, 30))
            both = np.unique(np.concatenate([base[: rng.integers(1, 48)], own]))
            sketches.append(both[: bottomk_dedup.K])
    words = zip(*(m.to_pylist() for m in bottomk_dedup._marks(sketches)), strict=True)
    rows = [(i, len(s), s.tolist(), *w) for i, (s, w) in enumerate(zip(sketches, words, strict=True))]
    classes = spark.createDataFrame(rows, "cid bigint, n int, sketch array<bigint>, " + ", ".join(f"{m} bigint" for m in bottomk_dedup.MARKS))
    side = lambda x, n: classes.select(F.col("cid").alias(x), F.col("n").alias(n), *[F.col(m).alias(f"{m}{x}") for m in bottomk_dedup.MARKS])
    pairs = side("x", "na").crossJoin(side("y", "nb")).where("x < y")
    close = {tuple(r) for r in bottomk_dedup._by_sketch(pairs.select(F.col("x").alias("a"), F.col("y").alias("b")), classes).collect()}
    passed = {(r.x, r.y) for r in pairs.where(bottomk_dedup._may_share()).select("x", "y").collect()}
    assert close
    assert close <= passed
    assert len(passed) < pairs.count() / 10


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


@pytest.mark.parametrize("long_list", [256, 3])
def test_tables_and_shuffles_that_are_used_up_go(spark, monkeypatch, tmp_path, long_list):
    monkeypatch.setattr(bottomk_dedup, "LONG_LIST", long_list)
    monkeypatch.setattr(common, "work_dir", lambda spark, *parts: "/".join([str(tmp_path), *parts, str(time.time_ns())]))
    setting = spark.conf.get(common._CLEANUP, None)
    rows = unlike_documents(5, 20)
    docs = spark.createDataFrame(rows, DOCS)
    before = _shuffle_files(spark)
    out = bottomk_dedup.near_duplicates(docs, n=2)
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(common._CLEANUP, None) == setting
    kept = {d for d in os.listdir(tmp_path / "llm") if any(os.listdir(tmp_path / "llm" / d))}
    gone = {"docs", "sketches", "classes", "values", "postings", "centers", "members", "placed", "main", "lists", "rare"}
    assert not kept & {f"neardup_{t}" for t in gone}
    assert {r.doc_id: r.component_id for r in out.collect()} == helpers.near_components(dict(rows), 2)

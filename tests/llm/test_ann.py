"""Multi-index hashing: exact retrieval within the radius, recall, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pipewatch.llm import ann_mih
from pipewatch.llm.queries import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("radius", [0, 1, 7, 8, 9, 17, 40, 64])
def test_index_retrieves_every_code_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    codes = rng.integers(0, 256, size=(700, 8), dtype=np.uint8)
    codes[1] = codes[0]
    index = ann_mih.MultiIndex(codes)
    for q in (codes[0], codes[5] ^ np.uint8(3), rng.integers(0, 256, 8, dtype=np.uint8)):
        want = np.flatnonzero(ann_mih.hamming(codes, q) <= radius)
        assert index.within(q, radius).tolist() == want.tolist()


def brute(ids, x, i, k):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cosine = unit @ unit[i]
    cosine[i] = -9
    return ids[np.lexsort((ids, -cosine.round(12)))[:k]], cosine


def test_recall_and_scores_against_brute_force(spark):
    rows = queries()["op1_multi_index_hashing"](spark, SF).collect()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    ids, x = table["vec_id"].to_numpy(), np.stack(table["embedding"].to_numpy()).astype(np.float64)
    asked = [i for i in range(len(ids)) if ids[i] % 50 == 0]
    assert len(rows) == 5 * len(asked)
    hits = 0
    for i in asked:
        mine = sorted((r for r in rows if r.query_id == ids[i]), key=lambda r: r.rank)
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5]
        want, cosine = brute(ids, x, i, 5)
        hits += len({r.vec_id for r in mine} & set(want.tolist()))
        for r in mine:
            assert abs(r.score - cosine[ids == r.vec_id][0]) < 1e-12
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
    assert hits / (5 * len(asked)) >= 0.9


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, v string, q int")


def test_odd_vectors_take_no_part_and_ties_go_to_small_ids(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], "x", 1) for i in (50, 3, 9, 4, 7, 100, 8)]
    rows += [(1, [0.0, 1.0], "y", 1), (2, [0.5, 0.5], "y", 1)]
    rows += [(20, None, "", 0), (21, [0.0, 0.0], "", 0), (22, [nan, 1.0], "", 0), (23, [inf, 1.0], "", 0), (24, [None, 1.0], "", 0), (25, [1.0], "", 0), (None, [1.0, 0.0], "", 0), (150, [0.0, 0.0], "", 0)]
    got = ann_mih.search(vectors(spark, rows), F.col("vec_id") % 50 == 0, k=5).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(50, 3), (50, 4), (50, 7), (50, 8), (50, 9), (100, 3), (100, 4), (100, 7), (100, 8), (100, 9)]
    assert all(abs(r.score - 1) < 1e-12 for r in got)


def test_few_candidates_and_empty_tables(spark):
    got = ann_mih.search(vectors(spark, [(0, [1.0, 0.0], "", 0), (1, [-1.0, 0.1], "", 0), (0, [1.0, 0.0], "", 0)]), F.col("vec_id") % 50 == 0, k=5).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 1)]
    assert ann_mih.search(vectors(spark, []), F.lit(True)).collect() == []
    assert ann_mih.search(vectors(spark, [(0, None, "", 0)]), F.lit(True)).collect() == []

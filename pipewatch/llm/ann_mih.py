"""Nearest neighbours by multi-index hashing.

A rotation learned on a sample turns vectors into binary codes.  Codes are cut
into substrings, each with an index of its own.  If two codes differ in at
most r bits, some substring differs in few bits (pigeonhole), so probing the
substring indexes around a query's own substrings meets every code within the
Hamming radius r.  Those are reranked by the cosine of the original vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pipewatch.llm.common import saved

#: Vectors the rotation and the radius are fitted on, at most (a random choice that the seed fixes).
FIT_ROWS = 20_000
#: Rotations learned; each gives as many bits as the vectors have dimensions.
ROTATIONS = 2
#: Share of true neighbours within the sample that the radius must reach.
TARGET_RECALL = 0.985
#: Bits of a substring.
SUBSTRING = 8
#: Vectors and queries of one block, about; a task holds one block of each.
BLOCK_ROWS = 65_536
QUERY_ROWS = 4_096


@dataclass(frozen=True)
class Codec:
    """Centre and rotation (dims x bits), and the Hamming radius to search."""

    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as rows of bytes; each byte is a substring."""
        units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.packbits((units - self.mean) @ self.rotation > 0, axis=1)


def _learn_rotation(x: np.ndarray, seed: int, steps: int = 30) -> np.ndarray:
    """Iterative quantisation: turn the data so that its signs lose least."""
    r = np.linalg.qr(np.random.default_rng(seed).normal(size=(x.shape[1],) * 2))[0]
    for _ in range(steps):
        u, _, vt = np.linalg.svd(x.T @ np.where(x @ r > 0, 1.0, -1.0))
        r = u @ vt
    return r


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of code rows ``a`` to one code or row by row to ``b``."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int32)


def fit(sample: np.ndarray, k: int, rotations: int = ROTATIONS, recall: float = TARGET_RECALL, seed: int = 7) -> Codec:
    """Learn the codec on distinct nonzero ``sample`` vectors.  The radius is
    the smallest at which codes of ``recall`` of the sample's own ``k``
    nearest pairs meet.  The whole table is denser than the sample, its
    neighbours are nearer, and so the radius reaches at least that share."""
    units = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = units.mean(axis=0)
    rotation = np.concatenate([_learn_rotation(units - mean, seed + i) for i in range(rotations)], axis=1)
    pad = -rotation.shape[1] % SUBSTRING  # whole substrings only
    rotation = np.concatenate([rotation, np.zeros((rotation.shape[0], pad))], axis=1) if pad else rotation
    codec = Codec(mean, rotation, 0)
    codes, found = codec.codes(sample), []
    for i in range(0, len(units), max(1, len(units) // 500)):
        near = units @ units[i]
        near[i] = -2
        top = np.argpartition(-near, min(k, len(near) - 1))[:k] if len(near) > 1 else []
        found += [int(d) for j in top if j != i for d in [np.bitwise_count(codes[j] ^ codes[i]).sum()]]
    radius = int(np.quantile(found, recall, method="higher")) if found else codes.shape[1] * 8
    return Codec(mean, rotation, radius)


class MultiIndex:
    """Substring indexes over the codes of one block."""

    #: Values of a substring by their distance from 0.
    BY_DISTANCE = [np.flatnonzero(np.bitwise_count(np.arange(256, dtype=np.uint8)) <= s).astype(np.uint8) for s in range(9)]

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable").T  # per substring: rows in the order of its value
        values = np.arange(257)
        self.starts = [np.searchsorted(codes[o, j], values) for j, o in enumerate(self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes differ from ``code`` in at most ``radius`` bits.

        With m substrings and radius = m * s + a, a code within the radius has
        one of the first a + 1 substrings within s or one of the others within
        s - 1; were it otherwise its distance would be larger."""
        m = len(self.starts)
        s, a = divmod(radius, m)
        met = np.zeros(len(self.codes), dtype=bool)
        for j, (order, starts) in enumerate(zip(self.order, self.starts, strict=True)):
            reach = s if j <= a else s - 1
            if reach < 0:
                continue
            if reach >= 8:
                met[:] = True
                break
            for v in self.BY_DISTANCE[reach] ^ code[j]:
                met[order[starts[v] : starts[int(v) + 1]]] = True
        rows = np.flatnonzero(met)
        return rows[hamming(self.codes[rows], code) <= radius]


def sound(vector: str, dims: int) -> Column:
    """True for vectors of ``dims`` finite components that are not all zero."""
    v = F.col(vector)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) == dims) & good & F.exists(v, lambda x: x != 0), F.lit(False))


def _block(keys: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(keys), F.lit(blocks)).cast("int")


def search(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", fit_rows: int = FIT_ROWS) -> DataFrame:
    """The ``k`` nearest found of each row for which ``queries`` holds, among
    all other rows: query_id, rank (from 1), vec_id and score (cosine in
    double precision of the original vectors), nearest first, ties to the
    smaller vec_id.

    Vectors that are null, zero or hold null or non-finite components, or
    have another length than most of the sample, take no part.  Rows with a
    null id take no part.  Equal vectors are indexed once, with their k + 1
    smallest ids (more can never be among k), so a vector that fills a third
    of the table costs no more than any other.  A row that repeats its id is
    found once.  With fewer than k candidates found within the radius the
    whole block is searched for that query, so queries come back with k rows
    whenever there are k candidates.  No rows, no result."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").alias("v"), F.coalesce(queries, F.lit(False)).alias("q"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    common = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if common is None or common["d"] < 1:
        return spark.createDataFrame([], schema)
    rows = rows.where(sound("v", common["d"]))

    # One entry per distinct vector: its smallest ids.  The ranks are cut before rows are dealt out.
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    least = rows.select("id", "v").distinct().withColumn("r", first).where(F.col("r") <= k + 1)
    index = saved(least.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("g", F.col("ids")[0]), "ann_index")
    total = index.count()
    if not total:
        return spark.createDataFrame([], schema)
    sample = index.orderBy(F.xxhash64("g", F.lit(11)), "g").limit(fit_rows).select("v").toPandas()["v"]
    codec = fit(np.array(sample.tolist(), dtype=np.float64), k)

    asked = rows.where("q").select("id", "v")
    members = saved(asked.join(index.select("v", "g"), "v").select(F.col("id").alias("query_id"), "g").distinct(), "ann_queries")
    wanted = index.join(members.select("g").distinct(), "g").select(F.col("g").alias("qg"), F.col("v").alias("qv"))
    wanted = saved(wanted, "ann_wanted")
    nq = wanted.count()
    # Queries in blocks against the index in blocks.
    ib, qb = max(16, -(-total // BLOCK_ROWS)), max(1, -(-nq // QUERY_ROWS))
    left = index.select("g", "v", _block("g", ib).alias("ib"), F.explode(F.sequence(F.lit(0), F.lit(qb - 1))).alias("qb"))
    right = wanted.select("qg", "qv", _block("qg", qb).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(ib - 1))).alias("ib"))

    def run(block: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        return _search_block(block, asks, codec, k + 1)

    near = left.groupBy("ib", "qb").cogroup(right.groupBy("ib", "qb")).applyInPandas(run, "qg bigint, g bigint, score double")
    # The best k + 1 vectors of a query: its own and k others, whatever their ids.
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("g").alias("g")))), 1, k + 1)
    near = near.groupBy("qg").agg(best.alias("b")).select("qg", F.posexplode("b").alias("p", "x"))
    ids = near.select("qg", F.col("x.s").alias("s"), F.col("x.g").alias("g")).join(index.select("g", "ids"), "g")
    hits = ids.groupBy("qg").agg(F.sort_array(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(F.col("s").alias("s"), i.alias("id")))))).alias("hits"))
    hits = saved(hits, "ann_hits")
    got = members.join(hits, F.col("g") == F.col("qg"))
    others = F.slice(F.filter("hits", lambda h: h.getField("id") != F.col("query_id")), 1, k)
    out = got.select("query_id", F.posexplode(others).alias("p", "h"))
    return out.select("query_id", (F.col("p") + 1).alias("rank"), F.col("h.id").alias("vec_id"), (-F.col("h.s")).alias("score"))


def _search_block(block: pd.DataFrame, asks: pd.DataFrame, codec: Codec, k: int) -> pd.DataFrame:
    """The ``k`` best of one block for each query, its own vector included.
    A query that meets fewer than ``k`` codes searches the whole block."""
    none = pd.DataFrame({"qg": pd.Series(dtype="int64"), "g": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
    if block.empty or asks.empty:
        return none
    x, q = np.stack(block["v"].to_numpy()).astype(np.float64), np.stack(asks["qv"].to_numpy()).astype(np.float64)
    g, norms = block["g"].to_numpy(), np.sqrt((x * x).sum(axis=1))
    index, codes = MultiIndex(codec.codes(x)), codec.codes(q)
    out: list[tuple[np.ndarray, ...]] = []
    for i, ask in enumerate(asks["qg"].to_numpy()):
        rows = index.within(codes[i], codec.radius)
        if len(rows) < k:
            rows = np.arange(len(x))
        # Row-wise sums: the score of a pair does not depend on what shares its block.
        cosine = (x[rows] * q[i]).sum(axis=1) / (norms[rows] * np.sqrt((q[i] * q[i]).sum()))
        top = np.lexsort((g[rows], -cosine))[:k]
        out.append((np.full(len(top), ask), g[rows][top], cosine[top]))
    return pd.DataFrame({name: np.concatenate([o[c] for o in out]) for c, name in enumerate(("qg", "g", "score"))})

"""Hard negatives by threshold joins over an inverted index with norm bounds.

Dimensions are ordered by energy and cut into runs.  A row is indexed under
its leading runs only: once the norm of what is left of it cannot reach the
threshold, the rest is omitted from the index.  A join adds up partial scores
run by run, drops pairs whose partial score and remaining norms stay below the
anchor's threshold, and completes the pairs that are left from the omitted
dimensions.  Thresholds begin high and are lowered for the anchors whose
windows are not full yet.

Anchors (a stated query set) meet all rows in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pipewatch.llm.common import saved

#: Rows of an index block, anchors of an anchor block, and anchors that are joined at once.
BLOCK_ROWS, ANCHOR_ROWS, AT_ONCE = 16_384, 2_048, 64
#: Dimensions of a run.
RUN = 16
#: Whole components beyond this take a row out: inner products must fit 64 bits.
LARGEST = 1 << 27
#: A threshold after each lowering, as a share of the anchor's first one.
STEPS = (1.0, 0.75, 0.55, 0.4, 0.25, 0.1)


class PrunedIndex:
    """The rows of a block under their leading runs of dimensions."""

    def __init__(self, vectors: np.ndarray):
        order = np.argsort(-np.square(vectors, dtype=np.float64).sum(axis=0), kind="stable")
        self.dims = [order[i : i + RUN] for i in range(0, len(order), RUN)]
        self.vectors = vectors
        self.rest = self.remaining(vectors)
        self.norms = self.rest[0]

    def remaining(self, vectors: np.ndarray) -> np.ndarray:
        """Norms of what is left of each vector before run 0, 1, ..., and after the last."""
        squares = np.array([np.square(vectors[:, d], dtype=np.float64).sum(axis=1) for d in self.dims])
        left = np.vstack([np.cumsum(squares[::-1], axis=0)[::-1], np.zeros(len(vectors))])
        return np.sqrt(left) * (1 + 1e-12)

    def join(self, asks: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(ask, rows, scores) for each ask in turn: all rows with a score of
        at least ``least`` of it."""
        for at in range(0, len(asks), AT_ONCE):
            q, t = asks[at : at + AT_ONCE], least[at : at + AT_ONCE].astype(np.float64)
            rest = self.remaining(q)
            # A row is listed in a run if what is left of it before the run can reach one of the thresholds.
            with np.errstate(divide="ignore", invalid="ignore"):
                reach = np.min(np.where(t > 0, t / rest[0], -np.inf))
            listed = self.rest[:-1] >= reach
            runs = listed.sum(axis=0)
            rows = np.flatnonzero(runs)
            whole = self.kind(rest[0].max(initial=0), rows)
            part = np.zeros((len(q), len(rows)), whole)
            for run, dims in enumerate(self.dims):
                here = listed[run][rows]
                if not here.any():
                    break
                part[:, here] += q[:, dims].astype(whole) @ self.vectors[np.ix_(rows[here], dims)].T.astype(whole)
                bound = part + rest[run + 1][:, None] * self.rest[run + 1][rows]
                alive = ~here | (bound >= t[:, None]).any(axis=0)
                rows, part = rows[alive], part[:, alive]
            # Rows left: what was omitted of each is bounded by its norm, then added.
            bound = part + rest[runs[rows]].T * self.rest[runs[rows], rows]
            for i in range(len(q)):
                good = np.flatnonzero(bound[i] >= t[i])
                score = self.complete(q[i], rows[good], part[i][good], runs[rows[good]])
                enough = score >= least[at + i]
                yield at + i, rows[good][enough], score[enough]

    def kind(self, norm: float, rows: np.ndarray) -> type:
        """Doubles add whole numbers exactly below 2^53."""
        return np.float64 if norm * self.norms[rows].max(initial=0) < 2**52 else np.int64

    def complete(self, ask: np.ndarray, rows: np.ndarray, part: np.ndarray, done: np.ndarray) -> np.ndarray:
        """Scores with the omitted dimensions added."""
        score = part.astype(np.int64)
        for run in np.unique(done):
            if run < len(self.dims):
                dims, these = np.concatenate(self.dims[run:]), done == run
                score[these] += (self.vectors[np.ix_(rows[these], dims)] * ask[dims]).sum(axis=1)
        return score


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _positives(block: pd.DataFrame, asks: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best rows of the anchor's label in a block: thresholds fall
    until that many are found, at last to where every row is met."""
    out: list[tuple] = []
    for label, mine in asks.groupby("label"):
        held = block[block["label"] == label]
        if held.empty:
            continue
        index, ids = PrunedIndex(np.stack(held["v"].to_numpy()).astype(np.int64)), held["id"].to_numpy()
        q, own = np.stack(mine["v"].to_numpy()).astype(np.int64), mine["id"].to_numpy()
        top = np.sqrt(np.square(q, dtype=np.float64).sum(axis=1)) * index.norms.max()
        open_ = np.arange(len(q))
        for step in (*STEPS, None):
            least = np.floor(top[open_] * 0.8 * step) if step is not None else -np.ceil(top[open_]) - 1
            unfilled = []
            for i, rows, scores in index.join(q[open_], least.astype(np.int64)):
                other = ids[rows] != own[open_[i]]
                rows, scores = rows[other], scores[other]
                if step is not None and len(rows) < k:
                    unfilled.append(open_[i])
                    continue
                best = _top(ids[rows], scores, k)
                out += [(own[open_[i]], ids[rows[j]], scores[j]) for j in best]
            open_ = np.array(unfilled, dtype=int)
            if not len(open_):
                break
    return pd.DataFrame(out, columns=["anchor", "id", "score"])


def _negatives(block: pd.DataFrame, asks: pd.DataFrame, k: int, low: int, high: int) -> pd.DataFrame:
    """For each anchor and positive, the ``k`` best rows of other labels in a
    block within the positive's window.  The threshold falls from the highest
    window's upper end to the lowest window's lower end, and no further for an
    anchor whose windows are all full."""
    out: list[tuple] = []
    if block.empty or asks.empty:
        return pd.DataFrame(out, columns=["anchor", "positive", "positive_score", "id", "score"])
    index, ids, labels = PrunedIndex(np.stack(block["v"].to_numpy()).astype(np.int64)), block["id"].to_numpy(), block["label"].to_numpy()
    q = np.stack(asks["v"].to_numpy()).astype(np.int64)
    own, label = asks["id"].to_numpy(), asks["label"].to_numpy()
    # The least and greatest scores of each window, in whole numbers.
    windows = [[(int(p), int(s), -(-low * int(s) // 100), min(high * int(s) // 100, 2**62)) for p, s in zip(ps, ss, strict=True)] for ps, ss in zip(asks["positives"], asks["scores"], strict=True)]
    floor = np.array([min(w[2] for w in ws) for ws in windows], dtype=np.int64)
    ceiling = np.array([max(w[3] for w in ws) for ws in windows], dtype=np.int64)
    open_ = np.arange(len(q))
    for step in (*STEPS[1:], 0.0):
        least = floor[open_] + ((ceiling[open_] - floor[open_]) * step).astype(np.int64)
        unfilled = []
        for i, rows, scores in index.join(q[open_], least):
            a = open_[i]
            other = (labels[rows] != label[a]) & (ids[rows] != own[a])
            rows, scores = rows[other], scores[other]
            found, full = [], True
            for p, s, lo, hi in windows[a]:
                inside = (scores >= lo) & (scores <= hi)
                full &= inside.sum() >= k or least[i] <= lo
                best = _top(ids[rows[inside]], scores[inside], k)
                found += [(own[a], p, s, ids[rows[inside][j]], scores[inside][j]) for j in best]
            if full or step == 0.0:
                out += found
            else:
                unfilled.append(a)
        open_ = np.array(unfilled, dtype=int)
        if not len(open_):
            break
    return pd.DataFrame(out, columns=["anchor", "positive", "positive_score", "id", "score"])


def whole_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component x as a double; null where the
    vector is null or a component is null or not finite."""
    x = lambda e: e.cast("double")
    good = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(x(e)) & (F.abs(x(e)) < float("inf")))
    return F.when(F.coalesce(good, F.lit(False)), F.transform(vector, lambda e: F.floor(x(e) * scale).cast("long")))


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")


def _first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, id_col: str = "id", label: str = "label", vector: str = "v") -> DataFrame:
    """Hard negatives of the rows for which ``anchors`` holds.

    ``vector`` holds whole numbers (:func:`whole_components`).  A row's score
    is its inner product with the anchor; higher scores come first, ties by
    smaller id.  An anchor's positives are its first other rows of the same
    label.  For each, the first rows of other labels are returned whose score
    lies between ``low`` and ``high`` percent of the positive's: anchor_id,
    positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Rows with a null id, label or vector (or component), without components,
    with components beyond 2^27, or of another length than most rows take no
    part.  Rows that repeat an id: the one with the least label, then vector,
    stands for it.  Of rows with one label and vector only the smallest ids
    can be among the first, so a vector that fills a third of the table costs
    no more than any other.  No rows or anchors, no result."""
    spark = rows.sparkSession
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    v = F.col(f"`{vector}`")
    sound = F.coalesce(F.forall(v, lambda x: x.isNotNull() & (F.abs(x) <= LARGEST)), F.lit(False)) & (F.size(v) > 0)
    data = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), v.alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    data = data.where(F.col("id").isNotNull() & F.col("label").isNotNull() & sound)
    data = saved(data.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"), F.max("anchor").alias("anchor")).select("id", "r.label", "r.v", "anchor"), "negatives_rows")
    common = data.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    data = data.where(F.size("v") == common["d"])
    most = max(positives + 1, negatives + 1)
    same = Window.partitionBy("label", "v").orderBy("id")
    index = saved(data.withColumn("r", F.row_number().over(same)).where(F.col("r") <= most).select("id", "label", "v"), "negatives_index")
    asked = saved(data.where("anchor").select("id", "label", "v"), "negatives_anchors")
    ib, qb = max(16, -(-index.count() // BLOCK_ROWS)), max(1, -(-asked.count() // ANCHOR_ROWS))
    left = index.withColumn("ib", _block(ib)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1))))
    cells = lambda df: df.withColumn("qb", _block(qb)).withColumn("ib", F.explode(F.sequence(F.lit(0), F.lit(ib - 1))))

    def first(block: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        return _positives(block, asks, positives)

    def then(block: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        return _negatives(block, asks, negatives, low, high)

    found = left.groupBy("ib", "qb").cogroup(cells(asked).groupBy("ib", "qb")).applyInPandas(first, "anchor bigint, id bigint, score bigint")
    best = saved(_first(found, ["anchor"], positives), "negatives_positives")
    # A positive with a score below 0 has no window.
    with_windows = best.where(F.col("score") >= 0).groupBy(F.col("anchor").alias("id")).agg(F.collect_list(F.struct("rank", F.col("id").alias("p"), "score")).alias("b"))
    with_windows = with_windows.select("id", F.col("b.p").alias("positives"), F.col("b.score").alias("scores"))
    asks = saved(asked.join(with_windows, "id"), "negatives_windows")
    found = left.groupBy("ib", "qb").cogroup(cells(asks).groupBy("ib", "qb")).applyInPandas(then, "anchor bigint, positive bigint, positive_score bigint, id bigint, score bigint")
    out = _first(found, ["anchor", "positive"], negatives)
    return out.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

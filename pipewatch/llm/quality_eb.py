"""Quality by hierarchical empirical Bayes.

A logistic model gives the evidence of a document's own text.  Sites (host,
then path within host) have posteriors of their own: the share of good
documents there, shrunk towards the level above by as much as sites differ.
A document's posterior combines its evidence with its site's posterior,
leaving itself out.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipewatch.llm.common import hash52, saved

#: Labelled documents the model is fitted on, at most (those of the smallest id hashes).
FIT_ROWS = 20_000
#: A document stays if its posterior of being good is at least this.
KEEP = 0.5
#: Up to so many sites the site table may be broadcast (counted first).
BROADCAST_SITES = 100_000
#: Evidence (log odds) is held within these bounds, so no site prior is ever beyond reach.
EVIDENCE = 12.0

FEATURES = (
    "log_words", "distinct_words", "top_word", "repeats", "distinct_pairs", "mean_word", "long_words",
    "letters", "upper", "digits", "marks", "stops", "odd_words", "distinct_lines", "line_words", "capital_words",
)

_LETTERS = re.compile(r"[^\W\d_]")
_MARKS = re.compile(r"[^\w\s.,;:'\"()?-]")


def text_features(text: str | None) -> list[float]:
    """The features of one text; a null or blank text gives zeros."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = sum(map(len, words))
    counts = Counter(words)
    pairs = set(zip(words, words[1:], strict=False))
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = [x for x in text.split("\n") if x]
    # Letters and marks by kind: count characters once, then sort the few distinct ones.
    chars = Counter(text)
    letters = upper = digits = marks = 0
    for c, k in chars.items():
        if _LETTERS.match(c):
            letters += k
            upper += k * c.isupper()
        elif c.isdigit():
            digits += k
        elif _MARKS.match(c):
            marks += k
    odd = sum(k for w, k in counts.items() if _MARKS.search(w))
    return [
        float(np.log1p(n)),
        len(counts) / n,
        max(counts.values()) / n,
        repeats / n,
        len(pairs) / n,
        size / n,
        sum(k for w, k in counts.items() if len(w) > 20) / n,
        letters / size,
        upper / max(1, letters),
        digits / size,
        marks / size,
        chars.get(".", 0) / n,
        odd / n,
        len(set(lines)) / max(1, len(lines)),
        float(np.log1p(n / max(1, len(lines)))),
        sum(k for w, k in counts.items() if w[:1].isupper()) / n,
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def features(text: pd.Series) -> pd.Series:
    return text.map(text_features)


@dataclass(frozen=True)
class Model:
    """Log odds = bias + sum of weight * feature; ``base`` is the share of
    good documents in the fit (0.5 if it knows nothing)."""

    bias: float
    weights: tuple[float, ...]
    base: float

    def evidence(self, f: Column) -> Column:
        """Log likelihood ratio of good against bad."""
        total = F.lit(self.bias - float(np.log(self.base / (1 - self.base))))
        for i, w in enumerate(self.weights):
            total = total + F.get(f, F.lit(i)) * F.lit(w)
        # A blank text says nothing about itself.
        held = F.greatest(F.lit(-EVIDENCE), F.least(F.lit(EVIDENCE), total))
        return F.when(F.get(f, F.lit(0)) > 0, held).otherwise(F.lit(0.0))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> Model:
    """Logistic regression on standardised features and their squares' signs
    left out; Newton steps with a ridge.  With one class only, or no rows, the
    model knows nothing (weights 0, even odds)."""
    if len(set(y.tolist())) < 2:
        return Model(0.0, (0.0,) * len(FEATURES), 0.5)
    base = float((y.sum() + 1) / (len(y) + 2))
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1.0
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[1:] / scale
    return Model(float(w[0] - weights @ mean), tuple(float(v) for v in weights), base)


def fit_on(featured: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents: ``featured`` has doc_id and
    f, ``labels`` doc_id and quality (0 or 1; others and nulls are no labels).
    The rows with the smallest hashes of their ids are taken, so the choice
    is the same each time."""
    chosen = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "quality")
    chosen = chosen.orderBy(hash52(F.col("doc_id")), "doc_id", "quality").limit(rows)
    got = featured.join(F.broadcast(chosen), "doc_id").select("quality", "f").limit(4 * rows).toPandas()
    x = np.array(got["f"].tolist(), dtype=float).reshape(len(got), len(FEATURES))
    return fit(x, got["quality"].to_numpy(dtype=float))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def strength(sites: DataFrame, n: str, total: str, mean: float) -> float:
    """How many documents the level above is worth, from how much sites
    differ: with a Beta prior of strength k the variance of site shares beyond
    sampling noise is mean (1 - mean) / (k + 1).  Held between 1 and 10,000."""
    share = F.col(total) / F.col(n)
    row = sites.where(F.col(n) > 1).agg(
        F.sum(F.col(n) * (share - mean) * (share - mean)).alias("between"), F.sum(n).alias("docs"), F.count("*").alias("sites")
    ).first()
    noise = mean * (1 - mean)
    if not row["sites"] or noise <= 0:
        return 10_000.0
    extra = (row["between"] - row["sites"] * noise) / row["docs"]
    return float(min(10_000.0, max(1.0, noise / extra - 1))) if extra > 0 else 10_000.0


@dataclass(frozen=True)
class Sites:
    """Sums of each path (with its host's), the global mean and strengths."""

    table: DataFrame
    mean: float
    host_strength: float
    path_strength: float
    small: bool


def site_sums(judged: DataFrame, host: str, path: str) -> Sites:
    """Grouped sums of ``p`` (the document's own probability) by host and path."""
    paths = saved(judged.groupBy(F.col(host).alias("_host"), F.col(path).alias("_path")).agg(F.count("*").alias("_n"), F.sum("p").alias("_s")), "quality_paths")
    hosts = saved(paths.groupBy("_host").agg(F.sum("_n").alias("_hn"), F.sum("_s").alias("_hs")), "quality_hosts")
    whole = hosts.agg(F.sum("_hn"), F.sum("_hs")).first()
    mean = (float(whole[1] or 0) + 1) / (float(whole[0] or 0) + 2)
    both = saved(paths.join(hosts.withColumnRenamed("_host", "_h"), F.col("_host").eqNullSafe(F.col("_h"))).drop("_h"), "quality_sites")
    return Sites(both, mean, strength(hosts, "_hn", "_hs", mean), strength(paths, "_n", "_s", mean), both.count() <= BROADCAST_SITES)


def with_posterior(judged: DataFrame, sites: Sites, host: str, path: str) -> DataFrame:
    """Add ``host_share``, ``path_share`` (both without the document itself)
    and ``posterior`` to rows that have ``evidence`` and ``p``."""
    side = F.broadcast(sites.table) if sites.small else sites.table
    met = judged.join(side, F.col(host).eqNullSafe(F.col("_host")) & F.col(path).eqNullSafe(F.col("_path")))
    kh, kp = F.lit(sites.host_strength), F.lit(sites.path_strength)
    host_share = (kh * F.lit(sites.mean) + F.greatest(F.lit(0.0), F.col("_hs") - F.col("p"))) / (kh + F.col("_hn") - 1)
    path_share = (kp * F.col("host_share") + F.greatest(F.lit(0.0), F.col("_s") - F.col("p"))) / (kp + F.col("_n") - 1)
    inside = lambda c: F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), c))
    met = met.withColumn("host_share", inside(host_share)).withColumn("path_share", inside(path_share))
    return met.withColumn("posterior", _sigmoid(_logit(F.col("path_share")) + F.col("evidence"))).drop("_host", "_path", "_n", "_s", "_hn", "_hs")


def _with_p(df: DataFrame, model: Model) -> DataFrame:
    prior = float(np.log(model.base / (1 - model.base)))
    return df.withColumn("evidence", model.evidence(F.col("f"))).withColumn("p", _sigmoid(F.col("evidence") + F.lit(prior)))


def _featured(docs: DataFrame, host: str, path: str) -> DataFrame:
    return saved(docs.select("doc_id", F.col(host).alias("host"), F.col(path).alias("path"), features(F.col("text")).alias("f")), "quality_features")


def scores(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", keep: float = KEEP, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, host, path, evidence, host_share,
    path_share, posterior and kept.

    Null hosts and paths are sites of their own.  Null and blank texts have no
    evidence; their site decides.  Repeated rows are scored alike.  Without
    labels, or with labels of one class only, the model knows nothing, all
    posteriors are even and documents stay.  An empty table gives no rows."""
    featured = _featured(docs, host, path)
    judged = _with_p(featured, fit_on(featured, labels, fit_rows))
    out = with_posterior(judged, site_sums(judged, "host", "path"), "host", "path")
    return out.select("doc_id", "host", "path", "evidence", "host_share", "path_share", "posterior", (F.col("posterior") >= keep).alias("kept"))


def kept(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", keep: float = KEEP, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  Rows are judged
    where they lie: the text is read twice and never shuffled."""
    featured = _featured(docs, host, path)
    model = fit_on(featured, labels, fit_rows)
    sites = site_sums(_with_p(featured, model), "host", "path")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, F.col(host).alias("host"), F.col(path).alias("path"), features(F.col("text")).alias("f"))
    rows = with_posterior(_with_p(rows, model), sites, "host", "path").where(F.col("posterior") >= keep)
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

"""Mixing sources to target weights by Pareto order sampling.

Every document is due an expected number of copies.  The whole part is
certain.  For the rest, documents draw Pareto keys (random odds over the odds
of inclusion); in their order every document that fits what the source's target
still leaves is taken.

Only DataFrame functions: no Python runs on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pipewatch.llm.common import hash52, saved, unit, words

#: Rows of the whole corpus in one range of Pareto keys, about.
RANGE_ROWS = 2_000
#: Up to so many sources (or repeated documents) their tables may be broadcast (counted first).
BROADCAST_SOURCES = 100_000
#: Stretches of the order in which documents up to a size are taken.
RUNS = "array<struct<after:struct<_mix_key:double,_mix_seed:bigint>,stop:struct<_mix_key:double,_mix_seed:bigint>,room:double>>"


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def targets(sizes: DataFrame, share: float, cap: float) -> DataFrame:
    """``sizes`` has a row per source: ``source``, ``weight`` and
    ``source_size``.  Targets are ``share`` times all sizes dealt out by
    weight; a target stops at ``cap`` times its source's size and the excess
    goes to the others by weight, until none is above.

    Closed form: targets are min(cap, level * weight); sources reach their cap
    in the order of cap / weight, so the level follows from running sums over
    one row per source."""
    up = Window.orderBy("_reach", "source").rowsBetween(Window.unboundedPreceding, -1)
    on = Window.orderBy("_reach", "source").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    limits = (
        sizes.withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
        .withColumn("_reach", F.col("_cap") / F.col("weight"))
        .withColumn("_total", F.sum("source_size").over(Window.partitionBy(F.lit(1))) * F.lit(float(share)))
        .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(up), F.lit(0.0))) / F.sum("weight").over(on))
    )
    # The level holds from the first source that does not reach its cap under it.
    level = F.min(F.when(F.col("_level") <= F.col("_reach"), F.struct("_reach", "source", "_level"))).over(Window.partitionBy(F.lit(1)))
    chosen = limits.withColumn("_chosen", level.getField("_level"))
    target = F.when(F.col("_chosen").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_chosen") * F.col("weight")))
    return chosen.select("source", "source_size", "weight", target.alias("target"))


def _with_source(df: DataFrame, per: DataFrame, small: bool, *more: Column, how: str = "inner") -> DataFrame:
    """Join the per-source table ``per`` to rows on ``source`` (null included)."""
    side = per.withColumnRenamed("source", "_mix_s")
    cond = F.col("source").eqNullSafe(F.col("_mix_s"))
    for c in more:
        cond = cond & c
    return df.join(F.broadcast(side) if small else side, cond, how).drop("_mix_s")


def _cut(df: DataFrame, small: bool) -> DataFrame:
    """Where the room of each source ends.  ``df`` has ``source``, ``_mix_room``,
    ``_mix_range``, ``_mix_key``, ``_mix_seed`` and ``_mix_size``.  Returns
    ``source``, ``_mix_stop`` (place of the first document that does not fit,
    null if all do) and ``_mix_gap`` (the room left before it)."""
    # Words by (source, range) and running sums over them: the range where the room ends.
    sums = df.groupBy("source", "_mix_range").agg(F.sum("_mix_size").alias("_mix_words"), F.first("_mix_room").alias("_mix_room"))
    before = F.coalesce(F.sum("_mix_words").over(Window.partitionBy("source").orderBy("_mix_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("_mix_room", F.col("_mix_room") - before)
    edge = F.min(F.when(F.col("_mix_words") > F.col("_mix_room"), F.struct("_mix_range", "_mix_room")))
    edges = sums.groupBy("source").agg(edge.alias("e"), F.min(F.col("_mix_room") - F.col("_mix_words")).alias("_mix_after"))
    edges = saved(edges.select("source", "_mix_after", F.col("e._mix_range").alias("_mix_edge"), F.col("e._mix_room").alias("_mix_left")), "mixing_edges")

    # Only that range is put in order, row by row.
    rows = _with_source(df, edges.drop("_mix_after"), small, F.col("_mix_range") == F.col("_mix_edge"))
    total = F.sum("_mix_size").over(Window.partitionBy("source").orderBy("_mix_key", "_mix_seed"))
    rows = rows.withColumn("_mix_sum", total)
    inside = F.col("_mix_sum") <= F.col("_mix_left")
    stops = rows.groupBy("source").agg(
        F.min(F.when(~inside, F.struct("_mix_key", "_mix_seed"))).alias("_mix_stop"),
        (F.first("_mix_left") - F.coalesce(F.max(F.when(inside, F.col("_mix_sum"))), F.lit(0))).alias("_mix_gap"),
    )
    found = _with_source(edges.select("source", "_mix_after"), stops, False, how="left")
    return saved(found.select("source", "_mix_stop", F.coalesce("_mix_gap", "_mix_after").alias("_mix_gap")), "mixing_cuts")


def mix(docs: DataFrame, weights: DataFrame, share: float = 1.5, cap: int = 2, inclusion: Column | None = None, seed: int = 17, narrow: bool = False) -> DataFrame:
    """Copies of each document for a mix of ``share`` times the words of ``docs``.

    ``docs`` has ``doc_id``, ``text`` and ``source``; ``weights`` has
    ``source`` and ``weight`` (above 0) for every source, null included.
    Returns every row of ``docs`` (all its columns, or with ``narrow`` only
    ``doc_id`` and ``source``) with ``size`` (words), ``source_size``,
    ``target`` (its source's, in words), ``copies`` (0 to ``cap``) and
    ``taken`` (copies * size).

    Every document is due target / source_size copies: the whole part is
    certain, the fraction is the mean chance of one more.  ``inclusion`` (a
    column in (0, 1], default 1) multiplies a document's chance.  Documents
    are ranked by the odds of a uniform draw over the odds of their chance.
    In that order every document whose words fit what the target still leaves
    is taken, until none is left that fits; at last the one document nearest
    to the gap, if it is nearer than nothing.  So a source misses its target by
    half of the smallest document not taken, at most.

    Null text counts as empty; empty documents weigh nothing (they are taken
    before the first document that does not fit).  Null sources are a source.
    Rows that repeat (same source, id and text) draw alike and share their
    fate: they count with the words of all of them.  An empty table gives an empty mix.  Columns of ``docs`` with
    the names added are replaced, those that start with ``_mix_`` left out."""
    added = ("size", "source_size", "target", "copies", "taken")
    mine = [c for c in docs.columns if c not in added and not c.startswith("_mix_")]
    tilt = F.lit(1.0) if inclusion is None else F.greatest(F.lit(1e-6), F.least(F.lit(1.0), F.coalesce(inclusion.cast("double"), F.lit(1.0))))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in mine],
        word_count(F.col("text")).alias("_mix_size"),
        hash52(F.lit(seed), F.col("doc_id"), F.md5("text")).alias("_mix_seed"),
        tilt.alias("_mix_tilt"),
    )
    slim = saved(rows.select("doc_id", "source", "_mix_size", "_mix_seed", "_mix_tilt"), "mixing")

    per = slim.groupBy("source").agg(F.sum("_mix_size").alias("source_size"))
    per = per.join(weights.select(F.col("source").alias("_mix_s"), "weight"), F.col("source").eqNullSafe(F.col("_mix_s"))).drop("_mix_s")
    goal = targets(per, share, cap)
    due = F.when(F.col("source_size") > 0, F.least(F.lit(float(cap)), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    goal = saved(goal.select("source", "source_size", "target", F.floor(due).cast("int").alias("_mix_whole"), (due - F.floor(due)).alias("_mix_rest")), "mixing_targets")
    small = goal.count() <= BROADCAST_SOURCES

    # A monotone form of the Pareto key in (0, 1); with inclusion 1 it is the uniform draw itself.
    mean = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), F.col("_mix_rest")))
    chance = mean * F.col("_mix_tilt")
    u = unit(F.col("_mix_seed"))
    odds = u / (1 - u) * ((mean / (1 - mean)) / (chance / (1 - chance)))
    ranges = max(64, -(-slim.count() // RANGE_ROWS))

    # Rows that repeat are taken together or not at all.
    repeats = slim.groupBy("source", F.col("_mix_seed").alias("_mix_r")).agg(F.sum("_mix_size").alias("_mix_all"), F.count("*").alias("n"))
    repeats = saved(repeats.where("n > 1 AND _mix_all > 0").drop("n"), "mixing_repeats")
    n_repeats = repeats.count()

    def keyed(df: DataFrame) -> DataFrame:
        k = _with_source(df, goal, small).withColumn("_mix_key", odds / (1 + odds))
        k = k.withColumn("_mix_range", F.least(F.lit(ranges - 1), F.floor(F.col("_mix_key") * ranges).cast("int")))
        if not n_repeats:
            return k.withColumn("_mix_by", F.col("_mix_size"))
        k = _with_source(k, repeats, n_repeats <= BROADCAST_SOURCES, F.col("_mix_seed") == F.col("_mix_r"), how="left")
        return k.withColumn("_mix_by", F.coalesce("_mix_all", "_mix_size")).drop("_mix_r", "_mix_all")

    place = F.struct("_mix_key", "_mix_seed")
    slots = ["source", "_mix_size", "_mix_by", "_mix_key", "_mix_seed", "_mix_range"]
    left = keyed(slim).where(F.col("_mix_whole") < cap)
    cuts = _cut(left.withColumn("_mix_room", F.col("target") - F.col("source_size") * F.col("_mix_whole")), small)
    cuts = cuts.withColumn("_mix_runs", F.array().cast(RUNS)).withColumn("_mix_at", F.col("_mix_stop"))
    # Go on behind the document that did not fit with those that fit the room left, until there are none.
    while True:
        going = cuts.where("_mix_at IS NOT NULL AND _mix_gap > 0").select("source", "_mix_at", F.col("_mix_gap").alias("_mix_room"))
        fits = (place > F.col("_mix_at")) & (F.col("_mix_by") > 0) & (F.col("_mix_by") <= F.col("_mix_room"))
        left = saved(_with_source(left.select(*slots), going, small).where(fits).select(*slots, "_mix_room"), "mixing_left")
        if left.isEmpty():
            break
        step = _cut(left, small).select("source", F.col("_mix_stop").alias("_mix_next"), F.col("_mix_gap").alias("_mix_rest_gap"))
        run = F.array(F.struct(F.col("_mix_at").alias("after"), F.col("_mix_next").alias("stop"), F.col("_mix_gap").alias("room")))
        went = F.col("_mix_rest_gap").isNotNull()
        cuts = _with_source(cuts, step, False, how="left").select(
            "source",
            "_mix_stop",
            F.coalesce("_mix_rest_gap", "_mix_gap").alias("_mix_gap"),
            F.when(went, F.concat("_mix_runs", run)).otherwise(F.col("_mix_runs")).alias("_mix_runs"),
            F.col("_mix_next").alias("_mix_at"),
        )
        cuts = saved(cuts, "mixing_runs")

    def in_run(r: Column) -> Column:
        before = r.getField("stop").isNull() | (place < r.getField("stop"))
        return (place > r.getField("after")) & before & (F.col("_mix_by") > 0) & (F.col("_mix_by") <= r.getField("room"))

    won = F.col("_mix_stop").isNull() | (place < F.col("_mix_stop")) | F.coalesce(F.exists("_mix_runs", in_run), F.lit(False))
    # What is left is larger than the gap: the nearest, if it is nearer than nothing.
    off = F.abs(F.col("_mix_gap") - F.col("_mix_by"))
    last = _with_source(keyed(slim), cuts, small).where((F.col("_mix_by") > 0) & (off < F.col("_mix_gap")) & ~won)
    last = last.groupBy("source").agg(F.min(F.struct(off.alias("off"), "_mix_key", "_mix_seed")).alias("f"))
    last = last.select("source", F.struct(F.col("f._mix_key").alias("_mix_key"), F.col("f._mix_seed").alias("_mix_seed")).alias("_mix_last"))
    cuts = saved(_with_source(cuts, last, False, how="left"), "mixing_fills")

    full = _with_source(keyed(slim if narrow else rows), cuts, small, how="left")
    won = won | F.coalesce(place == F.col("_mix_last"), F.lit(False))
    copies = F.col("_mix_whole") + F.when((F.col("_mix_whole") < cap) & won, 1).otherwise(0)
    out = full.withColumn("copies", copies.cast("int"))
    first = ["doc_id", "source"] if narrow else mine
    return out.select(*[F.col(f"`{c}`") for c in first], F.col("_mix_size").alias("size"), "source_size", "target", "copies", (F.col("copies") * F.col("_mix_size")).cast("long").alias("taken"))


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each row as often as its copies say."""
    return mixed.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select(*[F.col(f"`{c}`") for c in columns])

"""Sharding by rendezvous hashing of record keys over weighted shards.

Every shard draws a number for every key; the shard with the best draw gets
the record.  A draw depends on the key and the shard's own name only, so a
new shard takes records into itself and moves none between the old ones.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipewatch.llm.common import gapless_rank, hash52, unit

#: Rows of one shard that a task numbers at once, about.
SLOT_ROWS = 65_536


def _draw(key: Column, shard: int, weight: float) -> Column:
    """Exponential draw with rate ``weight``: the smallest over the shards is
    shard i's with probability weight_i / sum of weights."""
    return F.struct((-F.log(unit(hash52(key, F.lit(shard)))) / F.lit(float(weight))).alias("draw"), F.lit(shard).alias("shard"))


def shard_of(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key.  Shards of weight 0 take nothing; at least one
    weight must be positive.  A null key is a key like any other."""
    draws = [_draw(key, s, w) for s, w in sorted(weights.items()) if w > 0]
    if not draws:
        raise ValueError("no shard with a positive weight")
    if any(w < 0 for w in weights.values()):
        raise ValueError("negative weight")
    return F.array_min(F.array(*draws)).getField("shard") if len(draws) > 1 else F.lit(draws and min(s for s, w in weights.items() if w > 0))


def assign(df: DataFrame, key: str, weights: Mapping[int, float], out: str = "shard") -> DataFrame:
    """Add the shard of each row.  Equal keys share a shard; every other
    column, also one named like an internal one, passes through.  An empty
    table stays empty.  No shuffle."""
    return df.withColumn(out, shard_of(F.col(f"`{key}`"), weights))


def slots(df: DataFrame, key: str, ties: list[str], shard: str = "shard", out: str = "slot", rows: int | None = None) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in a shuffled order
    that the key decides (``ties`` order rows of equal keys; rows that agree
    there too are alike).  Shards are cut into ranges of about ``SLOT_ROWS`` rows.

    Equal keys have equal positions and stay in one range, so a key should not
    repeat for more rows than a task can sort (row keys are near unique)."""
    rows = df.count() if rows is None else rows
    placed = df.withColumn("_slot_at", hash52(F.col(key), F.lit("slot")))
    ranked = gapless_rank(placed, [shard], "_slot_at", [key, *ties], max(256, -(-rows // SLOT_ROWS)), out)
    return ranked.drop("_slot_at")


def write_shards(df: DataFrame, key: str, weights: Mapping[int, float], path: str) -> None:
    """Write each shard to a folder ``shard=<i>`` under ``path``.  A large
    shard is written by many tasks."""
    assign(df, key, weights).write.partitionBy("shard").parquet(path)

"""Running maximum in arrival order without a single-task window.

``max(ts) over (partition by keys order by seq rows between unbounded
preceding and current row)`` plans an ``Exchange SinglePartition`` when
``keys`` is empty, and puts a whole key on one task when a key is hot.  The
bucketed prefix max below splits the ``seq`` axis into buckets of about
``rows_per_bucket`` rows:

1. ``bk`` = the bucket of a row, a plain deterministic column: by default
   ``floor(seq / width)`` (arrival sequences are dense, so a bucket holds
   at most ``width`` rows of a key and no planning pass is needed); or, for
   sequences that are not dense, quantile boundaries from one aggregate
   over ``seq`` looked up by binary search (``Bucketizer``);
2. ``bmax`` = ``max(ts)`` per ``(keys, bk)`` - at most ``#keys x
   #buckets`` rows;
3. ``carry`` = exclusive running max of ``bmax`` over the buckets of a key
   (window on the small table, partitioned by the keys);
4. a window partitioned by ``(keys, bk)`` and ordered by ``seq`` gives the
   running max inside the bucket; ``greatest`` with the joined ``carry``
   finishes the job.

The source is read once: the rows are shuffled once, on ``(keys, bk)``, and
steps 2 and 4 both read that exchange.  The carry is worked out in two
levels (runs of buckets, then buckets of a run), so a sequence with gaps,
whose buckets are as many as its rows, puts no key's buckets on one task.
The join in step 4 needs no shuffle of the large side (same partitioning
and order); nothing is broadcast unless AQE finds the carry table small at
run time.  Null keys form their own group as in SQL.  With fixed-width
buckets nothing is executed until the result is used.
Rows with a null ``seq`` have no place in arrival order and are dropped
(use :func:`split_null_seq` to keep them as rejects).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BUCKET_WIDTH = 1_000_000  # seq units (offsets) per bucket

RUN_BUCKETS = 4_096  # bucket numbers whose prefix one task works out

_BK = "__pw_bk"
_CARRY = "__pw_carry"
_LOCAL = "__pw_local"
_HOT = "__pw_hot"
MAX_BROADCAST_HOT_KEYS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20  # checked bound for broadcasting the hot-key list
_KEY = "__pw_key"


_GRID = 1024  # quantile probes taken in the planning pass
_ACCURACY = 10_000  # percentile_approx accuracy (relative error 1e-4)


def bucket_bounds(df: DataFrame, seq: str, buckets: int) -> list[float]:
    """Strictly increasing inner boundaries for ``buckets`` buckets of ``seq``
    (one ``approxQuantile`` action; empty when ``buckets <= 1``)."""
    if buckets <= 1:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    rel_err = 1.0 / (4.0 * buckets)
    bounds = df.where(F.col(seq).isNotNull()).approxQuantile(seq, probs, rel_err)
    return sorted({float(b) for b in bounds if b is not None})


def plan_bounds(df: DataFrame, seq: str, rows_per_bucket: int, buckets: int | None = None) -> list[float]:
    """Bucket boundaries for ``df``.

    With ``buckets`` given: that many (one ``approxQuantile`` action).
    Otherwise one aggregate pass returns the row count and a grid of 1023
    approximate quantiles; the count fixes ``ceil(rows / rows_per_bucket)``
    buckets whose bounds are read off the grid (a second pass only beyond
    1024 buckets)."""
    base = df.where(F.col(seq).isNotNull())
    if buckets is not None:
        return bucket_bounds(base, seq, buckets)
    grid = [i / _GRID for i in range(1, _GRID)]
    row = base.agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx(F.col(seq).cast("double"), grid, _ACCURACY).alias("q"),
    ).first()
    n_rows = int(row["n"] or 0)
    n = max(1, math.ceil(n_rows / max(1, rows_per_bucket)))
    if n <= 1:
        return []
    if n > _GRID:
        return bucket_bounds(base, seq, n)
    q = row["q"] or []
    picks = {q[round(i * _GRID / n) - 1] for i in range(1, n)}
    return sorted(float(b) for b in picks if b is not None)


def with_bucket(df: DataFrame, seq: str, bounds: list[float], out: str = _BK) -> DataFrame:
    """Adds ``out`` = index of the bucket of ``seq`` (0 .. len(bounds))."""
    if not bounds:
        return df.withColumn(out, F.lit(0))
    from pyspark.ml.feature import Bucketizer

    tmp = "__pw_seq_d"
    splits = [-math.inf, *bounds, math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    staged = df.withColumn(tmp, F.col(seq).cast("double"))
    return bucketizer.transform(staged).withColumn(out, F.col(out).cast("int")).drop(tmp)


def running_max(
    df: DataFrame,
    seq: str,
    value: str,
    keys: Sequence[str] = (),
    out: str = "max_ts",
    buckets: int | None = None,
    rows_per_bucket: int | None = None,
    bucket_width: int = DEFAULT_BUCKET_WIDTH,
    hot_keys_only: bool = False,
) -> DataFrame:
    """``df`` (rows with non-null ``seq``) plus ``out`` = running max of
    ``value`` over rows of the same ``keys`` with ``seq`` up to the current
    row, in ``seq`` order.

    Bucketing of the ``seq`` axis:

    * default - fixed width: ``bucket = floor(seq / bucket_width)``.  For an
      arrival sequence (offsets, identity ids: dense by construction) every
      bucket holds at most ``bucket_width`` rows of a key, the bucket count
      grows with the data, and no action runs here (the plan stays lazy);
    * ``buckets=N`` - N quantile buckets (one ``approxQuantile`` action);
    * ``rows_per_bucket=R`` - quantile buckets of about R rows, planned in one
      aggregate pass (:func:`plan_bounds`), for sequences that are not dense.

    ``hot_keys_only`` (fixed width, with keys): only keys holding more than
    ``bucket_width`` rows are split into buckets.  Otherwise a small key
    spread over a long log gets a bucket per offset range it touches and the
    bucket table grows to the size of the data.  One narrow partial
    aggregate counts rows per key.  The hot keys (at most
    ``rows / bucket_width`` of them) are checkpointed to the shared
    checkpoint folder and counted, then broadcast when within
    ``MAX_BROADCAST_HOT_KEYS``; beyond that every key is bucketed.  With no
    hot key this is a plain per-key window.
    """
    keys = list(keys)
    base = df.where(F.col(seq).isNotNull())
    if buckets is not None or rows_per_bucket is not None:
        bounds = plan_bounds(base, seq, rows_per_bucket or 1, buckets)
        data = with_bucket(base, seq, bounds)
        if not bounds:
            return _single_bucket(data, seq, value, keys, out)
    elif hot_keys_only and keys:
        data = _hot_bucketed(base, seq, keys, int(bucket_width))
        if data is None:
            return _single_bucket(base.withColumn(_BK, F.lit(0)), seq, value, [F.struct(*keys)], out)
    else:
        data = base.withColumn(_BK, F.floor(F.col(seq) / F.lit(int(bucket_width))))
    return _bucketed(df, data, seq, value, keys, out)


def _hot_bucketed(base: DataFrame, seq: str, keys: list[str], width: int) -> DataFrame | None:
    """``base`` with the bucket column: ``floor(seq / width)`` for hot keys,
    0 for the rest; None when no key is hot."""
    from pipewatch.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(base.sparkSession)
    kstruct = F.struct(*keys)
    counts = base.groupBy(kstruct.alias(_KEY)).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.where(F.col("__n") > width).select(_KEY, F.lit(True).alias(_HOT)).checkpoint(eager=True)
    # reads the checkpointed rows only
    n_hot, size = hot.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(F.to_json(_KEY))), F.lit(0))).first()
    if n_hot == 0:
        return None
    if n_hot > MAX_BROADCAST_HOT_KEYS or size > MAX_BROADCAST_BYTES:
        return base.withColumn(_BK, F.floor(F.col(seq) / F.lit(width)))
    tagged = base.withColumn(_KEY, kstruct).join(F.broadcast(hot), _KEY, "left").drop(_KEY)
    bucket = F.when(F.col(_HOT), F.floor(F.col(seq) / F.lit(width))).otherwise(F.lit(0).cast("bigint"))
    return tagged.withColumn(_BK, bucket).drop(_HOT)


def _single_bucket(data: DataFrame, seq: str, value: str, keys: list, out: str) -> DataFrame:
    w = Window.partitionBy(*keys, _BK).orderBy(F.col(seq)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return data.withColumn(out, F.max(value).over(w)).drop(_BK)


def _bucketed(df: DataFrame, data: DataFrame, seq: str, value: str, keys: list[str], out: str) -> DataFrame:
    # The key columns travel as one struct: struct equality treats null
    # fields as equal, so null keys group (and join) together as in SQL.
    kcols = [F.struct(*keys).alias(_KEY)] if keys else []
    part = [_KEY, _BK] if keys else [_BK]
    rest = [c for c in data.columns if c not in keys and c != _BK]
    # 1. the one shuffle of the data, on (keys, bucket).  Both steps below read
    #    it: the source is scanned and parsed once.  Key columns travel in the
    #    struct only, so that both branches ask for the same columns.
    kdata = data.select(*kcols, _BK, *rest).repartition(*part)
    # 2. per (keys, bucket) max of what a task has received.  The struct names
    #    every column, so this branch asks for the same exchange as the window
    #    and Spark reuses it instead of reading the source a second time.
    whole = F.max(F.struct(value, *[c for c in rest if c != value and _ordered(kdata.schema[c].dataType)]))
    bmax = kdata.groupBy(*part).agg(whole.alias("__pw_m")).select(*part, F.col("__pw_m").getField(value).alias(_CARRY))
    carry = _exclusive_max(bmax, part[:-1])
    # 3. running max inside the bucket, then the carry of earlier buckets joined
    #    on the same columns: the data side already has that partitioning and
    #    order, so only the small carry side moves (or is broadcast when AQE
    #    finds it small at run time).
    w = Window.partitionBy(*part).orderBy(F.col(seq)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = kdata.withColumn(_LOCAL, F.max(value).over(w))
    joined = local.join(carry, part, "left")
    back = [F.col(_KEY).getField(c).alias(c) if c in keys else F.col(c) for c in df.columns]
    return joined.select(*back, F.greatest(F.col(_LOCAL), F.col(_CARRY)).alias(out))


def _ordered(t: T.DataType) -> bool:
    """Whether values of a type can be compared (a map's cannot)."""
    if isinstance(t, T.StructType):
        return all(_ordered(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _ordered(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType))


def _exclusive_max(bmax: DataFrame, keys: list[str]) -> DataFrame:
    """The max of all earlier buckets of the same keys, in two levels: runs of
    ``RUN_BUCKETS`` bucket numbers each get their prefix inside the run, and the
    runs (one row each) get theirs among runs.  A sequence with gaps may give
    nearly every row a bucket of its own; a task then still holds one run, or
    one row a run, never all buckets of a key."""
    run = "__pw_run"
    runs = bmax.withColumn(run, F.floor(F.col(_BK) / F.lit(RUN_BUCKETS)))
    top = runs.groupBy(*keys, run).agg(F.max(_CARRY).alias("__pw_top"))
    among = Window.partitionBy(*keys).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    top = top.select(*keys, run, F.max("__pw_top").over(among).alias("__pw_before"))
    inside = Window.partitionBy(*keys, run).orderBy(_BK).rowsBetween(Window.unboundedPreceding, -1)
    held = runs.select(*keys, run, _BK, F.max(_CARRY).over(inside).alias(_CARRY))
    both = held.join(top, [*keys, run], "left").select(*keys, _BK, F.greatest(_CARRY, "__pw_before").alias(_CARRY))
    return both.where(F.col(_CARRY).isNotNull())


def lateness(
    df: DataFrame,
    seq: str,
    ts: str,
    keys: Sequence[str] = (),
    buckets: int | None = None,
    rows_per_bucket: int | None = None,
    bucket_width: int = DEFAULT_BUCKET_WIDTH,
    hot_keys_only: bool = False,
) -> DataFrame:
    """``df`` plus ``max_ts`` (running max of ``ts``) and ``diff_ts`` =
    ``max_ts - ts``: how far each row arrives behind the latest time seen
    before it."""
    ran = running_max(df, seq, ts, keys, "max_ts", buckets, rows_per_bucket, bucket_width, hot_keys_only)
    return ran.withColumn("diff_ts", F.col("max_ts") - F.col(ts))


def split_null_seq(df: DataFrame, seq: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a seq, rows without one)."""
    return df.where(F.col(seq).isNotNull()), df.where(F.col(seq).isNull())

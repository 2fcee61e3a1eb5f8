"""Per-key lateness on a stream, with the running maximum held as
state; S3 stream form: a watermark at the measured bound.

State is one ``bigint`` (the max event time seen) per key, many keys to a
bucket (``key_buckets``), in Spark's state store, checkpointed with the query.
Inside a micro-batch the rows of a key
are sorted by ``seq`` before the running max is taken, so the late rows of
a replay equal the batch per-key disorder (T6).  Rows of a key that arrive
in a later micro-batch with a smaller ``seq`` are exactly the disorder
being measured.  In :func:`late_rows_stream` one worker sorts the rows of a
bucket, so a hot key must be bounded per batch by the trigger size
(``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``);
:func:`run_late_rows_batched` splits it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from pipewatch.plans.scan import DEFAULT_BUCKET_WIDTH, running_max
from pipewatch.streaming.key_buckets import LAST, Tops, bucket, key_columns, key_name

#: Of a bucket of keys, in parallel: names, largest event times, when last seen.
STATE_SCHEMA = "names array<string>, tops array<bigint>, seen array<bigint>"


def _late_rows(idle_ms: int | None = None):
    import pandas as pd

    def fn(key, pdfs, state):
        if state.hasTimedOut:  # idle keys: forget their running max
            state.remove()
            return
        frames = list(pdfs)
        frame = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        if frame.empty:
            return
        now = 0 if idle_ms is None else state.getCurrentProcessingTimeMs()
        tops = Tops(state.get if state.exists else None, now, idle_ms)
        at = tops.numbers(frame["name"])
        late = tops.late(at, frame["seq"].to_numpy(dtype="int64"), frame["ts"].to_numpy(dtype="float64"))
        state.update(tops.stored())
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        if len(late):
            yield late

    return fn


def late_rows_stream(
    events: DataFrame,
    seq: str = "offset",
    ts: str = "ts",
    keys: Sequence[str] = ("partition", "key"),
    idle_timeout_ms: int | None = None,
) -> DataFrame:
    """Streaming late rows per key: the key columns, ``diff_ts`` and ``id``
    (= seq) for every row behind the running max of its key (across
    batches).

    State is one bigint per key; a null ``seq`` comes last.  With ``idle_timeout_ms`` the state of a
    key that sees no rows for that long (processing time) is removed, which
    bounds the state of a stream whose key space keeps growing; lateness of
    a key that returns after that is measured afresh.  Timeouts need a
    continuously running query (processing-time trigger): Spark keeps
    scheduling empty batches to fire pending timeouts, so an ``availableNow``
    replay would not end."""
    keys = list(keys)
    kinds = [events.schema[k].dataType for k in keys]
    narrow = events.select(
        key_name([F.col(f"`{k}`") for k in keys], kinds).alias("name"),
        F.coalesce(F.col(f"`{seq}`").cast("bigint"), F.lit(LAST)).alias("seq"),
        F.col(f"`{ts}`").cast("double").alias("ts"),
    )
    timeout = GroupStateTimeout.NoTimeout if idle_timeout_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    found = narrow.withColumn("bucket", bucket(F.col("name"))).groupBy("bucket").applyInPandasWithState(
        _late_rows(idle_timeout_ms), "name string, diff_ts bigint, id bigint", STATE_SCHEMA, "append", timeout
    )
    return found.select(*[c.alias(k) for c, k in zip(key_columns(F.col("name"), kinds), keys)], "diff_ts", "id")


def run_late_rows_batched(
    events: DataFrame,
    path: str,
    state: str,
    checkpoint: str,
    seq: str = "offset",
    ts: str = "ts",
    keys: Sequence[str] = ("partition", "key"),
    bucket_width: int = DEFAULT_BUCKET_WIDTH,
) -> None:
    """The late rows of :func:`late_rows_stream` (columns and values) by
    micro-batches in the JVM, run with ``availableNow``; read them with
    :func:`read_batches`.

    A key that fills a whole batch is no problem here: the batch's running max
    is the bucketed one of T6, which splits hot keys.  The largest event time
    of every key so far is a table in ``state``, one version per batch; a
    batch replayed after a failure reads the version before its own and
    replaces its own output and version."""
    spark = events.sparkSession
    keys = list(keys)
    fields = T.StructType([events.schema[k] for k in keys] + [T.StructField("__top", T.LongType())])

    def before(batch_id: int) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], fields)
        return spark.read.schema(fields).parquet(f"{state}/batch_id={batch_id - 1}")

    def same(prior: DataFrame, rows: DataFrame):
        cond = F.lit(True)
        for k in keys:
            cond = cond & rows[k].eqNullSafe(prior[k])
        return cond

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        prior = before(batch_id)
        ran = running_max(batch, seq, ts, keys, "__run", bucket_width=bucket_width, hot_keys_only=True)
        met = ran.join(prior, same(prior, ran), "left").select(
            *[ran[k] for k in keys], (F.greatest("__run", "__top") - F.col(ts)).alias("diff_ts"), F.col(seq).alias("id")
        )
        met.where("diff_ts > 0").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        tops = batch.groupBy(*keys).agg(F.max(ts).alias("__top")).unionByName(prior).groupBy(*keys).agg(F.max("__top").alias("__top"))
        tops.write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")
        batch.unpersist()

    q = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The output of all batches written to ``batch_id=<n>`` folders."""
    return spark.read.parquet(path).drop("batch_id")


def with_lateness_watermark(events: DataFrame, event_time: str, bound_seconds: int) -> DataFrame:
    """Watermark at the measured disorder bound (T5/S3): with a delay equal
    to the bound no row is dropped as late."""
    return events.withWatermark(event_time, f"{int(bound_seconds)} seconds")


def windowed_counts_with_watermark(events: DataFrame, event_time: str, delay_seconds: int, window: str = "1 hour") -> DataFrame:
    """S3 stream form: event-time windowed counts under a watermark of
    ``delay_seconds``.  Rows older than the watermark are dropped by Spark,
    so with the delay at the measured bound (T5) nothing is dropped and the
    counts equal the batch counts."""
    return (
        with_lateness_watermark(events, event_time, delay_seconds)
        .groupBy(F.window(event_time, window).alias("w"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def run_update_to_parquet(stream_df: DataFrame, path: str, checkpoint: str) -> None:
    """Run an aggregating stream with ``availableNow`` in update mode; each
    micro-batch writes its updated rows, tagged with the batch id, to its own
    ``batch_id=<n>`` folder in overwrite mode, so a batch replayed after a
    failure replaces its earlier attempt instead of duplicating it.  Read the
    final value of a group as the row of its highest batch id
    (:func:`latest_updates`)."""
    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    q = (
        stream_df.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def latest_updates(updates: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Final value per group from update-mode output: the row of the
    highest batch id (``max_by``, a partial aggregate)."""
    return updates.groupBy(*keys).agg(F.max_by(F.col(value), F.col("batch_id")).alias(value))

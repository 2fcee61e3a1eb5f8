"""Registered streaming audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from pipewatch.functions.times import format_ntz
from pipewatch.operators.topics import disorder_bound, extract_events
from pipewatch.plans.topic_audits import _broker_events
from pipewatch.plans import fixtures_sql as fx
from pipewatch.plans.registry import register
from pipewatch.plans.topic_audits import _disorder_sql
from pipewatch.session import work_dir
from pipewatch.sources import derived
from pipewatch.streaming import ledger
from pipewatch.streaming.lag import load_lag
from pipewatch.streaming.landing import land_available
from pipewatch.streaming.lateness import (
    late_rows_stream,
    latest_updates,
    read_batches,
    run_late_rows_batched,
    run_update_to_parquet,
    windowed_counts_with_watermark,
)
from pipewatch.streaming.lateness_state import run_late_rows, stored_tops
from pipewatch.streaming.sources import table_stream


REPLAY_PARTS = 4


def _write_part(log, folder: str, i: int) -> None:
    """Append the i-th quarter of the log, by offset, to a folder that a
    stream reads: a later write is a later batch."""
    hi = log.agg(F.max("offset")).first()[0] or 0
    step = hi // REPLAY_PARTS + 1
    part = log.where((F.col("offset") >= i * step) & (F.col("offset") < (i + 1) * step))
    part.write.mode("append").parquet(folder)


@register("s1_landing_stream", f"""SELECT "partition", "offset", "key", ts FROM ({fx.EVENTS_EXTRACTED})""")
def s1_landing_stream(spark, sf_dir):
    log = derived.events_as_log(table_stream(spark, sf_dir, "events"))
    path, ckpt = work_dir(spark, "landing", "data"), work_dir(spark, "landing", "checkpoint")
    land_available(log, path, ckpt)
    return spark.read.parquet(path)


@register(
    "s1_landing_resumed",
    f"""SELECT "partition", "offset", 'landed' AS outcome FROM ({fx.EVENTS_EXTRACTED})
        UNION ALL SELECT 0, event_id, 'event time missing or unparsable' FROM events WHERE event_id % 97 = 0""",
)
def s1_landing_resumed(spark, sf_dir):
    """Stopped and started again on its checkpoint as each quarter arrives;
    accepted and rejected messages, each once."""
    log = derived.events_log(spark, sf_dir)
    src, path, ckpt, bad = (work_dir(spark, "resumed", n) for n in ("src", "data", "checkpoint", "rejects"))
    for i in range(REPLAY_PARTS):
        _write_part(log, src, i)
        land_available(spark.readStream.schema(log.schema).parquet(src), path, ckpt, rejects_path=bad)
    good = spark.read.parquet(path).select("partition", "offset", F.lit("landed").alias("outcome"))
    return good.unionByName(spark.read.parquet(bad).select("partition", "offset", F.col("reason").alias("outcome")))


def _outcomes(spark, path):
    good = ledger.landed(spark, path).select("partition", "offset", F.lit("landed").alias("outcome"))
    return good.unionByName(ledger.rejected(spark, path).select("partition", "offset", F.col("reason").alias("outcome")))


@register(
    "s1_landing_ledger",
    f"""SELECT "partition", "offset", 'landed' AS outcome FROM ({fx.EVENTS_EXTRACTED})
        UNION ALL SELECT 0, event_id, 'event time missing or unparsable' FROM events WHERE event_id % 97 = 0""",
)
def s1_landing_ledger(spark, sf_dir):
    """One pass with a ledger; the checkpoint is lost after half of the log,
    and the ledger alone keeps what had landed from landing again."""
    log = derived.events_log(spark, sf_dir)
    src, path = (work_dir(spark, "ledger", n) for n in ("src", "data"))
    for half in range(2):
        ckpt = work_dir(spark, "ledger", "checkpoint")
        for i in range(half * 2, half * 2 + 2):
            _write_part(log, src, i)
            ledger.land_available(spark.readStream.schema(log.schema).parquet(src), path, ckpt)
    return _outcomes(spark, path)


_STEP = f"""((SELECT max("offset") FROM ({fx.EVENTS_LOG})) // {REPLAY_PARTS} + 1)"""


@register(
    "s1_landing_reset_to_end",
    f"""SELECT * FROM (SELECT "partition", "offset", 'landed' AS outcome FROM ({fx.EVENTS_EXTRACTED})
            UNION ALL SELECT 0, event_id, 'event time missing or unparsable' FROM events WHERE event_id % 97 = 0)
        WHERE "offset" // {_STEP} <> 2""",
)
def s1_landing_reset_to_end(spark, sf_dir):
    """Reset to the end of the log after its third quarter has arrived, which
    has not landed by then: the fourth goes on behind it."""
    log = derived.events_log(spark, sf_dir)
    src, path, ckpt = (work_dir(spark, "ledger_reset", n) for n in ("src", "data", "checkpoint"))
    for i in range(REPLAY_PARTS):
        _write_part(log, src, i)
        if i == 2:
            ledger.reset_to_end(spark.read.schema(log.schema).parquet(src), path)
        else:
            ledger.land_available(spark.readStream.schema(log.schema).parquet(src), path, ckpt)
    return _outcomes(spark, path)


@register("s2_late_rows_stream", _disorder_sql(fx.ORDERS_EXTRACTED, "key", topn=None))
def s2_late_rows_stream(spark, sf_dir):
    events = extract_events(derived.orders_as_log(table_stream(spark, sf_dir, "orders")))
    late = late_rows_stream(events)
    path, ckpt = work_dir(spark, "late", "data"), work_dir(spark, "late", "checkpoint")
    q = late.writeStream.format("parquet").option("path", path).option("checkpointLocation", ckpt).trigger(
        availableNow=True
    ).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(late.schema).parquet(path)


@register("s2_late_rows_resumed", _disorder_sql(fx.ORDERS_EXTRACTED, "key", topn=None))
def s2_late_rows_resumed(spark, sf_dir):
    """State carried over batches and restarts: a run for each quarter."""
    log = derived.orders_log(spark, sf_dir)
    src, path, ckpt = (work_dir(spark, "late_resumed", n) for n in ("src", "data", "checkpoint"))
    for i in range(REPLAY_PARTS):
        _write_part(log, src, i)
        late = late_rows_stream(extract_events(spark.readStream.schema(log.schema).parquet(src)))
        q = late.writeStream.format("parquet").option("path", path).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return spark.read.schema(late.schema).parquet(path)


@register("s2_late_rows_batched", _disorder_sql(fx.ORDERS_EXTRACTED, "key", topn=None))
def s2_late_rows_batched(spark, sf_dir):
    """Quarters of the log, each a batch of its own; keys of more than 50 rows split."""
    log = derived.orders_log(spark, sf_dir)
    src, path, state, ckpt = (work_dir(spark, "late_batched", n) for n in ("src", "data", "state", "checkpoint"))
    for i in range(REPLAY_PARTS):
        _write_part(log, src, i)
        run_late_rows_batched(extract_events(spark.readStream.schema(log.schema).parquet(src)), path, state, ckpt, bucket_width=50)
    return read_batches(spark, path)


def _replayed_by_processor(spark, sf_dir):
    """Late rows and checkpoint of the orders topic, stopped and started again
    for each quarter; a key's rows beyond one Arrow batch are sorted by ranges."""
    log = derived.orders_log(spark, sf_dir)
    src, path, ckpt = (work_dir(spark, "late_processor", n) for n in ("src", "data", "checkpoint"))
    for i in range(REPLAY_PARTS):
        _write_part(log, src, i)
        late = run_late_rows(extract_events(spark.readStream.schema(log.schema).parquet(src)), path, ckpt)
    return late, ckpt


@register("s2_late_rows_processor", _disorder_sql(fx.ORDERS_EXTRACTED, "key", topn=None))
def s2_late_rows_processor(spark, sf_dir):
    return _replayed_by_processor(spark, sf_dir)[0]


@register("s2_stored_tops", f"""SELECT "partition", "key", max(ts) AS max_ts FROM ({fx.ORDERS_EXTRACTED}) GROUP BY 1, 2""")
def s2_stored_tops(spark, sf_dir):
    """What the state store holds of each key after the last restart."""
    return stored_tops(spark, _replayed_by_processor(spark, sf_dir)[1])


@register(
    "s4_load_lag",
    f"""SELECT db, name, state,
               CAST(coalesce(list_sum(CAST(map_values(json_transform(lag, '"MAP(VARCHAR, VARCHAR)"')) AS BIGINT[])), 0)
                    AS BIGINT) AS lag
        FROM (
            SELECT 'db' || CAST(s_nationkey % 4 AS VARCHAR) AS db, 'job_' || CAST(s_suppkey AS VARCHAR) AS name,
                   CASE s_suppkey % 4 WHEN 0 THEN 'STOPPED' WHEN 1 THEN 'PAUSED' ELSE 'RUNNING' END AS state,
                   CASE WHEN s_suppkey % 10 = 7 THEN '{{}}'
                        ELSE '{{"0":"' || CAST(s_suppkey % 50 AS VARCHAR) || '","1":"' || CAST(s_nationkey AS VARCHAR) || '"}}'
                   END AS lag
            FROM supplier)
        WHERE state <> 'STOPPED' ORDER BY db, name""",
)
def s4_load_lag(spark, sf_dir):
    return load_lag(derived.load_jobs(spark, sf_dir))


def _broker_view(events):
    """Event time = broker time (mild disorder), as epoch seconds and as a
    timestamp for the watermark."""
    return extract_events(
        events.withColumn(
            "value",
            F.to_json(F.struct(
                F.get_json_object("value", "$.id").alias("id"),
                format_ntz("timestamp", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
            )),
        )
    )


@register(
    "s3_watermark_at_bound_stream",
    f"""SELECT CAST(epoch(date_trunc('hour', date_trunc('second', "timestamp"))) AS BIGINT) AS window_start,
               count(*) AS "rows"
        FROM ({fx.EVENTS_LOG}) GROUP BY 1""",
)
def s3_watermark_at_bound_stream(spark, sf_dir):
    # the bound (T5 over the whole log, in arrival order)
    bound = disorder_bound(_broker_events(spark, sf_dir), topn=1).first()
    return _watermarked(spark, sf_dir, int(bound["diff_ts"]) if bound else 0, "1 hour")


def _watermarked(spark, sf_dir, delay: int, window: str):
    """Windowed counts of the log replayed in offset order, a run for each
    quarter on one checkpoint: the watermark of a quarter is set by those
    before it."""
    log = derived.events_log(spark, sf_dir)
    src, out, ckpt = (work_dir(spark, "wm", n) for n in ("src", "out", "ckpt"))
    for i in range(REPLAY_PARTS):
        _write_part(log, src, i)
        events = _broker_view(spark.readStream.schema(log.schema).parquet(src)).withColumn("event_ts", F.timestamp_seconds("ts"))
        counts = windowed_counts_with_watermark(events, "event_ts", delay, window)
        run_update_to_parquet(counts.select(F.unix_seconds(F.col("w.start")).alias("window_start"), "rows"), out, ckpt)
    return latest_updates(spark.read.parquet(out), ["window_start"], "rows")


# Windows of one second: a row is late by itself, not with its whole hour.
@register(
    "s3_watermark_at_bound_seconds",
    f"""SELECT CAST(epoch(date_trunc('second', "timestamp")) AS BIGINT) AS window_start, count(*) AS "rows"
        FROM ({fx.EVENTS_LOG}) GROUP BY 1""",
)
def s3_watermark_at_bound_seconds(spark, sf_dir):
    bound = disorder_bound(_broker_events(spark, sf_dir), topn=1).first()
    return _watermarked(spark, sf_dir, int(bound["diff_ts"]) if bound else 0, "1 second")


# Far below the bound, the rows of a quarter that lie before the last quarters' watermark are dropped.
_BELOW = 60


@register(
    "s3_watermark_below_bound",
    f"""WITH l AS (SELECT "offset", CAST(epoch(date_trunc('second', "timestamp")) AS BIGINT) AS s,
                          "offset" // ((SELECT max("offset") FROM ({fx.EVENTS_LOG})) // 4 + 1) AS part FROM ({fx.EVENTS_LOG})),
        w AS (SELECT p.part, (SELECT max(s) FROM l WHERE l.part < p.part) - {_BELOW} AS mark FROM (SELECT DISTINCT part FROM l) p)
        SELECT s AS window_start, count(*) AS "rows" FROM l JOIN w USING (part)
        WHERE mark IS NULL OR s + 1 > mark GROUP BY 1""",
)
def s3_watermark_below_bound(spark, sf_dir):
    return _watermarked(spark, sf_dir, _BELOW, "1 second")

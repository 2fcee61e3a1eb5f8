"""Topic order audit: slice a message log, extract key and event time,
land it, and measure how far out of order it is.

A *message log* is a DataFrame ``partition int, offset bigint, timestamp
timestamp[_ntz], value string`` (what the Kafka source gives, with the value
cast to string).  A *landed topic* is ``partition, offset, key string, ts
bigint`` (epoch seconds).  Offsets order the rows of one partition; the
disorder operators run per partition unless the caller names a global
sequence column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipewatch.functions.maps import json_map
from pipewatch.functions.names import table_name_of  # noqa: F401  (re-exported: T11)
from pipewatch.functions.times import epoch_seconds, ts_literal
from pipewatch.plans.scan import DEFAULT_BUCKET_WIDTH, lateness

# Defaults of a topic audit.
DEFAULT_KEY_FIELD = "id"
DEFAULT_TIME_FIELD = "event_time"
DEFAULT_FALLBACK_FIELD = "modify_time"
DEFAULT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DEFAULT_TOPN = 5
INTERNAL_TOPIC_PREFIXES = ("__", "--")
# Topic partitions up to which slice bounds become a literal scan filter.
MAX_STATIC_PARTITIONS = 256


# --------------------------------------------------------------------- T1, T2
def slice_log(
    log: DataFrame,
    start,
    end=None,
    partition: str = "partition",
    offset: str = "offset",
    ts: str = "timestamp",
    static_bounds: bool = True,
) -> DataFrame:
    """Time-bounded slice of a message log, per partition.

    The slice starts at the earliest offset whose broker time is ``>= start``
    and runs up to and including the first row (at or after that start) whose
    broker time is ``>= end``.  Late broker times inside the slice stay; a
    partition with no row at or after ``start`` contributes nothing; with no
    row reaching ``end`` (or ``end`` None) the slice runs to the last row.

    One aggregation per partition, over rows at or after ``start`` only
    (pushed to the scan), gives both bounds: any row with time ``>= end >=
    start`` lies at or after the start offset, so the first such row needs
    no second pass; ``greatest`` covers ``end < start`` (the start row
    itself then ends the slice).  The bounds table has one row per topic
    partition - bounded by the topic's partition count.  With
    ``static_bounds`` (one small action) it is collected and becomes a
    literal ``partition = p AND offset BETWEEN lo AND hi`` filter that the
    Parquet scan uses to skip row groups, so a recent slice of a long topic
    reads only its own row groups; otherwise (or beyond
    ``MAX_STATIC_PARTITIONS``) it is joined to the log.
    """
    ttype = log.schema[ts].dataType
    t = F.col(ts)
    # Rows before ``start`` cannot move either bound (an ``end`` row found
    # before the start offset is replaced by the start row via greatest), so
    # the bounds pass filters on time first - a predicate Parquet can use to
    # skip row groups of a long, roughly time-ordered log.
    recent = log.where(t >= ts_literal(start, ttype))
    hi_expr = (
        F.lit(None).cast("bigint") if end is None else F.min(F.when(t >= ts_literal(end, ttype), F.col(offset)))
    )
    bounds = (
        recent.groupBy(partition)
        .agg(F.min(offset).alias("__lo"), hi_expr.alias("__hi"))
        .withColumn("__hi", F.when(F.col("__hi").isNotNull(), F.greatest("__lo", "__hi")))
    )
    if static_bounds:
        narrowed = _offset_ranges(log, bounds, partition, offset)
        if narrowed is not None:
            return narrowed
    bounds = bounds.withColumnRenamed(partition, "__p")
    joined = log.join(bounds, F.col(partition).eqNullSafe(F.col("__p")))
    keep = (F.col(offset) >= F.col("__lo")) & (F.col("__hi").isNull() | (F.col(offset) <= F.col("__hi")))
    return joined.where(keep).drop("__lo", "__hi", "__p")


def _offset_ranges(log: DataFrame, ranges: DataFrame, partition: str, offset: str) -> DataFrame | None:
    """``log`` restricted to per-partition offset ranges (``ranges``: one
    row per topic partition with ``__lo`` and a nullable ``__hi``) through a
    literal filter the Parquet scan can use to skip row groups.  Collects the
    ranges (bounded by the partition count); returns None beyond
    ``MAX_STATIC_PARTITIONS`` so the caller can join instead."""
    rows = ranges.select(partition, "__lo", "__hi").limit(MAX_STATIC_PARTITIONS + 1).collect()
    if len(rows) > MAX_STATIC_PARTITIONS:
        return None
    cond = F.lit(False)
    for r in rows:
        term = F.col(partition).eqNullSafe(F.lit(r[partition])) & (F.col(offset) >= F.lit(r["__lo"]))
        if r["__hi"] is not None:
            term = term & (F.col(offset) <= F.lit(r["__hi"]))
        cond = cond | term
    return log.where(cond)


def slice_last_day(log: DataFrame, now, **names) -> DataFrame:
    """T1 over ``[now - 24h, now]``, ``now`` cut to whole seconds."""
    if isinstance(now, dt.datetime):
        now = now.replace(microsecond=0)
        return slice_log(log, now - dt.timedelta(hours=24), now, **names)
    raise TypeError("now must be a datetime")


# ------------------------------------------------------------------------- T3
def _fields(value: str, key_field: str, time_field: str, fallback: str | None) -> tuple[F.Column, list[str]]:
    """One ``json_tuple`` generator pulling the key and time fields in a
    single streaming parse (a generator, so later filters cannot be inlined
    into it and re-parse the text)."""
    names = [key_field, time_field] + ([fallback] if fallback and fallback not in (key_field, time_field) else [])
    outs = ["__k", "__t"] + (["__f"] if len(names) == 3 else [])
    return F.json_tuple(F.col(value), *names).alias(*outs), outs


def _reject_reason(value: str):
    return (
        F.when(json_map(value).isNull(), F.lit("value is not a JSON object"))
        .when(F.col("key").isNull(), F.lit("key missing"))
        .otherwise(F.lit("event time missing or unparsable"))
    )


def split_events(
    log: DataFrame,
    key_field: str = DEFAULT_KEY_FIELD,
    time_field: str = DEFAULT_TIME_FIELD,
    fallback: str | None = DEFAULT_FALLBACK_FIELD,
    fmt: str = DEFAULT_TIME_FORMAT,
    tz: str = "UTC",
    value: str = "value",
    keep: Sequence[str] = ("partition", "offset"),
) -> tuple[DataFrame, DataFrame]:
    """(events, rejects).

    events: ``keep`` columns + ``key string`` + ``ts bigint`` (whole epoch
    seconds of the event time read in zone ``tz``).  The time field falls
    back to ``fallback`` when absent *or* null.  Rows whose value is not a
    JSON object, or whose key or time is missing or unparsable, go to
    rejects with a ``reason`` column (worked out on the reject rows only).
    """
    gen, outs = _fields(value, key_field, time_field, fallback)
    t = F.coalesce(*[F.col(c) for c in outs[1:]])
    staged = log.select(*keep, value, gen).select(
        *keep, value, F.col("__k").alias("key"), epoch_seconds(t, fmt, tz).alias("ts")
    )
    good = staged.where(F.col("key").isNotNull() & F.col("ts").isNotNull()).select(*keep, "key", "ts")
    bad = staged.where(F.col("key").isNull() | F.col("ts").isNull())
    return good, bad.select(*keep, value, _reject_reason(value).alias("reason"))


def marked_events(
    log: DataFrame,
    key_field: str = DEFAULT_KEY_FIELD,
    time_field: str = DEFAULT_TIME_FIELD,
    fallback: str | None = DEFAULT_FALLBACK_FIELD,
    fmt: str = DEFAULT_TIME_FORMAT,
    tz: str = "UTC",
    value: str = "value",
    keep: Sequence[str] = ("partition", "offset"),
) -> DataFrame:
    """Both halves of :func:`split_events` in one pass: ``keep``, ``key``,
    ``ts``, ``value`` and ``reason``; an event has neither value nor reason, a
    reject neither key nor ts."""
    gen, outs = _fields(value, key_field, time_field, fallback)
    t = F.coalesce(*[F.col(c) for c in outs[1:]])
    staged = log.select(*keep, F.col(value).alias("value"), gen).select(
        *keep, "value", F.col("__k").alias("key"), epoch_seconds(t, fmt, tz).alias("ts")
    )
    bad = F.col("key").isNull() | F.col("ts").isNull()
    reason = F.when(bad, _reject_reason("value"))
    return staged.select(
        *keep, F.when(~bad, F.col("key")).alias("key"), F.when(~bad, F.col("ts")).alias("ts"),
        F.when(bad, F.col("value")).alias("value"), reason.alias("reason"),
    )


def extract_events(log: DataFrame, **kw) -> DataFrame:
    """The good half of :func:`split_events`."""
    return split_events(log, **kw)[0]


# ------------------------------------------------------------------------- T4
def land(log: DataFrame, target: str, start, end=None, mode: str = "overwrite", rejects: str | None = None, **extract) -> DataFrame:
    """Slice (T1), extract (T3) and write ``partition, offset, key, ts`` to
    ``target`` - a catalogue table name (``saveAsTable``) or a folder path
    (Parquet) - replacing what was there.  Rows that could not be extracted
    are written next to it, to ``rejects`` (default ``<target>_rejects``).

    Returns a report read back from both copies: one row per partition of
    the log with ``has_data`` (the slice holds messages), ``start_offset``
    (first offset of the slice, accepted or not; null without data),
    ``rows`` landed and ``rejected``.  Actions: the two writes (and the
    report, when collected)."""
    sliced = slice_log(log, start, end)
    events, bad = split_events(sliced, **extract)
    landed = _written(events, target, mode).select("partition", "offset", F.lit(1).alias("good"))
    left = _written(bad, rejects or f"{target}_rejects", mode).select("partition", "offset", F.lit(0).alias("good"))
    known = log.select("partition").distinct().select("partition", F.lit(None).cast("bigint").alias("offset"), F.lit(None).cast("int").alias("good"))
    return landed.unionByName(left).unionByName(known).groupBy("partition").agg(
        (F.count("good") > 0).alias("has_data"),
        F.min("offset").alias("start_offset"),
        F.count_if(F.col("good") == 1).alias("rows"),
        F.count_if(F.col("good") == 0).alias("rejected"),
    )


def _written(df: DataFrame, target: str, mode: str) -> DataFrame:
    if _is_path(target):
        df.write.mode(mode).parquet(target)
        return df.sparkSession.read.schema(df.schema).parquet(target)
    df.write.mode(mode).saveAsTable(target)
    return df.sparkSession.table(target)


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


# --------------------------------------------------------------------- T5, T6
def _present(events: DataFrame, per: Sequence[str]) -> list[str]:
    missing = [c for c in per if c not in events.columns]
    if missing:
        raise ValueError(f"no column {missing} in the events; pass per=() if the sequence is global")
    return list(per)


def disorder_bound(
    events: DataFrame,
    seq: str = "offset",
    ts: str = "ts",
    key: str | Sequence[str] | None = None,
    topn: int | None = DEFAULT_TOPN,
    per: Sequence[str] = ("partition",),
    buckets: int | None = None,
    rows_per_bucket: int | None = None,
    bucket_width: int = DEFAULT_BUCKET_WIDTH,
) -> DataFrame:
    """How far behind the running maximum event time rows arrive.

    Global (``key`` None): running max over arrival order ``seq`` within each
    of ``per`` (topic partitions; pass ``per=()`` when ``seq`` is global).
    Per key: running max within ``per + key``.  Rows with ``diff_ts > 0`` are
    kept; with ``topn`` the largest ``topn`` diffs are returned (ties broken
    on ``seq``, a ``TakeOrderedAndProject``), else all late rows.  Output:
    ``per``, key columns, ``diff_ts``, ``id`` (= seq).  Empty input gives an
    empty result.  A ``per`` column that ``events`` lacks is an error: offsets
    of several partitions have no common order.
    """
    keys = [key] if isinstance(key, str) else list(key or [])
    per = _present(events, per)
    group = [*per, *keys]
    # per key: split only keys with more than bucket_width rows (many small
    # keys would otherwise each get a bucket per offset range they touch)
    needed = list(dict.fromkeys([*group, seq, ts]))  # what is not reported is not shuffled
    late = lateness(events.select(*needed), seq, ts, group, buckets, rows_per_bucket, bucket_width, hot_keys_only=bool(keys)).where(
        F.col("diff_ts") > 0
    )
    out = late.select(*group, F.col("diff_ts"), F.col(seq).alias("id"))
    if topn is None:
        return out
    return out.orderBy(F.col("diff_ts").desc(), F.col("id").asc(), *[F.col(c).asc() for c in group]).limit(topn)


def late_beyond(
    events: DataFrame,
    delays: Sequence[int],
    seq: str = "offset",
    ts: str = "ts",
    key: str | Sequence[str] | None = None,
    per: Sequence[str] = ("partition",),
    buckets: int | None = None,
    bucket_width: int = DEFAULT_BUCKET_WIDTH,
) -> DataFrame:
    """S3, batch form: for each candidate watermark delay, the rows that a
    watermark of that delay would drop (arriving more than ``delay`` behind
    the running max).  At the T5 bound the count is 0.  Output: ``delay,
    late_rows, max_diff`` - a single grouped aggregate over the lateness
    column against a tiny literal table of delays."""
    keys = [key] if isinstance(key, str) else list(key or [])
    per = _present(events, per)
    needed = list(dict.fromkeys([*per, *keys, seq, ts]))
    lat = lateness(events.select(*needed), seq, ts, [*per, *keys], buckets, bucket_width=bucket_width, hot_keys_only=bool(keys))
    # One pass: a conditional count per candidate delay (a short literal
    # list), then ``stack`` turns the counts into rows - no join needed.
    aggs = [F.count(F.when(F.col("diff_ts") > int(d), 1)).alias(f"d{i}") for i, d in enumerate(delays)]
    agg = lat.agg(*aggs, F.max("diff_ts").alias("max_diff"))
    stack = F.expr(
        "stack({}, {})".format(len(delays), ", ".join(f"{int(d)}L, d{i}" for i, d in enumerate(delays)))
    ).alias("delay", "late_rows")
    res = agg.select(stack, F.greatest(F.col("max_diff"), F.lit(0)).cast("bigint").alias("max_diff"))
    return res


# ------------------------------------------------------------------------- T7
def message_count(landed: DataFrame) -> DataFrame:
    """Row count of the landed copy."""
    return landed.agg(F.count(F.lit(1)).alias("messages"))


# ------------------------------------------------------------------------- T8
@F.pandas_udf(T.StringType())
def _pretty_json(values):  # per-row helper on the final few rows only
    import json

    def fmt(v):
        if v is None:
            return None
        try:
            return json.dumps(json.loads(v), indent=1, ensure_ascii=False)
        except ValueError:
            return v

    return values.map(fmt)


def last_message(
    log: DataFrame,
    partition: str = "partition",
    offset: str = "offset",
    value: str = "value",
    pretty: bool = True,
    static_bounds: bool = True,
) -> DataFrame:
    """The last message of each partition (highest offset): ``partition,
    offset, timestamp, value`` and, with ``pretty``, the value re-indented.
    An empty log gives no rows.  Rows without an offset have no place and are
    left out; of rows that share the last offset the largest (by the columns
    in order) is the last.

    The highest offset per partition is found from the two narrow columns
    only; the rows themselves are then read through a literal offset filter
    (row groups skipped by their offset statistics), so the wide ``value``
    column of the whole log is never read.  Beyond
    ``MAX_STATIC_PARTITIONS`` partitions the whole log is aggregated.  Either
    way the same aggregate (partial, combined map-side) picks the row."""
    names = log.columns
    log = log.where(F.col(offset).isNotNull())
    if static_bounds:
        top = log.groupBy(partition).agg(F.max(offset).alias("__lo")).withColumn("__hi", F.col("__lo"))
        narrowed = _offset_ranges(log, top, partition, offset)
        log = log if narrowed is None else narrowed
    rest = [offset, *[c for c in names if c not in (partition, offset)]]
    last = log.groupBy(partition).agg(F.max(F.struct(*rest)).alias("__m")).select(partition, "__m.*").select(*names)
    if pretty:
        last = last.withColumn("pretty", _pretty_json(F.col(value)))
    return last


# ------------------------------------------------------------------------- T9
def check_landed(
    log: DataFrame,
    landed: DataFrame,
    key_field: str = DEFAULT_KEY_FIELD,
    partition: str = "partition",
    offset: str = "offset",
    value: str = "value",
    static_bounds: bool = True,
) -> DataFrame:
    """Compare the key sequence of the topic with the landed copy, position
    by position (offset), over the landed offset range of each partition.

    One report row per landed partition: ``compared`` (positions present on
    both sides), ``mismatched`` (keys differ, null-safe), ``missing``
    (topic rows absent from the copy), ``extra`` (copy rows absent from the
    topic), ``first_offset`` of the first difference (null when equal).
    An equi-join on (partition, offset), not a positional zip; rows of a null
    partition are compared as one partition of their own, however many
    partitions there are.  The landed
    ranges (one row per partition) become a literal offset filter on the
    log scan, as in :func:`slice_log`."""
    rng = landed.groupBy(partition).agg(F.min(offset).alias("__lo"), F.max(offset).alias("__hi"))
    in_range = _offset_ranges(log, rng, partition, offset) if static_bounds else None
    if in_range is None:
        in_range = (
            log.join(rng.withColumnRenamed(partition, "__p"), F.col(partition).eqNullSafe(F.col("__p")))
            .where(F.col(offset).between(F.col("__lo"), F.col("__hi")))
            .drop("__lo", "__hi", "__p")
        )
    topic = in_range.select(partition, offset, F.json_tuple(F.col(value), key_field).alias("topic_key"))
    copy = landed.select(partition, offset, F.col("key").alias("landed_key"), F.lit(True).alias("__in"))
    # Null partitions are one partition, on either path and in the join.
    position = F.struct(partition, offset)
    topic = topic.select(position.alias("__at"), "topic_key", F.lit(True).alias("__t"))
    both = topic.join(copy.select(position.alias("__at"), "landed_key", "__in"), "__at", "full_outer")
    both = both.select(F.col("__at").getField(partition).alias(partition), F.col("__at").getField(offset).alias(offset), "topic_key", "landed_key", "__t", "__in")
    diff = ~F.col("topic_key").eqNullSafe(F.col("landed_key"))
    paired = F.col("__t").isNotNull() & F.col("__in").isNotNull()
    return both.groupBy(partition).agg(
        F.count(F.when(paired, 1)).alias("compared"),
        F.count(F.when(paired & diff, 1)).alias("mismatched"),
        F.count(F.when(F.col("__in").isNull(), 1)).alias("missing"),
        F.count(F.when(F.col("__t").isNull(), 1)).alias("extra"),
        F.min(F.when(diff, F.col(offset))).alias("first_offset"),
    )


# ------------------------------------------------------------------------ T10
def user_topics(topics: DataFrame, name: str = "name") -> DataFrame:
    """Drop internal topics (names starting ``__`` or ``--``)."""
    c = F.col(name)
    cond = F.lit(True)
    for p in INTERNAL_TOPIC_PREFIXES:
        cond = cond & ~c.startswith(p)
    return topics.where(cond)


def topics_frame(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "name string")


__all__ = [
    "slice_log",
    "slice_last_day",
    "split_events",
    "extract_events",
    "land",
    "disorder_bound",
    "late_beyond",
    "message_count",
    "last_message",
    "check_landed",
    "user_topics",
    "table_name_of",
]

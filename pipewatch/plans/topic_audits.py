"""Registered topic audits (T1-T11, S3 batch form)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pipewatch.functions.names import table_name_of
from pipewatch.functions.times import format_ntz, instant
from pipewatch.operators import topics
from pipewatch.plans import fixtures_sql as fx
from pipewatch.plans.registry import register
from pipewatch.session import work_dir
from pipewatch.sources import derived

# The slice used by the audits (FIXTURES.md).
SLICE_START = dt.datetime(2024, 1, 10)
SLICE_END = dt.datetime(2024, 1, 12)
LAST_DAY_NOW = dt.datetime(2024, 1, 15, 12, 34, 56, 789000)


def _slice_sql(start: str, end: str) -> str:
    return f"""
    WITH log AS ({fx.EVENTS_LOG}),
    b AS (SELECT "partition",
                 min(CASE WHEN "timestamp" >= TIMESTAMP '{start}' THEN "offset" END) AS lo,
                 min(CASE WHEN "timestamp" >= TIMESTAMP '{end}' THEN "offset" END) AS hi
          FROM log GROUP BY "partition")
    SELECT l."partition", l."offset", l."timestamp"
    FROM log l JOIN b USING ("partition")
    WHERE b.lo IS NOT NULL AND l."offset" >= b.lo AND (b.hi IS NULL OR l."offset" <= greatest(b.lo, b.hi))
    """


@register("t1_slice_log", _slice_sql("2024-01-10 00:00:00", "2024-01-12 00:00:00"))
def t1_slice_log(spark, sf_dir):
    log = derived.events_log(spark, sf_dir)
    return topics.slice_log(log, SLICE_START, SLICE_END).select("partition", "offset", "timestamp")


@register("t1_slice_open_end", _slice_sql("2024-01-25 00:00:00", "2024-03-01 00:00:00"))
def t1_slice_open_end(spark, sf_dir):
    log = derived.events_log(spark, sf_dir)
    return topics.slice_log(log, dt.datetime(2024, 1, 25), dt.datetime(2024, 3, 1)).select(
        "partition", "offset", "timestamp"
    )


@register("t2_slice_last_day", _slice_sql("2024-01-14 12:34:56", "2024-01-15 12:34:56"))
def t2_slice_last_day(spark, sf_dir):
    log = derived.events_log(spark, sf_dir)
    return topics.slice_last_day(log, LAST_DAY_NOW).select("partition", "offset", "timestamp")


def _instants(log):
    """The log with its broker time as an instant, as a Kafka source gives it."""
    return log.withColumn("timestamp", instant("timestamp"))


def _offsets(sql: str) -> str:
    return f'SELECT "partition", "offset" FROM ({sql})'


@register("t1_slice_log_instant", _offsets(_slice_sql("2024-01-10 00:00:00", "2024-01-12 00:00:00")))
def t1_slice_log_instant(spark, sf_dir):
    log = _instants(derived.events_log(spark, sf_dir))
    return topics.slice_log(log, SLICE_START, SLICE_END).select("partition", "offset")


@register("t2_slice_last_day_instant", _offsets(_slice_sql("2024-01-14 12:34:56", "2024-01-15 12:34:56")))
def t2_slice_last_day_instant(spark, sf_dir):
    log = _instants(derived.events_log(spark, sf_dir))
    return topics.slice_last_day(log, LAST_DAY_NOW).select("partition", "offset")


@register(
    "t3_extract_events",
    f"""WITH e AS ({fx.EVENTS_EXTRACTED}) SELECT "partition", "offset", "key", ts FROM e""",
)
def t3_extract_events(spark, sf_dir):
    return topics.extract_events(derived.events_log(spark, sf_dir))


@register(
    "t3_rejects",
    """SELECT 0 AS "partition", event_id AS "offset", 'event time missing or unparsable' AS reason
       FROM events WHERE event_id % 97 = 0""",
)
def t3_rejects(spark, sf_dir):
    _, bad = topics.split_events(derived.events_log(spark, sf_dir))
    return bad.select("partition", "offset", "reason")


@register(
    "t4_land",
    f"""WITH s AS ({_slice_sql("2024-01-10 00:00:00", "2024-01-12 00:00:00")})
        SELECT "partition", count(*) > 0 AS has_data, min("offset") AS start_offset,
               count(*) FILTER (WHERE "offset" % 97 <> 0) AS "rows", count(*) FILTER (WHERE "offset" % 97 = 0) AS rejected
        FROM s GROUP BY "partition" """,
)
def t4_land(spark, sf_dir):
    log = derived.events_log(spark, sf_dir)
    return topics.land(log, work_dir(spark, "landed"), SLICE_START, SLICE_END)


@register(
    "t4_land_rejects",
    f"""WITH s AS ({_slice_sql("2024-01-10 00:00:00", "2024-01-12 00:00:00")})
        SELECT "partition", "offset", 'event time missing or unparsable' AS reason FROM s WHERE "offset" % 97 = 0""",
)
def t4_land_rejects(spark, sf_dir):
    path = work_dir(spark, "landed")
    topics.land(derived.events_log(spark, sf_dir), path, SLICE_START, SLICE_END)
    return spark.read.parquet(f"{path}_rejects").select("partition", "offset", "reason")


@register(
    "t4_land_empty_slice",
    f"""SELECT "partition", false AS has_data, CAST(NULL AS BIGINT) AS start_offset, 0 AS "rows", 0 AS rejected
        FROM ({fx.EVENTS_LOG}) GROUP BY "partition" """,
)
def t4_land_empty_slice(spark, sf_dir):
    log = derived.events_log(spark, sf_dir)
    return topics.land(log, work_dir(spark, "landed"), dt.datetime(2100, 1, 1), dt.datetime(2100, 1, 2))


def _disorder_sql(src: str, key: str | None, topn: int | None = 5) -> str:
    part = 'PARTITION BY "partition", "key"' if key else 'PARTITION BY "partition"'
    cols = '"partition", "key", ' if key else '"partition", '
    lim = f'ORDER BY diff_ts DESC, id LIMIT {topn}' if topn else ""
    return f"""
    WITH e AS ({src}),
    t1 AS (SELECT "partition", "key", "offset", ts,
                  max(ts) OVER ({part} ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS max_ts
           FROM e)
    SELECT {cols} max_ts - ts AS diff_ts, "offset" AS id FROM t1 WHERE max_ts - ts > 0 {lim}
    """


def _orders_events(spark, sf_dir):
    return topics.extract_events(derived.orders_log(spark, sf_dir))


@register("t5_disorder_global", _disorder_sql(fx.ORDERS_EXTRACTED, None))
def t5_disorder_global(spark, sf_dir):
    return topics.disorder_bound(_orders_events(spark, sf_dir), topn=5)


@register("t6_disorder_per_key", _disorder_sql(fx.ORDERS_EXTRACTED, "key"))
def t6_disorder_per_key(spark, sf_dir):
    return topics.disorder_bound(_orders_events(spark, sf_dir), key="key", topn=5)


@register("t6_late_rows_per_key", _disorder_sql(fx.ORDERS_EXTRACTED, "key", topn=None))
def t6_late_rows_per_key(spark, sf_dir):
    return topics.disorder_bound(_orders_events(spark, sf_dir), key="key", topn=None)


_BROKER_SQL = f"""
    SELECT "partition", "offset", CAST(user_id AS VARCHAR) AS "key",
           CAST(epoch(date_trunc('second', "timestamp")) AS BIGINT) AS ts
    FROM ({fx.EVENTS_LOG})
"""


def _broker_events(spark, sf_dir):
    log = derived.events_log(spark, sf_dir)
    ev = topics.extract_events(log.withColumn("value", F.to_json(F.struct(
        F.get_json_object("value", "$.id").alias("id"),
        format_ntz("timestamp", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
    ))))
    return ev


@register("t5_disorder_broker_mild", _disorder_sql(_BROKER_SQL, None))
def t5_disorder_broker_mild(spark, sf_dir):
    return topics.disorder_bound(_broker_events(spark, sf_dir), topn=5)


@register("t6_disorder_broker_mild_per_user", _disorder_sql(_BROKER_SQL, "key"))
def t6_disorder_broker_mild_per_user(spark, sf_dir):
    return topics.disorder_bound(_broker_events(spark, sf_dir), key="key", topn=5)


_DELAYS = (0, 600, 3600, 86400, 31536000, 207705600)


@register(
    "s3_late_beyond",
    f"""
    WITH e AS ({fx.ORDERS_EXTRACTED}),
    t1 AS (SELECT ts, max(ts) OVER (PARTITION BY "partition" ORDER BY "offset"
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - ts AS diff FROM e),
    d AS (SELECT * FROM (VALUES {", ".join(f"({d})" for d in _DELAYS)}) v(delay))
    SELECT CAST(d.delay AS BIGINT) AS delay, count(t1.diff) FILTER (WHERE t1.diff > d.delay) AS late_rows,
           CAST((SELECT max(diff) FROM t1) AS BIGINT) AS max_diff
    FROM d, t1 GROUP BY d.delay
    """,
)
def s3_late_beyond(spark, sf_dir):
    return topics.late_beyond(_orders_events(spark, sf_dir), _DELAYS)


@register("t7_message_count", f"""SELECT count(*) AS messages FROM ({fx.LANDED_EVENTS})""")
def t7_message_count(spark, sf_dir):
    return topics.message_count(derived.landed_events(spark, sf_dir))


@register(
    "t8_last_message",
    """SELECT 0 AS "partition", o_orderkey AS "offset", o_orderdate AS "timestamp",
              '{"id":' || o_custkey || ',"event_time":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"}' AS value,
              '{' || chr(10) || ' "id": ' || o_custkey || ',' || chr(10) || ' "event_time": "'
                  || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"' || chr(10) || '}' AS pretty
       FROM orders ORDER BY o_orderkey DESC LIMIT 1""",
)
def t8_last_message(spark, sf_dir):
    return topics.last_message(derived.orders_log(spark, sf_dir))


@register(
    "t9_check_landed",
    f"""
    WITH l AS ({fx.LANDED_EVENTS}),
    r AS (SELECT "partition", min("offset") AS lo, max("offset") AS hi FROM l GROUP BY "partition"),
    t AS (SELECT 0 AS "partition", event_id AS "offset", CAST(user_id AS VARCHAR) AS topic_key FROM events),
    t2 AS (SELECT t.* FROM t JOIN r USING ("partition") WHERE t."offset" BETWEEN r.lo AND r.hi),
    j AS (SELECT coalesce(t2."partition", l."partition") AS "partition", coalesce(t2."offset", l."offset") AS "offset",
                 t2.topic_key, l."key" AS landed_key, t2."offset" IS NOT NULL AS in_t, l."offset" IS NOT NULL AS in_l
          FROM t2 FULL OUTER JOIN l ON t2."partition" = l."partition" AND t2."offset" = l."offset")
    SELECT "partition",
           count(*) FILTER (WHERE in_t AND in_l) AS compared,
           count(*) FILTER (WHERE in_t AND in_l AND topic_key IS DISTINCT FROM landed_key) AS mismatched,
           count(*) FILTER (WHERE NOT in_l) AS missing,
           count(*) FILTER (WHERE NOT in_t) AS extra,
           min("offset") FILTER (WHERE topic_key IS DISTINCT FROM landed_key) AS first_offset
    FROM j GROUP BY "partition"
    """,
)
def t9_check_landed(spark, sf_dir):
    return topics.check_landed(derived.events_log(spark, sf_dir), derived.landed_events(spark, sf_dir))


@register(
    "t10_user_topics",
    f"""SELECT name FROM ({fx.TOPIC_NAMES}) WHERE NOT starts_with(name, '__') AND NOT starts_with(name, '--')""",
)
def t10_user_topics(spark, sf_dir):
    return topics.user_topics(derived.topic_names(spark, sf_dir))


@register(
    "t11_table_name_of",
    f"""SELECT name, regexp_replace(name, '[.\\-]', '_', 'g') AS table_name FROM ({fx.TOPIC_NAMES})""",
)
def t11_table_name_of(spark, sf_dir):
    return derived.topic_names(spark, sf_dir).select("name", table_name_of("name").alias("table_name"))


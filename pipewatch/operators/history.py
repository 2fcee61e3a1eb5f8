"""Query-history mining, maintenance ranking and replication-slot lag."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipewatch.functions.times import format_ntz, ts_literal, utc_wall

# Dashboard query markers, users, windows and report sizes.
DASHBOARD_MARKER = "-- MBI:"
DASHBOARD_CODE_PATTERN = r"(?U)-- MBI:(\w+)"
QUERY_UUID_PATTERN = r"(?U)query: (\w+)"
DASHBOARD_TEXT_PREFIX = 64
DASHBOARD_DAYS = 7
LOCAL_OFFSET_HOURS = 8
MAINTENANCE_TOPN = 10
LSN_HIGH = 4294967296  # 2^32: one WAL "log id" step


# ------------------------------------------------------------------------- H1
def dashboard_queries(
    hist: DataFrame,
    as_of: dt.date,
    users: Sequence[int],
    days: int = DASHBOARD_DAYS,
    offset_hours: int = LOCAL_OFFSET_HOURS,
) -> DataFrame:
    """Dashboard queries of the given users whose local start (UTC +8h) is on
    or after ``as_of - days``: ``query_id``, local ``start_time`` text,
    ``elapsed`` in whole minutes, and the dashboard code and query uuid read
    from the first 64 characters of the text (missing gives ``''``)."""
    stype = hist.schema["start_time"].dataType
    local = F.timestamp_add("HOUR", F.lit(offset_hours), utc_wall("start_time", stype))
    since = as_of - dt.timedelta(days=days)
    since_local = dt.datetime(since.year, since.month, since.day)
    # local >= since  <=>  start_time >= since - offset: a plain range the scan can use
    recent = F.col("start_time") >= ts_literal(since_local - dt.timedelta(hours=offset_hours), stype)
    head = F.substring("query_text", 1, DASHBOARD_TEXT_PREFIX)
    return hist.where(
        F.col("user_id").isin(list(users)) & recent & (F.instr("query_text", DASHBOARD_MARKER) > 0)
    ).select(
        "query_id",
        format_ntz(local, "yyyy-MM-dd HH:mm:ss").alias("start_time"),
        F.call_function("div", F.call_function("div", F.col("elapsed_us"), F.lit(1000000)), F.lit(60)).alias("elapsed"),
        F.regexp_extract(head, DASHBOARD_CODE_PATTERN, 1).alias("dashboard_code"),
        F.regexp_extract(head, QUERY_UUID_PATTERN, 1).alias("query_uuid"),
    )


# ------------------------------------------------------------------------- H2
def slowest(queries: DataFrame, code: str | None = None) -> DataFrame:
    """Dashboard queries, slowest first; optionally of one dashboard code."""
    out = queries if code is None else queries.where(F.col("dashboard_code") == F.lit(code))
    return out.orderBy(F.col("elapsed").desc(), F.col("query_id"))


# ------------------------------------------------------------------------- H3
def maintenance_rank(info: DataFrame, topn: int = MAINTENANCE_TOPN) -> DataFrame:
    """Tables with the largest vacuum sort benefit (nulls last, null kept),
    with the command text; a ``TakeOrderedAndProject``."""
    ddl = F.concat(F.lit("vacuum "), F.col("schema"), F.lit("."), F.col("table"), F.lit(";"))
    return (
        info.select("benefit", ddl.alias("ddl"))
        .orderBy(F.col("benefit").desc_nulls_last(), F.col("ddl"))
        .limit(topn)
    )


# ------------------------------------------------------------------------- H4
def lsn_bytes(lsn: Column | str) -> Column:
    """WAL position ``X/Y`` (hex) as a byte number ``X * 2^32 + Y``."""
    c = F.col(lsn) if isinstance(lsn, str) else lsn
    hi = F.conv(F.split_part(c, F.lit("/"), F.lit(1)), 16, 10).try_cast("bigint")
    lo = F.conv(F.split_part(c, F.lit("/"), F.lit(2)), 16, 10).try_cast("bigint")
    return hi * F.lit(LSN_HIGH) + lo


def size_pretty(size: Column | str) -> Column:
    """Readable byte count in the PostgreSQL ``pg_size_pretty`` style:
    bytes below 10 kB, then kB / MB / GB / TB with half rounding, each unit
    used while the value stays below 20480 half-units."""
    s = F.col(size) if isinstance(size, str) else size
    limit, limit2 = 10 * 1024, 10 * 1024 * 2 - 1

    def div(x: Column, d: int) -> Column:
        return F.call_function("div", x, F.lit(d))  # integral, truncating like C

    def half(x: Column) -> Column:
        return div(x + F.when(x < 0, -1).otherwise(1), 2)

    k = div(s, 1 << 9)
    m = div(k, 1 << 10)
    g = div(m, 1 << 10)
    t = div(g, 1 << 10)
    fmt = lambda v, unit: F.concat(v.cast("string"), F.lit(" " + unit))
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(F.abs(s) < limit, fmt(s, "bytes"))
        .when(F.abs(k) < limit2, fmt(half(k), "kB"))
        .when(F.abs(m) < limit2, fmt(half(m), "MB"))
        .when(F.abs(g) < limit2, fmt(half(g), "GB"))
        .otherwise(fmt(half(t), "TB"))
    )


def slot_lag(slots: DataFrame) -> DataFrame:
    """Replication slots with the bytes between the current WAL position and
    the slot's restart position, readable size, by database; slots without a
    database (null or empty) are hidden."""
    lag = lsn_bytes("current_lsn") - lsn_bytes("restart_lsn")
    return (
        slots.where(F.coalesce(F.col("database"), F.lit("")) != "")
        .select("database", "active", lag.alias("lag_bytes"), "slot_name")
        .withColumn("lag_size", size_pretty("lag_bytes"))
        .orderBy("database", "slot_name")
    )

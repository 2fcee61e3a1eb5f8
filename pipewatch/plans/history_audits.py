"""Registered history / maintenance audits (H1-H4)."""

from __future__ import annotations

import datetime as dt

from pipewatch.functions.times import instant
from pipewatch.operators import history as hs
from pipewatch.plans import fixtures_sql as fx
from pipewatch.plans.registry import register
from pipewatch.sources import derived

# Fixed value: the day the dashboard history is read on.
AS_OF = dt.date(2024, 1, 20)
USERS = (102, 109)

_H1_SQL = f"""
    SELECT query_id, strftime(start_time + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS start_time,
           elapsed_us // 1000000 // 60 AS elapsed,
           regexp_extract(left(query_text, 64), '-- MBI:(\\w+)', 1) AS dashboard_code,
           regexp_extract(left(query_text, 64), 'query: (\\w+)', 1) AS query_uuid
    FROM ({fx.QUERY_HISTORY})
    WHERE user_id IN (102, 109) AND start_time + INTERVAL 8 HOUR >= TIMESTAMP '2024-01-13 00:00:00'
      AND position('-- MBI:' IN query_text) > 0
"""


def _h1(spark, sf_dir):
    return hs.dashboard_queries(derived.query_history(spark, sf_dir), AS_OF, USERS)


@register("h1_dashboard_queries", _H1_SQL)
def h1_dashboard_queries(spark, sf_dir):
    return _h1(spark, sf_dir)


@register("h1_dashboard_queries_instant", _H1_SQL)
def h1_dashboard_queries_instant(spark, sf_dir):
    hist = derived.query_history(spark, sf_dir).withColumn("start_time", instant("start_time"))
    return hs.dashboard_queries(hist, AS_OF, USERS)


@register("h2_slowest", f"SELECT * FROM ({_H1_SQL}) WHERE dashboard_code = 'view7' ORDER BY elapsed DESC")
def h2_slowest(spark, sf_dir):
    return hs.slowest(_h1(spark, sf_dir), "view7")


@register(
    "h3_maintenance_rank",
    f"""SELECT benefit, 'vacuum ' || schema || '.' || "table" || ';' AS ddl FROM ({fx.TABLE_INFO})
        ORDER BY benefit DESC NULLS LAST, ddl LIMIT 10""",
)
def h3_maintenance_rank(spark, sf_dir):
    return hs.maintenance_rank(derived.table_info(spark, sf_dir))


def _lsn(c: str) -> str:
    return (f"(('0x' || split_part({c}, '/', 1))::BIGINT * 4294967296 + ('0x' || split_part({c}, '/', 2))::BIGINT)")


def _pretty(s: str) -> str:
    k, m = f"({s} // 512)", f"({s} // 512 // 1024)"
    g, t = f"({s} // 512 // 1024 // 1024)", f"({s} // 512 // 1024 // 1024 // 1024)"

    def half(x):
        return f"(({x} + CASE WHEN {x} < 0 THEN -1 ELSE 1 END) // 2)"

    return f"""CASE WHEN abs({s}) < 10240 THEN CAST({s} AS VARCHAR) || ' bytes'
                    WHEN abs({k}) < 20479 THEN CAST({half(k)} AS VARCHAR) || ' kB'
                    WHEN abs({m}) < 20479 THEN CAST({half(m)} AS VARCHAR) || ' MB'
                    WHEN abs({g}) < 20479 THEN CAST({half(g)} AS VARCHAR) || ' GB'
                    ELSE CAST({half(t)} AS VARCHAR) || ' TB' END"""


@register(
    "h4_slot_lag",
    f"""SELECT database, active, lag_bytes, slot_name, {_pretty('lag_bytes')} AS lag_size
        FROM (SELECT database, active, slot_name, {_lsn('current_lsn')} - {_lsn('restart_lsn')} AS lag_bytes
              FROM ({fx.SLOTS}) WHERE coalesce(database, '') <> '')""",
)
def h4_slot_lag(spark, sf_dir):
    return hs.slot_lag(derived.replication_slots(spark, sf_dir))

"""Registered key-value item audits (K1-K5) and the SQL entry (Q1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pipewatch.functions.times import format_ntz, to_local
from pipewatch.operators import items as it
from pipewatch.operators.sql import run_sql
from pipewatch.plans.registry import register
from pipewatch.sources import derived
from pipewatch.sources.tables import read_table


@register(
    "k1_latest_items",
    """WITH top AS (SELECT 'c' || CAST(o_custkey AS VARCHAR) AS key FROM orders
                    ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5)
       SELECT 'c' || CAST(c_custkey AS VARCHAR) AS key, c_name AS name, c_mktsegment AS segment
       FROM customer WHERE 'c' || CAST(c_custkey AS VARCHAR) IN (SELECT key FROM top)""",
)
def k1_latest_items(spark, sf_dir):
    items = it.unwrap_items(derived.typed_items(spark, sf_dir))
    got = it.latest_items(derived.item_keys(spark, sf_dir), items, "key", "time", n=5, tie="order_key")
    return got.select("key", F.col("item")["c_name"].alias("name"), F.col("item")["c_mktsegment"].alias("segment"))


@register(
    "k2_items_by_key",
    """SELECT 'c' || CAST(o_custkey AS VARCHAR) AS key, o_orderdate AS time, o_orderkey AS order_key
       FROM orders WHERE o_custkey = 42""",
)
def k2_items_by_key(spark, sf_dir):
    return it.items_by_key(derived.item_keys(spark, sf_dir), "key", "c42")


@register(
    "k3_unwrap",
    """SELECT 'c' || CAST(c_custkey AS VARCHAR) AS key, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
              CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
)
def k3_unwrap(spark, sf_dir):
    items = it.unwrap_items(derived.typed_items(spark, sf_dir))
    m = F.col("item")
    return items.select("key", *[m[c].alias(c) for c in ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")])


@register(
    "k4_attributes",
    """SELECT 'c' || CAST(c_custkey AS VARCHAR) AS key, 'c_name' AS attribute, c_name AS value FROM customer
       UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
       UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM customer
       UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), 'c_mktsegment', c_mktsegment FROM customer""",
)
def k4_attributes(spark, sf_dir):
    return it.attributes(derived.typed_items(spark, sf_dir))


def _iso_text(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    t = format_ntz(F.timestamp_add("SECOND", k % 86400, F.col("o_orderdate")), "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(k % 3 == 0, F.concat(t, F.lit(".123Z")))
        .when(k % 3 == 1, t)
        .otherwise(F.concat(F.lit("order "), k.cast("string")))
    )
    return o.select(k.alias("o_orderkey"), text.alias("text"))


# The pattern of an ISO time, and the shift to local time (8 hours).
@register(
    "k5_to_local",
    """WITH s AS (SELECT o_orderkey, CASE o_orderkey % 3
                    WHEN 0 THEN strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%dT%H:%M:%S') || '.123Z'
                    WHEN 1 THEN strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%dT%H:%M:%S')
                    ELSE 'order ' || CAST(o_orderkey AS VARCHAR) END AS text FROM orders)
       SELECT o_orderkey, text,
              CASE WHEN regexp_matches(text, '^\\d\\d\\d\\d-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d')
                   THEN strftime(strptime(substr(text, 1, 19), '%Y-%m-%dT%H:%M:%S') + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S')
                   ELSE text END AS local_time
       FROM s""",
)
def k5_to_local(spark, sf_dir):
    s = _iso_text(spark, sf_dir)
    return s.select("o_orderkey", "text", to_local("text").alias("local_time"))


# Fixed value: the SQL text run through the SQL entry (same text in both engines).
Q1_TEXT = """
    SELECT l_returnflag, l_linestatus,
           round(sum(l_quantity), 2) AS sum_qty,
           round(sum(l_extendedprice), 2) AS sum_base_price,
           round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
           round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
           round(avg(l_quantity), 4) AS avg_qty,
           round(avg(l_discount), 4) AS avg_disc,
           count(*) AS count_order
    FROM lineitem
    WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00'
    GROUP BY l_returnflag, l_linestatus
    ORDER BY l_returnflag, l_linestatus
"""


@register("q1_run_sql", Q1_TEXT)
def q1_run_sql(spark, sf_dir):
    return run_sql(spark, Q1_TEXT, {"lineitem": read_table(spark, sf_dir, "lineitem")})

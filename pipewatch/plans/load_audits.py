"""Registered load / backfill / copy audits."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from pipewatch.operators import loads as ld
from pipewatch.plans import fixtures_sql as fx
from pipewatch.plans.registry import register
from pipewatch.session import work_dir
from pipewatch.sources import derived
from pipewatch.sources.tables import read_table

# Backfill window (string partition bounds).
BACKFILL_LO = "1996/01/01/00"
BACKFILL_HI = "1997/06/30/23"


def _backfill_target(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderkey") % 4 != 0).drop("o_orderpriority")


@register(
    "l1_backfill",
    f"""SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice FROM ({fx.CDC_SOURCE}) s
        WHERE length(event_time) >= 13 AND event_time BETWEEN '{BACKFILL_LO}' AND '{BACKFILL_HI}'
          AND NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey % 4 <> 0 AND t.o_orderkey = s.o_orderkey)""",
)
def l1_backfill(spark, sf_dir):
    src = derived.cdc_source(spark, sf_dir)
    return ld.backfill(src, _backfill_target(spark, sf_dir), BACKFILL_LO, BACKFILL_HI, key="o_orderkey")


@register(
    "l1_backfill_thinned",
    f"""SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice FROM ({fx.CDC_SOURCE}) s
        WHERE length(event_time) >= 13 AND event_time BETWEEN '{BACKFILL_LO}' AND '{BACKFILL_HI}'
          AND NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey % 4 <> 0 AND t.o_orderkey = s.o_orderkey)""",
)
def l1_backfill_thinned(spark, sf_dir):
    src = derived.cdc_source(spark, sf_dir)
    return ld.backfill_thinned(src, _backfill_target(spark, sf_dir), BACKFILL_LO, BACKFILL_HI, key="o_orderkey")


@register(
    "l1_append_reads_back",
    f"""WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderkey % 10 AS only_target
                   FROM orders WHERE o_orderkey % 4 <> 0)
        SELECT * FROM t
        UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL FROM ({fx.CDC_SOURCE})
        WHERE length(event_time) >= 13 AND event_time BETWEEN '{BACKFILL_LO}' AND '{BACKFILL_HI}' AND o_orderkey % 4 = 0""",
)
def l1_append_reads_back(spark, sf_dir):
    """Backfill twice into a table with a column of its own and read it back."""
    path = work_dir(spark, "backfill")
    _backfill_target(spark, sf_dir).withColumn("only_target", F.col("o_orderkey") % 10).write.parquet(path)
    src = derived.cdc_source(spark, sf_dir)
    for _ in range(2):
        ld.append(ld.backfill(src, spark.read.parquet(path), BACKFILL_LO, BACKFILL_HI, key="o_orderkey"), path)
    return spark.read.parquet(path)


@register(
    "l2_l3_unload_load",
    """SELECT o_orderkey, o_custkey, o_totalprice, 'orders__2' AS label_prefix FROM orders""",
)
def l2_l3_unload_load(spark, sf_dir):
    path = work_dir(spark, "unload", "orders")
    ld.unload(read_table(spark, sf_dir, "orders"), path)
    loaded = ld.load(spark, path, ["o_orderkey", "o_custkey", "o_totalprice"], "orders", attempt=2)
    return loaded.select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.regexp_extract("label", r"^(.*)__\d+$", 1).alias("label_prefix"),
    )


@register(
    "l3_load_file_labels",
    """SELECT 'lineitem__1__' || dense_rank() OVER (ORDER BY l_returnflag) AS label, l_orderkey, l_linenumber
       FROM lineitem""",
)
def l3_load_file_labels(spark, sf_dir):
    """A folder with one file, of the same name, in each partition folder."""
    path = work_dir(spark, "unload", "lineitem")
    items = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    with ld.open_writers(spark):  # one task writes all files, for their names to be equal: it keeps no rows
        items.repartition(1, "l_returnflag").write.partitionBy("l_returnflag").parquet(path)
    return ld.load(spark, path, ["l_orderkey", "l_linenumber"], "lineitem").select("label", "l_orderkey", "l_linenumber")


@register(
    "l4_load_status",
    f"""SELECT label, state, create_time FROM (
            SELECT *, row_number() OVER (PARTITION BY label ORDER BY create_time DESC, state DESC) AS rn
            FROM ({fx.LOAD_LOG})) WHERE rn = 1""",
)
def l4_load_status(spark, sf_dir):
    return ld.load_status(derived.load_log(spark, sf_dir))


@register("l5_model_detail", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def l5_model_detail(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ld.apply_model(o, "detail", ["o_custkey"])


_UNIQUE_SQL = """
    SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders) WHERE rn = 1
"""


@register("l5_model_unique", _UNIQUE_SQL)
def l5_model_unique(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return ld.apply_model(o, "unique", ["o_custkey"], order=["o_orderdate", "o_orderkey"])


@register(
    "l5_model_aggregate",
    """SELECT o_custkey, round(sum(o_totalprice), 2) AS total, count(*) AS orders, max(o_orderdate) AS last_order
       FROM orders GROUP BY o_custkey""",
)
def l5_model_aggregate(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    aggs = [
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.count(F.lit(1)).alias("orders"),
        F.max("o_orderdate").alias("last_order"),
    ]
    return ld.apply_model(o, "aggregate", ["o_custkey"], aggs=aggs)


@register("l5_write_bucketed_unique", _UNIQUE_SQL)
def l5_write_bucketed_unique(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    db = f"serving_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{work_dir(spark, 'serving')}'")
    table = f"{db}.orders_unique"
    ld.write_model(o, table, "unique", ["o_custkey"], ["o_custkey"], order=["o_orderdate", "o_orderkey"])
    return spark.table(table)


def _loads(spark, sf_dir, model, columns, **rules):
    """Two loads of one model: orders before and since 1995, into one table."""
    o = read_table(spark, sf_dir, "orders").select(*columns)
    since = F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz")
    db = f"serving_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{work_dir(spark, 'serving')}'")
    for part in (o.where(~since), o.where(since)):
        ld.write_model(part, f"{db}.orders", model, ["o_custkey"], ["o_custkey"], **rules)
    return spark.table(f"{db}.orders")


@register("l5_load_detail_twice", "SELECT o_custkey, o_orderkey, o_orderdate FROM orders")
def l5_load_detail_twice(spark, sf_dir):
    return _loads(spark, sf_dir, "detail", ["o_custkey", "o_orderkey", "o_orderdate"])


@register("l5_load_unique_twice", _UNIQUE_SQL)
def l5_load_unique_twice(spark, sf_dir):
    cols = ["o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    return _loads(spark, sf_dir, "unique", cols, order=["o_orderdate", "o_orderkey"])


@register(
    "l5_load_aggregate_twice",
    "SELECT o_custkey, count(*) AS orders, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey",
)
def l5_load_aggregate_twice(spark, sf_dir):
    return _loads(
        spark, sf_dir, "aggregate", ["o_custkey", "o_orderdate"],
        aggs=[F.count(F.lit(1)).alias("orders"), F.max("o_orderdate").alias("last_order")],
        merge=[F.sum("orders").alias("orders"), F.max("last_order").alias("last_order")],
    )


@register(
    "l6_restore_rows",
    "SELECT o_orderkey, o_custkey, o_totalprice, 'restored' AS first_run, 'skipped' AS second_run FROM orders",
)
def l6_restore_rows(spark, sf_dir):
    """The rows of a restored copy, and what a second restore says of it."""
    snap, schema, when = work_dir(spark, "snapshot"), f"temp_{uuid.uuid4().hex[:12]}", dt.datetime(1998, 1, 2, 2, 30)
    read_table(spark, sf_dir, "orders").write.parquet(f"{snap}/dw/ods/orders")
    runs = [ld.restore_tables(spark, snap, ["dw.ods.orders"], when, schema, work_dir(spark, "restore")).first()["status"] for _ in range(2)]
    rows = spark.table(f"{schema}.{ld.restore_name('dw.ods.orders', when)}")
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", F.lit(runs[0]).alias("first_run"), F.lit(runs[1]).alias("second_run"))


@register(
    "l6_restore_tables",
    """SELECT 'dw.ods.orders' AS "table", 'orders_199801021030' AS target_table, 'restored' AS status,
              (SELECT count(*) FROM orders) AS "rows"
       UNION ALL
       SELECT 'dw.ods.customer', 'customer_199801021030', 'restored', (SELECT count(*) FROM customer)""",
)
def l6_restore_tables(spark, sf_dir):
    snap = work_dir(spark, "snapshot")
    for name in ("orders", "customer"):
        read_table(spark, sf_dir, name).write.parquet(f"{snap}/dw/ods/{name}")
    schema = f"temp_{uuid.uuid4().hex[:12]}"
    when = dt.datetime(1998, 1, 2, 2, 30)
    status = ld.restore_tables(spark, snap, ["dw.ods.orders", "dw.ods.customer"], when, schema=schema,
                               schema_location=work_dir(spark, "restore"))
    counts = [
        spark.table(f"{schema}.{ld.restore_name(t, when)}").agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(t))
        for t in ("dw.ods.orders", "dw.ods.customer")
    ]
    rows = counts[0].unionByName(counts[1])
    return status.join(rows, "table").select("table", "target_table", "status", "rows")


@register(
    "l7_heads",
    """SELECT 'nation' AS table_name, CAST(row_number() OVER (ORDER BY n_nationkey) AS INTEGER) AS rn, to_json(t) AS row_json
       FROM (SELECT * FROM nation ORDER BY n_nationkey LIMIT 3) t
       UNION ALL
       SELECT 'region', CAST(row_number() OVER (ORDER BY r_regionkey) AS INTEGER), to_json(t)
       FROM (SELECT * FROM region ORDER BY r_regionkey LIMIT 3) t
       UNION ALL
       SELECT 'supplier', CAST(row_number() OVER (ORDER BY s_suppkey) AS INTEGER), to_json(t)
       FROM (SELECT * FROM supplier ORDER BY s_suppkey LIMIT 3) t""",
)
def l7_heads(spark, sf_dir):
    frames = {n: read_table(spark, sf_dir, n) for n in ("nation", "region", "supplier")}
    order = {"nation": ["n_nationkey"], "region": ["r_regionkey"], "supplier": ["s_suppkey"]}
    return ld.heads(frames, 3, order)


@register(
    "l7_heads_by_supplier",
    """SELECT l_suppkey, l_orderkey, l_linenumber, rn FROM (
           SELECT l_suppkey, l_orderkey, l_linenumber,
                  CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS INTEGER) AS rn
           FROM lineitem) WHERE rn <= 3""",
)
def l7_heads_by_supplier(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    return ld.heads_by(li, ["l_suppkey"], ["l_orderkey", "l_linenumber"], 3)


@register(
    "l8_apply_mapping",
    """SELECT 'ods.init_region' AS target_table, count(*) AS "rows" FROM region
       UNION ALL SELECT 'ods.init_nation', count(*) FROM nation
       UNION ALL SELECT 'ods.init_supplier', count(*) FROM supplier
       UNION ALL SELECT 'stg.s_region', 0 UNION ALL SELECT 'stg.s_nation', 0""",
)
def l8_apply_mapping(spark, sf_dir):
    frames = {n: read_table(spark, sf_dir, n) for n in ("region", "nation", "supplier")}
    data = ld.apply_mapping(frames, ["region", "nation", "supplier"], "init_", "ods", "data")
    struct_only = ld.apply_mapping(frames, ["region", "nation"], "s_", "stg", "schema")
    root = work_dir(spark, "mapping")
    ld.write_mapping({**data, **struct_only}, root)
    parts = []
    for name in [*data, *struct_only]:
        sch, tbl = name.split(".", 1)
        back = spark.read.parquet(f"{root}/{sch}/{tbl}")
        parts.append(back.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("target_table"), "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register(
    "l8_mapping_rows",
    """SELECT 'ods.a_supplier' AS target_table, CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey END AS id, s_name FROM supplier
       UNION ALL SELECT 'stg.b_supplier', NULL, s_name FROM supplier WHERE s_suppkey % 7 = 0""",
)
def l8_mapping_rows(spark, sf_dir):
    """Row contents of a table some of whose ids are null, in both modes."""
    key = F.col("s_suppkey")
    frames = {"supplier": read_table(spark, sf_dir, "supplier").select(F.when(key % 7 != 0, key).alias("id"), "s_name")}
    mapped = ld.apply_mapping(frames, ["supplier"], "a_", "ods", "data") | ld.apply_mapping(frames, ["supplier"], "b_", "stg", "schema")
    root = work_dir(spark, "mapping")
    ld.write_mapping(mapped, root)
    parts = [spark.read.parquet(f"{root}/{n.replace('.', '/', 1)}").select(F.lit(n).alias("target_table"), "id", "s_name") for n in mapped]
    return parts[0].unionByName(parts[1])

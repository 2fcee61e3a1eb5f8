"""Registered inventory / reconciliation / search audits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pipewatch.functions.times import instant
from pipewatch.operators import catalog as cg
from pipewatch.plans import fixtures_sql as fx
from pipewatch.plans.registry import register
from pipewatch.sources import derived
from pipewatch.sources.tables import read_table


@register(
    "i1_full_refresh_tasks",
    f"""WITH t AS ({fx.TASKS}), e AS ({fx.ENDPOINTS})
        SELECT t.task_id, s.id AS source_id, g.id AS target_id, s.engine AS source_engine, g.engine AS target_engine,
               CAST(json_extract(t.settings, '$.TargetMetadata.ParallelLoadThreads') AS INTEGER) AS threads,
               json_extract_string(t.mappings, '$.rules[0]."rule-id"') AS rule_id
        FROM t LEFT JOIN e s ON t.source_arn = s.arn LEFT JOIN e g ON t.target_arn = g.arn""",
)
def i1_full_refresh_tasks(spark, sf_dir):
    inv = cg.full_refresh(derived.endpoints(spark, sf_dir), derived.tasks(spark, sf_dir), derived.table_stats(spark, sf_dir))
    return inv["tasks"].select(
        "task_id", "source_id", "target_id", "source_engine", "target_engine",
        F.try_variant_get("settings", "$.TargetMetadata.ParallelLoadThreads", "int").alias("threads"),
        F.try_variant_get("mappings", "$.rules[0]['rule-id']", "string").alias("rule_id"),
    )


@register(
    "i1_full_refresh_tables",
    f"""WITH t AS ({fx.TASKS}), st AS ({fx.TABLE_STATS})
        SELECT st.task_arn, st."table" AS name, st.schema, t.task_id AS task_name
        FROM st LEFT JOIN t ON st.task_arn = t.arn""",
)
def i1_full_refresh_tables(spark, sf_dir):
    inv = cg.full_refresh(derived.endpoints(spark, sf_dir), derived.tasks(spark, sf_dir), derived.table_stats(spark, sf_dir))
    return inv["tables"]


def _customers(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    existing = c.where(F.col("c_custkey") % 3 != 0).select("c_custkey", "c_name", "c_nationkey")
    incoming = c.where(F.col("c_custkey") % 3 != 1).select("c_custkey", F.upper("c_name").alias("c_name"), "c_nationkey")
    return existing, incoming


@register(
    "i2_add_new",
    """SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey % 3 <> 0
       UNION ALL SELECT c_custkey, upper(c_name), c_nationkey FROM customer WHERE c_custkey % 3 = 0""",
)
def i2_add_new(spark, sf_dir):
    existing, incoming = _customers(spark, sf_dir)
    return cg.add_new(existing, incoming, ["c_custkey"])


@register(
    "i3_reconcile",
    """SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey % 3 <> 0 AND c_nationkey <> 5
       UNION ALL SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey % 3 = 2 AND c_nationkey = 5
       UNION ALL SELECT c_custkey, upper(c_name), c_nationkey FROM customer WHERE c_custkey % 3 = 0 AND c_nationkey = 5""",
)
def i3_reconcile(spark, sf_dir):
    existing, incoming = _customers(spark, sf_dir)
    return cg.reconcile(existing, incoming, ["c_custkey"], "c_nationkey", 5)[0]


@register(
    "i3_reconcile_counts",
    """SELECT count(*) FILTER (WHERE c_custkey % 3 = 0) AS added, count(*) FILTER (WHERE c_custkey % 3 = 1) AS removed
       FROM customer WHERE c_nationkey = 5""",
)
def i3_reconcile_counts(spark, sf_dir):
    existing, incoming = _customers(spark, sf_dir)
    return cg.reconcile_counts(existing, incoming, ["c_custkey"], "c_nationkey", 5)


@register("i4_replace_keep_if_empty", "SELECT c_custkey, c_name FROM customer")
def i4_replace_keep_if_empty(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return cg.replace(c, c.where(F.col("c_name") == ""), keep_if_empty=True)


@register("i4_replace", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def i4_replace(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    incoming = c.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    return cg.replace(c.select("c_custkey", "c_name"), incoming, keep_if_empty=True)


@register(
    "i5_endpoints_on",
    f"""SELECT arn, id, engine, server FROM ({fx.ENDPOINTS})
        WHERE engine IN ('mysql', 'mariadb', 'aurora', 'postgres', 'aurora-postgresql') AND server = 'db1.example'""",
)
def i5_endpoints_on(spark, sf_dir):
    return cg.endpoints_on(derived.endpoints(spark, sf_dir), "db1.example").select("arn", "id", "engine", "server")


@register(
    "i6_warehouse_tables",
    f"""SELECT database || '.' || schema || '.' || "table" AS name, schema FROM ({fx.CATALOGUE})
        WHERE type = 'TABLE' AND schema IN ('ods', 'stg', 'dim', 'dwd', 'dws', 'met', 'ads')""",
)
def i6_warehouse_tables(spark, sf_dir):
    return cg.warehouse_tables(derived.table_catalogue(spark, sf_dir))


@register(
    "i7_source_tables_postgresql",
    f"""SELECT DISTINCT "table" AS name FROM ({fx.CATALOGUE}) WHERE NOT starts_with("table", 'pg_')""",
)
def i7_source_tables_postgresql(spark, sf_dir):
    return cg.source_tables(derived.table_catalogue(spark, sf_dir), "postgresql")


def _mysql_catalogue(spark, sf_dir):
    """The catalogue as MySQL words it."""
    base = F.when(F.col("type") == "TABLE", F.lit("BASE TABLE")).otherwise(F.col("type"))
    return derived.table_catalogue(spark, sf_dir).withColumn("type", base)


@register(
    "i7_source_tables_mysql",
    f"""SELECT DISTINCT "table" AS name FROM ({fx.CATALOGUE}) WHERE schema = 'ods' AND type = 'TABLE'""",
)
def i7_source_tables_mysql(spark, sf_dir):
    return cg.source_tables(_mysql_catalogue(spark, sf_dir), "mysql", schema="ods")


@register(
    "i7_i2_inventory_then_add",
    f"""WITH c AS (SELECT DISTINCT "table" AS name FROM ({fx.CATALOGUE}) WHERE schema = 'ods' AND type = 'TABLE'),
        known AS (SELECT CASE WHEN hash_no % 2 = 0 THEN name END AS name, hash_no
                  FROM (SELECT name, CAST(regexp_extract(name, '(\\d+)$', 1) AS BIGINT) AS hash_no FROM c) WHERE hash_no % 3 = 0)
        SELECT name, 'stored' AS origin FROM known
        UNION ALL SELECT name, 'new' FROM c WHERE name NOT IN (SELECT name FROM known WHERE name IS NOT NULL)
        UNION ALL SELECT NULL, 'new' WHERE NOT EXISTS (SELECT 1 FROM known WHERE name IS NULL)""",
)
def i7_i2_inventory_then_add(spark, sf_dir):
    """The inventory of I7 (and a null name) added to a stored list that holds
    nulls, twice: the second time adds nothing."""
    names = cg.source_tables(_mysql_catalogue(spark, sf_dir), "mysql", schema="ods")
    number = F.regexp_extract("name", r"(\d+)$", 1).cast("bigint")
    known = names.where(number % 3 == 0).select(F.when(number % 2 == 0, F.col("name")).alias("name"), F.lit("stored").alias("origin"))
    incoming = names.unionByName(spark.range(1).select(F.lit(None).cast("string").alias("name"))).withColumn("origin", F.lit("new"))
    return cg.add_new(cg.add_new(known, incoming, ["name"]), incoming, ["name"])


# The date pattern that ends a snapshot's name, its 23 characters, and the shift to local time (8 hours).
def _snap_sql(start: str, end: str) -> str:
    return f"""
    SELECT cluster, identifier, create_time,
           strftime(create_time + INTERVAL 8 HOUR, '%Y%m%d%H%M') AS create_time_str,
           substr(identifier, 1, length(identifier) - 23)
             || strftime(strptime(substr(identifier, length(identifier) - 22, 19), '%Y-%m-%d-%H-%M-%S')
                         + INTERVAL 8 HOUR, '%Y-%m-%d-%H-%M-%S') AS display_name
    FROM ({fx.SNAPSHOTS})
    WHERE regexp_matches(identifier, '\\d\\d\\d\\d-\\d\\d-\\d\\d-\\d\\d-\\d\\d-\\d\\d-\\d\\d\\d$')
      AND create_time BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'
    """


@register("i8_snapshots", _snap_sql("1997-12-31 16:00:00", "1998-03-31 16:00:00"))
def i8_snapshots(spark, sf_dir):
    return cg.snapshots(derived.snapshots(spark, sf_dir), dt.datetime(2001, 8, 1), "1998/01/01", "1998/03/31")


def _instant_snapshots(spark, sf_dir):
    return derived.snapshots(spark, sf_dir).withColumn("create_time", instant("create_time"))


@register("i8_snapshots_instant", f"""SELECT cluster, identifier, create_time_str, display_name FROM ({_snap_sql("1997-12-31 16:00:00", "1998-03-31 16:00:00")})""")
def i8_snapshots_instant(spark, sf_dir):
    return cg.snapshots(_instant_snapshots(spark, sf_dir), dt.datetime(2001, 8, 1), "1998/01/01", "1998/03/31").drop("create_time")


@register(
    "i9_apply_retention_instant",
    f"""SELECT cluster, identifier FROM ({fx.SNAPSHOTS}) WHERE create_time > TIMESTAMP '1998-04-27 00:00:00'""",
)
def i9_apply_retention_instant(spark, sf_dir):
    return cg.apply_retention(_instant_snapshots(spark, sf_dir), "create_time", dt.datetime(1998, 6, 1)).select("cluster", "identifier")


@register("i8_snapshots_last_35_days", _snap_sql("1998-04-27 00:00:00", "1998-06-01 00:00:00"))
def i8_snapshots_last_35_days(spark, sf_dir):
    return cg.snapshots(derived.snapshots(spark, sf_dir), dt.datetime(1998, 6, 1))


@register(
    "i9_apply_retention",
    f"""SELECT cluster, identifier, create_time FROM ({fx.SNAPSHOTS})
        WHERE create_time > TIMESTAMP '1998-04-27 00:00:00'""",
)
def i9_apply_retention(spark, sf_dir):
    return cg.apply_retention(derived.snapshots(spark, sf_dir), "create_time", dt.datetime(1998, 6, 1))


@register(
    "i8_i2_i9_snapshot_inventory",
    f"""SELECT identifier, create_time FROM (SELECT DISTINCT identifier, create_time
            FROM ({_snap_sql("1998-04-27 00:00:00", "1998-06-01 00:00:00")})) WHERE create_time > TIMESTAMP '1998-05-02 00:00:00'
        UNION ALL SELECT DISTINCT identifier, create_time FROM ({fx.SNAPSHOTS}) s
        WHERE create_time > TIMESTAMP '1998-06-01 00:00:00' AND create_time < TIMESTAMP '1998-06-20 00:00:00'""",
)
def i8_i2_i9_snapshot_inventory(spark, sf_dir):
    """Snapshots listed (I8), added to a stored list (I2), then old ones dropped."""
    every = derived.snapshots(spark, sf_dir)
    between = (F.col("create_time") > F.lit("1998-06-01").cast("timestamp_ntz")) & (F.col("create_time") < F.lit("1998-06-20").cast("timestamp_ntz"))
    stored = every.where(between).select("identifier", "create_time").distinct()
    listed = cg.snapshots(every, dt.datetime(1998, 6, 1)).select("identifier", "create_time")
    return cg.apply_retention(cg.add_new(stored, listed, ["identifier", "create_time"]), "create_time", dt.datetime(1998, 6, 6))


# Fixed value: the pattern that ends the name of a restored cluster.
@register(
    "i10_restored_clusters",
    f"""SELECT identifier FROM ({fx.CLUSTERS}) WHERE regexp_matches(identifier, 'snapshot-\\d{{8}}t\\d{{6}}$')""",
)
def i10_restored_clusters(spark, sf_dir):
    return cg.restored_clusters(derived.clusters(spark, sf_dir))


_SEARCH_FIELDS = ("p_name", "p_type", "p_brand")
_SEARCH_TEXT = 'small bolt -standard -"brand#1[0-9]"'
_SEARCH_REGEX_TEXT = r"bolt -brand#\d[13579]$"


def _search_sql() -> str:
    def some(term):
        return "(" + " OR ".join(f"coalesce(contains(lower({f}), '{term}'), false)" for f in _SEARCH_FIELDS) + ")"

    def none(rx):
        return " AND ".join(f"NOT coalesce(regexp_matches({f}, '(?i){rx}'), false)" for f in _SEARCH_FIELDS)

    return f"""SELECT p_partkey, p_name, p_type, p_brand FROM part
               WHERE {some('small')} AND {some('bolt')} AND {none('standard')} AND {none('brand#1[0-9]')}"""


@register("i11_search", _search_sql())
def i11_search(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select("p_partkey", *_SEARCH_FIELDS)
    return cg.search(part, _SEARCH_FIELDS, _SEARCH_TEXT)


@register(
    "i11_search_regex",
    """SELECT p_partkey, p_name, p_type, p_brand FROM part
       WHERE (contains(lower(p_name), 'bolt') OR contains(lower(p_type), 'bolt') OR contains(lower(p_brand), 'bolt'))
         AND NOT regexp_matches(p_brand, '(?i)brand#[0-9][13579]$')""",
)
def i11_search_regex(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select("p_partkey", *_SEARCH_FIELDS)
    return cg.search(part, _SEARCH_FIELDS, _SEARCH_REGEX_TEXT)


@register(
    "i12_facets",
    """SELECT 'c_mktsegment' AS "column", c_mktsegment AS value, count(*) AS "count" FROM customer GROUP BY 2
       UNION ALL
       SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY 2""",
)
def i12_facets(spark, sf_dir):
    return cg.facets(read_table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"])


@register(
    "i12_pick",
    "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3",
)
def i12_pick(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    return cg.pick(c, {"c_mktsegment": "BUILDING", "c_nationkey": 3}).select("c_custkey", "c_name")


def _as_ts(drill):
    """Period start as a midnight timestamp (the oracle's date_trunc type)."""
    return drill.select(F.col("period").cast("timestamp_ntz").alias("period"), "count")


@register(
    "i13_date_drill_years",
    """SELECT date_trunc('year', o_orderdate) AS period, count(*) AS "count" FROM orders GROUP BY 1""",
)
def i13_date_drill_years(spark, sf_dir):
    return _as_ts(cg.date_drill(read_table(spark, sf_dir, "orders"), "o_orderdate"))


@register(
    "i13_date_drill_months",
    """SELECT date_trunc('month', o_orderdate) AS period, count(*) AS "count" FROM orders
       WHERE year(o_orderdate) = 1997 GROUP BY 1""",
)
def i13_date_drill_months(spark, sf_dir):
    return _as_ts(cg.date_drill(read_table(spark, sf_dir, "orders"), "o_orderdate", year=1997))


@register(
    "i13_date_drill_days",
    """SELECT date_trunc('day', o_orderdate) AS period, count(*) AS "count" FROM orders
       WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 5 GROUP BY 1""",
)
def i13_date_drill_days(spark, sf_dir):
    return _as_ts(cg.date_drill(read_table(spark, sf_dir, "orders"), "o_orderdate", year=1997, month=5))


@register(
    "i13_date_drill_instant",
    """SELECT date_trunc('day', o_orderdate) AS period, count(*) AS "count" FROM orders
       WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 5 GROUP BY 1""",
)
def i13_date_drill_instant(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").withColumn("o_orderdate", instant("o_orderdate"))
    return _as_ts(cg.date_drill(orders, "o_orderdate", year=1997, month=5))


@register("i14_scoped", f"""SELECT * FROM ({fx.CATALOGUE}) WHERE schema = 'ods'""")
def i14_scoped(spark, sf_dir):
    return cg.scoped(derived.table_catalogue(spark, sf_dir), "schema", "ods")


@register(
    "i14_scoped_none",
    f"""SELECT 'none chosen' AS choice, 0 AS "rows" UNION ALL SELECT 'ods', count(*) FROM ({fx.CATALOGUE}) WHERE schema = 'ods'""",
)
def i14_scoped_none(spark, sf_dir):
    cat = derived.table_catalogue(spark, sf_dir)
    size = lambda name, conn: cg.scoped(cat, "schema", conn).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("choice"), "rows")
    return size("none chosen", None).unionByName(size("ods", "ods"))

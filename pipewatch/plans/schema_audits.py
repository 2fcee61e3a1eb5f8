"""Registered schema-conformance audits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pipewatch.operators import schema as sc
from pipewatch.plans import fixtures_sql as fx
from pipewatch.plans.registry import register
from pipewatch.session import work_dir
from pipewatch.sources import derived
from pipewatch.sources.tables import read_table

# The tables profiled, and the serving sort key used.
PROFILED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
SERVING_SORT_KEY = "c_name, o_orderstatus"


def _profile(spark, sf_dir, measure=False):
    frames = {n: read_table(spark, sf_dir, n) for n in PROFILED}
    frames["orders_cdc"] = derived.cdc_source(spark, sf_dir)
    return sc.columns_of(spark, frames, measure=measure)


_IN = ", ".join(f"'{n}'" for n in PROFILED)

# The text columns of the profiled tables (the oracle measures them).
TEXT_COLUMNS = {
    "region": ["r_name"],
    "nation": ["n_name"],
    "customer": ["c_name", "c_mktsegment"],
    "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"],
    "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"],
    "events": ["event_type", "props"],
}
_CDC_TEXT = ["o_orderstatus", "o_orderpriority", "op", "commit_timestamp", "cdc_transact_id", "event_time"]

_LENGTHS_SQL = " UNION ALL ".join(
    [f"SELECT '{t}' AS t, '{c}' AS c, max(length({c})) AS len FROM {t}" for t, cols in TEXT_COLUMNS.items() for c in cols]
    + [f"SELECT 'orders_cdc', '{c}', max(length({c})) FROM ({fx.CDC_SOURCE})" for c in _CDC_TEXT]
)

_TYPES_SQL = f"""
    SELECT table_name AS "table", column_name AS "column", CAST(ordinal_position AS INTEGER) AS position,
           CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'integer'
                WHEN 'VARCHAR' THEN 'character varying' WHEN 'DOUBLE' THEN 'double precision'
                WHEN 'TIMESTAMP' THEN 'timestamp without time zone' ELSE lower(data_type) END AS data_type,
           CAST(CASE data_type WHEN 'BIGINT' THEN 64 WHEN 'INTEGER' THEN 32 WHEN 'DOUBLE' THEN 53 END AS INTEGER) AS precision,
           CAST(CASE WHEN data_type IN ('BIGINT', 'INTEGER') THEN 0 END AS INTEGER) AS scale
    FROM information_schema.columns WHERE table_name IN ({_IN})
"""


def _profile_sql(length: str, join: str = "") -> str:
    return f"""
    SELECT 'public' AS schema, ty."table", ty."column", ty.position, ty.data_type,
           CAST(CASE WHEN ty.data_type = 'character varying' THEN {length} END AS INTEGER) AS char_len,
           ty.precision, ty.scale
    FROM (
        SELECT * FROM ({_TYPES_SQL})
        UNION ALL
        SELECT 'orders_cdc', "column", position, data_type, precision, scale FROM (
            SELECT "column", position, data_type, precision, scale FROM ({_TYPES_SQL}) WHERE "table" = 'orders'
            UNION ALL SELECT 'op', 7, 'character varying', NULL, NULL
            UNION ALL SELECT 'commit_timestamp', 8, 'character varying', NULL, NULL
            UNION ALL SELECT 'cdc_transact_id', 9, 'character varying', NULL, NULL
            UNION ALL SELECT 'event_time', 10, 'character varying', NULL, NULL)
    ) ty {join}
    """


# Text without a declared length has the warehouse's maximum.
_PROFILE_ALL_SQL = _profile_sql("65535")
_MEASURED_SQL = _profile_sql("greatest(coalesce(l.len, 1), 1)", f'LEFT JOIN ({_LENGTHS_SQL}) l ON l.t = ty."table" AND l.c = ty."column"')


@register("c4_columns_of", _PROFILE_ALL_SQL)
def c4_columns_of(spark, sf_dir):
    return _profile(spark, sf_dir)


@register("c4_columns_measured", _MEASURED_SQL)
def c4_columns_measured(spark, sf_dir):
    return _profile(spark, sf_dir, measure=True)


@register(
    "c4_columns_declared",
    """SELECT * FROM (VALUES ('public', 't', 'c_custkey', 1, 'bigint', NULL, 64, 0), ('public', 't', 'c_name', 2, 'character varying', 40, NULL, NULL),
                             ('public', 't', 'c_mktsegment', 3, 'character', 12, NULL, NULL), ('public', 't', 'note', 4, 'character varying', 65535, NULL, NULL))
       v(schema, "table", "column", position, data_type, char_len, precision, scale)""",
)
def c4_columns_declared(spark, sf_dir):
    """Lengths declared in the catalogue, of a table filled from customer."""
    db = f"declared_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{work_dir(spark, 'declared')}'")
    spark.sql(f"CREATE TABLE {db}.t (c_custkey BIGINT, c_name VARCHAR(40), c_mktsegment CHAR(12), note STRING) USING parquet")
    rows = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", F.lit(None).cast("string").alias("note"))
    rows.write.insertInto(f"{db}.t")
    return sc.columns_of(spark, {"t": spark.table(f"{db}.t")})


_CDC_SQL = f"""
    WITH p AS ({_PROFILE_ALL_SQL}),
    m AS (SELECT schema, "table", "column", position,
                 CASE WHEN data_type IN ('smallint', 'integer', 'bigint', 'date', 'timestamp', 'real', 'double precision')
                           THEN data_type
                      WHEN data_type = 'timestamp without time zone' THEN 'timestamp'
                      WHEN data_type = 'numeric' THEN 'numeric(' || precision || ', ' || scale || ')'
                      WHEN data_type IN ('string', 'character varying') AND "column" = 'op' THEN 'char(1)'
                      WHEN data_type IN ('string', 'character varying') THEN 'varchar(' || char_len || ')' END AS cdc_type
          FROM p),
    t AS (SELECT schema, "table", max(position) AS last FROM p GROUP BY 1, 2),
    e AS (SELECT * FROM (VALUES ('commit_timestamp', 1, 'varchar(50)'), ('op', 2, 'char(1)'),
                                ('cdc_transact_id', 3, 'varchar(50)')) v("column", extra, cdc_type))
    SELECT * FROM m WHERE cdc_type IS NOT NULL
    UNION ALL
    SELECT t.schema, t."table", e."column", CAST(t.last + e.extra AS INTEGER), e.cdc_type FROM t, e
    WHERE NOT EXISTS (SELECT 1 FROM p WHERE p."table" = t."table" AND p."column" = e."column")
"""


@register("c1_map_types_cdc", _CDC_SQL)
def c1_map_types_cdc(spark, sf_dir):
    return sc.map_types_cdc(_profile(spark, sf_dir))


@register(
    "c3_map_types_serving",
    f"""SELECT schema, "table", "column", position,
               CASE WHEN data_type = 'character varying'
                         THEN CASE WHEN "column" IN ('c_name', 'o_orderstatus') THEN 'varchar(' || char_len || ')'
                                   ELSE 'string' END
                    WHEN data_type IN ('timestamp without time zone', 'timestamp with time zone') THEN 'datetime'
                    WHEN data_type = 'double precision' THEN 'double'
                    WHEN data_type = 'numeric' THEN 'decimal'
                    ELSE data_type END AS serving_type
        FROM ({_PROFILE_ALL_SQL})""",
)
def c3_map_types_serving(spark, sf_dir):
    return sc.map_types_serving(_profile(spark, sf_dir), SERVING_SORT_KEY)


@register(
    "c2_conform_cdc",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
               op, commit_timestamp, cdc_transact_id, event_time
        FROM ({fx.CDC_SOURCE})""",
)
def c2_conform_cdc(spark, sf_dir):
    src = derived.cdc_source(spark, sf_dir)
    cols = sc.columns_of(spark, {"orders_cdc": src})
    mapping = sc.map_types_cdc(cols).orderBy("position").select("column", "cdc_type").collect()  # one row per column
    conformed = sc.conform_cdc(src, [(r["column"], r["cdc_type"]) for r in mapping])
    path = work_dir(spark, "cdc", "orders")
    sc.write_cdc(conformed, path, mode="overwrite")
    return sc.read_cdc(spark, path, conformed.schema)


@register(
    "c2_files_of_hours",
    f"""SELECT event_time, CAST(1 AS BIGINT) AS files, count(*) AS "rows" FROM ({fx.CDC_SOURCE}) GROUP BY event_time""",
)
def c2_files_of_hours(spark, sf_dir):
    """Files of each hour after a clustered write: one while an hour fits it."""
    src = derived.cdc_source(spark, sf_dir)
    path = work_dir(spark, "cdc", "orders_files")
    sc.write_cdc(sc.conform_cdc(src, [("o_orderkey", "bigint"), ("op", "char(1)")]), path, mode="overwrite")
    return sc.file_counts(spark, path)


# A target that some rows of orders do not fit.
_TIGHT = [("o_orderkey", "bigint"), ("o_orderpriority", "varchar(8)"), ("note", "integer"), ("op", "char(1)")]


def _tight_source(spark, sf_dir):
    """Change rows with a text that is not always a number and an operation
    that is not always one letter."""
    k = F.col("o_orderkey")
    note = F.when(k % 5 == 0, F.lit("n/a")).when(k % 7 == 0, F.lit(None)).otherwise(k.cast("string"))
    return derived.cdc_source(spark, sf_dir).withColumn("note", note).withColumn("op", F.when(k % 11 == 0, F.lit("INSERT")).otherwise(F.col("op")))


_TIGHT_SQL = f"""
    SELECT *, CASE WHEN length(o_orderpriority) > 8 THEN 'o_orderpriority is no varchar(8); ' ELSE '' END
              || CASE WHEN o_orderkey % 5 = 0 THEN 'note is no integer; ' ELSE '' END
              || CASE WHEN o_orderkey % 11 = 0 THEN 'op is no char(1); ' ELSE '' END AS why
    FROM ({fx.CDC_SOURCE})
"""


@register(
    "c2_conform_tight",
    f"""SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END::INTEGER AS note, op, event_time
        FROM ({_TIGHT_SQL}) WHERE why = ''""",
)
def c2_conform_tight(spark, sf_dir):
    return sc.conform_cdc(_tight_source(spark, sf_dir), _TIGHT)


@register("c2_rejects", f"""SELECT o_orderkey, left(why, length(why) - 2) AS reason FROM ({_TIGHT_SQL}) WHERE why <> ''""")
def c2_rejects(spark, sf_dir):
    return sc.split_cdc(_tight_source(spark, sf_dir), _TIGHT)[1].select("o_orderkey", "reason")

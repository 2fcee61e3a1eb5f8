"""Registered replication-statistics audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from pipewatch.functions.names import PARTITION_NAME_RULES, PARTITION_SUFFIX, fold_partition_name, strip_partition_suffix
from pipewatch.operators import stats as st
from pipewatch.plans import fixtures_sql as fx
from pipewatch.plans.registry import register
from pipewatch.sources import derived
from pipewatch.sources.tables import read_table


def _fold_case_sql(col: str, what: str) -> str:
    """DuckDB CASE chain over the same rules (RE2 full match)."""
    parts = []
    for pattern, label in PARTITION_NAME_RULES:
        if what == "base":
            val = f"regexp_extract({col}, '^(?:{pattern})$', 1)"
        else:
            val = f"'{label}'"
        parts.append(f"WHEN regexp_full_match({col}, '{pattern}') THEN {val}")
    default = col if what == "base" else "NULL"
    return "CASE " + " ".join(parts) + f" ELSE {default} END"


@register(
    "r1_fold_partition_name",
    f"""SELECT "table", {_fold_case_sql('"table"', 'base')} AS base, {_fold_case_sql('"table"', 'rule')} AS rule
        FROM ({fx.PHYSICAL_NAMES})""",
)
def r1_fold_partition_name(spark, sf_dir):
    names = derived.physical_table_names(spark, sf_dir)
    return names.select("table", fold_partition_name("table").alias("f")).select("table", "f.base", "f.rule")


# A name of each style (the part after the base) and the rule it must fall under, written out by
# hand.  The last but one shows the order of the rules: year_month_day reads as month then hash.
_STYLES = (
    ("_p1_default", "hash then range (default)"),
    ("_3_2020", "hash then range (year)"),
    ("_p3_202001", "hash then range (month)"),
    ("_12_2020_01_02", "hash then range (day)"),
    ("_default_p3", "range (default) then hash"),
    ("_2020_3", "range (year) then hash"),
    ("_p202001_p12", "range (month) then hash"),
    ("_20200102_3", "range (day) then hash"),
    ("_default", "range (default)"),
    ("_p2020", "range (year)"),
    ("_202001", "range (month)"),
    ("_20200102", "range (day)"),
    ("_p007", "hash"),
    ("_2020_01_02", "range (month) then hash"),
    ("_20200", None),
)


@register(
    "r1_fold_every_rule",
    "SELECT p_partkey, 't' || p_size || '_base' || CASE WHEN rule IS NULL THEN style ELSE '' END AS base, rule FROM part JOIN (VALUES "
    + ", ".join(f"({i}, '{s}', {'NULL' if r is None else repr(r)})" for i, (s, r) in enumerate(_STYLES))
    + f") v(i, style, rule) ON v.i = p_partkey % {len(_STYLES)}",
)
def r1_fold_every_rule(spark, sf_dir):
    styles = F.array(*[F.lit(s) for s, _ in _STYLES])
    style = F.get(styles, (F.col("p_partkey") % len(_STYLES)).cast("int"))
    name = F.concat(F.lit("t"), F.col("p_size").cast("string"), F.lit("_base"), style)
    names = read_table(spark, sf_dir, "part").select("p_partkey", fold_partition_name(name).alias("f"))
    return names.select("p_partkey", "f.base", "f.rule")


@register(
    "r2_strip_partition_suffix",
    f"""SELECT "table", regexp_replace("table", '{PARTITION_SUFFIX}', '') AS name FROM ({fx.PHYSICAL_NAMES})""",
)
def r2_strip_partition_suffix(spark, sf_dir):
    names = derived.physical_table_names(spark, sf_dir)
    return names.select("table", strip_partition_suffix("table").alias("name"))


def _r3_sql(topn: int | None) -> str:
    lim = f"ORDER BY cdc_counts DESC, table_name LIMIT {topn}" if topn else ""
    return f"""
    WITH st AS ({fx.TABLE_STATS}), t AS ({fx.TASKS}), e AS ({fx.ENDPOINTS}),
    f AS (SELECT task_arn, schema, {_fold_case_sql('"table"', 'base')} AS base,
                 inserts + updates + deletes AS cdc, seen_no
          FROM st WHERE inserts + updates + deletes > 0),
    j AS (SELECT CASE WHEN coalesce(e.database, '') <> '' THEN e.database || '.' ELSE '' END
                 || f.schema || '.' || f.base AS table_name, f.cdc, f.seen_no, t.task_id, t.started
          FROM f JOIN t ON f.task_arn = t.arn LEFT JOIN e ON t.source_arn = e.arn)
    SELECT table_name, CAST(sum(cdc) AS BIGINT) AS cdc_counts,
           arg_min(started, (seen_no, task_id)) AS start_date, arg_min(task_id, (seen_no, task_id)) AS task
    FROM j GROUP BY table_name {lim}
    """


def _r3(spark, sf_dir, topn):
    return st.change_counts(
        derived.table_stats(spark, sf_dir), derived.tasks(spark, sf_dir), derived.endpoints(spark, sf_dir), topn=topn
    )


@register("r3_change_counts_top20", _r3_sql(20))
def r3_change_counts_top20(spark, sf_dir):
    return _r3(spark, sf_dir, 20)


@register("r3_change_counts_export", _r3_sql(None))
def r3_change_counts_export(spark, sf_dir):
    return _r3(spark, sf_dir, None)


@register(
    "r4_tables_per_task",
    f"""WITH st AS ({fx.TABLE_STATS}), t AS ({fx.TASKS})
        SELECT t.task_id, CAST(count(st.task_arn) AS BIGINT) AS tables
        FROM t LEFT JOIN st ON st.task_arn = t.arn GROUP BY t.task_id ORDER BY tables DESC, task_id LIMIT 10""",
)
def r4_tables_per_task(spark, sf_dir):
    return st.tables_per_task(derived.tasks(spark, sf_dir), derived.table_stats(spark, sf_dir))


@register(
    "r4_tables_per_task_all",
    f"""WITH st AS ({fx.TABLE_STATS}), t AS ({fx.TASKS})
        SELECT t.task_id, CAST(count(st.task_arn) AS BIGINT) AS tables
        FROM t LEFT JOIN st ON st.task_arn = t.arn GROUP BY t.task_id""",
)
def r4_tables_per_task_all(spark, sf_dir):
    return st.tables_per_task(derived.tasks(spark, sf_dir), derived.table_stats(spark, sf_dir), topn=None)


@register(
    "r5_tasks_with_table",
    f"""WITH st AS ({fx.TABLE_STATS}), t AS ({fx.TASKS})
        SELECT task_id, arn, 'returns_r' AS table_name FROM t
        WHERE EXISTS (SELECT 1 FROM st WHERE st.task_arn = t.arn AND contains(st."table", 'returns_r'))
          AND task_id NOT IN (SELECT task_id FROM t WHERE status = 'running' AND contains(task_id, '-1'))""",
)
def r5_tasks_with_table(spark, sf_dir):
    tasks = derived.tasks(spark, sf_dir)
    known = tasks.where(F.col("status") == "running")
    found = st.tasks_with_table(tasks, derived.table_stats(spark, sf_dir), "returns_r", known=known, purge_suffix="-1")
    return found.select("task_id", "arn", "table_name")


@register(
    "r5_purged_known",
    f"""SELECT task_id FROM ({fx.TASKS}) WHERE status = 'running' AND contains(task_id, '-1')""",
)
def r5_purged_known(spark, sf_dir):
    known = derived.tasks(spark, sf_dir).where(F.col("status") == "running")
    return st.purged_known(known, "-1").select("task_id")


@register(
    "r6_new_logical_tables",
    f"""WITH st AS ({fx.TABLE_STATS}),
        c AS (SELECT DISTINCT task_arn, regexp_replace("table", '{PARTITION_SUFFIX}', '') AS name, schema FROM st),
        k AS (SELECT DISTINCT task_arn, name FROM c WHERE schema = 'sch0' AND name LIKE 'order%')
        SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.task_arn = c.task_arn AND k.name = c.name)""",
)
def r6_new_logical_tables(spark, sf_dir):
    stats = derived.table_stats(spark, sf_dir)
    known = (
        stats.where((F.col("schema") == "sch0"))
        .select("task_arn", strip_partition_suffix("table").alias("name"), "schema")
        .where(F.col("name").startswith("order"))
    )
    return st.new_logical_tables(stats, known)


@register(
    "r7_tasks_of_endpoint",
    f"""WITH t AS ({fx.TASKS})
        SELECT task_id, source_arn, target_arn FROM t
        WHERE (source_arn = 'arn:ep:3' OR target_arn = 'arn:ep:3') AND status <> 'running'""",
)
def r7_tasks_of_endpoint(spark, sf_dir):
    tasks = derived.tasks(spark, sf_dir)
    known = tasks.where(F.col("status") == "running")
    return st.tasks_of_endpoint(tasks, "arn:ep:3", known).select("task_id", "source_arn", "target_arn")

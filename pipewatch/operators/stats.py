"""Replication statistics: change counts per logical table, tables per task,
task and table discovery.

Inputs (FIXTURES.md): *tasks* ``task_id, arn, source_arn, target_arn,
status, ...``; *endpoints* ``arn, id, type, engine, ..., database,
server``; *table statistics* ``task_arn, schema, table, inserts, updates,
deletes, seen_no`` (``seen_no`` = the order in which the API lists rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewatch.functions.names import fold_partition_name, strip_partition_suffix

# Report sizes.
CHANGE_COUNTS_TOPN = 20
TABLES_PER_TASK_TOPN = 10


def change_counts(
    stats: DataFrame,
    tasks: DataFrame,
    endpoints: DataFrame,
    topn: int | None = CHANGE_COUNTS_TOPN,
    endpoint_arns: Sequence[str] | None = None,
) -> DataFrame:
    """Change counts per logical table.

    Physical rows with ``inserts + updates + deletes > 0`` are folded to
    their logical name (R1), prefixed ``<database>.`` of the task's source
    endpoint when that database is non-empty, and summed.  ``start_date``
    and ``task`` come from the first row seen (smallest ``seen_no``, ties
    broken by task id).
    Sorted by ``cdc_counts`` descending (ties by name); ``topn`` None gives
    the full export.  ``endpoint_arns`` keeps tasks touching those endpoints.

    Plan: the statistics are pre-aggregated per (task, schema, base) before
    any join (partial aggregation, so a hot task is combined map-side), then
    joined to tasks and endpoints (sizes left to the optimizer/AQE), then
    aggregated per logical name with ``min_by``.
    """
    cdc = F.col("inserts") + F.col("updates") + F.col("deletes")
    folded = stats.select(
        "task_arn",
        "schema",
        fold_partition_name("table").getField("base").alias("base"),
        cdc.alias("cdc"),
        "seen_no",
    ).where(F.col("cdc") > 0)
    pre = folded.groupBy("task_arn", "schema", "base").agg(
        F.sum("cdc").alias("cdc"), F.min("seen_no").alias("seen_no")
    )
    t = tasks
    if endpoint_arns is not None:
        arns = list(endpoint_arns)
        t = t.where(F.col("source_arn").isin(arns) | F.col("target_arn").isin(arns))
    t = t.select(F.col("arn").alias("task_arn"), "task_id", "started", "source_arn")
    e = endpoints.select(F.col("arn").alias("source_arn"), "database")
    joined = pre.join(t, "task_arn").join(e, "source_arn", "left")
    db = F.when(F.coalesce(F.col("database"), F.lit("")) != "", F.concat(F.col("database"), F.lit("."))).otherwise("")
    name = F.concat(db, F.col("schema"), F.lit("."), F.col("base"))
    out = (
        joined.groupBy(name.alias("table_name"))
        .agg(
            F.sum("cdc").alias("cdc_counts"),
            F.min_by(F.struct("started", "task_id"), F.struct("seen_no", "task_id")).alias("__first"),
        )
        .select(
            "table_name",
            "cdc_counts",
            F.col("__first.started").alias("start_date"),
            F.col("__first.task_id").alias("task"),
        )
    )
    if topn is None:
        return out
    return out.orderBy(F.col("cdc_counts").desc(), F.col("table_name")).limit(topn)


def tables_per_task(tasks: DataFrame, stats: DataFrame, topn: int | None = TABLES_PER_TASK_TOPN) -> DataFrame:
    """Number of statistics rows per task, largest first (ties by task
    id); a task without rows counts 0.  Counts are aggregated before the
    left join, so a hot task never lands whole on one join task."""
    counts = stats.groupBy("task_arn").agg(F.count(F.lit(1)).alias("tables"))
    joined = tasks.join(counts, tasks["arn"] == counts["task_arn"], "left")
    out = joined.select("task_id", F.coalesce(F.col("tables"), F.lit(0)).cast("bigint").alias("tables"))
    if topn is None:
        return out
    return out.orderBy(F.col("tables").desc(), F.col("task_id")).limit(topn)


def tasks_with_table(
    tasks: DataFrame,
    stats: DataFrame,
    text: str,
    known: DataFrame | None = None,
    purge_suffix: str | None = None,
) -> DataFrame:
    """Tasks with at least one table whose name contains ``text``
    (case-sensitive), each task once (``left_semi``).  With ``known`` (the
    stored task list, column ``task_id``) only new tasks are returned; the
    stored list is first purged of ids that do not contain ``purge_suffix``
    (:func:`purged_known` gives the purged list, to store it).
    """
    hits = stats.where(F.col("table").contains(text)).select("task_arn")
    found = tasks.join(hits, tasks["arn"] == hits["task_arn"], "left_semi").withColumn("table_name", F.lit(text))
    if known is not None:
        found = found.join(purged_known(known, purge_suffix).select("task_id"), "task_id", "left_anti")
    return found


def purged_known(known: DataFrame, purge_suffix: str | None = None) -> DataFrame:
    """The stored task list after R5's purge: only ids that contain
    ``purge_suffix`` stay (all of them without one; a null id goes)."""
    return known.where(F.col("task_id").contains(purge_suffix)) if purge_suffix else known


def new_logical_tables(stats: DataFrame, known: DataFrame, task_arn: str | None = None) -> DataFrame:
    """Distinct ``(task_arn, name, schema)`` with ``name`` = short fold
    (R2) of the table, leaving out those already known.  "Known" compares
    ``(task_arn, name)`` only, not the schema (kept on purpose)."""
    s = stats if task_arn is None else stats.where(F.col("task_arn") == task_arn)
    cand = s.select("task_arn", strip_partition_suffix("table").alias("name"), "schema").distinct()
    return cand.join(known.select("task_arn", "name").distinct(), ["task_arn", "name"], "left_anti")


def tasks_of_endpoint(tasks: DataFrame, endpoint_arn: str, known: DataFrame | None = None) -> DataFrame:
    """Tasks whose source or target is ``endpoint_arn``; with ``known``
    (column ``task_id``) only those not stored yet."""
    found = tasks.where((F.col("source_arn") == endpoint_arn) | (F.col("target_arn") == endpoint_arn))
    if known is not None:
        found = found.join(known.select("task_id"), "task_id", "left_anti")
    return found

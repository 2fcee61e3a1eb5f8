"""Inventory, reconciliation and search over catalogue rows (tasks,
endpoints, tables, snapshots, clusters).

Refresh operators return the new inventory as a DataFrame; writing it is a
separate, explicit step (:func:`write_inventory`)."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipewatch.functions.times import format_ntz, parse_ntz, ts_literal, utc_wall

# Engines and schemas the inventories keep, and snapshot rules.
SOURCE_ENGINES = ("mysql", "mariadb", "aurora", "postgres", "aurora-postgresql")
WAREHOUSE_SCHEMAS = ("ods", "stg", "dim", "dwd", "dws", "met", "ads")
BASE_TABLE_TYPES = ("BASE TABLE", "TABLE")
SNAPSHOT_ID_PATTERN = r"\d\d\d\d-\d\d-\d\d-\d\d-\d\d-\d\d-\d\d\d$"
RESTORED_CLUSTER_PATTERN = r"snapshot-\d{8}t\d{6}$"
SNAPSHOT_RETENTION_DAYS = 35
LOCAL_OFFSET_HOURS = 8


# ------------------------------------------------------------------------- I1
def full_refresh(endpoints: DataFrame, tasks: DataFrame, stats: DataFrame) -> dict[str, DataFrame]:
    """Replace endpoints, tasks and tables in one go.

    Each task is joined to its source *and* target endpoint by ARN; the JSON
    settings and mappings are parsed (variant).  A task whose endpoint is
    missing, a table whose task is missing, or settings that are not JSON
    fail the job when it is run (inside the plan - no extra pass to check
    first).
    Returns ``{"endpoints", "tasks", "tables"}``."""
    src = endpoints.select(
        F.col("arn").alias("source_arn"),
        F.col("id").alias("source_id"),
        F.col("engine").alias("source_engine"),
        F.col("database").alias("source_database"),
    )
    tgt = endpoints.select(
        F.col("arn").alias("target_arn"),
        F.col("id").alias("target_id"),
        F.col("engine").alias("target_engine"),
    )
    joined = tasks.join(src, "source_arn", "left").join(tgt, "target_arn", "left")
    missing = F.col("source_id").isNull() | F.col("target_id").isNull()
    error = F.raise_error(F.concat(F.lit("endpoint missing for task "), F.col("task_id")))
    guarded = joined.where(~missing | error.isNull())
    guarded = guarded.withColumn("settings", F.parse_json("settings")).withColumn("mappings", F.parse_json("mappings"))
    t_ids = tasks.select(F.col("arn").alias("task_arn"), F.col("task_id").alias("task_name"))
    tables = stats.select("task_arn", F.col("table").alias("name"), "schema").join(t_ids, "task_arn", "left")
    tables = tables.where(
        F.col("task_name").isNotNull() | F.raise_error(F.concat(F.lit("task missing: "), F.col("task_arn"))).isNull()
    )
    return {"endpoints": endpoints, "tasks": guarded, "tables": tables}


def write_inventory(frames: Mapping[str, DataFrame], root: str) -> None:
    """Replace each inventory under ``root/<name>`` (parquet, overwrite)."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")


# ------------------------------------------------------------------------- I2
def _one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key (null is a value): of rows that share a key the one
    whose other columns come first as JSON text."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*rest)
    picked = df.groupBy(*keys).agg(F.min_by(row, F.to_json(row, {"ignoreNullFields": "false"})).alias("__r"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"__r.`{c}`").alias(c) for c in df.columns])


def _match(keys: Sequence[str], prefix: str = "__k_") -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(prefix + k))
    return cond


def add_new(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-only refresh: rows of ``incoming`` whose key is absent from
    ``existing`` are added; existing rows are never changed.  A null in a key
    is a value like any other, so a second refresh adds nothing."""
    return existing.unionByName(added_rows(existing, incoming, keys), allowMissingColumns=True)


def added_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = list(keys)
    have = existing.select(*[F.col(k).alias(f"__k_{k}") for k in keys])
    return _one_per_key(incoming, keys).join(have, _match(keys), "left_anti")


# ------------------------------------------------------------------------- I3
def reconcile(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], scope: str, scope_value
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reconcile within a scope (e.g. one server).

    ``incoming`` is the remote list for ``scope == scope_value``.  In the
    scope, new keys are added and vanished keys deleted; rows present on both
    sides and rows outside the scope are left as they are.  A null in a key is
    a value like any other.  Returns ``(result, added, removed)``; applying it
    twice changes nothing.  One full outer join on the key marks every row."""
    keys = list(keys)
    marked = _reconciled(existing, incoming, keys, scope, scope_value)
    cols = list(dict.fromkeys([*existing.columns, *incoming.columns]))
    side = lambda s, names: [F.col(f"{s}.`{c}`").alias(c) for c in names]
    both = [
        F.when(F.col("__e").isNotNull(), F.col(f"__e.`{c}`") if c in existing.columns else F.lit(None))
        .otherwise(F.col(f"__i.`{c}`") if c in incoming.columns else F.lit(None))
        .alias(c)
        for c in cols
    ]
    result = marked.where("__state <> 'removed'").select(*both)
    added = marked.where("__state = 'added'").select(*side("__i", incoming.columns))
    removed = marked.where("__state = 'removed'").select(*side("__e", existing.columns))
    return result, added, removed


def _reconciled(existing: DataFrame, incoming: DataFrame, keys: list[str], scope: str, scope_value) -> DataFrame:
    """``__e`` and ``__i`` (existing and incoming row, null if absent) and
    ``__state``: kept, added or removed."""
    inc = _one_per_key(incoming.where(F.col(scope) == F.lit(scope_value)), keys)
    left = existing.select(*keys, F.struct(*[F.col(c) for c in existing.columns]).alias("__e"))
    right = inc.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.struct(*[F.col(c) for c in inc.columns]).alias("__i"))
    inside = F.coalesce(F.col(f"__e.`{scope}`") == F.lit(scope_value), F.lit(False))
    state = F.when(F.col("__e").isNull(), "added").when(inside & F.col("__i").isNull(), "removed").otherwise("kept")
    return left.join(right, _match(keys), "full").select("__e", "__i", state.alias("__state"))


def reconcile_counts(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], scope: str, scope_value) -> DataFrame:
    """One row: ``added, removed`` of :func:`reconcile`."""
    marked = _reconciled(existing, incoming, list(keys), scope, scope_value)
    state = F.col("__state")
    return marked.agg(F.count_if(state == "added").alias("added"), F.count_if(state == "removed").alias("removed"))


# ------------------------------------------------------------------------- I4
def replace(existing: DataFrame, incoming: DataFrame, keep_if_empty: bool = False) -> DataFrame:
    """Swap the whole list; with ``keep_if_empty`` an empty ``incoming``
    keeps ``existing`` (one ``isEmpty`` action, which reads one row)."""
    if keep_if_empty and incoming.isEmpty():
        return existing
    return incoming


# ------------------------------------------------------------------- I5 - I7
def endpoints_on(df: DataFrame, server: str, engines: Sequence[str] = SOURCE_ENGINES) -> DataFrame:
    """Endpoints of one server (exact name) with one of ``engines``."""
    return df.where(F.col("engine").isin(list(engines)) & (F.col("server") == F.lit(server)))


def warehouse_tables(cat: DataFrame, schemas: Sequence[str] = WAREHOUSE_SCHEMAS) -> DataFrame:
    """Base tables of the listed schemas as ``name = db.schema.table``."""
    return cat.where((F.col("type") == "TABLE") & F.col("schema").isin(list(schemas))).select(
        F.concat_ws(".", "database", "schema", "table").alias("name"), "schema"
    )


def source_tables(cat: DataFrame, kind: str, schema: str | None = None, base_types: Sequence[str] = BASE_TABLE_TYPES) -> DataFrame:
    """Table names of a source database: PostgreSQL drops ``pg_`` names
    (every schema); MySQL keeps base tables of ``schema`` (its catalogue says
    ``BASE TABLE``; ``TABLE`` is taken too).  Distinct."""
    if kind == "postgresql":
        out = cat.where(~F.col("table").startswith("pg_"))
    elif kind == "mysql":
        out = cat.where((F.col("schema") == F.lit(schema)) & F.col("type").isin(list(base_types)))
    else:
        raise ValueError(f"unknown source kind {kind!r}")
    return out.select(F.col("table").alias("name")).distinct()


# ------------------------------------------------------------------- I8 - I10
def _start_end(now, start_date, end_date, offset_hours, retention_days):
    if start_date is not None:
        start = dt.datetime.strptime(start_date, "%Y/%m/%d") - dt.timedelta(hours=offset_hours)
    else:
        start = now - dt.timedelta(days=retention_days)
    if end_date is not None:
        end = dt.datetime.strptime(end_date, "%Y/%m/%d") + dt.timedelta(hours=24 - offset_hours)
    else:
        end = now
    return start, end


def snapshots(
    df: DataFrame,
    now: dt.datetime,
    start_date: str | None = None,
    end_date: str | None = None,
    offset_hours: int = LOCAL_OFFSET_HOURS,
    retention_days: int = SNAPSHOT_RETENTION_DAYS,
) -> DataFrame:
    """Automated snapshots (identifier ends ``yyyy-MM-dd-HH-mm-ss-SSS``)
    created in the local-date window: local ``start_date`` 00:00 to local
    ``end_date`` 24:00 (``yyyy/MM/dd``; defaults: the last 35 days up to
    ``now``).  Adds ``create_time_str`` (local ``yyyyMMddHHmm``) and
    ``display_name`` (identifier with its time stamp in local time; the 23
    stamp characters are replaced, not 19)."""
    start, end = _start_end(now, start_date, end_date, offset_hours, retention_days)
    ttype = df.schema["create_time"].dataType
    ident = F.col("identifier")
    local = F.timestamp_add("HOUR", F.lit(offset_hours), utc_wall("create_time", ttype))
    stamp = parse_ntz(F.substring(ident, -23, 19), "yyyy-MM-dd-HH-mm-ss")
    shown = format_ntz(F.timestamp_add("HOUR", F.lit(offset_hours), stamp), "yyyy-MM-dd-HH-mm-ss")
    display = F.concat(F.expr("substring(identifier, 1, length(identifier) - 23)"), shown)
    return df.where(
        ident.rlike(SNAPSHOT_ID_PATTERN) & F.col("create_time").between(ts_literal(start, ttype), ts_literal(end, ttype))
    ).select(
        "cluster",
        "identifier",
        "create_time",
        format_ntz(local, "yyyyMMddHHmm").alias("create_time_str"),
        display.alias("display_name"),
    )


def apply_retention(df: DataFrame, ts: str, now: dt.datetime, days: int = SNAPSHOT_RETENTION_DAYS) -> DataFrame:
    """Drop rows ``days`` old or more (kept: ``ts > now - days``)."""
    ttype = df.schema[ts].dataType
    return df.where(F.col(ts) > ts_literal(now - dt.timedelta(days=days), ttype))


def restored_clusters(df: DataFrame, ident: str = "identifier") -> DataFrame:
    """Clusters restored from a snapshot (identifier ends
    ``snapshot-<8 digits>t<6 digits>``)."""
    return df.where(F.col(ident).rlike(RESTORED_CLUSTER_PATTERN))


# ------------------------------------------------------------------------ I11
_TERM = re.compile(r"""(-?)(?:"([^"]*)"(?!\S)|'([^']*)'(?!\S)|(\S*))""")


def parse_search(text: str) -> tuple[list[str], list[str]]:
    """(plain terms, excluded terms): separated by white space; a term in
    matched quotes may hold white space; a leading ``-`` marks an exclusion.
    Backslashes stay (exclusions are regexes) and an unmatched quote is a
    character like any other."""
    plain, minus = [], []
    for sign, double, single, bare in _TERM.findall(text or ""):
        term = double or single or bare
        if sign and term:
            minus.append(term)
        elif term or sign:
            plain.append(term or sign)
    return plain, minus


def search(df: DataFrame, fields: Sequence[str], text: str) -> DataFrame:
    """Admin-style search: every plain term occurs (case-insensitively) in
    *some* field; rows where *any* field matches an excluded term as a
    case-insensitive regex are dropped.  Null fields never match."""
    plain, minus = parse_search(text)
    cond: Column = F.lit(True)
    for term in plain:
        low = term.lower()
        any_field = F.lit(False)
        for f in fields:
            any_field = any_field | F.coalesce(F.lower(F.col(f)).contains(low), F.lit(False))
        cond = cond & any_field
    for term in minus:
        for f in fields:
            cond = cond & ~F.coalesce(F.col(f).rlike("(?iu)" + term), F.lit(False))
    return df.where(cond)


# ------------------------------------------------------------------------ I12
def facets(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values and counts of each listed column: ``column, value, count``.

    One scan with ``GROUPING SETS`` (an Expand feeding a partial hash
    aggregate), not one scan per column."""
    cols = list(cols)
    staged = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    agg = staged.groupingSets([[c] for c in cols], *cols).agg(
        F.count(F.lit(1)).alias("count"), F.grouping_id().alias("__g")
    )
    n = len(cols)
    name = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for i, c in enumerate(cols):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))
        name = F.when(F.col("__g") == gid, F.lit(c)).otherwise(name)
        value = F.when(F.col("__g") == gid, F.col(c)).otherwise(value)
    return agg.select(name.alias("column"), value.alias("value"), F.col("count"))


def pick(df: DataFrame, choices: Mapping[str, object]) -> DataFrame:
    """Filter by chosen facet values (equality on each listed column; the
    value None picks nulls, which :func:`facets` counts)."""
    cond = F.lit(True)
    for c, v in choices.items():
        cond = cond & F.col(c).eqNullSafe(F.lit(v))
    return df.where(cond)


# ------------------------------------------------------------------------ I13
def date_drill(df: DataFrame, ts: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """Date hierarchy: counts per year; given a year, per month of it; given
    a month too, per day.  Output ``period date, count``.  The chosen year
    or month is a range on the stored column (so the scan can skip row
    groups), not a function of it."""
    c = F.col(ts)
    ttype = df.schema[ts].dataType
    out = df
    if year is None:
        level = "year"
    elif month is None:
        out = out.where((c >= ts_literal(dt.datetime(year, 1, 1), ttype)) & (c < ts_literal(dt.datetime(year + 1, 1, 1), ttype)))
        level = "month"
    else:
        nxt = dt.datetime(year + (month == 12), month % 12 + 1, 1)
        out = out.where((c >= ts_literal(dt.datetime(year, month, 1), ttype)) & (c < ts_literal(nxt, ttype)))
        level = "day"
    day = F.to_date(utc_wall(c, ttype))  # the UTC date; no session zone involved
    period = day if level == "day" else F.trunc(day, level)
    return out.groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("count"))


# ------------------------------------------------------------------------ I14
def scoped(df: DataFrame, conn_col: str, conn) -> DataFrame:
    """Rows of one connection; no connection chosen gives no rows."""
    if conn is None:
        return df.where(F.lit(False))
    return df.where(F.col(conn_col) == F.lit(conn))

"""Loads, backfill and copies: backfill by anti-join, Parquet unload and
labelled load, load status, the three serving-table models, table copies
out of a snapshot, table heads and mapping-driven replication."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipewatch.plans.keyfilter import key_filter, possible

# CDC partition rule, serving-table buckets, copy naming.
MIN_EVENT_TIME_LENGTH = 13  # "yyyy/MM/dd/HH"
SERVING_BUCKETS = 3
RESTORE_SCHEMA = "temp"
RESTORE_STAMP = "%Y%m%d%H%M"
LOCAL_OFFSET_HOURS = 8
HEAD_ROWS = 3
#: Files whose numbers a load broadcasts (some 200 bytes each).
LISTED_FILES = 100_000
SKIP_DATABASES = ("information_schema", "test", "doris_audit_db__")
SKIP_DATABASE_PREFIX = "rs_"
MODELS = ("detail", "unique", "aggregate")
MAPPING_MODES = ("schema", "data")


# ------------------------------------------------------------------------- L1
def backfill_columns(src: DataFrame, tgt: DataFrame) -> list[str]:
    """Sorted column intersection of source and target (must not be empty)."""
    cols = sorted(set(src.columns) & set(tgt.columns))
    if not cols:
        raise ValueError("source and target share no column")
    return cols


def backfill(src: DataFrame, tgt: DataFrame, lo: str, hi: str, key: str = "id", event_time: str = "event_time") -> DataFrame:
    """Rows to append to ``tgt``: source rows of whole-hour partitions
    (``length(event_time) >= 13``) with ``lo <= event_time <= hi`` (string
    bounds, so a partitioned source prunes partitions), whose ``key`` is not
    in the target, projected to the sorted common columns.  A null key is
    always appended (it never equals a target key).  Applying the result and
    running again yields nothing.  The anti join is left to the optimizer:
    broadcast when the target's key column is small, sort-merge otherwise."""
    cols = backfill_columns(src, tgt)
    if key not in cols:
        raise ValueError(f"key {key!r} is not a common column")
    et = F.col(event_time)
    cand = src.where((F.length(et) >= MIN_EVENT_TIME_LENGTH) & et.between(lo, hi)).select(*cols)
    return cand.join(tgt.select(key), key, "left_anti")


#: Key types whose equal values have equal hashes (floating zeros do not).
_HASHED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType)


def _hashed(t: T.DataType) -> bool:
    return isinstance(t, _HASHED) or t == T.StringType()


def thinned_keys(cand: DataFrame, tgt: DataFrame, key: str, count: int | None = None) -> DataFrame:
    """The keys of ``tgt`` that can be among those of ``cand`` (all that are,
    and some that are not), by a key filter of at most 16 MB whatever either
    side holds.  ``count``: about how many rows ``cand`` has; counted if not
    given.  Keys of unlike types, or of a type whose equal values may differ
    in their bytes, are not thinned."""
    kind = cand.schema[key].dataType
    keys = tgt.select(key)
    if kind != tgt.schema[key].dataType or not _hashed(kind):
        return keys
    h = F.xxhash64(F.col(f"`{key}`"))
    known = cand.where(F.col(f"`{key}`").isNotNull()).select(key)
    return possible(keys.where(F.col(f"`{key}`").isNotNull()), h, key_filter(known, h, known.count() if count is None else count))


def backfill_thinned(src: DataFrame, tgt: DataFrame, lo: str, hi: str, key: str = "id", event_time: str = "event_time", count: int | None = None) -> DataFrame:
    """The rows of :func:`backfill`, for a few hours into a large table: a key
    filter of the hours' keys leaves of the target only the keys that may be
    met, before anything of it is shuffled.  The exact anti join follows.  The
    hours' keys are read twice, and a third time where ``count`` is not
    given."""
    cols = backfill_columns(src, tgt)
    if key not in cols:
        raise ValueError(f"key {key!r} is not a common column")
    et = F.col(event_time)
    cand = src.where((F.length(et) >= MIN_EVENT_TIME_LENGTH) & et.between(lo, hi)).select(*cols)
    return cand.join(thinned_keys(cand, tgt, key, count), key, "left_anti")


def append(df: DataFrame, path: str) -> None:
    """Append rows to a Parquet table folder in the table's own columns and
    types: columns that ``df`` lacks are null, columns that the table lacks
    are an error.  Reading the folder back gives all its columns, whichever
    file Spark takes the schema from.  A folder that does not exist yet is
    created with the columns of ``df``."""
    from pyspark.errors import AnalysisException

    spark = df.sparkSession
    try:
        target = spark.read.parquet(path).schema
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        target = df.schema
    unknown = [c for c in df.columns if c not in target.names]
    if unknown:
        raise ValueError(f"the table has no column {unknown}")
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields]
    df.select(*cols).write.mode("append").parquet(path)


# ------------------------------------------------------------------- L2, L3
def unload(df: DataFrame, path: str) -> None:
    """Write ``df`` to ``path`` as Parquet, replacing what was there."""
    df.write.mode("overwrite").parquet(path)


@contextmanager
def open_writers(spark: SparkSession, most: int = 100) -> Iterator[None]:
    """Partitioned writes inside keep a file open for each partition folder
    (up to ``most`` a task) instead of sorting their rows by folder; the
    session's setting is back afterwards."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def load(spark: SparkSession, path: str, cols: Sequence[str], label: str, attempt: int = 1) -> DataFrame:
    """Read the Parquet files under ``path`` (the exact folder, not a name
    prefix; partition folders included) with a fixed column list; every row
    carries the label of its file, ``<label>__<attempt>__<n>``, ``n`` counting
    all Parquet files from 1 in the order of their full paths, those without
    rows too.

    Files are told apart by their whole path, so equal names in different
    partition folders stay apart.  The numbers come from the scan's own file
    listing (which Spark holds for planning anyway), one row per file, and are
    broadcast up to ``LISTED_FILES``: a shuffle by file would sort all rows of
    a file in one task."""
    stored_rows = spark.read.parquet(path)
    local = lambda c: F.regexp_replace(c, "^file:/+", "file:/")  # noqa: E731 - the scan and the listing write local paths differently
    staged = stored_rows.select(*cols, local(F.col("_metadata.file_path")).alias("__file"))
    files = stored_rows.inputFiles()
    listed = spark.createDataFrame([(f,) for f in files], "__file string")
    numbers = listed.select(local(F.col("__file")).alias("__file")).distinct().withColumn("__n", F.row_number().over(Window.orderBy("__file")))
    if len(files) <= LISTED_FILES:
        numbers = F.broadcast(numbers)
    tag = F.concat(F.lit(f"{label}__{attempt}__"), F.col("__n").cast("string"))
    return staged.join(numbers, "__file").select(*cols, tag.alias("label"))


# ------------------------------------------------------------------------- L4
def load_status(log: DataFrame, label: str = "label", state: str = "state", time: str = "create_time") -> DataFrame:
    """Latest entry of each label by create time (ties: larger state), a
    partial aggregate with ``max_by`` - no sort of the whole log."""
    latest = F.max_by(F.struct(F.col(state).alias("state"), F.col(time).alias("create_time")), F.struct(time, state))
    return log.groupBy(label).agg(latest.alias("__l")).select(label, "__l.state", "__l.create_time")


# ------------------------------------------------------------------------- L5
def apply_model(
    df: DataFrame,
    model: str,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    aggs: Sequence[Column] | None = None,
) -> DataFrame:
    """Rows a serving table of the given model holds.

    * ``detail``: every row (duplicate keys kept);
    * ``unique``: the last row of each key in load ``order``;
    * ``aggregate``: rows of a key merged with ``aggs`` (required).

    ``unique`` uses ``max_by`` in a grouped aggregate (partial aggregation,
    so a hot key is merged map-side rather than sorted on one task)."""
    keys = list(keys)
    if model == "detail":
        return df
    if model == "unique":
        if not order:
            raise ValueError("unique model needs a load order")
        rest = [c for c in df.columns if c not in keys]
        last = F.max_by(F.struct(*rest), F.struct(*order))
        return df.groupBy(*keys).agg(last.alias("__last")).select(*keys, *[F.col(f"__last.{c}") for c in rest])
    if model == "aggregate":
        if not aggs:
            raise ValueError("aggregate model needs aggregate functions")
        return df.groupBy(*keys).agg(*aggs)
    raise ValueError(f"unknown model {model!r}; expected one of {MODELS}")


def write_model(
    df: DataFrame,
    table: str,
    model: str,
    sort_key: Sequence[str],
    bucket_key: Sequence[str] | None,
    order: Sequence[str] | None = None,
    aggs: Sequence[Column] | None = None,
    buckets: int = SERVING_BUCKETS,
    merge: Sequence[Column] | None = None,
) -> None:
    """Load rows into a serving table of the given model, hash-bucketed on
    ``bucket_key`` (required) and sorted by the sort key.

    A table that does not exist is created.  An existing one is loaded on:
    ``detail`` appends; ``unique`` keeps the last row of each key over the
    stored rows and the load; ``aggregate`` merges the stored rows with the
    aggregated load by ``merge`` (aggregates over the table's own columns,
    such as ``sum(total) AS total``; required then).  Merged rows are written
    aside and swapped in, so a failed load leaves the table as it was.

    ``buckets`` defaults to the serving table's 3; a large table wants a
    count that gives bucket files of roughly 128 MB-1 GB, since a join or
    aggregate on the bucket key then runs one task per bucket without a
    shuffle."""
    if not bucket_key:
        raise ValueError("bucket key is required")
    spark = df.sparkSession
    rows = apply_model(df, model, sort_key, order, aggs)

    def write(frame: DataFrame, name: str, mode: str) -> None:
        frame.write.mode(mode).bucketBy(buckets, *list(bucket_key)).sortBy(*list(sort_key)).saveAsTable(name)

    if not spark.catalog.tableExists(table):
        write(rows, table, "error")
        return
    stored = spark.table(table)
    if model == "detail":
        write(rows.select(*stored.columns), table, "append")
        return
    if model == "aggregate" and not merge:
        raise ValueError("loading into an existing aggregate table needs merge functions")
    merged = apply_model(stored.unionByName(rows), model, sort_key, order, merge)
    aside = f"{table}__{uuid.uuid4().hex[:8]}"
    write(merged.select(*stored.columns), aside, "error")
    _swap(spark, table, aside)


def _swap(spark: SparkSession, table: str, new: str) -> None:
    """``new`` takes the name of ``table``.  The stored table keeps its rows
    under another name until the new one stands; a failure on the way gives
    it its name back and leaves no merged copy behind."""
    old = f"{table}__{uuid.uuid4().hex[:8]}"
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except BaseException:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    spark.sql(f"DROP TABLE {old}")


def default_keys(df: DataFrame) -> tuple[list[str], list[str]]:
    """(sort key, bucket key) when none is given: the first column."""
    first = df.columns[0]
    return [first], [first]


# ------------------------------------------------------------------------- L6
def restore_name(table: str, snapshot_time: dt.datetime, offset_hours: int = LOCAL_OFFSET_HOURS) -> str:
    """Target name of a copied table: ``<table>_<local yyyyMMddHHmm>``."""
    local = snapshot_time + dt.timedelta(hours=offset_hours)
    return f"{table.split('.')[-1]}_{local.strftime(RESTORE_STAMP)}"


def restore_tables(
    spark: SparkSession,
    snapshot_root: str,
    tables: Sequence[str],
    snapshot_time: dt.datetime,
    schema: str = RESTORE_SCHEMA,
    schema_location: str | None = None,
) -> DataFrame:
    """Copy ``db.schema.table`` tables out of a snapshot folder
    (``<root>/<db>/<schema>/<table>``, Parquet) into ``schema`` as
    ``<table>_<local stamp>``; a target that exists is skipped.  Returns one
    status row per table.  The loop runs over the requested table names
    (control metadata); each copy is one distributed read/write."""
    loc = f" LOCATION '{schema_location}'" if schema_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`{loc}")
    status = []
    for full in tables:
        db, sch, name = full.split(".")
        target = restore_name(full, snapshot_time)
        qualified = f"`{schema}`.`{target}`"
        if spark.catalog.tableExists(f"{schema}.{target}"):
            status.append((full, target, "skipped"))
            continue
        spark.read.parquet(f"{snapshot_root.rstrip('/')}/{db}/{sch}/{name}").write.saveAsTable(qualified)
        status.append((full, target, "restored"))
    return spark.createDataFrame(status, "table string, target_table string, status string")


# ------------------------------------------------------------------------- L7
def heads(frames: Mapping[str, DataFrame], n: int = HEAD_ROWS, order: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """First ``n`` rows of each table as ``table_name, rn, row_json``: a union
    of per-table top-n in the ``order`` given, else any ``n`` rows (a limit,
    which reads no more than it needs)."""
    parts = []
    for name, df in frames.items():
        cols = list((order or {}).get(name, ()))
        w = Window.orderBy(*(cols or [F.lit(1)]))
        top = df.orderBy(*cols).limit(n) if cols else df.limit(n)
        parts.append(
            top.select(
                F.lit(name).alias("table_name"),
                F.row_number().over(w).alias("rn"),
                F.to_json(F.struct(*df.columns)).alias("row_json"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def heads_by(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int = HEAD_ROWS) -> DataFrame:
    """First ``n`` rows of each group of one table: ``row_number() <= n``,
    which Spark plans as a partial + final ``WindowGroupLimit`` so only
    ``n`` rows per group and task are shuffled."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)


def catalog_heads(
    spark: SparkSession,
    n: int = HEAD_ROWS,
    skip: Sequence[str] = SKIP_DATABASES,
    skip_prefix: str = SKIP_DATABASE_PREFIX,
) -> DataFrame:
    """One-row-per-table smoke check over the catalogue: the first ``n``
    rows of every table outside system, ``skip`` and ``rs_`` databases."""
    frames = {}
    for db in spark.catalog.listDatabases():
        if db.name in skip or db.name.startswith(skip_prefix):
            continue
        for t in spark.catalog.listTables(db.name):
            if t.isTemporary:
                continue
            frames[f"{db.name}.{t.name}"] = spark.table(f"`{db.name}`.`{t.name}`")
    if not frames:
        return spark.createDataFrame([], "table_name string, rn int, row_json string")
    return heads(frames, n)


# ------------------------------------------------------------------------- L8
def apply_mapping(
    frames: Mapping[str, DataFrame],
    tables: Sequence[str],
    prefix: str,
    schema: str,
    mode: str,
    id_col: str = "id",
) -> dict[str, DataFrame]:
    """Replicate chosen tables under ``schema.<prefix><name>``: in ``data``
    mode every row passes; in ``schema`` mode only rows whose ``id`` is null
    (structure without data; a table without ``id`` passes no row)."""
    if mode not in MAPPING_MODES:
        raise ValueError(f"unknown mode {mode!r}")
    out = {}
    for name in tables:
        df = frames[name]
        if mode == "schema":
            df = df.where(F.col(id_col).isNull()) if id_col in df.columns else df.where(F.lit(False))
        out[f"{schema}.{prefix}{name}"] = df
    return out


def write_mapping(frames: Mapping[str, DataFrame], root: str) -> None:
    """Write each mapped table to ``root/<schema>/<table>`` (overwrite)."""
    for name, df in frames.items():
        sch, tbl = name.split(".", 1)
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{sch}/{tbl}")

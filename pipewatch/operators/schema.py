"""Schema conformance: column profiles, type mapping to the CDC table and
to the serving table, and conforming + writing CDC rows.

A *column profile* is ``schema, table, column, position, data_type,
char_len, precision, scale`` with warehouse (PostgreSQL-style) type names.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipewatch.session import work_dir

# The warehouse type names and the CDC / serving rules.
DEFAULT_VARCHAR_LENGTH = 65535
CDC_KEEP_TYPES = ("smallint", "integer", "bigint", "date", "timestamp", "real", "double precision")
CDC_EXTRA_COLUMNS = (("commit_timestamp", "varchar(50)"), ("op", "char(1)"), ("cdc_transact_id", "varchar(50)"))
CDC_PARTITION = "event_time"
PROFILE_SCHEMA = (
    "schema string, table string, column string, position int, data_type string, "
    "char_len int, precision int, scale int"
)


# ------------------------------------------------------------------------- C4
#: Where Spark keeps the declared type of a char or varchar column of a table.
_DECLARED_KEY = "__CHAR_VARCHAR_TYPE_STRING"
_DECLARED = re.compile(r"(varchar|char)\((\d+)\)")


def _warehouse_type(dt: T.DataType, metadata: dict | None = None) -> tuple[str, int | None, int | None, int | None]:
    if isinstance(dt, T.LongType):
        return "bigint", None, 64, 0
    if isinstance(dt, T.IntegerType):
        return "integer", None, 32, 0
    if isinstance(dt, (T.ShortType, T.ByteType)):
        return "smallint", None, 16, 0
    if isinstance(dt, T.FloatType):
        return "real", None, 24, None
    if isinstance(dt, T.DoubleType):
        return "double precision", None, 53, None
    if isinstance(dt, T.DecimalType):
        return "numeric", None, dt.precision, dt.scale
    if isinstance(dt, T.VarcharType):
        return "character varying", dt.length, None, None
    if isinstance(dt, T.CharType):
        return "character", dt.length, None, None
    if isinstance(dt, T.StringType):
        declared = _DECLARED.fullmatch((metadata or {}).get(_DECLARED_KEY, ""))
        if declared:
            return ("character varying" if declared[1] == "varchar" else "character"), int(declared[2]), None, None
        return "character varying", DEFAULT_VARCHAR_LENGTH, None, None
    if isinstance(dt, T.BooleanType):
        return "boolean", None, None, None
    if isinstance(dt, T.DateType):
        return "date", None, None, None
    if isinstance(dt, T.TimestampNTZType):
        return "timestamp without time zone", None, None, None
    if isinstance(dt, T.TimestampType):
        return "timestamp with time zone", None, None, None
    return dt.simpleString(), None, None, None


def columns_of(
    spark: SparkSession,
    frames: dict[str, DataFrame | T.StructType],
    schema: str = "public",
    measure: bool = False,
) -> DataFrame:
    """Column profile of DataFrames or schemas (name -> frame/schema).

    Types and declared ``varchar(n)`` / ``char(n)`` lengths come from the
    schemas alone (Spark keeps them in the column metadata of tables); text
    without a declared length gets the warehouse maximum (65535).  No data is
    read.  With ``measure`` the ``char_len`` of undeclared text is the longest
    value stored instead: one aggregate pass per table over those columns,
    unpivoted with ``stack`` and joined to the schema rows."""
    rows = []
    measured = []
    for table, df in frames.items():
        struct = df if isinstance(df, T.StructType) else df.schema
        strings = []
        for i, f in enumerate(struct.fields, start=1):
            kind = _warehouse_type(f.dataType, f.metadata)
            rows.append((schema, table, f.name, i, *kind))
            if type(f.dataType) is T.StringType and _DECLARED_KEY not in (f.metadata or {}):
                strings.append(f.name)
        if measure and strings and isinstance(df, DataFrame):
            lens = df.agg(*[F.max(F.length(F.col(c))).alias(f"__l{j}") for j, c in enumerate(strings)])
            pairs = ", ".join(f"'{_sql_str(c)}', __l{j}" for j, c in enumerate(strings))
            measured.append(
                lens.select(F.expr(f"stack({len(strings)}, {pairs})").alias("column", "__len")).select(
                    F.lit(table).alias("table"), "column", F.greatest(F.col("__len"), F.lit(1)).cast("int").alias("__len")
                )
            )
    profile = spark.createDataFrame(rows, PROFILE_SCHEMA)
    if not measured:
        return profile
    lengths = measured[0]
    for m in measured[1:]:
        lengths = lengths.unionByName(m)
    joined = profile.join(lengths, ["table", "column"], "left")
    return joined.select(
        "schema", "table", "column", "position", "data_type",
        F.coalesce(F.col("__len"), F.col("char_len")).alias("char_len"), "precision", "scale",
    )


def _sql_str(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


# ------------------------------------------------------------------------- C1
def map_types_cdc(columns: DataFrame, with_extra: bool = True) -> DataFrame:
    """CDC-table type of each column: the plain numeric/date types stay,
    ``timestamp without time zone`` becomes ``timestamp``, ``numeric(p, s)``
    keeps precision and scale, text becomes ``varchar(n)`` - except a column
    named ``op``, which is ``char(1)``.  Other types get a null ``cdc_type``
    (rejects: see :func:`cdc_rejects`).  With ``with_extra`` the three CDC
    columns are appended to each table unless the table already has them."""
    t, name = F.col("data_type"), F.col("column")
    text = t.isin("string", "character varying")
    cdc = (
        F.when(t.isin(*CDC_KEEP_TYPES), t)
        .when(t == "timestamp without time zone", F.lit("timestamp"))
        .when(t == "numeric", F.format_string("numeric(%d, %d)", F.col("precision"), F.col("scale")))
        .when(text & (name == "op"), F.lit("char(1)"))
        .when(text, F.concat(F.lit("varchar("), F.col("char_len").cast("string"), F.lit(")")))
    )
    mapped = columns.select("schema", "table", "column", "position", cdc.alias("cdc_type"))
    if not with_extra:
        return mapped
    extra = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(i).alias("extra"), F.lit(ty).alias("cdc_type"))
            for i, (c, ty) in enumerate(CDC_EXTRA_COLUMNS, start=1)
        ]
    )
    tables = columns.groupBy("schema", "table").agg(F.max("position").alias("__last"))
    extras = (
        tables.select("schema", "table", "__last", F.explode(extra).alias("__e"))
        .select(
            "schema",
            "table",
            F.col("__e.column").alias("column"),
            (F.col("__last") + F.col("__e.extra")).alias("position"),
            F.col("__e.cdc_type").alias("cdc_type"),
        )
        .join(columns.select("schema", "table", "column"), ["schema", "table", "column"], "left_anti")
    )
    return mapped.where(F.col("cdc_type").isNotNull()).unionByName(extras)


def cdc_rejects(columns: DataFrame) -> DataFrame:
    """Columns whose type has no CDC mapping."""
    return (
        map_types_cdc(columns, with_extra=False)
        .where(F.col("cdc_type").isNull())
        .join(columns, ["schema", "table", "column", "position"])
        .select("schema", "table", "column", "data_type")
    )


# ------------------------------------------------------------------------- C3
def map_types_serving(columns: DataFrame, sort_key: str) -> DataFrame:
    """Serving-table type of each column: text is ``varchar(n)`` only for
    sort-key columns (``sort_key`` is a comma list), else ``string``;
    timestamps become ``datetime``; ``double precision`` becomes ``double``;
    ``numeric`` becomes ``decimal``; other types are unchanged."""
    keys = F.split(F.lit(sort_key), r",\s*")
    t = F.col("data_type")
    serving = (
        F.when(
            t == "character varying",
            F.when(
                F.array_contains(keys, F.col("column")),
                F.concat(F.lit("varchar("), F.col("char_len").cast("string"), F.lit(")")),
            ).otherwise(F.lit("string")),
        )
        .when(t.isin("timestamp without time zone", "timestamp with time zone"), F.lit("datetime"))
        .when(t == "double precision", F.lit("double"))
        .when(t == "numeric", F.lit("decimal"))
        .otherwise(t)
    )
    return columns.select("schema", "table", "column", "position", serving.alias("serving_type"))


# ------------------------------------------------------------------------- C2
def spark_type_of(cdc_type: str) -> str:
    """Spark SQL type for a CDC type name."""
    ct = cdc_type.strip().lower()
    simple = {
        "smallint": "smallint",
        "integer": "int",
        "bigint": "bigint",
        "date": "date",
        "timestamp": "timestamp_ntz",
        "real": "float",
        "double precision": "double",
        "char(1)": "string",
    }
    if ct in simple:
        return simple[ct]
    if ct.startswith("numeric("):
        return "decimal" + ct[len("numeric"):].replace(" ", "")
    if ct.startswith("varchar("):
        return "string"
    raise ValueError(f"no Spark type for {cdc_type!r}")


def text_limit(cdc_type: str) -> int | None:
    """Characters a text type may hold; None for other types."""
    m = re.fullmatch(r"(?:varchar|char)\((\d+)\)", cdc_type.strip().lower())
    return int(m[1]) if m else None


def _lossy(src: Column, source: T.DataType, target: str) -> Column:
    """Numbers that a cast to ``target`` changes: a fraction or a magnitude it
    cannot hold.  Decimals and doubles may be rounded to the digits a decimal,
    real or double has; they may not become infinite.  Other types: no."""
    if not isinstance(source, T.NumericType):
        return F.lit(False)
    there = src.try_cast(target)
    if target in ("smallint", "short", "int", "integer", "bigint", "long"):
        back = there.cast("decimal(20,0)")
        return F.coalesce(back != (src if isinstance(source, T.DecimalType) else src.cast("double")), F.lit(False))
    if target in ("float", "double"):
        finite = F.abs(src.cast("double")) < float("inf")
        return F.coalesce(finite & (F.abs(there) == float("inf")), F.lit(False))
    return F.lit(False)


def split_cdc(df: DataFrame, column_types: Sequence[tuple[str, str]], event_time: Column | str = CDC_PARTITION) -> tuple[DataFrame, DataFrame]:
    """(conformed, rejects): ``df`` cast to the CDC column list ``[(column,
    cdc_type), ...]`` (the small output of :func:`map_types_cdc` for one table,
    collected by the caller), CDC columns the source lacks filled with nulls,
    each column once; ``event_time`` (string ``yyyy/MM/dd/HH``) is the
    partition.

    A row with a value that does not fit its type (a number that the type
    cannot hold: a fraction for a whole number, 1e300 for a real), with text
    longer than its length or without an ``event_time`` is no conformed row: it goes to rejects, whole and unchanged, with
    a ``reason`` that names the columns."""
    cols, bad, seen = [], [], {CDC_PARTITION}
    for name, ctype in column_types:
        if name in seen:
            continue
        seen.add(name)
        target = spark_type_of(ctype)
        if name not in df.columns:
            cols.append(F.lit(None).cast(target).alias(name))
            continue
        src = F.col(f"`{name}`")
        cols.append(src.try_cast(target).alias(name))
        limit = text_limit(ctype)
        wrong = src.isNotNull() & src.try_cast(target).isNull() | _lossy(src, df.schema[name].dataType, target)
        if limit is not None:
            wrong = wrong | (F.length(src.cast("string")) > limit)
        bad.append(F.when(F.coalesce(wrong, F.lit(False)), F.lit(f"{name} is no {ctype}")))
    et = F.col(event_time) if isinstance(event_time, str) else event_time
    bad.append(F.when(et.isNull(), F.lit(f"no {CDC_PARTITION}")))
    reason = F.concat_ws("; ", *bad)
    marked = df.withColumn("__reason", reason)
    good = marked.where(F.col("__reason") == "").select(*cols, et.cast("string").alias(CDC_PARTITION))
    return good, marked.where(F.col("__reason") != "").select(*[F.col(f"`{c}`") for c in df.columns], F.col("__reason").alias("reason"))


def conform_cdc(df: DataFrame, column_types: Sequence[tuple[str, str]], event_time: Column | str = CDC_PARTITION) -> DataFrame:
    """The conformed half of :func:`split_cdc`."""
    return split_cdc(df, column_types, event_time)[0]


#: Rows of a file at most (about 128 MB of change rows), and what a file costs to open, in rows.
FILE_ROWS, FILE_COST = 1_000_000, 5_000


def clustered(df: DataFrame, hour: str = CDC_PARTITION, file_rows: int = FILE_ROWS, writers: int | None = None) -> DataFrame:
    """``df`` dealt to writers by how many rows each ``hour`` has, counted
    first (one aggregate over that column, written to the shared folder).

    An hour is cut into ``ceil(rows / file_rows)`` pieces, by the hash of the
    whole row: equal rows share a piece.  Pieces lie one after the other, in
    order of hours, and are cut into ``writers`` stretches of equal work (rows
    plus a fixed cost for each file; by default one writer for each
    ``file_rows``, and at least one for each core).  So small hours share a
    writer and a large one has several.  An hour has a file for each piece at
    most, but for pieces that the hash made larger than ``file_rows``."""
    spark = df.sparkSession
    pieces = F.ceil(F.col("n") / F.lit(file_rows)).cast("bigint")
    per = df.groupBy(F.col(f"`{hour}`").alias("__h")).agg(F.count(F.lit(1)).alias("n")).select("__h", pieces.alias("__pieces"), (F.col("n") + pieces * FILE_COST).alias("__work"))
    folder = work_dir(spark, "hours")
    per.write.parquet(folder)
    per = spark.read.parquet(folder)
    total = per.agg(F.sum("__work")).first()[0] or 0
    writers = writers or max(spark.sparkContext.defaultParallelism, -(-total // file_rows))
    # A row for each hour goes through this window: as many as the table has partition folders.
    before = F.sum("__work").over(Window.orderBy("__h").rowsBetween(Window.unboundedPreceding, -1))
    plan = per.withColumn("__before", F.coalesce(before, F.lit(0)))
    piece = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col("__pieces"))
    middle = F.col("__before") + (piece + 0.5) * F.col("__work") / F.col("__pieces")
    writer = F.least(F.lit(writers - 1), F.floor(middle * writers / max(total, 1))).cast("int")
    dealt = df.join(plan, F.col(f"`{hour}`").eqNullSafe(F.col("__h"))).withColumn("__writer", writer)
    return dealt.repartitionById(writers, "__writer").select(*[F.col(f"`{c}`") for c in df.columns])


def write_cdc(df: DataFrame, path: str, mode: str = "append", file_rows: int = FILE_ROWS) -> None:
    """Write conformed rows as Parquet partitioned by the string
    ``event_time``, dealt to writers by :func:`clustered`; no file has more
    than ``file_rows`` rows."""
    writer = clustered(df, file_rows=file_rows).write.mode(mode).option("maxRecordsPerFile", file_rows)
    writer.partitionBy(CDC_PARTITION).parquet(path)


def file_counts(spark: SparkSession, path: str) -> DataFrame:
    """``event_time, files, rows`` of a CDC folder (rows without an hour apart)."""
    files = spark.read.schema(f"{CDC_PARTITION} string").parquet(path).select(CDC_PARTITION, F.col("_metadata.file_path").alias("f"))
    return files.groupBy(CDC_PARTITION).agg(F.countDistinct("f").alias("files"), F.count(F.lit(1)).alias("rows"))


def read_cdc(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a CDC folder with an explicit schema (``event_time`` stays a
    string, so filters on it prune partitions)."""
    return spark.read.schema(schema).parquet(path)

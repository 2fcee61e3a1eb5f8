"""Helpers shared by the operators: words, shared-folder tables, ranks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pipewatch.session import work_dir

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; a null, empty or blank text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: later stages and retries start from files that every
    executor sees, and a table that several steps use is computed once."""
    spark = df.sparkSession
    path = work_dir(spark, "llm", name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables of :func:`saved` that nothing will read again: what was
    made from them has been written."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(t._saved_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


#: Spark's setting that removes the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each query that runs inside go when it ends, and
    not when the driver happens to collect its garbage.  For steps that hand
    on written tables (:func:`saved`): nothing reads those files again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def hash52(*parts: Column) -> Column:
    """A 52-bit whole number from the texts of ``parts`` (the leading 13 hex
    digits of their MD5, joined by ``:``; null reads as ``null``)."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def unit(h: Column) -> Column:
    """A 52-bit number as a double strictly between 0 and 1."""
    return (h + F.lit(0.5)) / F.lit(float(2**52))


def gapless_rank(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    ties: Sequence[str],
    blocks: int,
    out: str = "rank",
    bits: int = 52,
) -> DataFrame:
    """Number the rows of each key from 0 without gaps, in the order of
    ``position`` (a whole number of ``bits`` bits, spread evenly) and ``ties``.

    A key may hold a third of all rows: its positions are cut into ``blocks``
    equal ranges.  One aggregate counts rows per (key, range), a window over
    those counts gives each range its first number, and rows are numbered
    inside (key, range) only, so a task never sorts a whole key."""
    b, c, first = "_rank_block", "_rank_count", "_rank_first"
    cut = df.withColumn(b, F.floor(F.col(position) / F.lit(float(2**bits) / blocks)).cast("int"))
    before = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy(*keys, b)
        .agg(F.count("*").alias(c))
        .select(*keys, b, F.coalesce(F.sum(c).over(before), F.lit(0)).alias(first))
    )
    inside = Window.partitionBy(*keys, b).orderBy(position, *ties)
    numbered = cut.withColumn(out, F.row_number().over(inside) - 1)
    on = [numbered[k].eqNullSafe(starts[k]) for k in [*keys, b]]
    cond = on[0]
    for x in on[1:]:
        cond = cond & x
    kept = [numbered[x] for x in df.columns]
    return numbered.join(starts, cond).select(*kept, (numbered[out] + starts[first]).alias(out))

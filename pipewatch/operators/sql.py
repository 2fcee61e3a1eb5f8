"""SQL entry: run a SQL text over registered views."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def _views(spark: SparkSession, views: Mapping[str, DataFrame]) -> Iterator[None]:
    """``views`` as temp views while the block runs.  A temp view of the
    session that has the same name is back afterwards; the others are gone."""
    taken = {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary}
    before = {name: spark.table(name) for name in views if name.lower() in taken}
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        yield
    finally:
        for name in views:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def run_sql(spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None, rows: bool = True) -> DataFrame | None:
    """Run ``text`` with ``spark.sql`` over ``views`` (name -> DataFrame).

    The views exist only while the text is analysed (the result's plan holds
    what they stand for), so the session keeps none of them.  With ``rows``
    the result is a lazy DataFrame.  Without, no rows are wanted: a command
    (INSERT, CREATE, ...) has run when this returns, a query is run to its
    end and its rows are thrown away, and the result is None.  An empty text
    does nothing and returns None."""
    if not text or not text.strip():
        return None
    with _views(spark, views or {}):
        result = spark.sql(text)
    if rows:
        return result
    if result.columns:  # a command's result has no rows left to run
        result.write.format("noop").mode("overwrite").save()
    return None

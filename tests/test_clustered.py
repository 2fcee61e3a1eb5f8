from collections import Counter

import pytest
from pyspark.sql import functions as F

from pipewatch.operators import schema as sc

HOT = "2024/01/01/00"


def _changes(spark, n):
    """A third of all rows in one hour, the others in 40 hours."""
    hour = F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.format_string("2024/02/%02d/%02d", F.col("id") % 4 + 1, F.col("id") % 10))
    return spark.range(n).select("id", (F.col("id") * 2).alias("v"), hour.alias("event_time"))


def test_small_hours_have_one_file_and_all_rows_stay(spark, tmp_dir):
    df = _changes(spark, 3000)
    sc.write_cdc(df, tmp_dir, file_rows=2000)
    got = {r.event_time: (r.files, r["rows"]) for r in sc.file_counts(spark, tmp_dir).collect()}
    want = Counter(r.event_time for r in df.collect())
    assert got == {h: (1, n) for h, n in want.items()}
    back = sc.read_cdc(spark, tmp_dir, df.schema)
    assert back.exceptAll(df).count() == 0 and back.count() == 3000


def test_hot_hour_is_split_over_writers(spark, tmp_dir):
    df = _changes(spark, 30_000)
    dealt = sc.clustered(df, file_rows=1000, writers=30)
    placed = dealt.select("event_time", F.spark_partition_id().alias("p"))
    by_hour = placed.groupBy("event_time").agg(F.countDistinct("p").alias("w"))
    sizes = [r["count"] for r in placed.groupBy("p").count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 5000  # 10,000 rows are of the hot hour
    writers = {r.event_time: r.w for r in by_hour.collect()}
    assert writers[HOT] > 3 and all(w == 1 for h, w in writers.items() if h != HOT)
    sc.write_cdc(df, tmp_dir, file_rows=1000)
    files = spark.read.parquet(tmp_dir).groupBy(F.col("_metadata.file_path")).count()
    assert files.agg(F.max("count")).first()[0] <= 1000
    got = {r.event_time: r.files for r in sc.file_counts(spark, tmp_dir).collect()}
    assert 10 <= got[HOT] <= 20 and all(n == 1 for h, n in got.items() if h != HOT)


@pytest.mark.parametrize("rows", [[], [(1, 2, HOT)], [(1, 2, HOT)] * 50])
def test_no_rows_one_row_equal_rows(spark, tmp_dir, rows):
    df = spark.createDataFrame(rows, "id bigint, v bigint, event_time string")
    sc.write_cdc(df, tmp_dir, file_rows=20)
    back = sc.read_cdc(spark, tmp_dir, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_rows_without_an_hour_and_column_names_of_any_kind(spark):
    df = spark.createDataFrame([(1, None), (2, HOT)], "`a.b` int, event_time string")
    got = sc.clustered(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == [(1, None), (2, HOT)]

import pytest
from pyspark.sql import functions as F

from pipewatch.operators import loads as ld

LO, HI = "2024/01/01/00", "2024/01/01/05"


def _sides(spark, key):
    """1,000 rows of the wanted hours, every other one in a target of 100,000."""
    hour = F.when(F.col("i") < 1000, F.lit("2024/01/01/03")).otherwise(F.lit("2024/02/01/00"))
    src = spark.range(3000).withColumnRenamed("id", "i").select(key.alias("id"), F.col("i").alias("v"), hour.alias("event_time"))
    tgt = spark.range(100_000).select((F.col("id") * 2).alias("i")).select(key.alias("id"), F.col("i").alias("v"))
    return src, tgt


@pytest.mark.parametrize("kind", ["bigint", "string", "double", "date"])
def test_same_rows_as_the_plain_backfill(spark, kind):
    i = F.col("i")
    key = F.date_add(F.lit("1970-01-01").cast("date"), i.cast("int")) if kind == "date" else i.cast(kind)
    src, tgt = _sides(spark, key)
    want = ld.backfill(src, tgt, LO, HI)
    got = ld.backfill_thinned(src, tgt, LO, HI)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 500


def test_few_target_keys_are_left_for_the_join(spark):
    src, tgt = _sides(spark, F.col("i"))
    cand = src.where(F.col("event_time") < HI)
    left = ld.thinned_keys(cand, tgt, "id")
    assert left.join(cand, "id", "left_semi").count() == 500  # none that is met is missing
    assert left.count() < 10_000  # 1 in 16 of the others at most, of 100,000
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # the target itself is not shuffled


def test_unlike_types_are_not_thinned(spark):
    src, tgt = _sides(spark, F.col("i"))
    tgt = tgt.withColumn("id", F.col("id").cast("string"))
    assert ld.thinned_keys(src, tgt, "id").count() == 100_000
    assert ld.backfill_thinned(src, tgt, LO, HI).count() == ld.backfill(src, tgt, LO, HI).count() == 500


def test_null_repeated_and_no_keys(spark):
    src = spark.createDataFrame([(None, LO), (1, LO), (1, LO), (2, LO), (2, "2024")], "id int, event_time string")
    tgt = spark.createDataFrame([(None,), (2,), (2,)], "id int")
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert rows(ld.backfill_thinned(src, tgt, LO, HI)) == rows(ld.backfill(src, tgt, LO, HI)) == [(1,), (1,), (None,)]
    assert rows(ld.backfill_thinned(src, tgt.limit(0), LO, HI)) == rows(ld.backfill(src, tgt.limit(0), LO, HI))
    assert rows(ld.backfill_thinned(src.limit(0), tgt, LO, HI)) == []
    with pytest.raises(ValueError):
        ld.backfill_thinned(src, tgt, LO, HI, key="event_time")

"""Plan tests: the physical shapes the scale design relies on."""

import datetime as dt

from pyspark.sql import functions as F

from pipewatch.operators import catalog as cg
from pipewatch.operators import items as it
from pipewatch.operators import stats as sx
from pipewatch.operators import topics as tp
from pipewatch.sources import derived

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_facets_single_scan_with_expand(spark):
    c = spark.read.parquet(f"{SF}/customer.parquet")
    plan = _plan(cg.facets(c, ["c_mktsegment", "c_nationkey"]))
    assert plan.count("FileScan") == 1 and "Expand" in plan


def test_slice_filters_reach_scan(spark):
    # a log whose broker time and offset are stored columns (as in a landed or Kafka log)
    log = spark.read.parquet(f"{SF}/events.parquet").selectExpr(
        "0 AS partition", "event_id AS offset", "ts AS timestamp", "props AS value"
    )
    start, end = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12)
    # bounds pass: the time filter reaches the scan
    bounds_plan = _plan(log.where(F.col("timestamp") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")))
    assert any(">= 2024-01-10" in ln for ln in bounds_plan.splitlines() if "FileScan" in ln)
    # slice pass: the collected bounds are a literal offset range on the scan
    sliced = tp.slice_log(log, start, end)
    scans = [ln for ln in _plan(sliced).splitlines() if "FileScan" in ln]
    assert any("event_id" in ln and ">=" in ln and "<=" in ln for ln in scans)
    joined = tp.slice_log(log, start, end, static_bounds=False)
    assert "BroadcastExchange" in _plan(joined)
    assert sorted(r.offset for r in sliced.collect()) == sorted(r.offset for r in joined.collect())


def test_latest_items_broadcasts_only_top_n(spark):
    items = it.unwrap_items(derived.typed_items(spark, SF))
    plan = _plan(it.latest_items(derived.item_keys(spark, SF), items, "key", "time", n=5))
    assert "TakeOrderedAndProject" in plan and "LeftSemi" in plan and "BroadcastExchange" in plan


def test_change_counts_aggregates_before_joining(spark):
    df = sx.change_counts(derived.table_stats(spark, SF), derived.tasks(spark, SF), derived.endpoints(spark, SF))
    plan = _plan(df)
    lines = plan.splitlines()
    first_join = min(i for i, ln in enumerate(lines) if "Join" in ln)
    # a partial aggregate sits below (after, in the printed tree) the first join
    assert any("partial_sum" in ln for ln in lines[first_join:])


def test_cdc_read_prunes_partitions(spark, tmp_dir):
    from pipewatch.operators import schema as sc

    src = derived.cdc_source(spark, SF).where(F.col("o_orderkey") < 300)
    conformed = sc.conform_cdc(src, [("o_orderkey", "bigint"), ("op", "char(1)")])
    sc.write_cdc(conformed, tmp_dir)
    back = sc.read_cdc(spark, tmp_dir, conformed.schema).where(F.col("event_time").between("1996/01/01/00", "1996/12/31/23"))
    assert "PartitionFilters: [isnotnull(event_time" in _plan(back)


def test_per_key_disorder_has_no_single_partition_on_data(spark):
    ev = tp.extract_events(derived.orders_log(spark, SF)).withColumn("partition", F.col("offset") % 3)
    # no key holds more than 100 rows: a plain per-key window
    cold = _plan(tp.disorder_bound(ev, key="key", topn=None, bucket_width=100))
    assert "SinglePartition" not in cold and "hashpartitioning" in cold
    # one hot key (half the rows): it alone is split into buckets
    hot_ev = ev.withColumn("key", F.when(F.col("offset") % 2 == 0, F.lit("hot")).otherwise(F.col("key")))
    hot = _plan(tp.disorder_bound(hot_ev, key="key", topn=None, bucket_width=100))
    assert "SinglePartition" not in hot
    assert "hashpartitioning(__pw_key" in hot and "__pw_hot" in hot


def test_date_drill_and_history_windows_reach_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = _plan(cg.date_drill(orders, "o_orderdate", 1997, 5))
    assert any("o_orderdate" in ln and ">= 1997-05-01" in ln for ln in plan.splitlines() if "FileScan" in ln)
    from pipewatch.operators import history as hs

    hist = spark.read.parquet(f"{SF}/events.parquet").selectExpr(
        "event_id AS query_id", "CAST(user_id AS INT) AS user_id", "ts AS start_time",
        "CAST(value AS BIGINT) AS elapsed_us", "props AS query_text",
    )
    plan = _plan(hs.dashboard_queries(hist, dt.date(2024, 1, 20), (102, 109)))
    assert any("GreaterThanOrEqual(ts,2024-01-1" in ln for ln in plan.splitlines() if "FileScan" in ln)

"""Edge cases of the audits: instants under another session zone, null keys,
rejects, loads into existing tables, plans without data scans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pipewatch.functions.maps import unwrap
from pipewatch.functions.times import instant, ts_literal
from pipewatch.operators import catalog as cg
from pipewatch.operators import history as hs
from pipewatch.operators import loads as ld
from pipewatch.operators import schema as sc
from pipewatch.operators import topics as tp
from pipewatch.plans import registry
from pipewatch.plans.schema_audits import _profile

SF = "/root/testdata/sf0.001"
LOG = "partition int, offset bigint, timestamp timestamp_ntz, value string"


@pytest.fixture()
def shanghai(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


def rows(df):
    return sorted(map(repr, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


INSTANT = [n for n in registry.queries() if n.endswith("_instant")]


@pytest.mark.parametrize("name", INSTANT)
def test_instants_do_not_move_with_the_session_zone(spark, name):
    want = rows(registry.queries()[name](spark, SF))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert rows(registry.queries()[name](spark, SF)) == want and want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_literals_of_instants(shanghai):
    utc = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    got = shanghai.range(1).select(
        F.unix_micros(ts_literal(dt.datetime(2024, 1, 1), "timestamp")).alias("a"),
        F.unix_micros(ts_literal("2024-01-01 00:00:00", "timestamp")).alias("b"),
        F.unix_micros(ts_literal(dt.date(2024, 1, 1), "timestamp")).alias("c"),
        F.unix_micros(ts_literal(utc, "timestamp")).alias("d"),
    ).first()
    assert (got.a, got.b, got.c, got.d) == (1704067200000000,) * 3 + (1704067200000000 + 10 * 3600 * 10**6,)


def test_history_range_reaches_the_scan(shanghai, tmp_dir):
    from pipewatch.sources import derived

    derived.query_history(shanghai, SF).withColumn("start_time", instant("start_time")).write.parquet(tmp_dir)
    shanghai.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        assert "GreaterThanOrEqual(start_time" in plan(hs.dashboard_queries(shanghai.read.parquet(tmp_dir), dt.date(2024, 1, 20), (102, 109)))
    finally:
        shanghai.conf.unset("spark.sql.maxMetadataStringLength")


def log(spark, data):
    return spark.createDataFrame([(p, o, dt.datetime(2024, 1, 1, h), v) for p, o, h, v in data], LOG)


def test_missing_partition_column_is_an_error(spark):
    events = spark.createDataFrame([(0, 1, 5)], "kafka_partition int, offset bigint, ts bigint")
    for run in (tp.disorder_bound, lambda e: tp.late_beyond(e, [0])):
        with pytest.raises(ValueError, match="no column"):
            run(events)
    assert tp.disorder_bound(events, per=()).count() == 0


def test_last_message_has_one_definition(spark):
    data = log(spark, [(0, 5, 1, "a"), (0, 5, 1, "b"), (0, 4, 2, "z"), (1, None, 1, "n"), (None, 2, 1, "p")])
    want = [(None, 2, "p"), (0, 5, "b")]
    for static in (True, False):
        got = tp.last_message(data, pretty=False, static_bounds=static).collect()
        assert sorted(((r.partition, r.offset, r.value) for r in got), key=str) == sorted(want, key=str)


def test_landing_reports_rejects_and_empty_slices(spark, tmp_dir):
    good = '{"id": 1, "event_time": "2024-01-01 01:00:00"}'
    data = log(spark, [(0, 1, 1, "no json"), (0, 2, 1, good), (0, 3, 2, '{"event_time": "2024-01-01 01:00:00"}'), (0, 4, 2, '{"id": 1}'), (1, 9, 0, good)])
    got = {r.partition: tuple(r)[1:] for r in tp.land(data, tmp_dir + "/x", dt.datetime(2024, 1, 1, 1)).collect()}
    assert got == {0: (True, 1, 1, 3), 1: (False, None, 0, 0)}
    bad = {r.offset: r.reason for r in spark.read.parquet(tmp_dir + "/x_rejects").collect()}
    assert bad == {1: "value is not a JSON object", 3: "key missing", 4: "event time missing or unparsable"}


def test_null_keys_are_added_once(spark):
    schema = "k int, v string, scope string"
    have = spark.createDataFrame([(1, "a", "s")], schema)
    new = spark.createDataFrame([(None, "z", "s"), (None, "b", "s"), (1, "x", "s")], schema)
    once = cg.add_new(have, new, ["k"])
    assert rows(once) == rows(cg.add_new(once, new, ["k"]))
    assert sorted((r.k is None, r.v) for r in once.collect()) == [(False, "a"), (True, "b")]
    first, added, removed = cg.reconcile(have, new, ["k"], "scope", "s")
    assert added.count() == 1 and removed.count() == 0
    again, added, removed = cg.reconcile(first, new, ["k"], "scope", "s")
    assert rows(again) == rows(first) and added.count() == 0 and removed.count() == 0
    assert plan(cg.reconcile(have, new, ["k"], "scope", "s")[0]).count("Scan ExistingRDD") == 2


def test_reconcile_keeps_keys_of_other_scopes(spark):
    schema = "k int, scope string"
    have = spark.createDataFrame([(1, "s"), (2, "t"), (3, None)], schema)
    new = spark.createDataFrame([(2, "s"), (3, "s"), (4, "s")], schema)
    got, added, removed = cg.reconcile(have, new, ["k"], "scope", "s")
    assert sorted(r.k for r in got.collect()) == [2, 3, 4]
    assert [r.k for r in added.collect()] == [4] and [r.k for r in removed.collect()] == [1]


def test_settings_that_are_not_json_fail(spark):
    eps = spark.createDataFrame([("e1", "ep1", "mysql", "db")], "arn string, id string, engine string, database string")
    tasks = spark.createDataFrame([("t1", "a1", "e1", "e1", "{broken", "{}")], "task_id string, arn string, source_arn string, target_arn string, settings string, mappings string")
    stats = spark.createDataFrame([("a1", "x", "s")], "task_arn string, table string, schema string")
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|parse"):
        cg.full_refresh(eps, tasks, stats)["tasks"].collect()


def test_attributes_without_a_value_are_dropped(spark):
    item = spark.createDataFrame([({"a": {"S": "1"}, "b": {}, "c": None},)], "item map<string, map<string, string>>")
    assert item.select(unwrap("item").alias("i")).first().i == {"a": "1"}


def test_search_terms_keep_backslashes_and_quotes(spark):
    assert cg.parse_search(r"-_p\d+$ it's") == (["it's"], [r"_p\d+$"])
    df = spark.createDataFrame([("x_p12",), ("x_pd",), ("Ärger",)], "name string")
    assert [r.name for r in cg.search(df, ["name"], r"x -_p\d+$").collect()] == ["x_pd"]
    assert cg.search(df, ["name"], "-ÄRGER").count() == 2


def test_picking_a_null_facet(spark):
    df = spark.createDataFrame([("a",), (None,)], "seg string")
    assert cg.pick(df, {"seg": None}).count() == 1


def test_append_keeps_the_columns_of_the_table(spark, tmp_dir):
    spark.createDataFrame([(1, "x", 1.5)], "id bigint, only string, v double").write.parquet(tmp_dir)
    ld.append(spark.createDataFrame([(2, 7)], "id int, v int"), tmp_dir)
    got = sorted(tuple(r) for r in spark.read.parquet(tmp_dir).select("id", "only", "v").collect())
    assert got == [(1, "x", 1.5), (2, None, 7.0)]
    with pytest.raises(ValueError, match="no column"):
        ld.append(spark.createDataFrame([(2, 7)], "id int, other int"), tmp_dir)
    ld.append(spark.range(3), tmp_dir + "/new")
    assert spark.read.parquet(tmp_dir + "/new").count() == 3


def test_labels_of_equal_file_names_stay_apart(spark, tmp_dir):
    spark.range(10).withColumn("p", F.col("id") % 2).repartition(1, "p").write.partitionBy("p").parquet(tmp_dir)
    got = ld.load(spark, tmp_dir, ["id", "p"], "l").collect()
    assert len(got) == 10 and {(r.p, r.label) for r in got} == {(0, "l__1__1"), (1, "l__1__2")}


def test_aggregate_load_needs_merge_functions(spark, tmp_dir):
    import uuid

    db = "m_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_dir}'")
    df = spark.createDataFrame([(1, 2)], "k int, n int")
    total = [F.sum("n").alias("n")]
    ld.write_model(df, f"{db}.t", "aggregate", ["k"], ["k"], aggs=total)
    with pytest.raises(ValueError, match="merge"):
        ld.write_model(df, f"{db}.t", "aggregate", ["k"], ["k"], aggs=total)
    ld.write_model(df, f"{db}.t", "aggregate", ["k"], ["k"], aggs=total, merge=total)
    assert [tuple(r) for r in spark.table(f"{db}.t").collect()] == [(1, 4)]
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]


def test_profiles_read_no_data(spark):
    assert "FileScan" not in plan(_profile(spark, SF))
    for name in ("c1_map_types_cdc", "c3_map_types_serving", "c4_columns_of"):
        assert "FileScan" not in plan(registry.queries()[name](spark, SF)), name


def test_heads_without_an_order_do_not_sort(spark, tmp_dir):
    spark.range(100).write.parquet(tmp_dir)
    got = ld.heads({"t": spark.read.parquet(tmp_dir)}, 2)
    assert got.count() == 2 and "TakeOrderedAndProject" not in plan(got)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from pipewatch import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())

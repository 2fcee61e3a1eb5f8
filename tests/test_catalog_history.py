import datetime as dt

import pytest
from pyspark.sql import functions as F

from pipewatch.operators import catalog as cg
from pipewatch.operators import history as hs

SCHEMA = "k int, v string, scope string"


def _ex_in(spark):
    existing = spark.createDataFrame([(1, "a", "s1"), (2, "b", "s1"), (3, "c", "s2")], SCHEMA)
    incoming = spark.createDataFrame([(2, "B", "s1"), (4, "D", "s1"), (4, "D2", "s1"), (5, "E", "s2")], SCHEMA)
    return existing, incoming


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_add_new_insert_only_and_idempotent(spark):
    ex, inc = _ex_in(spark)
    inc = inc.where(F.col("v") != "D2")
    once = cg.add_new(ex, inc, ["k"])
    assert _rows(once) == [(1, "a", "s1"), (2, "b", "s1"), (3, "c", "s2"), (4, "D", "s1"), (5, "E", "s2")]
    assert _rows(cg.add_new(once, inc, ["k"])) == _rows(once)


def test_reconcile_scope(spark):
    ex, inc = _ex_in(spark)
    inc = inc.where(F.col("v") != "D2")
    res, added, removed = cg.reconcile(ex, inc, ["k"], "scope", "s1")
    assert _rows(res) == [(2, "b", "s1"), (3, "c", "s2"), (4, "D", "s1")]
    assert _rows(added) == [(4, "D", "s1")] and _rows(removed) == [(1, "a", "s1")]
    again, a2, r2 = cg.reconcile(res, inc, ["k"], "scope", "s1")
    assert _rows(again) == _rows(res) and a2.count() == 0 and r2.count() == 0
    c = cg.reconcile_counts(ex, inc, ["k"], "scope", "s1").first()
    assert (c.added, c.removed) == (1, 1)


def test_replace(spark):
    ex, inc = _ex_in(spark)
    empty = inc.where(F.lit(False))
    assert cg.replace(ex, empty, keep_if_empty=True) is ex
    assert cg.replace(ex, empty).count() == 0
    assert cg.replace(ex, inc, keep_if_empty=True) is inc


def test_snapshots_display_and_window(spark):
    df = spark.createDataFrame(
        [("c1", "rs:c1-2024-01-02-03-04-05-123", dt.datetime(2024, 1, 2, 3, 4, 5)),
         ("c1", "manual-1", dt.datetime(2024, 1, 2)),
         ("c1", "rs:c1-2024-01-09-03-04-05-123", dt.datetime(2024, 1, 9, 3, 4, 5))],
        "cluster string, identifier string, create_time timestamp_ntz",
    )
    got = cg.snapshots(df, dt.datetime(2024, 2, 1), "2024/01/02", "2024/01/05").collect()
    assert len(got) == 1
    assert got[0].create_time_str == "202401021104"
    assert got[0].display_name == "rs:c1-2024-01-02-11-04-05"  # B10: 23 stamp characters cut
    # rows exactly 35 days old are dropped (<=)
    assert cg.apply_retention(df, "create_time", dt.datetime(2024, 2, 13, 3, 4, 5)).count() == 0
    assert cg.apply_retention(df, "create_time", dt.datetime(2024, 2, 6, 3, 4, 5)).count() == 1
    assert cg.apply_retention(df, "create_time", dt.datetime(2024, 2, 6)).count() == 2


def test_restored_clusters(spark):
    df = spark.createDataFrame([("bi-snapshot-20240101t010203",), ("bi-snapshot-2024t1",), ("x",)], "identifier string")
    assert [r.identifier for r in cg.restored_clusters(df).collect()] == ["bi-snapshot-20240101t010203"]


def test_search(spark):
    df = spark.createDataFrame(
        [(1, "Red Bolt", "small"), (2, "red gear", None), (3, "blue bolt", "SMALL red"), (4, "red bolt", "big x")],
        "id int, name string, kind string",
    )
    assert cg.parse_search('red "big x" -Gear') == (["red", "big x"], ["Gear"])
    got = sorted(r.id for r in cg.search(df, ["name", "kind"], "red bolt").collect())
    assert got == [1, 3, 4]  # each term in some field
    got = sorted(r.id for r in cg.search(df, ["name", "kind"], "red -SMALL").collect())
    assert got == [2, 4]  # excluded in any field; null never matches
    got = sorted(r.id for r in cg.search(df, ["name", "kind"], '"big x"').collect())
    assert got == [4]


def test_facets_pick_drill_scoped(spark):
    df = spark.createDataFrame(
        [("a", 1, dt.datetime(2023, 5, 1)), ("a", 2, dt.datetime(2024, 5, 1)), ("b", 1, dt.datetime(2024, 5, 3))],
        "seg string, n int, t timestamp_ntz",
    )
    f = _rows(cg.facets(df, ["seg", "n"]))
    assert f == [("n", "1", 2), ("n", "2", 1), ("seg", "a", 2), ("seg", "b", 1)]
    assert cg.pick(df, {"seg": "a", "n": 2}).count() == 1
    assert _rows(cg.date_drill(df, "t")) == [(dt.date(2023, 1, 1), 1), (dt.date(2024, 1, 1), 2)]
    assert _rows(cg.date_drill(df, "t", 2024, 5)) == [(dt.date(2024, 5, 1), 1), (dt.date(2024, 5, 3), 1)]
    assert cg.scoped(df, "seg", None).count() == 0 and cg.scoped(df, "seg", "b").count() == 1


def test_full_refresh_missing_endpoint_fails(spark):
    eps = spark.createDataFrame([("e1", "ep1", "mysql", "db")], "arn string, id string, engine string, database string")
    tasks = spark.createDataFrame(
        [("t1", "a1", "e1", "e1", "{}", "{}"), ("t2", "a2", "e1", "missing", "{}", "{}")],
        "task_id string, arn string, source_arn string, target_arn string, settings string, mappings string",
    )
    stats = spark.createDataFrame([("a1", "x", "s")], "task_arn string, table string, schema string")
    inv = cg.full_refresh(eps, tasks.where(F.col("task_id") == "t1"), stats)
    assert inv["tasks"].count() == 1 and inv["tables"].first().task_name == "t1"
    with pytest.raises(Exception, match="endpoint missing"):
        cg.full_refresh(eps, tasks, stats)["tasks"].collect()


def test_dashboard_queries(spark):
    hist = spark.createDataFrame(
        [(1, 102, dt.datetime(2024, 1, 12, 17), 185_000_000, "-- MBI:ä1x query: u1 select"),
         (2, 109, dt.datetime(2024, 1, 12, 15), 60_000_000, "-- MBI:c2 select"),  # +8h is before the window
         (3, 5, dt.datetime(2024, 1, 15), 1, "-- MBI:c3"),  # other user
         (4, 102, dt.datetime(2024, 1, 15), 1, "x" * 70 + "-- MBI:late query: q")],
        "query_id bigint, user_id int, start_time timestamp_ntz, elapsed_us bigint, query_text string",
    )
    got = {r.query_id: r for r in hs.dashboard_queries(hist, dt.date(2024, 1, 20), (102, 109)).collect()}
    assert set(got) == {1, 4}
    assert (got[1].start_time, got[1].elapsed, got[1].dashboard_code, got[1].query_uuid) == (
        "2024-01-13 01:00:00", 3, "ä1x", "u1")
    assert (got[4].dashboard_code, got[4].query_uuid) == ("", "")  # markers beyond the first 64 characters
    assert [r.query_id for r in hs.slowest(hs.dashboard_queries(hist, dt.date(2024, 1, 20), (102, 109))).collect()] == [1, 4]


def test_maintenance_rank_nulls_kept_last(spark):
    info = spark.createDataFrame([("s", "a", None), ("s", "b", 3.0), ("s", "c", 9.0)], "schema string, table string, benefit double")
    got = [tuple(r) for r in hs.maintenance_rank(info, 3).collect()]
    assert got == [(9.0, "vacuum s.c;"), (3.0, "vacuum s.b;"), (None, "vacuum s.a;")]  # B11
    plan = hs.maintenance_rank(info)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_slot_lag(spark):
    slots = spark.createDataFrame(
        [("db", True, "s1", "16/B374D848", "16/B374D848"), ("db", False, "s2", "0/0", "16/B374D848"),
         (None, True, "s3", "0/0", "1/0"), ("", True, "s4", "0/0", "1/0"), ("db", True, "s5", "0/10", "0/2810")],
        "database string, active boolean, slot_name string, restart_lsn string, current_lsn string",
    )
    got = {r.slot_name: (r.lag_bytes, r.lag_size) for r in hs.slot_lag(slots).collect()}
    assert got == {"s1": (0, "0 bytes"), "s2": (97500059720, "91 GB"), "s5": (10240, "10 kB")}


def test_full_refresh_missing_task_fails(spark):
    eps = spark.createDataFrame([("e1", "ep1", "mysql", "db")], "arn string, id string, engine string, database string")
    tasks = spark.createDataFrame([("t1", "a1", "e1", "e1", "{}", "{}")],
                                  "task_id string, arn string, source_arn string, target_arn string, settings string, mappings string")
    stats = spark.createDataFrame([("a1", "x", "s"), ("a9", "y", "s")], "task_arn string, table string, schema string")
    inv = cg.full_refresh(eps, tasks, stats)
    with pytest.raises(Exception, match="task missing"):
        inv["tables"].collect()


def test_size_pretty_branches(spark):
    vals = [0, 10239, 10240, 1048575, 20 * 1024 * 1024, 10 * 1024**3, 5 * 1024**4, 30 * 1024**4, -20000, None]
    df = spark.createDataFrame([(v,) for v in vals], "s bigint")
    got = [r[0] for r in df.select(hs.size_pretty("s")).collect()]
    assert got == ["0 bytes", "10239 bytes", "10 kB", "1024 kB", "20 MB", "10 GB", "5120 GB", "30 TB", "-20 kB", None]


def test_run_sql(spark):
    from pipewatch.operators.sql import run_sql

    assert run_sql(spark, "   ") is None
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    got = run_sql(spark, "SELECT count(*) AS n FROM pw_sql_t WHERE k > 1", {"pw_sql_t": t}).first().n
    assert got == 1
    assert not spark.catalog.tableExists("pw_sql_t")  # the session keeps no view
    t.createOrReplaceTempView("pw_sql_own")
    assert run_sql(spark, "SELECT * FROM pw_sql_own", {"pw_sql_own": t.limit(1)}).count() == 1
    assert spark.table("pw_sql_own").count() == 2  # the session's own view is back
    spark.catalog.dropTempView("pw_sql_own")


def test_run_sql_without_rows(spark, tmp_dir):
    from pipewatch.operators.sql import run_sql

    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert run_sql(spark, f"INSERT OVERWRITE DIRECTORY '{tmp_dir}' USING parquet SELECT k FROM pw_sql_t", {"pw_sql_t": t}, rows=False) is None
    assert sorted(r.k for r in spark.read.parquet(tmp_dir).collect()) == [1, 2]
    assert run_sql(spark, "SELECT k FROM pw_sql_t", {"pw_sql_t": t}, rows=False) is None
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|Division"):  # a query runs to its end
        run_sql(spark, "SELECT k / (k - 1) FROM pw_sql_t", {"pw_sql_t": t}, rows=False)
    assert not spark.catalog.tableExists("pw_sql_t")

import re
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from pipewatch.functions.names import PARTITION_NAME_RULES, fold_partition_name, strip_partition_suffix
from pipewatch.operators import stats as sx

_RULES = [(re.compile(p), label) for p, label in PARTITION_NAME_RULES]


def _py_fold(name):
    for rx, label in _RULES:
        m = rx.fullmatch(name)
        if m:
            return m.group(1), label
    return name, None


_piece = st.sampled_from(["order", "line", "a", "x9", "_", "p", "default", "2021", "202101", "20210102",
                          "2021_01", "2021_01_02", "1", "12", "123", "1234", "Upper", "é"])
_names = st.lists(_piece, min_size=1, max_size=5).map(lambda xs: "_".join(xs))

HAND = ["orders_p1_default", "orders_12_2021", "orders_p3_202101", "orders_3_2021_01_02", "orders_default_p7",
        "orders_2021_p9", "orders_2021_01_1", "orders_20210102_p12", "orders_default", "orders_2021",
        "orders_p202101", "orders_2021_01_02", "orders_p12", "order2_1", "Orders_2021", "orders", "a_1",
        "x_1234567", "orders_2021\n"]


def _check(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "t string")
    got = {r.t: (r.f.base, r.f.rule) for r in df.select("t", fold_partition_name("t").alias("f")).collect()}
    for n in names:
        assert got[n] == _py_fold(n), n


def test_fold_hand_made(spark):
    _check(spark, HAND)


@settings(max_examples=3, deadline=None)
@given(st.lists(_names, min_size=20, max_size=60, unique=True))
def test_fold_matches_python_fullmatch(spark, names):
    _check(spark, names)


def test_short_fold_differs_from_rule_fold(spark):
    df = spark.createDataFrame([("order2_1",), ("orders_p2021_x",), ("plain",)], "t string")
    got = [r.s for r in df.select(strip_partition_suffix("t").alias("s")).collect()]
    assert got == ["order2", "orders", "plain"]
    assert df.select(fold_partition_name("t").base.alias("b")).first().b == "order2_1"


def _catalogue(spark):
    tasks = spark.createDataFrame(
        [("t1", "arn:1", "ep:a", "ep:b", dt.datetime(2024, 1, 1)), ("t2", "arn:2", "ep:c", "ep:b", dt.datetime(2024, 2, 1)),
         ("t3", "arn:3", "ep:a", "ep:c", dt.datetime(2024, 3, 1))],
        "task_id string, arn string, source_arn string, target_arn string, started timestamp_ntz",
    )
    eps = spark.createDataFrame([("ep:a", "db1"), ("ep:b", "dbt"), ("ep:c", "")], "arn string, database string")
    stats = spark.createDataFrame(
        [("arn:2", "s", "orders_p1_2021", 1, 0, 0, 1), ("arn:1", "s", "orders_2022", 2, 2, 0, 2),
         ("arn:1", "s", "orders_2021", 0, 0, 0, 3), ("arn:2", "s", "users", 0, 5, 0, 4),
         ("arn:1", "s", "orders_p2_2021", 0, 0, 4, 0)],
        "task_arn string, schema string, table string, inserts bigint, updates bigint, deletes bigint, seen_no bigint",
    )
    return tasks, eps, stats


def test_change_counts(spark):
    tasks, eps, stats = _catalogue(spark)
    got = [tuple(r) for r in sx.change_counts(stats, tasks, eps).collect()]
    # db prefix only when the source endpoint has a database; first seen = smallest seen_no
    assert got == [
        ("db1.s.orders", 8, dt.datetime(2024, 1, 1), "t1"),
        ("s.users", 5, dt.datetime(2024, 2, 1), "t2"),
        ("s.orders", 1, dt.datetime(2024, 2, 1), "t2"),
    ]


def test_tables_per_task_zero(spark):
    tasks, _, stats = _catalogue(spark)
    got = [tuple(r) for r in sx.tables_per_task(tasks, stats).collect()]
    assert got == [("t1", 3), ("t2", 2), ("t3", 0)]


def test_tasks_with_table_and_known(spark):
    tasks, _, stats = _catalogue(spark)
    known = spark.createDataFrame([("t1",), ("old-x",)], "task_id string")
    got = sorted(r.task_id for r in sx.tasks_with_table(tasks, stats, "orders").collect())
    assert got == ["t1", "t2"]
    new = [r.task_id for r in sx.tasks_with_table(tasks, stats, "orders", known=known, purge_suffix="-x").collect()]
    assert sorted(new) == ["t1", "t2"]  # t1 purged from the stored list (lacks -x)
    new2 = [r.task_id for r in sx.tasks_with_table(tasks, stats, "orders", known=known).collect()]
    assert new2 == ["t2"]


def test_new_logical_tables_ignores_schema(spark):
    stats = spark.createDataFrame(
        [("arn:1", "s1", "orders_p1"), ("arn:1", "s2", "orders_p2"), ("arn:1", "s1", "users")],
        "task_arn string, schema string, table string",
    )
    known = spark.createDataFrame([("arn:1", "orders", "other")], "task_arn string, name string, schema string")
    got = sorted(tuple(r) for r in sx.new_logical_tables(stats, known).collect())
    assert got == [("arn:1", "users", "s1")]  # B16: (task, name) known in any schema


def test_tasks_of_endpoint(spark):
    tasks, _, _ = _catalogue(spark)
    got = sorted(r.task_id for r in sx.tasks_of_endpoint(tasks, "ep:c").collect())
    assert got == ["t2", "t3"]
    known = spark.createDataFrame([("t2",)], "task_id string")
    assert [r.task_id for r in sx.tasks_of_endpoint(tasks, "ep:c", known).collect()] == ["t3"]


def test_change_counts_export_csv(spark, tmp_dir):
    from pipewatch.sources.sinks import export

    tasks, eps, stats = _catalogue(spark)
    full = sx.change_counts(stats, tasks, eps, topn=None)
    export(full, tmp_dir, "csv")
    back = spark.read.option("header", "true").csv(tmp_dir)
    assert sorted(r.table_name for r in back.collect()) == ["db1.s.orders", "s.orders", "s.users"]

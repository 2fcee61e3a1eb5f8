import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pipewatch.functions.times import to_local
from pipewatch.operators import items as it
from pipewatch.operators import loads as ld
from pipewatch.operators import schema as sc


def test_backfill_idempotent_null_key_and_plan(spark, tmp_dir):
    src = spark.createDataFrame(
        [(1, "a", "2025/02/18/02", 1), (2, "b", "2025/02/18/05", 1), (3, "c", "2025/02/18/09", 1),
         (None, "n", "2025/02/18/03", 1), (4, "d", "2025/02/1", 1)],
        "id int, v string, event_time string, only_src int",
    )
    tgt = spark.createDataFrame([(2, "old", 0)], "id int, v string, only_tgt int")
    tgt.write.parquet(tmp_dir)
    new = ld.backfill(src, spark.read.parquet(tmp_dir), "2025/02/18/02", "2025/02/18/07")
    assert new.columns == ["id", "v"]  # sorted common columns
    assert sorted((r.id is None, r.v) for r in new.collect()) == [(False, "a"), (True, "n")]  # B20
    assert "LeftAnti" in new._jdf.queryExecution().executedPlan().toString()
    ld.append(new, tmp_dir)
    again = ld.backfill(src.where(F.col("id").isNotNull()), spark.read.parquet(tmp_dir), "2025/02/18/02", "2025/02/18/07")
    assert again.count() == 0
    with pytest.raises(ValueError):
        ld.backfill(src.select("v", "event_time"), tgt.select("only_tgt"), "a", "b")


def test_unload_load_labels(spark, tmp_dir):
    df = spark.range(0, 30).withColumnRenamed("id", "k").repartition(3)
    ld.unload(df, tmp_dir)
    ld.unload(df.where("k < 10").coalesce(1), tmp_dir + "_x")  # a sibling with the same name prefix
    got = ld.load(spark, tmp_dir, ["k"], "orders", attempt=2)
    labels = sorted({r.label for r in got.collect()})
    assert labels == ["orders__2__1", "orders__2__2", "orders__2__3"]
    assert got.count() == 30  # exact folder only (B13)
    files = sorted(f for f in os.listdir(tmp_dir) if f.endswith(".parquet"))
    first = spark.read.parquet(os.path.join(tmp_dir, files[0])).count()
    assert got.where(F.col("label") == "orders__2__1").count() == first


def test_load_status(spark):
    log = spark.createDataFrame(
        [("l1", "LOADING", dt.datetime(2024, 1, 1)), ("l1", "FINISHED", dt.datetime(2024, 1, 2)),
         ("l2", "CANCELLED", dt.datetime(2024, 1, 1))],
        "label string, state string, create_time timestamp_ntz",
    )
    assert sorted((r.label, r.state) for r in ld.load_status(log).collect()) == [("l1", "FINISHED"), ("l2", "CANCELLED")]


def test_models(spark):
    df = spark.createDataFrame([(1, "a", 1, 5.0), (1, "b", 2, 7.0), (2, "c", 1, 1.0)], "k int, v string, seq int, x double")
    assert ld.apply_model(df, "detail", ["k"]).count() == 3
    uniq = sorted(tuple(r) for r in ld.apply_model(df, "unique", ["k"], order=["seq"]).collect())
    assert uniq == [(1, "b", 2, 7.0), (2, "c", 1, 1.0)]
    agg = sorted(tuple(r) for r in ld.apply_model(df, "aggregate", ["k"], aggs=[F.sum("x").alias("x")]).collect())
    assert agg == [(1, 12.0), (2, 1.0)]
    with pytest.raises(ValueError):
        ld.apply_model(df, "aggregate", ["k"])  # B14
    with pytest.raises(ValueError):
        ld.write_model(df, "t_none", "detail", ["k"], None)
    assert ld.default_keys(df) == (["k"], ["k"])


def test_restore_tables_skips_existing(spark, tmp_dir):
    spark.range(5).write.parquet(f"{tmp_dir}/snap/db/ods/t1")
    when = dt.datetime(2024, 1, 1, 20, 0)
    schema = "restore_test_" + os.path.basename(tmp_dir)[:8]
    st1 = ld.restore_tables(spark, f"{tmp_dir}/snap", ["db.ods.t1"], when, schema=schema, schema_location=f"{tmp_dir}/wh")
    assert [tuple(r) for r in st1.collect()] == [("db.ods.t1", "t1_202401020400", "restored")]
    assert spark.table(f"{schema}.t1_202401020400").count() == 5
    st2 = ld.restore_tables(spark, f"{tmp_dir}/snap", ["db.ods.t1"], when, schema=schema)
    assert st2.first().status == "skipped"


def test_heads(spark):
    a = spark.createDataFrame([(i, f"x{i}") for i in range(10)], "k int, v string")
    h = ld.heads({"a": a}, 3, {"a": ["k"]}).collect()
    assert [(r.rn, r.row_json) for r in h] == [(1, '{"k":0,"v":"x0"}'), (2, '{"k":1,"v":"x1"}'), (3, '{"k":2,"v":"x2"}')]
    by = ld.heads_by(a.withColumn("g", F.col("k") % 2), ["g"], ["k"], 2)
    assert sorted(r.k for r in by.collect()) == [0, 1, 2, 3]


def test_apply_mapping_modes(spark, tmp_dir):
    t = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    n = spark.createDataFrame([(1,)], "x int")
    data = ld.apply_mapping({"t": t, "n": n}, ["t"], "init_", "ods", "data")
    assert list(data) == ["ods.init_t"] and data["ods.init_t"].count() == 2
    sch = ld.apply_mapping({"t": t, "n": n}, ["t", "n"], "p_", "stg", "schema")
    assert sch["stg.p_t"].count() == 1 and sch["stg.p_n"].count() == 0
    ld.write_mapping(sch, tmp_dir)
    assert spark.read.parquet(f"{tmp_dir}/stg/p_n").columns == ["x"]  # structure without data


def _profile(spark):
    from pyspark.sql import types as T

    struct = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("op", T.StringType()),
        T.StructField("name", T.VarcharType(20)), T.StructField("amt", T.DecimalType(12, 3)),
        T.StructField("t", T.TimestampNTZType()), T.StructField("ok", T.BooleanType()),
    ])
    return sc.columns_of(spark, {"x": struct})


def test_cdc_mapping_op_and_extras(spark):
    cols = _profile(spark)
    got = {r.column: (r.position, r.cdc_type) for r in sc.map_types_cdc(cols).collect()}
    assert got["op"] == (2, "char(1)")  # B12: compared before quoting, not added twice
    assert got["name"][1] == "varchar(20)" and got["amt"][1] == "numeric(12, 3)" and got["t"][1] == "timestamp"
    assert "ok" not in got and got["commit_timestamp"] == (7, "varchar(50)") and got["cdc_transact_id"][1] == "varchar(50)"
    assert [r.column for r in sc.cdc_rejects(cols).collect()] == ["ok"]


def test_serving_mapping(spark):
    got = {r.column: r.serving_type for r in sc.map_types_serving(_profile(spark), "name,  id").collect()}
    assert got == {"id": "bigint", "op": "string", "name": "varchar(20)", "amt": "decimal", "t": "datetime", "ok": "boolean"}


def test_conform_and_partition_pruning(spark, tmp_dir):
    df = spark.createDataFrame(
        [(1, "2025/02/18/02", "9.5"), (2, "2025/02/18/09", "x")], "id bigint, event_time string, amt string"
    )
    conformed = sc.conform_cdc(df, [("id", "bigint"), ("amt", "numeric(5, 2)"), ("op", "char(1)"), ("op", "char(1)")])
    assert conformed.columns == ["id", "amt", "op", "event_time"]
    sc.write_cdc(conformed, tmp_dir)
    back = sc.read_cdc(spark, tmp_dir, conformed.schema).where(F.col("event_time").between("2025/02/18/00", "2025/02/18/05"))
    assert [(r.id, str(r.amt)) for r in back.collect()] == [(1, "9.50")]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_time" in plan


def test_items(spark):
    items = spark.createDataFrame(
        [("c1", {"name": {"S": "Ann"}, "bal": {"N": "1.5"}}), ("c2", {"name": {"S": "Bo"}})],
        "key string, item map<string, map<string,string>>",
    )
    plain = it.unwrap_items(items)
    assert plain.where("key = 'c1'").first().item == {"name": "Ann", "bal": "1.5"}
    assert sorted(tuple(r) for r in it.attributes(items).collect()) == [("c1", "bal", "1.5"), ("c1", "name", "Ann"), ("c2", "name", "Bo")]
    keys = spark.createDataFrame([("c1", dt.datetime(2024, 1, 1)), ("c2", dt.datetime(2024, 1, 3))], "key string, time timestamp_ntz")
    assert [r.key for r in it.latest_items(keys, items, "key", "time", 1).collect()] == ["c2"]
    assert it.items_by_key(items, "key", "  ").count() == 0
    assert it.items_by_key(items, "key", "c1").count() == 1


def test_to_local(spark):
    df = spark.createDataFrame(
        [("2024-01-01T20:00:00.123Z",), ("2024-01-01T20:00:00",), ("2024-13-01T20:00:00",), ("hello",), (None,)], "s string"
    )
    got = [r.l for r in df.select(to_local("s").alias("l")).collect()]
    assert got == ["2024-01-02T04:00:00", "2024-01-02T04:00:00", "2024-13-01T20:00:00", "hello", None]


def test_times_ignore_session_zone(spark):
    from pipewatch.functions.times import format_ntz, parse_ntz

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'1998-04-05 02:30:00' AS t, '1998-04-04T18:30:00' AS s")
        r = df.select(
            format_ntz("t", "yyyyMMddHHmm").alias("a"),
            format_ntz("t", "yyyy/MM/dd/HH").alias("b"),
            to_local("s").alias("c"),
            parse_ntz(F.lit("1998-04-05 02:30:00"), "yyyy-MM-dd HH:mm:ss").cast("string").alias("d"),
        ).first()
        # 02:30 on that day does not exist in Los Angeles; wall times must not move
        assert (r.a, r.b, r.c, r.d) == ("199804050230", "1998/04/05/02", "1998-04-05T02:30:00", "1998-04-05 02:30:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_columns_of_measures_text_length(spark):
    df = spark.createDataFrame([("ab", None, 1), ("abcé", None, 2)], "s string, empty string, n int")
    prof = {r.column: (r.data_type, r.char_len) for r in sc.columns_of(spark, {"t": df}, measure=True).collect()}
    assert prof == {"s": ("character varying", 4), "empty": ("character varying", 1), "n": ("integer", None)}
    cdc = {r.column: r.cdc_type for r in sc.map_types_cdc(sc.columns_of(spark, {"t": df}, measure=True)).collect()}
    assert cdc["s"] == "varchar(4)"
    assert sc.columns_of(spark, {"t": df}).where("column = 's'").first().char_len == 65535


def test_catalog_heads_skips_system_and_rs(spark, tmp_dir):
    import uuid

    from pipewatch.sources.sinks import save_table

    tag = uuid.uuid4().hex[:8]
    keep, skip = f"heads_{tag}", f"rs_{tag}"
    spark.sql(f"CREATE DATABASE {keep} LOCATION '{tmp_dir}/k'")
    spark.sql(f"CREATE DATABASE {skip} LOCATION '{tmp_dir}/s'")
    save_table(spark.range(10), f"{keep}.t")
    save_table(spark.range(10), f"{skip}.t")
    got = ld.catalog_heads(spark, n=2)
    names = {r.table_name for r in got.collect()}
    assert f"{keep}.t" in names and f"{skip}.t" not in names
    assert got.where(F.col("table_name") == f"{keep}.t").count() == 2


def test_load_keeps_rows_of_a_file_apart_from_one_task(spark, tmp_dir):
    """Neither the write of one task nor the load sorts the rows of a folder."""
    path = tmp_dir
    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("flag"))
    with ld.open_writers(spark):
        rows.repartition(1, "flag").write.partitionBy("flag").parquet(path)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == 0
    files = spark.read.parquet(path).inputFiles()
    assert len(files) == 3 and len({f.rsplit("/", 1)[1] for f in files}) == 1
    got = ld.load(spark, path, ["id", "flag"], "x")
    assert got.groupBy("label").agg(F.count("*"), F.min("flag"), F.max("flag")).orderBy("label").collect() == [
        (f"x__1__{i + 1}", 334 if i == 0 else 333, i, i) for i in range(3)
    ]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan

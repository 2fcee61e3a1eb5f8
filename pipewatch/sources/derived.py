"""Logical inputs of the audits, derived by Spark from the driver tables.

In production these rows come from cloud service APIs, Kafka and warehouse
catalogues; here each one is a deterministic projection of a driver table
(see FIXTURES.md), so the work of every audit grows with the tables.
Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewatch.functions.times import format_ntz
from pipewatch.sources.tables import read_table

_FMT = "yyyy-MM-dd HH:mm:ss"
EPOCH_2024 = "2024-01-01 00:00:00"


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _ts(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")


# ------------------------------------------------------------- message logs
def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mild disorder: broker time = ts + (event_id*7919 % 3600) s (see
    :func:`events_as_log`)."""
    return events_as_log(read_table(spark, sf_dir, "events"))


def events_as_log(ev: DataFrame) -> DataFrame:
    """Events (batch or stream) as a message log.

    value: ``{"id": user_id, "event_time": ..., "modify_time": ..., "type":
    event_type}``; every tenth row (id % 10 = 3) has no ``event_time`` (the
    fallback is read); id % 97 = 0 carries an unparsable event time."""
    eid = F.col("event_id")
    t = format_ntz("ts", _FMT)
    event_time = F.when(eid % 97 == 0, F.lit("not a time")).when(eid % 10 != 3, t)
    value = F.to_json(
        F.struct(
            F.col("user_id").alias("id"),
            event_time.alias("event_time"),
            t.alias("modify_time"),
            F.col("event_type").alias("type"),
        )
    )
    return ev.select(
        F.lit(0).alias("partition"),
        eid.alias("offset"),
        F.timestamp_add("SECOND", (eid * 7919) % 3600, F.col("ts")).alias("timestamp"),
        value.alias("value"),
    )


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strong disorder: orders in key order, event time = order date."""
    return orders_as_log(read_table(spark, sf_dir, "orders"))


def orders_as_log(o: DataFrame) -> DataFrame:
    """Orders (batch or stream) as a message log."""
    value = F.to_json(F.struct(F.col("o_custkey").alias("id"), format_ntz("o_orderdate", _FMT).alias("event_time")))
    return o.select(
        F.lit(0).alias("partition"),
        F.col("o_orderkey").alias("offset"),
        F.col("o_orderdate").alias("timestamp"),
        value.alias("value"),
    )


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed copy of :func:`events_log` with damage: keys changed where
    event_id % 997 = 5, rows lost where event_id % 1009 = 7."""
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    key = F.when(eid % 997 == 5, F.concat(_s("user_id"), F.lit("x"))).otherwise(_s("user_id"))
    return ev.where(eid % 1009 != 7).select(
        F.lit(0).alias("partition"),
        eid.alias("offset"),
        key.alias("key"),
        F.timestamp_diff("SECOND", _ts("1970-01-01 00:00:00"), F.col("ts")).alias("ts"),
    )


def topic_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic names built from parts; some internal (``__``/``--``)."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    base = F.concat(F.lower("p_type"), F.lit("."), F.regexp_replace("p_name", " ", "-"), F.lit("-"), _s(k))
    name = F.when(k % 10 == 0, F.concat(F.lit("__"), base)).when(k % 10 == 1, F.concat(F.lit("--"), base)).otherwise(base)
    return p.select(name.alias("name"))


# ----------------------------------------------------- replication catalogue
def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replication tasks, one per supplier."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    created = F.timestamp_add("HOUR", k, _ts(EPOCH_2024))
    return s.select(
        F.concat(F.lit("task-"), _s(k)).alias("task_id"),
        F.concat(F.lit("arn:task:"), _s(k)).alias("arn"),
        F.concat(F.lit("arn:ep:"), _s("s_nationkey")).alias("source_arn"),
        F.concat(F.lit("arn:ep:"), _s((F.col("s_nationkey") + 7) % 25)).alias("target_arn"),
        F.when(k % 3 == 0, "running").when(k % 3 == 1, "stopped").otherwise("failed").alias("status"),
        F.when(k % 2 == 0, "cdc").otherwise("full-load-and-cdc").alias("migration_type"),
        F.concat(F.lit("arn:ri:"), _s(k % 4)).alias("instance_arn"),
        F.concat(F.lit('{"TargetMetadata":{"ParallelLoadThreads":'), _s(k % 8), F.lit("}}")).alias("settings"),
        F.concat(F.lit('{"rules":[{"rule-id":"'), _s(k), F.lit('"}]}')).alias("mappings"),
        created.alias("created"),
        F.timestamp_add("DAY", F.lit(1), created).alias("started"),
    )


def endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoints, one per nation; database empty for every third."""
    n = read_table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    r = F.col("n_regionkey")
    engine = (
        F.when(r == 0, "mysql").when(r == 1, "postgres").when(r == 2, "aurora").when(r == 3, "sqlserver").otherwise("mariadb")
    )
    return n.select(
        F.concat(F.lit("arn:ep:"), _s(k)).alias("arn"),
        F.concat(F.lower("n_name"), F.lit("-ep")).alias("id"),
        F.when(k % 2 == 0, "SOURCE").otherwise("TARGET").alias("type"),
        engine.alias("engine"),
        F.upper(engine).alias("engine_name"),
        F.lit("active").alias("status"),
        F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lower("n_name"), F.lit("_db"))).alias("database"),
        F.concat(F.lit("db"), _s(r), F.lit(".example")).alias("server"),
    )


def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-table change counts: lineitem grouped by (supplier pair, schema,
    physical table name); inserts/updates/deletes counted by return flag and
    line status; ``seen_no`` orders the rows as an API would list them."""
    li = read_table(spark, sf_dir, "lineitem")
    y = _s(F.year("l_shipdate"))
    m = F.lpad(_s(F.month("l_shipdate")), 2, "0")
    ln = F.col("l_linenumber") % 4
    table = (
        F.when(ln == 0, F.concat(F.lit("order_line_"), y))
        .when(ln == 1, F.concat(F.lit("order_line_p"), m, F.lit("_"), y))
        .when(ln == 2, F.concat(F.lit("returns_"), F.lower("l_returnflag"), F.lit("_default")))
        .otherwise(F.concat(F.lit("lineitem2_"), _s(F.col("l_orderkey") % 7)))
    )
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    staged = li.select(
        F.concat(F.lit("arn:task:"), _s(F.floor(F.col("l_suppkey") / 2) * 2)).alias("task_arn"),
        F.concat(F.lit("sch"), _s(F.col("l_partkey") % 3)).alias("schema"),
        table.alias("table"),
        F.when((flag == "N") & (status == "O"), 1).otherwise(0).alias("i"),
        F.when((flag == "R") & (status == "O"), 1).otherwise(0).alias("u"),
        F.when((flag == "A") & (status == "O"), 1).otherwise(0).alias("d"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seen"),
    )
    return staged.groupBy("task_arn", "schema", "table").agg(
        F.sum("i").cast("bigint").alias("inserts"),
        F.sum("u").cast("bigint").alias("updates"),
        F.sum("d").cast("bigint").alias("deletes"),
        F.min("seen").alias("seen_no"),
    )


# ----------------------------------------------------------- warehouse side
def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster snapshots, one per order; every seventh is a manual one whose
    identifier does not end in a time stamp."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    created = F.timestamp_add("SECOND", k % 86400, F.col("o_orderdate"))
    cluster = F.concat(F.lit("cluster-"), _s(F.col("o_custkey") % 5))
    stamp = F.concat(format_ntz(created, "yyyy-MM-dd-HH-mm-ss"), F.lit("-"), F.lpad(_s(k % 1000), 3, "0"))
    ident = F.when(k % 7 == 0, F.concat(F.lit("manual-"), _s(k))).otherwise(F.concat(F.lit("rs:"), cluster, F.lit("-"), stamp))
    return o.select(cluster.alias("cluster"), ident.alias("identifier"), created.alias("create_time"))


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster identifiers; restored clusters end in ``snapshot-<date>t<time>``."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    restored = F.concat(F.lit("bi-snapshot-"), F.lpad(_s(19900000 + k), 8, "0"), F.lit("t"), F.lpad(_s(k % 240000), 6, "0"))
    ident = F.when(k % 4 == 0, restored).otherwise(F.concat(F.lit("cluster-"), F.lower("c_mktsegment"), F.lit("-"), _s(k)))
    return c.select(ident.alias("identifier"))


def table_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse / source table catalogue from parts."""
    p = read_table(spark, sf_dir, "part")
    k, sz = F.col("p_partkey"), F.col("p_size") % 9
    schemas = ["ods", "stg", "dim", "dwd", "dws", "met", "ads", "public", "temp"]
    schema = F.lit(schemas[-1])
    for i in range(len(schemas) - 2, -1, -1):
        schema = F.when(sz == i, schemas[i]).otherwise(schema)
    name = F.concat(F.regexp_replace("p_name", " ", "_"), F.lit("_"), _s(k))
    name = F.when(F.col("p_size") % 11 == 0, F.concat(F.lit("pg_"), name)).otherwise(name)
    ttype = F.when(k % 5 == 0, "VIEW").otherwise("TABLE")
    return p.select(
        F.lit("dw").alias("database"), schema.alias("schema"), name.alias("table"), ttype.alias("type"),
    )


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse query history from events; dashboard queries carry
    ``-- MBI:<code>`` and ``query: <uuid>`` in their text."""
    ev = read_table(spark, sf_dir, "events")
    eid, et = F.col("event_id"), F.col("event_type")
    user = F.when(eid % 4 == 0, 102).when(eid % 4 == 1, 109).otherwise(F.col("user_id")).cast("int")
    dash = F.concat(F.lit("-- MBI:"), et, _s("user_id"), F.lit(" query: q"), _s(eid), F.lit(" select * from t"))
    late = F.concat(F.lpad(F.lit(""), 70, "x"), F.lit(" -- MBI:late"))
    text = (
        F.when(et.isin("click", "view"), dash)
        .when(et == "error", late)
        .otherwise(F.concat(F.lit("select 1 /* "), et, F.lit(" */")))
    )
    return ev.select(
        eid.alias("query_id"),
        user.alias("user_id"),
        F.col("ts").alias("start_time"),
        (F.col("value") * 60000000).cast("bigint").alias("elapsed_us"),
        text.alias("query_text"),
    )


def table_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table maintenance info from parts; every 13th benefit is null."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    benefit = F.when(k % 13 == 0, F.lit(None).cast("double")).otherwise(F.round(F.col("p_retailprice") % 97, 0))
    return p.select(
        F.concat(F.lit("s"), _s(F.col("p_size") % 4)).alias("schema"),
        F.concat(F.regexp_replace("p_name", " ", "_"), F.lit("_"), _s(k)).alias("table"),
        benefit.alias("benefit"),
    )


def replication_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replication slots from events; positions as hex ``X/Y``."""
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    db = F.when(eid % 5 == 0, F.lit(None).cast("string")).when(eid % 5 == 1, F.lit("")).otherwise(
        F.concat(F.lit("db"), _s(F.col("user_id") % 7))
    )
    restart = F.concat(F.hex(F.floor(eid / 7)), F.lit("/"), F.hex((eid * 1000003) % 4294967296))
    current = F.concat(F.hex(F.floor(eid * 3 / 7) + 16), F.lit("/"), F.hex((eid * 7919) % 4294967296))
    return ev.select(
        db.alias("database"),
        (eid % 2 == 0).alias("active"),
        F.concat(F.lit("slot_"), _s(eid)).alias("slot_name"),
        restart.alias("restart_lsn"),
        current.alias("current_lsn"),
    )


def cdc_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows of orders with the CDC columns; ``event_time`` is the
    hourly partition string ``yyyy/MM/dd/HH``."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        "*",
        F.when(k % 3 == 0, "I").when(k % 3 == 1, "U").otherwise("D").alias("op"),
        format_ntz(F.timestamp_add("SECOND", k % 3600, F.col("o_orderdate")), _FMT).alias("commit_timestamp"),
        F.concat(F.lit("tx"), _s(k % 1000)).alias("cdc_transact_id"),
        format_ntz(F.col("o_orderdate"), "yyyy/MM/dd/HH").alias("event_time"),
    )


def load_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-load jobs from suppliers; lag is JSON ``{"partition": "lag"}``."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    lag = F.when(k % 10 == 7, F.lit("{}")).otherwise(
        F.concat(F.lit('{"0":"'), _s(k % 50), F.lit('","1":"'), _s("s_nationkey"), F.lit('"}'))
    )
    state = F.when(k % 4 == 0, "STOPPED").when(k % 4 == 1, "PAUSED").otherwise("RUNNING")
    return s.select(
        F.concat(F.lit("db"), _s(F.col("s_nationkey") % 4)).alias("db"),
        F.concat(F.lit("job_"), _s(k)).alias("name"),
        state.alias("state"),
        lag.alias("lag"),
    )


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load attempts from orders: several entries per label."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("load_"), _s(F.col("o_custkey") % 50)).alias("label"),
        F.when(k % 3 == 0, "FINISHED").when(k % 3 == 1, "LOADING").otherwise("CANCELLED").alias("state"),
        F.timestamp_add("SECOND", k, F.col("o_orderdate")).alias("create_time"),
    )


# ---------------------------------------------------------- key-value items
def typed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as typed items ``{attr: {type: value}}``."""
    c = read_table(spark, sf_dir, "customer")
    item = F.create_map(
        F.lit("c_name"), F.create_map(F.lit("S"), F.col("c_name")),
        F.lit("c_nationkey"), F.create_map(F.lit("N"), _s("c_nationkey")),
        F.lit("c_acctbal"), F.create_map(F.lit("N"), _s("c_acctbal")),
        F.lit("c_mktsegment"), F.create_map(F.lit("S"), F.col("c_mktsegment")),
    )
    return c.select(F.concat(F.lit("c"), _s("c_custkey")).alias("key"), item.alias("item"))


def item_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with times (orders: customer key, order date)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("c"), _s("o_custkey")).alias("key"),
        F.col("o_orderdate").alias("time"),
        F.col("o_orderkey").alias("order_key"),
    )


def physical_table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physical table names in many partition styles (and some that match
    no rule: upper case, five-digit suffixes)."""
    p = read_table(spark, sf_dir, "part")
    k, sz = F.col("p_partkey"), F.col("p_size")
    b = F.regexp_replace("p_name", " ", "_")
    r = k % 8
    name = (
        F.when(r == 0, F.concat(b, F.lit("_"), _s(1990 + sz)))
        .when(r == 1, F.concat(b, F.lit("_p"), _s(sz), F.lit("_default")))
        .when(r == 2, F.concat(b, F.lit("_default_p"), _s(sz % 100)))
        .when(r == 3, F.concat(b, F.lit("_"), _s(200000 + k % 1000)))
        .when(r == 4, F.concat(b, F.lit("_p"), F.lpad(_s(sz), 3, "0")))
        .when(
            r == 5,
            F.concat(b, F.lit("_"), _s(2020 + sz % 5), F.lit("_"), F.lpad(_s(sz % 12 + 1), 2, "0"), F.lit("_"),
                     F.lpad(_s(sz % 28 + 1), 2, "0")),
        )
        .when(r == 6, F.concat(F.upper(b), F.lit("_2020")))
        .otherwise(F.concat(b, F.lit("_"), _s(k)))
    )
    return p.select(name.alias("table"))

"""Readers.  Parquet is the interchange format; JSON text and Kafka are
thin pass-throughs (the Kafka connector is a deploy-time jar)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the driver tables this toolkit reads.
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """Register driver tables as temp views (for :func:`run_sql`)."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options) -> DataFrame:
    """A Kafka topic as a batch message log (``partition, offset, timestamp,
    value string``).  Needs the Kafka connector on the classpath."""
    raw = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )
    return raw.select("partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options) -> DataFrame:
    """Streaming form of :func:`read_kafka` (``starting='latest'`` starts at
    the end of the topic)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )
    return raw.select("partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))


def read_json_log(spark: SparkSession, path: str) -> DataFrame:
    """A message log stored as JSON lines with the log columns."""
    return spark.read.schema("partition int, offset bigint, timestamp timestamp, value string").json(path)

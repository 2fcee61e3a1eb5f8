"""S1 in one pass with a ledger: events and rejects of a topic from one read
and one write of each micro-batch, and an entry that says what has landed.

Layout: ``<path>/data/run=<id>/batch_id=<n>/rejected=<bool>/`` holds messages,
``<path>/ledger/run=<id>/batch_id=<n>/`` one row for each partition of the
topic.  ``run`` is the id that Spark keeps in a query's checkpoint.  The ledger
entry of a batch is written after its data and is its commit: readers take
only batches with an entry, so a batch that failed in between is not seen, and
the replay (same id, same messages) replaces it whole.

A new checkpoint (the old one lost, or a reset to the end) starts a new run.
It leaves out what lies at or before the ledger's last offset of a partition;
with Kafka, :func:`starting_offsets` lets the source start there.  This takes
what Kafka gives: the offsets of a partition arrive in order.  A message that
another run landed meanwhile is left out too.  One query at a time may land
into a path."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pipewatch.operators.topics import marked_events

DATA = "partition int, offset bigint, key string, ts bigint, value string, reason string, run string, batch_id bigint, rejected boolean"
ENTRY = "partition int, first bigint, last bigint, rows bigint, rejects bigint, run string, batch_id bigint"


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The folder's rows; none while it does not exist."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The ledger: for each run, batch and partition of the topic its first and
    last offset, how many messages landed and how many were rejected.  A reset
    is a batch of a run of its own (``reset-...``) without messages."""
    return _read(spark, f"{path}/ledger", ENTRY)


def _committed(spark: SparkSession, path: str, rejected: bool) -> DataFrame:
    data = _read(spark, f"{path}/data", DATA).where(F.col("rejected") == rejected)
    return data.join(entries(spark, path).select("run", "batch_id").distinct(), ["run", "batch_id"], "left_semi")


def landed(spark: SparkSession, path: str) -> DataFrame:
    """``partition, offset, key, ts`` of the messages that have landed."""
    return _committed(spark, path, False).select("partition", "offset", "key", "ts")


def rejected(spark: SparkSession, path: str) -> DataFrame:
    """``partition, offset, value, reason`` of the messages that could not be
    extracted."""
    return _committed(spark, path, True).select("partition", "offset", "value", "reason")


def last_offsets(spark: SparkSession, path: str, but: str | None = None) -> DataFrame:
    """``partition, last``: the last offset the ledger holds, of all runs or of
    all but one."""
    held = entries(spark, path)
    if but is not None:
        held = held.where(F.col("run") != but)
    return held.groupBy("partition").agg(F.max("last").alias("last"))


def starting_offsets(spark: SparkSession, path: str, topic: str) -> str:
    """Kafka's ``startingOffsets`` for a new checkpoint: the offset after the
    ledger's last for each partition (a row of the ledger for each).  A
    partition that the ledger does not know must be added by the caller, as
    Kafka wants all partitions named; ``{}`` for an empty ledger."""
    rows = last_offsets(spark, path).where("last IS NOT NULL").collect()  # one row for each partition of the topic
    return json.dumps({topic: {str(r["partition"]): r["last"] + 1 for r in rows}} if rows else {})


def _commit(spark: SparkSession, path: str, run: str, batch_id: int) -> None:
    """The entry of a batch, from two narrow columns of what was written."""
    at = f"run={run}/batch_id={batch_id}"
    reject = F.col("rejected").cast("bigint")
    written = _read(spark, f"{path}/data/{at}", "partition int, offset bigint, rejected boolean")
    entry = written.groupBy("partition").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.sum(1 - reject).alias("rows"), F.sum(reject).alias("rejects")
    )
    entry.coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger/{at}")  # one file: seen whole or not at all


def start_landing(log_stream: DataFrame, path: str, checkpoint: str, available_now: bool = True, processing_time: str | None = None, **extract) -> StreamingQuery:
    """Start landing a message log (``partition, offset`` and the value) into
    ``path``; pause by ``stop()``, go on by starting again on the same
    checkpoint.  ``extract``: the options of ``topics.split_events``.  Messages
    without a partition or an offset are no messages of a topic and fail the
    batch."""
    run: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not run:  # the query's id, which its checkpoint keeps over restarts
            run.append(spark.read.json(f"{checkpoint}/metadata").first()["id"])
        held = entries(spark, path).where((F.col("run") == run[0]) & (F.col("batch_id") == batch_id))
        if not held.isEmpty():  # committed, but Spark was stopped before it noted that
            return
        known = last_offsets(spark, path, but=run[0]).withColumnRenamed("partition", "__p")
        named = batch.withColumns({
            "partition": F.coalesce(F.col("partition").cast("int"), F.raise_error(F.lit("a message without a partition")).cast("int")),
            "offset": F.coalesce(F.col("offset").cast("bigint"), F.raise_error(F.lit("a message without an offset")).cast("bigint")),
        })
        new = named.join(known, F.col("partition") == F.col("__p"), "left").where("last IS NULL OR offset > last")
        rows = marked_events(new, **extract).withColumn("rejected", F.col("reason").isNotNull())
        rows.write.mode("overwrite").partitionBy("rejected").parquet(f"{path}/data/run={run[0]}/batch_id={batch_id}")
        _commit(spark, path, run[0], batch_id)

    writer = log_stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def land_available(log_stream: DataFrame, path: str, checkpoint: str, **extract) -> None:
    """Land what is there, to its end."""
    q = start_landing(log_stream, path, checkpoint, **extract)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def reset_to_end(log: DataFrame, path: str) -> None:
    """Give up what has not landed yet: an entry with the present end of each
    partition of the log (read as a batch).  The landing must be stopped; it
    goes on behind the end on its checkpoint or on a new one."""
    ends = log.groupBy(F.col("partition").cast("int").alias("partition")).agg(F.max("offset").cast("bigint").alias("last"))
    nothing = F.lit(0).cast("bigint")
    entry = ends.select("partition", F.lit(None).cast("bigint").alias("first"), "last", nothing.alias("rows"), nothing.alias("rejects"))
    entry.coalesce(1).write.mode("errorifexists").parquet(f"{path}/ledger/run=reset-{uuid.uuid4().hex}/batch_id=0")

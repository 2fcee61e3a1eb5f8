"""S2 with ``transformWithState``: per-key lateness on a stream, its running
maxima in a state variable that can be read back.

Keys are dealt to buckets (``key_buckets``); the state of a bucket is the
largest event time seen of each of its keys (``top``), in RocksDB.  The rows of
a bucket reach the processor in Arrow batches of bounded size, in no order.  A
bucket whose rows fill one batch is sorted there.  Rows of a bucket that go on
over more batches are put aside in the state store, by range of ``seq``, and
taken up range by range in order; so a worker holds one Arrow batch or the rows
of one range of a bucket, never all rows of a key.

Rows, ties and nulls: a row is late if an earlier one of its key (smaller
``seq``, or an earlier micro-batch) has a larger event time.  A null event
time is never late and leaves the maximum alone; a null ``seq`` comes last in
its micro-batch; null keys are a key like others.  Rows of a key with equal
``seq`` are taken in the order of their event times, so that none of them is
late because of another.  Event times are whole numbers below 2**53.  Streams without rows give none."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pipewatch.plans.scan import DEFAULT_BUCKET_WIDTH
from pipewatch.streaming.key_buckets import LAST, Tops, bucket, key_columns, key_name

#: ``transformWithState`` needs this state store.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

TOP = "top"
_ROW = np.dtype([("at", "<i8"), ("seq", "<i8"), ("ts", "<f8")])
_RESULT = "name string, diff_ts bigint, id bigint"


def _rows(frame: pd.DataFrame) -> np.ndarray:
    out = np.empty(len(frame), _ROW)
    out["at"] = frame.get("at", 0)  # rows of one key need no number
    out["seq"] = frame["seq"].to_numpy(dtype="int64")
    out["ts"] = frame["ts"].to_numpy(dtype="float64")
    return out


class Lateness(StatefulProcessor):
    """Late rows of a bucket of keys, whose columns have the types ``kinds``;
    ``width``: the range of ``seq`` that is sorted at once when a bucket's rows
    go on over more than one Arrow batch."""

    def __init__(self, kinds: Sequence[T.DataType], width: int, idle_ms: int | None) -> None:
        self.kinds, self.width, self.idle_ms = list(kinds), width, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        times = T.ArrayType(T.LongType())
        kept = T.StructType().add("names", T.ArrayType(T.StringType())).add("tops", times).add("seen", times)
        # Always null: its type tells a reader of the state the types of the key columns.
        kept = kept.add("like", T.StructType([T.StructField(f"k{i}", k) for i, k in enumerate(self.kinds)]))
        self.top = handle.getValueState(TOP, kept, self.idle_ms)
        # (range of seq, running number) -> rows put aside; empty between micro-batches
        self.aside = handle.getMapState("aside", "range bigint, n bigint", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        stored = self.top.get()
        now = 0 if self.idle_ms is None else timerValues.getCurrentProcessingTimeInMs()
        tops = Tops(None if stored is None else stored[:3], now, self.idle_ms)
        first = next(rows, None)
        if first is None:
            return
        second = next(rows, None)
        numbered = (frame.assign(at=tops.numbers(frame["name"])) for frames in ((first, second), rows) for frame in frames if frame is not None)
        for part in [_rows(next(numbered))] if second is None else self._in_order(next(numbered), next(numbered), numbered):
            part = part[np.argsort(part["ts"], kind="stable")]
            yield tops.late(part["at"], part["seq"], part["ts"])
        left = tops.stored()
        if left[0] and (stored is None or self.idle_ms is not None or left[:2] != (list(stored[0]), list(stored[1]))):
            self.top.update((*left, None))  # with a time to live, a visit renews it

    def _in_order(self, *frames) -> Iterator[np.ndarray]:
        first, second, rest = frames
        put: dict[int, list[int]] = {}
        n = 0
        for frame in (f for part in ((first, second), rest) for f in part):
            rows = _rows(frame)
            ranges = rows["seq"] // self.width
            for r in np.unique(ranges).tolist():
                self.aside.updateValue((r, n), (rows[ranges == r].tobytes(),))
                put.setdefault(r, []).append(n)
                n += 1
        for r in sorted(put):
            blobs = [bytes(self.aside.getValue((r, i))[0]) for i in put[r]]
            yield np.frombuffer(b"".join(blobs), _ROW)
            for i in put[r]:
                self.aside.removeKey((r, i))

    def close(self) -> None:
        pass


def late_rows_processor(
    events: DataFrame,
    seq: str = "offset",
    ts: str = "ts",
    keys: Sequence[str] = ("partition", "key"),
    width: int = DEFAULT_BUCKET_WIDTH,
    idle_ms: int | None = None,
) -> DataFrame:
    """Streaming late rows per key: the key columns, ``diff_ts`` and ``id`` (=
    seq).  Start the query inside :func:`rocksdb_state`.

    With ``idle_ms`` the state of a key that sees no rows for that long
    (processing time) is dropped by the store, and its lateness is measured
    afresh when it returns; such a query wants a processing-time trigger, since
    Spark goes on with empty batches under ``availableNow``."""
    keys = list(keys)
    clash = {"diff_ts", "id"} & set(keys)
    if clash:
        raise ValueError(f"the result has columns {sorted(clash)} of its own")
    kinds = [events.schema[k].dataType for k in keys]
    narrow = events.select(
        key_name([F.col(f"`{k}`") for k in keys], kinds).alias("name"),
        F.coalesce(F.col(f"`{seq}`").cast("bigint"), F.lit(LAST)).alias("seq"),  # whole numbers stay so without nulls
        F.col(f"`{ts}`").cast("bigint").alias("ts"),
    )
    found = narrow.withColumn("bucket", bucket(F.col("name"))).groupBy("bucket").transformWithStateInPandas(
        Lateness(kinds, width, idle_ms), _RESULT, "append", "none" if idle_ms is None else "processingTime"
    )
    return found.select(*[c.alias(k) for c, k in zip(key_columns(F.col("name"), kinds), keys)], "diff_ts", "id")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB (a query holds the
    settings it was started with); the session's setting is back afterwards."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def run_late_rows(events: DataFrame, path: str, checkpoint: str, **how) -> DataFrame:
    """Run :func:`late_rows_processor` with ``availableNow`` to its end, into
    Parquet at ``path``; the late rows of all runs on this checkpoint."""
    late = late_rows_processor(events, **how)
    with rocksdb_state(events.sparkSession):
        writer = late.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return events.sparkSession.read.schema(late.schema).parquet(path)


def stored_tops(spark: SparkSession, checkpoint: str, keys: Sequence[str] = ("partition", "key"), batch: int | None = None) -> DataFrame:
    """What the store holds for each key, ``max_ts``, after the last committed
    micro-batch (or after ``batch``), by the state data source."""
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", TOP)
    if batch is not None:
        reader = reader.option("batchId", batch)
    with rocksdb_state(spark):
        state = reader.load()
    kinds = [f.dataType for f in state.schema["value"].dataType["like"].dataType]
    each = state.select(F.explode(F.arrays_zip("value.names", "value.tops")).alias("x"))
    return each.select(*[c.alias(k) for c, k in zip(key_columns(F.col("x.names"), kinds), keys)], F.col("x.tops").alias("max_ts"))

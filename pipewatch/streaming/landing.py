"""Continuous landing of a topic into a Parquet table.

``readStream`` (Kafka, or files in tests) -> key and event time (T3) ->
``writeStream`` Parquet with a checkpoint.  Pause is ``query.stop()``;
resume is :func:`start_landing` again on the same checkpoint (exactly the
unprocessed offsets are read); recreate is a new checkpoint, which with
``startingOffsets=latest`` on the Kafka source starts at the end of the
topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pipewatch.operators.topics import split_events


def start_landing(
    log_stream: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    query_name: str | None = None,
    rejects: bool = False,
    **extract,
) -> StreamingQuery:
    """Start landing ``partition, offset, key, ts`` of a streaming message
    log into ``path``; with ``rejects``, the rows that cannot be extracted and
    their ``reason`` instead (a second query with a checkpoint of its own, so
    no message is lost unseen).  ``available_now`` processes what is there and
    stops; otherwise a processing-time trigger keeps it running."""
    events = split_events(log_stream, **extract)[int(rejects)]
    writer = (
        events.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if query_name:
        writer = writer.queryName(query_name)
    if available_now and not processing_time:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def land_available(log_stream: DataFrame, path: str, checkpoint: str, timeout_s: float | None = None, rejects_path: str | None = None, **extract) -> None:
    """Run :func:`start_landing` with ``availableNow`` to completion; with
    ``rejects_path`` the rejects too (checkpoint ``<checkpoint>_rejects``)."""
    started = [start_landing(log_stream, path, checkpoint, available_now=True, **extract)]
    if rejects_path:
        started.append(start_landing(log_stream, rejects_path, f"{checkpoint}_rejects", available_now=True, rejects=True, **extract))
    for q in started:
        q.awaitTermination(timeout_s)
        if q.exception() is not None:
            raise q.exception()

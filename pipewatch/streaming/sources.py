"""Streaming sources: a driver table replayed as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the Parquet files of one driver table (``<name>.parquet``
    under ``sf_dir``) with the file source; the schema comes from the
    files, so no inference happens on the stream."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(sf_dir)

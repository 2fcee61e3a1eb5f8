"""Sinks: report exports and table writes (CSV and Parquet; xlsx is a
single-machine format and is not offered)."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: export formats.
EXPORT_FORMATS = ("parquet", "csv")


def export(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a report (e.g. the full change-count export) to ``path``.  CSV
    gets a header row; every task writes its own part file, so nothing is
    funnelled through one task."""
    if fmt not in EXPORT_FORMATS:
        raise ValueError(f"unknown export format {fmt!r}; expected one of {EXPORT_FORMATS}")
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.parquet(path)


def save_table(df: DataFrame, table: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    """Write ``df`` as a catalogue table."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)

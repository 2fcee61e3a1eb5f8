"""Stream-load lag list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewatch.functions.maps import json_map, sum_map_values

# Fixed value: jobs in this state are left out.
STOPPED = "STOPPED"


def load_lag(jobs: DataFrame) -> DataFrame:
    """Running and paused stream-load jobs with their total lag (sum of the
    per-partition lags in the JSON ``lag``; ``{}`` gives 0), by db and name."""
    return (
        jobs.where(F.col("state") != STOPPED)
        .select("db", "name", "state", sum_map_values(json_map("lag")).alias("lag"))
        .orderBy("db", "name")
    )

"""Benchmark: run the registered audits at ``$BENCH_SF_DIR`` on
``local[$BENCH_CPUS]`` and print one JSON line.

Each query is executed in full with the ``noop`` sink (no rows are
collected to the driver).  Every query runs once cold (JVM class loading,
code generation, Python worker start - reported as ``cold`` and
``cold_total``), then ``BENCH_REPEAT`` (default 3) more times; ``queries``
holds the median of the warm runs and ``value`` their sum.  Also measured:
the global running max as a plain single-task window against the bucketed
prefix max (``scan_*`` entries).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4)))
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from pipewatch.operators import topics
    from pipewatch.plans import registry
    from pipewatch.plans.scan import lateness
    from pipewatch.session import build_session
    from pipewatch.sources import derived

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    queries = registry.queries()

    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    names = [n for n in queries if not only or n in only]

    def timed(name: str) -> float:
        t0 = time.perf_counter()
        _run(queries[name](spark, sf_dir))
        return time.perf_counter() - t0

    cold: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        try:
            cold[name] = round(timed(name), 3)
        except Exception as e:  # noqa: BLE001 - report, keep measuring the rest
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    runs: dict[str, list[float]] = {n: [] for n in cold}
    for _ in range(repeat):
        for name in cold:
            runs[name].append(timed(name))
    times: dict[str, float] = {n: round(statistics.median(v), 3) for n, v in runs.items()}

    # Global running max: one-task window vs bucketed prefix max (same result).
    if not only or "scan" in only:
        ev = topics.extract_events(derived.orders_log(spark, sf_dir))
        w = Window.orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        plain = ev.withColumn("diff_ts", F.max("ts").over(w) - F.col("ts")).where("diff_ts > 0")
        width = max(1, ev.agg(F.max("offset")).first()[0] // cpus + 1)  # cpus buckets, as a cluster would use
        bucketed = lateness(ev, "offset", "ts", (), bucket_width=width).where("diff_ts > 0")

        def best(df) -> float:
            out = []
            for _ in range(1 + repeat):
                t0 = time.perf_counter()
                _run(df)
                out.append(time.perf_counter() - t0)
            return round(min(out[1:]), 3)

        times["scan_plain_single_task_window"] = best(plain)
        times["scan_bucketed_prefix_max"] = best(bucketed)

    total = round(sum(v for k, v in times.items() if not k.startswith("scan_")), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "n_queries": len([k for k in times if not k.startswith("scan_")]),
        "repeat": repeat,
        "cold_total": round(sum(cold.values()), 3),
        "cold": cold,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

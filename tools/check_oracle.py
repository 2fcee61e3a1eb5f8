"""Run every registered query in Spark and its oracle SQL in DuckDB on the
same parquet tables; compare row count, column names and an
order-insensitive hash of the values.

    python tools/check_oracle.py [sf_dir] [name ...]

Environment: PIPEWATCH_PLAIN=1 uses a default session instead of the tuned
one; PIPEWATCH_TZ sets the session time zone; CHECK_DTYPES=1 also prints
pandas dtype differences (e.g. datetime64 ns vs us).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 4)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 4)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()[:16]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import duckdb

    from pipewatch.plans import registry
    from pipewatch.session import build_session

    if os.environ.get("PIPEWATCH_PLAIN"):  # a default session, as a caller might bring
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, oracle = registry.queries(), registry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        el = time.time() - t0
        if name not in oracle:
            print(f"ROWS {name}: {len(s_rows)} rows (no oracle) {el:.1f}s")
            continue
        try:
            rel = con.sql(oracle[name])
            o_cols = rel.columns
            o_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        ok_cols = sorted(s_cols) == sorted(o_cols)
        ok_n = len(s_rows) == len(o_rows)
        ok_h = ok_cols and digest(s_cols, s_rows) == digest(o_cols, o_rows)
        status = "OK  " if (ok_cols and ok_n and ok_h) else "FAIL"
        if status == "FAIL":
            bad += 1
        print(f"{status} {name}: rows {len(s_rows)}/{len(o_rows)} cols {ok_cols} hash {ok_h} {el:.1f}s")
        if os.environ.get("CHECK_DTYPES"):  # pandas dtypes on both sides (informational)
            sp, dp = df.toPandas(), con.sql(oracle[name]).df()
            diff = {c: (str(sp[c].dtype), str(dp[c].dtype)) for c in sp.columns if c in dp.columns
                    and str(sp[c].dtype) != str(dp[c].dtype)}
            if diff:
                print(f"     dtypes differ: {diff}")
        if status == "FAIL" and os.environ.get("VERBOSE"):
            print("  spark cols", s_cols, "\n  duck cols", o_cols)
            print("  spark", sorted(map(repr, [tuple(norm(x) for x in r) for r in s_rows]))[:5])
            print("  duck ", sorted(map(repr, [tuple(norm(x) for x in r) for r in o_rows]))[:5])
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

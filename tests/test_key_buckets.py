import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pipewatch.session import work_dir
from pipewatch.streaming import key_buckets
from pipewatch.streaming.key_buckets import LAST, Tops, key_columns, key_name
from pipewatch.streaming.lateness import late_rows_stream
from pipewatch.streaming.lateness_state import run_late_rows, stored_tops

SCHEMA = "partition int, offset bigint, key string, ts bigint"


def test_keys_of_any_type_come_back(spark):
    t = dt.datetime(1969, 12, 31, 23, 59, 59, 123456)
    schema = "i bigint, s string, d double, f float, b boolean, day date, t timestamp, n timestamp_ntz, x binary, m decimal(10,3), st struct<a:int,b:string>, l array<bigint>"
    rows = [
        (2**62 + 1, 'a"]\\,\né', 0.1, 0.5, True, dt.date(2024, 2, 29), t, t, b"\xff\x00", Decimal("1.250"), (1, None), [None, 5]),
        (None,) * 12,
        (-1, "", float("inf"), -2.0, False, dt.date(1, 1, 1), t, t, b"", Decimal("-0.001"), (None, ""), []),
        (0, "null", float("nan"), 0.0, None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    kinds = [f.dataType for f in df.schema]
    named = df.select(key_name([F.col(c) for c in df.columns], kinds).alias("name"))
    assert named.where("name IS NULL").count() == 0 and named.distinct().count() == len(rows)
    back = named.select(*[c.alias(n) for c, n in zip(key_columns(F.col("name"), kinds), df.columns)])
    assert back.schema.simpleString() == df.schema.simpleString()
    assert back.exceptAll(df).count() == 0 and back.count() == len(rows)


def _rows(n):
    return [(i % 3, i, [None, "", "a", "b", "c"][i % 5], None if i % 17 == 3 else 1_000 + i * 10 - i * 7919 % 300) for i in range(n)]


def _brute(rows):
    tops, late = {}, []
    for p, o, k, t in rows:
        if t is not None:
            if tops.get((p, k), t) > t:
                late.append((p, k, tops[p, k] - t, o))
            tops[p, k] = max(t, tops.get((p, k), t))
    return sorted(late, key=str), tops


def test_many_keys_to_a_state(spark, monkeypatch):
    """Fifteen keys in four states, over two runs, by either operator."""
    monkeypatch.setattr(key_buckets, "BUCKETS", 4)
    rows = _rows(300)
    src, out, ckpt, out2, ckpt2 = (work_dir(spark, "buckets", n) for n in ("src", "out", "ckpt", "out2", "ckpt2"))
    for part in (rows[:140], rows[140:]):
        spark.createDataFrame(part, SCHEMA).repartition(3).write.mode("append").parquet(src)
        got = run_late_rows(spark.readStream.schema(SCHEMA).parquet(src), out, ckpt)
        late = late_rows_stream(spark.readStream.schema(SCHEMA).parquet(src))
        q = late.writeStream.format("parquet").option("path", out2).option("checkpointLocation", ckpt2).trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
    want, tops = _brute(rows)
    assert want and sorted((tuple(r) for r in got.collect()), key=str) == want
    assert sorted((tuple(r) for r in spark.read.schema(late.schema).parquet(out2).collect()), key=str) == want
    assert {(r.partition, r.key): r.max_ts for r in stored_tops(spark, ckpt).collect()} == tops
    assert 0 < spark.read.format("statestore").load(ckpt2).count() <= 4 < len(tops)


def test_idle_keys_of_a_bucket_are_forgotten_one_by_one():
    held = (["a", "b"], [100, 200], [5_000, 1_000])
    tops = Tops(held, 6_000, 2_000)
    at = tops.numbers(pd.Series(["b", "a", "b"], dtype=object))
    late = tops.late(at, np.array([1, 2, LAST]), np.array([50.0, 90.0, 40.0]))
    assert [tuple(r) for r in late.astype(object).where(late.notna(), None).itertuples(index=False)] == [("a", 10, 2), ("b", 10, None)]
    assert tops.stored() == (["a", "b"], [100, 50], [6_000, 6_000])

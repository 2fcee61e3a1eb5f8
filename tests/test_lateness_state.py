import pytest
from pyspark.sql import functions as F

from pipewatch.operators import topics as tp
from pipewatch.session import work_dir
from pipewatch.streaming.lateness_state import ROCKSDB, PROVIDER, late_rows_processor, run_late_rows, stored_tops

SCHEMA = "partition int, offset bigint, key string, ts bigint"


def _replay(spark, rows, cuts, **how):
    """A run, on one checkpoint, for each stretch of rows; late rows and checkpoint."""
    src, out, ckpt = (work_dir(spark, "tws", n) for n in ("src", "out", "ckpt"))
    for lo, hi in zip([0, *cuts], [*cuts, len(rows)]):
        spark.createDataFrame(rows[lo:hi], SCHEMA).repartition(3).write.mode("append").parquet(src)
        got = run_late_rows(spark.readStream.schema(SCHEMA).parquet(src), out, ckpt, **how)
    return got, ckpt


def _brute(rows):
    tops, late = {}, []
    for p, o, k, t in rows:
        if t is None:
            continue
        top = tops.get((p, k))
        if top is not None and top > t:
            late.append((p, k, top - t, o))
        tops[p, k] = t if top is None else max(top, t)
    return sorted(late, key=str), tops


def _rows(n):
    out = []
    for i in range(n):
        key = "hot" if i % 3 else [None, "", "a b", "z"][i // 3 % 4]
        out.append((0 if key else 1, i, key, None if i % 41 == 7 else 1_700_000_000 + i * 10 - (i * 7919 % 900)))
    return out


@pytest.mark.parametrize("cuts", [[], [400], [1, 250, 251, 600]])
def test_late_rows_and_stored_state_over_restarts(spark, cuts):
    rows = _rows(900)
    late, tops = _brute(rows)
    got, ckpt = _replay(spark, rows, cuts)
    assert late and sorted((tuple(r) for r in got.collect()), key=str) == late
    state = {(r.partition, r.key): r.max_ts for r in stored_tops(spark, ckpt).collect()}
    assert state == tops
    assert spark.conf.get(PROVIDER) != ROCKSDB  # the session's own setting is back


def test_hot_key_is_taken_up_in_ranges(spark):
    """A key of many Arrow batches, in shuffled order, sorted by ranges of 50."""
    rows = _rows(900)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "40")
    try:
        got, ckpt = _replay(spark, rows, [500], width=50)
    finally:
        spark.conf.set(name, before)
    late, tops = _brute(rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == late
    assert {(r.partition, r.key): r.max_ts for r in stored_tops(spark, ckpt).collect()} == tops
    aside = spark.read.format("statestore").option("path", ckpt).option("stateVarName", "aside").load()
    assert aside.count() == 0  # nothing put aside stays


def test_state_of_an_earlier_batch(spark):
    rows = _rows(300)
    _, ckpt = _replay(spark, rows, [100, 200])
    for batch, hi in enumerate([100, 200, 300]):
        got = {(r.partition, r.key): r.max_ts for r in stored_tops(spark, ckpt, batch=batch).collect()}
        assert got == _brute(rows[:hi])[1]


def test_equal_seq_null_seq_and_no_rows(spark):
    rows = [(0, 5, "k", 100), (0, 5, "k", 90), (0, 6, "k", 95), (0, None, "k", 10), (0, 7, "n", None)]
    got, ckpt = _replay(spark, rows, [])
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([(0, "k", 5, 6), (0, "k", 90, None)], key=str)
    assert [tuple(r) for r in stored_tops(spark, ckpt).collect()] == [(0, "k", 100)]


def test_key_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, 1, 9, "x"), (1, 2, 4, "x")], "seq int, `o.f` bigint, ts bigint, k1 string")
    src, out, ckpt = (work_dir(spark, "tws", n) for n in ("src", "out", "ckpt"))
    df.write.parquet(src)
    got = run_late_rows(spark.readStream.schema(df.schema).parquet(src), out, ckpt, seq="o.f", ts="ts", keys=["seq", "k1"])
    assert got.columns == ["seq", "k1", "diff_ts", "id"]
    assert [tuple(r) for r in got.collect()] == [(1, "x", 5, 2)]
    with pytest.raises(ValueError):
        late_rows_processor(df.withColumnRenamed("k1", "id"), seq="o.f", keys=["id"])


def test_equals_batch_audit(spark):
    rows = _rows(600)
    got, _ = _replay(spark, rows, [300], keys=["partition", "key"])
    want = tp.disorder_bound(spark.createDataFrame(rows, SCHEMA).where(F.col("ts").isNotNull()), key="key", topn=None)
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == want.count()


class _FakeMap:
    def __init__(self):
        self.held, self.most = {}, 0

    def updateValue(self, k, v):
        self.held[k] = v
        self.most = max(self.most, len(self.held))

    def getValue(self, k):
        return self.held[k]

    def removeKey(self, k):
        del self.held[k]


def test_rows_put_aside_come_back_by_ranges():
    import numpy as np
    import pandas as pd

    from pipewatch.streaming.lateness_state import Lateness

    seq = np.random.default_rng(5).permutation(1000)
    frames = [pd.DataFrame({"seq": s, "ts": s * 2.0}) for s in np.array_split(seq, 25)]
    p = Lateness(["k"], 100, None)
    p.aside = _FakeMap()
    ranges = [np.sort(r["seq"]) for r in p._in_order(frames[0], frames[1], iter(frames[2:]))]
    assert [r.tolist() for r in ranges] == np.arange(1000).reshape(10, 100).tolist()
    assert p.aside.most > 100 and not p.aside.held

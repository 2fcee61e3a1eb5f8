import json

import pytest

from pipewatch.operators import topics as tp
from pipewatch.session import work_dir
from pipewatch.streaming import ledger

SCHEMA = "partition int, offset bigint, value string"


def _message(i):
    if i % 5 == 2:
        return "no json"
    if i % 7 == 3:
        return json.dumps({"event_time": "2024-01-01 00:00:00"})
    return json.dumps({"id": f"k{i % 3}", "event_time": f"2024-01-01 00:00:{i % 60:02d}"})


def _rows(lo, hi):
    return [(i % 2, i, _message(i)) for i in range(lo, hi)]


class Topic:
    def __init__(self, spark):
        self.spark, (self.src, self.path) = spark, [work_dir(spark, "ledger_test", n) for n in ("src", "data")]
        self.ckpt = self.new_checkpoint()
        self.end = 0

    def new_checkpoint(self):
        return work_dir(self.spark, "ledger_test", "ckpt")

    def arrive(self, n):
        self.spark.createDataFrame(_rows(self.end, self.end + n), SCHEMA).write.mode("append").parquet(self.src)
        self.end += n

    def land(self):
        ledger.land_available(self.spark.readStream.schema(SCHEMA).parquet(self.src), self.path, self.ckpt)

    def offsets(self):
        good, bad = ledger.landed(self.spark, self.path), ledger.rejected(self.spark, self.path)
        return sorted(r.offset for r in good.collect()), sorted(r.offset for r in bad.collect())


def _want(rows):
    bad = [o for _, o, _ in rows if o % 5 == 2 or o % 7 == 3]
    return [o for _, o, _ in rows if o not in bad], bad


def test_events_rejects_and_entries(spark):
    t = Topic(spark)
    assert t.offsets() == ([], [])  # nothing yet
    t.arrive(20)
    t.land()
    t.arrive(15)
    t.land()
    assert t.offsets() == _want(_rows(0, 35))
    log = spark.read.schema(SCHEMA).parquet(t.src)
    good, bad = tp.split_events(log)
    assert sorted(map(tuple, ledger.landed(spark, t.path).collect())) == sorted(map(tuple, good.collect()))
    assert sorted(map(tuple, ledger.rejected(spark, t.path).collect())) == sorted(map(tuple, bad.collect()))
    got = sorted((r.batch_id, r.partition, r.first, r.last, r.rows, r.rejects) for r in ledger.entries(spark, t.path).collect())
    want = []
    for b, (lo, hi) in enumerate([(0, 20), (20, 35)]):
        for p in (0, 1):
            rows = [r for r in _rows(lo, hi) if r[0] == p]
            g, r = _want(rows)
            want.append((b, p, rows[0][1], rows[-1][1], len(g), len(r)))
    assert got == want
    assert json.loads(ledger.starting_offsets(spark, t.path, "orders")) == {"orders": {"0": 35, "1": 34}}


def test_killed_between_data_and_entry(spark, monkeypatch):
    t = Topic(spark)
    t.arrive(20)
    t.land()
    t.arrive(20)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(ledger, "_commit", killed)
        with pytest.raises(Exception, match="killed"):
            t.land()
    assert t.offsets() == _want(_rows(0, 20))  # the data is there, but not committed
    t.arrive(10)
    t.land()
    assert t.offsets() == _want(_rows(0, 50))  # none lost, none twice


def test_stopped_after_the_entry(spark, monkeypatch):
    """Spark replays a batch that the ledger already has: it stays as it is."""
    t = Topic(spark)
    t.arrive(20)
    commit = ledger._commit

    def stopped(*args):
        commit(*args)
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(ledger, "_commit", stopped)
        with pytest.raises(Exception, match="stopped"):
            t.land()
    files = lambda: sorted(ledger._read(spark, f"{t.path}/data", ledger.DATA).inputFiles())
    before = files()
    assert t.offsets() == _want(_rows(0, 20))
    t.land()
    assert files() == before and t.offsets() == _want(_rows(0, 20))


def test_lost_checkpoint(spark):
    t = Topic(spark)
    t.arrive(20)
    t.land()
    t.ckpt = t.new_checkpoint()
    t.arrive(20)
    t.land()  # reads all 40 messages again
    assert t.offsets() == _want(_rows(0, 40))
    t.land()
    assert t.offsets() == _want(_rows(0, 40))


@pytest.mark.parametrize("new_checkpoint", [False, True])
def test_reset_to_end(spark, new_checkpoint):
    t = Topic(spark)
    t.arrive(20)
    t.land()
    t.arrive(20)
    ledger.reset_to_end(spark.read.schema(SCHEMA).parquet(t.src), t.path)
    if new_checkpoint:
        t.ckpt = t.new_checkpoint()
    t.arrive(20)
    t.land()
    assert t.offsets() == _want(_rows(0, 20) + _rows(40, 60))


def test_message_without_offset_fails_loudly(spark):
    t = Topic(spark)
    spark.createDataFrame([(0, None, _message(0))], SCHEMA).write.parquet(t.src)
    with pytest.raises(Exception, match="without an offset"):
        t.land()
    assert t.offsets() == ([], [])


def test_one_read_and_one_parse_of_a_batch(spark):
    log = spark.createDataFrame(_rows(0, 10), SCHEMA)
    plan = tp.marked_events(log)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_tuple") == 1

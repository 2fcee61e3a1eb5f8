"""Property tests: reconcile is idempotent and scoped;
backfill applied twice adds nothing."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pipewatch.operators import catalog as cg
from pipewatch.operators import loads as ld

_rows = st.lists(st.tuples(st.integers(0, 40), st.sampled_from(["s1", "s2", None])), max_size=30, unique_by=lambda r: r[0])


def _rows_of(df):
    return sorted((r.k, r.scope) for r in df.collect())


@settings(max_examples=8, deadline=None)
@given(existing=_rows, incoming=_rows)
def test_reconcile_scoped_and_idempotent(spark, existing, incoming):
    schema = "k int, scope string"
    ex = spark.createDataFrame(existing, schema)
    inc = spark.createDataFrame(incoming, schema)
    once, _, _ = cg.reconcile(ex, inc, ["k"], "scope", "s1")
    twice, added, removed = cg.reconcile(once, inc, ["k"], "scope", "s1")
    assert _rows_of(twice) == _rows_of(once) and added.count() == 0 and removed.count() == 0
    got = _rows_of(once)
    # outside the scope nothing changes
    assert [r for r in got if r[1] != "s1"] == sorted((k, s) for k, s in existing if s != "s1")
    # inside the scope the keys are exactly the incoming in-scope keys not held elsewhere
    ex_out = {k for k, s in existing if s != "s1"}
    want_in = sorted(k for k, s in incoming if s == "s1" and k not in ex_out)
    assert sorted(k for k, s in got if s == "s1") == want_in


@settings(max_examples=6, deadline=None)
@given(
    src=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 30)), st.integers(0, 23)), max_size=25),
    tgt=st.lists(st.integers(0, 30), max_size=15, unique=True),
)
def test_backfill_twice_adds_nothing(spark, src, tgt):
    s = spark.createDataFrame(
        [(i, f"2025/02/18/{h:02d}") for i, h in src], "id int, event_time string"
    ).withColumn("v", F.lit("x"))
    t = spark.createDataFrame([(i, "y") for i in tgt], "id int, v string")
    first = ld.backfill(s, t, "2025/02/18/02", "2025/02/18/07")
    grown = t.unionByName(first)
    second = ld.backfill(s.where(F.col("id").isNotNull()), grown, "2025/02/18/02", "2025/02/18/07")
    assert second.count() == 0
    in_window = [i for i, h in src if 2 <= h <= 7]
    # every in-window source row whose id is absent from the target is appended (null ids always)
    assert first.count() == sum(1 for i in in_window if i is None or i not in set(tgt))

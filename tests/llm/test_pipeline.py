"""Registered queries against SQL, and the pipeline against its stages'
brute-force twins."""

import re
from collections import Counter

import duckdb
import helpers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pipewatch.llm import packing
from pipewatch.llm.queries import oracle_sql, queries, tokenizer_path

SF = helpers.SF
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(oracle_sql()[name])
    df = queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    want = Counter(tuple(r[rel.columns.index(c)] for c in cols) for r in rel.fetchall())
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == want


def test_near_duplicate_query_against_all_pairs(spark):
    rows = queries()["op2_bottomk_dedup"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: r.component_id for r in rows} == helpers.near_components(texts, 2)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "exact dedup", "MinHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}

    kept = stages["quality classifier"](spark, docs, SF)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert sum((i in ids) == (q == 1) for i, q in labels.items()) / len(labels) >= 0.95

    exact = stages["exact dedup"](spark, kept, SF)
    assert exact.columns == docs.columns
    first = {}
    for r in sorted(kept.collect(), key=lambda r: r.doc_id):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", r.text or ""), r.doc_id)
    assert sorted(r.doc_id for r in exact.collect()) == sorted(first.values())

    near = stages["MinHash near-dedup"](spark, exact, SF)
    assert near.columns == docs.columns
    texts = {r.doc_id: r.text for r in exact.collect()}
    assert sorted(r.doc_id for r in near.collect()) == sorted(i for i, c in helpers.near_components(texts, 5).items() if i == c)

    mixed = stages["mixing sources to target weights"](spark, near, SF)
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert set(times) <= {r.doc_id for r in near.collect()} and max(times.values()) <= 2
    size = lambda df: sum(len(helpers.WORD.findall(r.text or "")) for r in df.collect())
    assert abs(size(mixed) / size(near) - 1.5) < 0.05

    packed = stages["best-fit packing"](spark, mixed, SF).collect()
    assert {r.doc_id for r in packed} == set(times)
    fast = packing.FastIds(tokenizer_path("word_bpe_49k.json"))
    assert sum(r.length for r in packed) == sum(len(fast.ids(r.text or "")) // 4 + 1 for r in mixed.collect())


def test_mix_stage_keeps_columns_of_any_name(spark, odd):
    names = ["size", "source_size", "target", "copies", "taken", "_mix_size", "_mix_key", "row", "a.b"]
    docs = odd.select("*", *[F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in names])
    got = corpus_pipeline.mix(spark, docs, SF)
    assert got.dtypes == docs.dtypes
    got = {tuple(r) for r in got.collect()}
    assert got and got <= {tuple(r) for r in docs.collect()}


def test_run_over_a_whole_table(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())

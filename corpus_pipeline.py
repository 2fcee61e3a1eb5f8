"""A corpus pipeline: from raw documents to packed training sequences.

Stages take (spark, docs, sf_dir); each result is written as Parquet and
reread as the next stage's documents.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewatch.llm import block_naming, bottomk_dedup, mixing, packing, quality_eb
from pipewatch.llm.common import saved, table
from pipewatch.llm.queries import source_weights, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_eb.kept(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return block_naming.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five-word shingles, 0.8) the smallest doc_id stays."""
    return bottomk_dedup.deduplicated(docs, n=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; documents repeat as often as they are taken."""
    # The document's columns travel in one struct: none clashes with those the mix adds.
    whole = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    mixed = mixing.repeated(mixing.mix(whole, source_weights(docs), share=1.5, cap=2), ["row"])
    return mixed.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row per piece of a document."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: SQL has no way to fit a classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_").lower())
    return docs

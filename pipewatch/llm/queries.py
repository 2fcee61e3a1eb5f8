"""The ``opN_<name>`` queries over the driver tables, and their DuckDB SQL
where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pipewatch.llm import (
    ann_mih,
    block_naming,
    bottomk_dedup,
    hard_negatives,
    jaccard_regions,
    mixing,
    packing,
    quality_eb,
    sharding,
    spelling_trie,
    token_counts,
    url_filter,
    warc,
)
from pipewatch.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Number of words of ``text`` in SQL, and the leading 52 bits of an MD5.
SQL_WORDS = "len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), w -> w <> ''))"


def _sql_hash52(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 13))::BIGINT"


@register("op1_multi_index_hashing")
def op1_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every row whose vec_id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann_mih.search(vectors, F.col("vec_id") % 50 == 0, k=5)


@register("op2_bottomk_dedup")
def op2_bottomk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents on 2-word shingles at 0.8."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bottomk_dedup.near_duplicates(docs, n=2, percent=80)


@register("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the unigram vocabulary of the public
    32k piece file (its pieces and stored scores)."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.count_tokens(docs, tokenizer_path("piece_bpe_32k.model"))


@register(
    "op4_block_naming",
    r"""
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
    FROM n
    """,
)
def op4_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents by block names."""
    return block_naming.groups(table(spark, sf_dir, "documents", "doc_id", "text"))


#: Rules of the URL query.
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def _sql_rule(rule: str) -> str:
    host, _, rest = rule.partition("/")
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{rest}'))"


_BY_LENGTH = sorted(URL_RULES, key=lambda r: -len(r[0]))


@register(
    "op5_url_filter",
    r"""
    WITH u AS (
        SELECT page_id,
               coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
               coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages
    ), r AS (
        SELECT *, CASE """
    + " ".join(f"WHEN {_sql_rule(r)} THEN '{r}'" for r, _ in _BY_LENGTH)
    + """ END AS rule FROM u
    )
    SELECT page_id, host, path, rule, CASE rule """
    + " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in URL_RULES)
    + """ ELSE 'allow' END AS verdict FROM r
    """,
)
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    rules = spark.createDataFrame(list(URL_RULES), "rule string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


@register(
    "op6_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    g AS (SELECT page_id, h, strlen(h)::BIGINT AS n, max(page_id) OVER (PARTITION BY h) AS last FROM p)
    SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
           CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
    FROM g
    """,
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back."""
    found = warc.archive_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents: their text, their source and its languages."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    return quality_eb.scores(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


#: Weights of the sources in code point order, repeating (null last).
SOURCE_WEIGHTS = (3, 1, 2)


def source_weights(docs: DataFrame) -> DataFrame:
    """``source`` and ``weight`` for each source of ``docs``: one row per
    source is ranked, not documents."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in SOURCE_WEIGHTS]), (rank % len(SOURCE_WEIGHTS) + 1).cast("int"))
    return docs.select("source").distinct().withColumn("weight", weight)


@register("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mix of one and a half times the words of all documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    mixed = mixing.mix(docs, source_weights(docs), share=1.5, cap=2, narrow=True)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@register("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


#: Shards of the sharding query.
SHARDS = 16


@register("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal weight by rendezvous hashing of
    ``doc_id``; ``grown_shard`` is the shard among 17."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    sharded = sharding.assign(docs, "doc_id", {i: 1.0 for i in range(SHARDS)})
    sharded = sharding.assign(sharded, "doc_id", {i: 1.0 for i in range(SHARDS + 1)}, "grown_shard")
    placed = sharding.slots(sharded.withColumn("law", F.lit("key")), "doc_id", ["text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@register("op11_jaccard_regions")
def op11_jaccard_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents linked at 0.8 on 5-word shingles."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return jaccard_regions.linked(docs, n=5, percent=80)


@register("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents; one run in 97 of
    a document lacks a code point."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return spelling_trie.variants(spelling_trie.word_counts(docs, damage=97))


@register(
    "op13_hard_negatives",
    """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ),
    s AS (
        SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, list_inner_product(a.v, r.v)::BIGINT AS score
        FROM v a, v r WHERE a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id
    ),
    p AS (
        SELECT * FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, p.vec_id AS positive_id,
           (row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
           n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
         AND 80 * p.score <= 100 * n.score AND n.score <= p.score
    QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) <= 5
    """,
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every row whose vec_id is divisible by 100; the
    labels of one row in seven are moved on by one first."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), hard_negatives.whole_components(F.col("embedding")).alias("v"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, id_col="vec_id")


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

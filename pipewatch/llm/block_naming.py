"""Exact deduplication by deterministic block naming.

A text is cut into blocks of fixed size.  Distinct blocks are sorted and
numbered; the number is the block's name.  Adjacent names are paired and the
distinct pairs numbered again, until each document has one name.  Two
documents have equal names and equal block counts only if their texts are
equal: names come from the blocks themselves, so no collision is possible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pipewatch.llm.common import WHITE, saved

#: Code points in a block.
BLOCK = 4096


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _numbered(distinct: DataFrame, *order: str) -> DataFrame:
    """Sort the distinct rows (already dealt out by a hash of themselves) and
    number them.  Numbers are unique over all partitions."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def _name_blocks(blocks: DataFrame, rows: DataFrame) -> DataFrame:
    """Names of the first level.

    Distinct blocks are numbered with their whole content as the key.  Rows
    find their name by the block's digest, so the text is shuffled once and a
    block that fills a third of the corpus moves as 16 bytes a row.  Digests
    that stand for more than one block are looked up by content instead."""
    names = _numbered(blocks.select("d1", "d2", "block").distinct(), "d1", "d2", "block")
    names = saved(names.select("d1", "d2", "name"), "block_names")
    clash = names.groupBy("d1", "d2").agg(F.count("*").alias("n")).where("n > 1").select("d1", "d2")
    if clash.isEmpty():
        return rows.join(names, ["d1", "d2"]).select("row", "idx", "name")
    clash = saved(clash, "block_clashes")
    alike = blocks.join(clash, ["d1", "d2"])
    exact = saved(_numbered(alike.select("block").distinct(), "block").withColumn("name", -1 - F.col("name")), "block_exact")
    by_text = alike.join(exact, "block").select("row", "idx", "name")
    return rows.join(clash, ["d1", "d2"], "left_anti").join(names, ["d1", "d2"]).select("row", "idx", "name").unionByName(by_text)


def identities(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: the ``carry`` columns, ``row`` (its number),
    ``text_sha256`` of the normalised text, ``blocks`` and ``name``.  Equal
    (blocks, name) means equal normalised text, and the reverse.

    Null and blank texts are blocks like any other (empty, one space).
    Repeated rows get rows of their own and equal names.  A very long text
    only has more blocks.  An empty table gives an empty result."""
    norm = normalised(F.col(f"`{text}`"))
    pieces = F.regexp_extract_all("_norm", F.lit(f"(?s).{{1,{block}}}"), 0)
    cut = (
        docs.select(*[F.col(f"`{c}`") for c in carry], F.monotonically_increasing_id().alias("row"), norm.alias("_norm"))
        .withColumn("text_sha256", F.sha2("_norm", 256))
        .withColumn("_pieces", pieces)
        .withColumn("_pieces", F.when(F.size("_pieces") == 0, F.array(F.lit(""))).otherwise(F.col("_pieces")))
        .select(*carry, "row", "text_sha256", F.size("_pieces").alias("blocks"), F.posexplode("_pieces").alias("idx", "block"))
        .withColumn("d1", F.xxhash64("block"))
        .withColumn("d2", F.xxhash64(F.lit("second"), "block"))
    )
    first = F.col("idx") == 0
    rows = saved(
        cut.select(*[F.when(first, F.col(f"`{c}`")).alias(c) for c in carry], "row", F.when(first, F.col("text_sha256")).alias("text_sha256"), "blocks", "idx", "d1", "d2"),
        "block_rows",
    )
    docs_of = rows.where("idx = 0").select(*carry, "row", "text_sha256", "blocks")
    level = saved(_name_blocks(cut.select("row", "idx", "block", "d1", "d2"), rows), "block_level")
    done = [docs_of.select("row", "blocks").where("blocks = 1").join(level, "row").select("row", "name")]
    most = rows.agg(F.max("blocks")).first()[0] or 1
    left = rows.where("idx = 0 AND blocks > 1").select("row", F.col("blocks").alias("width"))
    level = level.join(left, "row")
    while most > 1:
        half = F.floor(F.col("idx") / 2).cast("int")
        even = F.col("idx") % 2 == 0
        pairs = level.groupBy("row", half.alias("at")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"),
            F.max(F.when(~even, F.col("name"))).alias("b"),
            F.max("width").alias("width"),
        )
        pairs = saved(pairs.withColumn("b", F.coalesce("b", F.lit(-(2**63)))), "block_pairs")
        names = saved(_numbered(pairs.select("a", "b").distinct(), "a", "b"), "block_pair_names")
        width = F.floor((F.col("width") + 1) / 2).cast("int")
        level = saved(pairs.join(names, ["a", "b"]).select("row", F.col("at").alias("idx"), "name", width.alias("width")), "block_level")
        done.append(level.where("width = 1").select("row", "name"))
        level = level.where("width > 1")
        most = (most + 1) // 2
    named = done[0]
    for more in done[1:]:
        named = named.unionByName(more)
    return docs_of.join(named, "row")


def groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id`` (the smallest id
    among equal texts), ``group_size``, ``kept`` and ``text_sha256``.

    Exactly one row of a group is kept: the smallest id, nulls last, and of
    rows that share the id the first met.  ``keep_id`` is null only if all ids
    of the group are."""
    found = saved(identities(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))), "block_identities")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row")))
    per = saved(found.groupBy("blocks", "name").agg(best.alias("best"), F.count("*").alias("group_size")), "block_groups")
    return found.join(per, ["blocks", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    judged = saved(groups(docs, id_col, text), "block_judged")
    per = judged.groupBy("doc_id").agg(F.count("*").alias("_rows"), F.count_if("kept").alias("_kept"))
    per = per.withColumnRenamed("doc_id", "_id")
    # Ids of which no row stays leave; a repeated id of which some rows stay is settled by its texts.
    gone = per.where("_kept < _rows").select("_id").alias("gone")
    stay = docs.alias("docs").join(gone, F.col(f"docs.`{id_col}`").eqNullSafe(F.col("gone._id")), "left_anti")
    some = per.where("_kept > 0 AND _kept < _rows").select("_id")
    if some.isEmpty():
        return stay
    texts = judged.where("kept").select(F.col("doc_id").alias("_id"), "text_sha256").join(some.withColumnRenamed("_id", "_i"), F.col("_id").eqNullSafe(F.col("_i"))).drop("_i")
    # The whole row travels in one struct: none of its columns clashes with those of the join.
    part = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{id_col}`").alias("i"), F.sha2(normalised(F.col(f"`{text}`")), 256).alias("t"))
    part = part.join(texts, F.col("i").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("text_sha256")))
    part = part.dropDuplicates(["i", "t"]).select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
    return stay.unionByName(part)

"""Spelling variants by a dictionary of trie-node pairs.

Every prefix of a word is a node of the forward trie, every suffix a node of
the reversed one; both are numbered.  A word without the code point at place
i is the integer pair (node of what stands before, node of what stands after);
a word cut at place i is such a pair too.  Two words are one replacement apart
exactly if they share a pair with a skipped place, and one insertion apart
exactly if a skipped pair of the longer is a cut pair of the shorter.  A pair
holds at most one word for each code point of the alphabet, and one that is
cut there, so no group grows with the data.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewatch.llm.common import saved

#: Maximal runs of letters, A-Z already lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")
#: Distinct words that a task holds before it hands on their counts.
HELD = 200_000


def runs(text: str | None) -> list[str]:
    """Runs of ``[A-Za-zÀ-ÿ]`` of a text, A-Z lower-cased; none for null."""
    return RUN.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def damaged(doc_id: int | None, run: str, one_in: int) -> str:
    """``run`` as document ``doc_id`` spells it: one in ``one_in`` (by the
    crc32 of ``<doc_id>:<run>``) lacks a code point.  A null id reads ``null``."""
    h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
    if h % one_in:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least_length: int = 5, least_count: int = 3, damage: int | None = None) -> DataFrame:
    """``word`` and ``n``: the words of at least ``least_length`` code points
    that occur at least ``least_count`` times in all texts (null and empty
    texts have none).  With ``damage`` the runs of a document are first
    spelt as :func:`damaged` has it.  Tasks count what they read before words
    are dealt out, so a frequent word costs a row a task."""
    rows = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text}`").alias("t")).where(F.col("t").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for run, n in Counter(runs(t.as_py())).items():
                    word = run if damage is None else damaged(i, run, damage)
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        yield out()

    counted = rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def _digests(pieces: list[bytes]) -> list[tuple[int, int]]:
    """128 bits for each of the sequences that begin with ``pieces``: 0, 1, ... of them."""
    state = xxhash.xxh3_128()
    out = []
    for piece in [b"", *pieces]:
        state.update(piece)
        d = state.digest()
        out.append((int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)))
    return out


def node_pairs(words: DataFrame) -> DataFrame:
    """``wid``, ``gap`` (false: the code point at a place is skipped; true:
    the word is cut there), ``p`` and ``s`` (numbers of trie nodes) for each
    place of the distinct ``word``s of ``words`` (wid, word).

    The nodes of a word are told by digests that grow along the word (time
    linear in its length); distinct nodes get their numbers from one table in
    the shared folder, so a retried task numbers nothing anew."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                rows = []
                for wid, word in zip(b.column(0)[at : at + 256].to_pylist(), b.column(1)[at : at + 256].to_pylist(), strict=True):
                    chars = [c.encode("utf-32-le", "surrogatepass") for c in word]
                    before, after = _digests(chars), _digests(chars[::-1])[::-1]
                    rows += [(wid, True, *before[i], *after[i]) for i in range(len(chars) + 1)]
                    rows += [(wid, False, *before[i], *after[i + 1]) for i in range(len(chars))]
                kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 4]
                columns = zip(*rows, strict=True) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["wid", "gap", "f1", "f2", "r1", "r2"])

    places = words.select("wid", "word").mapInArrow(spell, "wid bigint, gap boolean, f1 bigint, f2 bigint, r1 bigint, r2 bigint")
    places = saved(places, "spelling_places")
    forward = saved(places.select("f1", "f2").distinct().withColumn("p", F.monotonically_increasing_id()), "spelling_forward")
    backward = saved(places.select("r1", "r2").distinct().withColumn("s", F.monotonically_increasing_id()), "spelling_backward")
    return places.join(forward, ["f1", "f2"]).join(backward, ["r1", "r2"]).select("wid", "gap", "p", "s")


def near_pairs(pairs: DataFrame) -> DataFrame:
    """Distinct ``wid``, ``other`` (both directions) of the words that share
    an entry of :func:`node_pairs`, at least one of them with a skipped place."""
    group = pairs.groupBy("p", "s").agg(F.collect_list(F.struct("wid", "gap")).alias("held")).where(F.size("held") > 1)
    both = group.select("held", F.explode("held").alias("x")).select("x", F.explode("held").alias("y"))
    both = both.where((F.col("x.wid") != F.col("y.wid")) & ~(F.col("x.gap") & F.col("y.gap")))
    return both.select(F.col("x.wid").alias("wid"), F.col("y.wid").alias("other")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``wid`` and ``root`` (where following ``form`` ends) of every row of
    ``forms`` (wid, form).  Pointers double each round, so rounds grow with
    the logarithm of the longest chain."""
    now = saved(forms.select("wid", F.col("form").alias("root")), "spelling_chain")
    while True:
        ahead = now.select(F.col("wid").alias("root"), F.col("root").alias("next"))
        then = saved(now.join(ahead, "root", "left").select("wid", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling_chain")
        now = then.select("wid", "root")
        if then.where("moved").isEmpty():
            return now


def variants(counts: DataFrame, ratio: float = 2) -> DataFrame:
    """One row per word of ``counts`` (word, n; other columns are not read):
    ``form`` (its near word of largest n, ties to the first in code-point
    order, if that n is at least ``ratio`` times its own; else null), ``root``
    (last of its forms, itself if none), ``n``, ``n_near`` and ``form_n``.

    Near words differ by exactly one inserted, deleted or replaced code point.
    Repeated words add up; rows without a word or count, and empty words,
    take no part; no words, no rows.  ``ratio`` must be over 1, so that forms
    never lead in a circle."""
    if ratio <= 1:
        raise ValueError("forms of equal counts could lead in a circle")
    own = counts.select("word", "n").where("word != '' AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = saved(own.withColumn("wid", F.monotonically_increasing_id()), "spelling_words")
    near = saved(near_pairs(node_pairs(words)), "spelling_near")
    other = words.select(F.col("wid").alias("other"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    best = F.min(F.struct((-F.col("form_n")).alias("d"), "form", "other"))
    found = near.join(other, "other").groupBy("wid").agg(F.count("*").alias("n_near"), best.alias("b"))
    found = words.join(found, "wid", "left").withColumn("takes", F.coalesce(-F.col("b.d") >= F.col("n") * F.lit(ratio), F.lit(False)))
    take = lambda c: F.when(F.col("takes"), c)
    found = saved(found.select("wid", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), take(F.col("b.form")).alias("form"), take(F.col("b.other")).alias("to"), take(-F.col("b.d")).alias("form_n")), "spelling_found")
    last = roots(found.where("to IS NOT NULL").select("wid", F.col("to").alias("form")))
    last = last.join(words.select(F.col("wid").alias("root"), F.col("word").alias("last")), "root").select("wid", "last")
    return found.join(last, "wid", "left").select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")

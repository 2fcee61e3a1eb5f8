"""Near-duplicate documents by bottom-k sketches.

One hash function orders all shingles; a document's sketch is its ``K``
smallest hashes.  Inverted lists of retained values bring documents together,
the sketch of the union estimates their similarity, and full shingle sets
decide.

No list is expanded into all its pairs.  Each list first compares its members
with one of them only, the most typical.  Most copies meet there.  What is
then still apart, inside a list, is compared across components; members of
very long lists are told apart by the rarest part of their full sets (exact
prefix and position bounds) instead.

Disk holds little more than the tables that later steps read: see ``_places``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipewatch.llm.common import dropped, saved, shuffles_dropped
from pipewatch.llm.components import components
from pipewatch.plans.keyfilter import key_filter, possible

#: Hashes kept of each document.
K = 32
#: A pair is estimated as too far apart if fewer of the union's K smallest hashes are shared.  At a
#: similarity of 0.8 the number shared is 25.6 +- 2.3; fewer than 12 has a chance of about 1e-8.
SHARED = 12
#: Members of a list that are compared across components directly.
LONG_LIST = 48
#: Members of a longer list that need not be told apart by their full sets unless the marks of another member leave a link possible.
MARKED_LIST = 256
#: Bits that mark the values of a sketch, as 64-bit numbers: a value sets the bit of its lowest digits.
MARK_BITS = 256
MARKS = [f"m{i}" for i in range(MARK_BITS // 64)]
#: Bits kept of each member of a longer list, one for each of so many orders of its set (the last bit of the least
#: number), and how many two members must have in common.  At a similarity of 0.8 they share 230 +- 5 of 256; fewer
#: than 196 has a chance of about 1e-10.
LONG_BITS, LONG_SHARED = 256, 196
#: Rare elements before an element that are looked at to meet most pairs once.
BEFORE = 16
#: Counters that tell rare elements from frequent ones (16 MB), and counters in a slice.
COUNTERS, SLICE = 1 << 22, 1 << 14
#: Multipliers of a public 64-bit mixing function, and the step between words.
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)

def shingle_hashes(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles of a text (A-Z
    lower-cased).  With fewer words the whole sequence is the one shingle;
    without words the set is empty."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.int64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(n, len(w))
    h = np.full(len(w) - width + 1, width, np.uint64)
    for k in range(width):
        h = h * STEP + w[k : len(w) - width + 1 + k]
    h ^= h >> np.uint64(30)
    h *= np.uint64(MIX[0])
    h ^= h >> np.uint64(27)
    h *= np.uint64(MIX[1])
    h ^= h >> np.uint64(31)
    h = np.sort(h.view(np.int64))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def _name(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), "<i8").tolist())


def _lists_of(sets: Iterable[np.ndarray]) -> pa.Array:
    sets = list(sets)
    ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))


def _marks(sketches: list[np.ndarray]) -> list[pa.Array]:
    """The columns MARKS of sketches."""
    bits = np.zeros((len(sketches), MARK_BITS), np.uint8)
    for at, sketch in zip(bits, sketches, strict=True):
        at[sketch & (MARK_BITS - 1)] = 1
    words = np.packbits(bits, axis=1).view(np.int64)
    return [pa.array(words[:, i]) for i in range(len(MARKS))]


def _sketches(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, row (its number), th (hash of the text), n, k1, k2 (size and
    name of the set), sketch and its marks of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("th"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, names, sketches = [], [], []
            for t in b.column(3):
                h = shingle_hashes(t.as_py(), n)
                sizes.append(len(h))
                names.append(_name(h))
                sketches.append(h[:K].copy())
            k1, k2 = zip(*names, strict=True) if names else ((), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(sizes, pa.int32()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), _lists_of(sketches), *_marks(sketches)],
                ["doc_id", "row", "th", "n", "k1", "k2", "sketch", *MARKS],
            )

    marks = "".join(f", {m} bigint" for m in MARKS)
    return rows.mapInArrow(run, f"doc_id {kind}, row bigint, th bigint, n int, k1 bigint, k2 bigint, sketch array<bigint>{marks}")


def _same(x: str, y: str) -> Column:
    return F.col(x).eqNullSafe(F.col(y))


def _close(na: str = "na", nb: str = "nb", percent: int = 80) -> Column:
    """Sizes that allow the similarity at all."""
    return (F.col(na) * 100 >= F.col(nb) * percent) & (F.col(nb) * 100 >= F.col(na) * percent)


def _may_share(x: str = "x", y: str = "y", na: str = "na", nb: str = "nb") -> Column:
    """Marks (MARKS with the ending ``x`` or ``y``) that do not rule out what :func:`_by_sketch` asks for.

    A bit that only one sketch has is a value, or more, that the other has
    not.  The values left bound those shared, and the union has as many as
    the larger sketch at least: no pair that passes there is lost here."""
    sizes = [F.least(F.col(c), F.lit(K)) for c in (na, nb)]
    least = F.greatest(*sizes) * SHARED

    def left(size: Column, mine: str, other: str) -> Column:
        own = (F.bit_count(F.col(f"{m}{mine}").bitwiseAND(F.bitwise_not(F.col(f"{m}{other}")))) for m in MARKS)
        return (size - sum(own, F.lit(0))) * K >= least

    return left(sizes[0], x, y) & left(sizes[1], y, x)


def _by_sketch(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a < b, distinct) whose union sketch shares enough."""
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("sketch").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, K)
    shared = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    return both.where(shared * K >= F.lit(SHARED) * F.size(union)).select("a", "b")


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``cid`` and full ``set`` of the classes ``wanted`` (cid, at, th),
    shingled again from the texts of their first rows.  Ids that repeat with
    the same text give a class more than once, which does no harm.  A filter
    of their keys keeps other texts out of the join's shuffle."""
    wanted = saved(wanted.select("cid", "at", "th"), "neardup_wanted")
    some = possible(docs, F.xxhash64("doc_id", F.xxhash64("text")), key_filter(wanted, F.xxhash64("at", "th"), wanted.count()))
    here = F.col("doc_id").eqNullSafe(F.col("at")) & (F.xxhash64("text") == F.col("th"))
    texts = some.join(wanted, here).select("cid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _lists_of(shingle_hashes(t.as_py(), n) for t in b.column(1))], ["cid", "set"])

    return texts.mapInArrow(run, "cid bigint, set array<bigint>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have the similarity."""
    side = lambda x: sets.select(F.col("cid").alias(x), F.col("set").alias(f"f{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("fa", "fb"))
    return both.where(common * 100 >= (F.size("fa") + F.size("fb") - common) * percent).select("a", "b")


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()


def _open(members: DataFrame, key: str) -> DataFrame:
    """The ``members`` (cid, comp, ...) of lists (``key``) that lie in more
    than one component; ``apart`` tells those that lie outside the list's
    largest one."""
    count = members.groupBy(key, "comp").agg(F.count("*").alias("c"))
    main = count.groupBy(key).agg(F.max(F.struct("c", "comp")).alias("m"), F.count("*").alias("comps")).where("comps > 1")
    main = saved(main.select(F.col(key).alias("main_key"), F.col("m.comp").alias("main")), "neardup_main")
    held = members.join(main, F.col(key) == F.col("main_key")).withColumn("apart", F.col("comp") != F.col("main")).drop("main_key", "main")
    held = saved(held, "neardup_lists")
    dropped(main)
    return held


def _meetings(members: DataFrame, key: str, extra: Column, percent: int) -> DataFrame:
    """Pairs of members (of :func:`_open`) of a list (``key``) that lie in
    different components, have sizes that allow a link and satisfy ``extra``,
    once for each list where they meet.

    The list's largest component is never joined with itself: the other
    members meet all members."""
    carried = [c for c in members.columns if c in ("pos", "pre", *MARKS) or c.startswith("bit")]
    side = lambda x, n: members.select(F.col(key).alias(f"k{x}"), F.col("cid").alias(x), F.col("n").alias(n), F.col("comp").alias(f"c{x}"), F.col("apart").alias(f"apart{x}"), *[F.col(c).alias(f"{c}{x}") for c in carried])
    # One condition over both sides, not a filter of one: both then read the same shuffle, which is written once.
    once = F.when(F.col("aparty"), F.col("apartx") & (F.col("x") < F.col("y"))).otherwise(F.col("apartx"))
    cond = (F.col("cx") != F.col("cy")) & once & _close(percent=percent) & extra
    return side("x", "na").join(side("y", "nb"), (F.col("kx") == F.col("ky")) & cond).select(*_ordered("x", "y"))


def _rarity(sets: DataFrame) -> np.ndarray:
    """Counters of the elements of all ``set``s, by the low bits of each.

    Tasks add up counters of their own and pass them on in slices; what comes
    to the driver is COUNTERS numbers, however many elements there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.uint32)
        for b in batches:
            total += np.bincount(_slot(b.column(0).flatten().to_numpy()), minlength=COUNTERS).astype(np.uint32)
        parts = [(i, part.tobytes()) for i, part in enumerate(total.reshape(-1, SLICE)) if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())], ["slice", "counts"])

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SLICE, np.uint32)
        for part in parts["counts"]:
            total += np.frombuffer(part, np.uint32)
        return pd.DataFrame({"slice": parts["slice"].iloc[:1], "counts": [total.tobytes()]})

    schema = "slice int, counts binary"
    out = np.zeros(COUNTERS, np.uint32)
    for r in sets.select("set").mapInArrow(count, schema).groupBy("slice").applyInPandas(add, schema).collect():
        out[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(r["counts"], np.uint32)
    return out


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes & (COUNTERS - 1)).astype(np.int64)


def _far_apart(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs among classes of very long lists, from full sets.

    Elements are ordered from the rarest (by counter, then by hash: any order
    that all sets share is right).  Two sets with the similarity share an
    element among the first size - ceil(size * percent / 100) + 1 of each; and
    from where they first meet, enough elements must remain on both sides.
    Elements that are alone in their counter meet nothing and are left out.
    Where sets meet, LONG_BITS bits of each estimate their similarity; they
    take four numbers a row, so rows stay small in the join."""
    counters = sets.sparkSession.sparkContext.broadcast(_rarity(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = counters.value
        for b in batches:
            elements, places, bits = [], [], []
            for one in b.column(3):
                hashes = one.values.to_numpy()
                often = held[_slot(hashes)]
                first = np.lexsort((hashes, often))[: len(hashes) + (-len(hashes) * percent) // 100 + 1]
                meets = often[first] > 1
                elements.append(hashes[first][meets])
                places.append(np.flatnonzero(meets))
                bits.append(_bits(hashes))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), _lists_of(bits), _lists_of(elements), _lists_of(places)], ["cid", "n", "comp", "bits", "es", "at"])

    rows = sets.join(members, "cid").select("cid", "n", "comp", "set")
    rows = rows.mapInArrow(run, "cid bigint, n int, comp bigint, bits array<bigint>, es array<bigint>, at array<bigint>")
    rows = rows.select("cid", "n", "comp", "bits", "es", F.posexplode(F.arrays_zip("es", "at")).alias("i", "x"))
    before = F.slice("es", F.greatest(F.lit(1), F.col("i") - BEFORE + 1), F.least(F.col("i"), F.lit(BEFORE)))
    rows = saved(rows.select("cid", "n", "comp", before.alias("pre"), F.col("x.es").alias("e"), F.col("x.at").alias("pos"), *[F.col("bits")[i].alias(f"bit{i}_") for i in range(LONG_BITS // 64)]), "neardup_rare")
    room = F.least(F.col("na") - F.col("posx"), F.col("nb") - F.col("posy"))
    # An element that both have before this one has brought the pair together already.
    first = ~F.arrays_overlap("prex", "prey")
    differ = sum((F.bit_count(F.col(f"bit{i}_x").bitwiseXOR(F.col(f"bit{i}_y"))) for i in range(LONG_BITS // 64)), F.lit(0))
    held = _open(rows, "e")
    dropped(rows)
    pairs = saved(_meetings(held, "e", (room * (100 + percent) >= (F.col("na") + F.col("nb")) * percent) & first & (differ <= LONG_BITS - LONG_SHARED), percent).distinct(), "neardup_far_pairs")
    dropped(held)
    return pairs


_ORDERS = np.random.default_rng(1).integers(0, 2**63, LONG_BITS, dtype=np.uint64)[:, None]


def _bits(hashes: np.ndarray) -> np.ndarray:
    """The last bits of the least number of a set in each of LONG_BITS orders, which come from mixing its hashes anew."""
    least = np.full(LONG_BITS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 2048):
        x = (hashes[at : at + 2048].view(np.uint64)[None, :] ^ _ORDERS) * np.uint64(MIX[0])
        x ^= x >> np.uint64(29)
        x *= np.uint64(MIX[1])
        least = np.minimum(least, x.min(axis=1))
    return np.packbits(((least >> np.uint64(7)) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``,
    ``component_id`` (smallest id reachable over links, itself included) and
    ``kept`` (its id is the component's).

    Documents are linked if 100 * shared >= percent * united shingles;
    ``percent`` must be at least 80, for which the sketch bounds are set.
    Documents without words (null, empty, blank) have no shingles and no
    links.  Equal sets are one class and need no pairs.  Rows that repeat an
    id are rows of their own.  Null ids come last; a component of null ids
    only has a null id, and its rows are not kept apart: ``kept`` compares
    null as equal.  An empty table gives no rows; other columns are not read."""
    out = _judged(docs, n, percent, id_col, text)
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _judged(docs: DataFrame, n: int, percent: int, id_col: str, text: str) -> DataFrame:
    """doc_id, row, th, n of every row, with root (of its component) and
    component_id; both are null for rows without words."""
    if percent < 80:
        raise ValueError("the sketch bounds hold for similarities of 0.8 or more")
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    with shuffles_dropped(docs.sparkSession):
        return _places(docs, n, percent)


def _places(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The result of :func:`_judged` for ``docs`` (doc_id, text).  Each table
    is dropped when what is made from it has been written."""
    each = saved(_sketches(docs, n), "neardup_docs")

    key = ["n", "k1", "k2"]
    per = saved(each.where("n > 0").groupBy(*key).agg(F.min("row").alias("cid"), F.min("doc_id").alias("rep")), "neardup_classes")
    # A class's sketch and place are those of its first row.
    classes = per.select("cid", "n").join(each.select(F.col("row").alias("cid"), F.col("doc_id").alias("at"), "th", "sketch", *MARKS), "cid")
    classes = saved(classes, "neardup_sketches")
    rows = saved(each.select("doc_id", "row", "th", *key), "neardup_rows")
    dropped(each)

    postings = _lists(classes)
    lists = postings.select("cid", "n", "typical", *MARKS, F.explode("vs").alias("v"))
    best = F.max(F.struct("typical", (-F.col("cid")).alias("c"), "n", *MARKS)).alias("best")
    centers = lists.groupBy("v").agg(best, F.count("*").alias("members")).where("members > 1")
    centers = saved(centers.select("v", (-F.col("best.c")).alias("center"), F.col("best.n").alias("nb"), *[F.col(f"best.{m}").alias(f"{m}c") for m in MARKS], "members"), "neardup_centers")
    # Members that may be linked to the center are near.
    near = (F.col("cid") != F.col("center")) & _close("n", "nb", percent) & _may_share("", "c", "n", "nb")
    lists = saved(lists.join(centers, "v").select("v", "cid", "n", "members", "center", near.alias("near")), "neardup_members")
    dropped(centers)

    star = lists.where("near").select(*_ordered("cid", "center")).distinct()
    star = saved(_by_sketch(star, classes), "neardup_star")
    sets = saved(_sets(docs, _ends(star).join(classes, "cid"), n), "neardup_sets")
    links = saved(_confirmed(star, sets, percent), "neardup_links")
    comp = saved(components(links), "neardup_components")

    placed = lists.join(comp.select(F.col("node").alias("cid"), "root"), "cid", "left").select("v", "cid", "n", "members", F.coalesce("root", "cid").alias("comp"))
    placed = saved(placed, "neardup_placed")
    dropped(lists)
    open_ = _open(placed.where(F.col("members") <= LONG_LIST).drop("members"), "v")
    # A list before this one that holds both has brought the pair together already, or is long and left to _far_apart.
    carried = postings.select("cid", *MARKS, "vs")
    short = open_.join(carried, "cid").withColumn("pre", F.slice("vs", F.lit(1), F.array_position("vs", F.col("v")).cast("int") - 1)).drop("vs")
    short = _meetings(short, "v", _may_share() & ~F.arrays_overlap("prex", "prey"), percent).distinct()
    more = saved(_by_sketch(short, classes), "neardup_short")
    dropped(open_)
    long_lists = placed.where(F.col("members") > LONG_LIST)
    apart = saved(long_lists.groupBy("v").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("v"), "neardup_apart")
    far = saved(_far(long_lists.join(apart, "v"), postings, percent).distinct(), "neardup_far")
    dropped(placed, postings)
    if not far.isEmpty():
        far_sets = saved(_sets(docs, far.select("cid").join(classes, "cid"), n), "neardup_far_sets")
        more = more.unionByName(_far_apart(far_sets, far, percent)).distinct()
    more = saved(more.join(star, ["a", "b"], "left_anti"), "neardup_more")
    if not more.isEmpty():
        new = _ends(more).join(sets.select("cid"), "cid", "left_anti")
        if not far.isEmpty():
            sets = sets.unionByName(far_sets.join(sets.select("cid"), "cid", "left_anti"))
            new = new.join(far.select("cid"), "cid", "left_anti")
        sets = sets.unionByName(saved(_sets(docs, new.join(classes, "cid"), n), "neardup_new_sets"))
        new = saved(_confirmed(more, sets, percent), "neardup_more_links")
        if not new.isEmpty():
            comp = saved(components(links.unionByName(new)), "neardup_components")

    found = per.join(comp.select(F.col("node").alias("cid"), "root"), "cid", "left").select(*key, "rep", F.coalesce("root", "cid").alias("root"))
    least = saved(found.groupBy("root").agg(F.min("rep").alias("component_id")), "neardup_least")
    found = saved(found.join(least, "root").select(*key, "root", "component_id"), "neardup_found")
    dropped(classes, per, least)
    return rows.join(found, key, "left").drop("k1", "k2")


def _far(members: DataFrame, postings: DataFrame, percent: int) -> DataFrame:
    """The ``members`` (v, cid, n, members, comp) of long lists that have to
    be told apart by their full sets: all of the longest lists; of the others
    those that some member of another component may be linked to, which its
    marks tell without making the pair."""
    marked = members.where(F.col("members") <= MARKED_LIST).join(postings.select("cid", *MARKS), "cid")
    side = lambda x, n: marked.select(F.col("v").alias(f"k{x}"), F.col("cid").alias(x), F.col("n").alias(n), F.col("comp").alias(f"c{x}"), *[F.col(m).alias(f"{m}{x}") for m in MARKS])
    alike = (F.col("kx") == F.col("ky")) & (F.col("cx") != F.col("cy")) & _close(percent=percent) & _may_share()
    alike = side("x", "na").join(side("y", "nb"), alike, "left_semi").select(F.col("x").alias("cid"), F.col("na").alias("n"), F.col("cx").alias("comp"))
    return alike.unionByName(members.where(F.col("members") > MARKED_LIST).select("cid", "n", "comp"))


def _lists(classes: DataFrame) -> DataFrame:
    """What each sketch puts into inverted lists of retained values: cid, n,
    its marks, typical and ``vs``, its listed values in one order for all.

    Two sketches that share at least SHARED values (in proportion for smaller
    sketches) also share one among the rarest size - SHARED + 1 of each, so
    only those are listed; values of a single sketch need no list.
    ``typical`` is high for sketches of frequent values: a copy with odd
    words of its own is less typical than what it was copied from."""
    values = classes.select("cid", F.explode("sketch").alias("v"))
    often = saved(values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1"), "neardup_values")
    held = values.join(often, "v").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"))
    held = held.join(classes.select("cid", "n", F.least(F.col("n"), F.lit(K)).alias("s"), *MARKS), "cid")
    least = F.ceil(F.col("s") * SHARED / K)
    prefix = F.col("s") - F.greatest(F.lit(1), least) + 1
    alone = F.col("s") - F.size("vs")
    typical = F.aggregate("vs", F.lit(0.0), lambda t, x: t + F.log(x.getField("df"))) / F.col("s")
    held = held.select("cid", "n", *MARKS, typical.alias("typical"), F.slice("vs", 1, F.greatest(F.lit(0), prefix - alone).cast("int")).alias("vs"))
    held = saved(held.select("cid", "n", *MARKS, "typical", F.col("vs.v").alias("vs")).where(F.size("vs") > 0), "neardup_postings")
    dropped(often)
    return held


def deduplicated(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each
    component the one row with the smallest id (nulls last; of rows that share
    it, the one with the least digest of its text).  Rows without words stay."""
    judged = saved(_judged(docs, n, percent, id_col, text).select("doc_id", "row", "th", "n", "root"), "neardup_judged")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "row")).alias("best")
    won = saved(judged.where("n > 0").groupBy("root").agg(best).select("best.doc_id", "best.th"), "neardup_won")
    per = judged.select("doc_id", F.lit(1).alias("r"), (F.col("n") == 0).cast("int").alias("k"))
    per = per.unionByName(won.select("doc_id", F.lit(0).alias("r"), F.lit(1).alias("k")))
    per = per.groupBy(F.col("doc_id").alias("_gone")).agg(F.sum("r").alias("_rows"), F.sum("k").alias("_kept")).where("_kept < _rows")
    per = saved(per, "neardup_gone")
    # Ids of which no row stays leave; a repeated id of which some rows stay is settled by its texts.
    stay = docs.alias("docs").join(per.select("_gone").alias("per"), F.col(f"docs.`{id_col}`").eqNullSafe(F.col("per._gone")), "left_anti")
    some = per.where("_kept > 0").select("_gone")
    if some.isEmpty():
        return stay
    part = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{id_col}`").alias("i"), F.xxhash64(F.col(f"`{text}`")).alias("t"))
    texts = won.select("doc_id", "th", F.lit(True).alias("one")).unionByName(judged.where("n = 0").select("doc_id", "th", F.lit(False).alias("one")).distinct())
    texts = saved(texts.join(some, _same("doc_id", "_gone")).drop("_gone"), "neardup_texts")
    part = part.join(texts, _same("i", "doc_id") & (F.col("t") == F.col("th")))
    one = part.where("one").groupBy("i", "t").agg(F.first("doc").alias("doc")).select("doc")
    part = one.unionByName(part.where("NOT one").select("doc"))
    return stay.unionByName(part.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns]))

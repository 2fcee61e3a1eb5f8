"""Exact similarity join of documents in the metric space of Jaccard distance.

1. Pivots, documents of the corpus, split the space: a document's home is its
   nearest pivot, if that is near enough (``REACH``).  By the triangle
   inequality two linked documents of which one has home p both lie within a
   window around p, so documents in the window are copied into p's region.
   Documents within the link distance of a pivot are linked to it at once.
2. Where no pivot is near, documents hardly overlap and single shingles are
   the pivots: the singleton {e} is at distance 1 - 1/size from a document
   that has e, else at 1.  All documents order shingles by one hash; a
   linked partner lacks at most size - ceil(size * percent / 100) of a
   document's shingles, so the document is copied into the regions of its
   first that many + 1 shingles, and meets every partner in one of them.
3. Small regions compare their documents across components of the links found
   so far.  Of the documents of large regions that are not one component yet
   those stay that share enough of their shingles with others there at all;
   they are the next level's space, with pivots of their own (the largest
   components that are still apart).
4. What the last level leaves is dealt to regions of single shingles again,
   now ordered from the rarest in the crowd, so that a passage that many have
   brings nothing together by itself.  Documents alone in all their regions
   leave.  The others first meet by runs: in the order of the united shingles
   of two linked documents, shared ones must stand in a run
   of ``RUN`` somewhere, for there are too few others to part them all.  Each
   is compared with the most typical one of each run.  What is then still
   apart is compared inside the regions, where two documents first meet and
   if enough shingles of both still follow.

Every step is exact; links are confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipewatch.llm.bottomk_dedup import shingle_hashes
from pipewatch.llm.common import saved
from pipewatch.llm.components import components
from pipewatch.plans.keyfilter import among, key_filter, possible

#: Pivots of a level (what is broadcast is bounded by them), and the longest text of a pivot.
PIVOTS, PIVOT_CHARS = 256, 20_000
#: Greatest distance from a document to its home.
REACH = 0.6
#: Levels of document pivots.
LEVELS = 2
#: Documents of a region that are compared directly across components.
SMALL = 64
#: Shared shingles in a row that two linked documents have if together they have 16 shingles or more
#: (n united, at most n / 5 not shared: (4 n / 5) / (n / 5 + 1) > 3); with fewer (but more than 4), two.
RUN, SHORT_RUN, SHORT = 4, 2, 15
#: Rarer shingles before a shingle that are looked at to meet most pairs once.
BEFORE = 16
#: Widens windows against rounding.
SLACK = 1e-9
#: One distinct text in so many is read beforehand; shingles that occur twice among them are common.
SAMPLED = 16
#: Bit of a shingle's number that common shingles have set, so that they come last.
COMMON = np.int64(1 << 62)


class Pivots:
    """Shingle sets of pivots, looked up by shingle."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        elements = np.concatenate([np.empty(0, np.int64), *sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(elements, kind="stable")
        self.elements, self.owner = elements[order], owner[order]

    def common(self, h: np.ndarray) -> np.ndarray:
        """Shingles that a set shares with each pivot."""
        lo, hi = np.searchsorted(self.elements, h, "left"), np.searchsorted(self.elements, h, "right")
        met = np.flatnonzero(hi > lo)
        if not len(met):
            return np.zeros(len(self.sizes), np.int64)
        return np.bincount(np.concatenate([self.owner[lo[i] : hi[i]] for i in met]), minlength=len(self.sizes))

    def place(self, h: np.ndarray, percent: int) -> tuple[int, list[int], list[float], list[int]]:
        """Home (-1: none), the pivots whose regions the set lies in, its
        similarities to them, and the pivots it is linked to."""
        common = self.common(h)
        near = np.flatnonzero(common)
        if not len(near):
            return -1, [], [], []
        c, united = common[near], len(h) + self.sizes[near] - common[near]
        j, r = c / united, 1 - percent / 100
        best = int(np.argmax(j))
        homed = j[best] >= 1 - REACH
        least = 1 - REACH - r if not homed else max(1 - REACH - r, j[best] - 2 * r)
        inside = j >= least - SLACK
        links = near[100 * c >= percent * united]
        return int(near[best]) if homed else -1, near[inside].tolist(), j[inside].tolist(), links.tolist()


def _numbers(text: str | None, n: int, common: np.ndarray) -> np.ndarray:
    """The sorted distinct numbers of a text's shingles: 62 bits of their hashes, common ones after the others."""
    h = shingle_hashes(text, n)
    return np.sort((h.view(np.uint64) >> np.uint64(2)).view(np.int64) | (COMMON * among(h, common)))


def _common_shingles(docs: DataFrame, n: int) -> np.ndarray:
    """A filter (of bounded size) of the shingles that are common in a sample of the distinct texts."""
    h = F.xxhash64("text", F.lit(17))
    some = docs.select("text", h.alias("h")).where(F.pmod("h", F.lit(SAMPLED)) == 0).groupBy("h").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches):
            yield pa.RecordBatch.from_arrays([_arrays([shingle_hashes(t.as_py(), n) for t in b.column(0)])], ["es"])

    each = some.select("text").mapInArrow(run, "es array<bigint>").select(F.explode("es").alias("e"))
    found = saved(each.groupBy("e").agg(F.count("*").alias("c")).where("c > 1").select("e"), "regions_common_shingles")
    return key_filter(found, "e", found.count()).bits()


def _first_shingles(h: np.ndarray, percent: int) -> np.ndarray:
    """The shingles whose regions a set is copied into: one at least is shared with any partner."""
    return h[: len(h) + (-len(h) * percent) // 100 + 1] if len(h) else h


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """Small batches, so that a task holds the sets of few documents at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _lists(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array(values, pa.list_(kind))


def _arrays(sets: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))


def _name(h: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(h.tobytes()), "<i8").tolist())


_PLACED = "home int, regions array<int>, nears array<double>, links array<int>"


def _placed(sets: list[np.ndarray], pivots: Pivots, percent: int) -> list[pa.Array]:
    places = [pivots.place(h, percent) for h in sets]
    columns = list(zip(*places, strict=True)) if places else [[]] * 4
    return [pa.array(columns[0], pa.int32()), _lists(columns[1], pa.int32()), _lists(columns[2], pa.float64()), _lists(columns[3], pa.int32())]


def _measured(docs: DataFrame, n: int, percent: int, pivots: Pivots, common: Broadcast) -> DataFrame:
    """Every row with its number, the hash of its text, size and name of its
    set, its place among the pivots, and its first shingles."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("th"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches):
            sets = [_numbers(t.as_py(), n, common.value) for t in b.column(3)]
            names = [_name(h) for h in sets]
            k1, k2 = zip(*names, strict=True) if names else ((), ())
            place = _placed(sets, shared.value, percent)
            first = _arrays([_first_shingles(h, percent) for h in sets])
            columns = [b.column(0), b.column(1), b.column(2), pa.array([len(h) for h in sets], pa.int32()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), *place, first]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "th", "n", "k1", "k2", "home", "regions", "nears", "links", "first"])

    return rows.mapInArrow(run, f"doc_id {kind}, row bigint, th bigint, n int, k1 bigint, k2 bigint, {_PLACED}, first array<bigint>")


def _first_pivots(docs: DataFrame, n: int, common: np.ndarray) -> Pivots:
    """The first level's pivots: distinct texts with the smallest hashes."""
    h = F.xxhash64("text", F.lit(29))
    fit = docs.where(F.length("text").between(1, PIVOT_CHARS)).select(h.alias("h"), "text")
    least = [r["h"] for r in fit.select("h").distinct().orderBy("h").limit(PIVOTS).collect()]
    texts = fit.where(F.col("h").isin(least)).groupBy("h").agg(F.min("text").alias("text")).orderBy("h") if least else fit
    sets = {h.tobytes(): h for r in texts.collect() for h in [_numbers(r["text"], n, common)] if len(h)}
    return Pivots(list(sets.values()))


def _next_pivots(sets: DataFrame, crowd: DataFrame) -> Pivots:
    """The next level's pivots: a document of each of the largest components of the crowd."""
    able = crowd.join(sets.select("cid", F.xxhash64("set").alias("h"), F.size("set").alias("s")), "cid").where(F.col("s") <= PIVOT_CHARS)
    pick = able.groupBy("comp").agg(F.count("*").alias("c"), F.min(F.struct("h", "cid")).alias("x"))
    pick = [r["cid"] for r in pick.orderBy(F.desc("c"), "x.h", "x.cid").limit(PIVOTS).select("x.cid").collect()]
    rows = sets.where(F.col("cid").isin(pick)).select("cid", "set").dropDuplicates(["cid"]).collect() if pick else []
    return Pivots([np.array(r["set"], np.int64) for r in sorted(rows, key=lambda r: r["cid"])])


def _same_size(percent: int, nx: str = "nx", ny: str = "ny") -> Column:
    return (F.col(nx) * 100 >= F.col(ny) * percent) & (F.col(ny) * 100 >= F.col(nx) * percent)


def _cross(members: DataFrame, key: str, percent: int, window: Column | None = None) -> DataFrame:
    """Distinct pairs (a < b) of documents of one region (``key``) that lie in
    different components, by size and ``window`` able to be linked.  A
    region's largest component is not compared within."""
    per = members.groupBy(key, "comp").agg(F.count("*").alias("c")).groupBy(key)
    open_ = per.agg(F.max(F.struct("c", "comp")).alias("m"), F.count("*").alias("comps")).where("comps > 1")
    open_ = saved(open_.select(F.col(key).alias("open"), F.col("m.comp").alias("main")), "regions_open")
    held = saved(members.join(open_, F.col(key) == F.col("open")), "regions_held")
    more = [c for c in ("near", "homed", "pos", "pre") if c in members.columns]
    side = lambda s: held.select(F.col(key).alias(f"k{s}"), F.col("cid").alias(s), F.col("n").alias(f"n{s}"), F.col("comp").alias(f"c{s}"), F.col("main").alias(f"m{s}"), *[F.col(c).alias(c + s) for c in more])
    x, y = side("x").where("cx != mx").drop("mx"), side("y")
    ok = (F.col("kx") == F.col("ky")) & (F.col("cx") != F.col("cy")) & ((F.col("cy") == F.col("my")) | (F.col("x") < F.col("y"))) & _same_size(percent)
    return x.join(y, ok if window is None else ok & window).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _able(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose first shingles leave a link possible.  Up to the lesser of
    their last shingles both sets are known whole; what differs there is no
    more than may differ in all: |x - y| + |y - x| <= (|x| + |y|) (1 - s) / (1 + s)."""
    ends = saved(_ends(pairs), "regions_ends")
    needed = saved(possible(classes, F.xxhash64("cid"), key_filter(ends, F.xxhash64("cid"), ends.count())).select("cid", "n", "first"), "regions_needed")
    side = lambda s: needed.select(F.col("cid").alias(s), F.col("n").alias(f"n{s}"), F.col("first").alias(f"f{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    last = F.least(F.element_at("fa", -1), F.element_at("fb", -1))
    known = lambda f: F.size(F.filter(f, lambda h: h <= last))
    apart = known("fa") + known("fb") - 2 * F.size(F.array_intersect("fa", "fb"))
    return both.where(apart * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)).select("a", "b")


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, n: int, common: Broadcast) -> DataFrame:
    """``cid`` and ``set`` of the classes ``wanted`` (cid), from the texts of
    their first rows.  A filter on the hashes of texts lets few others reach the join."""
    seek = saved(classes.select("cid", "at", "th").join(wanted, "cid", "left_semi"), "regions_seek")
    some = possible(docs, F.xxhash64("text"), key_filter(seek, "th", seek.count()))
    texts = some.join(seek, F.col("doc_id").eqNullSafe(F.col("at")) & (F.xxhash64("text") == F.col("th"))).select("cid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), _arrays([_numbers(t.as_py(), n, common.value) for t in b.column(1)])], ["cid", "set"])

    return texts.mapInArrow(run, "cid bigint, set array<bigint>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    side = lambda s: sets.select(F.col("cid").alias(s), F.col("set").alias(f"f{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("fa", "fb"))
    return both.where(common * 100 >= (F.size("fa") + F.size("fb") - common) * percent).select("a", "b").distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()


class _Join:
    """Classes of equal sets, the links found so far, and their components."""

    def __init__(self, docs: DataFrame, classes: DataFrame, n: int, percent: int, common: Broadcast):
        self.docs, self.classes, self.n, self.percent, self.common = docs, classes, n, percent, common
        self.sets = docs.sparkSession.createDataFrame([], "cid bigint, set array<bigint>")
        self.links = docs.sparkSession.createDataFrame([], "a bigint, b bigint")
        self.comp = docs.sparkSession.createDataFrame([], "node bigint, root bigint")
        self.levels = 0

    def know(self, wanted: DataFrame) -> None:
        """Full sets of ``wanted`` (cid), those at hand not again."""
        new = saved(wanted.join(self.sets.select("cid"), "cid", "left_anti"), "regions_wanted")
        if not new.isEmpty():
            self.sets = self.sets.unionByName(saved(_sets(self.docs, self.classes, new, self.n, self.common), "regions_sets"))

    def try_pairs(self, pairs: DataFrame) -> None:
        """Confirm pairs and settle components."""
        pairs = saved(pairs, "regions_met_pairs")
        if pairs.isEmpty():
            return
        pairs = saved(_able(pairs, self.classes, self.percent), "regions_pairs")
        if not pairs.isEmpty():
            self.know(_ends(pairs))
            self.add(_confirmed(pairs, self.sets, self.percent))

    def add(self, links: DataFrame) -> None:
        links = saved(links, "regions_links")
        if not links.isEmpty():
            self.links = self.links.unionByName(links)
            self.comp = saved(components(self.links), "regions_components")

    def to_pivots(self, placed: DataFrame) -> DataFrame:
        """Links of documents to the pivots of this level, which are nodes below 0."""
        return placed.select(F.col("cid").alias("a"), F.explode("links").alias("p")).select("a", (F.lit(-1 - self.levels * PIVOTS) - F.col("p")).cast("long").alias("b"))

    def with_comp(self, members: DataFrame) -> DataFrame:
        found = self.comp.select(F.col("node").alias("cid"), F.col("root").alias("found"))
        return members.join(found, "cid", "left").withColumn("comp", F.coalesce("found", "cid")).drop("found")

    def regions(self, placed: DataFrame) -> DataFrame:
        """The regions of this level's pivots: region, cid, n, near, homed."""
        each = placed.select("cid", "n", "home", F.explode(F.arrays_zip("regions", "nears")).alias("r"))
        return each.select(F.col("r.regions").cast("long").alias("region"), "cid", "n", F.col("r.nears").alias("near"), (F.col("home") == F.col("r.regions")).alias("homed"))

    def settle(self, members: DataFrame, window: Column | None = None) -> DataFrame:
        """Try the pairs of small regions; the documents of large ones that
        are not one component yet (cid) are returned."""
        size = members.groupBy("region").agg(F.count("*").alias("size"))
        members = saved(self.with_comp(members.join(size, "region")), "regions_members")
        large = members.where(F.col("size") > SMALL)
        apart = large.groupBy("region").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("region")
        crowd = saved(large.join(saved(apart, "regions_apart"), "region").select("cid").distinct(), "regions_crowd")
        self.try_pairs(_cross(members.where(F.col("size") <= SMALL), "region", self.percent, window))
        return crowd

    def window(self) -> Column:
        """Pairs of a pivot's region that may be linked: one is at home there,
        and their distances from the pivot are no more than a link apart."""
        return (F.col("homedx") | F.col("homedy")) & (F.abs(F.col("nearx") - F.col("neary")) <= 1 - self.percent / 100 + SLACK)

    def plausible(self, crowd: DataFrame) -> DataFrame:
        """The documents of the crowd that share enough of their shingles with
        others of it: a linked one shares ``percent`` of its own at least."""
        # Read twice, not kept: most of the crowd is not needed again.
        sets = _sets(self.docs, self.classes, crowd, self.n, self.common)
        common = saved(sets.select(F.explode("set").alias("e")).groupBy("e").agg(F.count("*").alias("c")).where("c > 1").select("e"), "regions_common")
        bits = crowd.sparkSession.sparkContext.broadcast(key_filter(common, "e", common.count()).bits())
        percent = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in _pieces(batches):
                sizes = [(len(s), int(among(s.values.to_numpy(), bits.value).sum())) for s in b.column(1)]
                yield b.select([0]).filter(pa.array([100 * c >= percent * n for n, c in sizes], pa.bool_()))

        return saved(sets.mapInArrow(run, "cid bigint"), "regions_plausible").distinct()

    def deeper(self, crowd: DataFrame) -> DataFrame:
        """One more level of pivots for the documents of the crowd (cid)."""
        self.levels += 1
        self.know(crowd)
        crowd = saved(self.with_comp(crowd), "regions_crowd")
        sets = saved(self.sets.join(crowd.select("cid"), "cid", "left_semi").dropDuplicates(["cid"]), "regions_crowd_sets")
        pivots = _next_pivots(sets, crowd)
        shared, percent = crowd.sparkSession.sparkContext.broadcast(pivots), self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in _pieces(batches):
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *_placed([s.values.to_numpy() for s in b.column(2)], shared.value, percent)], ["cid", "n", "home", "regions", "nears", "links"])

        placed = saved(sets.select("cid", F.size("set").alias("n"), "set").mapInArrow(run, f"cid bigint, n int, {_PLACED}"), "regions_placed")
        self.add(self.to_pivots(placed))
        left = self.settle(self.regions(placed), self.window())
        return saved(left.unionByName(placed.where("home < 0").select("cid")).distinct(), "regions_left")

    def by_runs(self, crowd: DataFrame) -> None:
        """Pairs of the crowd that share a run of shingles and a rare one."""
        self.know(crowd)
        sets = self.sets.join(crowd, "cid", "left_semi").dropDuplicates(["cid"]).withColumn("n", F.size("set"))
        rare = _rare_regions(sets, self.percent)
        shared = rare.groupBy("region").agg(F.count("*").alias("c")).where("c > 1").select("region")
        rare = saved(rare.join(saved(shared, "regions_rare_shared"), "region"), "regions_rare_met")
        typical = saved(rare.select("cid", "typical").distinct(), "regions_typical")
        sets = self.with_comp(sets.join(typical, "cid"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in _pieces(batches):
                keys = [_runs(s.values.to_numpy()) for s in b.column(4)]
                yield pa.RecordBatch.from_arrays([*b.columns[:4], _arrays(keys)], ["cid", "n", "comp", "typical", "runs"])

        runs = sets.select("cid", "n", "comp", "typical", "set").mapInArrow(run, "cid bigint, n int, comp bigint, typical double, runs array<bigint>")
        runs = saved(runs.select("cid", "n", "comp", "typical", F.explode("runs").alias("region")), "regions_runs")
        # Documents of one component need not meet; a run of one component brings nothing together.
        best = F.max(F.struct("typical", (-F.col("cid")).alias("c"))).alias("best")
        open_ = runs.groupBy("region").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), best).where("lo < hi")
        met = runs.join(saved(open_.select("region", (-F.col("best.c")).alias("center")), "regions_shared_runs"), "region")
        size = self.classes.select(F.col("cid").alias("center"), F.col("n").alias("ny"))
        star = met.where("cid != center").select("cid", "center", F.col("n").alias("nx")).distinct().join(size, "center").where(_same_size(self.percent))
        self.try_pairs(star.select(F.least("cid", "center").alias("a"), F.greatest("cid", "center").alias("b")).distinct())
        self.try_pairs(_cross(self.with_comp(rare.drop("typical")), "region", self.percent, _first_meeting(self.percent)))


def _runs(h: np.ndarray) -> np.ndarray:
    """One number for each run of RUN (or SHORT_RUN) shingles in order.
    Documents of 13 to 15 shingles may meet partners of either kind."""
    out = []
    for width, wanted in ((RUN, len(h) * 5 >= 4 * (SHORT + 1)), (SHORT_RUN, len(h) <= SHORT)):
        if wanted and len(h) >= width:
            key = np.full(len(h) - width + 1, width, np.uint64)
            for k in range(width):
                key = (key ^ h[k : len(h) - width + 1 + k].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            out.append(key.view(np.int64))
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.int64)


def _rare_regions(sets: DataFrame, percent: int) -> DataFrame:
    """Regions of single shingles (region, cid, n, typical, pos, pre): of each
    of ``sets`` (cid, n, set) the first shingles, ordered from the rarest
    among them, with the number of shingles before and the BEFORE last of
    these.  Shingles of one set only come first of all and have no region.
    ``typical`` is high for sets of frequent shingles."""
    each = sets.select("cid", "n", F.explode("set").alias("v"))
    often = saved(each.groupBy("v").agg(F.count("*").alias("df")).where("df > 1"), "regions_rare")
    own = possible(each, F.col("v"), key_filter(often, "v", often.count())).join(often, "v").groupBy("cid", "n").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"))
    alone = F.col("n") - F.size("vs")
    most = F.floor(F.col("n") * (100 - percent) / 100).cast("int") + 1 - alone
    typical = F.aggregate("vs", F.lit(0.0), lambda t, x: t + F.log(x.getField("df"))) / F.col("n")
    own = own.select("cid", "n", typical.alias("typical"), alone.alias("alone"), F.slice("vs.v", 1, F.greatest(F.lit(0), most)).alias("vs"))
    own = own.select("cid", "n", "typical", "alone", "vs", F.posexplode("vs").alias("i", "region"))
    pre = F.slice("vs", F.greatest(F.lit(1), F.col("i") - BEFORE + 1), F.least(F.col("i"), F.lit(BEFORE)))
    return saved(own.select("region", "cid", "n", "typical", (F.col("alone") + F.col("i")).alias("pos"), pre.alias("pre")), "regions_rare_shingles")


def _first_meeting(percent: int) -> Column:
    """Pairs of a region of :func:`_rare_regions` that may be linked, if it is
    the first of both: as many shingles as they must share have to follow.  A
    rarer one that both have has brought the pair together already."""
    room = F.least(F.col("nx") - F.col("posx"), F.col("ny") - F.col("posy"))
    return (room * (100 + percent) >= (F.col("nx") + F.col("ny")) * percent) & ~F.arrays_overlap("prex", "prey")


def _shingle_regions(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Regions of single shingles (region, cid, n) that hold two documents or
    more, of documents without a home, and pairs (cid, center): of the most
    typical documents of its regions (those of many common shingles) the one
    that a document meets most often."""
    # What is worked out of an array is selected before the array is dealt out into rows, else each row would carry it.
    each = classes.where("home < 0").select("cid", "n", F.size("first").alias("m"), "first").select("cid", "n", "m", F.explode("first").alias("v"))
    often = saved(each.groupBy("v").agg(F.count("*").alias("df")).where("df > 1"), "regions_often")
    own = possible(each, F.col("v"), key_filter(often, "v", often.count())).join(often, "v").groupBy("cid", "n", "m").agg(F.collect_list(F.struct("v", "df")).alias("vs"))
    typical = F.aggregate("vs", F.lit(0.0), lambda t, x: t + F.log(x.getField("df"))) / F.col("m")
    own = own.select("cid", "n", typical.alias("typical"), F.col("vs.v").alias("vs"))
    held = saved(own.select("cid", "n", "typical", F.explode("vs").alias("region")), "regions_shingles")
    center = held.groupBy("region").agg(F.max(F.struct("typical", (-F.col("cid")).alias("c"), "n")).alias("best"))
    center = saved(center.select("region", (-F.col("best.c")).alias("center"), F.col("best.n").alias("ny")), "regions_centers")
    star = held.join(center, "region").where((F.col("cid") != F.col("center")) & _same_size(percent, "n", "ny")).groupBy("cid", "center").agg(F.count("*").alias("c"))
    star = star.groupBy("cid").agg(F.max(F.struct("c", (-F.col("center")).alias("x"))).alias("best")).select("cid", (-F.col("best.x")).alias("center"))
    return held.select("region", "cid", "n"), star


def linked(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` (size of its
    set of ``n``-word shingles, A-Z lower-cased; with fewer words the whole
    sequence is the one shingle) and ``component_id`` (smallest id reachable
    over links, itself included).

    Two documents are linked if 100 * shared >= percent * united shingles;
    ``percent`` must be at least 80, for which the lengths of runs are set.
    Null, empty and blank texts have no shingles and no links.  Equal sets
    are one class.  Rows that repeat an id are rows of their own.  Null ids
    come last: a component of null ids only has a null id.  An empty table
    gives no rows; other columns are not read, whatever their names.
    Shingles are 62-bit hashes (two of a pair of documents are the same by
    accident with a chance of about 1e-12)."""
    if percent < 80:
        raise ValueError("the lengths of runs hold for similarities of 0.8 or more")
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    often = _common_shingles(docs, n)
    common = docs.sparkSession.sparkContext.broadcast(often)
    each = saved(_measured(docs, n, percent, _first_pivots(docs, n, often), common), "regions_docs")
    key = ["n", "k1", "k2"]
    per = saved(each.where("n > 0").groupBy(*key).agg(F.min("row").alias("cid"), F.min("doc_id").alias("rep")), "regions_sets_of")
    first = each.select(F.col("row").alias("cid"), F.col("doc_id").alias("at"), "th", "n", "home", "regions", "nears", "links", "first")
    classes = saved(first.join(per.select("cid"), "cid"), "regions_classes")

    join = _Join(docs, classes, n, percent, common)
    shingle_regions, star = _shingle_regions(classes, percent)
    star = star.select(F.least("cid", "center").alias("a"), F.greatest("cid", "center").alias("b")).distinct()
    star = saved(_able(star, classes, percent), "regions_star")
    join.know(_ends(star))
    join.add(join.to_pivots(classes).unionByName(_confirmed(star, join.sets, percent)))
    crowd = join.settle(join.regions(classes), join.window())
    crowd = saved(crowd.unionByName(join.settle(shingle_regions)).distinct(), "regions_crowd")
    if not crowd.isEmpty():
        crowd = join.plausible(crowd)
    while join.levels < LEVELS - 1 and not crowd.isEmpty():
        crowd = join.deeper(crowd)
    if not crowd.isEmpty():
        join.by_runs(crowd)

    found = per.join(join.comp.select(F.col("node").alias("cid"), "root"), "cid", "left").select(*key, "rep", F.coalesce("root", "cid").alias("root"))
    least = saved(found.groupBy("root").agg(F.min("rep").alias("component_id")), "regions_least")
    found = saved(found.join(least, "root").select(*key, "component_id"), "regions_found")
    out = each.select("doc_id", *key).join(found, key, "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))

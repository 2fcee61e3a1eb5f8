"""Best-two-fit packing of tokenised documents into fixed-size sequences.

Lengths are whole numbers up to the sequence size, so the plan depends only on
how many pieces there are of each length: at most 2048 counts, however large
the corpus is.  The plan is a list of layouts with how often each is used;
pieces are numbered within their length and look up their place.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewatch.llm.common import gapless_rank, hash52, saved
from pipewatch.llm.token_counts import Memory

SEQUENCE = 2048
#: Pre-tokens that a worker remembers, in each of two generations.
REMEMBERED = 400_000
#: Pieces of the corpus in one numbering range, about.
RANK_ROWS = 2_000

#: The tokenizer's pre-token pattern, 's|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+,
#: written out for lower-case Latin-1 text (fixed value).
LATIN_LETTERS, LATIN_NUMBERS, LATIN_SPACE = r"a-zªµºß-öø-ÿ", r"0-9²³¹¼½¾", r"\x09-\x0d\x20\x85\xa0"
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN_LETTERS}]+|[{LATIN_NUMBERS}]|[^{LATIN_SPACE}{LATIN_LETTERS}{LATIN_NUMBERS}]+"


def _little(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class FastIds:
    """Token ids of a text exactly as the tokenizer gives them, remembering
    pre-tokens.

    The tokenizer drops white space and merges inside pre-tokens only, so the
    ids of a text are those of its pre-tokens in a row.  Latin-1 texts are
    lowered and split here by the same pattern.  Other texts go word by word,
    and words with other characters to the tokenizer itself; so do texts with
    special-token marks or control separators, whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.split = re.compile(PRE_TOKEN).findall
        self.odd = re.compile(r"[\x1c-\x1f]").search
        # Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256 onwards.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.parts = Memory(REMEMBERED, self._part)

    def _part(self, part: str) -> bytes:
        letters = part if part.isascii() and part.isprintable() else "".join([self.alphabet[b] for b in part.encode()])
        return _little([t.id for t in self.model.tokenize(letters)])

    def _latin(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, self.split(text.lower())))

    def _whole(self, text: str) -> bytes:
        return _little(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if "<|" in text:
            return self._whole(text)
        if _is_latin(text):
            return self._latin(text)
        if self.odd(text):
            return self._whole(text)
        return b"".join([self._latin(w) if _is_latin(w) else self._whole(w) for w in text.split()])


def _is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_loaded: dict[str, FastIds] = {}


def token_pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = 0, id_col: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise and cut: ``doc_id``, ``piece``, ``start``, ``length``,
    ``ids_crc32`` and, with ``with_ids``, ``ids``.  A document is its ids and
    then ``end_id``; only documents longer than ``sequence`` are cut.  Null
    and empty texts are the end id alone."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = FastIds(path)
        fast = _loaded[path]
        end, step = end_id.to_bytes(4, "little"), 4 * sequence
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for k, t in enumerate(b.column(1)):
                ids = fast.ids(t.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    for col, v in zip(cols, (k, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None), strict=True):
                        col.append(v)
            arrays = [b.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:5]]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, pa.array(cols[5], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(f"`{id_col}`", f"`{text}`").mapInArrow(run, schema)


def layouts(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, list[int]]]:
    """Best-two-fit on counts of lengths: [(how many sequences, lengths in order)].

    A sequence is filled greedily with the longest piece that fits.  Then its
    shortest piece is replaced by the two unpacked pieces that fill the gap
    this opens most tightly, if they fill it better.  The same layout is used
    again for as long as the counts allow."""
    left = {k: n for k, n in counts.items() if n > 0}
    if any(k < 1 or k > size for k in left):
        raise ValueError(f"lengths must lie between 1 and {size}")
    lengths, out = sorted(left), []
    while lengths:
        used: dict[int, int] = {}
        fill, room = [], size
        while room:
            at = bisect_right(lengths, room) - 1
            while at >= 0 and used.get(lengths[at], 0) >= left[lengths[at]]:
                at -= 1
            if at < 0:
                break
            k = lengths[at]
            fill.append(k)
            used[k] = used.get(k, 0) + 1
            room -= k
        if room and len(fill) > 1:
            small = fill[-1]
            gap = room + small
            free = {k: left[k] - used.get(k, 0) for k in lengths}
            best = (small, None)
            lo, hi = 0, bisect_right(lengths, gap) - 1
            while lo <= hi and best[0] < gap:  # two pointers over the lengths that are left
                a, b = lengths[lo], lengths[hi]
                if a + b > gap or free[b] < 1:
                    hi -= 1
                elif free[a] < 1 or (lo == hi and free[a] < 2):
                    lo += 1
                else:
                    best = max(best, (a + b, (b, a)), key=lambda x: x[0])
                    lo += 1
            if best[1]:
                used[small] -= 1
                fill[-1:] = best[1]
                for k in best[1]:
                    used[k] = used.get(k, 0) + 1
        times = min(left[k] // n for k, n in used.items() if n)
        out.append((times, fill))
        for k, n in used.items():
            left[k] -= times * n
        lengths = [k for k in lengths if left[k] > 0]
    return out


def pack(pieces: DataFrame, sequence: int = SEQUENCE, order: tuple[str, ...] = ("doc_id", "piece"), length: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every row of ``pieces`` (a table
    that reads the same each time, such as one from :func:`saved`).

    Sequences are filled from 0 without gaps and hold at most ``sequence``
    tokens; ids are numbers from 0.  Rows are numbered within their length;
    a length shared by a third of all rows is numbered in ranges.  Rows that
    agree in ``order`` and length get places of their own, in any order.
    An empty table stays empty; columns of the two names are replaced."""
    spark = pieces.sparkSession
    mine = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    counts = {r[0]: r[1] for r in pieces.groupBy(length).agg(F.count("*")).collect()}  # at most `sequence` rows
    plan, first, taken = [], 0, {}
    for times, lengths in layouts(counts, sequence):
        at = 0
        for k in lengths:
            begin = taken.get(k, 0)
            plan.append((k, begin, begin + times, first, at))
            taken[k] = begin + times
            at += k
        first += times
    places = spark.createDataFrame(plan, "_len int, _from bigint, _to bigint, _first bigint, _offset bigint")
    total = sum(counts.values())
    ranked = gapless_rank(
        pieces.select(*[f"`{c}`" for c in mine]).withColumn("_at", hash52(*[F.col(c) for c in order])),
        [length], "_at", list(order), max(64, -(-total // RANK_ROWS)), out="_rank",
    )
    # The plan has a few rows a length and never more than the counts allow: broadcast.
    met = ranked.join(F.broadcast(places), (F.col(length) == F.col("_len")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    return met.select(*mine, (F.col("_first") + F.col("_rank") - F.col("_from")).alias("sequence_id"), F.col("_offset").alias("offset"))


def pack_documents(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = 0) -> DataFrame:
    """Tokenise, cut and pack: see :func:`token_pieces` and :func:`pack`."""
    return pack(saved(token_pieces(docs, path, sequence, end_id), "packing_pieces"), sequence)

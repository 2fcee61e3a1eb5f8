"""Mergeable key filters: which rows of a large table can have a partner.

A filter is a bitmap of fixed size over hashed keys, cut into pieces of 4 kB.
Tasks set bits of the pieces they meet and pieces are united by a partial
aggregate, so a filter costs a map-side combine and a shuffle of its pieces,
however many keys there are.  Probing joins the large table with the pieces
(broadcast: at most ``MOST_PIECES`` of 4 kB) and keeps rows whose bit is set.
A key of the filter always passes; another passes with the share of bits that
are set.  The exact join follows, on the rows that are left, so results never
depend on the filter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a piece (fixed: what ``bitmap_construct_agg`` makes) and the most pieces of a filter (16 MB).
PIECE_BITS, MOST_PIECES = 32_768, 4_096
#: Bits for each key: 1 in 16 other keys passes, fewer than 1 in 3 up to MOST_PIECES * PIECE_BITS / 2.5 keys.
BITS_PER_KEY = 16

_PIECE, _BITS = "__kf_piece", "__kf_bits"


@dataclass(frozen=True)
class KeyFilter:
    """``table``: piece number and bits; ``pieces``: how many there can be."""

    table: DataFrame
    pieces: int

    def bits(self) -> np.ndarray:
        """The filter as one byte array (bit i of a key is bit i % 8 of byte
        i // 8), for tests of keys inside Python tasks."""
        out = np.zeros((self.pieces, PIECE_BITS // 8), np.uint8)
        for r in self.table.collect():
            out[r[_PIECE]] = np.frombuffer(r[_BITS], np.uint8)
        return out.reshape(-1)


def pieces_for(keys: int) -> int:
    wanted = max(1, -(-keys * BITS_PER_KEY // PIECE_BITS))
    return min(MOST_PIECES, 1 << (wanted - 1).bit_length())


def _place(h: Column, pieces: int) -> Column:
    return F.pmod(h, F.lit(pieces * PIECE_BITS))


def key_filter(keys: DataFrame, h: Column | str, count: int) -> KeyFilter:
    """The filter of the 64-bit hashes ``h`` of ``keys`` (nulls set no bit),
    sized for about ``count`` of them."""
    pieces = pieces_for(count)
    place = _place(F.col(h) if isinstance(h, str) else h, pieces)
    rows = keys.select(place.alias("p")).where("p IS NOT NULL")
    rows = rows.select(F.floor(F.col("p") / PIECE_BITS).cast("int").alias(_PIECE), (F.col("p") % PIECE_BITS).alias("b"))
    return KeyFilter(rows.groupBy(_PIECE).agg(F.bitmap_construct_agg("b").alias(_BITS)), pieces)


def possible(df: DataFrame, h: Column, filter_: KeyFilter) -> DataFrame:
    """Rows of ``df`` whose hash may be among the filter's keys (all that are,
    and some that are not); rows with a null hash go."""
    place = "__kf_place"
    probed = df.withColumn(place, _place(h, filter_.pieces))
    pieces = F.broadcast(filter_.table.withColumnRenamed(_PIECE, "__kf_found"))
    joined = probed.join(pieces, F.floor(F.col(place) / PIECE_BITS).cast("int") == F.col("__kf_found"))
    bit = F.col(place) % PIECE_BITS
    byte = F.conv(F.hex(F.substring(_BITS, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return joined.where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*[F.col(f"`{c}`") for c in df.columns])


def among(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of an array of hashes may be among the keys of
    :meth:`KeyFilter.bits`."""
    place = np.mod(hashes, len(bits) * 8)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1

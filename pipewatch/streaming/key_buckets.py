"""Many keys to a group of a stateful stream: what the two operators of S2
share.

A call of Python for each key and micro-batch costs milliseconds, however few
rows the key has.  So keys are dealt by their hash to ``BUCKETS`` groups; one
call takes up all rows of a bucket at once, and the bucket's state holds the
largest event time of each of its keys.  The number of buckets is part of a
checkpoint's layout.

A key travels as one text (``key_name``), exact for any type of the key
columns, and is turned back in the JVM (``key_columns``)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Groups that the keys of a stream are dealt to.
BUCKETS = 1024

#: Stands for a null ``seq``, which comes last.
LAST = 2**63 - 1


def _text(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        c = c + F.lit(0.0)  # -0.0 is grouped with 0.0
    elif isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)
    elif isinstance(kind, T.BinaryType):
        c = F.base64(c)
    elif isinstance(kind, (T.StructType, T.ArrayType)):
        c = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
    return c.cast("string")


def _value(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(text.cast("bigint"))
    if isinstance(kind, T.BinaryType):
        return F.unbase64(text)
    if isinstance(kind, (T.StructType, T.ArrayType)):
        return F.from_json(text, T.StructType([T.StructField("v", kind)])).getField("v")
    return text.cast(kind)


def key_name(columns: Sequence[Column], kinds: Sequence[T.DataType]) -> Column:
    """One text for the key ``columns``; never null."""
    return F.to_json(F.array(*[_text(c, k) for c, k in zip(columns, kinds)]))


def key_columns(name: Column, kinds: Sequence[T.DataType]) -> list[Column]:
    """The key columns of a :func:`key_name`."""
    texts = F.from_json(name, "array<string>")
    return [_value(texts[i], k) for i, k in enumerate(kinds)]


def bucket(name: Column) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(BUCKETS)).cast("int")


class Tops:
    """The largest event time of each key of a bucket, as it was stored:
    parallel lists of names, times and when a key was last seen.  Keys not
    seen for ``idle_ms`` are left out."""

    def __init__(self, stored: Sequence | None, now: int, idle_ms: int | None) -> None:
        names, tops, seen = stored or ([], [], [])
        if idle_ms is not None:
            live = [i for i, at in enumerate(seen) if at + idle_ms > now]
            names, tops, seen = ([x[i] for i in live] for x in (names, tops, seen))
        self.at = {n: i for i, n in enumerate(names)}
        self.tops, self.seen, self.now = np.array(tops, "float64"), np.array(seen, "int64"), now

    def numbers(self, names: pd.Series) -> np.ndarray:
        """The places of keys; new ones are taken in."""
        codes, distinct = pd.factorize(names)
        at = np.array([self.at.setdefault(n, len(self.at)) for n in distinct], "int64")
        new = len(self.at) - len(self.tops)
        self.tops = np.append(self.tops, np.full(new, np.nan))
        self.seen = np.append(self.seen, np.full(new, self.now))
        self.seen[at] = self.now
        return at[codes]

    def late(self, at: np.ndarray, seq: np.ndarray, ts: np.ndarray) -> pd.DataFrame:
        """``name``, ``diff_ts`` and ``id`` of the late ones of these rows,
        which come after those before; rows of a key with equal ``seq`` stay in
        their order.  A null time (NaN) is passed over."""
        order = np.lexsort((seq, at))
        at, seq, ts = at[order], seq[order], ts[order]
        running = np.fmax(pd.Series(ts).groupby(at).cummax().to_numpy(), self.tops[at])
        np.fmax.at(self.tops, at, ts)
        late = running > ts
        ids = pd.array(seq[late], dtype="Int64")
        ids[seq[late] == LAST] = pd.NA
        names = np.array(list(self.at), dtype=object)[at[late]]
        # Of type object: frames are put together, and Arrow text would come out in chunks.
        return pd.DataFrame({"name": pd.Series(names, dtype=object), "diff_ts": (running - ts)[late].astype("int64"), "id": ids})

    def stored(self) -> tuple[list, list, list]:
        met = np.flatnonzero(~np.isnan(self.tops))
        names = list(self.at)
        return [names[i] for i in met], self.tops[met].astype("int64").tolist(), self.seen[met].tolist()

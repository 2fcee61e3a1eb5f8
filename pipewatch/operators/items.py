"""Key-value items: latest keys then fetch, lookup by key, typed-attribute
unwrap, attribute rows and local time of ISO strings.

A *typed item* is ``key string, item map<string, map<string,string>>``
(``{attr: {type: value}}``); :func:`unwrap` turns it into
``map<string,string>``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipewatch.functions.maps import unwrap
from pipewatch.functions.times import to_local  # noqa: F401  (K5, re-exported)

# Fixed value: how many newest keys are fetched by default.
LATEST_DEFAULT = 1
# A top-n key list is broadcast to the item scan up to this many keys.
MAX_BROADCAST_KEYS = 100_000


def latest_items(keys: DataFrame, items: DataFrame, key: str, time: str, n: int = LATEST_DEFAULT, tie: str | None = None) -> DataFrame:
    """Items of the ``n`` newest keys (by ``time``, ties by ``tie`` then key,
    descending).  The top-n is a ``TakeOrderedAndProject``; its result has at
    most ``n`` rows, so it is broadcast (up to a fixed bound) into a
    ``left_semi`` join with the items."""
    order = [F.col(time).desc()] + ([F.col(tie).desc()] if tie else []) + [F.col(key).desc()]
    top = keys.orderBy(*order).limit(n).select(key).distinct()
    if n <= MAX_BROADCAST_KEYS:
        top = F.broadcast(top)
    return items.join(top, key, "left_semi")


def items_by_key(items: DataFrame, hash_key: str, term: str | None, range_key: str | None = None, range_term=None) -> DataFrame:
    """Items with hash key ``term`` (all range rows of it), or with the full
    key when ``range_term`` is given; a blank term gives nothing."""
    if term is None or not str(term).strip():
        return items.where(F.lit(False))
    cond = F.col(hash_key) == F.lit(term)
    if range_key is not None and range_term is not None:
        cond = cond & (F.col(range_key) == F.lit(range_term))
    return items.where(cond)


def unwrap_items(items: DataFrame, col: str = "item") -> DataFrame:
    """``item`` typed map to plain ``map<string,string>``."""
    return items.withColumn(col, unwrap(col))


def attributes(items: DataFrame, key: str = "key", col: str = "item") -> DataFrame:
    """One row per attribute: ``key, attribute, value`` (``explode`` of the
    unwrapped map)."""
    typed = isinstance(items.schema[col].dataType.valueType, T.MapType)
    plain = unwrap(col) if typed else F.col(col)
    return items.select(key, F.explode(plain).alias("attribute", "value"))

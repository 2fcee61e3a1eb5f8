"""JSON and map column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_map(text: Column | str) -> Column:
    """JSON object text to map<string,string>; malformed or non-object text
    gives null (never an error)."""
    return F.from_json(_c(text), "map<string,string>")


def sum_map_values(m: Column | str) -> Column:
    """Sum of the values of a map<string,string> as bigint; ``{}`` gives 0
    and a value that is not an integer makes the sum null."""
    return F.aggregate(
        F.map_values(_c(m)),
        F.lit(0).cast("bigint"),
        lambda acc, x: acc + x.try_cast("bigint"),
    )


def unwrap(item: Column | str) -> Column:
    """Typed attributes ``{a: {S: v}}`` to ``{a: v}`` (the one value of the
    inner type map).  An attribute without a value (empty or null type map)
    is dropped."""
    held = F.map_filter(_c(item), lambda _k, v: F.coalesce(F.size(v) > 0, F.lit(False)))
    return F.transform_values(held, lambda _k, v: F.try_element_at(F.map_values(v), F.lit(1)))

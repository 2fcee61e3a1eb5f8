"""Name functions: topic to table name, partition-table name folding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The partition-table name rules, in the order they are tried
# (composite hash+range, composite range+hash, range, then hash).  Each is a
# full match of the physical table name; group 1 is the logical base name.
PARTITION_NAME_RULES: list[tuple[str, str]] = [
    (r"([_a-z0-9]+[a-z])_p?\d{1,3}_default", "hash then range (default)"),
    (r"([_a-z0-9]+[a-z])_p?\d{1,3}_p?\d{4}", "hash then range (year)"),
    (r"([_a-z0-9]+[a-z])_p?\d{1,3}_p?(?:\d{6}|\d{4}_\d{2})", "hash then range (month)"),
    (r"([_a-z0-9]+[a-z])_p?\d{1,3}_p?(?:\d{8}|\d{4}_\d{2}_\d{2})", "hash then range (day)"),
    (r"([_a-z0-9]+[a-z])_default_p?\d{1,3}", "range (default) then hash"),
    (r"([_a-z0-9]+[a-z])_p?\d{4}_p?\d{1,3}", "range (year) then hash"),
    (r"([_a-z0-9]+[a-z])_p?(?:\d{6}|\d{4}_\d{2})_p?\d{1,3}", "range (month) then hash"),
    (r"([_a-z0-9]+[a-z])_p?(?:\d{8}|\d{4}_\d{2}_\d{2})_p?\d{1,3}", "range (day) then hash"),
    (r"([_a-z0-9]+[a-z])_default", "range (default)"),
    (r"([_a-z0-9]+[a-z])_p?\d{4}", "range (year)"),
    (r"([_a-z0-9]+[a-z])_p?(?:\d{6}|\d{4}_\d{2})", "range (month)"),
    (r"([_a-z0-9]+[a-z])_p?(?:\d{8}|\d{4}_\d{2}_\d{2})", "range (day)"),
    (r"([_a-z0-9]+[a-z])_p?\d{1,3}", "hash"),
]

# Fixed value: the short partition suffix stripped from table names.
PARTITION_SUFFIX = r"_p?\d+\w*$"


def _full(pattern: str) -> str:
    # rlike / regexp_extract search; anchor both ends (\z: no trailing newline).
    return "^(?:" + pattern + r")\z"


def fold_partition_name(name: Column | str) -> Column:
    """struct<base string, rule string>: the first full-match rule gives the
    logical base name and the rule label; no match keeps the name (rule null)."""
    c = F.col(name) if isinstance(name, str) else name
    base = c
    rule = F.lit(None).cast("string")
    for pattern, label in reversed(PARTITION_NAME_RULES):
        full = _full(pattern)
        hit = c.rlike(full)
        base = F.when(hit, F.regexp_extract(c, full, 1)).otherwise(base)
        rule = F.when(hit, F.lit(label)).otherwise(rule)
    return F.struct(base.alias("base"), rule.alias("rule"))


def strip_partition_suffix(name: Column | str) -> Column:
    """Short fold: drop a trailing ``_<digits>...`` suffix (``_p`` optional)."""
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_replace(c, "(?U)" + PARTITION_SUFFIX, "")


def table_name_of(topic: Column | str) -> Column:
    """Topic name to table name: ``.`` and ``-`` become ``_``."""
    c = F.col(topic) if isinstance(topic, str) else topic
    return F.regexp_replace(c, r"[.\-]", "_")

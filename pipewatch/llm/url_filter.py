"""URL filter: rules on host suffixes and path prefixes.

Each URL is expanded into the expressions (host suffix + path prefix) a rule
could be written as.  Expressions meet rules on a short prefix of their
SHA-256 digest; the full digests confirm, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipewatch.llm.common import lower_ascii

#: Hex digits of the digest that the join uses.
PREFIX_DIGITS = 8
#: Up to so many rules the join may broadcast them (counted first).
BROADCAST_RULES = 50_000


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or a text without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def compile_rules(rules: DataFrame) -> DataFrame:
    """``rules`` has ``rule`` (host and path written together, as
    ``example.net/en/``) and ``verdict``.  The host goes up to the first ``/``;
    a rule without one fits any path.  Null or hostless rules are refused by
    dropping nothing silently: they raise at run time.  Of rules that repeat,
    the smallest verdict by name stays."""
    host = lower_ascii(F.regexp_extract("rule", r"(?s)^([^/]*)", 1))
    path = F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1)
    valid = F.when(
        F.col("rule").isNull() | F.col("verdict").isNull() | (host == ""),
        F.raise_error(F.concat(F.lit("url rule without host or verdict: "), F.coalesce("rule", F.lit("null")))),
    ).otherwise(F.col("rule"))
    out = rules.select(valid.alias("rule"), host.alias("rule_host"), path.alias("rule_path"), "verdict")
    out = out.groupBy("rule_host", "rule_path").agg(F.min("rule").alias("rule"), F.min("verdict").alias("verdict"))
    digest = F.sha2(F.concat("rule_host", "rule_path"), 256)
    return out.select(
        "rule",
        "verdict",
        (F.length("rule_host") + F.length("rule_path")).alias("rule_length"),
        F.size(F.split("rule_host", r"\.")).alias("labels"),
        F.length("rule_path").alias("path_length"),
        digest.alias("rule_digest"),
        F.substring(digest, 1, PREFIX_DIGITS).alias("rule_prefix"),
    )


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``urls``.

    A rule fits its host and all subdomains if the path starts with the
    rule's path.  Of the rules that fit the longest wins (host and path
    together, then the smaller text); with none, ``rule`` is null and
    ``verdict`` is ``default``.  A null or odd URL has an empty host and fits
    no rule.  Rows that repeat are judged one by one; an empty rule list lets
    all pass; existing columns of the four names are replaced.

    Expressions are limited to label counts and path lengths that occur in
    the rules: the shapes are read from the rules themselves, so none is
    missed, and a very long URL costs no more expressions than there are shapes.
    """
    spark = urls.sparkSession
    compiled = compile_rules(rules)
    shapes = compiled.agg(F.collect_set("labels").alias("l"), F.collect_set("path_length").alias("p"), F.count("*").alias("n")).first()
    keep = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict", "_url_row")]
    base = urls.withColumn("host", host_of(F.col(f"`{url}`"))).withColumn("path", path_of(F.col(f"`{url}`"))).select(*[f"`{c}`" for c in keep], "host", "path")
    if shapes["n"] == 0:
        return base.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    side = F.broadcast(compiled) if shapes["n"] <= BROADCAST_RULES else compiled

    def with_labels(n: int) -> Column:
        """The last ``n`` labels of the host, or null if it has fewer."""
        return F.when(F.size(F.split("host", r"\.")) >= n, F.substring_index("host", ".", -n))

    hosts = F.array_compact(F.array(*[with_labels(n) for n in sorted(shapes["l"])]))
    paths = F.array_compact(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(shapes["p"])]))
    expressions = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.sha2(F.concat(h, p), 256))))
    # Judge each distinct (host, path) once: a crawl names hosts and pages again and again.
    distinct = base.where("host != ''").select("host", "path").distinct()
    asked = distinct.withColumn("_digest", F.explode(expressions)).withColumn("_prefix", F.substring("_digest", 1, PREFIX_DIGITS))
    met = asked.join(side, (F.col("_prefix") == F.col("rule_prefix")) & (F.col("_digest") == F.col("rule_digest")))
    best = F.min_by(F.struct("rule", "verdict"), F.struct((-F.col("rule_length")).alias("n"), F.col("rule")))
    judged = met.groupBy("host", "path").agg(best.alias("_best"))
    found = base.alias("base").join(judged.alias("judged"), ["host", "path"], "left")
    return found.select(
        *[f"base.`{c}`" for c in keep],
        "host",
        "path",
        F.col("judged._best.rule").alias("rule"),
        F.coalesce(F.col("judged._best.verdict"), F.lit(default)).alias("verdict"),
    )

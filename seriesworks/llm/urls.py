"""URL filters by hashed expressions.

A rule is a host and a path prefix.  Each URL is expanded into the expressions that
could be rules for it: a suffix of its host, as many labels long as some rule's host,
joined with a prefix of its path, as long as some rule's path.  Expressions meet the
rules in an equi-join on the first eight hex digits of their SHA-256; the full digest
is compared afterwards, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import lower_ascii

#: Hex digits of the digest in the join key.
SHORT = 8
DEFAULT_VERDICT = "allow"


def host_of(url: Column) -> Column:
    """Host after the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without one."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """Path after the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digests(rules: DataFrame) -> DataFrame:
    """One row per rule (host, path, verdict) with its digest; of equal rules the block stays.

    Hosts are lower-cased.  Rules with a null part are left out.
    """
    return (
        rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict")
        .dropna()
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("rule_verdict"))  # "block" sorts after "allow"
        .select(
            F.concat("host", "path").alias("rule"),
            "rule_verdict",
            F.size(F.split("host", r"\.")).alias("labels"),
            F.length("path").alias("path_length"),
            F.sha2(F.concat("host", "path"), 256).alias("rule_digest"),
        )
        .withColumn("short", F.left("rule_digest", F.lit(SHORT)))
    )


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's path.
    The rule with the longest text wins; at equal length the later in code point order,
    which only matters for rules that fit no common URL.  Distinct URLs are judged once,
    so copies cost nothing; null URLs and URLs without ``://`` get the default verdict.
    Columns of ``pages`` that have the names of the results are replaced.
    """
    hashed = digests(rules)
    # the lengths that occur are bounded by the longest host and path of a rule
    lengths = hashed.agg(
        F.sort_array(F.collect_set("labels")).alias("labels"), F.sort_array(F.collect_set("path_length")).alias("paths")
    ).first()
    bare = pages.drop(*({"host", "path", "rule", "verdict"} - {url}))
    if not lengths["labels"]:
        return bare.withColumns({
            "host": host_of(F.col(url)), "path": path_of(F.col(url)),
            "rule": F.lit(None).cast("string"), "verdict": F.lit(default),
        })
    parts = F.split("host", r"\.")
    tail = lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".")
    hosts = F.array_compact(F.array(*(F.when(F.size(parts) >= n, tail(F.lit(n))) for n in lengths["labels"])))
    paths = F.array_compact(
        F.array(*(F.when(F.length("path") >= n, F.left("path", F.lit(n))) for n in lengths["paths"]))
    )
    expressions = (
        bare.select(F.col(url).alias("url"))
        .distinct()
        .select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .filter("host <> ''")
        .select("url", "path", F.explode(hosts).alias("suffix"))
        .select("url", "suffix", F.explode(paths).alias("prefix"))
        .select("url", F.sha2(F.concat("suffix", "prefix"), 256).alias("digest"))
        .withColumn("short", F.left("digest", F.lit(SHORT)))
    )
    found = (
        expressions.join(hashed, "short")
        .filter("digest = rule_digest")
        .groupBy("url")
        .agg(F.max(F.struct(F.length("rule").alias("length"), "rule", "rule_verdict")).alias("best"))
        .select(F.col("url").alias("__sw_url"), F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("__sw_verdict"))
    )
    return (
        bare.join(found, bare[url] == found["__sw_url"], "left")
        .drop("__sw_url")
        .withColumn("host", host_of(F.col(url)))
        .withColumn("path", path_of(F.col(url)))
        .withColumn("verdict", F.coalesce("__sw_verdict", F.lit(default)))
        .drop("__sw_verdict")
    )

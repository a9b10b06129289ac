"""Operator 2: URL filter by host suffixes and path prefixes.

The distinct pairs of host and path head (as much of the path as the longest rule has) are expanded into
all combinations of host suffix and path prefix that a rule could have. Expressions and rules are joined by
equality on the first 32 bits of their SHA-256 digests, then the whole digests are compared. The most
specific rule wins: longest host, then longest path; of equal rules that disagree, ``block``. The judged
pairs are joined back to the rows.

How far to expand follows from the rules alone (their path lengths and most host labels), so a very long
host or path costs no more than a short one. Pairs are made distinct before they are expanded, with partial
aggregation in the maps, so a host with a third of all pages is expanded once for each path head; the join
back is one that Spark splits where a pair is hot.

Results for odd inputs: a null url or one without ``://`` has an empty host and path and no rule (unless a
rule names the empty host); an empty table gives an empty table; repeated rows give repeated results;
without rules every row has the default verdict; columns called like the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.llm.common import ascii_lower, without

SHORT = 8  # hexadecimal digits of the digest in the join key


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substring(url, begin + 3, F.length(url))).otherwise(F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def expressions(host: Column, head: Column, labels: int, lengths: list[int]) -> Column:
    """All host suffixes of at most ``labels`` labels with all prefixes of ``head`` of these lengths."""
    parts = F.split(host, r"\.")
    # substring_index counts from the right, so the whole host needs no case of its own
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
                           lambda i: F.array_join(F.slice(parts, F.size(parts) - i + 1, i), "."))
    prefixes = F.filter(F.array(*[F.when(F.length(head) >= n, F.substring(head, 1, n)) for n in lengths]),
                        lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict. ``rules``: host, path, verdict (allow or block)."""
    rules = (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
             .select(ascii_lower(F.col("host")).alias("host"), "path", "verdict"))
    # two numbers' worth of facts about the rules: at most as many lengths as the longest path has characters
    shape = rules.agg(F.sort_array(F.collect_set(F.length("path"))).alias("lengths"),
                      F.max(F.size(F.split("host", r"\."))).alias("labels")).first()
    host, path = url_parts(F.col(url))
    rows = without(pages, "host", "path", "rule", "verdict", "__head").withColumn("host", host).withColumn("path", path)
    if not shape["lengths"]:
        return rows.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    rows = rows.withColumn("__head", F.substring("path", 1, max(shape["lengths"])))
    pairs = rows.select("host", "__head").distinct()
    asked = pairs.select("host", "__head", F.explode(expressions(
        F.col("host"), F.col("__head"), shape["labels"], shape["lengths"])).alias("expression"))
    asked = asked.select("host", "__head", F.sha2("expression", 256).alias("asked"))
    known = rules.select(
        F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_length"),
        F.length("path").alias("path_length"), F.sha2(F.concat("host", "path"), 256).alias("digest"))
    hits = (asked.withColumn("short", F.substring("asked", 1, SHORT))
            .join(known.withColumn("short", F.substring("digest", 1, SHORT)), "short")
            .where(F.col("asked") == F.col("digest")))
    best = hits.groupBy("host", "__head").agg(F.max_by(
        F.struct("rule", "verdict"), F.struct("host_length", "path_length", "verdict")).alias("best"))
    return (rows.join(best, ["host", "__head"], "left")
            .select(*[F.col(f"`{c}`") for c in rows.columns if c != "__head"],
                    F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))

"""URL filter: hashed host-suffix and path-prefix expressions against a rule list.

Every URL becomes the expressions ``host suffix + path prefix`` that a rule could have.  The
short prefix of each expression's digest is equi-joined with the rules' prefixes, the full
digest confirms, and the longest confirmed rule decides.  The join is left to Spark's size
statistics: a short rule list is broadcast under ``autoBroadcastJoinThreshold``, a long
one is shuffled and a hot prefix split by the adaptive skew join.

Defined results
  null URL, or one without ``://``: host and path empty, no rule, the default verdict;
  repeated rows: each is returned; null page_id: kept as null;
  rules that tie in length: the longer host first, then ``block`` over ``allow``, then the
  larger text; a null part of a rule counts as empty; no rules: all get the default verdict;
  other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of a digest that the equi-join uses (4 bytes).
PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return F.when(F.instr(url, "://") > 0, host).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, path).otherwise(F.lit(""))


def host_suffixes(host: Column, label_counts: list[int]) -> Column:
    """The last labels of the host, as many as each of ``label_counts`` says: a host with very
    many labels gives no more suffixes than rules can have."""
    labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    each = [F.when(labels >= n, F.substring_index(host, ".", -n)) for n in label_counts]
    return F.array_compact(F.array(*each).cast("array<string>"))


def judge_urls(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """Rows (key, host, path, rule, verdict) for ``pages``; ``rules`` has host, path, verdict."""
    rules = rules.select(
        F.coalesce(F.col("host"), F.lit("")).alias("rule_host"),
        F.coalesce(F.col("path"), F.lit("")).alias("rule_path"),
        F.coalesce(F.col("verdict"), F.lit(default)).alias("rule_verdict"),
    )
    # the lengths a rule's path can have: at most as many numbers as a URL has characters
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())
    labels = F.size(F.split("rule_host", "\\."))
    label_counts = sorted(r[0] for r in rules.select(labels).distinct().collect())  # no more than a host has labels
    rules = rules.withColumn("rule", F.concat("rule_host", "rule_path")).select(
        F.sha2("rule", 256).alias("rule_digest"),
        F.struct(
            F.length("rule").alias("length"),
            F.length("rule_host").alias("host_length"),
            (F.col("rule_verdict") == "block").alias("blocks"),
            "rule",
            F.col("rule_verdict").alias("verdict"),
        ).alias("found"),
    ).withColumn("rule_prefix", F.substring("rule_digest", 1, PREFIX_DIGITS))

    urls = (
        pages.groupBy(F.col(key).alias("page"), F.col(url).alias("url")).agg(F.count("*").alias("copies"))
        .withColumn("host", url_host(F.coalesce("url", F.lit(""))))
        .withColumn("path", url_path(F.coalesce("url", F.lit(""))))
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    expressions = (
        urls.withColumn("suffix", F.explode_outer(host_suffixes(F.col("host"), label_counts)))
        .withColumn("prefix", F.explode_outer(F.transform(fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))))
        .withColumn("digest", F.sha2(F.concat("suffix", "prefix"), 256))
        .withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
    )
    confirmed = (F.col("short") == F.col("rule_prefix")) & (F.col("digest") == F.col("rule_digest"))
    return (
        expressions.join(rules, confirmed, "left")
        .groupBy("page", "url", "copies", "host", "path").agg(F.max("found").alias("found"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            F.col("page").alias(key), "host", "path",
            F.col("found.rule").alias("rule"),
            F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
        )
    )

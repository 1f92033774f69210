"""Allow or block URLs: host and path rules, then boosted trees on lexical features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .common import UPPER, quota, stored

TRAIN_ROWS = 50_000  # most labelled URLs that the trees are fitted on
TREES, DEPTH = 12, 4
COUNTED = "abcdefghijklmnopqrstuvwxyz0123456789-._~/?#=&%+:"  # characters of the entropy
SEED = 7


def host(url: Column) -> Column:
    """Behind the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, UPPER.lower()), F.lit(""))


def path(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(rules: Sequence[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. ``rules`` is a list of
    configuration: (verdict, host, path). A rule fits its host and all subdomains when the
    path starts with its own. Equal lengths: the first in alphabetical order."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Numbers of one URL: lengths, depth, digit ratio, entropy, parameters, separators.

    The entropy is that of the characters in COUNTED, all others counting as one."""
    low = F.lower(url)
    size = F.greatest(F.length(url), F.lit(1)).cast("double")

    def count(text: Column, char: Column | str) -> Column:
        char = F.lit(char) if isinstance(char, str) else char
        return (F.length(text) - F.length(F.replace(text, char, F.lit("")))).cast("double")

    def bits(c: Column) -> Column:
        return F.when(c > 0, c * F.log2(c)).otherwise(F.lit(0.0))

    # Of the counted characters: their number and the sum of n * log2(n).
    sums = F.aggregate(
        F.split(F.lit(COUNTED), ""),
        F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("s")),
        lambda at, c: F.struct((at["n"] + count(low, c)).alias("n"), (at["s"] + bits(count(low, c))).alias("s")),
        lambda at: F.log2(size) - (at["s"] + bits(F.length(low) - at["n"])) / size)
    digits = F.length(url) - F.length(F.translate(url, "0123456789", ""))
    return {
        "length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": count(path, "/"),
        "labels": count(host, "."),
        "hyphens": count(host, "-"),
        "digit_ratio": digits / size,
        "entropy": sums,
        "parameters": F.when(url.contains("?"), 1.0 + count(url, "&")).otherwise(F.lit(0.0)),
        "fragment": url.contains("#").cast("double"),
        "secure": low.startswith("https").cast("double"),
    }


def suffix(host: Column) -> Column:
    """Last label of a host."""
    return F.element_at(F.split(host, r"\."), -1)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], id: str = "page_id", url: str = "url",
          train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score.

    A URL that a rule fits gets the rule's verdict; those URLs are also the labelled ones
    that gradient-boosted trees are trained on, on lexical features and on statistics of
    the host's suffix (how many labelled URLs have it and how many of them are blocked,
    counted over all labelled URLs, smoothed). The trees judge the rest: ``block`` if their
    probability ``score`` (null for ruled URLs) is 0.5 or more.

    At most about ``train_rows`` labelled URLs, chosen by a hash of the URL, fit the trees;
    both classes have the same quota, so a rare one keeps all its URLs.
    With labels of one class only, the rest gets that class; without labels, ``allow``.
    A null URL, or one without ``://``, has empty host and path, so no rule fits it; the
    trees judge it by what features remain. Repeated rows are judged each. Very long URLs
    are read whole; every feature is linear in their length.
    """
    u = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id}`").alias("page_id"), u.alias("_url"))
    rows = rows.select("page_id", "_url", host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path"))
    rule, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    ruled = rows.withColumn("rule", rule).withColumn("_said", verdict).withColumn("_suffix", suffix(F.col("host")))

    labelled = ruled.where("_said is not null")
    ends = labelled.groupBy("_suffix").agg(
        F.count(F.lit(1)).alias("_n"), F.sum((F.col("_said") == "block").cast("long")).alias("_b"))
    total = ends.agg(F.sum("_n"), F.sum("_b")).first()
    n, blocked = total[0] or 0, total[1] or 0
    if not 0 < blocked < n:
        only = "block" if n and blocked == n else "allow"
        return ruled.select("page_id", "host", "path", "rule", F.coalesce("_said", F.lit(only)).alias("verdict"),
                            F.lit(None).cast("double").alias("score"))

    rate = blocked / n
    stats = ends.select(
        F.col("_suffix").alias("_end"), F.log1p(F.col("_n").cast("double")).alias("suffix_count"),
        ((F.col("_b") + rate) / (F.col("_n") + 1)).alias("suffix_blocked"))
    features = lexical(F.col("_url"), F.col("host"), F.col("path"))
    full = (
        ruled.select("page_id", "host", "path", "rule", "_said", "_suffix", F.xxhash64("_url").alias("_hash"),
                     *[c.alias(k) for k, c in features.items()])
        .join(stats, F.col("_suffix") == F.col("_end"), "left").drop("_end", "_suffix")
        .fillna({"suffix_count": 0.0, "suffix_blocked": rate})
    )
    inputs = [*features, "suffix_count", "suffix_blocked"]
    vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(stored(full, "urls"))
    most = quota([n - blocked, blocked], train_rows)
    share = F.when(F.col("_said") == "block", min(1.0, most / blocked)).otherwise(min(1.0, most / (n - blocked)))
    part = F.pmod("_hash", F.lit(1 << 30)) <= share * (1 << 30)
    sample = vectors.where(F.col("_said").isNotNull() & part).select(
        "features", (F.col("_said") == "block").cast("double").alias("label"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(sample)
    scored = trees.transform(vectors.drop("label"))
    p = vector_to_array(F.col("probability"))[1]
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("_said", F.when(p >= 0.5, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("_said").isNull(), p).alias("score"))

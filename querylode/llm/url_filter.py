"""URL verdicts: host and path rules first, gradient-boosted trees over lexical features for the rest.

Features and scores are Spark expressions and Spark ML; rates of suffixes and domains count all labelled urls, the trees are fitted on
a bounded sample of the distinct ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from querylode import lineage, sizing
from querylode.llm import common

#: Labelled urls the trees are fitted on, at most.
FIT_ROWS = 20_000
LEXICAL = (
    "url_chars", "host_chars", "path_chars", "host_labels", "path_depth", "digit_ratio", "host_digits", "dash_count", "entropy",
    "n_params", "query_chars", "has_fragment", "suffix_rate", "suffix_rows", "domain_rate",
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one and for null."""
    return F.coalesce(common.ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_column(rules: Sequence[tuple[str, str]], host: Column, path: Column, value: int) -> Column:
    """``rules`` are (verdict, ``host/path``); the longest that fits gives its verdict (value 0) or its text (value 1)."""
    found = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.lit((verdict, rule)[value])).otherwise(found)
    return found


def entropy(text: Column) -> Column:
    """Bits per character."""

    def total(chars: Column) -> Column:
        share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / F.length(text)
        return F.aggregate(chars, F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))

    return F.when(F.length(text) == 0, 0.0).otherwise(common.let(F.array_distinct(F.split(text, "")), total))


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the features that need the url alone, and the last one and two host labels as ``suffix`` and ``domain``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    return urls.withColumns({
        "suffix": F.substring_index("host", ".", -1), "domain": F.substring_index("host", ".", -2),
        "url_chars": F.length(url).cast("double"), "host_chars": F.length("host").cast("double"),
        "path_chars": F.length("path").cast("double"), "host_labels": count(F.col("host"), r"\.") + 1,
        "path_depth": count(F.col("path"), r"/[^/]"),
        "digit_ratio": count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)), "host_digits": count(F.col("host"), "[0-9]"),
        "dash_count": count(F.col("host"), "-"), "entropy": entropy(url),
        "n_params": count(query, "[^&]+"), "query_chars": F.length(query).cast("double"),
        "has_fragment": url.contains("#").cast("double"),
    })


def _rates(counted: DataFrame, key: str, name: str) -> DataFrame:
    """Smoothed share of blocked urls per key, and how many urls have it, from ``counted`` (key, bad, n)."""
    bad, n = F.sum("bad"), F.sum("n")
    return counted.groupBy(key).agg(((bad + 1) / (n + 2)).alias(f"{name}_rate"), n.cast("double").alias(f"{name}_rows"))


def fit(labelled: DataFrame, rows: int = FIT_ROWS, trees: int = 20, depth: int = 4):
    """A scorer from (url, host, path, label 0/1): a function that adds ``score``, the likelihood of label 1.

    The trees take the ``rows`` distinct urls of smallest hash, each with its more frequent label (1 where both are as frequent); the
    rates per suffix and domain take every row. With labels of one kind only (or none) every url scores that kind (or 0).
    """
    usable = labelled.where("url is not null and label is not null").select("url", "host", "path", F.col("label").cast("double"))
    once = usable.groupBy("url", "host", "path").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
    sample = lineage.stored(lexical(once.orderBy(F.xxhash64("url"), "url").limit(rows)).coalesce(2), "url-sample")
    kinds = [r[0] for r in sample.select("label").distinct().limit(2).collect()]
    if len(kinds) < 2:
        return lambda urls: urls.withColumn("score", F.lit(float(kinds[0]) if kinds else 0.0))
    counted = usable.groupBy(F.substring_index("host", ".", -2).alias("domain")).agg(F.sum("label").alias("bad"), F.count("*").alias("n"))
    counted = lineage.stored(counted, "url-domains")
    by_suffix = counted.withColumn("suffix", F.substring_index("domain", ".", -1))
    suffixes = sizing.small_side(lineage.stored(_rates(by_suffix, "suffix", "suffix"), "url-suffix-rates"))
    domains = sizing.small_side(lineage.stored(_rates(counted, "domain", "domain").drop("domain_rows"), "url-domain-rates"))

    def features(urls: DataFrame) -> DataFrame:
        joined = urls.join(suffixes, "suffix", "left").join(domains, "domain", "left")
        joined = joined.fillna({"suffix_rate": 0.5, "suffix_rows": 0.0, "domain_rate": 0.5})
        return VectorAssembler(inputCols=list(LEXICAL), outputCol="features").transform(joined)

    model: GBTClassificationModel = GBTClassifier(
        maxIter=trees, maxDepth=depth, seed=7, featuresCol="features", labelCol="label", cacheNodeIds=True,
    ).fit(features(sample).select("features", "label").coalesce(2))

    def score(urls: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        scored = model.setProbabilityCol("_p").transform(features(lexical(urls)))
        return scored.withColumn("score", vector_to_array("_p")[1]).select(*urls.columns, "score")

    return score


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block) and score for every row of ``pages`` (page_id, url).

    ``labelled`` has url and label (1: block); without it the urls that a rule judges teach the trees. Null urls and urls without
    ``://`` have an empty host and path, fit no rule, and are scored like any other. Other columns are ignored.
    """
    parts = {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}
    rows = pages.select("page_id", "url").withColumns(parts)
    host, path = F.col("host"), F.col("path")
    rows = rows.withColumns({"rule": rule_column(rules, host, path, 1), "ruled": rule_column(rules, host, path, 0)})
    if labelled is None:
        seen = rows.where("ruled is not null").withColumn("label", (F.col("ruled") == "block").cast("int"))
    else:
        seen = labelled.select("url", "label").withColumns(parts)
    scored = fit(seen)(rows)
    verdict = F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")

"""Ranking metrics per query and their macro mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

METRICS = ("hit_rate_at_k", "mrr", "precision", "recall", "f1_score")


def evaluate(queries: DataFrame, ranked: DataFrame, truth: DataFrame, key: str, item: str, k: int = 5) -> DataFrame:
    """Hit@k, reciprocal rank, precision, recall and F1 for every row of ``queries`` (its ``key`` column).

    ``ranked`` holds ``key, item, rank``, ``truth`` holds ``key, item``.  No truth gives 0 for hit, reciprocal rank
    and recall; no prediction gives 0 precision.
    """
    return _measured([ranked], queries, truth, key, item, k).drop("_run")


def _measured(runs: list[DataFrame], queries: DataFrame, truth: DataFrame, key: str, item: str, k: int) -> DataFrame:
    """``key, _run`` and the metrics: the rows of all runs, the truth and the queries meet in one row per key, packed by each task before they
    are dealt, so that neither pairs of key and item nor the truth travel once per run."""
    asked, right = -1, -2
    rows = queries.select(key).distinct().withColumn("_run", F.lit(asked))
    for run, df in ((right, truth), *enumerate(runs)):
        kept = [c for c in (key, item, "rank") if c in df.columns and (run >= 0 or c != "rank")]
        rows = rows.unionByName(df.filter(F.col(key).isNotNull()).select(*kept, F.lit(run).alias("_run")), allowMissingColumns=True)
    met = rows.groupBy(key).agg(F.collect_list(F.struct("_run", F.col(item).alias("item"), "rank")).alias("_all"))
    met = met.filter(F.exists("_all", lambda x: x["_run"] == asked))
    met = met.withColumn("_truth", F.array_distinct(F.transform(F.filter("_all", lambda x: x["_run"] == right), lambda x: x["item"])))
    met = met.withColumn("_all", F.transform(F.filter("_all", lambda x: x["_run"] >= 0), lambda x: F.struct(
        x["_run"].alias("run"), x["rank"].alias("rank"), F.coalesce(F.array_contains("_truth", x["item"]), F.lit(False)).alias("right"))))

    def counted(run: int):
        own = F.filter("_all", lambda x: x["run"] == run)
        hits = F.filter("_all", lambda x: (x["run"] == run) & x["right"])
        return F.struct(F.lit(run).alias("_run"), F.size(own).alias("predicted"), F.size(hits).alias("correct"), F.array_min(F.transform(hits, lambda x: x["rank"])).alias("first"))

    rows = met.select(key, F.size("_truth").alias("wanted"), F.inline(F.array(*map(counted, range(len(runs))))))

    def share(n, d):
        return F.when(F.col(d) > 0, F.col(n) / F.col(d)).otherwise(0.0)

    rows = rows.select(
        key, "_run", F.when(F.col("first") <= k, 1.0).otherwise(0.0).alias("hit_rate_at_k"),
        F.coalesce(1 / F.col("first"), F.lit(0.0)).alias("mrr"),
        share("correct", "predicted").alias("precision"), share("correct", "wanted").alias("recall"))
    both = F.col("precision") + F.col("recall")
    return rows.withColumn("f1_score", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0))


def macro_mean(metrics: DataFrame, by: str | None = None) -> DataFrame:
    return metrics.groupBy(*([by] if by else [])).agg(*[F.avg(m).alias(m) for m in METRICS], F.count("*").alias("queries"))


def sweep(runs: dict[str, DataFrame], queries: DataFrame, truth: DataFrame, key: str, item: str, k: int = 5) -> DataFrame:
    """Macro means of several ranked runs side by side: ``config`` plus the metrics."""
    scored = _measured(list(runs.values()), queries, truth, key, item, k)
    names = F.array(*map(F.lit, runs))
    return macro_mean(scored.withColumn("config", F.get(names, F.col("_run"))), "config")

"""Column statistics and execution profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from querylode.lineage import stored
from querylode.operators.ordering import quantiles, running_total, top_k

_NUMBERS = (T.NumericType,)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def columns_of(df: DataFrame, kinds: tuple) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def value_counts(df: DataFrame, columns: list[str], cast: str) -> DataFrame:
    """``column_name, value, n`` over the given columns, nulls included; counted before the shuffle."""
    long = df.select(*[F.col(c).cast(cast).alias(c) for c in columns]).unpivot([], columns, "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def sample_values(df: DataFrame, k: int = 5, columns: list[str] | None = None) -> DataFrame:
    """The k smallest distinct values of each text column: ``column_name, sample_values``."""
    columns = columns or columns_of(df, (T.StringType,))
    values = value_counts(df, columns, "string").filter("value IS NOT NULL")
    return _collect_samples(values, k)


def _collect_samples(counts: DataFrame, k: int) -> DataFrame:
    head = top_k(counts, ["column_name"], [F.asc("value")], k)
    return head.groupBy("column_name").agg(F.array_sort(F.collect_list("value")).alias("sample_values"))


def _common(counts: DataFrame) -> list:
    total, nulls = F.sum("n"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0))
    return [total.alias("row_count"), (nulls / total).alias("null_rate"), F.count("value").alias("distinct_count")]


def exact_statistics(df: DataFrame, samples: int = 5) -> DataFrame:
    """Statistics of every numeric, text and time column, exact.

    Everything derives from (column, value) counts: one partially aggregated shuffle, then small aggregates; the
    median comes from running totals instead of a per-column sort.
    """
    parts = []
    if numbers := columns_of(df, _NUMBERS):
        counts = stored(value_counts(df, numbers, "double"), "values")
        # Sums of (value * count) as decimals do not depend on the order of addition.
        exact = F.sum((F.col("value").cast("decimal(24,6)") * F.col("n").cast("decimal(12,0)")))
        base = counts.groupBy("column_name").agg(
            *_common(counts), F.min("value").alias("min_number"), F.max("value").alias("max_number"),
            (exact.cast("double") / F.sum(F.when(F.col("value").isNotNull(), F.col("n")))).alias("avg_number"))
        middle = quantiles(counts, ["column_name"], "value", 0.5, "median", count="n")
        middle = middle.select("column_name", ((F.col("median_low") + F.col("median_high")) / 2).alias("median_number"))
        parts.append(base.join(middle, "column_name", "left").withColumn("kind", F.lit("number")))
    if texts := columns_of(df, (T.StringType,)):
        counts = value_counts(df, texts, "string")
        base = counts.groupBy("column_name").agg(*_common(counts))
        found = _collect_samples(counts.filter("value IS NOT NULL"), samples)
        parts.append(base.join(found, "column_name", "left").withColumn("kind", F.lit("text")))
    if times := columns_of(df, _TIMES):
        counts = value_counts(df, times, "timestamp_ntz")
        base = counts.groupBy("column_name").agg(
            *_common(counts), F.date_format(F.min("value"), TIME_FORMAT).alias("min_time"),
            F.date_format(F.max("value"), TIME_FORMAT).alias("max_time"))
        parts.append(base.withColumn("kind", F.lit("time")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def quick_statistics(df: DataFrame) -> DataFrame:
    """One-pass sketch variant for very wide scans: approximate distinct count and median, no shuffle of values."""
    numbers, texts, times = columns_of(df, _NUMBERS), columns_of(df, (T.StringType,)), columns_of(df, _TIMES)

    def row(c: str) -> Column:
        null = F.lit(None)
        col = F.col(c)
        is_number, is_time = c in numbers, c in times
        return F.struct(
            F.lit(c).alias("column_name"),
            F.lit("number" if is_number else "time" if is_time else "text").alias("kind"),
            F.count(F.lit(1)).alias("row_count"), (F.count_if(col.isNull()) / F.count(F.lit(1))).alias("null_rate"),
            F.approx_count_distinct(col).alias("distinct_count"),
            (F.min(col) if is_number else null).cast("double").alias("min_number"),
            (F.max(col) if is_number else null).cast("double").alias("max_number"),
            (F.avg(col) if is_number else null).cast("double").alias("avg_number"),
            (F.percentile_approx(col, 0.5) if is_number else null).cast("double").alias("median_number"),
            (F.date_format(F.min(col), TIME_FORMAT) if is_time else null.cast("string")).alias("min_time"),
            (F.date_format(F.max(col), TIME_FORMAT) if is_time else null.cast("string")).alias("max_time"))

    return df.agg(F.array(*[row(c) for c in numbers + texts + times]).alias("s")).select(F.inline("s"))


def execution_profile(logs: DataFrame, key: str = "template_id") -> DataFrame:
    """Per template: average result size and time, 95th percentile time, last execution, errors.

    ``exec_time`` is integral; the percentile is the smallest time that at least 95 % of executions do not exceed,
    taken from time counts so that a hot template is never gathered in one task.
    """
    base = logs.groupBy(key).agg(
        F.count("*").alias("runs"), F.sum("exec_count").alias("exec_count"), F.avg("result_rows").alias("rows_avg"),
        F.avg("exec_time").alias("exec_time_avg"), F.max("collected_at").alias("last_executed_at"),
        F.sum("error_count").alias("error_count"),
        F.max(F.when(F.col("error_count") > 0, F.col("collected_at"))).alias("last_error_at"))
    counts = logs.groupBy(key, "exec_time").agg(F.count("*").alias("n"))
    return base.join(percentile_disc(counts, [key], "exec_time", 0.95, "exec_time_p95"), key)


def percentile_disc(counts: DataFrame, by: list[str], value: str, share: float, out: str) -> DataFrame:
    """Smallest value whose cumulative share reaches ``share``, from (by, value, n) counts."""
    counts = stored(counts, "counts")
    totals = counts.groupBy(*by).agg(F.sum("n").alias("_all"))
    upto = running_total(counts, by, value, F.col("n"), "_upto").join(totals, by)
    return upto.filter(F.col("_upto") >= F.ceil(F.col("_all") * share)).groupBy(*by).agg(F.min(value).alias(out))

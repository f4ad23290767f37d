"""Logs to templates: filter, rank, mask, extract, describe, and the run report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from querylode.functions import sqltext as S
from querylode.operators import filters, ordering
from querylode.sizing import salted_join


def normalized(logs: DataFrame, strict: bool = False) -> DataFrame:
    """Per log: masked text, template id, tables, columns and the row error (null when fine)."""
    c = F.col("sql_text")
    out = logs.withColumn("template_text", S.mask_literals(c, strict)).withColumn("_cols", S.select_columns(c))
    return (out.withColumn("template_id", S.template_id(F.col("template_text")))
            .withColumn("tables", S.tables(c)).withColumn("columns", F.col("_cols.columns"))
            .withColumn("error", F.col("_cols.error")).drop("_cols"))


def input_order() -> Column:
    """Order in which ranked logs reach the sinks."""
    return F.struct(-F.col("exec_count"), (~S.has_analytics(F.col("sql_text"))).cast("int"), F.col("sql_id"))


def log_templates(logs: DataFrame) -> DataFrame:
    """One template row per valid log that could be processed, as the sinks receive them."""
    rows = normalized(filters.keep_valid(logs)).filter(F.col("error").isNull())
    return rows.withColumn("input_order", input_order())


def errors(logs: DataFrame) -> DataFrame:
    """Rows that could not be processed; the others go on."""
    rows = normalized(filters.keep_valid(logs)).filter(F.col("error").isNotNull())
    return rows.select("sql_id", F.lit("processing").alias("stage"), "error")


def distinct_templates(logs: DataFrame) -> DataFrame:
    """First log of each template in input order.  Descriptions are generated after this step, once per template."""
    return ordering.first_per_key(log_templates(logs), ["template_id"], "input_order")


def template_load(logs: DataFrame, top_n: int | None = None) -> DataFrame:
    """Templates by total executions: which statements dominate the load?"""
    valid = filters.keep_valid(logs).withColumn("template_text", S.mask_literals(F.col("sql_text")))
    load = (valid.groupBy("template_text").agg(F.sum("exec_count").alias("exec_count"), F.count("*").alias("log_count"))
            .withColumn("template_id", S.template_id(F.col("template_text"))))
    ranked = load.orderBy(F.desc("exec_count"), "template_id")
    return ranked if top_n is None else ranked.limit(top_n)


def run_report(logs: DataFrame) -> DataFrame:
    """One row: collected, filtered, normalised, indexed (duplicates included), errors, success."""
    rows = logs.select(filters.valid().alias("ok"), S.select_columns(F.col("sql_text"))["error"].isNotNull().alias("bad"))
    counts = rows.agg(
        F.count("*").alias("collected_count"), F.count_if("ok").alias("filtered_count"),
        F.count_if(F.col("ok") & ~F.col("bad")).alias("normalized_count"),
        F.count_if(F.col("ok") & F.col("bad")).alias("error_count"))
    return counts.select("collected_count", "filtered_count", "normalized_count",
                         F.col("normalized_count").alias("indexed_count"), "error_count",
                         (F.col("error_count") == 0).alias("success"))


def report_text(report: dict, errors: list[dict] | None = None) -> str:
    """The run report as text, from its one row."""
    # Report labels.
    labels = (("수집된 로그", "collected_count"), ("필터링된 로그", "filtered_count"),
              ("정규화된 템플릿", "normalized_count"), ("인덱싱된 템플릿", "indexed_count"), ("에러 수", "error_count"))
    lines = ["=== 파이프라인 실행 결과 ===", *(f"{text}: {report[key]}건" for text, key in labels),
             f"성공 여부: {'성공' if report['success'] else '실패'}"]
    if errors:
        lines += ["\n=== 에러 목록 ===", *(f"  - {e.get('sql_id', 'N/A')}: {e.get('error', 'Unknown')}" for e in errors)]
    return "\n".join(lines)


def link_back(logs: DataFrame, known: DataFrame) -> DataFrame:
    """Every log with the id of its known template, null for logs the filter drops."""
    own = logs.withColumn("_id", F.when(filters.valid(), S.template_id(S.mask_literals(F.col("sql_text")))))
    known = known.select(F.col("template_id").alias("_id"), "template_id").distinct()
    return salted_join(own, known, ["_id"], F.col("sql_id"), how="left").drop("_id")

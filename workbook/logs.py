"""Log sources, filters, ranking and run reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from querylode.functions import sqltext as S
from querylode.operators import filters, usage
from querylode.plans import templates
from querylode.sources import derived, logs as log_sources
from workbook import duck as D, query

START, END = datetime(2024, 1, 3, 6, 30), datetime(2024, 1, 20, 12, 0)


@query("s1_json_log_source", D.with_(D.LOGS) + """
SELECT sql_id, sql_text, exec_count, error_count, schema_name FROM sql_logs
WHERE collected_at >= TIMESTAMP '2024-01-03 06:30:00' AND collected_at <= TIMESTAMP '2024-01-20 12:00:00'""")
def s1(spark, d):
    lines = derived.sql_logs(spark, d).select(F.to_json(F.struct("*")).alias("value"))
    logs = log_sources.collect_json_logs(log_sources.parse_json_logs(lines), START, END)
    return logs.drop("collected_at")


@query("s2_table_log_source", D.with_(D.LOGS) + """
SELECT sql_id, exec_count, error_count FROM sql_logs
WHERE collected_at >= TIMESTAMP '2024-01-03' AND collected_at <= TIMESTAMP '2024-01-20'
ORDER BY exec_count DESC, sql_id LIMIT 500""")
def s2(spark, d):
    logs = log_sources.collect_table_logs(derived.sql_logs(spark, d), START, END, limit=500)
    return logs.select("sql_id", "exec_count", "error_count")


@query("f1_failed", D.with_(D.LOGS) + "SELECT sql_id, error_count FROM sql_logs WHERE error_count = 0")
def f1(spark, d):
    return derived.sql_logs(spark, d).filter(~filters.failed()).select("sql_id", "error_count")


@query("f2_ddl", D.with_(D.LOGS) + f"SELECT sql_id, sql_text FROM sql_logs WHERE {D.is_ddl('sql_text')}")
def f2(spark, d):
    return derived.sql_logs(spark, d).filter(S.is_ddl(F.col("sql_text"))).select("sql_id", "sql_text")


@query("f3_dml", D.with_(D.LOGS) + f"SELECT sql_id, sql_text FROM sql_logs WHERE {D.is_dml('sql_text')}")
def f3(spark, d):
    return derived.sql_logs(spark, d).filter(S.is_dml(F.col("sql_text"))).select("sql_id", "sql_text")


@query("f4_system", D.with_(D.LOGS) + f"SELECT sql_id, sql_text FROM sql_logs WHERE {D.is_system('sql_text')}")
def f4(spark, d):
    return derived.sql_logs(spark, d).filter(S.is_system(F.col("sql_text"))).select("sql_id", "sql_text")


@query("f5_valid", D.with_(D.LOGS) + f"SELECT sql_id, sql_text, exec_count FROM sql_logs WHERE {D.VALID}")
def f5(spark, d):
    return filters.keep_valid(derived.sql_logs(spark, d)).select("sql_id", "sql_text", "exec_count")


@query("f6_analytics", D.with_(D.LOGS) + f"""
SELECT {D.analytics('sql_text')} AS has_analytics, CAST(count(*) AS BIGINT) AS n,
  CAST(sum(exec_count) AS BIGINT) AS exec_count FROM sql_logs GROUP BY 1""")
def f6(spark, d):
    logs = derived.sql_logs(spark, d).withColumn("has_analytics", S.has_analytics(F.col("sql_text")))
    return logs.groupBy("has_analytics").agg(F.count("*").alias("n"), F.sum("exec_count").alias("exec_count"))


_REASONS = f"""reasons AS (SELECT sql_id, list_filter([CASE WHEN error_count > 0 THEN 'error' END,
  CASE WHEN {D.is_dml('sql_text')} THEN 'DML' END, CASE WHEN {D.is_ddl('sql_text')} THEN 'DDL' END,
  CASE WHEN {D.is_system('sql_text')} THEN 'system' END], lambda x: x IS NOT NULL) AS reasons FROM sql_logs)"""


@query("f7_exclusion_audit", D.with_(D.LOGS, _REASONS) + """
SELECT sql_id, array_to_string(reasons, ',') AS reasons FROM reasons WHERE len(reasons) > 0""")
def f7(spark, d):
    return filters.audit(derived.sql_logs(spark, d)).select("sql_id", F.concat_ws(",", "reasons").alias("reasons"))


@query("f7_exclusion_counts", D.with_(D.LOGS, _REASONS) + """
SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(reasons) AS reason FROM reasons) GROUP BY reason""")
def f7_counts(spark, d):
    return filters.audit_counts(derived.sql_logs(spark, d))


@query("f8_comment_quality", """
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n,
  (o_orderpriority IS NULL OR length(trim(o_orderpriority)) < 5 OR (upper(o_orderpriority) = o_orderpriority
   AND lower(o_orderpriority) <> o_orderpriority AND length(o_orderpriority) <= 10)) AS insufficient
FROM orders GROUP BY o_orderpriority""")
def f8(spark, d):
    return filters.comment_quality(derived.table(spark, d, "orders"), "o_orderpriority")


@query("o1_log_ranking", D.with_(D.LOGS) + f"""
SELECT sql_id, exec_count, has_analytics FROM (
  SELECT sql_id, exec_count, {D.analytics('sql_text')} AS has_analytics FROM sql_logs WHERE {D.VALID})
ORDER BY exec_count DESC, has_analytics DESC, sql_id LIMIT 100""")
def o1(spark, d):
    ranked = filters.rank_logs(filters.keep_valid(derived.sql_logs(spark, d)), top_n=100)
    return ranked.select("sql_id", "exec_count", "has_analytics")


@query("a0_template_load", D.with_(D.LOGS) + f"""
SELECT md5(template_text) AS template_id, template_text, CAST(sum(exec_count) AS BIGINT) AS exec_count,
  CAST(count(*) AS BIGINT) AS log_count
FROM (SELECT {D.mask('sql_text')} AS template_text, exec_count FROM sql_logs WHERE {D.VALID}) GROUP BY template_text""")
def a0(spark, d):
    return templates.template_load(derived.sql_logs(spark, d))


@query("a1_run_report", D.with_(D.LOGS, f"ok AS (SELECT {D.columns('sql_text')} AS cols FROM sql_logs WHERE {D.VALID})") + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM sql_logs) AS collected_count, CAST(count(*) AS BIGINT) AS filtered_count,
  CAST(count(*) FILTER (NOT list_contains(cols, '')) AS BIGINT) AS normalized_count,
  CAST(count(*) FILTER (NOT list_contains(cols, '')) AS BIGINT) AS indexed_count,
  CAST(count(*) FILTER (list_contains(cols, '')) AS BIGINT) AS error_count,
  count(*) FILTER (list_contains(cols, '')) = 0 AS success FROM ok""")
def a1(spark, d):
    return templates.run_report(derived.sql_logs(spark, d))


@query("a2_table_usage", D.with_(D.LOGS) + f"""
SELECT table_name, CAST(sum(exec_count) AS BIGINT) AS weight FROM (
  SELECT unnest({D.bare_tables('sql_text')}) AS table_name, exec_count FROM sql_logs) GROUP BY table_name""")
def a2(spark, d):
    return usage.table_usage(derived.sql_logs(spark, d))


@query("a3_glossary_categories", D.with_(D.GLOSSARY) + """
SELECT category, n, term, korean_name, rank FROM (
  SELECT coalesce(category, '기타') AS category, term, korean_name,
    CAST(count(*) OVER (PARTITION BY coalesce(category, '기타')) AS BIGINT) AS n,
    CAST(row_number() OVER (PARTITION BY coalesce(category, '기타') ORDER BY pos) AS INTEGER) AS rank FROM glossary)
WHERE rank <= 3""")
def a3(spark, d):
    return usage.glossary_categories(derived.glossary(spark, d))


@query("a3_glossary_search", D.with_(D.GLOSSARY) + """
SELECT term, korean_name, description, pos FROM glossary WHERE contains(lower(term), 'ring')""")
def a3_search(spark, d):
    return usage.glossary_contains(derived.glossary(spark, d), "ring").select("term", "korean_name", "description", "pos")

"""What the sinks write, and the batch model functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from querylode.functions import sqltext as S
from querylode.operators import inference
from querylode.plans import templates
from querylode.sinks import tables as sinks
from querylode.sources import derived, glossary
from workbook import duck as D, query
from workbook.sqltext import rule_case

TEMPLATES = f"""templates AS (SELECT *, md5(template_text) AS template_id, {rule_case('template_text')} AS description,
  row_number() OVER (ORDER BY exec_count DESC, analytic DESC, sql_id) AS input_order
  FROM (SELECT sql_id, sql_text, exec_count, {D.analytics('sql_text')} AS analytic, {D.mask('sql_text')} AS template_text,
    {D.tables('sql_text')} AS tables, {D.columns('sql_text')} AS columns FROM sql_logs WHERE {D.VALID}) WHERE NOT list_contains(columns, ''))"""


def _templates(logs):
    return templates.log_templates(logs).withColumn("description", S.rule_description(F.col("template_text")))


def _out(df, *more):
    return df.select("template_id", "template_text", "description", *more)


@query("k1_vector_rows", D.with_(D.LOGS, TEMPLATES) + """
SELECT template_id, substr(template_text, 1, 4000) AS template_text, description, substr(array_to_string(tables, ','), 1, 1000) AS tables,
  substr(array_to_string(columns, ','), 1, 2000) AS columns FROM templates QUALIFY row_number() OVER (PARTITION BY template_id ORDER BY input_order) = 1""")
def k1(spark, d):
    return _out(sinks.vector_rows(_templates(derived.sql_logs(spark, d))), "tables", "columns")


@query("k2_search_upsert", D.with_(D.LOGS, TEMPLATES) + """
SELECT template_id, template_text, description, array_to_string(tables, ',') AS tables, CAST(exec_count AS INTEGER) AS exec_count
FROM templates QUALIFY row_number() OVER (PARTITION BY template_id ORDER BY input_order DESC) = 1""")
def k2(spark, d):
    rows = sinks.search_rows(_templates(derived.sql_logs(spark, d)))
    return _out(rows, F.array_join("tables", ",").alias("tables"), "exec_count")


@query("k2_search_upsert_batches", D.with_(D.LOGS, TEMPLATES) + """
SELECT template_id, CAST(exec_count AS INTEGER) AS exec_count FROM templates WHERE length(sql_id) > 0
QUALIFY row_number() OVER (PARTITION BY template_id ORDER BY sql_id >= 'EV000005000' DESC, input_order DESC) = 1""")
def k2_batches(spark, d):
    rows = _templates(derived.sql_logs(spark, d))
    first = sinks.search_rows(rows.filter("sql_id < 'EV000005000'"))
    return sinks.search_rows(rows.filter("sql_id >= 'EV000005000'"), existing=first).select("template_id", "exec_count")


@query("k4_delete_by_ids", D.with_(D.LOGS) + f"""
SELECT sql_id, exec_count FROM sql_logs WHERE sql_id NOT IN (SELECT sql_id FROM sql_logs WHERE error_count > 0)""")
def k4(spark, d):
    logs = derived.sql_logs(spark, d)
    return sinks.delete_ids(logs, "sql_id", logs.filter("error_count > 0")).select("sql_id", "exec_count")


@query("k4_delete_by_condition", D.with_(D.LOGS) + """
SELECT sql_id, exec_count FROM sql_logs WHERE NOT coalesce(schema_name = 'TPCH' AND exec_count < 50, false)""")
def k4_condition(spark, d):
    kept = sinks.delete_where(derived.sql_logs(spark, d), (F.col("schema_name") == "TPCH") & (F.col("exec_count") < 50))
    return kept.select("sql_id", "exec_count")


@query("k5_glossary_rows", D.with_(D.GLOSSARY) + """
SELECT term, korean_name, description, category FROM glossary QUALIFY row_number() OVER (PARTITION BY term ORDER BY pos DESC) = 1""")
def k5(spark, d):
    return sinks.glossary_rows(derived.glossary(spark, d), "pos")


@query("s4_glossary_terms", D.with_(D.GLOSSARY) + """
SELECT term, korean_name, description, category, '' AS missing FROM glossary WHERE category IS NOT NULL
UNION ALL SELECT term, korean_name, NULL, category, 'description' FROM glossary WHERE category IS NULL""")
def s4(spark, d):
    # Entries without a category lose their description, to show both sides of the split.
    rows = derived.glossary(spark, d).drop("pos").withColumn(
        "description", F.when(F.col("category").isNotNull(), F.col("description")))
    terms, rejects = glossary.split_terms(rows)
    return terms.withColumn("missing", F.lit("")).unionByName(rejects.withColumn("missing", F.array_join("missing", ",")))


@query("u1_batch_descriptions", D.with_(D.LOGS, TEMPLATES) + """
SELECT DISTINCT template_id, description, CAST(NULL AS VARCHAR) AS error_class, CAST(NULL AS VARCHAR) AS error FROM templates""")
def u1(spark, d):
    distinct = templates.distinct_templates(derived.sql_logs(spark, d))
    return inference.generate(distinct, "template_id", "template_text")


_HASHED = f"""cells AS (SELECT doc_id, CAST(('0x' || substr(md5(w), 1, 7)) AS BIGINT) % 256 AS slot, count(*) AS n
  FROM (SELECT doc_id, unnest({D.tokens('text')}) AS w FROM documents) GROUP BY ALL)"""


@query("u2_batch_embeddings", D.with_(_HASHED) + """
SELECT doc_id, CAST(slot AS INTEGER) AS slot, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)), 4) AS value FROM cells""")
def u2(spark, d):
    embed = inference.embed_udf(lambda: inference.HashingEmbedder(256))
    docs = derived.table(spark, d, "documents").select("doc_id", embed("text").alias("v"))
    cells = docs.select("doc_id", F.posexplode_outer("v").alias("slot", "value")).filter("value > 0")
    return cells.withColumn("value", F.round(F.col("value").cast("double"), 4))


@query("d17_embedding_cache", """
SELECT CAST(count(*) AS BIGINT) AS texts, CAST(count(*) FILTER (known) AS BIGINT) AS cached, CAST(count(*) FILTER (NOT known) AS BIGINT) AS embedded
FROM (SELECT md5(text) AS text_key, bool_or(lang <> 'en') AS known FROM documents GROUP BY 1)""")
def d17(spark, d):
    docs = derived.table(spark, d, "documents")
    small = lambda: inference.HashingEmbedder(64)
    cache = inference.embed_with_cache(docs.filter("lang <> 'en'"), "text", factory=small).drop("cached")
    rows = inference.embed_with_cache(docs, "text", cache, factory=small)
    return rows.agg(F.count("embedding").alias("texts"), F.count_if("cached").alias("cached"), F.count_if(~F.col("cached")).alias("embedded"))

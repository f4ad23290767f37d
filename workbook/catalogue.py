"""Catalogue metadata, joinability, prompts, the knowledge graph and assembled context."""

from __future__ import annotations

from pyspark.sql import functions as F

from querylode.functions import sqltext as S
from querylode.lineage import stored
from querylode.operators import context, graph, joinability, linking, profile, prompts, registry, retrieval as R, usage
from querylode.plans import templates
from querylode.sources import catalog, derived, registry_json
from workbook import duck as D, query
from workbook.linking import EDGES
from workbook.registry import _TABLES, JOIN_PATTERNS, REGISTRY
from workbook.retrieval import BM25, TFIDF, top
from workbook.sqltext import PREDICATES, rule_case

_COUNTS = "counts AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS num_rows FROM {t}" for t, _, _ in catalog.TABLE_NOTES) + ")"


def _columns(spark, d):
    return catalog.star_columns(spark, d).withColumn("description", F.coalesce("description", F.lit("")))


def _edges(spark, d):
    return joinability.edges(joinability.shared_names(catalog.star_columns(spark, d)))


@query("s3_table_metadata", D.with_(D.CATALOG, _COUNTS) + "SELECT table_name, num_rows, description AS comments FROM counts LEFT JOIN cat_tables USING (table_name)")
def s3(spark, d):
    comments = catalog.star_tables(spark).select("table_name", F.col("description").alias("comments"))
    return catalog.table_metadata(catalog.star_row_counts(spark, d), comments)


@query("s3_column_metadata", D.with_(D.CATALOG, _COUNTS) + """
SELECT k.table_name, k.column_name, true AS nullable, CAST(k.pos AS INTEGER) AS column_id, k.description AS comments, num_rows
FROM cat_columns k JOIN counts USING (table_name)""")
def s3_columns(spark, d):
    columns = _columns(spark, d)
    meta = columns.select("table_name", "column_name", F.lit("Y").alias("nullable"), F.col("pos").alias("column_id"))
    comments = columns.select("table_name", "column_name", F.col("description").alias("comments"))
    return catalog.column_metadata(meta, comments).join(catalog.star_row_counts(spark, d), "table_name")


@query("s5_registry_json", D.with_(D.LOGS, _TABLES, REGISTRY) + "SELECT table_name, schema_name, sql_count, meta_status FROM registry")
def s5(spark, d):
    rows = registry.table_registry(derived.sql_logs(spark, d)).select("table_name", "schema_name", "sql_count")
    text = rows.select(F.to_json(F.array(F.struct("*"))).alias("value"))
    return registry_json.table_registry(text).select("table_name", "schema_name", "sql_count", "meta_status")


_USAGE = f"""usage AS (SELECT table_name, CAST(sum(exec_count) AS BIGINT) AS weight FROM (
  SELECT unnest({D.bare_tables('sql_text')}) AS table_name, exec_count FROM sql_logs) GROUP BY table_name)"""


@query("j4_joinability_edges", D.with_(D.LOGS, D.CATALOG, EDGES, _USAGE) + """
SELECT table_a, table_b, array_to_string(join_columns, ',') AS join_columns, round(jaccard, 6) AS jaccard, join_type,
  CAST(coalesce(a.weight, 0) + coalesce(b.weight, 0) AS BIGINT) AS weight
FROM edges LEFT JOIN usage a ON a.table_name = table_a LEFT JOIN usage b ON b.table_name = table_b""")
def j4(spark, d):
    weights = usage.table_usage(derived.sql_logs(spark, d))
    rows = _edges(spark, d)
    for side in ("a", "b"):
        rows = rows.join(weights.select(F.col("table_name").alias(f"table_{side}"), F.col("weight").alias(f"w_{side}")), f"table_{side}", "left")
    total = F.coalesce("w_a", F.lit(0)) + F.coalesce("w_b", F.lit(0))
    return rows.select("table_a", "table_b", F.array_join("join_columns", ",").alias("join_columns"),
                       F.round("jaccard", 6).alias("jaccard"), "join_type", total.cast("long").alias("weight"))


@query("j5_joinable_neighbours", D.with_(D.LOGS, D.CATALOG, EDGES, _USAGE) + """
SELECT table_name, other, round(score, 6) AS score, weight FROM around JOIN usage USING (table_name) WHERE score >= 0.35""")
def j5(spark, d):
    near = joinability.neighbours(_edges(spark, d), 0.35).join(usage.table_usage(derived.sql_logs(spark, d)), "table_name")
    return near.select("table_name", "other", F.round("score", 6).alias("score"), "weight")


@query("j6_join_paths", D.with_(D.LOGS, D.CATALOG, EDGES, _USAGE).replace("WITH", "WITH RECURSIVE", 1) + """
, walks AS (SELECT table_name AS source, table_name AS target, [table_name] AS path FROM usage WHERE table_name IN (SELECT table_name FROM cat_tables)
  UNION ALL SELECT source, other, path || [other] FROM walks JOIN around ON target = table_name WHERE NOT list_contains(path, other))
SELECT source, target, array_to_string(path, '>') AS path FROM walks
QUALIFY row_number() OVER (PARTITION BY source, target ORDER BY len(path), array_to_string(path, '>')) = 1""")
def j6(spark, d):
    used = usage.table_usage(derived.sql_logs(spark, d)).join(catalog.star_tables(spark), "table_name", "left_semi")
    return joinability.paths(_edges(spark, d), used).withColumn("path", F.array_join("path", ">"))


@query("j8_join_explanation", D.with_(D.LOGS, D.CATALOG, EDGES) + f"""
SELECT a.sql_id, a.t AS table_a, b.t AS table_b, array_to_string(join_columns, ',') AS join_columns, round(jaccard, 6) AS jaccard, join_type
FROM (SELECT sql_id, unnest({D.bare_tables('sql_text')}) AS t FROM sql_logs) a JOIN (SELECT sql_id, unnest({D.bare_tables('sql_text')}) AS t FROM sql_logs) b
  ON a.sql_id = b.sql_id AND a.t < b.t JOIN edges ON table_a = a.t AND table_b = b.t""")
def j8(spark, d):
    chosen = derived.sql_logs(spark, d).select("sql_id", F.explode(S.bare_tables(F.col("sql_text"))).alias("table_name"))
    rows = joinability.explain(_edges(spark, d), chosen, "sql_id")
    return rows.select("sql_id", "table_a", "table_b", F.array_join("join_columns", ",").alias("join_columns"),
                       F.round("jaccard", 6).alias("jaccard"), "join_type")


def _distinct(spark, d):
    rows = templates.distinct_templates(derived.sql_logs(spark, d))
    return rows.withColumn("description", S.rule_description(F.col("template_text")))


_FIRST = f"""firsts AS (SELECT * FROM (SELECT sql_id, exec_count, {D.mask('sql_text')} AS template_text, md5({D.mask('sql_text')}) AS template_id,
  {D.tables('sql_text')} AS tables, {D.columns('sql_text')} AS columns, {D.analytics('sql_text')} AS analytic FROM sql_logs WHERE {D.VALID})
  QUALIFY row_number() OVER (PARTITION BY template_id ORDER BY exec_count DESC, analytic DESC, sql_id) = 1)"""


_CONTEXTS = """contexts AS (SELECT t.table_name, chr(10) || '테이블: ' || t.table_name || ' (' || t.description || ')' || chr(10) || '컬럼:' || chr(10)
  || string_agg('  - ' || k.column_name || ': ' || k.description, chr(10) ORDER BY k.pos) AS context
  FROM cat_tables t JOIN cat_columns k USING (table_name) GROUP BY t.table_name, t.description)"""


@query("t17_sql_prompts", D.with_(D.LOGS, D.CATALOG, _FIRST, _CONTEXTS) + f"""
SELECT template_id, '{prompts.CONTEXT_TITLE}' || coalesce(chr(10) || b.blocks, '') || chr(10) || chr(10) || '{prompts.DEFAULT_PROMPT.strip()}' || chr(10) || chr(10) || template_text AS prompt
FROM firsts LEFT JOIN (SELECT template_id, string_agg(context, chr(10) ORDER BY place) AS blocks FROM (
  SELECT template_id, unnest(tables) AS table_name, generate_subscripts(tables, 1) AS place FROM firsts) JOIN contexts USING (table_name) GROUP BY template_id) b USING (template_id)""")
def t17(spark, d):
    blocks = prompts.table_context(catalog.star_tables(spark), _columns(spark, d))
    return prompts.prompts_with_context(_distinct(spark, d), blocks)


def _statements(spark, d):
    """Distinct statements of each table, most executed first."""
    groups = registry.statement_groups(derived.sql_logs(spark, d)).groupBy("statement").agg(F.sum("exec_count").alias("exec_count"))
    rows = groups.select(F.explode(F.array_distinct(S.tables(F.col("statement")))).alias("table_name"),
                         F.struct(-F.col("exec_count"), F.col("statement")).alias("pos"), F.col("statement").alias("sql_text"))
    return rows


@query("t18_table_prompts")
def t18(spark, d):
    logs = derived.sql_logs(spark, d)
    tables = registry.table_registry(logs).join(
        catalog.star_tables(spark).select("table_name", F.col("description").alias("system_comment")), "table_name", "left")
    stats = None
    rows = None
    for name in ("nation", "customer", "orders", "part"):
        source = derived.table(spark, d, name)
        part = profile.quick_statistics(source).withColumn("table_name", F.lit(name))
        stats = part if stats is None else stats.unionByName(part)
        first = source.orderBy(source.columns[0]).limit(10).select(
            F.lit(name).alias("table_name"), F.col(source.columns[0]).cast("long").alias("pos"), F.to_json(F.struct("*")).alias("row"))
        rows = first if rows is None else rows.unionByName(first)
    figures = F.struct("distinct_count", "null_rate", "min_number", "max_number", "avg_number")
    columns = catalog.star_columns(spark, d).join(stats.select("table_name", "column_name", figures.alias("statistics")),
                                                  ["table_name", "column_name"], "left")
    columns = columns.withColumn("system_comment", F.col("description")).withColumn("sample_values", F.array().cast("array<string>"))
    joins = registry.join_patterns(logs).withColumn("pos", F.struct(-F.col("join_count"), F.col("target_table")))
    wheres = registry.where_patterns(logs).withColumn("pos", F.struct(-F.col("count"), F.col("condition")))
    wheres = linking.top_k(wheres, ["table_name"], [F.asc("pos")], 5).drop("rank")
    return prompts.table_payloads(tables, columns, _statements(spark, d), joins, wheres, rows)


@query("t19_column_prompts")
def t19(spark, d):
    columns = registry.column_registry(derived.sql_logs(spark, d)).filter("table_name IS NOT NULL")
    columns = columns.withColumn("usage_context", registry.usage_context()).join(
        catalog.star_columns(spark, d).select("table_name", "column_name", "data_type", F.col("description").alias("system_comment")),
        ["table_name", "column_name"], "left")
    columns = columns.withColumn("sample_values", F.array().cast("array<string>")).withColumn("statistics", F.struct("usage_count"))
    return prompts.column_payloads(columns.withColumn("column_name", F.upper("column_name")), _statements(spark, d))


_MAPPED = """mapped AS (SELECT DISTINCT term, table_name, column_name FROM (SELECT DISTINCT split_part(term, ' ', 2) AS term FROM (SELECT p_name AS term FROM part)
  UNION SELECT DISTINCT lower(event_type) FROM events UNION SELECT 'price' UNION SELECT 'key') g JOIN cat_columns ON contains(lower(description), lower(term)))"""


def _terms(spark, d):
    """Glossary terms taken from the data: second words of part names, event types, and two common nouns."""
    part = derived.table(spark, d, "part").select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("term"))
    kinds = derived.table(spark, d, "events").select(F.lower("event_type").alias("term"))
    rows = part.unionByName(kinds).distinct()
    return rows.unionByName(rows.sparkSession.createDataFrame([("price",), ("key",)], "term string")).distinct()


@query("d19_knowledge_graph", D.with_(D.LOGS, D.CATALOG, D.GLOSSARY, EDGES, _FIRST, _MAPPED) + """
, g AS (SELECT DISTINCT table_name AS src, 'HAS_COLUMN' AS relation, table_name || '.' || column_name AS dst FROM cat_columns
UNION SELECT table_a, 'REFERENCES', table_b FROM edges WHERE join_type = 'pk_fk' UNION SELECT table_b, 'REFERENCES', table_a FROM edges WHERE join_type = 'pk_fk'
UNION SELECT table_a || '.' || unnest(join_columns), 'FOREIGN_KEY_TO', table_b || '.' || unnest(join_columns) FROM edges WHERE join_type = 'pk_fk'
UNION SELECT table_name || '.' || column_name, 'MAPS_TO', term FROM mapped
UNION SELECT term, 'BELONGS_TO', category FROM glossary WHERE category IS NOT NULL
UNION SELECT template_id, 'USES_TABLE', unnest(tables) FROM firsts UNION SELECT template_id, 'USES_COLUMN', unnest(columns) FROM firsts)
SELECT src, relation, dst FROM g""")
def d19(spark, d):
    columns = _columns(spark, d)
    found = _distinct(spark, d)
    return graph.edges(
        catalog.star_tables(spark), columns, _edges(spark, d), derived.glossary(spark, d), graph.term_columns(_terms(spark, d), columns),
        found.select("template_id", F.explode("tables").alias("table_name")),
        found.select("template_id", F.explode("columns").alias("column_name")))


@query("d19_related_tables", D.with_(D.CATALOG, EDGES, _MAPPED) + """
, refs AS (SELECT table_name, other FROM around JOIN (SELECT table_a, table_b FROM edges WHERE join_type = 'pk_fk') e
  ON (table_name = table_a AND other = table_b) OR (table_name = table_b AND other = table_a))
SELECT term, table_name, CAST(min(hops) AS INTEGER) AS hops FROM (SELECT term, table_name, 0 AS hops FROM mapped
  UNION ALL SELECT term, r.other, 1 FROM mapped m JOIN refs r ON r.table_name = m.table_name
  UNION ALL SELECT term, q.other, 2 FROM mapped m JOIN refs r ON r.table_name = m.table_name JOIN refs q ON q.table_name = r.other)
GROUP BY term, table_name""")
def d19_related(spark, d):
    return graph.related_tables(graph.term_columns(_terms(spark, d), _columns(spark, d)), _edges(spark, d))


TEMPLATE_SEARCH = f"""tokens AS (SELECT template_id AS doc, {D.tokens('template_text')} AS t FROM firsts),
post AS (SELECT doc, length, term, count(*) AS tf FROM (SELECT doc, len(t) AS length, unnest(t) AS term FROM tokens) GROUP BY ALL),
corpus AS (SELECT count(*) AS n, CAST(sum(len(t)) AS DOUBLE) / count(*) AS mean_length FROM tokens),
freq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
dq AS (SELECT DISTINCT question AS query FROM questions),
terms AS (SELECT query, term, count(*) AS qtf FROM (SELECT query, unnest({D.tokens('query')}) AS term FROM dq) GROUP BY ALL)"""


def _template_index(spark, d):
    return R.Index(stored(_distinct(spark, d), "templates"), "template_id", "template_text")


@query("d20_stage_routing", D.with_(D.LOGS, _FIRST, "questions AS (SELECT DISTINCT lower(sql_text) AS question FROM sql_logs)", TEMPLATE_SEARCH, TFIDF, top("cosine", 1)) + """
SELECT query, doc, round(coalesce(score, 0), 6) AS score, CASE WHEN round(coalesce(score, 0), 9) >= 0.8 THEN 'template' ELSE 'schema' END AS path
FROM dq LEFT JOIN ranked USING (query)""")
def d20(spark, d):
    asked = derived.sql_logs(spark, d).select(F.lower("sql_text").alias("question")).distinct()
    best = R.cosine_search(asked, "question", "question", _template_index(spark, d), 1)
    return R.route(best.select("query", "doc", "score"), questions=asked.select(F.col("question").alias("query"))).withColumn("score", F.round("score", 6))


@query("d14_context_assembly", D.with_(D.LOGS, D.QUESTIONS, D.CATALOG, _FIRST, TEMPLATE_SEARCH, BM25, top("bm25", 3), _CONTEXTS) + """
, texts AS (SELECT query, string_agg(template_text, chr(10) ORDER BY rank) AS t FROM ranked JOIN firsts ON doc = template_id GROUP BY query)
, used AS (SELECT DISTINCT query, unnest(tables) AS table_name FROM ranked JOIN firsts ON doc = template_id)
, blocks AS (SELECT query, string_agg(context, chr(10) ORDER BY table_name) AS c FROM used JOIN contexts USING (table_name) GROUP BY query)
SELECT query, concat_ws(chr(10), t, c) AS context FROM dq LEFT JOIN texts USING (query) LEFT JOIN blocks USING (query)""")
def d14(spark, d):
    found = stored(_distinct(spark, d), "templates")
    asked = derived.questions(spark, d).select("question").distinct()
    hits = R.bm25_search(asked, "question", "question", R.Index(found, "template_id", "template_text"), 3)
    blocks = prompts.table_context(catalog.star_tables(spark), _columns(spark, d))
    return context.assemble(hits, found, blocks, asked.select(F.col("question").alias("query")))


@query("d23_glossary_search", D.with_(D.GLOSSARY, f"""entries AS (SELECT term, max(korean_name) AS korean_name, max(description) AS description FROM glossary GROUP BY term),
docs AS (SELECT term AS doc, concat_ws(' ', term, korean_name, description) AS text FROM entries),
tokens AS (SELECT doc, {D.tokens('text')} AS t FROM docs),
post AS (SELECT doc, length, term, count(*) AS tf FROM (SELECT doc, len(t) AS length, unnest(t) AS term FROM tokens) GROUP BY ALL),
corpus AS (SELECT count(*) AS n, CAST(sum(len(t)) AS DOUBLE) / count(*) AS mean_length FROM tokens),
freq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
asked AS (SELECT DISTINCT p_name AS query FROM part UNION SELECT DISTINCT lower(p_type) || ' part' FROM part),
terms AS (SELECT query, term, count(*) AS qtf FROM (SELECT query, unnest({D.tokens('query')}) AS term FROM asked) GROUP BY ALL),
bm25 AS (SELECT query, doc, sum(qtf * ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / mean_length))) AS score
  FROM terms JOIN freq USING (term) JOIN post USING (term), corpus GROUP BY query, doc)""") + """
SELECT query, doc AS term, CAST(tier AS INTEGER) AS tier, CAST(row_number() OVER (PARTITION BY query ORDER BY tier, round(score, 9) DESC, doc) AS INTEGER) AS rank
FROM (SELECT query, doc, CASE WHEN lower(query) = lower(doc) THEN 0 ELSE 1 END AS tier, CASE WHEN lower(query) = lower(doc) THEN 0 ELSE score END AS score FROM bm25)
QUALIFY row_number() OVER (PARTITION BY query ORDER BY tier, round(score, 9) DESC, doc) <= 5""")
def d23(spark, d):
    part = derived.table(spark, d, "part")
    asked = part.select(F.col("p_name").alias("q")).union(part.select(F.concat(F.lower("p_type"), F.lit(" part")))).distinct()
    return context.glossary_search(asked, "q", "q", derived.glossary(spark, d))


@query("d23_log_search", D.with_(D.LOGS, D.QUESTIONS, f"""load AS (SELECT template_text, md5(template_text) AS template_id, CAST(sum(exec_count) AS BIGINT) AS exec_count
  FROM (SELECT {D.mask('sql_text')} AS template_text, exec_count FROM sql_logs WHERE {D.VALID}) GROUP BY template_text)""") + f"""
SELECT query, template_id, exec_count, CAST(row_number() OVER (PARTITION BY query ORDER BY exec_count DESC, template_id) AS INTEGER) AS rank FROM (
  SELECT DISTINCT query, template_id, exec_count FROM (SELECT question AS query, unnest(list_distinct({D.tokens('question')})) AS w FROM (SELECT DISTINCT question FROM questions))
  JOIN (SELECT template_id, exec_count, unnest(list_distinct({D.tokens('template_text')})) AS w FROM load WHERE upper(regexp_extract(template_text, '(\\S+)', 1)) = 'SELECT') USING (w))
QUALIFY row_number() OVER (PARTITION BY query ORDER BY exec_count DESC, template_id) <= 5""")
def d23_logs(spark, d):
    asked = derived.questions(spark, d).select("question").distinct()
    return context.log_search(asked, "question", "question", templates.template_load(derived.sql_logs(spark, d)), 5, "SELECT")

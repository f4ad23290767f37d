"""Registries mined from the log, profiles, monitoring and maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from querylode.operators import profile, registry
from querylode.plans import templates
from querylode.sources import catalog, derived
from querylode.streaming import incremental
from workbook import duck as D, query
from workbook.sqltext import JOINS, PREDICATES

_TABLES = rf"""used AS (SELECT sql_id, sql_text, exec_count, schema_name, collected_at, unnest(list_distinct({D.tables('sql_text')})) AS table_name
  FROM sql_logs)"""
REGISTRY = """registry AS (SELECT table_name, min(schema_name) AS schema_name, min(collected_at) AS first_seen_at,
  max(collected_at) AS last_seen_at, CAST(count(*) AS BIGINT) AS sql_count, 'pending' AS meta_status
  FROM used GROUP BY table_name)"""


@query("d1_incremental_extract", D.with_(D.LOGS) + """
SELECT sql_id, exec_count FROM sql_logs
WHERE collected_at > (SELECT max(collected_at) FROM sql_logs) - INTERVAL 1 DAY""")
def d1(spark, d):
    logs = derived.sql_logs(spark, d)
    last = logs.agg((F.max("collected_at") - F.expr("INTERVAL 1 DAY")).alias("t")).scalar()
    return incremental.changed_since(logs, "collected_at", last).select("sql_id", "exec_count")


@query("d1_incremental_stream", D.with_(D.LOGS) + f"""
SELECT md5({D.mask('sql_text')}) AS template_id, CAST(count(*) AS BIGINT) AS log_count,
  CAST(sum(exec_count) AS BIGINT) AS exec_count FROM sql_logs WHERE {D.VALID} GROUP BY 1""")
def d1_stream(spark, d):
    return incremental.stream_template_load(spark, d)


@query("d6_link_back", D.with_(D.LOGS) + f"""
SELECT sql_id, CASE WHEN {D.VALID} THEN md5({D.mask('sql_text')}) END AS template_id FROM sql_logs""")
def d6(spark, d):
    logs = derived.sql_logs(spark, d)
    return templates.link_back(logs, templates.template_load(logs)).select("sql_id", "template_id")


@query("d7_table_registry", D.with_(D.LOGS, _TABLES, REGISTRY) + """
SELECT table_name, schema_name, epoch_us(first_seen_at) AS first_seen_us, epoch_us(last_seen_at) AS last_seen_us,
  sql_count, meta_status FROM registry""")
def d7(spark, d):
    logs = derived.sql_logs(spark, d)
    cutoff = F.lit("2024-01-15").cast("timestamp_ntz")
    old = registry.table_registry(logs.filter(F.col("collected_at") < cutoff))
    new = registry.table_registry(logs.filter(F.col("collected_at") >= cutoff))
    merged = registry.merge_table_registry(old, new)
    return merged.select("table_name", "schema_name", *[
        F.unix_micros(F.col(f"{c}_at").cast("timestamp")).alias(f"{c}_us") for c in ("first_seen", "last_seen")],
        "sql_count", "meta_status")


# Uses per clause for the statement shapes of the derived log, by table.
_USES = rf"""uses AS (
  SELECT sql_id, table_name, column_name, 'where' AS context FROM (SELECT DISTINCT sql_id, CASE WHEN contains(c, '.') THEN
      regexp_extract(sql_text, '(?:FROM|JOIN)\s+(\w+)\s+' || regexp_extract(c, '^([^.]*)', 1) || '\b', 1, 'i')
      ELSE regexp_extract(sql_text, '\bFROM\s+(\w+)', 1, 'i') END AS table_name, regexp_extract(c, '([^.]*)$', 1) AS column_name
    FROM (SELECT sql_id, sql_text, unnest(regexp_extract_all(regexp_extract(sql_text, '\bWHERE\s+(.*)$', 1, 'is'),
      '(?:^|AND|OR)\s*{D.NAME}\s*(?:=|!=|<>|<|>|<=|>=|IN|LIKE|BETWEEN|IS)', 1, 'i')) AS c FROM sql_logs))
    WHERE table_name <> ''
  UNION ALL
  SELECT sql_id, CASE WHEN c LIKE 'c.%' THEN 'customer' WHEN c LIKE 'o.%' THEN 'orders' WHEN c LIKE 'n.%' THEN 'nation'
      WHEN c LIKE 'r.%' THEN 'region' ELSE regexp_extract(sql_text, '\bFROM\s+(\w+)', 1, 'i') END, regexp_extract(c, '([^.]*)$', 1), 'select'
    FROM (SELECT sql_id, sql_text, trim(unnest(string_split(regexp_extract(sql_text, '^SELECT\s+(.*?)\s+FROM\b', 1, 'i'), ','))) AS c
      FROM sql_logs) WHERE regexp_matches(c, '^[A-Za-z_][\w.]*$')
  UNION ALL
  SELECT sql_id, CASE WHEN c LIKE 'c.%' THEN 'customer' WHEN c LIKE 'o.%' THEN 'orders' WHEN c LIKE 'n.%' THEN 'nation' ELSE 'region' END,
    regexp_extract(c, '([^.]*)$', 1), 'join' FROM (SELECT sql_id, unnest(string_split(condition, ' = ')) AS c FROM joins)
  UNION ALL
  SELECT sql_id, 'lineitem', 'l_returnflag', 'group_by' FROM sql_logs WHERE contains(sql_text, 'GROUP BY l_returnflag')
  UNION ALL
  SELECT sql_id, 'lineitem', 'l_quantity', 'aggregate' FROM sql_logs WHERE contains(sql_text, 'SUM(l_quantity)'))"""
_COLUMN_REGISTRY = """column_registry AS (SELECT table_name, column_name, CAST(count(*) AS BIGINT) AS usage_count,
  CAST(count(*) FILTER (context = 'select') AS BIGINT) AS select_count,
  CAST(count(*) FILTER (context = 'where') AS BIGINT) AS where_count,
  CAST(count(*) FILTER (context = 'join') AS BIGINT) AS join_count,
  CAST(count(*) FILTER (context = 'group_by') AS BIGINT) AS group_by_count,
  CAST(count(*) FILTER (context = 'aggregate') AS BIGINT) AS aggregate_count FROM uses GROUP BY table_name, column_name)"""


@query("d8_column_registry", D.with_(D.LOGS, JOINS, _USES, _COLUMN_REGISTRY) + "SELECT * FROM column_registry")
def d8(spark, d):
    return registry.column_registry(derived.sql_logs(spark, d)).filter("table_name IS NOT NULL").drop(
        "first_seen_at", "last_seen_at")


def _stats_sql() -> str:
    numbers = {"orders": ["o_orderkey", "o_custkey", "o_totalprice"],
               "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                            "l_discount", "l_tax"],
               "part": ["p_partkey", "p_size", "p_retailprice"], "customer": ["c_custkey", "c_nationkey", "c_acctbal"]}
    texts = {"orders": ["o_orderstatus", "o_orderpriority"], "lineitem": ["l_returnflag", "l_linestatus"],
             "part": ["p_name", "p_brand", "p_type"], "customer": ["c_name", "c_mktsegment"]}
    times = {"orders": ["o_orderdate"], "lineitem": ["l_shipdate"]}
    parts = []

    def row(t, c, kind, **given):
        fields = {"min_number": "CAST(NULL AS DOUBLE)", "max_number": "CAST(NULL AS DOUBLE)", "avg_number": "CAST(NULL AS DOUBLE)",
                  "median_number": "CAST(NULL AS DOUBLE)", "samples": "CAST(NULL AS VARCHAR)", "min_time": "CAST(NULL AS VARCHAR)",
                  "max_time": "CAST(NULL AS VARCHAR)", **given}
        parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS kind, CAST(count(*) AS BIGINT) AS row_count, "
                     f"CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) / count(*) AS null_rate, "
                     f"CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_count, "
                     + ", ".join(f"{v} AS {k}" for k, v in fields.items()) + f" FROM {t}")

    for t, cs in numbers.items():
        for c in cs:
            row(t, c, "number", min_number=f"CAST(min({c}) AS DOUBLE)", max_number=f"CAST(max({c}) AS DOUBLE)",
                avg_number=f"round(CAST(sum(CAST({c} AS DECIMAL(24,6))) AS DOUBLE) / count({c}), 4)",
                median_number=f"round(median(CAST({c} AS DOUBLE)), 4)")
    for t, cs in texts.items():
        for c in cs:
            row(t, c, "text", samples=f"array_to_string(list_slice(list_sort(list(DISTINCT {c})), 1, 5), ',')")
    for t, cs in times.items():
        for c in cs:
            row(t, c, "time", min_time=f"strftime(min({c}), '%Y-%m-%d %H:%M:%S')", max_time=f"strftime(max({c}), '%Y-%m-%d %H:%M:%S')")
    return "\nUNION ALL ".join(parts)


@query("d9_column_statistics", _stats_sql())
def d9(spark, d):
    out = None
    for t in ("orders", "lineitem", "part", "customer"):
        stats = profile.exact_statistics(derived.table(spark, d, t)).withColumn("table_name", F.lit(t))
        out = stats if out is None else out.unionByName(stats, allowMissingColumns=True)
    return out.select("table_name", "column_name", "kind", "row_count", "null_rate", "distinct_count", "min_number",
                      "max_number", F.round("avg_number", 4).alias("avg_number"),
                      F.round("median_number", 4).alias("median_number"),
                      F.array_join("sample_values", ",").alias("samples"), "min_time", "max_time")


_JOIN_PATTERNS = r"""patterns AS (SELECT owner(l) AS table_name, owner(r) AS target_table, split_part(l, '.', 2) AS join_column FROM sides
  UNION ALL SELECT owner(r), owner(l), split_part(r, '.', 2) FROM sides)""".replace("owner(l)", "(CASE split_part(l, '.', 1) WHEN 'c' THEN 'customer' WHEN 'o' THEN 'orders' WHEN 'n' THEN 'nation' ELSE 'region' END)").replace(
    "owner(r)", "(CASE split_part(r, '.', 1) WHEN 'c' THEN 'customer' WHEN 'o' THEN 'orders' WHEN 'n' THEN 'nation' ELSE 'region' END)")
_SIDES = "sides AS (SELECT split_part(condition, ' = ', 1) AS l, split_part(condition, ' = ', 2) AS r FROM joins)"
JOIN_PATTERNS = D.with_(D.LOGS, JOINS, _SIDES, _JOIN_PATTERNS)


@query("d10_join_patterns", JOIN_PATTERNS + """
SELECT table_name, target_table, join_column, CAST(count(*) AS BIGINT) AS join_count FROM patterns GROUP BY 1, 2, 3""")
def d10(spark, d):
    return registry.join_patterns(derived.sql_logs(spark, d))


@query("d10_where_patterns", D.with_(D.LOGS, PREDICATES) + r"""
SELECT coalesce(table_name, '') AS table_name, condition, CAST(count(*) AS BIGINT) AS count FROM (
  SELECT CASE WHEN contains(column_name, '.') THEN regexp_extract(sql_text,
      '(?:FROM|JOIN)\s+(\w+)\s+' || regexp_extract(column_name, '^([^.]*)', 1) || '\b', 1, 'i')
    ELSE regexp_extract(sql_text, '\bFROM\s+(\w+)', 1, 'i') END AS table_name,
    regexp_extract(column_name, '([^.]*)$', 1) || ' ' || op || ' ' || value AS condition FROM predicates)
GROUP BY 1, 2""")
def d10_where(spark, d):
    found = registry.where_patterns(derived.sql_logs(spark, d))
    return found.withColumn("table_name", F.coalesce("table_name", F.lit("")))


@query("d11_enrichment_priority", D.with_(D.LOGS, JOINS, _SIDES, _JOIN_PATTERNS, _USES, _COLUMN_REGISTRY, _TABLES, REGISTRY, D.CATALOG) + r"""
, t AS (SELECT table_name, percent_rank() OVER (ORDER BY sql_count DESC) AS share FROM registry)
, c AS (SELECT *, percent_rank() OVER (ORDER BY usage_count DESC) AS share FROM column_registry)
, deg AS (SELECT table_name, count(DISTINCT target_table) AS degree FROM patterns GROUP BY table_name)
SELECT c.table_name, c.column_name, c.usage_count, CAST(CASE WHEN t.share <= 0.2 THEN 1
  WHEN k.description IS NULL OR length(trim(k.description)) < 5 OR (upper(k.description) = k.description
    AND lower(k.description) <> k.description AND length(k.description) <= 10) THEN 2
  WHEN deg.degree >= 2 THEN 3 WHEN c.share <= 0.2 THEN 4 ELSE 5 END AS INTEGER) AS priority
FROM c LEFT JOIN t USING (table_name) LEFT JOIN deg USING (table_name)
  LEFT JOIN cat_columns k ON k.table_name = c.table_name AND k.column_name = c.column_name""")
def d11(spark, d):
    logs = derived.sql_logs(spark, d)
    comments = catalog.star_columns(spark, d).select("table_name", "column_name", F.col("description").alias("comment"))
    columns = registry.column_registry(logs).filter("table_name IS NOT NULL")
    return registry.enrichment_priority(registry.table_registry(logs), registry.join_patterns(logs), columns, comments)


@query("d12_unknown_references", D.with_(D.LOGS, JOINS, _USES, D.CATALOG) + """
SELECT table_name, column_name, CAST(count(*) AS BIGINT) AS n, CASE WHEN table_name IN (SELECT table_name FROM cat_tables)
  THEN 'unknown column' ELSE 'unknown table' END AS problem
FROM uses WHERE NOT EXISTS (SELECT 1 FROM cat_columns k WHERE k.table_name = uses.table_name AND k.column_name = uses.column_name)
GROUP BY table_name, column_name""")
def d12(spark, d):
    uses = registry.column_uses(derived.sql_logs(spark, d)).filter("table_name IS NOT NULL")
    return registry.unknown_columns(uses, catalog.star_columns(spark, d))


@query("d12_description_checks", """
SELECT p_partkey, array_to_string(list_filter([CASE WHEN length(trim(p_type)) < 6 THEN 'too short' END,
  CASE WHEN NOT contains(lower(p_type || ' ' || p_brand), lower(p_name)) THEN 'name missing' END], lambda x: x IS NOT NULL), ',') AS problems
FROM part WHERE length(trim(p_type)) < 6 OR NOT contains(lower(p_type || ' ' || p_brand), lower(p_name))""".replace(
    "length(trim(p_type)) < 6", "length(trim(p_type || ' ' || p_brand)) < 14"))
def d12_checks(spark, d):
    parts = derived.table(spark, d, "part").withColumn("text", F.concat_ws(" ", "p_type", "p_brand"))
    found = registry.description_checks(parts, "text", "p_name", min_length=14)
    return found.select("p_partkey", F.array_join("problems", ",").alias("problems"))


@query("d13_deactivate_unused", D.with_(D.LOGS, _TABLES, REGISTRY) + """
SELECT table_name, sql_count, CAST(DATE '2024-02-15' - CAST(last_seen_at AS DATE) AS INTEGER) AS idle_days,
  CASE WHEN DATE '2024-02-15' - CAST(last_seen_at AS DATE) > 18 THEN 'inactive' ELSE meta_status END AS meta_status
FROM registry""")
def d13(spark, d):
    tables = registry.table_registry(derived.sql_logs(spark, d))
    return registry.deactivate(tables, F.lit("2024-02-15").cast("date"), 18).select(
        "table_name", "sql_count", "idle_days", "meta_status")


_EDITS = """meta AS (SELECT c_custkey AS template_id, 'segment' AS field_name, c_mktsegment AS value FROM customer),
edits AS (SELECT o_orderkey AS edit_id, o_custkey AS template_id, 'segment' AS field_name, o_orderpriority AS new_value,
  'editor' || CAST(o_custkey % 7 AS VARCHAR) AS editor_id, o_orderdate AS edited_at,
  CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'P' THEN 'pending' ELSE 'rejected' END AS status FROM orders)"""


def _edits(spark, d):
    meta = derived.table(spark, d, "customer").selectExpr("c_custkey AS template_id", "'segment' AS field_name", "c_mktsegment AS value")
    edits = derived.table(spark, d, "orders").selectExpr(
        "o_orderkey AS edit_id", "o_custkey AS template_id", "'segment' AS field_name", "o_orderpriority AS new_value",
        "concat('editor', CAST(o_custkey % 7 AS STRING)) AS editor_id", "o_orderdate AS edited_at",
        "CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'P' THEN 'pending' ELSE 'rejected' END AS status")
    return registry.apply_edits(meta, edits)


@query("d15_metadata_edits", D.with_(_EDITS) + """
SELECT m.template_id, m.field_name, coalesce(e.new_value, m.value) AS value, e.editor_id AS reviewed_by,
  CASE WHEN e.new_value IS NULL THEN 'auto' ELSE 'modified' END AS review_status
FROM meta m LEFT JOIN (SELECT * FROM edits WHERE status = 'approved'
  QUALIFY row_number() OVER (PARTITION BY template_id, field_name ORDER BY edited_at DESC, edit_id DESC) = 1) e
  USING (template_id, field_name)""")
def d15(spark, d):
    return _edits(spark, d)[0]


@query("d15_edit_history", D.with_(_EDITS) + """
SELECT e.edit_id, e.template_id, e.new_value, e.status, coalesce(last_value(CASE WHEN status = 'approved' THEN new_value END IGNORE NULLS)
  OVER (PARTITION BY e.template_id ORDER BY edited_at, edit_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), m.value) AS old_value
FROM edits e JOIN meta m USING (template_id)""")
def d15_history(spark, d):
    return _edits(spark, d)[1].select("edit_id", "template_id", "new_value", "status", "old_value")


@query("d16_monitoring", D.with_(D.LOGS, f"""v AS (SELECT strftime(collected_at, '%Y-%m-%d') AS batch, {D.mask('sql_text')} AS template,
  {D.tables('sql_text')} AS tables FROM sql_logs WHERE {D.VALID})""") + """
, n AS (SELECT batch, count(*) AS k FROM (SELECT template, min(batch) AS batch FROM v GROUP BY template) GROUP BY batch)
, t AS (SELECT batch, count(*) AS k FROM (SELECT table_name, min(batch) AS batch FROM (SELECT batch, unnest(tables) AS table_name FROM v) GROUP BY 1) GROUP BY batch)
, s AS (SELECT batch, count(*) AS valid_logs, count(DISTINCT template) AS templates FROM v GROUP BY batch)
SELECT a.batch, a.logs, coalesce(valid_logs, 0) AS valid_logs, coalesce(templates, 0) AS templates, coalesce(n.k, 0) AS new_templates,
  coalesce(t.k, 0) AS new_tables, round(1 - CAST(templates AS DOUBLE) / valid_logs, 6) AS dedup_ratio,
  round(1 - CAST(coalesce(n.k, 0) AS DOUBLE) / templates, 6) AS reuse_rate, coalesce(n.k, 0) AS description_calls
FROM (SELECT strftime(collected_at, '%Y-%m-%d') AS batch, CAST(count(*) AS BIGINT) AS logs FROM sql_logs GROUP BY 1) a
LEFT JOIN s USING (batch) LEFT JOIN n USING (batch) LEFT JOIN t USING (batch)""")
def d16(spark, d):
    out = registry.monitoring(derived.sql_logs(spark, d), F.date_format("collected_at", "yyyy-MM-dd"))
    return out.withColumn("dedup_ratio", F.round("dedup_ratio", 6)).withColumn("reuse_rate", F.round("reuse_rate", 6))


@query("d18_execution_profile", D.with_(D.PROFILED) + f"""
SELECT md5({D.mask('sql_text')}) AS template_id, CAST(count(*) AS BIGINT) AS runs, CAST(sum(exec_count) AS BIGINT) AS exec_count,
  round(avg(result_rows), 4) AS rows_avg, round(avg(exec_time), 4) AS exec_time_avg,
  CAST(list_extract(list_sort(list(exec_time)), CAST(ceil(count(*) * 0.95) AS BIGINT)) AS BIGINT) AS exec_time_p95,
  epoch_us(max(collected_at)) AS last_executed_us, CAST(sum(error_count) AS BIGINT) AS error_count,
  epoch_us(max(collected_at) FILTER (error_count > 0)) AS last_error_us
FROM sql_logs GROUP BY 1""")
def d18(spark, d):
    logs = templates.normalized(derived.profiled_logs(spark, d))
    out = profile.execution_profile(logs)
    return out.select("template_id", "runs", "exec_count", F.round("rows_avg", 4).alias("rows_avg"),
                      F.round("exec_time_avg", 4).alias("exec_time_avg"), "exec_time_p95",
                      F.unix_micros(F.col("last_executed_at").cast("timestamp")).alias("last_executed_us"), "error_count",
                      F.unix_micros(F.col("last_error_at").cast("timestamp")).alias("last_error_us"))


@query("d22_table_families", D.with_(D.LOGS, _TABLES, REGISTRY) + r"""
SELECT regexp_extract(table_name, '^(.+)_((?:M\d+|R\d+|WLP\d*|C\d+)|(?:IC|CJ|WX)[A-Z]+)$', 1, 'i') AS stem,
  CAST(count(*) AS BIGINT) AS members, CAST(sum(sql_count) AS BIGINT) AS sql_count,
  array_to_string(list_sort(list(DISTINCT upper(regexp_extract(table_name, '^(.+)_((?:M\d+|R\d+|WLP\d*|C\d+)|(?:IC|CJ|WX)[A-Z]+)$', 2, 'i')))), ',') AS suffixes
FROM registry WHERE regexp_matches(table_name, '^(.+)_((?:M\d+|R\d+|WLP\d*|C\d+)|(?:IC|CJ|WX)[A-Z]+)$', 'i') GROUP BY 1""")
def d22(spark, d):
    found = registry.families(registry.table_registry(derived.sql_logs(spark, d)))
    return found.withColumn("suffixes", F.array_join("suffixes", ","))


@query("d22_family_union", """
SELECT fab_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (
  SELECT *, 'O' AS fab_id FROM orders WHERE o_orderstatus = 'O' UNION ALL
  SELECT *, 'F' AS fab_id FROM orders WHERE o_orderstatus = 'F' UNION ALL
  SELECT *, 'P' AS fab_id FROM orders WHERE o_orderstatus = 'P') GROUP BY fab_id""")
def d22_union(spark, d):
    orders = derived.table(spark, d, "orders")
    members = {s: orders.filter(F.col("o_orderstatus") == s) for s in ("O", "F", "P")}
    return registry.union_family(members).groupBy("fab_id").agg(
        F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))

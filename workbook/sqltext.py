"""Text projections over the derived log."""

from __future__ import annotations

from pyspark.sql import functions as F

from querylode.functions import sqltext as S
from querylode.functions import tokens as K
from querylode.operators import duplicates, predicates
from querylode.plans import templates
from querylode.sources import catalog, derived
from workbook import duck as D, query

def _sql():
    return F.col("sql_text")


def _logs(spark, d, *columns):
    return derived.sql_logs(spark, d).select("sql_id", *columns)


@query("t1_literal_masking", D.with_(D.LOGS) + f"SELECT sql_id, {D.mask('sql_text')} AS template_text FROM sql_logs")
def t1(spark, d):
    return _logs(spark, d, S.mask_literals(_sql()).alias("template_text"))


@query("t2_tables", D.with_(D.LOGS) + f"SELECT sql_id, array_to_string({D.tables('sql_text')}, ',') AS tables FROM sql_logs")
def t2(spark, d):
    return _logs(spark, d, F.concat_ws(",", S.tables(_sql())).alias("tables"))


@query("t3_select_columns", D.with_(D.LOGS) + f"""
SELECT sql_id, CASE WHEN NOT list_contains(cols, '') THEN array_to_string(cols, ',') END AS columns,
  CASE WHEN list_contains(cols, '') THEN 'blank select item' END AS error
FROM (SELECT sql_id, {D.columns('sql_text')} AS cols FROM sql_logs)""")
def t3(spark, d):
    cols = S.select_columns(_sql())
    return _logs(spark, d, F.array_join(cols["columns"], ",").alias("columns"), cols["error"].alias("error"))


@query("t4_where_columns", D.with_(D.LOGS) + rf"""
SELECT sql_id, array_to_string(list_transform(regexp_extract_all(clause,
  '(?:^|AND|OR)\s*{D.NAME}\s*(?:=|!=|<>|<|>|<=|>=|IN|LIKE|BETWEEN|IS)', 1, 'i'),
  lambda c: regexp_extract(c, '([^.]*)$', 1)), ',') AS columns
FROM (SELECT sql_id, regexp_extract(sql_text,
  '\bWHERE\s+(.*?)(?:\bORDER\b|\bGROUP\b|\bHAVING\b|\bLIMIT\b|$)', 1, 'is') AS clause FROM sql_logs)""")
def t4(spark, d):
    return _logs(spark, d, F.array_join(S.where_columns(_sql()), ",").alias("columns"))


@query("t5_template_id", D.with_(D.LOGS) + f"""
SELECT template_id, CAST(count(*) AS BIGINT) AS log_count, min(sql_id) AS first_sql_id
FROM (SELECT sql_id, md5({D.mask('sql_text')}) AS template_id FROM sql_logs) GROUP BY template_id""")
def t5(spark, d):
    ids = _logs(spark, d, S.template_id(S.mask_literals(_sql())).alias("template_id"))
    return ids.groupBy("template_id").agg(F.count("*").alias("log_count"), F.min("sql_id").alias("first_sql_id"))


@query("t6_canonical_form", D.with_(D.LOGS) + f"SELECT sql_id, {D.canonical('sql_text')} AS canonical FROM sql_logs")
def t6(spark, d):
    return _logs(spark, d, S.canonical(_sql()).alias("canonical"))


@query("t7_canonical_duplicates", D.with_(D.LOGS, f"""
h AS (SELECT sql_id, sha256({D.canonical('sql_text')}) AS canonical_hash FROM sql_logs)""") + """
SELECT sql_id, canonical_hash, min(sql_id) OVER (PARTITION BY canonical_hash) AS first_sql_id,
  CAST(count(*) OVER (PARTITION BY canonical_hash) AS BIGINT) AS copies FROM h""")
def t7(spark, d):
    return duplicates.canonical_duplicates(derived.sql_logs(spark, d)).select(
        "sql_id", "canonical_hash", "first_sql_id", "copies")


_PRED = r"""([A-Za-z_][\w.]*)\s*(<>|!=|>=|<=|=|<|>)\s*(''[^'']*(?:''''[^'']*)*''|-?\d+(?:\.\d+)?|:\w+|[A-Za-z_][\w.]*)"""
PREDICATES = rf"""predicates AS (SELECT sql_id, sql_text, unnest(regexp_extract_all(clause, '{_PRED}', 1)) AS column_name,
  unnest(regexp_extract_all(clause, '{_PRED}', 2)) AS op, unnest(regexp_extract_all(clause, '{_PRED}', 3)) AS value
  FROM (SELECT sql_id, sql_text, array_to_string(regexp_extract_all(sql_text,
    '\bWHERE\s+(.*?)(?:\bORDER\s+BY\b|\bGROUP\s+BY\b|\bHAVING\b|\bLIMIT\b|\bUNION\b|$)', 1, 'is'), ' AND ') AS clause
    FROM sql_logs))"""
JOINS = r"""joins AS (SELECT sql_id, sql_text, upper(CASE WHEN m[1] = '' THEN 'INNER' ELSE m[1] END) AS side,
  m[2] AS table_name, m[3] AS alias, m[4] AS condition
  FROM (SELECT sql_id, sql_text, [regexp_extract(sql_text, p, 1, 'is'), regexp_extract(sql_text, p, 2, 'is'),
    regexp_extract(sql_text, p, 3, 'is'), regexp_extract(sql_text, p, 4, 'is')] AS m, regexp_matches(sql_text, p, 'is') AS hit
    FROM (SELECT *, '(?:(LEFT|RIGHT|FULL|CROSS|INNER)\s+(?:OUTER\s+)?)?JOIN\s+([A-Za-z_][\w.]*)(?:\s+([A-Za-z_]\w*))?\s+ON\s+(.*?)\s+WHERE' AS p FROM sql_logs))
  WHERE hit)"""


@query("t8_where_predicates", D.with_(D.LOGS, PREDICATES) + "SELECT sql_id, column_name, op, value FROM predicates")
def t8(spark, d):
    return predicates.where_predicates(derived.sql_logs(spark, d)).select("sql_id", "column_name", "op", "value")


@query("t9_joins", D.with_(D.LOGS, JOINS) + "SELECT sql_id, side, table_name, alias, condition FROM joins")
def t9(spark, d):
    return predicates.joins(derived.sql_logs(spark, d)).select("sql_id", "side", "table_name", "alias", "condition")


_ITEM = r"(?:[^,()'']|''[^'']*''|\((?:[^()'']|''[^'']*''|\([^()'']*\))*\))+"
_LIST = r"^\s*SELECT\s+(?:DISTINCT\s+)?((?:[^()'']|''[^'']*''|\((?:[^()'']|''[^'']*''|\([^()'']*\))*\))*?)\s+FROM\b"


@query("t10_select_outputs", D.with_(D.LOGS) + rf"""
SELECT sql_id, array_to_string(list_transform(regexp_extract_all(regexp_extract(sql_text, '{_LIST}', 1, 'is'), '{_ITEM}'),
  lambda i: CASE WHEN regexp_matches(i, '\sAS\s+[A-Za-z_]\w*\s*$', 'i')
                 THEN regexp_extract(i, '\sAS\s+([A-Za-z_]\w*)\s*$', 1, 'i')
                 WHEN regexp_matches(trim(i), '^[A-Za-z_][\w.]*$') THEN regexp_extract(trim(i), '([^.]*)$', 1)
                 ELSE trim(i) END), ',') AS outputs FROM sql_logs""")
def t10(spark, d):
    return _logs(spark, d, F.array_join(S.select_outputs(_sql()), ",").alias("outputs"))


# The nested log's shapes, with what each must yield written out from the event's own values.
def _expected(columns: str, rows: dict[int, list[tuple[str, ...]]]) -> str:
    parts = [f"SELECT sql_id, {', '.join(f'{x} AS {c}' for x, c in zip(row, columns.split(', ')))} FROM src WHERE shape = {shape}"
             for shape, found in rows.items() for row in found]
    src = f"(SELECT {derived.LOG_COLUMNS[0]}, event_id % 6 AS shape, e, u, v, k, event_type FROM {D._PARTS})"
    return f"WITH src AS {src} " + " UNION ALL ".join(parts)


def _names(columns: str, rows: dict[int, tuple[tuple[str, ...], ...]]) -> str:
    return _expected(columns, {shape: [tuple(x if x.isdigit() and i == 0 else f"'{x}'" for i, x in enumerate(r)) for r in found] for shape, found in rows.items()})


@query("t8_nested_predicates", _expected("query, left_side, op, right_side", {
    0: [("1", "'o_totalprice'", "'>'", "v"), ("3", "'n_regionkey'", "'='", "k"), ("2", "'b.total + 1'", "'>'", "u")],
    1: [("1", "k", "'<'", "'s_acctbal'"), ("2", "'p_size + ' || k", "'>='", "u")],
    2: [("1", "'o.o_orderkey'", "'='", "'l.l_orderkey'"), ("2", "'c_custkey'", "'='", "'o.o_custkey'"), ("2", "'c_acctbal'", "'<>'", "v")],
    3: [("2", "'r_name'", "'='", "'''O''''' || event_type || ''''")],
    4: [("1", "'nvl(max(value), 1)'", "'='", "k"), ("1", "'e.user_id'", "'>'", "u"), ("1", "'CASE WHEN e.user_id > ' || u || ' THEN 1 ELSE 0 END'", "'='", "'1'")],
}))
def t8_nested(spark, d):
    found = predicates.nested_predicates(derived.nested_logs(spark, d))
    return found.select("sql_id", "query", F.col("left").alias("left_side"), "op", F.col("right").alias("right_side"))


_SUB = "'(SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = ' || k || ') n'"


@query("t9_nested_joins", _expected("query, side, how, table_name, alias, condition, shared", {
    0: [("2", "'INNER'", "'ON'", _SUB, "'n'", "'c.c_nationkey = n.n_nationkey'", "NULL"), ("2", "'LEFT'", "'USING'", "'big'", "'b'", "NULL", "'o_custkey'")],
    2: [("1", "'INNER'", "'COMMA'", "'lineitem'", "'l'", "NULL", "NULL")],
    3: [("1", "'INNER'", "'NATURAL'", "'region'", "NULL", "NULL", "NULL"), ("1", "'INNER'", "'CROSS'", "'supplier'", "NULL", "NULL", "NULL")],
    5: [("1", "'FULL'", "'ON'", "'lineitem'", "NULL", "'p.p_partkey = lineitem.l_partkey AND lineitem.l_quantity > ' || k", "NULL")],
}))
def t9_nested(spark, d):
    found = predicates.nested_joins(derived.nested_logs(spark, d))
    return found.select("sql_id", "query", "side", "how", F.col("table").alias("table_name"), "alias", "condition", F.array_join("shared", ",").alias("shared"))


@query("t10_nested_outputs", _names("query, name", {
    0: (("1", "o_custkey"), ("1", "total"), ("2", "c_name"), ("2", "total"), ("3", "n_nationkey"), ("3", "n_name")), 1: (("1", "s_name"), ("2", "s_name")),
    2: (("1", "o_orderkey"), ("2", "1")), 3: (("1", "*"), ("2", "r_regionkey")), 4: (("1", "users"), ("1", "MAX(value)")), 5: (("1", "p_partkey"), ("1", "p_name")),
}))
def t10_nested(spark, d):
    return predicates.nested_outputs(derived.nested_logs(spark, d)).select("sql_id", "query", "name")


@query("d8_nested_uses", "SELECT table_name, column_name, context, CAST(count(*) AS BIGINT) AS n FROM (" + _names("table_name, column_name, context", {
    0: (("orders", "o_custkey", "select"), ("orders", "o_totalprice", "where"), ("customer", "c_name", "select"), ("big", "total", "select"),
        ("customer", "c_nationkey", "join"), ("nation", "n_nationkey", "select"), ("nation", "n_name", "select"), ("nation", "n_regionkey", "where")),
    1: (("supplier", "s_name", "select"), ("supplier", "s_acctbal", "where"), ("part", "p_name", "select")),
    2: (("orders", "o_orderkey", "select"), ("orders", "o_orderkey", "where"), ("lineitem", "l_orderkey", "where"), ("customer", "c_custkey", "where"),
        ("orders", "o_custkey", "where"), ("customer", "c_acctbal", "where")),
    3: (("region", "r_regionkey", "select"), ("region", "r_name", "where")), 4: (("events", "user_id", "where"),),
    5: (("part", "p_partkey", "select"), ("part", "p_partkey", "join"), ("lineitem", "l_partkey", "join"), ("lineitem", "l_quantity", "join")),
}) + ") GROUP BY ALL")
def d8_nested(spark, d):
    return predicates.nested_column_uses(derived.nested_logs(spark, d))


@query("d10_nested_joins", "SELECT table_name, target_table, join_column, CAST(count(*) AS BIGINT) AS join_count FROM (" + _names(
    "table_name, target_table, join_column", {
        0: (("customer", "big", "o_custkey"), ("big", "customer", "o_custkey")),
        2: (("orders", "lineitem", "o_orderkey"), ("lineitem", "orders", "l_orderkey")),
        5: (("part", "lineitem", "p_partkey"), ("lineitem", "part", "l_partkey")),
    }) + ") GROUP BY ALL")
def d10_nested(spark, d):
    return predicates.nested_join_patterns(derived.nested_logs(spark, d))


@query("t11_keywords", f"""SELECT doc_id, array_to_string(list_sort(list_distinct({D.keywords('text')})), ' ') AS keywords,
  CAST(len({D.keywords('text')}) AS BIGINT) AS n FROM documents""")
def t11(spark, d):
    docs = derived.table(spark, d, "documents").select("doc_id", K.keywords(F.col("text")).alias("k"))
    return docs.select("doc_id", F.array_join(F.array_sort(F.array_distinct("k")), " ").alias("keywords"),
                       F.size("k").cast("long").alias("n"))


@query("t12_search_tokens", f"SELECT doc_id, array_to_string({D.tokens('text')}, ' ') AS tokens FROM documents")
def t12(spark, d):
    docs = derived.table(spark, d, "documents")
    return docs.select("doc_id", F.array_join(K.search_tokens(F.col("text")), " ").alias("tokens"))


_REFERENCED = " || ".join(rf"regexp_extract_all(sql_text, '{w}\s+([A-Za-z0-9_]+)', 1, 'i')"
                          for w in ("FROM", "JOIN", "INTO", "UPDATE"))


@query("t13_known_tables", D.with_(D.LOGS, D.CATALOG) + f"""
SELECT sql_id, table_name FROM (SELECT sql_id, unnest(list_distinct({_REFERENCED})) AS table_name FROM sql_logs)
WHERE upper(table_name) IN (SELECT upper(table_name) FROM cat_tables)""")
def t13(spark, d):
    return predicates.known_tables(derived.sql_logs(spark, d), catalog.star_tables(spark)).select("sql_id", "table_name")


_WORDS = "[" + ", ".join(f"'{w}'" for w in S.SQL_WORDS) + "]"


@query("t14_identifier_words", D.with_(D.LOGS) + f"""
SELECT sql_id, array_to_string(list_filter(regexp_extract_all(sql_text, '([A-Za-z_][A-Za-z0-9_]*)', 1),
  lambda w: NOT list_contains({_WORDS}, upper(w))), ' ') AS words FROM sql_logs""")
def t14(spark, d):
    return _logs(spark, d, F.array_join(S.identifier_words(_sql()), " ").alias("words"))


_NAMES = "SELECT unnest(" + _REFERENCED + ") AS table_name FROM sql_logs"


@query("t15_table_kind", D.with_(D.LOGS) + f"""
SELECT table_name, CAST(count(*) AS BIGINT) AS n, CASE WHEN contains(upper(table_name), 'MST') THEN 'master'
  WHEN contains(upper(table_name), 'HIS') THEN 'history' WHEN contains(upper(table_name), 'INF') THEN 'information'
  WHEN contains(upper(table_name), 'TRK') THEN 'tracking' ELSE 'data' END AS kind
FROM ({_NAMES}) GROUP BY table_name""")
def t15(spark, d):
    names = derived.sql_logs(spark, d).select(F.explode(F.concat(*[
        F.regexp_extract_all(_sql(), F.lit(rf"(?i){w}\s+([A-Za-z0-9_]+)"), F.lit(1))
        for w in ("FROM", "JOIN", "INTO", "UPDATE")])).alias("table_name"))
    return names.groupBy("table_name").agg(F.count("*").alias("n")).withColumn("kind", S.table_kind(F.col("table_name")))


def rule_case(x: str) -> str:
    whens = " ".join("WHEN " + " OR ".join(f"contains({x}, '{w}')" for w in ws) + f" THEN '{text}'"
                     for ws, text in S.RULE_DESCRIPTIONS)
    return f"CASE {whens} ELSE '{S.DEFAULT_DESCRIPTION}' END"


@query("t16_rule_description", D.with_(D.LOGS) + f"""
SELECT description, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT {rule_case(D.mask('sql_text'))} AS description FROM sql_logs WHERE {D.VALID}) GROUP BY description""")
def t16(spark, d):
    rows = templates.log_templates(derived.sql_logs(spark, d))
    return rows.groupBy(S.rule_description(F.col("template_text")).alias("description")).agg(F.count("*").alias("n"))


@query("d2_literal_values", D.with_(D.LOGS, PREDICATES) + rf"""
SELECT coalesce(CASE WHEN contains(column_name, '.') THEN regexp_extract(sql_text,
    '(?:FROM|JOIN)\s+(\w+)\s+' || regexp_extract(column_name, '^([^.]*)', 1) || '\b', 1, 'i')
  ELSE regexp_extract(sql_text, '\bFROM\s+(\w+)', 1, 'i') END, '') AS table_name,
  regexp_extract(column_name, '([^.]*)$', 1) AS column_name, value, CAST(count(*) AS BIGINT) AS n
FROM predicates WHERE regexp_matches(value, '^[''0-9-]') GROUP BY 1, 2, 3""")
def d2(spark, d):
    found = predicates.literal_values(derived.sql_logs(spark, d))
    return found.withColumn("table_name", F.coalesce("table_name", F.lit("")))


_DANGER = ", ".join(f"'{w}'" for w in S.FORBIDDEN)


@query("d21_safety_check", D.with_(D.LOGS) + rf"""
SELECT sql_id, array_to_string(list_filter([
  CASE WHEN len(list_filter(string_split(bare, ';'), lambda p: trim(p) <> '')) <> 1 THEN 'not one statement' END,
  CASE WHEN NOT regexp_matches(bare, '^\s*(SELECT|WITH)\b', 'i') THEN 'not a SELECT' END], lambda x: x IS NOT NULL)
  || list_sort(list_transform(list_distinct(list_filter(regexp_extract_all(upper(bare), '(\w+)', 1),
    lambda w: w IN ({_DANGER}))), lambda w: 'forbidden ' || w)), ',') AS reasons
FROM (SELECT sql_id, regexp_replace(sql_text, '{D.STRING_LITERAL}', '''''', 'g') AS bare FROM sql_logs)""")
def d21(spark, d):
    return _logs(spark, d, F.array_join(S.safety_reasons(_sql()), ",").alias("reasons"))


@query("t21_entities_topics", f"""
SELECT lang, source, topic, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT lang, source, unnest(list_filter([{', '.join(
      f"CASE WHEN contains(lower(text), '{k}') OR contains(text, '{o}') THEN '{k}' END" for k, (o, _) in K.TOPICS.items())}],
    lambda x: x IS NOT NULL)
    || list_distinct(list_transform(regexp_extract_all(text, '(M10|M11|M14|M15|M16)', 1, 'i'), lambda w: upper(w)))
    || list_distinct({D.keywords('text')})) AS topic FROM documents)
GROUP BY lang, source, topic""")
def t21(spark, d):
    text = F.col("text")
    docs = derived.table(spark, d, "documents")
    codes = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(K.FAB_ID), F.lit(1)), lambda w: F.upper(w)))
    tags = F.concat(K.topics(text), codes, F.array_distinct(K.keywords(text)))
    return (docs.select("lang", "source", F.explode(tags).alias("topic"))
            .groupBy("lang", "source", "topic").agg(F.count("*").alias("n")))

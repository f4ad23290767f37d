"""Schema linking of the derived questions against the star-schema catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from querylode.operators import evaluation, joinability, linking as L, profile, prompts, retrieval as R
from querylode.sources import catalog, derived
from workbook import duck as D, query
from workbook.retrieval import MEANS, metrics, rounded

KW = f"""kw AS (SELECT question_id, list_sort(list_distinct({D.keywords('question')})) AS words FROM questions),
sets AS (SELECT md5(array_to_string(words, ' ')) AS set_id, any_value(words) AS words FROM kw GROUP BY 1),
qs AS (SELECT question_id, md5(array_to_string(words, ' ')) AS set_id FROM kw),
sw AS (SELECT set_id, unnest(words) AS keyword FROM sets)"""
ALL_TABLES = "cells AS (SELECT set_id, table_name, pos FROM sets, cat_tables)"
EDGES = """names AS (SELECT table_name, stem AS name, bool_or(is_pk OR is_fk) AS keyed FROM cat_columns GROUP BY ALL),
edges AS (SELECT table_a, table_b, join_columns, common::DOUBLE / (na.n + nb.n - common) AS jaccard, CASE WHEN keyed THEN 'pk_fk' ELSE 'common_column' END AS join_type
  FROM (SELECT a.table_name AS table_a, b.table_name AS table_b, count(*) AS common, list_sort(list(a.name)) AS join_columns, bool_or(a.keyed OR b.keyed) AS keyed
    FROM names a JOIN names b ON a.name = b.name AND a.table_name < b.table_name GROUP BY ALL)
  JOIN (SELECT table_name AS table_a, count(*) AS n FROM names GROUP BY 1) na USING (table_a) JOIN (SELECT table_name AS table_b, count(*) AS n FROM names GROUP BY 1) nb USING (table_b)),
around AS (SELECT table_a AS table_name, table_b AS other, join_columns, jaccard + CASE WHEN join_type = 'pk_fk' THEN 0.3 ELSE 0 END AS score FROM edges
  UNION ALL SELECT table_b, table_a, join_columns, jaccard + CASE WHEN join_type = 'pk_fk' THEN 0.3 ELSE 0 END FROM edges)"""


def hits(words: str, weights: dict[str, int], name: str = "points", divisor: int = 100, cap: bool = True) -> str:
    texts = {"name": ("table_name", "cat_tables"), "upper_name": ("table_name", "cat_tables"), "description": ("description", "cat_tables"),
             "about": ("description || ' ' || purpose", "cat_tables"), "text": ("table_name || ' ' || description || ' ' || purpose", "cat_tables"),
             "column": ("column_name", "cat_columns"), "column_about": ("description", "cat_columns")}
    parts = " UNION ALL ".join(f"SELECT table_name, lower({texts[f][0]}) AS text, {w} AS w FROM {texts[f][1]}" for f, w in weights.items())
    score = f"sum(w) / {divisor}.0"
    return f"""{name} AS (SELECT set_id, table_name, CAST({f'least({score}, 1.0)' if cap else score} AS DOUBLE) AS score
  FROM (SELECT DISTINCT set_id, keyword FROM {words}) JOIN ({parts}) f ON contains(f.text, lower(keyword)) GROUP BY set_id, table_name)"""


def scored(source: str = "points", extra: str = "0", name: str = "scores") -> str:
    return f"{name} AS (SELECT c.*, coalesce(p.score, 0) + {extra} AS score FROM cells c LEFT JOIN {source} p USING (set_id, table_name))"


def best(k: int, source: str = "scores", name: str = "best") -> str:
    return f"""{name} AS (SELECT * FROM (SELECT set_id, table_name, score, CAST(row_number() OVER (PARTITION BY set_id ORDER BY round(score, 9) DESC, pos) AS INTEGER) AS rank
  FROM {source}) WHERE rank <= {k})"""


OUT = "SELECT question_id, table_name, rank, round(score, 6) AS score FROM qs JOIN best USING (set_id)"
BASE = (D.QUESTIONS, D.CATALOG, KW, ALL_TABLES)


def _out(df):
    return df.select("question_id", "table_name", "rank", F.round("score", 6).alias("score"))


def _inputs(spark, d):
    columns = catalog.star_columns(spark, d)
    return derived.questions(spark, d), catalog.star_tables(spark), columns.select("table_name", "column_name", F.coalesce("description", F.lit("")).alias("description"), "pos")


def _edges(spark, d):
    return joinability.edges(joinability.shared_names(catalog.star_columns(spark, d)))


SYNONYMS = """synonyms AS (SELECT DISTINCT keyword, unnest([term, korean_name]) AS synonym FROM (SELECT DISTINCT keyword FROM sw)
  JOIN (SELECT DISTINCT term, korean_name, description FROM glossary) ON contains(lower(term), lower(keyword)) OR contains(korean_name, lower(keyword)) OR contains(description, lower(keyword))),
fw AS (SELECT set_id, keyword FROM sw UNION SELECT set_id, synonym FROM sw JOIN synonyms USING (keyword))"""
EXPANSIONS = """expansions AS (SELECT keyword, arg_max(term, pos) AS synonym FROM (SELECT DISTINCT keyword FROM sw) JOIN glossary ON korean_name = keyword GROUP BY keyword
  UNION SELECT keyword, term FROM (SELECT DISTINCT keyword FROM sw) JOIN (SELECT arg_max(term, pos) AS term, arg_max(description, pos) AS description FROM glossary GROUP BY lower(term))
    ON contains(term, lower(keyword)) OR contains(lower(description), lower(keyword))),
rw AS (SELECT set_id, keyword FROM sw UNION SELECT set_id, synonym FROM sw JOIN expansions USING (keyword))"""


@query("j1_synonyms", D.with_(*BASE, D.GLOSSARY, SYNONYMS) + "SELECT keyword, synonym FROM synonyms")
def j1(spark, d):
    words = L.distinct_sets(L.keyword_sets(derived.questions(spark, d)))
    return L.synonyms(words, derived.glossary(spark, d))


@query("j2_query_expansion", D.with_(*BASE, D.GLOSSARY, EXPANSIONS) + "SELECT keyword, synonym FROM expansions")
def j2(spark, d):
    words = L.distinct_sets(L.keyword_sets(derived.questions(spark, d)))
    return L.expansions(words, derived.glossary(spark, d))


@query("j3_match_scores", D.with_(*BASE, hits("sw", L.FORWARD)) + "SELECT question_id, table_name, round(score, 6) AS score FROM qs JOIN points USING (set_id)")
def j3(spark, d):
    questions, tables, columns = _inputs(spark, d)
    sets = L.keyword_sets(questions)
    scores = L.match_scores(L.distinct_sets(sets), tables, columns, L.FORWARD)
    return L.per_question(sets, scores).withColumn("score", F.round("score", 6))


SIMILAR = f"""words AS (SELECT DISTINCT keyword FROM {{words}}),
texts AS (SELECT sql_id, lower(sql_text) AS text, {D.bare_tables('sql_text')} AS tables FROM sql_logs),
found AS (SELECT keyword, sql_id FROM words JOIN texts ON contains(text, lower(keyword)) QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY sql_id) <= 3),
firsts AS (SELECT set_id, sql_id FROM (SELECT DISTINCT set_id, sql_id FROM {{words}} JOIN found USING (keyword))
  QUALIFY row_number() OVER (PARTITION BY set_id ORDER BY sql_id) <= 3),
alike AS (SELECT set_id, sql_id, tables FROM firsts JOIN texts USING (sql_id))"""


@query("j7_similar_logs", D.with_(*BASE, D.LOGS, SIMILAR.replace("{words}", "sw")) + "SELECT set_id, sql_id, array_to_string(tables, ',') AS tables FROM alike")
def j7(spark, d):
    words = L.distinct_sets(L.keyword_sets(derived.questions(spark, d)))
    return L.similar_logs(words, derived.sql_logs(spark, d)).select(F.lower(F.hex("set_id")).alias("set_id"), "sql_id", F.array_join("tables", ",").alias("tables"))


@query("l2_forward", D.with_(*BASE, D.GLOSSARY, SYNONYMS, hits("fw", L.FORWARD), scored(), best(5)) + OUT)
def l2(spark, d):
    questions, tables, columns = _inputs(spark, d)
    return _out(L.link_forward(questions, tables, columns, derived.glossary(spark, d)))


def draft(name: str, cells: str) -> str:
    """Main table and joined tables of the draft statement."""
    return f"""{name}_m AS (SELECT set_id, table_name, pos, row_number() OVER (PARTITION BY set_id ORDER BY hit DESC, pos) AS place, hit
  FROM (SELECT c.set_id, c.table_name, c.pos, CASE WHEN s.table_name IS NULL THEN 0 ELSE 1 END AS hit FROM {cells} c LEFT JOIN seed s USING (set_id, table_name))),
{name}_c AS (SELECT m.*, f.table_name AS main FROM {name}_m m JOIN {name}_m f ON f.set_id = m.set_id AND f.place = 1 WHERE m.place <= 3 AND (m.hit = 1 OR m.place = 1)),
{name} AS (SELECT c.set_id, c.table_name, c.place, c.main, a.join_columns[1] AS join_column FROM {name}_c c LEFT JOIN around a ON a.table_name = c.main AND a.other = c.table_name
  WHERE c.place = 1 OR a.other IS NOT NULL)"""


@query("l3_draft_sql", D.with_(*BASE, EDGES, hits("sw", L.SEEDS, "seed"), draft("d1", "cells")) + """
SELECT question_id, 'SELECT ' || cols || ' FROM ' || main || joins AS sql_text FROM qs JOIN (
  SELECT set_id, main, string_agg(CASE WHEN place = 1 THEN '' ELSE ' JOIN ' || table_name || ' ON ' || main || '.' || join_column || ' = ' || table_name || '.' || join_column END, '' ORDER BY place) AS joins
  FROM d1 GROUP BY set_id, main) USING (set_id)
JOIN (SELECT table_name AS main, string_agg(column_name, ', ' ORDER BY pos) AS cols FROM cat_columns WHERE pos <= 5 GROUP BY 1) USING (main)""")
def l3(spark, d):
    questions, tables, columns = _inputs(spark, d)
    sets = L.keyword_sets(questions)
    drafts = L.draft_tables(L.distinct_sets(sets), sets, tables, _edges(spark, d))
    return L.per_question(sets, L.draft_sql(drafts, columns)).select("question_id", "sql_text")


BIDIRECTIONAL = (hits("fw", L.FORWARD), scored(name="forward"), EDGES, hits("sw", L.SEEDS, "seed"), draft("d1", "cells"))
_MIXED = "mixed AS (SELECT f.set_id, f.table_name, f.pos, {w} * f.score + {v} * CASE WHEN d.table_name IS NULL THEN 0 ELSE 1 END AS score FROM forward f LEFT JOIN d1 d USING (set_id, table_name))"
_REFINED = (best(7, "mixed", "seven"), "picked AS (SELECT c.* FROM cells c SEMI JOIN seven USING (set_id, table_name))", draft("d2", "picked"),
            "scores AS (SELECT m.set_id, m.table_name, m.pos, m.score + CASE WHEN d.table_name IS NULL THEN 0 ELSE 0.2 END AS score FROM mixed m LEFT JOIN d2 d USING (set_id, table_name))")


def mixed(w: float) -> str:
    return _MIXED.replace("{w}", str(w)).replace("{v}", str(1 - w))


@query("l4_bidirectional", D.with_(*BASE, D.GLOSSARY, SYNONYMS, *BIDIRECTIONAL, mixed(0.6), *_REFINED, best(5)) + OUT)
def l4(spark, d):
    questions, tables, columns = _inputs(spark, d)
    return _out(L.link_bidirectional(questions, tables, columns, derived.glossary(spark, d), _edges(spark, d)))


@query("l5_joinability", D.with_(*BASE, EDGES, hits("sw", L.SEEDS, cap=False), scored(name="seeded"), best(3, "seeded", "tops"), """
boost AS (SELECT t.set_id, a.other AS table_name, sum(a.score * 0.3) AS b FROM tops t JOIN around a USING (table_name) WHERE t.score > 0 OR t.rank = 1 GROUP BY ALL),
total AS (SELECT s.set_id, s.table_name, s.pos, s.score + coalesce(b, 0) AS score FROM seeded s LEFT JOIN boost USING (set_id, table_name)),
scores AS (SELECT set_id, table_name, pos, CASE WHEN max(score) OVER (PARTITION BY set_id) > 0 THEN least(score / max(score) OVER (PARTITION BY set_id), 1.0) ELSE score END AS score FROM total)""", best(5)) + OUT)
def l5(spark, d):
    questions, tables, _ = _inputs(spark, d)
    return _out(L.link_joinability(questions, tables, _edges(spark, d)))


_BONUS = """bonus AS (SELECT set_id, table_name, count(*) AS n FROM (SELECT set_id, unnest(tables) AS table_name FROM alike) GROUP BY ALL),
scores AS (SELECT c.set_id, c.table_name, c.pos, least(coalesce(p.score, 0) + 0.15 * coalesce(b.n, 0), 1.0) AS score FROM cells c
  LEFT JOIN points p USING (set_id, table_name) LEFT JOIN bonus b USING (set_id, table_name))"""


@query("l6_rag", D.with_(*BASE, D.LOGS, D.GLOSSARY, EXPANSIONS, hits("rw", L.RAG), SIMILAR.replace("{words}", "rw"), _BONUS, best(5)) + OUT)
def l6(spark, d):
    questions, tables, columns = _inputs(spark, d)
    return _out(L.link_rag(questions, tables, columns, derived.glossary(spark, d), derived.sql_logs(spark, d)))


PURPOSE = f"""known AS (SELECT table_name, list_distinct({D.keywords("(table_name || ' ' || description || ' ' || purpose)")}) AS words FROM cat_tables),
scores AS (SELECT c.set_id, c.table_name, c.pos, CAST(len(list_intersect(s.words, k.words)) AS DOUBLE) / greatest(len(s.words), 1)
  + CASE WHEN contains(upper(c.table_name), 'HIS') AND NOT contains(upper(c.table_name), 'MST') THEN 0.1 ELSE 0 END AS score
  FROM cells c JOIN sets s USING (set_id) JOIN known k USING (table_name))"""


@query("l7_purpose", D.with_(*BASE, PURPOSE, best(5)) + OUT)
def l7(spark, d):
    questions, tables, _ = _inputs(spark, d)
    return _out(L.link_purpose(questions, tables))


BINARY = (hits("sw", L.REFINED, cap=False), "scores AS (SELECT p.*, pos FROM points p JOIN cat_tables USING (table_name))", best(5, name="chosen"),
          "best AS (SELECT set_id, table_name, rank, 1 - (rank - 1) * 0.1 AS score FROM chosen)")


@query("l8_binary", D.with_(*BASE, *BINARY) + OUT.replace("round(score, 6)", "round(CAST(score AS DOUBLE), 6)"))
def l8(spark, d):
    questions, tables, _ = _inputs(spark, d)
    return _out(L.link_binary(questions, tables))


_TOPIC_WORDS = " || ".join(
    f"CASE WHEN contains(lower(question), '{n}') OR contains(question, '{o}') THEN [{', '.join(repr(w) for w in extra)}] ELSE [] END"
    for n, (o, extra) in L.K.TOPICS.items())
ENRICHED = KW.replace(f"list_sort(list_distinct({D.keywords('question')}))",
                      f"list_sort(list_distinct({D.keywords('question')} || regexp_extract_all(question, '(M10|M11|M14|M15|M16)', 1, 'i') || {_TOPIC_WORDS}))")


@query("l9_enriched", D.with_(D.QUESTIONS, D.CATALOG, ENRICHED, ALL_TABLES, hits("sw", L.ENRICHED), scored(), best(5)) + OUT)
def l9(spark, d):
    questions, tables, _ = _inputs(spark, d)
    return _out(L.link_enriched(questions, tables))


# --- table documents and the hybrid linker -----------------------------------------------------------

_SAMPLED = {"region": ["r_name"], "nation": ["n_name"], "customer": ["c_mktsegment"], "part": ["p_brand", "p_type"],
            "orders": ["o_orderstatus", "o_orderpriority"], "lineitem": ["l_returnflag", "l_linestatus"], "events": ["event_type"]}
DOCS = ("samples AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, list_slice(list_sort(list(DISTINCT {c})), 1, 5) AS samples FROM {t}"
    for t, cs in _SAMPLED.items() for c in cs) + """),
docs AS (SELECT t.table_name, t.pos, t.table_name || ' ' || t.description || ' ' || t.purpose || ' ' || c.cells AS document FROM cat_tables t JOIN (
  SELECT k.table_name, string_agg(k.column_name || ' ' || k.description || CASE WHEN samples IS NULL THEN '' ELSE ' ' || array_to_string(samples, ' ') END, ' ' ORDER BY pos) AS cells
  FROM cat_columns k LEFT JOIN samples s USING (table_name, column_name) GROUP BY k.table_name) c USING (table_name))""")


def table_documents(spark, d):
    samples = None
    for t, cs in _SAMPLED.items():
        part = profile.sample_values(derived.table(spark, d, t), 5, cs).withColumn("table_name", F.lit(t))
        samples = part if samples is None else samples.unionByName(part)
    _, tables, columns = _inputs(spark, d)
    return prompts.search_documents(tables, columns.join(samples, ["table_name", "column_name"], "left"))


@query("t20_table_documents", D.with_(D.CATALOG, DOCS) + "SELECT table_name, pos, document FROM docs")
def t20(spark, d):
    return table_documents(spark, d)


HYBRID = f"""dq AS (SELECT md5(question) AS set_id, any_value(question) AS question FROM questions GROUP BY 1),
sets AS (SELECT set_id FROM dq), qs AS (SELECT question_id, md5(question) AS set_id FROM questions),
tokens AS (SELECT table_name AS doc, {D.tokens('document')} AS t FROM docs),
post AS (SELECT doc, length, term, count(*) AS tf FROM (SELECT doc, len(t) AS length, unnest(t) AS term FROM tokens) GROUP BY ALL),
corpus AS (SELECT count(*) AS n, CAST(sum(len(t)) AS DOUBLE) / count(*) AS mean_length FROM tokens),
freq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
terms AS (SELECT query, term, count(*) AS qtf FROM (SELECT set_id AS query, unnest({D.tokens('question')}) AS term FROM dq) GROUP BY ALL)"""


def _hybrid_cte(w: float) -> tuple:
    from workbook.retrieval import BM25, TFIDF, fused
    return (D.QUESTIONS, D.CATALOG, DOCS, HYBRID, ALL_TABLES, TFIDF, BM25, fused(w),
            "points AS (SELECT query AS set_id, doc AS table_name, score FROM fused)")


_RERANK = (f"sw AS (SELECT set_id, unnest(list_distinct({D.keywords('question')})) AS keyword FROM dq)", hits("sw", L.BOOST, "boost", cap=False),
           "scores AS (SELECT c.*, least(coalesce(p.score, 0) + coalesce(b.score, 0), 1.0) AS score FROM cells c LEFT JOIN points p USING (set_id, table_name) LEFT JOIN boost b USING (set_id, table_name))")


@query("l1_hybrid", D.with_(*_hybrid_cte(0.7), scored(), best(5)) + OUT)
def l1(spark, d):
    questions, tables, _ = _inputs(spark, d)
    return _out(L.link_hybrid(questions, tables, table_documents(spark, d)))


@query("r5_hybrid_reranked", D.with_(*_hybrid_cte(0.7), *_RERANK, best(5)) + OUT)
def r5(spark, d):
    questions, tables, _ = _inputs(spark, d)
    return _out(L.link_hybrid(questions, tables, table_documents(spark, d), use_rerank=True))


# --- comparison of strategies --------------------------------------------------------------------------

_ITEMS = "items AS (SELECT question_id FROM questions)"


def _run(name: str, *ctes: str) -> str:
    rank = "ranked AS (SELECT question_id, table_name, rank FROM qs JOIN best USING (set_id))"
    return f"SELECT '{name}' AS config, * FROM (" + D.with_(*ctes, rank, D.TRUTH, _ITEMS, metrics("question_id", "items", item="table_name")) + f"SELECT {MEANS} FROM scored)"


@query("e2_strategy_sweep", "\nUNION ALL ".join([
    _run("forward", *BASE, D.GLOSSARY, SYNONYMS, hits("fw", L.FORWARD), scored(), best(5)),
    _run("backward", *BASE, D.GLOSSARY, SYNONYMS, *BIDIRECTIONAL, mixed(0.0), best(5, "mixed")),
    _run("bidirectional", *BASE, D.GLOSSARY, SYNONYMS, *BIDIRECTIONAL, mixed(0.6), best(5, "mixed")),
    _run("purpose", *BASE, PURPOSE, best(5)), _run("binary", *BASE, *BINARY),
    _run("enriched", D.QUESTIONS, D.CATALOG, ENRICHED, ALL_TABLES, hits("sw", L.ENRICHED), scored(), best(5)),
    _run("rag none", *BASE, hits("sw", L.RAG), scored(), best(5)),
]))
def e2(spark, d):
    questions, tables, columns = _inputs(spark, d)
    glossary, edges, shared = derived.glossary(spark, d), _edges(spark, d), L.Shared()
    runs = {
        "forward": L.link_forward(questions, tables, columns, glossary, shared=shared),
        "backward": L.link_bidirectional(questions, tables, columns, glossary, edges, 0.0, refine=False, shared=shared),
        "bidirectional": L.link_bidirectional(questions, tables, columns, glossary, edges, 0.6, refine=False, shared=shared),
        "purpose": L.link_purpose(questions, tables, shared=shared), "binary": L.link_binary(questions, tables, shared=shared),
        "enriched": L.link_enriched(questions, tables), "rag none": L.link_rag(questions, tables, columns, shared=shared),
    }
    return rounded(evaluation.sweep(runs, questions, derived.question_truth(spark, d), "question_id", "table_name"))

"""Assembled answers: context for a question, glossary search, log search."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from querylode.functions import sqltext as S
from querylode.functions import tokens as K
from querylode.operators import retrieval as R
from querylode.operators.ordering import top_k
from querylode.sizing import small_side


def assemble(hits: DataFrame, templates: DataFrame, contexts: DataFrame, questions: DataFrame | None = None) -> DataFrame:
    """``query, context``: the ranked templates of each query, then the description block of each of their tables.

    ``hits`` is ``query, doc (template_id), rank``; ``contexts`` is ``table_name, context``.  At most k templates and
    their few tables meet in one row.  Of ``questions`` (query) those without a hit get an empty context.
    """
    # Few templates and tables serve all queries, so they go to the queries; these stay where the search has left them.
    rows = hits.join(small_side(templates.select(F.col("template_id").alias("doc"), "template_text", "tables")), "doc")
    texts = rows.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "template_text"))).alias("t"),
                                      F.array_distinct(F.flatten(F.collect_list("tables"))).alias("names"))
    used = texts.select("query", "t", F.explode_outer("names").alias("table_name")).join(small_side(contexts), "table_name", "left")
    block = F.when(F.col("context").isNotNull(), F.struct("table_name", "context"))
    found = used.groupBy("query").agg(F.first("t").alias("t"), F.array_sort(F.collect_list(block)).alias("c"))
    if questions is not None:
        found = questions.select("query").join(found, "query", "left")
    return found.select("query", F.concat_ws("\n", F.col("t.template_text"), F.col("c.context")).alias("context"))


def glossary_search(queries: DataFrame, query: str, text: str, glossary: DataFrame, k: int = 5) -> DataFrame:
    """``query, term, tier, rank``: entries whose term equals the whole query text first (tier 0), then text matches on
    term, name and description (tier 1) by BM25."""
    entries = glossary.groupBy("term").agg(F.max("korean_name").alias("korean_name"), F.max("description").alias("description"))
    asked = queries.select(F.col(query).alias("query"), F.col(text).alias("text"))
    exact = asked.join(entries, F.lower("text") == F.lower("term")).select("query", "term", F.lit(0).alias("tier"), F.lit(0.0).alias("score"))
    docs = entries.withColumn("all", F.concat_ws(" ", "term", "korean_name", "description"))
    found = R.bm25_search(asked, "query", "text", R.Index(docs, "term", "all"), k + 1).select(
        "query", F.col("doc").alias("term"), F.lit(1).alias("tier"), "score")
    both = exact.unionByName(found.join(exact.select("query", "term"), ["query", "term"], "left_anti"))
    return top_k(both, ["query"], [F.asc("tier"), F.desc(F.round("score", 9)), F.asc("term")], k).select("query", "term", "tier", "rank")


def log_search(queries: DataFrame, query: str, text: str, templates: DataFrame, k: int = 5, kind: str | None = None) -> DataFrame:
    """``query, template_id, exec_count, rank``: templates matching any token of the query, most executed first.

    ``kind`` keeps only statements of one class (a tag filter).
    """
    rows = templates if kind is None else templates.filter(S.operation(F.col("template_text")) == kind)
    words = rows.select("template_id", "exec_count", F.explode(F.array_distinct(K.search_tokens(F.col("template_text")))).alias("word"))
    asked = queries.select(F.col(query).alias("query"), F.explode(F.array_distinct(K.search_tokens(F.col(text)))).alias("word"))
    # Per word only its k most executed templates can reach the result.
    best = top_k(words, ["word"], [F.desc("exec_count"), F.asc("template_id")], k).drop("rank")
    hits = asked.join(best, "word").select("query", "template_id", "exec_count").distinct()
    return top_k(hits, ["query"], [F.desc("exec_count"), F.asc("template_id")], k)

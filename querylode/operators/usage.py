"""Usage weights of tables and glossary summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from querylode.functions import sqltext as S
from querylode.operators.ordering import top_k

# Fixed value: label of terms without a category.
OTHER_CATEGORY = "기타"


def table_usage(logs: DataFrame) -> DataFrame:
    """Executions per table; a table counts once per log, a missing count is 1."""
    used = logs.select(F.explode(S.bare_tables(F.col("sql_text"))).alias("table_name"),
                       F.coalesce("exec_count", F.lit(1)).alias("n"))
    return used.groupBy("table_name").agg(F.sum("n").alias("weight"))


def glossary_categories(terms: DataFrame, first: int = 3) -> DataFrame:
    """Terms per category with the first few of each in file order."""
    terms = terms.withColumn("category", F.coalesce("category", F.lit(OTHER_CATEGORY)))
    sizes = terms.groupBy("category").agg(F.count("*").alias("n"))
    head = top_k(terms, ["category"], [F.asc("pos")], first)
    return head.join(sizes, "category").select("category", "n", "term", "korean_name", "rank")


def glossary_contains(terms: DataFrame, text: str) -> DataFrame:
    return terms.filter(F.lower("term").contains(text))

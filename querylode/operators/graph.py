"""Knowledge graph over the catalogue, the glossary and the templates, as edge rows ``src, relation, dst``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from querylode.operators.containment import contains_join
from querylode.operators.joinability import both_ways


def _edge(df: DataFrame, src: str, relation: str, dst: str) -> DataFrame:
    return df.select(F.expr(src).alias("src"), F.lit(relation).alias("relation"), F.expr(dst).alias("dst")).distinct()


def term_columns(glossary: DataFrame, columns: DataFrame) -> DataFrame:
    """``term, table_name, column_name``: columns whose description contains a term."""
    terms = glossary.select("term", F.lower("term").alias("needle")).distinct()
    texts = columns.select("table_name", "column_name", F.lower(F.coalesce("description", F.lit(""))).alias("text"))
    return contains_join(terms, "needle", texts, "text").select("term", "table_name", "column_name").distinct()


def edges(tables: DataFrame, columns: DataFrame, joins: DataFrame, glossary: DataFrame, mapped: DataFrame,
          template_tables: DataFrame, template_columns: DataFrame) -> DataFrame:
    """All relations.  ``joins`` are joinability edges; ``mapped`` is :func:`term_columns`; the last two are
    ``template_id, table_name`` and ``template_id, column_name``."""
    keyed = joins.filter("join_type = 'pk_fk'")
    parts = [
        _edge(columns.join(tables.select("table_name"), "table_name", "left_semi"), "table_name", "HAS_COLUMN",
              "concat(table_name, '.', column_name)"),
        _edge(both_ways(keyed), "table_a", "REFERENCES", "table_b"),
        _edge(keyed.withColumn("c", F.explode("join_columns")), "concat(table_a, '.', c)", "FOREIGN_KEY_TO", "concat(table_b, '.', c)"),
        _edge(mapped, "concat(table_name, '.', column_name)", "MAPS_TO", "term"),
        _edge(glossary.filter("category IS NOT NULL"), "term", "BELONGS_TO", "category"),
        _edge(template_tables, "template_id", "USES_TABLE", "table_name"),
        _edge(template_columns, "template_id", "USES_COLUMN", "column_name"),
    ]
    return reduce(DataFrame.unionByName, parts)


def related_tables(mapped: DataFrame, joins: DataFrame) -> DataFrame:
    """``term, table_name, hops``: tables of the term's columns (0) and their neighbours over one or two references."""
    step = both_ways(joins.filter("join_type = 'pk_fk'")).select("table_a", "table_b")
    start = mapped.select("term", "table_name").distinct()
    one = start.join(step, F.col("table_name") == F.col("table_a")).select("term", F.col("table_b").alias("table_name"))
    two = one.join(step, F.col("table_name") == F.col("table_a")).select("term", F.col("table_b").alias("table_name"))
    levels = [df.distinct().withColumn("hops", F.lit(i)) for i, df in enumerate((start, one, two))]
    return reduce(DataFrame.unionByName, levels).groupBy("term", "table_name").agg(F.min("hops").alias("hops"))

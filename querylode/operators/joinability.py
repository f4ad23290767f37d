"""Joinability of catalogue tables: edges, neighbours, paths and explanations.

Input columns: ``table_name, name, is_key`` (one row per column; ``name`` is the name tables share).  The catalogue is
bounded by the schema, not by the data, and edges are by definition pairs of tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from querylode.lineage import cut
from querylode.operators.ordering import first_per_key

# Fixed value: bonus for a shared key column.
KEY_BONUS = 0.3


def shared_names(columns: DataFrame, name: str = "stem") -> DataFrame:
    """Catalogue columns in the shape the edge operators take."""
    key = F.col("is_primary_key") | F.col("is_foreign_key")
    return columns.groupBy("table_name", F.col(name).alias("name")).agg(F.max(key).alias("is_key"))


def edges(columns: DataFrame) -> DataFrame:
    """``table_a < table_b`` with shared columns, their Jaccard share, and the join type."""
    sizes = columns.groupBy("table_name").agg(F.count("*").alias("n"))
    a = columns.select(F.col("table_name").alias("table_a"), "name", F.col("is_key").alias("key_a"))
    b = columns.select(F.col("table_name").alias("table_b"), "name", F.col("is_key").alias("key_b"))
    pairs = (a.join(b, "name").filter("table_a < table_b").groupBy("table_a", "table_b")
             .agg(F.count("*").alias("common"), F.array_sort(F.collect_set("name")).alias("join_columns"),
                  F.max(F.col("key_a") | F.col("key_b")).alias("keyed")))
    pairs = (pairs.join(sizes.select(F.col("table_name").alias("table_a"), F.col("n").alias("n_a")), "table_a")
             .join(sizes.select(F.col("table_name").alias("table_b"), F.col("n").alias("n_b")), "table_b"))
    return pairs.select(
        "table_a", "table_b", "join_columns",
        (F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common"))).alias("jaccard"),
        F.when(F.col("keyed"), "pk_fk").otherwise("common_column").alias("join_type"))


def both_ways(edge: DataFrame) -> DataFrame:
    swapped = edge.select(F.col("table_b").alias("table_a"), F.col("table_a").alias("table_b"),
                          *[c for c in edge.columns if c not in ("table_a", "table_b")])
    return edge.unionByName(swapped)


def neighbours(edge: DataFrame, min_score: float = 0.0) -> DataFrame:
    """``table_name, other, score`` in both directions: Jaccard plus the key bonus, at least ``min_score``."""
    score = F.col("jaccard") + F.when(F.col("join_type") == "pk_fk", KEY_BONUS).otherwise(0.0)
    rows = both_ways(edge).select(F.col("table_a").alias("table_name"), F.col("table_b").alias("other"),
                                  score.alias("score"))
    return rows.filter(F.col("score") >= min_score)


def paths(edge: DataFrame, sources: DataFrame) -> DataFrame:
    """Shortest join path from each source table to every table it reaches: ``source, target, path``.

    Breadth first for all sources at once; among equally short paths the lexically smallest.  A source
    reaches itself with a path of one table; no row means no path.
    """
    steps = both_ways(edge).select("table_a", "table_b")
    frontier = sources.select(F.col("table_name").alias("source"), F.col("table_name").alias("target"),
                              F.array("table_name").alias("path")).distinct()
    visited = frontier = cut(frontier)
    while True:
        reached = (frontier.join(steps, frontier["target"] == steps["table_a"])
                   .select("source", F.col("table_b").alias("target"), F.concat("path", F.array("table_b")).alias("path")))
        fresh = reached.join(visited, ["source", "target"], "left_anti")
        frontier = cut(first_per_key(fresh, ["source", "target"], "path"))
        if frontier.isEmpty():
            return visited
        visited = cut(visited.unionByName(frontier))


def explain(edge: DataFrame, selection: DataFrame, key: str = "query_id") -> DataFrame:
    """Edges inside each selection of tables; a selection is a short ranked list, so its pairs are few."""
    a = selection.select(key, F.col("table_name").alias("table_a"))
    b = selection.select(key, F.col("table_name").alias("table_b"))
    return a.join(b, key).filter("table_a < table_b").join(edge, ["table_a", "table_b"])

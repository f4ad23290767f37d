"""Exact duplicates by canonical hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from querylode.functions import sqltext as S
from querylode.lineage import stored
from querylode.sizing import weighted_join


def canonical_groups(logs: DataFrame) -> DataFrame:
    """One row per canonical hash: representative text, first sql_id, copies, executions."""
    hashed = logs.withColumn("canonical", S.canonical(F.col("sql_text")))
    groups = hashed.groupBy("canonical").agg(F.min("sql_id").alias("first_sql_id"), F.count("*").alias("copies"),
                                             F.sum("exec_count").alias("exec_count"))
    return groups.withColumn("canonical_hash", F.sha2("canonical", 256))


def canonical_duplicates(logs: DataFrame) -> DataFrame:
    """Every log with its canonical hash, the first log of its group and the group size.

    The group side has one row per hash; logs of a hot hash are spread over as many tasks as they need.
    """
    hashed = logs.withColumn("canonical_hash", S.canonical_hash(F.col("sql_text")))
    groups = hashed.groupBy("canonical_hash").agg(F.min("sql_id").alias("first_sql_id"), F.count("*").alias("copies"))
    return weighted_join(hashed, stored(groups, "canonical-groups"), ["canonical_hash"], F.col("sql_id"), "copies")

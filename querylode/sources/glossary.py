"""Glossary CSV source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "term string, korean_name string, description string, category string"
REQUIRED = ("term", "korean_name", "description")


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a CSV with a header; columns are found by name, ``category`` may be missing."""
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    if "category" not in raw.columns:
        raw = raw.withColumn("category", F.lit(None).cast("string"))
    return raw.select("term", "korean_name", "description", "category")


def split_terms(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(terms, rejects)``: rejects lack a required field."""
    ok = F.lit(True)
    for name in REQUIRED:
        ok = ok & F.col(name).isNotNull()
    missing = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in REQUIRED]))
    return rows.filter(ok), rows.filter(~ok).withColumn("missing", missing)

"""Registry and pattern files: one JSON object per file, keyed by table name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLE_REGISTRY = ("array<struct<table_name: string, schema_name: string, system_comment: string, sql_count: bigint, "
                  "first_seen_at: string, last_seen_at: string, meta_status: string, description_source: string>>")
COLUMN_REGISTRY = ("map<string, array<struct<column_name: string, data_type: string, system_comment: string, "
                   "sample_values: array<string>, statistics: struct<distinct_count: bigint, null_rate: double, "
                   "min: string, max: string, avg: double, median: double>, usage_context: map<string, bigint>>>>")
PATTERNS = ("map<string, struct<sample_sqls: array<string>, "
            "join_patterns: array<struct<target_table: string, join_column: string, join_count: bigint>>, "
            "where_patterns: array<struct<condition: string, count: bigint>>>>")
SAMPLE_ROWS = "map<string, array<map<string, string>>>"


def _parsed(texts: DataFrame, schema: str) -> DataFrame:
    return texts.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("doc"))


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def table_registry(texts: DataFrame) -> DataFrame:
    """Registered tables; a missing status is ``pending``."""
    rows = _parsed(texts, TABLE_REGISTRY).select(F.inline("doc"))
    return rows.withColumn("meta_status", F.coalesce("meta_status", F.lit("pending")))


def column_registry(texts: DataFrame) -> DataFrame:
    """Registered columns with their order inside the table; missing lists and maps are empty."""
    rows = (_parsed(texts, COLUMN_REGISTRY).select(F.explode("doc").alias("table_name", "columns"))
            .select("table_name", F.posexplode("columns").alias("pos", "c")).select("table_name", "pos", "c.*"))
    return (rows.withColumn("sample_values", F.coalesce("sample_values", F.array().cast("array<string>")))
            .withColumn("usage_context", F.coalesce("usage_context", F.create_map().cast("map<string,bigint>"))))


def sql_patterns(texts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(sample_sqls, join_patterns, where_patterns)`` in long form with their order."""
    rows = _parsed(texts, PATTERNS).select(F.explode("doc").alias("table_name", "p"))
    samples = rows.select("table_name", F.posexplode("p.sample_sqls").alias("pos", "sql_text"))
    joins = rows.select("table_name", F.posexplode("p.join_patterns").alias("pos", "j")).select("table_name", "pos", "j.*")
    wheres = rows.select("table_name", F.posexplode("p.where_patterns").alias("pos", "w")).select("table_name", "pos", "w.*")
    return samples, joins, wheres


def sample_rows(texts: DataFrame) -> DataFrame:
    """Sample records as maps; records of one table may differ in their keys."""
    rows = _parsed(texts, SAMPLE_ROWS).select(F.explode("doc").alias("table_name", "rows"))
    return rows.select("table_name", F.posexplode("rows").alias("pos", "row"))


def read_registry(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All four files of a folder."""
    samples, joins, wheres = sql_patterns(_read(spark, f"{folder}/sample_sqls_for_tables.json"))
    return {
        "tables": table_registry(_read(spark, f"{folder}/table_registry_samples.json")),
        "columns": column_registry(_read(spark, f"{folder}/column_registry_samples.json")),
        "sample_sqls": samples, "join_patterns": joins, "where_patterns": wheres,
        "sample_rows": sample_rows(_read(spark, f"{folder}/sample_table_data.json")),
    }

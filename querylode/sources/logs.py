"""Query-log sources.  Every reader returns the same columns; see ``LOG_SCHEMA``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

LOG_SCHEMA = T.StructType([
    T.StructField("sql_id", T.StringType(), False),
    T.StructField("sql_text", T.StringType(), False),
    T.StructField("exec_count", T.LongType(), False),
    T.StructField("error_count", T.LongType(), False),
    T.StructField("collected_at", T.TimestampNTZType(), False),
    T.StructField("schema_name", T.StringType(), True),
])
REQUIRED = [f.name for f in LOG_SCHEMA if not f.nullable]


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail the job on the first row that lacks a required field."""
    for name in columns:
        problem = F.raise_error(F.lit(f"log row without {name}"))
        df = df.withColumn(name, F.when(F.col(name).isNotNull(), F.col(name)).otherwise(problem))
    return df


def read_json_logs(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """JSON log files: one array per file, or one object per line (splittable; prefer it for large logs)."""
    df = spark.read.schema(LOG_SCHEMA).option("multiLine", not lines).option("mode", "FAILFAST").json(path)
    return require(df, REQUIRED)


def parse_json_logs(lines: DataFrame, column: str = "value") -> DataFrame:
    """Log rows from a column of JSON objects."""
    parsed = lines.select(F.from_json(F.col(column), LOG_SCHEMA, {"mode": "FAILFAST"}).alias("log")).select("log.*")
    return require(parsed, REQUIRED)


def collect_json_logs(logs: DataFrame, start: datetime | None = None, end: datetime | None = None,
                      limit: int | None = None, default_limit: int | None = None) -> DataFrame:
    """Logs between two full timestamps (both inclusive), most executed first; limit 0 or None is no limit."""
    if start is not None:
        logs = logs.filter(F.col("collected_at") >= F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz"))
    if end is not None:
        logs = logs.filter(F.col("collected_at") <= F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz"))
    return _ranked(logs, limit if limit is not None else default_limit)


def collect_table_logs(logs: DataFrame, start: datetime | None = None, end: datetime | None = None,
                       limit: int | None = None, default_limit: int | None = None) -> DataFrame:
    """Same from a relational table.  Bounds are cut to their day, so the end day after midnight is excluded."""
    if start is not None:
        logs = logs.filter(F.col("collected_at") >= F.lit(start.date().isoformat()).cast("timestamp_ntz"))
    if end is not None:
        logs = logs.filter(F.col("collected_at") <= F.lit(end.date().isoformat()).cast("timestamp_ntz"))
    return _ranked(logs, limit if limit is not None else default_limit)


def _ranked(logs: DataFrame, limit: int | None) -> DataFrame:
    ranked = logs.orderBy(F.desc("exec_count"), "sql_id")
    return ranked.limit(limit) if limit else ranked


def read_jdbc_logs(spark: SparkSession, url: str, table: str, properties: dict[str, str],
                   partition_column: str | None = None, bounds: tuple | None = None,
                   partitions: int = 64) -> DataFrame:
    """Relational log table; filters and top-N are pushed down, the scan is split on ``partition_column``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column and bounds:
        reader = (reader.option("partitionColumn", partition_column).option("numPartitions", partitions)
                  .option("lowerBound", bounds[0]).option("upperBound", bounds[1]))
    df = reader.load()
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA])

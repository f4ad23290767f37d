"""Sinks: vector collection, search documents, glossary, deletes, and versioned snapshots.

A snapshot table is a folder of complete versions.  A version counts once its success marker exists, so a job that dies
half-way leaves the previous version in force.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from querylode.operators.inference import HashingEmbedder, embed_udf
from querylode.operators.ordering import first_per_key

# Length limits of the vector collection, in characters.
LIMITS = {"template_text": 4000, "description": 2000, "tables": 1000, "columns": 2000}

VECTOR_SCHEMA = ("template_id string, template_text string, description string, tables string, columns string, "
                 "embedding array<float>")
SEARCH_SCHEMA = ("template_id string, template_text string, description string, tables array<string>, "
                 "columns array<string>, exec_count int")
GLOSSARY_SCHEMA = "term string, korean_name string, description string, category string"


def vector_rows(templates: DataFrame, order: str = "input_order", factory=HashingEmbedder) -> DataFrame:
    """First row per template in input order, cut to the limits, lists joined by commas, descriptions embedded."""
    first = first_per_key(templates, ["template_id"], order)
    text = {"template_text": F.col("template_text"), "description": F.col("description"),
            "tables": F.array_join("tables", ","), "columns": F.array_join("columns", ",")}
    return first.select("template_id", *[F.substring(c, 1, LIMITS[n]).alias(n) for n, c in text.items()],
                        embed_udf(factory)("description").alias("embedding"))


def upsert_last(existing: DataFrame | None, batch: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of both sides with the batch winning, and inside the batch the last row per key."""
    last = first_per_key(batch, [key], order, last=True).drop(order)
    if existing is None:
        return last
    return existing.join(last.select(key), key, "left_anti").unionByName(last)


def search_rows(templates: DataFrame, order: str = "input_order", existing: DataFrame | None = None) -> DataFrame:
    """Search documents after upserting a batch of templates by id."""
    columns = ["template_id", "template_text", "description", "tables", "columns", "exec_count"]
    batch = templates.select(*[F.col(c).cast("int") if c == "exec_count" else c for c in columns], order)
    return upsert_last(existing, batch, "template_id", order)


def glossary_rows(terms: DataFrame, order: str, existing: DataFrame | None = None) -> DataFrame:
    return upsert_last(existing, terms.select("term", "korean_name", "description", "category", order), "term", order)


def delete_ids(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose id is not listed."""
    return rows.join(ids.select(key).distinct(), key, "left_anti")


def delete_where(rows: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true (unknown keeps the row)."""
    return rows.filter(~F.coalesce(condition, F.lit(False)))


def _children(spark: SparkSession, path: str):
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, jvm, (fs.listStatus(root) if fs.exists(root) else [])


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a snapshot table, ascending."""
    fs, jvm, children = _children(spark, path)
    names = [c.getPath().getName() for c in children]
    done = [n for n in names if n.startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done)


def read_snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Latest complete version, or None."""
    found = versions(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/version={found[-1]}") if found else None


def write_snapshot(rows: DataFrame, path: str, schema: str) -> dict[str, int]:
    """Write the next version with the declared types and return the number of rows written.

    A column that does not fit the schema fails the write; ``rows`` may read the previous version.
    """
    from pyspark.sql import Observation
    from pyspark.sql.types import StructType

    spark = rows.sparkSession
    typed = rows.to(StructType.fromDDL(schema))
    seen = Observation("written")
    found = versions(spark, path)
    typed.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
        f"{path}/version={found[-1] + 1 if found else 1}")
    return {"rows": seen.get["rows"]}


def create_if_absent(spark: SparkSession, path: str, schema: str) -> bool:
    """Create an empty first version with the declared columns; False if the table exists."""
    if versions(spark, path):
        return False
    write_snapshot(spark.createDataFrame([], schema), path, schema)
    return True


def index_vectors(templates: DataFrame, path: str, factory=HashingEmbedder) -> int:
    """Append a batch to the vector collection; an empty batch writes nothing.  Returns the rows added."""
    if templates.isEmpty():
        return 0
    spark = templates.sparkSession
    rows = vector_rows(templates, factory=factory)
    existing = read_snapshot(spark, path, VECTOR_SCHEMA)
    before = existing.count() if existing is not None else 0
    total = write_snapshot(rows if existing is None else existing.unionByName(rows), path, VECTOR_SCHEMA)["rows"]
    return total - before


def index_search(templates: DataFrame, path: str) -> tuple[int, list]:
    """Upsert a batch into the search documents: ``(rows accepted, errors)``; failures of the write are returned."""
    if templates.isEmpty():
        return 0, []
    spark = templates.sparkSession
    try:
        write_snapshot(search_rows(templates, existing=read_snapshot(spark, path, SEARCH_SCHEMA)), path, SEARCH_SCHEMA)
    except Exception as e:  # a bulk write reports its errors instead of raising
        return 0, [{"error": str(e)}]
    return templates.count(), []


def delete_from(spark: SparkSession, path: str, schema: str, keep) -> int:
    """Write a version without the deleted rows; ``keep`` maps the rows to those that stay.  Returns the count."""
    rows = read_snapshot(spark, path, schema)
    if rows is None:
        return 0
    return rows.count() - write_snapshot(keep(rows), path, schema)["rows"]

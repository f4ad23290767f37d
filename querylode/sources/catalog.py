"""Schema catalogue: table and column metadata, comments, and the linking catalogue of the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from querylode.sources.derived import table

# Description and purpose of the star-schema tables, in catalogue order.
TABLE_NOTES = (
    ("region", "Sales region names", "Groups nations into a region for reporting"),
    ("nation", "Nations and their region", "Maps customers and suppliers to a nation"),
    ("customer", "Customer master data", "Account balance and market segment of every customer"),
    ("supplier", "Supplier master data", "Account balance of every supplier"),
    ("part", "Part catalogue", "Brand, type, size and retail price of every part"),
    ("orders", "Customer orders", "Total price, date and priority of every order"),
    ("lineitem", "Order line history", "Quantity, price, discount and ship date of every line"),
    ("events", "User event tracking", "Clicks, views and purchases of every user"),
)

# Column, description, key role (P primary, F foreign).
COLUMN_NOTES = {
    "region": (("r_regionkey", "region key", "P"), ("r_name", "region name", "")),
    "nation": (("n_nationkey", "nation key", "P"), ("n_name", "nation name", ""), ("n_regionkey", "region key", "F")),
    "customer": (("c_custkey", "customer key", "P"), ("c_name", "customer name", ""),
                 ("c_nationkey", "nation key", "F"), ("c_acctbal", "account balance", ""),
                 ("c_mktsegment", "market segment", "")),
    "supplier": (("s_suppkey", "supplier key", "P"), ("s_name", "supplier name", ""),
                 ("s_nationkey", "nation key", "F"), ("s_acctbal", "account balance", "")),
    "part": (("p_partkey", "part key", "P"), ("p_name", "part name", ""), ("p_brand", "brand", ""),
             ("p_type", "type", ""), ("p_size", "size", ""), ("p_retailprice", "retail price", "")),
    "orders": (("o_orderkey", "order key", "P"), ("o_custkey", "customer key", "F"), ("o_orderstatus", "", ""),
               ("o_totalprice", "total price", ""), ("o_orderdate", "order date", ""),
               ("o_orderpriority", "PRIO", "")),
    "lineitem": (("l_orderkey", "order key", "F"), ("l_partkey", "part key", "F"), ("l_suppkey", "supplier key", "F"),
                 ("l_linenumber", "line", ""), ("l_quantity", "quantity", ""), ("l_extendedprice", "price", ""),
                 ("l_discount", "discount", ""), ("l_tax", "tax", ""), ("l_returnflag", "return flag", ""),
                 ("l_linestatus", "", ""), ("l_shipdate", "ship date", "")),
    "events": (("event_id", "event key", "P"), ("ts", "event time", ""), ("user_id", "customer key", ""),
               ("event_type", "event type", ""), ("value", "value", ""), ("props", "JSON", "")),
}


def table_metadata(tables_meta: DataFrame, comments: DataFrame) -> DataFrame:
    """Table rows with their comment, all tables at once."""
    return tables_meta.join(comments, "table_name", "left")


def column_metadata(columns_meta: DataFrame, comments: DataFrame) -> DataFrame:
    """Column rows with their comment; ``nullable`` turns from Y/N into a boolean."""
    return (columns_meta.withColumn("nullable", F.col("nullable") == "Y")
            .join(comments, ["table_name", "column_name"], "left"))


def session_catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Columns of all tables of the session catalogue in the shape of ``columns_meta``."""
    schema = "table_name string, column_name string, data_type string, nullable string, column_id int"
    rows = [(t.name, c.name, c.dataType, "Y" if c.nullable else "N", i)
            for t in spark.catalog.listTables(database)
            for i, c in enumerate(spark.catalog.listColumns(t.name), 1)]
    return spark.createDataFrame(rows, schema)


def star_tables(spark: SparkSession) -> DataFrame:
    """``table_name, description, purpose, pos`` of the star schema."""
    rows = [(n, d, p, i) for i, (n, d, p) in enumerate(TABLE_NOTES, 1)]
    return spark.createDataFrame(rows, "table_name string, description string, purpose string, pos int")


def star_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns found in the files, annotated: ``table_name, column_name, stem, data_type, description,
    is_primary_key, is_foreign_key, pos``.  The stem after the prefix (``custkey``) is the shared name."""
    rows = []
    for name, _, _ in TABLE_NOTES:
        notes = {c: (text, key) for c, text, key in COLUMN_NOTES[name]}
        prefixed = name != "events"
        for i, field in enumerate(table(spark, sf_dir, name).schema, 1):
            text, key = notes.get(field.name, (None, ""))
            stem = field.name.split("_", 1)[1] if prefixed else field.name
            rows.append((name, field.name, stem, field.dataType.simpleString(), text, key == "P", key == "F", i))
    return spark.createDataFrame(rows, T.StructType.fromDDL(
        "table_name string, column_name string, stem string, data_type string, description string, "
        "is_primary_key boolean, is_foreign_key boolean, pos int"))


def star_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``table_name, num_rows`` counted over the files."""
    counts = [table(spark, sf_dir, n).agg(F.count("*").alias("num_rows")).select(F.lit(n).alias("table_name"), "num_rows")
              for n, _, _ in TABLE_NOTES]
    return reduce(DataFrame.unionByName, counts)

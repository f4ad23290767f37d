"""Exact copies: group by a 128-bit content hash, compare the bytes inside groups, keep the smallest id.

The comparison is part of the grouping: rows are grouped by (hash, text), which Spark decides byte by byte, and partial aggregation
leaves one row per text and task, so that a group with a third of all rows costs no more than any other. Hash values that turn out
to hold several texts are told apart by the text itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from querylode import lineage, sizing
from querylode.llm import common


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, common.SPACES, " ")


def exact_dedup(docs: DataFrame, hashed: Callable[[Column], Column] = content_hash, row: Column | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, row, keep_id, group_size, kept, text_sha256.

    Null texts count as empty and join the group of the empty text. Of rows that repeat a doc_id as well, one stays; which one
    does not matter, since both are the same. ``row`` tells such rows apart: a number, unless the caller has a key of its own, by which
    equal rows are kept or dropped together. A null doc_id ranks before all others. Other columns of ``docs`` are ignored. An empty
    table gives an empty result.
    """
    row = F.monotonically_increasing_id() if row is None else row
    rows = docs.select("doc_id", row.alias("row"), normalised(common.text_of()).alias("norm"))
    rows = rows.select("doc_id", "row", "norm", hashed(F.col("norm")).alias("hash"))
    ids = lineage.stored(rows.select("doc_id", "row", "hash"), "content-hashes")
    texts = rows.groupBy("hash", "norm").agg(F.min(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
    texts = texts.withColumn("text_sha256", F.sha2(F.encode("norm", "UTF-8"), 256))
    found = texts.groupBy("hash").agg(
        F.count("*").alias("n_texts"), F.sum("group_size").alias("group_size"), F.first("text_sha256").alias("text_sha256"))
    keep = ids.groupBy("hash").agg(F.min(F.struct("doc_id", "row")).alias("keep"))
    groups = lineage.stored(found.join(keep, "hash"), "exact-groups")
    collided = groups.where("n_texts > 1").select("hash")
    out = ids.join(groups.where("n_texts = 1").drop("n_texts"), "hash")
    if not collided.isEmpty():  # then these hashes are decided by (hash, text)
        own = texts.join(collided, "hash", "left_semi")
        out = out.unionByName(rows.join(own, ["hash", "norm"]).drop("norm"))
    return out.select(
        "doc_id", "row", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that repeat an earlier text; all columns stay. Of rows that repeat doc_id and text one stays, of rows
    that repeat doc_id and normalised text the one of least text hash.

    Rows are told apart by the hash of doc_id and text, so that the table need not be numbered and stored; what goes, and which kept
    rows are repeated, are small tables in most corpora, and texts move only where they are not.
    """
    key = F.xxhash64(F.col("doc_id"), common.text_of())
    with lineage.scratch(docs.sparkSession) as keep:
        judged = exact_dedup(docs.select("doc_id", "text"), row=key)
        rows = keep(judged.groupBy(F.col("row").alias("_key"), F.col("doc_id").alias("_id"), "kept").agg(F.count("*").alias("n")).where("not kept or n > 1"), "copies")
    mine = [F.col("_key"), F.col("_id")]
    left = docs.select(F.struct(*docs.columns).alias("doc"), key.alias("key"), F.col("doc_id").alias("id"))
    same = (F.col("key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id"))
    gone, twice = sizing.small_side(rows.where("not kept").select(*mine)), sizing.small_side(rows.where("kept").select(*mine))
    left = left.join(gone, same, "left_anti")
    once = left.join(twice, same, "left_anti").select("doc.*")
    if rows.where("kept").isEmpty():
        return once
    several = left.join(twice, same, "left_semi").dropDuplicates(["key", "id"])
    return once.unionByName(several.select("doc.*"))

"""From raw documents to packed sequences: stages applied in order, each written and read again.

Every stage but the last returns the columns of ``documents`` and works on all that its predecessor kept. What a stage stores on its way
goes before it returns; its result rests on its input and on a small table of decisions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from querylode import lineage
from querylode.llm import common, exact_dedup, mixing, ngram_join, packing, queries, toxicity


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more for toxicity go; the labels teach the score."""
    return toxicity.drop_toxic(docs, common.table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, the one of smallest doc_id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles at a similarity of 0.8, linked in any number of steps."""
    return ngram_join.keep_one(docs, size=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them: not at all, once or twice."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences; a document drawn twice is packed twice."""
    return packing.pack_documents(docs, queries.vocabulary(), end=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("mixing", mixed),
    ("packing", packed),
]
#: Trained scores, tokenisation and seeded draws are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out, path = stage(spark, docs, sf_dir), f"{lineage.shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

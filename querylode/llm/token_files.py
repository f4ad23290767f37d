"""Token ids in binary files: documents in ascending doc_id order, ids in patched frame-of-reference blocks.

A table of segments holds the files: every row is a run of whole documents of one range of doc_ids, with their ids packed by
``frames`` in ``ids``. Spark's writer commits the files, so a lost task leaves nothing half written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from querylode import sizing
from querylode.llm import common, encoding, frames

#: Ids in a segment before it is closed (a document is never cut).
SEGMENT_IDS = 1 << 18
SEGMENT = "part int, segment int, start long, doc_ids array<long>, sizes array<int>, ids binary"
_ARROW = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("sizes", pa.list_(pa.int32())), ("ids", pa.binary())])


def _segments(tokenizer: str, end: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, coder = TaskContext.get().partitionId(), encoding.encoder(tokenizer)
        segment = start = 0
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for first, texts in encoding.slices(batch.column("text")):
                ids, offsets = coder.encode(texts, end)
                at = 0
                while at < len(texts):
                    stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SEGMENT_IDS)))
                    stop = min(stop, len(texts))
                    run = ids[offsets[at] : offsets[stop]]
                    row = (part, segment, start, doc_ids[first + at : first + stop],
                           np.diff(offsets[at : stop + 1]).tolist(), frames.encode(run))
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)
                    segment, start, at = segment + 1, start + len(run), stop

    return encode


def write(docs: DataFrame, path: str, tokenizer: str, end: int = 2) -> None:
    """Encode every whole text of ``docs`` (doc_id, text; null text: empty) and append ``end`` to each document.

    Rows with the same doc_id stand side by side, a null doc_id stands first. An empty table writes an empty table.
    """
    rows = docs.select(F.col("doc_id").cast("long"), common.text_of().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(_segments(tokenizer, end), SEGMENT).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, sizes = frames.decode(row["ids"]), np.array(row["sizes"], np.int64)
            ends = np.cumsum(sizes)
            crc = [encoding.checksum(ids[e - n : e]) for e, n in zip(ends, sizes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - sizes, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start`` counted over all files; the files' sizes are summed, one row each."""
    rows = spark.read.schema(SEGMENT).parquet(path)
    in_part = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)
    parts = rows.select("part", in_part.alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = sizing.small_side(parts.select("part", F.coalesce(before, F.lit(0)).alias("before")))
    return rows.join(parts, "part").withColumn("start", F.col("before") + F.col("start")).drop("before")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""
    return segments(spark, path).select("doc_ids", "sizes", "start", "ids").mapInArrow(
        _documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, ends = frames.decode(row["ids"]), np.cumsum(row["sizes"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(np.split(ids.astype(np.int32), ends[:-1]), pa.list_(pa.int32()))],
                names=["doc_id", "ids"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids of every document."""
    return spark.read.schema(SEGMENT).parquet(path).select("doc_ids", "sizes", "ids").mapInArrow(_ids, "doc_id long, ids array<int>")

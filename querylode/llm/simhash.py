"""SimHash near duplicates: fingerprints at few differing bits, found through codewords of the Golay code near their segments.

A fingerprint of 64 bits has three segments. Of two differing bits at most, one segment sees none, and of the next segment both sides
have a codeword in common. A key is therefore a segment as it is and a codeword near the next one, 33 bits and at most six a segment.

Buckets of few fingerprints are compared pair by pair. In larger ones every fingerprint names the 65 words within one bit of it: two
fingerprints name a word in common exactly if they differ in two bits or less, so all that name it are linked to the least of them,
without pairs. Both ways are exact, and neither gives more than 65 rows per fingerprint and key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from querylode import lineage, sizing
from querylode.llm import common, encoding, golay
from querylode.operators import neardup

BITS, DISTANCE, SEED = 64, 2, 42
#: First bit and width of the segments; the code takes 23 bits, the missing ones are zero.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Buckets up to this size are compared pair by pair: as many pairs a member as the other way has words.
SMALL = BITS + 1


def _fingerprint(text: str, size: int) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z, and the six space characters
    if not words:
        return 0
    line = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(length + 1) - 1
    starts = ends - length
    n = max(1, len(words) - size + 1)
    digest = xxhash.xxh64_intdigest
    last = ends[min(size, len(words)) - 1 :]
    ones, step = np.zeros(BITS, np.int64), 1 << 16
    for at in range(0, n, step):
        stop = min(n, at + step)
        spans = zip(starts[at:stop].tolist(), last[at:stop].tolist())
        hashes = np.fromiter((digest(line[a:b], SEED) for a, b in spans), "<u8", stop - at)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in encoding.slices(batch.column("text")):
                found = np.array([_fingerprint(t, size) for t in texts], "<u8").view("<i8")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(texts)), pa.array(found)], names=["doc_id", "fp"])

    return build


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp) of every row of ``docs`` (doc_id, text): a bit of fp is one if set in over half the shingles' hashes.

    Fewer than ``size`` words are one shingle; no words (also null) are zero. fp is the signed view of the 64 bits.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text"))
    return texts.mapInArrow(_fingerprints(size), "doc_id long, fp long")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per key of each fingerprint: the number of the whole segment, the segment, and a codeword near the next one."""
    for batch in batches:
        fp = batch.column("fp").to_numpy().view("<u8")
        parts = [(fp >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
        own, out = [], []
        for i, part in enumerate(parts):
            at, near = golay.keys(parts[(i + 1) % len(parts)])
            own.append(fp[at])
            out.append(i << 40 | part[at] << 12 | near)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own).view("<i8")), pa.array(np.concatenate(out))], names=["fp", "key"])


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _around(fp: str) -> Column:
    """The words within one bit."""
    return F.array(F.col(fp), *[F.col(fp).bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(BITS)])


def links(nodes: DataFrame, small: int = SMALL) -> DataFrame:
    """(leader, id) between the distinct fingerprints ``nodes`` (fp, stored): they connect what all pairs within two bits connect."""
    keyed = lineage.stored(nodes.select("fp").mapInArrow(_keys, "fp long, key long"), "golay-keys")
    shared = lineage.stored(keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "golay-buckets")
    few = keyed.join(sizing.small_side(shared.where(F.col("members") <= small).select("key")), "key", "left_semi")
    few = lineage.stored(few, "small-buckets")
    x, y = few.alias("x"), few.alias("y")
    pairs = x.join(y, F.col("x.key") == F.col("y.key")).where((F.col("x.fp") < F.col("y.fp")) & (differing(F.col("x.fp"), F.col("y.fp")) <= DISTANCE))
    pairs = pairs.select(F.col("x.fp").alias("leader"), F.col("y.fp").alias("id"))
    many = sizing.small_side(shared.where(F.col("members") > small).select("key"))
    dense = lineage.stored(keyed.join(many, "key", "left_semi").select("fp").distinct(), "dense")
    named = dense.select("fp", F.explode(_around("fp")).alias("word"))
    stars = neardup.bucket_links(named.select(F.col("fp").alias("id"), F.lit(0).alias("band"), F.col("word").alias("bucket")))
    return lineage.stored(pairs.unionByName(stars).distinct(), "simhash-links")


def near_duplicates(docs: DataFrame, size: int = 3, small: int = SMALL) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id (smallest doc_id reachable over links of two bits) of every row of
    ``docs`` (doc_id, text).

    Texts without words (null, empty, blank) have fingerprint zero and are linked like any other. Every row of a repeated doc_id is
    returned and linked by its own text; a null doc_id links and bridges, but names a component only where no other does
    (component_id null). Other columns are ignored; an empty table gives no rows.
    """
    every = lineage.stored(fingerprints(docs, size), "fingerprints")
    nodes = lineage.stored(every.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")), "distinct-fingerprints")
    found = links(nodes, small)
    ends = lineage.stored(found.select(F.col("leader").alias("id")).union(found.select("id")).distinct(), "simhash-ends")
    label = lineage.stored(neardup.components(ends, found), "simhash-labels")
    linked = lineage.stored(nodes.join(label.withColumnRenamed("id", "fp"), "fp").select("fp", "component", "least", "rows"), "simhash-linked")
    best = linked.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    best = lineage.stored(best, "simhash-components")
    joined = sizing.weighted_join(linked, best, ["component"], F.col("fp"), "members").select("fp", "component_id", "rows")
    alone = nodes.join(ends.withColumnRenamed("id", "fp"), "fp", "left_anti").select("fp", F.col("least").alias("component_id"), "rows")
    of_node = lineage.stored(joined.unionByName(alone), "simhash-of-node")
    rows = sizing.weighted_join(every, of_node, ["fp"], F.coalesce("doc_id", F.lit(0)), "rows")
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

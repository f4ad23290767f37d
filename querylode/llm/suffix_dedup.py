"""Removal of every byte that a 400-byte string covers which also starts elsewhere.

Every start of such a string is judged, without a row per byte. The string at a start has one *anchor*, the place in it where the
hash of ``GRAM`` bytes is least, so equal strings have equal anchors at equal distances. Strings are settled in three steps, each a
count by key that partial aggregation keeps free of skew:

1. anchors: only texts in which the bytes at some anchor occur twice go on;
2. classes: the strings of one anchor whose distances fall into one step of ``STEP`` bytes share a *core* (what is in all of them)
   and lie in a *hull* (what any of them covers). A core that occurs once settles them as single, a hull that occurs twice as repeated;
3. strings: what is left, near the ends of repeated regions, is counted string by string, one representative per hull.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from querylode import lineage, sizing
from querylode.llm import common, encoding, shingles

LENGTH = 400
GRAM, STEP = 200, 32


class Bytes:
    """The UTF-8 bytes of several texts in a row, with hashes of any part of them."""

    def __init__(self, texts: list[str]) -> None:
        self.raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.ends = np.cumsum([len(r) for r in self.raw]) if texts else np.zeros(0, np.int64)
        self.begins = self.ends - [len(r) for r in self.raw]
        data = np.frombuffer(b"".join(self.raw), np.uint8)
        up, self.down = shingles._powers(len(data) + 1)
        with np.errstate(over="ignore"):
            self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return shingles.mix((self.total[stop] - self.total[start]) * self.down[start] + (stop - start).astype(np.uint64))

    def anchors(self, length: int, gram: int) -> tuple[np.ndarray, ...]:
        """(text, anchor, first start, last start) of every anchor; starts of strings that don't fit into their text have none."""
        n = int(self.ends[-1]) if len(self.ends) else 0
        span = length - gram + 1
        if n < length:
            return (np.zeros(0, np.int64),) * 4
        values = self.hashes(np.arange(n - gram + 1), np.arange(gram, n + 1))
        # The place fills the low bits: the least hash wins, and of equal ones the first.
        bits = np.uint64(n.bit_length())
        values = values >> bits << bits | np.arange(len(values), dtype=np.uint64)
        # The first least value of every span, by running minima from both sides of blocks of that size.
        m = len(values) - span + 1
        blocks = -(-len(values) // span)
        padded = np.full(blocks * span, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[: len(values)] = values
        grid = padded.reshape(blocks, span)
        left = np.minimum.accumulate(grid, axis=1).reshape(-1)
        right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(right[:m], left[span - 1 : span - 1 + m])
        fits = np.zeros(n, bool)
        for a, b in zip(self.begins, self.ends):
            if b - a >= length:
                fits[a : b - length + 1] = True
        start = np.flatnonzero(fits[:m])
        least = least[start]
        place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        text = np.searchsorted(self.ends, start, side="right")
        change = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(text) != 0) | (np.diff(start) != 1)])) if len(start) else np.zeros(0, np.int64)
        last = np.concatenate([change[1:] - 1, [len(start) - 1]]) if len(start) else change
        return text[change], place[change], start[change], start[last]


def _anchor_rows(length: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for first, texts in encoding.slices(batch.column("text"), 1 << 20):
                data = Bytes(texts)
                text, place, _, _ = data.anchors(length, gram)
                key = data.hashes(place, place + gram).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(rows[first + text])], names=["gram", "row"])

    return find


_CLASS = "core long, hull long, row long, low int, high int"


def _class_rows(length: int, gram: int, step: int):
    """Per anchor and step of distances: core, hull and the starts it holds."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for first, texts in encoding.slices(batch.column("text"), 1 << 20):
                data = Bytes(texts)
                text, place, low, high = data.anchors(length, gram)
                nearest, farthest = (place - high) // step, (place - low) // step
                many = farthest - nearest + 1
                which = np.repeat(np.arange(len(many)), many)
                j = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + nearest[which]
                a = place[which]
                begin, stop = np.maximum(low[which], a - step * j - (step - 1)), np.minimum(high[which], a - step * j)
                with np.errstate(over="ignore"):
                    core = shingles.mix(data.hashes(a - step * j, a - step * j - (step - 1) + length) + j.astype(np.uint64))
                    hull = shingles.mix(data.hashes(begin, stop + length) + shingles.mix((a - begin).astype(np.uint64) * np.uint64(length) + (a - stop).astype(np.uint64)))
                base = data.begins[text[which]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(hull.view(np.int64)), pa.array(rows[first + text[which]]),
                     pa.array((begin - base).astype(np.int32)), pa.array((stop - base).astype(np.int32))],
                    names=["core", "hull", "row", "low", "high"])

    return find


def _string_rows(length: int):
    """A row per start of the listed ranges: hash of the string, row, start, and how many hulls it stands for."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, wanted = batch.column("row").to_numpy(), batch.column("ranges").to_pylist()
            for first, texts in encoding.slices(batch.column("text"), 1 << 20):
                data = Bytes(texts)
                for t in range(len(texts)):
                    spans = np.array([(r["low"], r["high"], r["times"]) for r in wanted[first + t]], np.int64)
                    many = spans[:, 1] - spans[:, 0] + 1
                    which = np.repeat(np.arange(len(many)), many)
                    start = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + spans[which, 0]
                    begin = start + data.begins[t]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(data.hashes(begin, begin + length).view(np.int64)), pa.array(np.full(len(start), rows[first + t])),
                         pa.array(start.astype(np.int32)), pa.array(spans[which, 2])], names=["string", "row", "low", "times"])

    return find


def _removed(texts_too: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text, ranges in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "ranges")]):
                raw = (text or "").encode("utf-8", "surrogatepass")
                gone, spans = 0, 0
                parts, at = [], 0
                for span in ranges or ():
                    parts.append(raw[at : span["begin"]])
                    gone, spans, at = gone + span["end"] - span["begin"], spans + 1, span["end"]
                kept = b"".join([*parts, raw[at:]])
                row = (doc_id, len(raw), gone, spans, kept if texts_too else hashlib.sha256(kept).hexdigest())
                yield pa.RecordBatch.from_arrays([
                    pa.array([row[0]], pa.int64()), *[pa.array([v], pa.int64()) for v in row[1:4]],
                    pa.array([row[4]], pa.binary() if texts_too else pa.string())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept" if texts_too else "kept_sha256"])

    return cut


def _settled(classes: DataFrame) -> DataFrame:
    """Rows of repeated cores with ``times`` (occurrences of the hull), ``lone`` (the core has a hull that occurs once, and others)
    and ``first`` (one row of the hull)."""
    cold, hot = common.split_hot(classes, "core", "row")
    hull = Window.partitionBy("core", "hull")
    core = Window.partitionBy("core")
    out = cold.withColumn("members", F.count("*").over(core)).where("members > 1").withColumn("times", F.count("*").over(hull))
    out = out.withColumn("lone", (F.min("times").over(core) == 1)).withColumn("first", F.row_number().over(hull.orderBy("row", "low")) == 1)
    columns = ["core", "hull", "row", "low", "high", "times", "lone", "first"]
    if hot is None:
        return out.select(columns)
    # The same by aggregation and joins, which pre-aggregate and split what one task could not take.
    hulls = lineage.stored(hot.groupBy("core", "hull").agg(F.count("*").alias("times"), F.min(F.struct("row", "low")).alias("one")), "hot-hulls")
    cores = hulls.groupBy("core").agg((F.min("times") == 1).alias("lone"), F.sum("times").alias("members")).where("members > 1").drop("members")
    more = hot.join(hulls, ["core", "hull"]).join(cores, "core").withColumn("first", F.struct("row", "low") == F.col("one"))
    return out.select(columns).unionByName(more.select(columns))


def repeated_starts(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, step: int = STEP) -> DataFrame:
    """row, low, high: ranges of starts of strings of ``length`` bytes that also start elsewhere. ``rows`` has row and text."""
    found = lineage.stored(rows.mapInArrow(_anchor_rows(length, gram), "gram long, row long"), "anchors")
    cold, hot = common.split_hot(found, "gram", "row")
    twice = cold.withColumn("n", F.count("*").over(Window.partitionBy("gram"))).where("n > 1").select("gram", "row")
    twice = twice if hot is None else twice.unionByName(hot.select("gram", "row"))
    flagged = sizing.small_side(lineage.stored(twice.select("row").distinct(), "flagged"))
    classes = rows.join(flagged, "row", "left_semi").select("row", "text").mapInArrow(_class_rows(length, gram, step), _CLASS)
    settled = lineage.stored(_settled(lineage.stored(classes, "classes")), "settled")
    sure = settled.where("times > 1").select("row", "low", "high")
    unsure = settled.where("lone and first").groupBy("row").agg(F.collect_list(F.struct("low", "high", "times")).alias("ranges"))
    unsure = sizing.small_side(lineage.stored(unsure, "unsure"))
    strings = lineage.stored(
        rows.join(unsure, "row").select("row", "text", "ranges").mapInArrow(_string_rows(length), "string long, row long, low int, times long"),
        "strings")
    total = strings.groupBy("string").agg(F.sum("times").alias("n")).where("n > 1").select("string")
    single = strings.where("times = 1").join(total, "string").select("row", "low", F.col("low").alias("high"))
    return sure.unionByName(single)


def _merged(covers: Column) -> Column:
    """Sorted (begin, end) with those that meet joined."""

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], span["end"]).alias("end"))
        return (F.when(F.size(done) == 0, F.array(span))
                .when(last["end"] >= span["begin"], F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer)))
                .otherwise(F.concat(done, F.array(span))))

    return F.aggregate(covers, F.array().cast("array<struct<begin:int,end:int>>"), add)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, step: int = STEP, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 (with ``texts`` the kept bytes) of every row of ``docs`` (doc_id, text).

    Null texts are empty. Rows that repeat a doc_id are different places like any others, so equal rows of ``length`` bytes or more
    remove each other. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))  # rows that are alike may share it: what is removed from them is alike
    starts = repeated_starts(rows.select("row", "text"), length, gram, step)
    covers = F.sort_array(F.collect_list(F.struct(F.col("low").alias("begin"), (F.col("high") + length).alias("end"))))
    ranges = starts.groupBy("row").agg(covers.alias("covers")).select("row", _merged(F.col("covers")).alias("ranges"))
    ranges = sizing.small_side(lineage.stored(ranges, "removed"))
    last = "kept binary" if texts else "kept_sha256 string"
    joined = rows.join(ranges, "row", "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(_removed(texts), f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}")

"""Similarity join on word shingles: documents whose prefixes meet under several global token orders, then exact comparison.

Equal sets are one node. If two sets reach the threshold, the first ``n - ceil(t n) + 1`` tokens of each share a token, whatever
order all tokens are put in. Three orders are used:

* the first puts one hash class of tokens before the rest and rare tokens before frequent ones. Only that class has to be counted
  (a node with fewer tokens of it than its prefix needs adds the rest), and tokens of one node never count, so that most nodes drop out;
* the second and third are ascending and descending hashes, of which stored sets are sorted slices.

Pairs come from the buckets of the first order, must also meet under the other two, and are compared as whole sets. Buckets never
emit all their pairs: members are first compared with a leader of their size band, the one whose tokens are most common; where many
members then still are in different components, leaders of other components follow, as long as that joins them. Only members that
end up in different components are paired with each other, and only if their sketches leave enough in common. Tokens that no
other surviving node has bound the overlap of a node with anything, which removes nodes before pairs are made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from querylode import lineage, sizing
from querylode.llm import common, encoding, shingles, worker
from querylode.operators import neardup

#: Bytes of text whose words are hashed at a time; the arrays in between take 50 times as much.
SLICE = 1 << 19
#: Longs of a sketch. Each of its bits says whether an odd number of tokens has that hash: sets that differ by d tokens differ by at most d bits.
SKETCH = 16
#: Pairs of different components that a row of an open bucket may stand for on average before more leaders are tried.
CROWD = 4


def _least(n, percent: int):
    """ceil(percent / 100 * n) in whole numbers, for ints and arrays alike."""
    return -(-percent * n // 100)


def _first_class(percent: int) -> int:
    """Tokens below this hash come first in the first order: twice the share of tokens that a prefix holds, half of all at most."""
    return (1 << 63) * min(100, 4 * (100 - percent)) // 100


def _sketch(tokens: np.ndarray) -> np.ndarray:
    """The parities of the numbers of tokens by hash, as ``SKETCH`` longs."""
    odd = np.bincount((tokens % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _sets(size: int, percent: int, whole: bool):
    """row, doc_id, set (64 bits of the fingerprint), n, and the tokens: all of them, or those that the first order needs."""

    limit = _first_class(percent)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for first, texts in encoding.slices(batch.column("text"), SLICE):
                found = shingles.shingle_sets(texts, size)
                ids = [int.from_bytes(shingles.fingerprint(s)[:8], "little", signed=True) for s in found]
                kept = []
                for s in found:
                    early = s[s < np.uint64(limit)]
                    enough = whole is False and len(early) >= len(s) - _least(len(s), percent) + 1
                    kept.append((early if enough else s).astype("<u8").tobytes())
                columns = [batch.column("row").slice(first, len(texts)), pa.array(doc_ids[first : first + len(texts)], pa.int64()), pa.array(ids, pa.int64()),
                           pa.array([len(s) for s in found], pa.int32()), pa.array(kept, pa.binary())]
                if whole:
                    sketches = [_sketch(s) for s in found]
                    columns.append(pa.array(sketches, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "set", "n", "tokens", "sketch"][: len(columns)])
        batch = texts = found = kept = columns = sketches = None
        worker.release()  # idle workers stay beside the stages that need none

    return build


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per token: token, set."""
    for batch in batches:
        ids = batch.column("set").to_numpy()
        tokens = [np.frombuffer(t, "<i8") for t in batch.column("tokens").to_pylist()]
        step, at = 200_000, 0
        while at < len(tokens):  # batches of bounded size, however long the texts
            size, stop = 0, at
            while stop < len(tokens) and (stop == at or size + len(tokens[stop]) <= step):
                size, stop = size + len(tokens[stop]), stop + 1
            flat = np.concatenate(tokens[at:stop])
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat), pa.array(np.repeat(ids[at:stop], [len(t) for t in tokens[at:stop]]))], names=["token", "set"])
            at = stop


def _compared(percent: int):
    """Keeps pairs whose prefixes meet under ascending and under descending hashes and whose sets reach the threshold."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for a, b, x, y in zip(*[batch.column(c) for c in ("a", "b", "a_tokens", "b_tokens")]):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                p, q = len(x) - _least(len(x), percent) + 1, len(y) - _least(len(y), percent) + 1
                if not (np.isin(x[:p], y[:q]).any() and np.isin(x[-p:], y[-q:]).any()):
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    left.append(a.as_py()), right.append(b.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
        batch = None
        worker.release()

    return compare


def _linked(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets that reach the threshold."""
    x = full.select(F.col("set").alias("a"), F.col("tokens").alias("a_tokens"))
    y = full.select(F.col("set").alias("b"), F.col("tokens").alias("b_tokens"))
    rows = pairs.join(x, "a").join(y, "b").select("a", "b", "a_tokens", "b_tokens")
    return rows.mapInArrow(_compared(percent), "a long, b long")


def _room(n: Column, m: Column, percent: int) -> Column:
    """Tokens a set of ``n`` may lack if it reaches the threshold with one of ``m``."""
    return n - F.ceil((n + m) * percent / (100 + percent))


def _may_link(a: str, b: str, percent: int) -> Column:
    """Sizes, own tokens, places of the shared token and sketches leave enough in common."""
    c = lambda side, name: F.col(f"{side}.{name}")
    fits = lambda s, o: F.greatest(c(s, "own"), c(s, "pos")) <= _room(c(s, "n"), c(o, "n"), percent)
    apart = reduce(lambda x, y: x + y, [F.bit_count(c(a, "sketch")[i].bitwiseXOR(c(b, "sketch")[i])) for i in range(SKETCH)])
    total = c(a, "n") + c(b, "n")
    return fits(a, b) & fits(b, a) & (apart <= total - 2 * F.ceil(total * percent / (100 + percent)))


def _frequent(rows: DataFrame) -> DataFrame:
    """(token, set, df) of tokens in two sets or more; endlessly frequent ones come last in the order without being counted."""
    cold, hot = common.split_hot(rows, "token", "set")
    counted = cold.withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1")
    return counted if hot is None else counted.unionByName(hot.withColumn("df", F.lit(1 << 60)))


def _row() -> Column:
    """Key of a row of documents: equal rows share it, rows that repeat a doc_id with other texts do not."""
    return F.xxhash64(F.col("doc_id").cast("long"), common.text_of())


def near_sets(docs: DataFrame, size: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """((row, doc_id, set, n) of every row, links (a, b) between different sets).

    Links connect whatever all pairs at or above the threshold connect; pairs within a component that its other links already join
    are not all listed.
    """
    texts = docs.select(_row().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text"))
    schema = "row long, doc_id long, set long, n int, tokens binary"
    every = lineage.stored(texts.mapInArrow(_sets(size, percent, False), schema), "shingle-sets")
    nodes = every.where("n > 0").groupBy("set").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    rows = nodes.select("set", "tokens").mapInArrow(_spread, "token long, set long")
    counted = _frequent(rows)

    # Places in the first order: early tokens of one set, early shared ones by frequency, then the same for the rest.
    early = F.col("token").between(0, _first_class(percent) - 1)  # signed view of the unsigned hash
    sizes = every.where("n > 0").groupBy("set").agg(F.first("n").alias("n"), F.first(F.octet_length("tokens") / 8).cast("int").alias("sent"),
                                                   F.min("row").alias("row"))
    per_set = counted.groupBy("set").agg(F.sort_array(F.collect_list(F.struct((~early).alias("late"), "df", "token"))).alias("shared"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    placed = per_set.join(sizes, "set").withColumn("n_early", F.size(F.filter("shared", lambda t: ~t["late"])))
    # Whether a set sent all its tokens is visible from their number; only then are late tokens counted as well.
    placed = placed.select("set", "row", "n", "sent", "n_early", prefix.alias("prefix"), F.posexplode("shared").alias("at", "t"))
    own_early = F.when(F.col("sent") < F.col("n"), F.col("sent") - F.col("n_early")).otherwise(0)
    pos = own_early + F.col("at")
    first = lineage.stored(
        placed.withColumn("pos", pos.cast("int")).where(F.col("pos") < F.col("prefix")).select("set", "row", "n", "pos", F.col("t.token").alias("token")),
        "prefixes")
    met = first.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    first = lineage.stored(first.join(met, "token", "left_semi"), "met-prefixes")

    alive = sizing.small_side(lineage.stored(first.select("row", F.col("set").alias("alive")).distinct(), "alive"))
    again = texts.join(alive, "row").select("row", "doc_id", "text").mapInArrow(_sets(size, percent, True), f"{schema}, sketch array<long>")
    # Rows of one key may bring other texts along; and several texts may have the same set.
    full = again.join(alive.select("alive").distinct(), F.col("set") == F.col("alive"), "left_semi").groupBy("set").agg(
        F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch"))
    full = lineage.stored(full, "alive-sets")
    shared = _frequent(full.select("set", "tokens").mapInArrow(_spread, "token long, set long"))
    kept = shared.groupBy("set").agg(F.count("*").alias("shared"), F.sum(F.least("df", F.lit(1 << 30))).alias("common"))
    owned = full.select("set", "n", "sketch").join(kept, "set", "left").withColumn("own", F.col("n") - F.coalesce("shared", F.lit(0)))
    owned = owned.where(F.col("own") <= F.col("n") - F.ceil(F.col("n") * percent / 100))
    owned = owned.select("set", "own", "sketch", (-F.col("common") / F.col("n")).alias("remote"))
    first = first.drop("row").join(owned, "set")
    first = first.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / -math.log(percent / 100)).cast("int"))
    first = lineage.stored(first.withColumn("own", F.col("own").cast("int")), "buckets")

    # A leader per token and size band; members of its band and of the next one meet it.
    pairs = lineage.stored(_stars(first, _leaders(first), percent), "star-pairs")
    links = lineage.stored(_linked(pairs, full, percent), "star-links")

    # What the leaders did not settle: pairs of different components that share a bucket.
    open_rows, left = _open(first, links), None
    while (rows := open_rows.count()) and (crossing := _crossing(open_rows)) > CROWD * rows and (left is None or 2 * crossing <= left):
        left = crossing
        again = _stars(open_rows, _other_leaders(open_rows), percent, F.col("x.part") != F.col("y.part"))
        again = lineage.stored(again.join(pairs, ["a", "b"], "left_anti"), "star-pairs")
        found = lineage.stored(_linked(again, full, percent), "star-links")
        pairs = pairs.unionByName(again)
        if found.isEmpty():
            break
        links = links.unionByName(found)
        open_rows = _open(first, links)
    other = open_rows.alias("x").join(open_rows.alias("y"), F.col("x.token") == F.col("y.token")).where(
        (F.col("x.set") < F.col("y.set")) & (F.col("x.part") != F.col("y.part")) & _may_link("x", "y", percent))
    rest = other.select(F.col("x.set").alias("a"), F.col("y.set").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
    more = lineage.stored(_linked(rest, full, percent), "more-links")
    return every.select("row", "doc_id", "set", "n"), links.unionByName(more)


_LEADER = ("own", "pos", "n", "set", "sketch")


def _leaders(first: DataFrame) -> DataFrame:
    """Per token and size band the set whose tokens are most common."""
    return first.groupBy("token", "band").agg(F.min(F.struct("remote", *_LEADER)).alias("l"))


def _other_leaders(rows: DataFrame) -> DataFrame:
    """The same among the sets of other components than that of the first choice."""
    best = rows.groupBy("token", "band").agg(F.min(F.struct("remote", "set", "part")).alias("b")).select("token", "band", F.col("b.part").alias("taken"))
    return rows.join(best, ["token", "band"]).where("part <> taken").groupBy("token", "band").agg(F.min(F.struct("remote", *_LEADER, "part")).alias("l"))


def _stars(first: DataFrame, lead: DataFrame, percent: int, also: Column | None = None) -> DataFrame:
    """Pairs (a, b) of sets with the leaders (token, band, l) of their own size band and of the one below."""
    lead = lead.select("token", F.explode(F.array("band", F.col("band") + 1)).alias("band"), "l.*").drop("remote")
    stars = first.alias("x").join(lead.alias("y"), ["token", "band"]).where((F.col("x.set") != F.col("y.set")) & _may_link("x", "y", percent))
    stars = stars if also is None else stars.where(also)
    return stars.select(F.least("x.set", "y.set").alias("a"), F.greatest("x.set", "y.set").alias("b")).distinct()


def _open(first: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of the buckets that hold sets of several components, with their component (part)."""
    label = _labels(links)
    colour = first.join(label, F.col("set") == F.col("id"), "left").withColumn("part", F.coalesce("component", "set")).drop("id", "component")
    colour = lineage.stored(colour, "coloured")
    mixed = colour.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("token")
    return lineage.stored(colour.join(mixed, "token", "left_semi"), "open-buckets")


def _crossing(rows: DataFrame) -> float:
    """Pairs of rows of one bucket and different components."""
    parts = rows.groupBy("token", "part").agg(F.count("*").cast("double").alias("c"))
    both = parts.groupBy("token").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("own"))
    return both.agg(F.sum((F.col("c") * F.col("c") - F.col("own")) / 2)).first()[0] or 0.0


def _labels(links: DataFrame) -> DataFrame:
    """id, component of every linked set."""
    ends = links.select(F.col("a").alias("id")).union(links.select(F.col("b").alias("id"))).distinct()
    return neardup.components(lineage.stored(ends, "ends"), links.select(F.col("a").alias("leader"), F.col("b").alias("id")))


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row of ``docs`` (doc_id, text).

    Null and empty texts have no shingles and are linked with nothing. Rows that repeat a doc_id are linked by their texts alone; a
    null doc_id takes part, and names a component only where no other does not (component_id null). Other columns are ignored, an
    empty table gives no rows. The ids of sets are 64 bits of a 128-bit hash.
    """
    return _components(docs, size, percent).drop("row")


def _components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """What ``near_duplicates`` gives, with the key of each row."""
    every, links = near_sets(docs, size, percent)
    label = lineage.stored(_labels(links), "labels")
    own = every.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("least"))
    joined = own.join(label, F.col("set") == F.col("id"), "left").withColumn("part", F.coalesce("component", "set"))
    linked = lineage.stored(joined.where("component is not null").select("set", "part", "least"), "linked")
    best = linked.groupBy("part").agg(F.min("least").alias("component_id"))
    of_set = joined.where("component is null").select("set", F.col("least").alias("component_id")).unionByName(
        linked.join(best, "part").select("set", "component_id"))
    rows = every.where("n > 0").join(of_set, "set").select("row", "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    return rows.unionByName(every.where("n = 0").select("row", "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """``docs`` with one document per component, the one of smallest doc_id; rows that repeat it all stay, as do null doc_ids.

    Rows are judged one by one: of rows that share a doc_id only those go whose own text has a copy of smaller doc_id.
    """
    with lineage.scratch(docs.sparkSession) as keep:
        found = _components(docs.select("doc_id", "text"), size, percent)
        gone = keep(found.where("component_id <> doc_id").select(F.col("row").alias("_row"), F.col("doc_id").alias("_id")).distinct(), "near-copies")
    keyed = docs.select(F.struct(*docs.columns).alias("doc"), _row().alias("row"), F.col("doc_id").alias("id"))
    left = keyed.join(sizing.small_side(gone), (F.col("row") == F.col("_row")) & (F.col("id") == F.col("_id")), "left_anti")
    return left.select("doc.*")

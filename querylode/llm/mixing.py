"""Mixing sources to target weights with exact block quotas, dealt to output shards by a splitting tree.

Every source is cut into ``BLOCKS`` blocks by a seeded permutation of its documents. A source's target fixes how many of its blocks
are drawn (whole passes first, then a part of the next) and how much of one last block. The quotas of all sources are split in two
again and again: a node's left half receives a multivariate hypergeometric draw of its blocks, so that every shard gets its exact
share of blocks and a random mixture of sources. Shards then take the next blocks of each source's permuted order, which no other
shard takes, and shuffle them locally. All of it is DataFrame work; draws are hashes of the seed, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from querylode import lineage, sizing
from querylode.llm import common

#: Blocks per source; bounds what the quota tables and the tree hold, whatever the size of the corpus.
BLOCKS = 256
MAX_PASSES = 2


def unit(*parts: Column | int | str) -> Column:
    """A number in [0, 1) from the hash of ``parts``."""
    hashed = F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.shiftrightunsigned(hashed, 11).cast("double") / float(1 << 53)


def sized(docs: DataFrame, seed: int, *carried: Column) -> DataFrame:
    """doc_id, source, size (words of the whole text; null: 0), and the place of the document in its source's permutation: ``key`` and
    the ``block`` it falls into. The key is a hash of id and text, so every pass over the same rows finds it again; rows that are alike
    share it and may stand for one another."""
    words = F.regexp_count(common.text_of(), F.lit(common.WORD)).cast("long")
    key = unit(seed, F.coalesce(F.col("doc_id"), F.lit(-1)), F.xxhash64(common.text_of()))
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), words.alias("size"), key.alias("key"), *carried)
    return rows.withColumn("block", F.floor(F.col("key") * BLOCKS).cast("int"))


def targets(totals: DataFrame, weights: Sequence[float], share: float, passes: int = MAX_PASSES) -> DataFrame:
    """source, source_size and target of every source.

    Sources in code point order, null last, take ``weights`` in turn and share ``share`` times all words; a target stops at
    ``passes`` times its source's size, and what it leaves goes to the others by weight until none is above. A source stops when
    the level (words per weight) exceeds passes * size / weight; in the order of that ratio the level is found by running sums.
    """
    # One row per source. Sources are few against documents, but their number isn't bounded; so no collect, and one small sort.
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weighted = totals.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1))
    limit = F.col("source_size") * F.lit(float(passes))
    ordered = weighted.withColumn("limit", limit).withColumn("ratio", F.col("limit") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum(
        "weight").over(rest)
    # The first source in this order that stays below its limit sets the level of all after it.
    open_level = F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", "level"))).over(whole)["level"]
    return (
        ordered.withColumn("level", level).withColumn("open", open_level)
        .select("source", "source_size", F.least("limit", F.coalesce(F.col("open") * F.col("weight"), F.col("limit"))).alias("target"))
    )


def _draw(total: Column, marked: Column, takes: Column, *seed: Column | str) -> Column:
    """Marked ones among ``takes`` drawn without replacement from ``total`` with ``marked`` marked: a hypergeometric draw, one urn
    step for each marked one (is it among those taken?)."""
    start = F.struct(total.cast("long").alias("left"), takes.cast("long").alias("room"), F.lit(0).cast("long").alias("hit"))

    def step(state: Column, i: Column) -> Column:
        hit = (unit(*seed, i) * state["left"] < state["room"]).cast("long")
        return F.struct((state["left"] - 1).alias("left"), (state["room"] - hit).alias("room"), (state["hit"] + hit).alias("hit"))

    steps = F.when(marked > 0, F.sequence(F.lit(1).cast("long"), marked.cast("long"))).otherwise(F.array().cast("array<long>"))
    return F.aggregate(steps, start, step)["hit"]


def splitting_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source, shard, first, many): the blocks of every source's permuted order that a shard takes.

    ``quotas`` has source and blocks. Within a node the sources draw one after another from what the earlier ones left, which makes
    the draws multivariate hypergeometric; the chain is a fold over the node's sources.
    """
    pairs = F.sort_array(F.collect_list(F.struct(F.col("source").isNull().alias("none"), "source", F.col("blocks").cast("long").alias("blocks"))))
    tree = quotas.groupBy().agg(pairs.alias("q"), F.sum("blocks").cast("long").alias("total"))
    tree = tree.where("total is not null").select(F.lit(0).alias("node"), F.lit(shards).alias("width"), "q", "total")

    def split(q: Column, left: Column, total: Column, node: Column) -> Column:
        none = F.array().cast("array<bigint>")
        start = F.struct(total.alias("left"), left.cast("long").alias("room"), none.alias("hits"))

        def chain(state: Column, s: Column) -> Column:
            hit = _draw(state["left"], s["blocks"], state["room"], F.lit(seed), node, s["source"])
            return common.let(hit, lambda h: F.struct(
                (state["left"] - s["blocks"]).alias("left"), (state["room"] - h).alias("room"),
                F.concat(state["hits"], F.array(h)).alias("hits")))

        return F.aggregate(q, start, chain)["hits"]

    level, widths = 0, {shards}
    while max(widths) > 1:
        go = F.col("width") > 1
        half = F.ceil(F.col("width") / 2).cast("int")
        share = F.floor(F.col("total") * half / F.col("width")).cast("long")
        tree = tree.select("node", "width", "q", "total", half.alias("half"), share.alias("share"))
        tree = tree.withColumn("hits", F.when(go, split(F.col("q"), F.col("share"), F.col("total"), F.col("node") + F.lit(level << 20))))
        keep = lambda amount: F.transform("q", lambda s, i: F.struct(
            s["none"].alias("none"), s["source"].alias("source"), amount(s, i).alias("blocks")))
        lefts = F.struct(F.col("node").alias("node"), F.col("half").alias("width"),
                         keep(lambda s, i: F.col("hits")[i]).alias("q"), F.col("share").alias("total"))
        rights = F.struct((F.col("node") + F.col("half")).alias("node"), (F.col("width") - F.col("half")).alias("width"),
                          keep(lambda s, i: s["blocks"] - F.col("hits")[i]).alias("q"), (F.col("total") - F.col("share")).alias("total"))
        same = F.struct(F.col("node").alias("node"), F.col("width").alias("width"), F.col("q").alias("q"), F.col("total").alias("total"))
        tree = lineage.cut(tree.select(F.explode(F.when(go, F.array(lefts, rights)).otherwise(F.array(same))).alias("n")).select("n.*"))
        widths = {w for v in widths for w in ((-(-v // 2), v // 2) if v > 1 else (v,))}
        level += 1
    dealt = tree.select(F.col("node").alias("shard"), F.explode("q").alias("s")).select("shard", "s.source", F.col("s.blocks").alias("many"))
    before = F.sum("many").over(Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return dealt.select("source", "shard", F.coalesce(before, F.lit(0)).cast("long").alias("first"), "many").where("many > 0")


def _plan(rows: DataFrame, weights: Sequence[float], share: float, shards: int, seed: int) -> DataFrame:
    """What happens to every block of every source: whole draws, shards of the draws, and for one edge block per source the room left."""
    blocks = lineage.stored(rows.groupBy("source", "block").agg(F.sum("size").alias("words"), F.count("*").alias("n")), "blocks")
    aims = lineage.stored(targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share), "targets")
    # Whole passes, then in permuted order every block that still fits; the smallest block left over gives the rest in documents.
    lists = blocks.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("block", "words"))).alias("blocks"))  # BLOCKS at most
    lined = lists.join(aims, lists["source"].eqNullSafe(aims["source"])).drop(aims["source"])
    passes = F.when(F.col("source_size") > 0, F.least(F.lit(MAX_PASSES), F.floor(F.col("target") / F.col("source_size")))).otherwise(0)
    lined = lined.withColumn("passes", passes.cast("int")).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    start = F.struct(F.col("rest").alias("room"), F.array().cast("array<int>").alias("took"))

    def fill(state: Column, block: Column) -> Column:
        more = F.struct((state["room"] - block["words"]).alias("room"), F.concat(state["took"], F.array(block["block"])).alias("took"))
        return F.when(block["words"] <= state["room"], more).otherwise(state)

    open_pass = F.col("passes") < MAX_PASSES
    lined = lined.withColumn("filled", F.when(open_pass, F.aggregate("blocks", start, fill)).otherwise(start))
    over = F.filter("blocks", lambda b: ~F.array_contains("filled.took", b["block"]))
    smallest = F.array_min(F.transform(over, lambda b: F.struct(b["words"].alias("words"), b["block"].alias("block"))))
    lined = lined.withColumn("edge_block", F.when(open_pass, smallest["block"]))
    lined = lined.select(
        "source", "source_size", "target", "passes", F.col("filled.room").alias("room"), "edge_block", F.explode("blocks").alias("b"),
        F.array_contains("filled.took", F.col("b.block")).alias("more"))
    lined = lineage.stored(lined.select(
        "source", "source_size", "target", "passes", "room", F.col("b.block").alias("block"), F.col("b.block").alias("position"),
        (F.col("passes") + F.col("more").cast("int")).alias("whole"),
        F.coalesce(F.col("b.block") == F.col("edge_block"), F.lit(False)).alias("edge")), "block-plan")
    # A source's drawn blocks in permuted order: pass after pass, the edge block last in its pass.
    drawn = F.col("whole") + F.col("edge").cast("int")
    drawn_blocks = lined.where(drawn > 0).select("source", "block", "position", F.explode(F.sequence(F.lit(1), drawn)).alias("turn"))
    number = F.row_number().over(Window.partitionBy("source").orderBy("turn", "position")) - 1
    numbered = drawn_blocks.withColumn("number", number)
    tree = splitting_tree(numbered.groupBy("source").agg(F.count("*").alias("blocks")), shards, seed)
    placed = numbered.alias("b").join(tree.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))
                                      & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("first") + F.col("many")))
    homes = placed.select(F.col("b.source").alias("source"), "block", "turn", "shard").groupBy("source", "block").agg(
        F.sort_array(F.collect_list(F.struct("turn", "shard"))).alias("homes"))
    plan = lined.alias("l").join(homes.alias("h"), F.col("l.source").eqNullSafe(F.col("h.source")) & (F.col("l.block") == F.col("h.block")), "left")
    plan = sizing.small_side(lineage.stored(plan.select(
        F.col("l.source").alias("source"), F.col("l.block").alias("block"), "source_size", "target", "whole", "edge", "passes", "room",
        F.coalesce("h.homes", F.array().cast("array<struct<turn:int,shard:int>>")).alias("homes")), "mixing-plan"))
    return plan


def _drawn(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``rows`` with source_size, target, times and draws."""
    joined = rows.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.block") == F.col("p.block")))
    joined = joined.select("r.*", "source_size", "target", "whole", "edge", "passes", "room", "homes")
    inner = joined.where(~F.col("edge")).withColumn("times", F.col("whole"))
    # Only edge blocks, one per source, need their documents in order, large ones first; the last one may go over by half.
    fits = F.col("size") <= 2 * F.col("room")
    upto = F.sum(F.when(fits, F.col("size"))).over(Window.partitionBy("source", "block").orderBy(F.desc("size"), "key").rowsBetween(
        Window.unboundedPreceding, 0))
    edge = joined.where("edge").withColumn("upto", F.when(fits, upto))
    more = F.coalesce(F.col("upto") - F.col("size") / 2 <= F.col("room"), F.lit(False))
    every = inner.unionByName(edge.withColumn("times", F.col("whole") + more.cast("int")).drop("upto"))
    draws = F.transform(F.slice("homes", F.lit(1), F.col("times")), lambda h: F.struct(
        h["shard"].alias("shard"), F.xxhash64(F.lit(seed), h["shard"], h["turn"], F.col("key")).alias("position")))
    return every.withColumn("draws", draws)


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, shards: int = 16, seed: int = 11) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): doc_id, source, size, source_size, target, taken, draws.

    ``draws`` lists (shard, position) for each time the document is drawn: once per pass, hence at most twice; ``taken`` is its size
    times their number. The words taken from a source differ from its target by at most half of one document. A null source is a
    source of its own; documents without words may be drawn or not. Other columns are ignored, an empty table gives no rows.
    """
    rows = lineage.stored(sized(docs, seed), "sized")
    drawn = _drawn(rows, _plan(rows, weights, share, shards, seed), seed)
    return drawn.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("times")).cast("long").alias("taken"), "draws")


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, shards: int = 16, seed: int = 11) -> DataFrame:
    """``docs`` as the mix draws them, a row per draw with all columns of ``docs``: dealt to their output shards, shuffled inside.

    A shard is spread over tasks by position, so that shards may be large; within a task rows stand in (shard, position) order. Texts
    move once, to their shards.
    """
    with lineage.scratch(docs.sparkSession) as keep:
        plan = keep(_plan(lineage.stored(sized(docs, seed), "sized"), weights, share, shards, seed), "mixing-plan")
    drawn = _drawn(sized(docs, seed, F.struct("*").alias("doc")), sizing.small_side(plan), seed)
    spread = max(8, -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards))
    placed = drawn.select("doc", F.explode("draws").alias("draw")).repartition(F.col("draw.shard"), F.pmod(F.col("draw.position"), F.lit(spread)))
    return placed.sortWithinPartitions("draw.shard", "draw.position").select("doc.*")

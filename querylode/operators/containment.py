"""Substring joins as equi-joins.

``contains`` between two tables would compare everything with everything.  Both joins here first match on a piece every
containing text must share with the needle, then verify, so they are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from querylode.functions import tokens as K
from querylode.lineage import stored
from querylode.operators.ordering import first_per_key
from querylode.sizing import fits, small_side

_GRAM = 3
_RUN = 4


def _grams(text: Column, size: int) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def _needle_grams(words: DataFrame) -> DataFrame:
    return words.withColumn("_gram", F.explode(
        F.when(F.length("_needle") >= _GRAM, _grams(F.col("_needle"), _GRAM)).otherwise(F.array("_needle"))))


def contains_join(needles: DataFrame, needle: str, texts: DataFrame, text: str) -> DataFrame:
    """Pairs where ``text`` contains ``needle``; made for short fields (names, comments, vocabulary words).

    A needle meets only the texts that hold its rarest character gram (three characters, fewer for shorter needles).
    ``texts`` must not carry duplicate rows.  Empty needles match nothing.  Few needles travel to the texts, whose other grams then go nowhere.
    """
    needles = stored(needles, "needles")
    words = needles.select(F.col(needle).alias("_needle")).filter(F.length(needle) > 0).distinct()
    few, lengths = fits(words), range(1, _GRAM + 1)
    if few:
        lengths = [r[0] for r in words.select(F.least(F.length("_needle"), F.lit(_GRAM)).alias("n")).distinct().collect()] or [_GRAM]
    sized = texts.withColumn("_gram", F.explode(F.concat(*[_grams(F.col(text), n) for n in sorted(lengths)])))
    if few:
        sized = sized.join(F.broadcast(_needle_grams(words).select("_gram").distinct()), "_gram", "left_semi")
    frequency = sized.groupBy("_gram").agg(F.count("*").alias("_df"))
    parts = _needle_grams(words)
    # A gram found nowhere gets frequency 0 and wins: such a needle matches nothing and drops out of the join.
    rarest = first_per_key(
        parts.join(frequency, "_gram", "left").select("_needle", "_gram", F.coalesce("_df", F.lit(0)).alias("_df")),
        ["_needle"], F.struct("_df", "_gram")).select("_needle", "_gram")
    pairs = (F.broadcast(rarest) if few else rarest).join(sized, "_gram").filter(F.col(text).contains(F.col("_needle"))).drop("_gram")
    return needles.join(pairs, needles[needle] == pairs["_needle"]).drop("_needle")


_BASE, _BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bits of the sieve per piece, and the most it may have (32 MB); beyond that more pieces pass for nothing.
_SIEVE_BITS, _SIEVE_MOST = 12, 1 << 28


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _hashed(texts: list[str]) -> tuple[str, np.ndarray, Callable[[int], tuple[np.ndarray, np.ndarray]]]:
    """The texts in one string, the number of the text at each place, and a function that gives, for a length, the places where a piece of
    that length lies inside its text, with the hashes of these pieces. The hashes of all lengths come from the same prefix sums."""
    text, sizes = "".join(texts), np.fromiter(map(len, texts), np.int64, len(texts))
    codes, ends = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64), np.cumsum(sizes)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * _powers(_BASE, len(codes)), dtype=np.uint64)])
    back, room = _powers(_BACK, len(codes)), np.repeat(ends, sizes) - np.arange(len(codes))

    def pieces(length: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(room >= length)
        h = (sums[at + length] - sums[at]) * back[at] + np.uint64(length)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        return at, h ^ (h >> np.uint64(31))

    return text, np.repeat(np.arange(len(texts)), sizes), pieces


def _sieve(wanted: DataFrame, piece: str) -> np.ndarray:
    """Bits at two places of the hash of every wanted piece; what lacks one of them is not wanted."""
    size = 1 << 12
    while size < min(_SIEVE_MOST, _SIEVE_BITS * wanted.count()):
        size *= 2

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t for t in batch.column(0).to_pylist() if t]
            for length in {len(t) for t in texts}:
                own = [t for t in texts if len(t) == length]
                h = _hashed(own)[2](length)[1]
                at = np.concatenate([h, h >> np.uint64(32)]) & np.uint64(size - 1)
                yield pa.record_batch([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["slot", "bits"])

    rows = wanted.select(piece).mapInArrow(places, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[rows["slot"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint64)


def first_pieces(words: DataFrame, word: str, wanted: DataFrame, piece: str, lengths: list[int], order: str, k: int) -> DataFrame:
    """``piece, order`` of pieces of a ``word`` that have one of the ``lengths``: all that are ``wanted`` (a column ``piece``) and a few others,
    with the ``k`` smallest values of ``order`` (perhaps repeated).  A word has far more pieces than anyone asks for, so they are held against
    a sieve of the wanted ones before they become rows.  Each task keeps its own first ones, so a piece that lies in many words does not
    travel with all of them."""
    sieve = words.sparkSession.sparkContext.broadcast(_sieve(wanted, piece))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sieve.value
        mask = np.uint64(len(bits) * 64 - 1)
        for batch in batches:
            texts, orders = batch.column(0).to_pylist(), batch.column(1)
            text, owner, pieces = _hashed([t or "" for t in texts])
            found, rows = [], [np.zeros(0, np.int64)]
            for length in lengths:
                at, h = pieces(length)
                keep = np.ones(len(at), bool)
                for part in (h & mask, (h >> np.uint64(32)) & mask):
                    keep &= ((bits[part >> np.uint64(6)] >> (part & np.uint64(63))) & np.uint64(1)).astype(bool)
                at = at[keep]
                found += [text[i : i + length] for i in at.tolist()]
                rows.append(owner[at])
            yield pa.record_batch([pa.array(found, pa.string()), orders.take(pa.array(np.concatenate(rows)))], [piece, order])

    rows = words.select(word, order).mapInArrow(cut, f"`{piece}` string, `{order}` {words.schema[order].dataType.simpleString()}")
    place = F.dense_rank().over(W.partitionBy(piece).orderBy(order))
    return rows.withColumn("_place", place).filter(F.col("_place") <= k).select(piece, order)


def _runs(tokens: Column, size: int, first: int = 1, cut_last: int = 0) -> Column:
    """Distinct hashes of runs of ``size`` tokens.  ``tokens`` must be a materialised array column."""
    last = F.size(tokens) - cut_last - (size - 1)
    hashes = F.transform(F.sequence(F.lit(first), F.greatest(last, F.lit(first))),
                         lambda i: F.xxhash64(*K.token_run(tokens, i - 1, size)))
    return F.when(last >= first, F.array_distinct(hashes)).otherwise(F.array().cast("array<bigint>"))


def passages_in_texts(passages: DataFrame, passage_id: str, passage: str, texts: DataFrame, text_id: str,
                      text: str) -> DataFrame:
    """``(passage_id, text_id)`` where the text contains the passage, for long texts.

    Tokens strictly inside a passage are whole tokens of every text that contains it, in the same order.  Each passage
    meets the texts that share its rarest run of inner tokens; passages with too few inner tokens fall back to single
    inner tokens, and those without any to character grams.
    """
    texts = texts.select(text_id, F.col(text).alias("_text"))
    tokenized = texts.select(text_id, K.words(F.col("_text")).alias("_t"))
    sized = passages.select(passage_id, F.col(passage).alias("_passage"), K.words(F.col(passage)).alias("_p"))
    sized = sized.withColumn("_inner", F.greatest(F.size("_p") - 2, F.lit(0)))
    found = []
    for size, tier in ((_RUN, F.col("_inner") >= _RUN), (1, (F.col("_inner") >= 1) & (F.col("_inner") < _RUN))):
        chosen = sized.filter(tier)
        if chosen.isEmpty():
            continue
        # Inner runs: from the second to the last but one token.
        own = chosen.select(passage_id, F.explode(_runs(F.col("_p"), size, 2, 1)).alias("_run"))
        wanted = small_side(own.select("_run").distinct())
        in_texts = stored(tokenized.select(text_id, F.explode(_runs(F.col("_t"), size)).alias("_run"))
                          .join(wanted, "_run", "left_semi"), "runs")
        frequency = in_texts.groupBy("_run").agg(F.count("*").alias("_df"))
        rarest = first_per_key(own.join(frequency, "_run", "left").withColumn("_df", F.coalesce("_df", F.lit(0))),
                               [passage_id], F.struct("_df", "_run")).select(passage_id, "_run")
        candidates = rarest.join(in_texts, "_run").select(passage_id, text_id)
        found.append(texts.join(candidates, text_id).join(chosen.select(passage_id, "_passage"), passage_id)
                     .filter(F.col("_text").contains(F.col("_passage"))).select(passage_id, text_id))
    bare = sized.filter(F.col("_inner") == 0).select(passage_id, "_passage")
    if not found or not bare.isEmpty():
        found.append(contains_join(bare, "_passage", texts, "_text").select(passage_id, text_id))
    return reduce(DataFrame.unionByName, found)

"""Top-k per group, and ranks and quantiles that stay distributed when a group is huge."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from querylode.lineage import stored

_SLOTS = 1024


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, out: str = "rank") -> DataFrame:
    """First k rows of each group.  The rank filter lets Spark keep only k rows per group and task
    before the shuffle, so a hot group never travels whole."""
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


def first_per_key(df: DataFrame, keys: list[str], order: Column | str, last: bool = False) -> DataFrame:
    """One whole row per key, by the smallest (or largest) ``order``; partially aggregated before the shuffle."""
    pick = F.max_by if last else F.min_by
    order = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def _with_slot(df: DataFrame, value: str, out: str) -> tuple[DataFrame, list[int]]:
    """``df`` with its value slot between quantile bounds, and the slots that hold a single frequent value.

    Only the bounds (at most ``_SLOTS`` numbers) reach the driver.  A bound met by several quantiles is a frequent
    value and gets a slot of its own.
    """
    shares = F.expr(f"array({', '.join(f'{i / _SLOTS}D' for i in range(_SLOTS))})")
    bounds = df.agg(F.percentile_approx(F.col(value).cast("double"), shares, 4 * _SLOTS)).first()[0] or []
    repeated = {b for b, n in Counter(bounds).items() if n > 1}
    splits = sorted({*bounds, *(math.nextafter(b, math.inf) for b in repeated)})
    if not splits:
        return df.withColumn(out, F.lit(0.0)), []
    from pyspark.ml.feature import Bucketizer

    slots = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol=value, outputCol=out, handleInvalid="keep")
    return slots.transform(df), [i + 1 for i, b in enumerate(splits) if b in repeated]


def running_total(df: DataFrame, by: list[str], value: str, weight: Column, out: str = "running",
                  tie: str | None = None, descending: bool = False) -> DataFrame:
    """Inclusive running sum of ``weight`` inside each group, ordered by ``value`` and then ``tie`` (ascending).

    A single window would sort a whole group in one task.  Rows are first spread over value slots cut at
    quantiles; the slot of a frequent value is cut again by ``tie``.  Slot totals are accumulated per group, and
    only (group, slot) pieces are windowed.  ``value`` and ``tie`` must be numbers (exact as doubles), and
    (value, tie) unique within a group.
    """
    df, frequent = _with_slot(df.withColumn("_weight", weight), value, "_slot")
    if tie is not None and frequent:
        df, _ = _with_slot(df, tie, "_tie_slot")
        df = df.withColumn("_piece", F.when(F.col("_slot").isin(frequent), F.col("_tie_slot")).otherwise(0.0)).drop("_tie_slot")
    else:
        df = df.withColumn("_piece", F.lit(0.0))
    pieces = [*by, "_slot", "_piece"]
    direction = F.desc if descending else F.asc
    across = (W.partitionBy(*(by or [F.lit(0)])).orderBy(direction("_slot"), "_piece")
              .rowsBetween(W.unboundedPreceding, -1))
    before = (df.groupBy(*pieces).agg(F.sum("_weight").alias("_total"))
              .withColumn("_before", F.coalesce(F.sum("_total").over(across), F.lit(0))).drop("_total"))
    inside = W.partitionBy(*pieces).orderBy(direction(value), *([F.asc(tie)] if tie else [])).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    return (df.join(before, pieces).withColumn(out, F.col("_before") + F.sum("_weight").over(inside))
            .drop("_slot", "_piece", "_before", "_weight"))


def competition_rank(df: DataFrame, by: list[str], value: str, out: str = "rank", descending: bool = True) -> DataFrame:
    """``RANK()`` without a single-task window: equal values are counted first."""
    counts = stored(df.groupBy(*by, value).agg(F.count("*").alias("_n")), "counts")
    ranks = running_total(counts, by, value, F.col("_n"), "_upto", descending=descending)
    ranks = ranks.select(*by, value, (F.col("_upto") - F.col("_n") + 1).alias(out))
    return df.join(ranks, [*by, value])


def quantiles(df: DataFrame, by: list[str], value: str, share: float, out: str, count: str | None = None) -> DataFrame:
    """Exact lower and upper ``share`` quantile per group: ``(by, out_low, out_high, n)``.

    The values at positions floor and ceil of ``1 + share * (n - 1)``.  Works on value counts, so repeated
    values shrink before the shuffle; pass ``count`` if the rows already are (value, count) pairs.
    """
    rows = df.filter(F.col(value).isNotNull())
    counts = stored(rows.groupBy(*by, value).agg((F.sum(count) if count else F.count("*")).alias("_n")), "counts")
    upto = running_total(counts, by, value, F.col("_n"), "_upto")
    totals = counts.groupBy(*by).agg(F.sum("_n").alias("n"))
    upto = upto.join(totals, by) if by else upto.withColumn("n", totals.scalar())
    at = F.lit(share) * (F.col("n") - 1) + 1

    def value_at(position: Column) -> Column:
        return F.max(F.when((position <= F.col("_upto")) & (position > F.col("_upto") - F.col("_n")), F.col(value)))

    return upto.groupBy(*by).agg(value_at(F.floor(at)).alias(f"{out}_low"), value_at(F.ceil(at)).alias(f"{out}_high"),
                                 F.max("n").alias("n"))


def lag_in_key(df: DataFrame, key: str, at: str, tie: str, value: str, out: str, piece: Column) -> DataFrame:
    """Previous ``value`` of the same key in (at, tie) order.

    ``piece`` must not decrease with ``at`` (a day, say).  Each (key, piece) is windowed alone, and its first row
    takes the last value of the previous piece from a small summary, so a hot key is split over its pieces.
    """
    df = df.withColumn("_piece", piece)
    inside = W.partitionBy(key, "_piece").orderBy(at, tie)
    last = (df.groupBy(key, "_piece").agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(at, tie)).alias("_last"))
            .withColumn("_carry", F.lag("_last").over(W.partitionBy(key).orderBy("_piece"))).drop("_last"))
    return (df.join(last, [key, "_piece"])
            .withColumn("_rn", F.row_number().over(inside))
            .withColumn(out, F.when(F.col("_rn") == 1, F.col("_carry.v")).otherwise(F.lag(value).over(inside)))
            .drop("_piece", "_carry", "_rn"))

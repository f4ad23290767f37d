"""Size checks before broadcasting, and salted joins beyond the bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is proven to stay under both bounds (reads at most ``max_rows + 1`` rows)."""
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the size is proven; otherwise leave the join to the shuffle strategies."""
    return F.broadcast(df) if fits(df, max_rows) else df


def sided(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast when the size is proven, else a merge join: Spark takes a stored table for as large as its files, and tables that
    compress well are many times that in memory."""
    return F.broadcast(df) if fits(df, max_rows) else df.hint("merge")


def salted_join(big: DataFrame, keyed: DataFrame, on: list[str], spread: Column, how: str = "inner",
                salts: int = 32) -> DataFrame:
    """Join ``big`` to ``keyed`` (few rows per key) with each key split over ``salts`` tasks.

    ``spread`` is any well distributed column of ``big``; ``keyed`` is replicated once per salt.
    """
    left = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


#: Rows of one key that a task takes before the key is split.
HEAVY_ROWS = 100_000


def weighted_join(big: DataFrame, keyed: DataFrame, on: list[str], spread: Column, weight: str, rows: int = HEAVY_ROWS) -> DataFrame:
    """Join ``big`` to ``keyed`` (stored, one row per key, ``weight`` rows of the key in ``big``).

    Only keys above ``rows`` are salted, each over as many tasks as it needs; there are at most ``weight / rows`` of them in all, so what
    is replicated stays below one row per ``rows`` rows of ``big``. The rest is a plain join.
    """
    heavy, other = keyed.filter(F.col(weight) > rows), sided(keyed)
    if heavy.isEmpty():
        return big.join(other, on)
    parts = heavy.select(*on, F.ceil(F.col(weight) / rows).cast("int").alias("_parts"))
    listed = small_side(parts)
    salted = heavy.join(parts, on).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    hot = big.join(listed, on).withColumn("_salt", F.pmod(F.xxhash64(spread), F.col("_parts")).cast("int")).drop("_parts")
    cold = big.join(listed.drop("_parts"), on, "left_anti").join(other, on)
    return cold.unionByName(hot.join(salted, [*on, "_salt"]).drop("_salt"))

"""Small Column and DataFrame helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from querylode import lineage, sizing

#: A word is a run of anything but these six characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def text_of(column: str = "text") -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


#: Keys found this often in one row in ``SAMPLE`` are counted apart from the others.
SAMPLE, HOT = 64, 2_000


def split_hot(rows: DataFrame, key: str, by: str) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` (stored) without and with the keys that are endlessly frequent, so that no task has to take one of those whole.

    A sample by the hash of ``by`` finds them; it decides only how a key is counted, never what comes out.
    """
    seen = rows.where(F.pmod(F.xxhash64(by), F.lit(SAMPLE)) == 0).groupBy(key).agg(F.count("*").alias("n"))
    hot = lineage.stored(seen.where(F.col("n") >= HOT).select(key), "hot-keys")
    if hot.isEmpty():
        return rows, None
    known = sizing.small_side(hot)
    return rows.join(known, key, "left_anti"), rows.join(known, key, "left_semi")

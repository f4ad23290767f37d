"""Model calls as batch functions: text generation with error capture, embeddings, and an embedding cache.

Models are passed as factories and built once per task.  The defaults need no network.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from querylode.functions import sqltext as S
from querylode.functions import tokens as K

# Fixed value: vector length of the collection.
DIMENSION = 1024


class RuleDescriber:
    """Default generator: the deterministic description by the words of the statement."""

    def __call__(self, text: str) -> str:
        for words, out in S.RULE_DESCRIPTIONS:
            if any(w in text for w in words):
                return out
        return S.DEFAULT_DESCRIPTION


def error_class(message: str) -> str:
    low = message.lower()
    if "rate limit" in low:
        return "rate_limit"
    if "timed out" in low or "timeout" in low:
        return "timeout"
    return "other"


def generate(prompts: DataFrame, key: str, text: str, factory: Callable[[], Callable[[str], str]] = RuleDescriber) -> DataFrame:
    """``key, description, error_class, error``: one call per row; a failing row is recorded and the rest go on.

    Give distinct templates: the call is the expensive step, so duplicates must be gone before it.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for pdf in batches:
            rows = []
            for k, t in zip(pdf["k"], pdf["t"]):
                try:
                    rows.append((k, model(t), None, None))
                except Exception as e:  # any model failure belongs to its row
                    rows.append((k, None, error_class(str(e)), str(e)))
            yield pd.DataFrame(rows, columns=["k", "description", "error_class", "error"])

    rows = prompts.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"))
    out = rows.mapInPandas(run, "k string, description string, error_class string, error string")
    return out.withColumnRenamed("k", key)


def split_errors(generated: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(ok, errors)`` of a generation result; store it before splitting, or the model runs twice."""
    ok = generated.filter("error IS NULL").select(key, "description")
    return ok, generated.filter("error IS NOT NULL").select(key, F.lit("generating_desc").alias("stage"), "error_class", "error")


class HashingEmbedder:
    """Default embedding: token counts hashed into a fixed number of slots, L2-normalised."""

    def __init__(self, dimension: int = DIMENSION) -> None:
        self.dimension = dimension
        self.word = re.compile(K.WORD)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            v = np.zeros(self.dimension)
            for w in self.word.findall(text.lower()):
                v[int(hashlib.md5(w.encode()).hexdigest()[:7], 16) % self.dimension] += 1
            norm = np.linalg.norm(v)
            out.append(v / norm if norm else v)
        return out


def embed_udf(factory: Callable[[], Callable[[list[str]], list]] = HashingEmbedder):
    """Iterator UDF: one model per task, one call per Arrow batch, results in input order."""

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for texts in batches:
            vectors = model(texts.tolist())
            yield pd.Series([np.asarray(v, dtype=np.float32) for v in vectors])

    return embed


def embed_with_cache(texts: DataFrame, text: str, cache: DataFrame | None = None, factory=HashingEmbedder) -> DataFrame:
    """``text_key, embedding, cached`` for the distinct texts: only those whose md5 is not in ``cache`` are embedded."""
    wanted = texts.select(F.md5(text).alias("text_key"), F.col(text).alias("_text")).dropDuplicates(["text_key"])
    if cache is None:
        return wanted.select("text_key", embed_udf(factory)("_text").alias("embedding"), F.lit(False).alias("cached"))
    fresh = wanted.join(cache.select("text_key"), "text_key", "left_anti")
    fresh = fresh.select("text_key", embed_udf(factory)("_text").alias("embedding"), F.lit(False).alias("cached"))
    known = cache.select("text_key", "embedding").join(wanted.select("text_key"), "text_key", "left_semi")
    return known.withColumn("cached", F.lit(True)).unionByName(fresh)

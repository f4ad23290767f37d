from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, and columns whose names operators use themselves."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, None, None, None, None), (2, "", "en", "b", 0), (3, " \n\t ", "en", "b", 4), (4, long, "en", "a", None), (5, base, "de", "a", 9),
        (5, base, "de", "a", 9), (6, base.replace(" ", "\n"), "de", None, 9), (None, "no id here", "en", "a", 1), (7, "x", "fr", "é", 1),
        (8, "Ünïcödé 𝔘 text", "fr", "Z", 3), (9, base + " thirteen", "en", "b", 3), (9, "other text of the same id", "en", "b", 3),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS)
    for name in ("row", "hash", "norm", "score", "size", "token", "set", "target", "label", "toxic", "key", "block", "words", "_row", "_key", "_id", "id", "doc"):
        df = df.withColumn(name, F.lit("clash"))
    return df.cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")

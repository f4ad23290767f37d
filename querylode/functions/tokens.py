"""Word tokens and character shingles as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Token pattern and stop words of the keyword extractor.
WORD = r"([가-힣]+|[A-Za-z0-9_]+)"
STOPWORDS = ("을", "를", "이", "가", "에", "의", "로", "와", "과", "해", "줘", "해줘", "보여줘", "필요해")

# Site codes, bilingual topics and the keywords each topic adds.
FAB_ID = r"(?i)(M10|M11|M14|M15|M16)"
TOPICS = {
    "yield": ("수율", ("yield", "수율", "PRD_YIELD")),
    "defect": ("불량", ("defect", "불량", "DEF")),
    "equipment": ("설비", ("equipment", "설비", "EQP")),
    "production": ("생산", ("생산", "PRD")),
    "tracking": ("트래킹", ("tracking", "트래킹", "TRK")),
}


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(1))


def unnest(df: DataFrame, array: str, out: str) -> DataFrame:
    """One row per element; no row for an empty array.

    Spark adds a size filter below a plain ``explode`` of a column and pushes it down together with the expression that
    made the column, which would tokenise every text again.  The outer form has no such filter.
    """
    rest = [c for c in df.columns if c != array]
    return df.select(*rest, F.explode_outer(array).alias(out)).filter(F.col(out).isNotNull())


def keywords(text: Column) -> Column:
    """Words longer than one character that are no stop words; order and duplicates kept."""
    return F.filter(words(text), lambda w: ~w.isin(*STOPWORDS) & (F.length(w) > 1))


def search_tokens(text: Column) -> Column:
    """Lower-cased words without a stop list."""
    return words(F.lower(text))


def entities(text: Column) -> Column:
    """Site codes and keywords mentioned in a text, distinct."""
    return F.array_distinct(F.concat(F.regexp_extract_all(text, F.lit(FAB_ID), F.lit(1)), keywords(text)))


def topics(text: Column, table: dict = TOPICS) -> Column:
    """Names of the topics mentioned in a text in either language."""
    hits = [F.when(F.lower(text).contains(name) | text.contains(other), F.lit(name))
            for name, (other, _) in table.items()]
    return F.array_compact(F.array(*hits))


def topic_keywords(names: Column, table: dict = TOPICS) -> Column:
    """Keywords added by the given topics."""
    empty = F.array().cast("array<string>")
    return F.concat(*[F.when(F.array_contains(names, name), F.array(*map(F.lit, extra))).otherwise(empty)
                      for name, (_, extra) in table.items()])


def char_shingles(text: Column, k: int = 3) -> Column:
    """Distinct character k-shingles of the lower-cased text; none if it is shorter than k."""
    # A look-ahead matches at every position, so the scan stays linear in the text length.
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(rf"(?s)(?=(.{{{k}}}))"), F.lit(1)))


def token_run(tokens: Column, at: Column, k: int) -> list[Column]:
    """The k tokens from position ``at`` (0-based) on, by constant-time access (``slice`` copies the array)."""
    return [F.get(tokens, at + i) for i in range(k)]


def token_shingles(tokens: Column, k: int = 5) -> Column:
    """Distinct runs of k tokens; the whole list if it is shorter.  ``tokens`` must be a materialised array column:
    it is read once per run."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - k, F.lit(0)))
    return F.when(F.size(tokens) > 0, F.array_distinct(
        F.transform(starts, lambda i: F.concat_ws(" ", *token_run(tokens, i, k))))
    ).otherwise(F.array().cast("array<string>"))


def hash28(text: Column) -> Column:
    """Portable 28-bit hash: the first seven hex digits of md5."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")

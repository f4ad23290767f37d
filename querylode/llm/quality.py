"""Quality rules as a ledger: every rule is evaluated once, its failure kept as a bit beside the measurements.

Policies are versioned sets of rules and need the ledger alone, not the texts: a policy is a mask, its verdict ``bits & mask = 0``,
and an ablation an aggregate over the bits. All of it is built from Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from querylode.llm import common

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
#: Rule name -> failure as SQL over the measurements; the position is the bit. New rules go to the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "n_dup_lines > 3 and 100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 20 * n_words",
    "shouting": "2 * n_shouted > n_words and n_words > 0",
}
BASE = ("few_words", "repeated_windows")
#: Version -> rules it applies.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "repeated_lines", "word_length", "shouting"),
}


def mask_of(rules: tuple[str, ...]) -> int:
    order = list(RULES)
    return sum(1 << order.index(rule) for rule in rules)


def _covered(windows: Column) -> Column:
    """Positions inside windows whose hash occurs twice or more: sort (hash, start), keep starts with an equal neighbour, add up."""

    def repeated(ordered: Column) -> Column:
        size = F.size(ordered)

        def twin(item: Column, at: Column) -> Column:
            before = F.get(ordered, at - 1)["hash"] == item["hash"]
            after = F.get(ordered, at + 1)["hash"] == item["hash"]
            return ((at > 0) & F.coalesce(before, F.lit(False))) | ((at < size - 1) & F.coalesce(after, F.lit(False)))

        return F.sort_array(F.transform(F.filter(ordered, twin), lambda item: item["start"]))

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("start"))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def add(state: Column, begin: Column) -> Column:
        end = begin + WINDOW
        return F.struct(end.alias("end"), (state["total"] + F.least(F.lit(WINDOW), end - state["end"])).alias("total"))

    return F.aggregate(common.let(pairs, repeated), start, add)["total"]


def repeat_words(words: Column) -> Column:
    """Words inside ``WINDOW``-word windows that the text holds twice or more, the first occurrence included."""
    n = F.size(words)

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashes, i, F.lit(WINDOW))))

    def count(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) < F.size(found), _covered(found)).otherwise(0)

    hashed = common.let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.when(n > WINDOW, common.let(hashed, count)).otherwise(0)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every whole text (null: no words); other columns are ignored."""
    text = common.text_of()
    rows = docs.select("doc_id", text.alias("text"), common.words_of(text).alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(common.WORD))
    rows = rows.select("doc_id", "text", "words", lines.alias("lines"))
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("text", F.lit(r"\p{Lu}{2,}[^\x20\x09-\x0D\p{Ll}]*(?=[\x20\x09-\x0D]|$)")).cast("long").alias("n_shouted"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements with ``bits``: bit i is set where rule i fails."""
    bits = F.lit(0).cast("long")
    for at, failure in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(failure), F.lit(1 << at)).otherwise(0).cast("long"))
    return measured(docs).withColumn("bits", bits)


def judged(rows: DataFrame, version: str) -> DataFrame:
    """Apply a policy to a ledger: ``base_failed``, ``kept`` and the failed bits that the policy knows."""
    known = F.col("bits").bitwiseAND(F.lit(mask_of(POLICIES[version])).cast("long"))
    return (
        rows.withColumn("base_failed", F.col("bits").bitwiseAND(F.lit(mask_of(BASE)).cast("long")) != 0)
        .withColumn("failed_bits", known)
        .withColumn("kept", ~F.col("base_failed") & (known == 0))
    )


def ablations(rows: DataFrame, version: str) -> DataFrame:
    """Per rule of a policy: rows it fails, and rows that would come back without it. One aggregate over the bits."""
    names = POLICIES[version]
    mask = mask_of(names)
    known = rows.select(F.col("bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).groupBy("bits").agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask_of((r,))).cast("long").alias("bit")) for r in names])
    return (
        known.select("bits", "n", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
            F.bit_or(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("bits")).otherwise(0)).alias("failed_with"),
        )
    )

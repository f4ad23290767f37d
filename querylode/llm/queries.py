"""The registered queries of the operators, with the SQL that checks them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from querylode import lineage
from querylode.llm import (
    alignment, common, exact_dedup, html_text, mixing, ngram_join, packing, quality, simhash, sql, suffix_dedup, token_files, toxicity, url_filter, whitening,
)

#: Vocabulary of the queries; the operators take any path.
VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or model verdict of every page's url."""
    return url_filter.filter_urls(common.table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(common.table(spark, sf_dir, "pages", "page_id", "html"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents' ids to the shared folder and reads them back."""
    path = f"{lineage.shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write(common.table(spark, sf_dir, "documents", "doc_id", "text"), path, vocabulary(), end=2)
    return token_files.read_documents(spark, path)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(common.table(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "draws")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(common.table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary(), end=0)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(common.table(spark, sf_dir, "documents", "doc_id", "text")).drop("row")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(common.table(spark, sf_dir, "documents", "doc_id", "text"), common.table(spark, sf_dir, "labels"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-word shingles at a similarity of 0.9."""
    return ngram_join.near_duplicates(common.table(spark, sf_dir, "documents", "doc_id", "text"), size=3, percent=90)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(common.table(spark, sf_dir, "documents", "doc_id", "text"), length=400)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judged(quality.ledger(common.table(spark, sf_dir, "documents", "doc_id", "text")), "v2")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                       "n_lines", "n_shouted", F.col("failed_bits"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per vector and component, up to eight components."""
    rows, fit = whitening.whiten(common.table(spark, sf_dir, "embeddings", "vec_id", "embedding"), components=8)
    explained = F.array(*[F.lit(float(e)) for e in fit["explained"][:8]]) if fit["n"] else F.array().cast("array<double>")
    # The contract's long; null if a corpus is so large that the exact value is none.
    each = rows.select("vec_id", F.col("deviation").try_cast("long").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fit["n"]).cast("long").alias("n"), "deviation", "whitened",
                       F.get(explained, F.col("at")).alias("explained"), F.lit(fit["identity_error"]).alias("identity_error"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 3-word shingles, linked at two differing bits or less."""
    return simhash.near_duplicates(common.table(spark, sf_dir, "documents", "doc_id", "text"), size=3)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The byte-level vocabulary against the piece model over all documents."""
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    return alignment.align(docs, vocabulary(), public_tokenizers.path(PIECES))[0]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_html_text": op2_html_text,
    "op3_token_files": op3_token_files,
    "op4_mixing": op4_mixing,
    "op5_packing": op5_packing,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_ngram_join": op8_ngram_join,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_whitening": op11_whitening,
    "op12_simhash": op12_simhash,
    "op13_alignment": op13_alignment,
}
SQL: dict[str, str] = {"op6_exact_dedup": sql.EXACT_DEDUP, "op10_quality_rules": sql.QUALITY}

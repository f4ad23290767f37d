"""Retrieval over documents, pages and embeddings."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from querylode import lineage
from querylode.operators import containment, evaluation, retrieval as R
from querylode.sources import derived
from workbook import duck as D, query

POSTINGS = f"""tokens AS (SELECT doc_id AS doc, {D.tokens('text')} AS t FROM documents),
post AS (SELECT doc, length, term, count(*) AS tf FROM (SELECT doc, len(t) AS length, unnest(t) AS term FROM tokens) GROUP BY ALL),
corpus AS (SELECT count(*) AS n, CAST(sum(len(t)) AS DOUBLE) / count(*) AS mean_length FROM tokens),
freq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
terms AS (SELECT query, term, count(*) AS qtf FROM (SELECT item_id AS query, unnest({D.tokens('text')}) AS term FROM benchmark) GROUP BY ALL)"""
BM25 = """bm25 AS (SELECT query, doc, sum(qtf * ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / mean_length))) AS score
  FROM terms JOIN freq USING (term) JOIN post USING (term), corpus GROUP BY query, doc)"""
TFIDF = """raw AS (SELECT doc, term, tf * (ln(CAST(n + 1 AS DOUBLE) / (df + 1)) + 1) AS w FROM post JOIN freq USING (term), corpus),
tfidf AS (SELECT doc, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS weight FROM raw),
qraw AS (SELECT query, term, qtf * (ln(CAST(n + 1 AS DOUBLE) / (df + 1)) + 1) AS w FROM terms JOIN freq USING (term), corpus),
qw AS (SELECT query, term, w / sqrt(sum(w * w) OVER (PARTITION BY query)) AS q FROM qraw),
cosine AS (SELECT query, doc, sum(q * weight) AS score FROM qw JOIN tfidf USING (term) GROUP BY query, doc)"""


def top(source: str, k: int, name: str = "ranked") -> str:
    return f"""{name} AS (SELECT * FROM (SELECT query, doc, score, CAST(row_number() OVER (PARTITION BY query
  ORDER BY round(score, 9) DESC, doc) AS INTEGER) AS rank FROM {source}) WHERE rank <= {k})"""


def fused(w: float) -> str:
    return f"""fused AS (SELECT query, doc, {w} * coalesce(c.score, 0) + {1 - w} * coalesce(b.score, 0) / max(b.score) OVER (PARTITION BY query) AS score
  FROM cosine c FULL JOIN bm25 b USING (query, doc))"""


OUT = "SELECT query, doc, rank, round(score, 6) AS score FROM ranked"


def _out(df):
    return df.select("query", "doc", "rank", F.round("score", 6).alias("score"))


def _index(spark, d):
    return R.Index(derived.table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


def _items(spark, d):
    return derived.table(spark, d, "benchmark")


@query("r1_tfidf_weights", D.with_(POSTINGS, TFIDF) + "SELECT doc, term, round(weight, 6) AS weight FROM tfidf")
def r1(spark, d):
    return _index(spark, d).weights.select("doc", "term", F.round("cosine", 6).alias("weight"))


@query("r2_cosine_search", D.with_(POSTINGS, TFIDF, top("cosine", 10)) + OUT)
def r2(spark, d):
    return _out(R.cosine_search(_items(spark, d), "item_id", "text", _index(spark, d), 10))


@query("r2_dense_cosine", """
WITH c AS (SELECT label, pos, avg(x) AS x FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL),
e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
SELECT vec_id, round(sum(CAST(e.x AS DOUBLE) * c.x) / sqrt(sum(CAST(e.x AS DOUBLE) * e.x)) / sqrt(sum(c.x * c.x)), 5) AS similarity
FROM e JOIN c USING (label, pos) GROUP BY vec_id""")
def r2_dense(spark, d):
    vectors = derived.table(spark, d, "embeddings")
    rows = vectors.join(_centroids(vectors).withColumnRenamed("query", "label"), "label")
    return rows.select("vec_id", F.round(R.cosine(F.col("embedding"), F.col("vector")), 5).alias("similarity"))


@query("r3_bm25_search", D.with_(POSTINGS, BM25, top("bm25", 10)) + OUT)
def r3(spark, d):
    return _out(R.bm25_search(_items(spark, d), "item_id", "text", _index(spark, d), 10))


@query("r4_fused_search", D.with_(POSTINGS, TFIDF, BM25, fused(0.7), top("fused", 5)) + OUT)
def r4(spark, d):
    return _out(R.fused_search(_items(spark, d), "item_id", "text", _index(spark, d), 5)[R.VECTOR_WEIGHT])


def _segmented(spark, d):
    """The documents in three batches, the first of which also holds a half of the last as older versions, and some that are removed again."""
    docs = derived.table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    index = R.SegmentedIndex(spark, f"{lineage.shared_dir(spark)}/segments-{uuid.uuid4().hex}")
    older = docs.where(part == 3).withColumn("text", F.concat(F.lit("an older version "), "text"))
    index.append(docs.where(part == 0).unionByName(older), "doc_id", "text")
    index.open()
    index.append(docs.where(part.isin(1, 2)).unionByName(docs.where(part == 0).withColumn("doc_id", -1 - F.col("doc_id"))), "doc_id", "text")
    index.remove(docs.where(part == 0).select((-1 - F.col("doc_id")).alias("doc_id")), "doc_id")
    index.append(docs.where(part == 3), "doc_id", "text")
    return index


@query("r3_segmented_search", D.with_(POSTINGS, BM25, top("bm25", 10)) + OUT)
def r3_segmented(spark, d):
    """Grown by appends, replacements and removals, the index answers as one that was built at once."""
    return _out(R.bm25_search(_items(spark, d), "item_id", "text", _segmented(spark, d).open(), 10))


@query("r2_compacted_search", D.with_(POSTINGS, TFIDF, top("cosine", 10)) + OUT)
def r2_compacted(spark, d):
    index = _segmented(spark, d)
    index.compact()
    return _out(R.cosine_search(_items(spark, d), "item_id", "text", index.open(), 10))


def _centroids(vectors):
    long = vectors.select("label", F.posexplode("embedding").alias("pos", "x"))
    means = long.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    rows = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("v"))
    return rows.select(F.col("label").cast("long").alias("query"), F.col("v.x").alias("vector"))


_CENTROIDS = """c AS (SELECT label AS query, pos, avg(CAST(x AS DOUBLE)) AS x FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL),
e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
dist AS (SELECT CAST(query AS BIGINT) AS query, vec_id AS id, sum((e.x - c.x) * (e.x - c.x)) AS distance FROM e JOIN c USING (pos) GROUP BY ALL)"""


@query("r6_vector_search", D.with_(_CENTROIDS) + """
SELECT query, id, rank, round(distance, 5) AS distance FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY distance, id) AS INTEGER) AS rank FROM dist)
WHERE rank <= 10""")
def r6(spark, d):
    vectors = derived.table(spark, d, "embeddings")
    hits = R.vector_search(_centroids(vectors), vectors.select("vec_id", "embedding"), 10)
    return hits.withColumn("distance", F.round("distance", 5))


def _asked(vectors):
    """Every hundredth vector asks."""
    return vectors.where("vec_id % 100 = 0").select("vec_id", "embedding")


@query("r7_cell_search_recall")
def r7(spark, d):
    vectors = derived.table(spark, d, "embeddings")
    queries, rows = _asked(vectors), vectors.select("vec_id", "embedding")
    found = R.CellIndex(rows).search(queries, 10, nprobe=40)
    return R.recall(found, R.vector_search(queries, rows, 10))


@query("r7_cell_search", """WITH c AS (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL),
e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
near AS (SELECT vec_id, label, row_number() OVER (PARTITION BY vec_id ORDER BY sum((e.x - c.x) * (e.x - c.x))) AS place FROM e JOIN c USING (pos) GROUP BY vec_id, label),
pairs AS (SELECT q.vec_id AS query, r.vec_id AS id FROM near q JOIN near r ON q.label = r.label AND q.place <= 3 AND r.place = 1 WHERE q.vec_id % 100 = 0),
dist AS (SELECT query, id, sum((a.x - b.x) * (a.x - b.x)) AS distance FROM pairs JOIN e a ON a.vec_id = query JOIN e b ON b.vec_id = id AND b.pos = a.pos GROUP BY ALL)
SELECT query, id, rank, round(distance, 5) AS distance FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY distance, id) AS INTEGER) AS rank FROM dist) WHERE rank <= 10""")
def r7_cells(spark, d):
    """Three probes over cells whose centres are given: the means of the labels."""
    vectors = derived.table(spark, d, "embeddings")
    index = R.CellIndex(vectors.select("vec_id", "embedding"), centers=_centroids(vectors))
    return index.search(_asked(vectors), 10, nprobe=3).withColumn("distance", F.round("distance", 5))


def _page_field(field: str) -> str:
    return f"""{field}_t AS (SELECT page_id AS doc, {D.tokens(field)} AS t FROM pages),
{field}_p AS (SELECT doc, length, term, count(*) AS tf FROM (SELECT doc, len(t) AS length, unnest(t) AS term FROM {field}_t) GROUP BY ALL),
{field}_s AS (SELECT query, doc, sum(qtf * ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / m))) AS score
  FROM terms JOIN (SELECT term, count(*) AS df FROM {field}_p GROUP BY term) USING (term) JOIN {field}_p USING (term),
  (SELECT count(*) AS n, CAST(sum(len(t)) AS DOUBLE) / count(*) AS m FROM {field}_t) GROUP BY query, doc)"""


@query("r8_multi_field_search", D.with_(
    f"terms AS (SELECT query, term, count(*) AS qtf FROM (SELECT item_id AS query, unnest({D.tokens('text')}) AS term FROM benchmark) GROUP BY ALL)",
    _page_field("url"), _page_field("html"),
    "best AS (SELECT query, doc, max(score) AS score FROM (FROM url_s UNION ALL FROM html_s) GROUP BY query, doc)",
    top("best", 10)) + OUT)
def r8(spark, d):
    pages = derived.table(spark, d, "pages")
    return _out(R.best_field_search(_items(spark, d), "item_id", "text", pages, "page_id", ["url", "html"], 10))


TRUTH = "truth AS (SELECT item_id AS query, doc_id AS doc FROM benchmark b JOIN documents d ON contains(d.text, b.text))"


@query("e0_passages_in_documents", D.with_(TRUTH) + "SELECT query, doc FROM truth")
def e0(spark, d):
    return _truth(spark, d)


def _truth(spark, d):
    found = containment.passages_in_texts(_items(spark, d), "item_id", "text", derived.table(spark, d, "documents"), "doc_id", "text")
    return found.select(F.col("item_id").alias("query"), F.col("doc_id").alias("doc"))


def metrics(key: str, queries: str, ranked: str = "ranked", truth: str = "truth", item: str = "doc") -> str:
    return f"""scored AS (SELECT {key}, CASE WHEN first <= 5 THEN 1.0 ELSE 0.0 END AS hit_rate_at_k, coalesce(1.0 / first, 0) AS mrr,
  CASE WHEN predicted > 0 THEN CAST(correct AS DOUBLE) / predicted ELSE 0 END AS p, CASE WHEN wanted > 0 THEN CAST(correct AS DOUBLE) / wanted ELSE 0 END AS r
  FROM (SELECT {key}, coalesce(predicted, 0) AS predicted, coalesce(correct, 0) AS correct, first, coalesce(wanted, 0) AS wanted
    FROM {queries} LEFT JOIN (SELECT r.{key}, count(*) AS predicted, count(t.{key}) AS correct, min(CASE WHEN t.{key} IS NOT NULL THEN rank END) AS first
      FROM {ranked} r LEFT JOIN {truth} t ON r.{key} = t.{key} AND r.{item} = t.{item} GROUP BY r.{key}) USING ({key})
    LEFT JOIN (SELECT {key}, count(*) AS wanted FROM {truth} GROUP BY {key}) USING ({key})))"""


SCORES = """CAST(hit_rate_at_k AS DOUBLE) AS hit_rate_at_k, round(CAST(mrr AS DOUBLE), 6) AS mrr, round(p, 6) AS precision, round(r, 6) AS recall,
  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1_score"""
MEANS = """round(CAST(avg(hit_rate_at_k) AS DOUBLE), 6) AS hit_rate_at_k, round(CAST(avg(CAST(mrr AS DOUBLE)) AS DOUBLE), 6) AS mrr, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall,
  round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END), 6) AS f1_score, CAST(count(*) AS BIGINT) AS queries"""


def rounded(df):
    for m in evaluation.METRICS:
        df = df.withColumn(m, F.round(m, 6))
    return df


_ITEMS = "items AS (SELECT item_id AS query FROM benchmark)"


@query("e1_search_metrics", D.with_(POSTINGS, BM25, top("bm25", 10), TRUTH, _ITEMS, metrics("query", "items")) + f"SELECT query, {SCORES} FROM scored")
def e1(spark, d):
    ranked = R.bm25_search(_items(spark, d), "item_id", "text", _index(spark, d), 10)
    queries = _items(spark, d).select(F.col("item_id").alias("query"))
    return rounded(evaluation.evaluate(queries, ranked, _truth(spark, d), "query", "doc"))


def _config(name: str, w: float) -> str:
    return (f"SELECT '{name}' AS config, * FROM (" + D.with_(POSTINGS, TFIDF, BM25, fused(w), top("fused", 5), TRUTH, _ITEMS,
            metrics("query", "items")) + f"SELECT {MEANS} FROM scored)")


CONFIGS = {"vector only": 1.0, "bm25 only": 0.0, "hybrid 0.7": 0.7, "hybrid 0.5": 0.5}


@query("e2_fusion_sweep", "\nUNION ALL ".join(_config(n, w) for n, w in CONFIGS.items()))
def e2(spark, d):
    found = R.fused_search(_items(spark, d), "item_id", "text", _index(spark, d), 5, tuple(CONFIGS.values()))
    runs = {n: found[w] for n, w in CONFIGS.items()}
    queries = _items(spark, d).select(F.col("item_id").alias("query"))
    return rounded(evaluation.sweep(runs, queries, _truth(spark, d), "query", "doc"))

"""Near duplicates among logged statements and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from querylode.functions import tokens as K
from querylode.operators import neardup as N
from querylode.sources import derived
from workbook import duck as D, query

_A, _B = N.permutations()
_BANDS, _ROWS = N.bands_and_rows()
ITEMS = f"""items AS (SELECT min(sql_id) AS id, text, CAST(count(*) AS BIGINT) AS copies, CAST(sum(exec_count) AS BIGINT) AS exec_count
  FROM (SELECT sql_id, exec_count, {D.canonical('sql_text')} AS text FROM sql_logs) GROUP BY text)"""
SHINGLES = """shingles AS (SELECT id, list_distinct(list_transform(range(1, length(text) - 1), lambda i: substr(lower(text), i, 3))) AS s FROM items)"""
HASHES = """hashes AS (SELECT id, CAST(('0x' || substr(md5(unnest(s)), 1, 7)) AS BIGINT) AS h FROM shingles)"""
SIGNATURES = f"""perms AS (SELECT unnest({_A}::BIGINT[]) AS a, unnest({_B}::BIGINT[]) AS b, unnest(range(0, {N.NUM_PERM})) AS slot),
slots AS (SELECT id, slot, min((a * h + b) % {N.PRIME}) AS value FROM hashes, perms GROUP BY id, slot)"""
BUCKETS = f"""buckets AS (SELECT id, slot // {_ROWS} AS band, md5(string_agg(CAST(value AS VARCHAR), ',' ORDER BY slot)) AS bucket
  FROM slots WHERE slot < {_BANDS * _ROWS} GROUP BY id, slot // {_ROWS})"""
LINKS = """links AS (SELECT DISTINCT id, leader FROM (SELECT id, min(id) OVER (PARTITION BY band, bucket) AS leader FROM buckets) WHERE id <> leader)"""
COMPONENTS = """edges AS (SELECT id AS a, leader AS b FROM links UNION SELECT leader, id FROM links),
reach AS (SELECT id AS a, id AS b FROM items UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
labels AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY a)"""
CTES = (D.LOGS, ITEMS, SHINGLES, HASHES, SIGNATURES, BUCKETS, LINKS)


def _recursive(*ctes: str) -> str:
    return D.with_(*ctes).replace("WITH ", "WITH RECURSIVE ", 1)


def _items(spark, d):
    return N.statements(derived.sql_logs(spark, d))


def _signed(spark, d):
    return N.signatures(_items(spark, d), K.char_shingles(F.col("text"), N.SHINGLE))


def _labels(spark, d):
    items = N.stored(_items(spark, d), "statements")
    link = N.links(items, K.char_shingles(F.col("text"), N.SHINGLE))
    return items, N.components(items, link)


@query("m1_char_shingles", D.with_(D.LOGS, ITEMS, SHINGLES) + """
SELECT id, CAST(len(s) AS BIGINT) AS shingles, array_to_string(list_sort(s), '|') AS text FROM shingles""")
def m1(spark, d):
    rows = _items(spark, d).select("id", K.char_shingles(F.col("text"), N.SHINGLE).alias("s"))
    return rows.select("id", F.size("s").cast("long").alias("shingles"), F.array_join(F.array_sort("s"), "|").alias("text"))


@query("m2_minhash_signatures", D.with_(*CTES[:5]) + """
SELECT id, string_agg(CAST(value AS VARCHAR), ',' ORDER BY slot) AS signature FROM slots GROUP BY id""")
def m2(spark, d):
    rows = _signed(spark, d).select("id", F.array_join(F.col("signature").cast("array<string>"), ",").alias("signature"))
    return rows


@query("m3_lsh_buckets", D.with_(*CTES[:6]) + """
SELECT id, CAST(band AS INTEGER) AS band, bucket FROM buckets""")
def m3(spark, d):
    return N.bands(_signed(spark, d), _BANDS, _ROWS)


@query("m3_lsh_links", D.with_(*CTES) + "SELECT id, leader FROM links")
def m3_links(spark, d):
    return N.links(_items(spark, d), K.char_shingles(F.col("text"), N.SHINGLE))


@query("m4_link_similarity", D.with_(*CTES) + f"""
SELECT l.id, l.leader, round(avg(CASE WHEN x.value = y.value THEN 1.0 ELSE 0.0 END), 6) AS estimated, any_value(j) AS jaccard
FROM (SELECT l.id, l.leader, round(CAST(len(list_intersect(a.s, b.s)) AS DOUBLE) / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))), 6) AS j
  FROM links l JOIN (SELECT id, list(DISTINCT h) AS s FROM hashes GROUP BY id) a ON a.id = l.id JOIN (SELECT id, list(DISTINCT h) AS s FROM hashes GROUP BY id) b ON b.id = l.leader) l
JOIN slots x ON x.id = l.id JOIN slots y ON y.id = l.leader AND y.slot = x.slot GROUP BY l.id, l.leader""")
def m4(spark, d):
    signed = N.stored(_signed(spark, d), "signatures")
    rows = N.link_similarity(signed, N.bucket_links(N.bands(signed, _BANDS, _ROWS)))
    return rows.withColumn("estimated", F.round("estimated", 6)).withColumn("jaccard", F.round("jaccard", 6))


_GROUPED = "grouped AS (SELECT s.*, substr(i.text, 1, 6) AS grp FROM slots s JOIN items i USING (id))"


@query("m5_group_quality", D.with_(*CTES[:5], _GROUPED) + f"""
SELECT a.grp, CAST(count(DISTINCT a.id) AS BIGINT) AS members,
  round(avg(CASE WHEN a.id < b.id THEN CASE WHEN a.value = b.value THEN 1.0 ELSE 0.0 END END), 6) AS intra
FROM grouped a JOIN grouped b ON a.grp = b.grp AND a.slot = b.slot GROUP BY a.grp""")
def m5(spark, d):
    signed = _signed(spark, d).withColumn("grp", F.substring("text", 1, 6))
    return N.group_quality(signed, "grp")[0].select("grp", "members", F.round("intra", 6).alias("intra"))


@query("m5_separation", D.with_(*CTES[:5], _GROUPED) + f"""
, counts AS (SELECT grp, slot, value, count(*) AS n FROM grouped GROUP BY ALL)
, sizes AS (SELECT grp, count(DISTINCT id) AS m FROM grouped GROUP BY grp)
, intra AS (SELECT sum(n * (n - 1) / 2.0) / {N.NUM_PERM} / (SELECT sum(m * (m - 1) / 2.0) FROM sizes) AS v FROM counts)
, inter AS (SELECT avg(s) AS v FROM (SELECT x.grp AS g1, y.grp AS g2, coalesce(sum(CAST(a.n AS DOUBLE) * b.n), 0) / {N.NUM_PERM} / x.m / y.m AS s
    FROM (SELECT x.*, y.grp AS og, y.m AS om FROM sizes x JOIN sizes y ON x.grp < y.grp) x JOIN sizes y ON y.grp = x.og
    LEFT JOIN counts a ON a.grp = x.grp LEFT JOIN counts b ON b.grp = y.grp AND b.slot = a.slot AND b.value = a.value GROUP BY x.grp, y.grp, x.m, y.m))
SELECT (SELECT CAST(count(*) AS BIGINT) FROM sizes) AS groups, round(CAST(intra.v AS DOUBLE), 6) AS avg_intra, round(inter.v, 6) AS avg_inter,
  round(CAST(intra.v AS DOUBLE) - inter.v, 6) AS separation FROM intra, inter""")
def m5_separation(spark, d):
    signed = _signed(spark, d).withColumn("grp", F.substring("text", 1, 6))
    out = N.group_quality(signed, "grp")[1]
    return out.select("groups", *[F.round(c, 6).alias(c) for c in ("avg_intra", "avg_inter", "separation")])


@query("d3_batch_dedup", _recursive(*CTES, COMPONENTS) + """
SELECT id, text, copies FROM items WHERE id IN (SELECT component FROM labels)""")
def d3(spark, d):
    return N.keep_representatives(*_labels(spark, d)).select("id", "text", "copies")


@query("d5_template_clusters", _recursive(*CTES, COMPONENTS) + """
SELECT component, first(id ORDER BY exec_count DESC, id) AS representative, CAST(count(*) AS BIGINT) AS members,
  CAST(sum(exec_count) AS BIGINT) AS total_exec_count FROM items JOIN labels USING (id) GROUP BY component""")
def d5(spark, d):
    return N.representatives(*_labels(spark, d))


@query("d4_search_before_insert")
def d4(spark, d):
    items = _items(spark, d).select("id", "text")
    logs = derived.sql_logs(spark, d)
    cutoff = F.lit("2024-01-15").cast("timestamp_ntz")
    old = N.statements(logs.filter(F.col("collected_at") < cutoff)).select("id", "text")
    new = items.join(old.select("text"), "text", "left_anti").select("id", "text")
    return N.search_before_insert(new, old).withColumn("similarity", F.round("similarity", 6))


_DOC_BANDS, _DOC_ROWS = N.bands_and_rows(0.8)
DOC_LINKS = f"""items AS (SELECT min(doc_id) AS id, text FROM documents WHERE text IS NOT NULL GROUP BY text),
toks AS (SELECT id, {D.tokens('text')} AS t FROM items),
shingles AS (SELECT id, list_distinct(list_transform(range(1, greatest(len(t) - 5, 0) + 2), lambda i: array_to_string(t[i : i + 4], ' '))) AS s FROM toks WHERE len(t) > 0),
{HASHES},
{SIGNATURES},
buckets AS (SELECT id, slot // {_DOC_ROWS} AS band, md5(string_agg(CAST(value AS VARCHAR), ',' ORDER BY slot)) AS bucket
  FROM slots WHERE slot < {_DOC_BANDS * _DOC_ROWS} GROUP BY id, slot // {_DOC_ROWS}), {LINKS}"""


@query("m3_document_links", D.with_(DOC_LINKS) + "SELECT id, leader FROM links")
def m3_documents(spark, d):
    """Near copies among the documents by token shingles."""
    docs = N.distinct_texts(derived.table(spark, d, "documents"), "doc_id", "text")
    docs = docs.withColumn("_t", K.search_tokens(F.col("text"))).select("id", "_t")
    return N.links(docs, K.token_shingles(F.col("_t"), 5), threshold=0.8)

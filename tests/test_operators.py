import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from querylode.functions import tokens as K
from querylode.operators import containment, evaluation, inference, joinability, linking, neardup as N, ordering, retrieval as R
from querylode.sinks import tables as sinks


def test_running_total_with_hot_value_and_group(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 7}", float(5 if i % 2 else rng.randrange(50)), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, v double, id long")
    got = {(r.g, r.id): r.rn for r in ordering.running_total(df, ["g"], "v", F.lit(1), "rn", tie="id", descending=True).collect()}
    for g in {r[0] for r in rows}:
        want = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        assert [got[g, r[2]] for r in want] == list(range(1, len(want) + 1))


def test_rank_quantile_and_lag(spark):
    rows = [(1, 10.0, 1), (1, 10.0, 2), (1, 7.0, 3), (2, 1.0, 4)]
    df = spark.createDataFrame(rows, "k int, v double, id long")
    assert sorted((r.id, r["rank"]) for r in ordering.competition_rank(df, [], "v").collect()) == [(1, 1), (2, 1), (3, 3), (4, 4)]
    mid = {r.k: (r.m_low, r.m_high) for r in ordering.quantiles(df, ["k"], "v", 0.5, "m").collect()}
    assert mid == {1: (10.0, 10.0), 2: (1.0, 1.0)}
    lagged = ordering.lag_in_key(df, "k", "id", "id", "v", "p", F.floor(F.col("id") / 2))
    assert sorted((r.id, r.p) for r in lagged.collect()) == [(1, None), (2, 10.0), (3, 10.0), (4, None)]


def test_contains_join_matches_brute_force(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab_") for _ in range(rng.randrange(1, 12))) for _ in range(80)]
    needles = sorted({"".join(rng.choice("ab_") for _ in range(rng.randrange(1, 6))) for _ in range(40)})
    t = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, text string")
    n = spark.createDataFrame([(x,) for x in needles], "needle string")
    got = {(r.needle, r.id) for r in containment.contains_join(n, "needle", t, "text").collect()}
    assert got == {(x, i) for x in needles for i, y in enumerate(texts) if x in y}


def test_passages_match_brute_force(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "de", "eps", "zeta"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(3, 40))) for _ in range(60)]
    cuts = []
    for _ in range(40):
        x = rng.choice(texts)
        a = rng.randrange(len(x))
        cuts.append(x[a:a + rng.randrange(1, 60)])
    cuts += ["ph", "a b", "..", "gamma zeta alpha eps nowhere de beta"]
    t = spark.createDataFrame(list(enumerate(texts)), "tid int, text string")
    p = spark.createDataFrame(list(enumerate(cuts)), "pid int, passage string")
    got = {(r.pid, r.tid) for r in containment.passages_in_texts(p, "pid", "passage", t, "tid", "text").collect()}
    assert got == {(i, j) for i, x in enumerate(cuts) for j, y in enumerate(texts) if x in y}


def brute_bm25(docs, queries):
    toks = {i: d.lower().split() for i, d in docs}
    mean = sum(map(len, toks.values())) / len(toks)
    df = Counter(t for ts in toks.values() for t in set(ts))
    out = {}
    for q, text in queries:
        scores = []
        for d, ts in toks.items():
            tf, s = Counter(ts), 0.0
            for t in text.lower().split():
                if t in df and tf[t]:
                    idf = math.log((len(toks) - df[t] + 0.5) / (df[t] + 0.5) + 1)
                    s += idf * tf[t] * 2.5 / (tf[t] + 1.5 * (0.25 + 0.75 * len(ts) / mean))
            if s > 0:
                scores.append((-round(s, 9), d))
        out[q] = sorted(scores)
    return out


def test_pruned_search_equals_full_scoring(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    draw = lambda n: " ".join(rng.choices(vocab, [1 / (i + 1) for i in range(60)], k=n))
    docs = [(i, draw(rng.randrange(5, 60))) for i in range(150)]
    queries = [(i, draw(rng.randrange(2, 12)) + " unseen") for i in range(15)]
    index = R.Index(spark.createDataFrame(docs, "id long, text string"), "id", "text")
    hits = R.bm25_search(spark.createDataFrame(queries, "q long, text string"), "q", "text", index, 5).collect()
    want = brute_bm25(docs, queries)
    for q, _ in queries:
        got = sorted(((-round(r.score, 9), r.doc) for r in hits if r.query == q))
        assert [d for _, d in got] == [d for _, d in want[q][:5]]


def test_vector_search_blocks_and_cells(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<float>").repartition(3)
    queries = vectors.filter("id < 12")
    exact = R.vector_search(queries, vectors, 5, block=5)
    got = {}
    for r in exact.collect():
        got.setdefault(r.query, []).append((r["rank"], r.id))
    for q in range(12):
        d = ((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1)
        assert [i for _, i in sorted(got[q])] == np.argsort(d, kind="stable")[:5].tolist()
    found = R.CellIndex(vectors, nlist=8).search(queries, 5, nprobe=8)
    assert R.recall(found, exact).agg(F.min("recall")).first()[0] == 1.0


def test_dense_cosine(spark):
    row = spark.range(1).select(
        R.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))).alias("a"),
        R.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("b"),
        R.cosine(F.array(F.lit(1.0)), F.array(F.lit(1.0), F.lit(2.0))).alias("c")).first()
    assert (round(row.a, 6), row.b, row.c) == (0.707107, 0.0, 0.0)


def test_metrics(spark):
    queries = spark.createDataFrame([(1,), (2,), (3,)], "q int")
    ranked = spark.createDataFrame([(1, "x", 1), (1, "a", 2), (2, "b", 1)], "q int, t string, rank int")
    truth = spark.createDataFrame([(1, "a"), (1, "c"), (3, "a")], "q int, t string")
    got = {r.q: tuple(r)[1:] for r in evaluation.evaluate(queries, ranked, truth, "q", "t").collect()}
    assert got[1] == (1.0, 0.5, 0.5, 0.5, 0.5) and got[2] == (0.0,) * 5 and got[3] == (0.0,) * 5


COLUMNS = [("a", "k", True), ("a", "x", False), ("b", "k", False), ("b", "m", False), ("c", "m", False), ("c", "y", False), ("d", "z", True)]


def test_joinability(spark):
    edges = joinability.edges(spark.createDataFrame(COLUMNS, "table_name string, name string, is_key boolean"))
    got = {(r.table_a, r.table_b): (r.join_columns, round(r.jaccard, 4), r.join_type) for r in edges.collect()}
    assert got == {("a", "b"): (["k"], 0.3333, "pk_fk"), ("b", "c"): (["m"], 0.3333, "common_column")}
    near = {(r.table_name, r.other): round(r.score, 4) for r in joinability.neighbours(edges, 0.5).collect()}
    assert near == {("a", "b"): 0.6333, ("b", "a"): 0.6333}
    paths = {r.target: r.path for r in joinability.paths(edges, spark.createDataFrame([("a",)], "table_name string")).collect()}
    assert paths == {"a": ["a"], "b": ["a", "b"], "c": ["a", "b", "c"]}


def test_linking_small_catalogue(spark):
    tables = spark.createDataFrame([("LOT_MST", "로트 정보", "로트를 관리", 1), ("EQP_HIS", "설비 이력", "설비 가동", 2), ("X", "other", "none", 3)],
                                   "table_name string, description string, purpose string, pos int")
    asked = spark.createDataFrame([(1, "설비 상태"), (2, "nothing")], "question_id long, question string")
    got = {(r.question_id, r["rank"]): (r.table_name, round(r.score, 4)) for r in linking.link_purpose(asked, tables, 2).collect()}
    assert got[1, 1] == ("EQP_HIS", 0.6) and got[2, 1] == ("EQP_HIS", 0.1) and got[2, 2] == ("LOT_MST", 0.0)
    chosen = [(r.question_id, r.table_name, r.score) for r in linking.link_binary(asked, tables).collect()]
    assert chosen == [(1, "EQP_HIS", 1.0)]


def test_minhash(spark):
    assert N.bands_and_rows(0.5, 128) == (25, 5)
    texts = [("a", "select a, b, c from orders where day = ?"), ("b", "select a, b, c from orders where day > ?"),
             ("c", "delete from sessions"), ("d", "xy")]
    items = spark.createDataFrame(texts, "id string, text string")
    signed = N.signatures(items, K.char_shingles(F.col("text"))).cache()
    link = N.bucket_links(N.bands(signed, *N.bands_and_rows()))
    assert [tuple(r) for r in link.collect()] == [("b", "a")]
    row = N.link_similarity(signed, link).first()
    sh = lambda s: {s[i:i + 3] for i in range(len(s) - 2)}
    a, b = sh(texts[0][1]), sh(texts[1][1])
    assert abs(row.jaccard - len(a & b) / len(a | b)) < 1e-9 and abs(row.estimated - row.jaccard) < 0.2
    labels = {r.id: r.component for r in N.components(items, link).collect()}
    assert labels == {"a": "a", "b": "a", "c": "c", "d": "d"}


def test_components_on_a_chain(spark):
    nodes = spark.range(40).select("id")
    link = spark.createDataFrame([(i, i - 1) for i in range(1, 20)] + [(i, 20) for i in range(21, 40)], "id long, leader long")
    got = {r.id: r.component for r in N.components(nodes, link).collect()}
    assert got == {i: 0 if i < 20 else 20 for i in range(40)}


def test_search_before_insert(spark):
    base = "select customer name, order date and total price from orders join customer where order key is more than ten"
    old = spark.createDataFrame([("t1", base), ("t2", "update stock set amount")], "id string, text string")
    new = spark.createDataFrame([("n1", base + " "), ("n2", "a completely different statement over lines")], "id string, text string")
    got = {r.id: r.match for r in N.search_before_insert(new, old).collect()}
    assert got == {"n1": "t1", "n2": None}


def test_generation_errors_do_not_stop_other_rows(spark):
    class Flaky:
        def __call__(self, text):
            if "slow" in text:
                raise RuntimeError("request timed out")
            if "busy" in text:
                raise RuntimeError("Rate limit hit")
            return text.upper()

    rows = spark.createDataFrame([("1", "ok"), ("2", "slow"), ("3", "busy")], "id string, t string")
    got = {r.id: (r.description, r.error_class) for r in inference.generate(rows, "id", "t", Flaky).collect()}
    assert got == {"1": ("OK", None), "2": (None, "timeout"), "3": (None, "rate_limit")}


def test_sinks_round_trip(spark, tmp_path):
    schema = "template_id string, template_text string, description string, tables array<string>, columns array<string>, exec_count long, input_order int"
    rows = spark.createDataFrame([("x", "t1", "d1", ["a", "b"], ["c"], 9, 1), ("x", "t2", "d2", ["a"], ["c"], 3, 2), ("y", "t" * 5000, "d", [], [], 1, 3)], schema)
    vectors, search = str(tmp_path / "v"), str(tmp_path / "s")
    assert sinks.create_if_absent(spark, search, sinks.SEARCH_SCHEMA) and not sinks.create_if_absent(spark, search, sinks.SEARCH_SCHEMA)
    assert sinks.index_vectors(rows, vectors) == 2 and sinks.index_vectors(rows.limit(0), vectors) == 0
    stored = {r.template_id: r for r in sinks.read_snapshot(spark, vectors, sinks.VECTOR_SCHEMA).collect()}
    assert stored["x"].template_text == "t1" and stored["x"].tables == "a,b" and len(stored["y"].template_text) == 4000
    assert len(stored["x"].embedding) == inference.DIMENSION
    assert sinks.index_search(rows, search) == (3, []) and sinks.index_search(rows.limit(0), search) == (0, [])
    found = {r.template_id: r.template_text[:2] for r in sinks.read_snapshot(spark, search, sinks.SEARCH_SCHEMA).collect()}
    assert found == {"x": "t2", "y": "tt"}
    drop = spark.createDataFrame([("y",)], "template_id string")
    assert sinks.delete_from(spark, search, sinks.SEARCH_SCHEMA, lambda df: sinks.delete_ids(df, "template_id", drop)) == 1
    assert sinks.delete_from(spark, search, sinks.SEARCH_SCHEMA, lambda df: sinks.delete_where(df, F.col("exec_count") > 100)) == 0


def test_similar_logs_find_keywords_of_several_words(spark):
    logs = spark.createDataFrame([("a", "SELECT x FROM t WHERE c = 'Blue Ring'"), ("b", "SELECT blue FROM ring"), ("c", "SELECT o_id FROM u"), ("d", "SELECT x FROM v WHERE k = 'big blue ring'")],
                                 "sql_id string, sql_text string")
    words = spark.createDataFrame([(1, "Blue Ring"), (2, "ring"), (3, "o_id from"), (4, "absent words")], "set_id int, keyword string")
    got = {(r.set_id, r.sql_id) for r in linking.similar_logs(words, logs).collect()}
    assert got == {(1, "a"), (1, "d"), (2, "a"), (2, "b"), (2, "d"), (3, "c")}


def test_weighted_join_salts_heavy_keys_only(spark):
    big = spark.range(5000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v")).cache()
    keyed = big.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top")).cache()
    from querylode import sizing

    got = sizing.weighted_join(big, keyed, ["k"], F.col("v"), "n", rows=100)
    assert got.exceptAll(big.join(keyed, "k").select(got.columns)).count() == 0 and got.count() == 5000


def test_questions_without_hits_stay(spark):
    from querylode.operators import context, retrieval

    asked = spark.createDataFrame([("q1",), ("q2",)], "query string")
    best = spark.createDataFrame([("q1", "d", 0.9)], "query string, doc string, score double")
    assert {(r["query"], r.path) for r in retrieval.route(best, questions=asked).collect()} == {("q1", "template"), ("q2", "schema")}
    hits = spark.createDataFrame([("q1", "t", 1)], "query string, doc string, rank int")
    templates = spark.createDataFrame([("t", "SELECT 1", ["a"])], "template_id string, template_text string, tables array<string>")
    blocks = spark.createDataFrame([("a", "about a")], "table_name string, context string")
    assert {tuple(r) for r in context.assemble(hits, templates, blocks, asked).collect()} == {("q1", "SELECT 1\nabout a"), ("q2", "")}

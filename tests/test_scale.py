"""What large tables need: joins, shuffles and searches that do not rest on the size of compressed files."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from querylode import sizing
from querylode.operators import containment, context, evaluation, linking, neardup, predicates, retrieval as R


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def _merging(spark):
    """Joins are merge joins unless a side is sent on purpose."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_components_broadcast_nothing_that_is_not_proven_small(spark, monkeypatch):
    """A star of links compresses to next to nothing; Spark would take its file size for the table's."""
    monkeypatch.setattr(neardup, "fits", lambda df: False, raising=False)
    plans, cut = [], neardup.cut
    monkeypatch.setattr(neardup, "cut", lambda df: plans.append(_plan(df)) or cut(df))
    nodes = neardup.stored(spark.range(3000).selectExpr("lpad(cast(id as string), 9, '0') AS id"), "nodes")
    link = nodes.filter("id > '000000000'").selectExpr("id", "'000000000' AS leader")
    labels = neardup.components(nodes, link)
    assert {tuple(r) for r in labels.groupBy("component").count().collect()} == {("000000000", 3000)}
    assert len(plans) > 1 and not any("BroadcastHashJoin" in p for p in plans)


def test_sided_and_weighted_joins_merge_what_is_not_proven_small(spark, monkeypatch):
    big = neardup.stored(spark.range(1000).selectExpr("id", "id % 7 AS key"), "big")
    keyed = neardup.stored(big.groupBy("key").agg(F.count("*").alias("n")), "keyed")
    assert "BroadcastHashJoin" in _plan(sizing.weighted_join(big, keyed, ["key"], F.col("id"), "n"))
    monkeypatch.setattr(sizing, "fits", lambda df, *bounds: False)
    joined = sizing.weighted_join(big, keyed, ["key"], F.col("id"), "n")
    assert "BroadcastHashJoin" not in _plan(joined) and joined.count() == 1000


def _corpus(spark):
    words = "red green blue cyan pink grey gold"
    docs = [(i, " ".join(words.split()[(i * j) % 7] for j in range(1, 4 + i % 5))) for i in range(60)] + [(60, "red red gold"), (None, "pink")]
    asked = [(1, "red gold"), (2, "pink pink cyan"), (3, "nothing here"), (4, words)]
    return spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame(asked, "item long, text string")


def _rows(df):
    return {(r["query"], r["doc"], r["rank"], round(r["score"], 6)) for r in df.collect()}


def test_search_gives_the_same_whichever_side_is_small(spark, monkeypatch):
    docs, asked = _corpus(spark)
    index = R.Index(docs, "id", "text")
    terms = index.terms(asked, "item", "text")
    wanted = _rows(R._pruned(terms, index, ["bm25"], 5, 3))
    assert _rows(R.search(terms, index, ["bm25"], 5)) == wanted
    monkeypatch.setattr(R, "fits", lambda df: "query" in df.columns)  # the postings are not small
    assert _rows(R.search(terms, index, ["bm25"], 5)) == wanted
    fused = R.fused_search(asked, "item", "text", index, 5, (0.7, 0.0))
    monkeypatch.setattr(R, "fits", lambda df: False)
    assert _rows(R.search(terms, index, ["bm25"], 5)) == wanted
    pruned = R.fused_search(asked, "item", "text", index, 5, (0.7, 0.0))
    assert all(_rows(fused[w]) == _rows(pruned[w]) for w in (0.7, 0.0))


def test_searches_do_not_shuffle_pairs(spark, monkeypatch):
    """Postings are dealt by document or queries by query; pairs stay in the task that makes them until its best are taken."""
    docs, asked = _corpus(spark)
    index = R.Index(docs, "id", "text")
    for small in ("doc", "query"):
        monkeypatch.setattr(R, "fits", lambda df: small in df.columns)
        plan = _plan(R.bm25_search(asked, "item", "text", index, 5))
        pairs = [line for line in plan.splitlines() if "Exchange hashpartitioning(query" in line and ", doc" in line.split("ENSURE")[0]]
        assert "Exchange" in plan and not pairs and "SortMergeJoin" not in plan


def test_searches_weigh_no_more_postings_than_they_read(spark, monkeypatch):
    """Where the query terms are small, no table of all weighted postings is made; norms are for the cosine alone."""
    docs, asked = _corpus(spark)
    docs = docs.unionByName(spark.createDataFrame([(None, "nowhere else"), (3, "pump twice")], docs.schema))
    whole = R.Index(docs, "id", "text")
    terms = whole.terms(asked, "item", "text")
    wanted = {s: _rows(R._pruned(terms, whole, [s], 5, 3)) for s in ("bm25", "cosine")}
    monkeypatch.setattr(R, "fits", lambda df: "query" in df.columns)  # the postings are not small
    for search, score, made in ((R.bm25_search, "bm25", []), (R.cosine_search, "cosine", ["norms"])):
        names = []
        monkeypatch.setattr(R, "stored", lambda df, name: (names.append(name), neardup.stored(df, name))[1])
        assert _rows(search(asked, "item", "text", R.Index(docs, "id", "text"), 5)) == wanted[score]
        assert names == ["counts", "frequency", "queries", "asked", *made]


def test_weights_join_rare_terms_alone_by_term(spark, monkeypatch):
    docs, _ = _corpus(spark)
    post = neardup.stored(R.postings(docs, "id", "text"), "counts")
    plan = _plan(R.weighted(post, neardup.stored(R.document_frequency(post), "frequency"), 62, 4.0))
    assert "BroadcastHashJoin" in plan and "rangepartitioning" not in plan


def test_context_keeps_queries_where_they_are(spark):
    hits = spark.createDataFrame([("a", "t1", 1), ("a", "t2", 2), ("b", "t1", 1)], "query string, doc string, rank int")
    templates = spark.createDataFrame([("t1", "SELECT 1", ["x", "y"]), ("t2", "SELECT 2", ["y"]), ("t3", "SELECT 3", None)],
                                      "template_id string, template_text string, tables array<string>")
    blocks = spark.createDataFrame([("x", "about x"), ("y", "about y")], "table_name string, context string")
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "query string")
    found = context.assemble(hits, templates, blocks, asked)
    assert {tuple(r) for r in found.collect()} == {
        ("a", "SELECT 1\nSELECT 2\nabout x\nabout y"), ("b", "SELECT 1\nabout x\nabout y"), ("c", "")}
    assert "hashpartitioning(doc" not in _plan(found) and "hashpartitioning(table_name" not in _plan(found)


def test_first_pieces_hold_every_log_a_gram_join_finds(spark, monkeypatch):
    """Numbers share grams: one of 400 needles would meet dozens of the 1,000 words, and meets only what contains it."""
    logs = spark.range(1000).selectExpr("lpad(cast(id as string), 5, '0') AS sql_id", "concat('SELECT ', 700000 + id * 37, ' FROM tmp_', id) AS sql_text")
    words = spark.createDataFrame([(f"s{n}", str(n)) for n in range(0, 400)] + [("s1", "tmp_99"), ("s2", "70 0"), ("s3", "none")], "set_id string, keyword string")
    monkeypatch.setattr(linking, "contains_join", None)  # a gram of three characters is no key for numbers
    found = {(r["set_id"], r["sql_id"]) for r in linking.similar_logs(words, logs).collect()}
    texts = {r["sql_id"]: r["sql_text"].lower() for r in logs.collect()}
    wanted = {}
    for s, w in {tuple(r) for r in words.collect()}:
        wanted.setdefault(s, set()).update(sorted(i for i, t in texts.items() if w in t)[:3])
    assert found == {(s, i) for s, ids in wanted.items() for i in sorted(ids)[:3]}


def test_rag_hands_no_idle_synonyms_to_the_sets(spark, monkeypatch):
    """A keyword that lies in every glossary entry must not bring all of them to every question that has it."""
    tables = spark.createDataFrame([("part", "things", "buy", 0), ("blue_stock", "store", "keep", 1)], "table_name string, description string, purpose string, pos int")
    columns = spark.createDataFrame([("part", "p_size", "", 0)], "table_name string, column_name string, description string, pos int")
    glossary = spark.createDataFrame([(f"term{i}", None, "widget of some kind", None, i) for i in range(50)] + [("blue", None, "widget in blue", None, 60)],
                                     "term string, korean_name string, description string, category string, pos long")
    logs = spark.createDataFrame([("L1", "SELECT a FROM blue_stock"), ("L2", "SELECT term7 FROM part"), ("L3", "SELECT 1 FROM other")], "sql_id string, sql_text string")
    questions = spark.createDataFrame([(i, f"widget {100 + i}") for i in range(20)], "question_id long, question string")
    sizes, expanded = [], linking.expanded
    monkeypatch.setattr(linking, "expanded", lambda words, found: (lambda out: sizes.append(out.count()) or out)(expanded(words, found)))
    rows = linking.link_rag(questions, tables, columns, glossary, logs).collect()
    assert {(r["table_name"], r["rank"], round(r["score"], 6)) for r in rows} == {("blue_stock", 1, 0.45), ("part", 2, 0.15)} and len(rows) == 40
    assert sizes == [60]  # two keywords and the one synonym that names a table, for each question


def test_parts_of_a_statement_meet_inside_its_row(spark):
    """A column finds its table, and an equality its other side, without a join of statements by their text."""
    texts = [
        "SELECT a.x, y FROM t a WHERE EXISTS (SELECT 1 FROM u b WHERE b.k = a.k AND c.z = 1)",
        "SELECT a.x FROM t a, (SELECT a.x FROM v a WHERE a.q = 2) d WHERE a.x = d.x",
        "SELECT p FROM m JOIN n USING (i, j)", "SELECT 1", None,
    ]
    logs = spark.createDataFrame([(t,) for t in [*texts, texts[0]]], "sql_text string")
    uses, patterns = predicates.nested_column_uses(logs), predicates.nested_join_patterns(logs)
    assert {tuple(r) for r in uses.collect()} == {
        ("t", "x", "select", 3), ("t", "y", "select", 2), ("u", "k", "where", 2), ("t", "k", "where", 2),
        ("v", "x", "select", 1), ("v", "q", "where", 1), ("t", "x", "where", 1)}
    assert {tuple(r) for r in patterns.collect()} == {
        ("u", "t", "k", 2), ("t", "u", "k", 2), ("m", "n", "i", 1), ("n", "m", "i", 1), ("m", "n", "j", 1), ("n", "m", "j", 1)}
    assert "Join" not in _plan(uses) and "Join" not in _plan(patterns)


def test_linkers_share_what_they_need_of_the_same_questions(spark, monkeypatch):
    asked, matched = [], []
    was, words = linking.synonyms, linking.keyword_sets
    monkeypatch.setattr(linking, "synonyms", lambda *a: matched.append(1) or was(*a))
    monkeypatch.setattr(linking, "keyword_sets", lambda *a: asked.append(1) or words(*a))
    questions = spark.createDataFrame([(1, "price of each gadget"), (2, "who sells lamps"), (3, None), (4, "price of each gadget")], "question_id long, question string")
    tables = spark.createDataFrame([("goods", "gadget price list", "prices", 1), ("shops", "who sells", "sellers", 2)], "table_name string, description string, purpose string, pos int")
    columns = spark.createDataFrame([("goods", "price", "price", 1), ("shops", "name", "", 2)], "table_name string, column_name string, description string, pos int")
    glossary = spark.createDataFrame([("lamps", "goods", "things", "c", 1)], "term string, korean_name string, description string, category string, pos long")
    edges = spark.createDataFrame([], "table_a string, table_b string, join_columns array<string>, common long, jaccard double, join_type string")

    def runs(**more):
        return [{tuple(r) for r in df.collect()} for df in (
            linking.link_forward(questions, tables, columns, glossary, **more), linking.link_purpose(questions, tables, **more))]

    alone, shared = runs(), linking.Shared()
    assert len(asked) == 2 and all(alone)
    asked.clear(), matched.clear()
    assert runs(shared=shared) == alone
    linking.link_bidirectional(questions, tables, columns, glossary, edges, refine=False, shared=shared)
    assert (len(asked), len(matched)) == (1, 1)


def test_few_needles_travel_to_the_texts(spark, monkeypatch):
    """A text of a hundred characters has some 300 grams; only those of a needle are counted and met, and no text is dealt by gram."""
    texts = [(i, f"select large ring {i} from stock", f"k{i % 7}") for i in range(60)] + [(90, "x", "a"), (91, "", "b"), (92, None, "c"), (93, "Große Größe", "d")]
    needles = ["large ring 5", "ri", "x", "", None, "Grö", "absent words", "k", "ring 5"]
    made = spark.createDataFrame(texts, "id int, text string, other string")
    asked = spark.createDataFrame([(i, n) for i, n in enumerate(needles)] + [(99, "ri")], "n int, needle string")
    wanted = {(n, t[0]) for n, x in [*enumerate(needles), (99, "ri")] for t in texts if x and t[1] and x in t[1]}
    with _merging(spark):
        found = containment.contains_join(asked, "needle", made, "text")
        assert "LeftSemi" in _plan(found) and "BroadcastHashJoin [_gram" in _plan(found)
        assert {(r["n"], r["id"]) for r in found.collect()} == wanted
    monkeypatch.setattr(containment, "fits", lambda df: False)
    assert {(r["n"], r["id"]) for r in containment.contains_join(asked, "needle", made, "text").collect()} == wanted


def test_only_wanted_pieces_of_words_become_rows(spark):
    words = [(f"tmp_{i}", f"L{i:04d}") for i in range(300)] + [("größe", "L0001"), ("größe", "L0000"), ("", "L9"), ("주문번호", "L7"), ("a𝒳b", "L8")]
    needles = ["tmp_2", "17", "9", "öß", "absent", "번호", "p_29", "𝒳b"]
    made = spark.createDataFrame(words, "word string, sql_id string").repartition(5)
    asked = spark.createDataFrame([(n,) for n in needles], "needle string")
    rows = containment.first_pieces(made, "word", asked, "needle", sorted({len(n) for n in needles}), "sql_id", 3).collect()
    found = {}
    for r in rows:
        found.setdefault(r["needle"], set()).add(r["sql_id"])
    assert {n: found.get(n, set()) for n in needles} == {n: set(sorted({i for w, i in words if n in w})[:3]) for n in needles}
    assert len(found) < len(needles) + 40  # of some 1,000 pieces of these lengths


def test_sets_are_dealt_once(spark):
    """Scores, bonuses and the first tables of the catalogue meet in one exchange by set; ranks and questions use the same one."""
    sets = spark.createDataFrame([(1, b"a", ["x"]), (2, b"b", ["y"]), (3, b"a", ["x"]), (4, None, None)], "question_id long, set_id binary, words array<string>")
    tables = spark.createDataFrame([(f"t{i}", "", "", i) for i in range(6)], "table_name string, description string, purpose string, pos int")
    scores = spark.createDataFrame([(b"a", "t4", 0.5), (b"a", None, 0.9), (b"b", "elsewhere", 0.7)], "set_id binary, table_name string, score double")
    bonus = spark.createDataFrame([(b"a", "t5", 0.6), (b"a", "t4", 0.2)], "set_id binary, table_name string, bonus double")
    with _merging(spark):
        rows = linking.candidates(sets, tables, scores, 2, others=bonus)
        total = rows.withColumn("score", F.col("score") + F.coalesce("bonus", F.lit(0.0)))
        found = linking.per_question(sets, linking.ranked(total, 2))
        plan = _plan(found)
    assert sum("Exchange hashpartitioning(" in line for line in plan.splitlines()) == 3  # distinct sets, what is known of them, questions
    assert sorted((r["question_id"], r["table_name"], round(r["score"], 6), r["rank"]) for r in found.collect()) == [
        (1, "t4", 0.7, 1), (1, "t5", 0.6, 2), (2, "t0", 0.0, 1), (2, "t1", 0.0, 2), (3, "t4", 0.7, 1), (3, "t5", 0.6, 2)]


def test_a_sweep_deals_truth_and_runs_once(spark):
    """Runs, truth and queries meet in one row per key: one exchange by key besides that of the distinct queries, and no join by key and item."""
    make = spark.createDataFrame
    asked = make([(1,), (2,), (2,), (3,), (4,), (None,)], "q long")
    truth = make([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (2, None), (4, None), (9, "a"), (None, "a")], "q long, t string")
    runs = {"one": make([(1, "x", 1), (1, "a", 2), (1, "b", 3), (2, "c", 7), (4, None, 1), (9, "a", 1), (None, "a", 1)], "q long, t string, rank int"),
            "two": make([(3, "a", 1), (1, "a", 1), (1, "a", 2)], "q long, t string, rank int"), "none": make([], "q long, t string, rank int")}
    swept = evaluation.sweep(runs, asked, truth, "q", "t")
    wanted = {}
    for name, df in runs.items():
        rows = []
        for q in (1, 2, 3, 4, None):
            right = {r.t for r in truth.collect() if r.q == q and q is not None and r.t is not None}
            wants = len({r.t for r in truth.collect() if r.q == q and q is not None})
            mine = [r for r in df.collect() if r.q == q and q is not None]
            hits = [r.rank for r in mine if r.t in right]
            p, r = len(hits) / len(mine) if mine else 0, len(hits) / wants if wants else 0
            rows.append((1 if hits and min(hits) <= 5 else 0, 1 / min(hits) if hits else 0, p, r, 2 * p * r / (p + r) if p + r else 0))
        wanted[name] = tuple(round(sum(x) / 5, 9) for x in zip(*rows)) + (5,)
    assert {r["config"]: tuple(round(r[m], 9) for m in evaluation.METRICS) + (r["queries"],) for r in swept.collect()} == wanted
    with _merging(spark):
        plan = _plan(evaluation.sweep(runs, asked, truth, "q", "t"))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(q") == 2

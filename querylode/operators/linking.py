"""Schema linking: ranking catalogue tables for many questions at once.

Inputs
    questions  ``question_id, question``
    tables     ``table_name, description, purpose, pos`` (``pos`` is the catalogue order and breaks ties)
    columns    ``table_name, column_name, description, pos``
Every linker returns ``question_id, table_name, score, rank`` for the best tables; a question whose words match nothing still ranks the
catalogue in its order. Only candidates are scored: tables that matched, were boosted or drafted, and the first k of the catalogue's
order, because a table that nothing speaks for is among the best k only if fewer than k tables stand before it.

Questions repeat, so keywords are matched once per distinct keyword and scored once per distinct keyword set.  Weights
are counted in hundredths: integer sums do not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from querylode.functions import sqltext as S
from querylode.functions import tokens as K
from querylode.lineage import stored
from querylode.operators import joinability, retrieval as R
from querylode.operators.containment import contains_join, first_pieces, passages_in_texts
from querylode.operators.ordering import first_per_key, top_k
from querylode.sizing import small_side

# Match weights in hundredths per field, by strategy.
FORWARD = {"name": 30, "about": 20, "column": 15, "column_about": 10}
RAG = {"name": 30, "description": 20, "column": 10}
SEEDS = {"name": 30, "description": 20}
REFINED = {"name": 200, "description": 100}
ENRICHED = {"text": 20}
BOOST = {"upper_name": 10}
LOG_BONUS, BACKWARD_BONUS, HISTORY_BONUS, JOIN_SHARE = 15, 0.2, 0.1, 0.3


class Shared(dict):
    """What several linkers need of the same questions, catalogue, glossary and edges, stored by the first that asks for it. One of these
    belongs to one set of such inputs."""

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self:
            self[name] = stored(make(), name)
        return self[name]

    def sets(self, questions: DataFrame) -> DataFrame:
        return self.once("sets", lambda: keyword_sets(questions))

    def words(self, questions: DataFrame) -> DataFrame:
        sets = self.sets(questions)
        return self.once("keywords", lambda: distinct_sets(sets))


def keyword_sets(questions: DataFrame, extra: Column | None = None) -> DataFrame:
    """``question_id, set_id, words``: the sorted distinct keywords of each question and an id per distinct set, the 16 bytes of an MD5:
    what is dealt by set consists of little else."""
    words = K.keywords(F.col("question"))
    if extra is not None:
        words = F.concat(words, extra)
    words = F.array_sort(F.array_distinct(words))
    return questions.select("question_id", words.alias("words")).withColumn(
        "set_id", F.unhex(F.md5(F.array_join("words", " "))))


def distinct_sets(sets: DataFrame) -> DataFrame:
    """``set_id, keyword`` for each distinct keyword set; an empty set has no row."""
    return sets.select("set_id", "words").distinct().select("set_id", F.explode("words").alias("keyword"))  # hashed: to keep a first one sorts all rows


def fields(tables: DataFrame, columns: DataFrame | None, wanted: dict[str, int]) -> DataFrame:
    """``table_name, field, at, text``: lower-cased text of the fields a strategy weighs."""
    def field(df: DataFrame, name: str, text: Column, at: Column) -> DataFrame:
        return df.select("table_name", F.lit(name).alias("field"), at, F.lower(text).alias("text"))

    none = F.lit("").alias("at")
    column = F.col("column_name").alias("at") if columns is not None else none
    whole = F.concat_ws(" ", "table_name", "description", "purpose")
    makers = {
        "name": lambda: field(tables, "name", F.col("table_name"), none),
        "upper_name": lambda: field(tables, "upper_name", F.col("table_name"), none),
        "description": lambda: field(tables, "description", F.col("description"), none),
        "about": lambda: field(tables, "about", F.concat_ws(" ", "description", "purpose"), none),
        "text": lambda: field(tables, "text", whole, none),
        "column": lambda: field(columns, "column", F.col("column_name"), column),
        "column_about": lambda: field(columns, "column_about", F.coalesce(F.col("description"), F.lit("")), column),
    }
    out = None
    for name in wanted:
        part = makers[name]()
        out = part if out is None else out.unionByName(part)
    return out


def keyword_weights(words: DataFrame, tables: DataFrame, columns: DataFrame | None, weights: dict[str, int]) -> DataFrame:
    """``keyword, table_name, points``: summed weights of the fields of a table that contain the keyword."""
    lowered = words.select("keyword", F.lower("keyword").alias("needle")).distinct()
    hits = contains_join(lowered, "needle", fields(tables, columns, weights), "text")
    value = F.lit(0)
    for name, w in weights.items():
        value = F.when(F.col("field") == name, w).otherwise(value)
    return hits.groupBy("keyword", "table_name").agg(F.sum(value).alias("points"))


def match_scores(set_words: DataFrame, tables: DataFrame, columns: DataFrame | None, weights: dict[str, int],
                 cap: bool = True, per_word: DataFrame | None = None) -> DataFrame:
    """``set_id, table_name, score`` of keyword sets that match a table; capped at 1 unless told otherwise. ``per_word`` are the words'
    weights where they are known already."""
    per_word = stored(keyword_weights(set_words, tables, columns, weights), "weights") if per_word is None else per_word
    points = set_words.join(small_side(per_word), "keyword").groupBy("set_id", "table_name").agg(F.sum("points").alias("points"))
    score = F.col("points") / 100
    return points.select("set_id", "table_name", (F.least(score, F.lit(1.0)) if cap else score).alias("score"))


def candidates(sets: DataFrame, tables: DataFrame, scores: DataFrame, k: int, prior: Column | None = None, others: DataFrame | None = None) -> DataFrame:
    """What can be among the best ``k`` tables of a set: ``set_id, table_name, pos, score``.

    ``scores`` and ``others`` (``set_id, table_name``) name tables with something to say; the first ``k`` of the catalogue join them with
    score 0. Other columns of ``others`` are handed on. ``prior`` is what a table is worth to every set, and orders those first ``k``. Tables
    outside the catalogue are left out. Rows are dealt by set once, and stay there for ``ranked`` and ``per_question``.
    """
    worth = F.lit(0.0) if prior is None else prior
    known = tables.select("table_name", "pos", worth.alias("_prior"))
    head = [r["table_name"] for r in known.orderBy(F.desc("_prior"), "pos").limit(k).collect()]
    listed = F.array(*map(F.lit, head)).cast("array<string>")
    named = sets.select("set_id").distinct().unionByName(scores.filter("table_name IS NOT NULL").select("set_id", "table_name", "score"), allowMissingColumns=True)
    if others is not None:
        named = named.unionByName(others.filter("table_name IS NOT NULL"), allowMissingColumns=True)
    said = [c for c in named.columns if c not in ("set_id", "table_name")]
    rows = named.repartition("set_id").withColumn("table_name", F.explode(F.when(F.col("table_name").isNull(), listed).otherwise(F.array("table_name"))))
    rows = rows.groupBy("set_id", "table_name").agg(*[F.max(c).alias(c) for c in said]).join(small_side(known), "table_name")
    return rows.withColumn("score", F.coalesce("score", F.lit(0.0)) + F.col("_prior")).drop("_prior")


def ranked(scores: DataFrame, k: int) -> DataFrame:
    return top_k(scores, ["set_id"], [F.desc(F.round("score", 9)), F.asc("pos")], k).select(
        "set_id", "table_name", "score", "rank")


def per_question(sets: DataFrame, result: DataFrame) -> DataFrame:
    """Results of distinct sets handed back to their questions."""
    return sets.select("question_id", "set_id").join(result, "set_id").drop("set_id")


# --- glossary ---------------------------------------------------------------------------------------

def synonyms(words: DataFrame, glossary: DataFrame) -> DataFrame:
    """``keyword, synonym``: terms and Korean names of entries whose lower term, Korean name or description contains
    the lower keyword."""
    entries = glossary.select("term", "korean_name", "description").distinct()
    texts = entries.select("term", "korean_name", F.explode(F.array(
        F.lower("term"), F.coalesce("korean_name", F.lit("")), F.coalesce("description", F.lit("")))).alias("text")).distinct()
    needles = words.select("keyword", F.lower("keyword").alias("needle")).distinct()
    hits = contains_join(needles, "needle", texts, "text")
    names = F.array_compact(F.array("term", F.when(F.col("korean_name") != "", F.col("korean_name"))))
    return hits.select("keyword", F.explode(names).alias("synonym")).distinct()


def expansions(words: DataFrame, glossary: DataFrame) -> DataFrame:
    """``keyword, synonym``: the term of an equal Korean name (the last such entry by ``pos``), and terms where the
    lower keyword is part of the term (case-sensitive) or of the lower description."""
    keys = words.select("keyword", F.lower("keyword").alias("needle")).distinct()
    exact = first_per_key(glossary.filter(F.col("korean_name") != "").select("korean_name", "term", "pos"),
                          ["korean_name"], "pos", last=True)
    equal = keys.join(exact, keys["keyword"] == exact["korean_name"]).select("keyword", F.col("term").alias("synonym"))
    # Entries are keyed by lower term, the last one wins.
    last = first_per_key(glossary.withColumn("_key", F.lower("term")).select("_key", "term", "description", "pos"),
                         ["_key"], "pos", last=True)
    texts = last.select("term", F.explode(F.array("term", F.lower(F.coalesce("description", F.lit(""))))).alias("text")).distinct()
    part = contains_join(keys, "needle", texts, "text").select("keyword", F.col("term").alias("synonym"))
    return equal.unionByName(part).distinct()


def expanded(set_words: DataFrame, found: DataFrame) -> DataFrame:
    """Keyword sets with their synonyms: ``set_id, keyword``."""
    more = set_words.join(found, "keyword").select("set_id", F.col("synonym").alias("keyword"))
    return set_words.unionByName(more).distinct()


# --- few-shot logs ------------------------------------------------------------------------------------

def similar_logs(set_words: DataFrame, logs: DataFrame, k: int = 3, more: DataFrame | None = None) -> DataFrame:
    """``set_id, sql_id, tables``: the first k logs (by ``sql_id``) whose lower text contains any keyword of the set, or a synonym of one
    (``more``: ``keyword, synonym``).  A keyword takes the first k logs of its synonyms, so that sets need not be joined to these.

    A keyword that is one word lies inside one word of the text: such keywords meet the pieces of their length of the log's distinct
    words, and each word and piece needs only its first k logs.  Others are matched against the distinct texts.
    """
    text = F.lower("sql_text")
    words = logs.select("sql_id", F.explode(F.array_distinct(K.search_tokens(F.col("sql_text")))).alias("word"))
    first = stored(top_k(words, ["word"], [F.asc("sql_id")], k).select("word", "sql_id"), "words")
    named = set_words.select("keyword") if more is None else set_words.select("keyword").unionByName(more.select(F.col("synonym").alias("keyword")))
    needles = named.select("keyword", F.lower("keyword").alias("needle")).distinct()
    parts = K.words(F.col("needle"))
    needles = stored(needles.withColumn("single", (F.size(parts) == 1) & (F.get(parts, F.lit(0)) == F.col("needle"))), "needles")
    single, other = needles.filter("single").drop("single"), needles.filter(~F.coalesce("single", F.lit(False))).filter("needle <> ''")
    # Numbers share their grams with too many other numbers; a whole piece meets nothing but what contains it.
    lengths = [r[0] for r in single.select(F.length("needle")).distinct().sort(F.length("needle")).collect()]
    pieces = first_pieces(first, "word", single, "needle", lengths, "sql_id", k)
    hits = single.join(pieces, "needle").select("keyword", "sql_id")
    if not other.isEmpty():
        texts = stored(top_k(logs.select(text.alias("low"), "sql_id"), ["low"], [F.asc("sql_id")], k).select(
            F.md5("low").alias("low_id"), "low", "sql_id"), "texts")
        inside = passages_in_texts(other, "keyword", "needle", texts.select("low_id", "low").distinct(), "low_id", "low")
        hits = hits.unionByName(inside.join(texts, "low_id").select("keyword", "sql_id"))
    hits = top_k(hits.distinct(), ["keyword"], [F.asc("sql_id")], k).drop("rank")
    if more is not None:
        hits = stored(hits, "hits")
        through = more.join(hits.withColumnRenamed("keyword", "synonym"), "synonym").select("keyword", "sql_id")
        hits = top_k(hits.unionByName(through).distinct(), ["keyword"], [F.asc("sql_id")], k).drop("rank")
    found = set_words.join(hits, "keyword").select("set_id", "sql_id").distinct()
    found = stored(top_k(found, ["set_id"], [F.asc("sql_id")], k).drop("rank"), "found")
    named = logs.select("sql_id", S.bare_tables(F.col("sql_text")).alias("tables"))
    return found.join(named.join(small_side(found.select("sql_id").distinct()), "sql_id"), "sql_id")


# --- linkers -------------------------------------------------------------------------------------------

def forward_scores(set_words: DataFrame, tables: DataFrame, columns: DataFrame, glossary: DataFrame) -> DataFrame:
    return expanded_scores(set_words, stored(synonyms(set_words, glossary), "synonyms"), tables, columns, FORWARD)


def expanded_scores(set_words: DataFrame, found: DataFrame, tables: DataFrame, columns: DataFrame, weights: dict[str, int]) -> DataFrame:
    """Distinct keywords and synonyms (``found``, stored) meet the catalogue first; only synonyms that match a table are handed to the sets."""
    every = set_words.select("keyword").unionByName(found.select(F.col("synonym").alias("keyword"))).distinct()
    per_word = stored(keyword_weights(every, tables, columns, weights), "weights")
    useful = found.join(small_side(per_word.select(F.col("keyword").alias("synonym")).distinct()), "synonym", "left_semi")
    return match_scores(expanded(set_words, useful), tables, columns, weights, per_word=per_word)


def link_forward(questions: DataFrame, tables: DataFrame, columns: DataFrame, glossary: DataFrame, k: int = 5,
                 shared: Shared | None = None) -> DataFrame:
    shared = Shared() if shared is None else shared
    sets, words = shared.sets(questions), shared.words(questions)
    scores = shared.once("forward", lambda: forward_scores(words, tables, columns, glossary))
    return per_question(sets, ranked(candidates(sets, tables, scores, k), k))


def draft_tables(set_words: DataFrame, sets: DataFrame, tables: DataFrame, edges: DataFrame,
                 allowed: DataFrame | None = None) -> DataFrame:
    """Tables of the draft statement of each set: ``set_id, table_name, at, main, join_column``.

    Tables whose name or description contains a keyword, in catalogue order (within ``allowed`` if given): the first
    is the main table, the next two are joined if they share a column with it (the smallest name).  Without a match
    the first (allowed) table alone.
    """
    hits = stored(match_scores(set_words, tables, None, SEEDS).select("set_id", "table_name", F.lit(1.0).alias("score")), "hits")
    if allowed is None:
        rows = candidates(sets, tables, hits, 1)
    else:
        rows = allowed.select("set_id", "table_name").join(hits, ["set_id", "table_name"], "left").fillna(0.0, ["score"]).join(
            small_side(tables.select("table_name", "pos")), "table_name")
    # Matches first, then catalogue order; unmatched rows only serve as the fallback.
    chosen = top_k(rows, ["set_id"], [F.desc("score"), F.asc("pos")], 3, "at").filter((F.col("score") > 0) | (F.col("at") == 1))
    chosen = stored(chosen.select("set_id", "table_name", "at"), "drafted")
    main = chosen.filter("at = 1").select("set_id", F.col("table_name").alias("main"))
    shared = joinability.both_ways(edges).select(F.col("table_a").alias("main"), F.col("table_b").alias("table_name"),
                                                 F.element_at("join_columns", 1).alias("join_column"))
    return chosen.join(main, "set_id").join(small_side(shared), ["main", "table_name"], "left").filter(
        (F.col("at") == 1) | F.col("join_column").isNotNull())


def draft_sql(drafts: DataFrame, columns: DataFrame) -> DataFrame:
    """``set_id, sql_text``: five columns of the main table and up to two joins."""
    lists = top_k(columns, ["table_name"], [F.asc("pos")], 5).groupBy("table_name").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "column_name"))), lambda c: c["column_name"]),
                     ", ").alias("list"))
    join = F.concat(F.lit(" JOIN "), "table_name", F.lit(" ON "), "main", F.lit("."), "join_column", F.lit(" = "),
                    "table_name", F.lit("."), "join_column")
    joins = drafts.groupBy("set_id", "main").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("at", F.when(F.col("at") > 1, join).otherwise("").alias("j")))), lambda x: x["j"]), "").alias("joins"))
    return joins.join(lists, joins["main"] == lists["table_name"]).select(
        "set_id", F.concat(F.lit("SELECT "), "list", F.lit(" FROM "), "main", "joins").alias("sql_text"))


def link_bidirectional(questions: DataFrame, tables: DataFrame, columns: DataFrame, glossary: DataFrame, edges: DataFrame,
                       forward_weight: float = 0.6, refine: bool = True, k: int = 5, shared: Shared | None = None) -> DataFrame:
    """Forward score mixed with membership in the draft statement; ``refine`` drafts again on the best k + 2 tables
    and adds a bonus to the tables found."""
    shared = Shared() if shared is None else shared
    sets, words = shared.sets(questions), shared.words(questions)
    drafted = shared.once("draft", lambda: draft_tables(words, sets, tables, edges).select("set_id", "table_name"))
    scores = shared.once("forward", lambda: forward_scores(words, tables, columns, glossary))
    mixed = candidates(sets, tables, scores, k + 2, others=drafted.withColumn("drafted", F.lit(1.0))).withColumn(
        "score", forward_weight * F.col("score") + (1 - forward_weight) * F.coalesce("drafted", F.lit(0.0))).drop("drafted")
    if refine:
        mixed = stored(mixed, "mixed")
        best = ranked(mixed, k + 2)
        again = draft_tables(words, sets, tables, edges, best).select("set_id", "table_name").withColumn("again", F.lit(BACKWARD_BONUS))
        mixed = mixed.join(again, ["set_id", "table_name"], "left").withColumn(
            "score", F.col("score") + F.coalesce("again", F.lit(0.0))).drop("again")
    return per_question(sets, ranked(mixed, k))


def link_joinability(questions: DataFrame, tables: DataFrame, edges: DataFrame, k: int = 5, seeds: int = 3) -> DataFrame:
    """Seed tables by keyword, boosted neighbours, scaled to the best score of the question."""
    sets = stored(keyword_sets(questions), "sets")
    seed = stored(match_scores(stored(distinct_sets(sets), "keywords"), tables, None, SEEDS, cap=False), "seed")
    first = top_k(candidates(sets, tables, seed, 1), ["set_id"], [F.desc("score"), F.asc("pos")], seeds)
    best = first.filter((F.col("score") > 0) | (F.col("rank") == 1))
    around = joinability.neighbours(edges).select("table_name", "other", F.col("score").alias("join_score"))
    boost = stored(best.select("set_id", "table_name").join(small_side(around), "table_name").groupBy("set_id", F.col("other").alias("table_name"))
                   .agg(F.sum(F.col("join_score") * JOIN_SHARE).alias("boost")), "boost")
    total = stored(candidates(sets, tables, seed, k, others=boost).withColumn(
        "score", F.col("score") + F.coalesce("boost", F.lit(0.0))).drop("boost"), "total")
    peak = total.groupBy("set_id").agg(F.max("score").alias("peak"))
    scaled = total.join(peak, "set_id").withColumn(
        "score", F.when(F.col("peak") > 0, F.least(F.col("score") / F.col("peak"), F.lit(1.0))).otherwise(F.col("score")))
    return per_question(sets, ranked(scaled, k))


def link_rag(questions: DataFrame, tables: DataFrame, columns: DataFrame, glossary: DataFrame | None = None,
             logs: DataFrame | None = None, k: int = 5, shared: Shared | None = None) -> DataFrame:
    """Keyword match with optional glossary expansion and optional bonus for the tables of similar logs."""
    shared = Shared() if shared is None else shared
    sets, words, more = shared.sets(questions), shared.words(questions), None
    if glossary is None:
        matched = match_scores(words, tables, columns, RAG)
    else:
        more = stored(expansions(words, glossary), "expansions")
        matched = expanded_scores(words, more, tables, columns, RAG)
    if logs is None:
        scores = candidates(sets, tables, matched, k)
    else:
        found = similar_logs(words, logs, more=more).select("set_id", F.explode("tables").alias("table_name"))
        bonus = found.groupBy("set_id", "table_name").agg((F.count("*") * LOG_BONUS / 100).alias("bonus"))
        scores = candidates(sets, tables, matched, k, others=bonus).withColumn(
            "score", F.least(F.col("score") + F.coalesce("bonus", F.lit(0.0)), F.lit(1.0))).drop("bonus")
    return per_question(sets, ranked(scores, k))


def link_purpose(questions: DataFrame, tables: DataFrame, k: int = 5, shared: Shared | None = None) -> DataFrame:
    """Share of the question's distinct keywords among those of the table text, plus a bonus for history tables."""
    shared = Shared() if shared is None else shared
    sets, words = shared.sets(questions), shared.words(questions)
    known = tables.select("table_name", F.explode(F.array_distinct(K.keywords(
        F.concat_ws(" ", "table_name", "description", "purpose")))).alias("keyword"))
    hits = words.join(small_side(known), "keyword").groupBy("set_id", "table_name").agg(F.count("*").alias("n"))
    sizes = words.groupBy("set_id").agg(F.count("*").alias("size"))
    shares = hits.join(sizes, "set_id").select("set_id", "table_name", (F.col("n") / F.col("size")).alias("score"))
    bonus = F.when(S.table_kind(F.col("table_name")) == "history", HISTORY_BONUS).otherwise(0.0)
    return per_question(sets, ranked(candidates(sets, tables, shares, k, prior=bonus), k))


def link_binary(questions: DataFrame, tables: DataFrame, k: int = 5, choice: str = "B", shared: Shared | None = None) -> DataFrame:
    """Refined list (B: name hits count 2, description hits 1, best five) or the first match of the full schema (A).

    Unlike the other linkers only chosen tables are returned; their score falls by 0.1 per rank.
    """
    shared = Shared() if shared is None else shared
    sets, words = shared.sets(questions), shared.words(questions)
    if choice == "B":
        rows = match_scores(words, tables, None, REFINED, cap=False).join(small_side(tables.select("table_name", "pos")), "table_name")
        best = top_k(rows, ["set_id"], [F.desc("score"), F.asc("pos")], min(k, 5))
    else:
        rows = candidates(sets, tables, match_scores(words, tables, None, SEEDS).withColumn("score", F.lit(1.0)), 1)
        best = top_k(rows, ["set_id"], [F.desc("score"), F.asc("pos")], 1)
    score = 1 - (F.col("rank") - 1) * 0.1
    return per_question(sets, best.select("set_id", "table_name", score.alias("score"), "rank"))


def link_enriched(questions: DataFrame, tables: DataFrame, k: int = 5, notes: Column | None = None) -> DataFrame:
    """Keywords of the question plus the entities and topic keywords of ``notes`` (the question itself by default;
    pass the enrichment text of a model as a column otherwise)."""
    text = F.col("question") if notes is None else notes
    extra = F.concat(K.entities(text), K.topic_keywords(K.topics(text)))
    sets = stored(keyword_sets(questions, extra), "sets")
    scores = match_scores(stored(distinct_sets(sets), "keywords"), tables, None, ENRICHED)
    return per_question(sets, ranked(candidates(sets, tables, scores, k), k))


def name_boosts(set_words: DataFrame, tables: DataFrame) -> DataFrame:
    """``set_id, table_name, boost``: 0.1 per keyword contained in the table name."""
    return match_scores(set_words, tables, None, BOOST, cap=False).withColumnRenamed("score", "boost")


def link_hybrid(questions: DataFrame, tables: DataFrame, documents: DataFrame, vector_weight: float = R.VECTOR_WEIGHT,
                use_rerank: bool = False, k: int = 5) -> DataFrame:
    """TF-IDF cosine and scaled BM25 over the table documents (``table_name, pos, document``), optionally reranked."""
    sets = stored(questions.select("question_id", F.md5("question").alias("set_id")), "sets")
    distinct = stored(questions.select("question").distinct().withColumn("set_id", F.md5("question")), "distinct-questions")
    index = R.Index(documents, "table_name", "document")
    both = R.all_scores(index.terms(distinct, "set_id", "question"), index, ["cosine", "bm25"])
    peak = both.groupBy("query").agg(F.max("bm25").alias("peak"))
    scaled = F.when(F.col("peak") > 0, F.col("bm25") / F.col("peak")).otherwise(F.col("bm25"))
    fused = both.join(peak, "query").select(
        F.col("query").alias("set_id"), F.col("doc").alias("table_name"),
        (vector_weight * F.col("cosine") + (1 - vector_weight) * scaled).alias("score"))
    if not use_rerank:
        return per_question(sets, ranked(candidates(distinct, tables, fused, k), k))
    words = distinct.select("set_id", F.explode(F.array_distinct(K.keywords(F.col("question")))).alias("keyword"))
    boost = name_boosts(words, tables)
    scores = candidates(distinct, tables, fused, k, others=boost).withColumn(
        "score", F.least(F.col("score") + F.coalesce("boost", F.lit(0.0)), F.lit(1.0))).drop("boost")
    return per_question(sets, ranked(scores, k))

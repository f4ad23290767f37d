"""Linkers on a catalogue of thousands of tables against plain scoring of every table."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from querylode.functions import tokens as K
from querylode.operators import joinability, linking as L

WORDS = "order customer price stock ship region yield wafer defect lot tool alarm recipe step shift audit budget vendor staff plan".split()
SIZE, K_BEST = 5_000, 5


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(11)
    tables = []
    for i in range(SIZE):
        a, b, c = rng.sample(WORDS, 3)
        history = "_HIS" if i % 97 == 5 else ""
        tables.append((f"{a}_{b}_{i:04d}{history}", f"holds {c} of {b}", f"used for {rng.choice(WORDS)}", i))
    columns = [(t, f"{rng.choice(WORDS)}_{j}", None if rng.random() < 0.3 else f"the {rng.choice(WORDS)}", j) for t, *_ in tables for j in range(2)]
    asked = [" ".join(rng.sample(WORDS, rng.randint(1, 3))) for _ in range(25)] + ["nothing matches zzqx", "", "0007", "order 0042"]
    names = [t[0] for t in tables]
    edges = {tuple(sorted(rng.sample(names[:300], 2))) for _ in range(400)}
    edges = [(a, b, [f"k{rng.randint(1, 9)}"], round(rng.random(), 3), rng.choice(["pk_fk", "common_column"])) for a, b in sorted(edges)]
    make = spark.createDataFrame
    return (make(list(enumerate(asked)), "question_id long, question string").cache(), make(tables, "table_name string, description string, purpose string, pos int").cache(),
            make(columns, "table_name string, column_name string, description string, pos int").cache(),
            make(edges, "table_a string, table_b string, join_columns array<string>, jaccard double, join_type string").cache())


def keywords(questions):
    return {r.question_id: sorted(set(r.k)) for r in questions.select("question_id", K.keywords(F.col("question")).alias("k")).collect()}


def best(scores, tables, k=K_BEST):
    order = sorted(tables, key=lambda t: (-round(scores.get(t.table_name, 0.0), 9), t.pos))
    return [(t.table_name, round(scores.get(t.table_name, 0.0), 6)) for t in order[:k]]


def points(words, fields):
    """Sum of the weights of (text, weight) that contain a word, per word and field."""
    return sum(w for word in words for text, w in fields if word.lower() in text.lower()) / 100


def check(result, want):
    got = {}
    for r in sorted(result.collect(), key=lambda r: (r.question_id, r.rank)):
        got.setdefault(r.question_id, []).append((r.table_name, round(r.score, 6)))
    assert got == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_forward(world, spark):
    questions, tables, columns, _ = world
    glossary = spark.createDataFrame([("wafer", "웨이퍼", "a disc of tool steel"), ("yield", None, "share of good lot")], "term string, korean_name string, description string")
    found = L.link_forward(questions, tables, columns, glossary, K_BEST)
    assert "CartesianProduct" not in plan_of(found) and "NestedLoop" not in plan_of(found)
    rows, cols = tables.collect(), {}
    for c in columns.collect():
        cols.setdefault(c.table_name, []).append(c)
    entries, want = glossary.collect(), {}
    for q, words in keywords(questions).items():
        more = {s for w in words for e in entries if any(w.lower() in (x or "").lower() for x in (e.term, e.korean_name, e.description)) for s in (e.term, e.korean_name) if s}
        every = set(words) | more
        scores = {t.table_name: min(1.0, points(every, [(t.table_name, 30), (f"{t.description} {t.purpose}", 20), *((c.column_name, 15) for c in cols[t.table_name]),
                                                        *((c.description or "", 10) for c in cols[t.table_name])])) for t in rows}
        want[q] = best(scores, rows)
    check(found, want)


def test_purpose_ranks_history_tables_that_match_nothing(world):
    questions, tables, _, _ = world
    rows = tables.select("*", K.keywords(F.concat_ws(" ", "table_name", "description", "purpose")).alias("k")).collect()
    want = {}
    for q, words in keywords(questions).items():
        scores = {t.table_name: len(set(words) & set(t.k)) / max(1, len(words)) + (0.1 if "HIS" in t.table_name.upper() and "MST" not in t.table_name.upper() else 0.0) for t in rows}
        want[q] = best(scores, rows)
    check(L.link_purpose(questions, tables, K_BEST), want)


def test_joinability_boosts_tables_that_match_nothing(world):
    questions, tables, _, edges = world
    rows, around = tables.collect(), {}
    for r in joinability.neighbours(edges).collect():
        around.setdefault(r.table_name, []).append((r.other, r.score))
    want = {}
    for q, words in keywords(questions).items():
        seed = {t.table_name: points(words, [(t.table_name, 30), (t.description, 20)]) for t in rows}
        order = sorted(rows, key=lambda t: (-seed[t.table_name], t.pos))[:3]
        total = dict(seed)
        for i, t in enumerate(order):
            if seed[t.table_name] > 0 or i == 0:
                for other, score in around.get(t.table_name, []):
                    total[other] += score * 0.3
        peak = max(total.values())
        want[q] = best({t: min(1.0, s / peak) if peak > 0 else s for t, s in total.items()}, rows)
    check(L.link_joinability(questions, tables, edges, K_BEST), want)


def test_candidates_are_few(world, spark):
    _, tables, _, _ = world
    sets = spark.createDataFrame([("a",), ("b",)], "set_id string")
    scores = spark.createDataFrame([("a", tables.first().table_name, 0.5), ("b", "not in the catalogue", 0.9)], "set_id string, table_name string, score double")
    rows = L.candidates(sets, tables, scores, 3).collect()
    assert len(rows) == 6 and sorted(r.score for r in rows) == [0, 0, 0, 0, 0, 0.5]
    assert L.candidates(sets.limit(0), tables, scores.limit(0), 3).count() == 0
    assert L.candidates(sets, tables.limit(0), scores, 3).count() == 0

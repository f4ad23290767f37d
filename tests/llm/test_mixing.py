"""Targets, quotas and draws of the mix; the pipeline's stages."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from querylode import lineage
from querylode.llm import mixing, toxicity


def brute_targets(sizes, weights, share, passes=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > passes * sizes[s]]
        if not over:
            return {**fixed, **{s: left * weight[s] / total for s in free}}
        for s in over:
            fixed[s] = passes * sizes[s]
            left -= fixed[s]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, "w " * (1 + i * 7919 % 90), ["big", "a", "é", None, "Z"][0 if i % 3 else i // 3 % 5]) for i in range(1500)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("row", F.lit("x"))


def test_targets_and_taken_words(corpus):
    rows = mixing.mix(corpus).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r["size"]
    want = brute_targets(sizes, (5, 2, 1), 1.5)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == len(r.draws) * r["size"] <= 2 * r["size"]
        taken[r.source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 45
    again = {(r.doc_id, str(r.draws)) for r in mixing.mix(corpus).collect()}
    assert again == {(r.doc_id, str(r.draws)) for r in rows}


def test_draws_are_dealt_evenly(corpus):
    shards = Counter(d.shard for r in mixing.mix(corpus, shards=6).collect() for d in r.draws)
    assert sorted(shards) == list(range(6)) and max(shards.values()) < 1.5 * min(shards.values())


def test_splitting_tree_gives_exact_quotas(spark):
    quotas = spark.createDataFrame([("a", 37), ("b", 5), (None, 90)], "source string, blocks long")
    rows = mixing.splitting_tree(quotas, 7, 3).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append((r["first"], r.many))
    for source, blocks in (("a", 37), ("b", 5), (None, 90)):
        at = 0
        for first, many in sorted(by[source]):
            assert first == at
            at += many
        assert at == blocks
    per_shard = Counter()
    for r in rows:
        per_shard[r.shard] += r.many
    assert max(per_shard.values()) - min(per_shard.values()) <= 2


def test_mixing_odd_rows(odd_docs, no_docs):
    rows = mixing.mix(odd_docs)
    assert rows.count() == odd_docs.count()
    assert mixing.mix(no_docs).count() == 0
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.count() == rows.select(F.sum(F.size("draws"))).first()[0]
    assert mixing.mix(odd_docs.where("text is null")).select(F.sum("taken")).first()[0] == 0


def _spaced(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def _near_representatives(docs, size=5, percent=80):
    """Ids kept of (doc_id, text) by comparing all pairs of shingle sets."""
    sets = {d: {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if (w := _words(t)) else set() for d, t in docs}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, b in enumerate(ids):
        for a in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d for d in ids if root(d) == d}


def _pieces(docs, rows, tokenizer):
    """Packed ``rows`` hold every id of every document of ``docs`` once, side by side in their sequences."""
    ids = {}
    for d in docs:
        ids.setdefault(d.doc_id, np.array([*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 0], "<u4"))
    parts, spaces = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        parts[r.doc_id].append((r.start, r.length))
        spaces[r.sequence_id].append((r.offset, r.length))
    times = Counter(d.doc_id for d in docs)
    assert set(parts) == set(times)
    for d, found in parts.items():
        assert sum(n for _, n in found) == times[d] * len(ids[d])
        covered = Counter(k for start, n in found for k in range(start, start + n))
        assert set(covered.values()) == {times[d]}
    for found in spaces.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= 1024
    assert sorted(spaces) == list(range(len(spaces)))


def test_pipeline_stages_follow_brute_force(spark, sf, tmp_path, vocabulary):
    """What each stage keeps, computed over its own input in plain Python (toxicity: by the scores of the operator, tested apart)."""
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    columns, before = docs.columns, {tuple(r) for r in docs.collect()}
    steps = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(i)))
        after = spark.read.parquet(str(tmp_path / str(i)))
        steps[name] = docs.collect(), after.collect()
        if name == "toxicity":
            clean = {r.doc_id for r in toxicity.score(docs, labels).where("predicted = 0").collect()}
        if name == "mixing":
            draws = {r.doc_id: len(r.draws) for r in mixing.mix(docs).collect()}
        assert name == "packing" or after.columns == columns and {tuple(r) for r in after.collect()} <= before
        docs = after
    given, kept = steps["toxicity"]
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in given if r.doc_id in clean)
    given, kept = steps["exact_dedup"]
    least = {}
    for r in given:
        least[_spaced(r.text)] = min(r.doc_id, least.get(_spaced(r.text), r.doc_id))
    assert sorted(r.doc_id for r in kept) == sorted(least.values())
    given, kept = steps["ngram_join"]
    assert sorted(r.doc_id for r in kept) == sorted(_near_representatives([(r.doc_id, r.text) for r in given]))
    given, kept = steps["mixing"]
    assert Counter(r.doc_id for r in kept) == Counter({d: n for d, n in draws.items() if n})
    given, rows = steps["packing"]
    _pieces(given, rows, Tokenizer.from_file(vocabulary))
    # The pipeline as a whole gives the last stage's rows; twice, before any is read.
    first, second = corpus_pipeline.run(spark, sf), corpus_pipeline.run(spark, sf)
    content = lambda rows: sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    assert content(first.collect()) == content(rows) == content(second.collect())


def test_stages_of_odd_rows(spark, odd_docs, no_docs, sf):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns and out.count() <= 2 * docs.count()


def test_what_is_stored_on_the_way_goes_and_nothing_else(spark):
    outside = lineage.stored(spark.range(3), "outside")
    with lineage.scratch(spark) as keep:
        inner = lineage.stored(spark.range(5), "inner")
        with lineage.scratch(spark) as keep_inner:
            kept_inner = keep_inner(spark.range(6), "kept-inner")
        kept = keep(spark.range(4), "kept")
        assert inner.count() == 5 and kept_inner.count() == 6
    later = lineage.stored(spark.range(7), "later")
    assert (outside.count(), kept.count(), later.count()) == (3, 4, 7)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        inner.count()

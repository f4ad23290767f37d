"""Fingerprints and their links against all pairs."""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from querylode.llm import golay, simhash


def test_words_at_two_bits_share_a_codeword():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << golay.LENGTH, 400)
    flips = [0, *(1 << a for a in range(23)), *(1 << a | 1 << b for a, b in combinations(range(23), 2))]
    near = words[:, None] ^ np.array(flips)
    own, far = [], []
    for out, values in ((own, words), (far, near.ravel())):
        at, key = golay.keys(values)
        out += [set() for _ in values]
        for i, k in zip(at.tolist(), key.tolist()):
            out[i].add(k)
    assert all(own[i // len(flips)] & keys for i, keys in enumerate(far))
    assert {len(k) for k in far} == {1, 6}


def test_keys_are_the_near_codewords():
    code = np.flatnonzero(golay.syndromes(np.arange(1 << golay.LENGTH)) == 0)
    assert len(code) == 4096 and min(int(c).bit_count() for c in code if c) == 7
    for word in np.random.default_rng(3).integers(0, 1 << golay.LENGTH, 50).tolist():
        distance = np.array([int(c ^ word).bit_count() for c in code])
        want = code[distance <= (4 if distance.min() == 3 else 2)] >> golay.CHECK_BITS
        assert sorted(golay.keys(np.array([word]))[1].tolist()) == sorted(want.tolist())


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """{index: smallest id reachable} over all pairs of (doc_id, fingerprint)."""
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= 2:
            parent[root(a)] = root(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[root(f)] = min(d, least.get(root(f), d))
    return [(d, f"{f:016x}", least.get(root(f))) for d, f in rows]


def _sorted(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("small", [simhash.SMALL, 1])
def test_documents_against_all_pairs(spark, odd_docs, no_docs, sf, small):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    want = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()])
    assert _sorted(simhash.near_duplicates(docs, small=small).collect()) == _sorted(want)
    assert simhash.near_duplicates(odd_docs, small=small).columns == ["doc_id", "fingerprint", "component_id"]
    assert simhash.near_duplicates(no_docs, small=small).collect() == []


@pytest.mark.parametrize("small", [simhash.SMALL, 4])
def test_dense_fingerprints_link_without_pairs(spark, small):
    """A cloud around one fingerprint, chains of two bits a step and scattered words: large buckets and small ones."""
    rng = np.random.default_rng(7)
    centre = int(rng.integers(0, 1 << 62))
    cloud = [centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in range(400)]
    chain = [int(rng.integers(0, 1 << 62))]
    for i in range(30):
        chain.append(chain[-1] ^ 1 << (2 * i) ^ 1 << (2 * i + 1))
    far = [chain[0] ^ 0b111 << 40, *rng.integers(0, 1 << 62, 50).tolist()]
    fps = sorted({*cloud, *chain, *far})
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    nodes = spark.createDataFrame(signed, "fp long")
    found = simhash.links(nodes.cache(), small)
    assert found.where(simhash.differing(F.col("leader"), F.col("id")) > 2).isEmpty()
    labels = {r.id: r.component for r in simhash.neardup.components(nodes.select(F.col("fp").alias("id")), found).collect()}
    want = plain_components([(i, f) for i, f in enumerate(fps)])
    groups = {}
    for (i, _, c), (s,) in zip(want, signed):
        groups.setdefault(c, set()).add(labels[s])
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)

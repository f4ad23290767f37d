"""Exact copies, near copies and repeated strings against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from querylode.llm import exact_dedup, ngram_join, shingles, suffix_dedup, worker


def test_exact_dedup_odd_rows(odd_docs, no_docs):
    rows = exact_dedup.exact_dedup(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r.text_sha256].append(r)
    for group in by.values():
        assert sum(r.kept for r in group) == 1 and {r.group_size for r in group} == {len(group)}
    base = next(r for r in rows if r.doc_id == 6)
    assert (base.keep_id, base.group_size, base.kept) == (5, 3, False)
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.doc_id for r in by[empty]} == {1, 2}
    assert {r.doc_id for r in by[hashlib.sha256(b" ").hexdigest()]} == {3}
    assert exact_dedup.exact_dedup(no_docs).count() == 0


def test_exact_dedup_tells_colliding_texts_apart(odd_docs):
    want = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in exact_dedup.exact_dedup(odd_docs).collect())
    weak = exact_dedup.exact_dedup(odd_docs.withColumn("_row", F.monotonically_increasing_id()), lambda text: F.length(text) % 3)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in weak.collect()) == want


def test_drop_copies_keeps_one_of_each(odd_docs):
    left = exact_dedup.drop_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert left.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in odd_docs.select("text").collect()})


def word_set(text, size):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def brute_components(docs, size, percent):
    sets = [(d, word_set(t, size)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {d: (len(s), find(d)) for d, s in sets}


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_near_duplicates_match_all_pairs(spark, size, percent):
    rnd = random.Random(percent)
    passage = [f"p{i}" for i in range(60)]
    docs = []
    for family in range(6):
        words = [f"{family}w{rnd.randint(0, 400)}" for _ in range(rnd.choice((8, 40, 150)))] + passage * (family % 2)
        for _ in range(14):
            edited = list(words)
            for _ in range(rnd.choice((0, 0, 1, 1, 2, 3, 6))):
                edited[rnd.randrange(len(edited))] = f"e{rnd.randint(0, 10**6)}"
            docs.append((len(docs) * 3, " ".join(edited)))
    docs += [(1000 + i, t) for i, t in enumerate(["", None, "a", "A", "a b", "a b", "b a", "a b c", "Same Same Same Same", "same same same same"])]
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(docs, size, percent)


def test_groups_that_do_not_link_are_not_compared_pair_by_pair(spark, monkeypatch):
    """Copies of one text that are nearly all just beyond the threshold."""
    rnd, compared = random.Random(3), []
    base = [f"w{i}" for i in range(300)]
    docs = []
    for i in range(60):
        edited = list(base)
        for slot in rnd.sample(range(60), 5):
            edited[5 * slot] = f"w{slot}x{rnd.randint(0, 6)}"
        docs.append((i, " ".join(edited)))
    linked = ngram_join._linked

    def counted(pairs, full, percent):
        compared.append(pairs.count())
        return linked(pairs, full, percent)

    monkeypatch.setattr(ngram_join, "_linked", counted)
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 5, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(docs, 5, 80)
    assert sum(compared) < 3 * len(docs)


def test_components_of_a_crowded_bucket_meet_through_other_leaders(spark, monkeypatch):
    """Two families whose texts link across: a leader of the other component joins them, not all their pairs."""
    rnd, compared = random.Random(5), []
    base = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(120):
        edited = list(base)
        edited[i % 10 * 20] = f"a{rnd.randint(0, 50)}"
        if i % 2:
            edited[5], edited[105] = "b", "c"
        docs.append((i, " ".join(edited)))
    linked, leaders = ngram_join._linked, ngram_join._leaders
    monkeypatch.setattr(ngram_join, "_linked", lambda pairs, *a: (compared.append(pairs.count()), linked(pairs, *a))[1])
    # First leaders that meet their own family only.
    families = spark.createDataFrame([(d % 2, int.from_bytes(shingles.fingerprint(s)[:8], "little", signed=True))
                                      for (d, t), s in zip(docs, shingles.shingle_sets([t for _, t in docs], 5))], "family int, set long").distinct()
    monkeypatch.setattr(ngram_join, "_leaders", lambda first: leaders(first.join(families.where("family = 0"), "set")))
    stars = ngram_join._stars
    odd = [r["set"] for r in families.where("family = 1").collect()]
    monkeypatch.setattr(ngram_join, "_stars", lambda first, lead, percent, also=None: stars(
        first if also is not None else first.where(~F.col("set").isin(odd)), lead, percent, also))
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 5, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(docs, 5, 80)
    assert len(compared) > 2 and sum(compared) < 6 * len(docs)


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    rows = ngram_join.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in rows if r.doc_id in (1, 2, 5, 6)} == {(1, 0, 1), (2, 0, 2), (5, 10, 5), (6, 10, 5)}
    assert ngram_join.near_duplicates(no_docs).count() == 0
    assert ngram_join.keep_one(odd_docs).columns == odd_docs.columns


def test_keep_one_goes_by_row(spark, odd_docs):
    base = "one two three four five six seven eight nine ten eleven twelve"
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(odd_docs, 3, 80).select("doc_id", "text").collect()), key=str)
    gone = [(6, base.replace(" ", "\n")), (9, base + " thirteen")]
    assert kept == sorted(((r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect() if (r.doc_id, r.text) not in gone), key=str)
    words = [f"w{i}" for i in range(40)]
    docs = [(1, " ".join(words)), (None, " ".join(words[2:] + ["x", "y"])), (2, " ".join(words[4:] + ["x", "y", "z", "q"]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.near_duplicates(df, 3, 85).collect()} == {1: 1, None: 1, 2: 1}  # null is the bridge
    assert {r.doc_id for r in ngram_join.keep_one(df, 3, 85).collect()} == {1, None}


def test_shingle_hashes_are_those_of_the_words():
    texts = ["", "a", "A b  c\td", "a b c d", "é è", "x y z x y z", "a b c d e f g"]
    for size in (1, 3, 5):
        assert [len(s) for s in shingles.shingle_sets(texts, size)] == [len(word_set(t, size)) for t in texts]
    a, b = shingles.shingle_sets(["A b  c\td", "a b c d"], 3)
    assert (a == b).all()


def brute_repeats(docs, length):
    count = Counter()
    for _, text in docs:
        raw = (text or "").encode()
        count.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for d, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if count[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((d, len(raw), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


def test_removed_bytes_match_brute_force(spark):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abé ") for _ in range(120)) for _ in range(4)]
    docs = []
    for i in range(60):
        parts = ["ab", "a" * rnd.randint(0, 60), base[rnd.randint(0, 3)][rnd.randint(0, 40) : rnd.randint(50, 120)], "xyzzy" * rnd.randint(0, 9)]
        docs.append((i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 8)))))
    docs += [(100 + i, base[0]) for i in range(4)] + [(100, base[0]), (None, base[1]), (None, None), (200, ""), (201, "a" * 300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.lit(0)).repartition(3)
    got = sorted((tuple(r) for r in suffix_dedup.remove_repeats(df, 40, 20, 8).collect()), key=str)
    assert got == brute_repeats(docs, 40)
    kept = suffix_dedup.remove_repeats(df, 40, 20, 8, texts=True).collect()
    assert {hashlib.sha256(r.kept).hexdigest() for r in kept} == {r[4] for r in got}


def test_planted_passages_go_whole_and_other_documents_stay(spark):
    """At the lengths of the query: passages of over 50 words in two or three documents; those under 400 bytes stay, by contract."""
    rnd = random.Random(8)

    def words(n, longest):
        return " ".join("".join(rnd.choice("abcdé") for _ in range(rnd.randint(2, longest))) for _ in range(n))

    docs, planted = [(i, words(rnd.randint(60, 200), 9)) for i in range(60)], {}
    for k in range(16):
        passage = words(rnd.randint(51, 60), 5) if k % 4 == 0 else words(rnd.randint(51, 110), 12)
        for i in range(3 * k, 3 * k + rnd.randint(2, 3)):
            docs[i], planted[i] = (i, docs[i][1][:150] + "\n" + passage + "\n" + docs[i][1][150:]), len(passage.encode())
    got = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_repeats(docs, suffix_dedup.LENGTH)
    assert len({n < 400 for n in planted.values()}) == 2
    for r in got:
        n = planted.get(r.doc_id, 0)
        assert r.n_removed >= n if n >= 400 else (r.n_removed, r.n_spans) == (0, 0)
        assert r.n_bytes == len(docs[r.doc_id][1].encode())


def test_removed_bytes_of_no_rows(no_docs):
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_tasks_of_the_ngram_join_give_their_memory_back(monkeypatch):
    """A worker that waits lies beside the stages that need none: the last thing a task does is to free what it took."""
    left = []
    monkeypatch.setattr(worker, "release", lambda: left.append("released"))
    texts = pa.RecordBatch.from_pydict({"row": [1, 2], "doc_id": [1, 2], "text": ["a b c d", None]})
    for whole in (False, True):
        left.clear()
        assert len([*ngram_join._sets(3, 90, whole)(iter([texts]))]) == 1 and left == ["released", "released"]
    left.clear()
    assert not [*ngram_join._compared(90)(iter([]))] and left == ["released"]

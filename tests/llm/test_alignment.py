"""Alignment of two tokenizers against a plain version that looks at every pair of token occurrences."""

from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

from querylode.llm import alignment


@pytest.fixture(scope="module")
def paths(vocabulary):
    import public_tokenizers

    return vocabulary, public_tokenizers.path("piece_bpe_32k.model")


def _ends(tokens):
    at, out = 0, []
    for t in tokens:
        at += len(t)
        out.append(at)
    return out


def brute(texts, paths):
    """Rows of ``texts`` (doc_id, text), token by token over the whole text at once."""
    import sentencepiece

    a_side, b_side = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a_side.encode_special_tokens = True
    both = alignment.Pair(*paths)
    counts, rows, tops = Counter(), [], defaultdict(int)
    for doc_id, text in texts:
        row = {"doc_id": doc_id, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "links": []}
        rows.append(row)
        a = a_side.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_side.encode(text or "")
        a_tokens, b_tokens = [both.a_bytes[i] for i in a], [both.b_bytes[i] for i in b]
        if not text or not b"".join(a_tokens) == b"".join(b_tokens) == (" " + text).encode():
            continue
        a_end, b_end = _ends(a_tokens), _ends(b_tokens)
        cut = sorted(set(a_end) & set(b_end))
        sides = []
        for ids, ends in ((a, a_end), (b, b_end)):
            of_group = [[] for _ in cut]
            for i, e in zip(ids, ends):
                of_group[bisect_left(cut, e)].append(str(i))
            sides.append([",".join(g) for g in of_group])
        groups = [f"{x}|{y}" for x, y in zip(*sides)]
        j = 0
        for i, (e, t) in enumerate(zip(a_end, a_tokens)):
            while b_end[j] <= e - len(t):
                j += 1
            k = j
            while k < len(b) and b_end[k] - len(b_tokens[k]) < e:
                row["links"].append((a[i], b[k]))
                k += 1
        row |= {"n_a": len(a), "n_b": len(b), "n_groups": len(groups), "n_links": len(row["links"]),
                "groups_sha256": hashlib.sha256(";".join(groups).encode()).hexdigest()}
        counts.update(row["links"])
    for (_, y), n in counts.items():
        tops[y] = max(tops[y], n)
    for row in rows:
        links = row.pop("links")
        row |= {"n_best": sum(counts[p] == tops[p[1]] for p in links), "count_sum": sum(counts[p] for p in links)}
    return rows, counts


def _key(row):
    return sorted((k, str(v)) for k, v in row.items())


def _same(got, want):
    assert sorted(map(_key, (r.asDict() for r in got))) == sorted(map(_key, want))


def test_documents_against_every_pair_of_tokens(spark, sf, paths):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").repartition(3)
    rows, totals = alignment.align(docs, *paths)
    want, counts = brute([(r.doc_id, r.text) for r in docs.collect()], paths)
    _same(rows.collect(), want)
    assert {(r.a, r.b): r.total for r in totals.collect()} == dict(counts)


def test_chunks_change_nothing(paths):
    """Odd spaces, marks, special strings and texts that do not come back, cut into chunks of a few pieces."""
    rng = random.Random(5)
    letters = " \n\t\x0b\x1c\x85\xa0  aé.,'sx1▁<|>/s𝔘\x00"
    texts = [(i, "".join(rng.choices(letters, k=rng.randint(0, 14)))) for i in range(3000)]
    texts += [(-1, "<|endoftext|> a"), (-2, "a <s> </s> <0x41>"), (-3, "a  b"), (-4, "x\n\ny"), (-5, "▁"), (-6, "\nx\ny\n"), (-7, "x" * 50_000)]
    both, got = alignment.Pair(*paths), []
    for first in range(0, len(texts), 37):
        chunk = alignment._Chunk(both)
        for doc_id, text in texts[first : first + 37]:
            chunk.add(doc_id, text)
        got += [r for batch in chunk.rows(0) for r in batch.to_pylist() if r["a"] is None]
    want, _ = brute(texts, paths)
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    assert [[r[n] for n in names] for r in got] == [[r[n] for n in names] for r in want]
    assert sum(r["n_a"] == 0 for r in want) > 100


def test_odd_documents(spark, odd_docs, no_docs, paths):
    rows, _ = alignment.align(odd_docs, *paths)
    want, _ = brute([(r.doc_id, r.text) for r in odd_docs.collect()], paths)
    _same(rows.collect(), want)
    rows, totals = alignment.align(no_docs, *paths)
    assert rows.collect() == [] and totals.collect() == []

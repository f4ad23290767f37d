"""Encoding, token files and packing: exact round trips."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from querylode.llm import encoding, frames, packing, token_files

HARD = [
    "", " ", "  ", "a  b", "a   b", " a", "a ", "\n\n x", "x \n y", "a\xa0 b", "it's  'll don't", "\t\tx  \r\n y", "<|endoftext|> x", "a<|endoftext|>b c", "x <|endoftext|>, y. <|endoftext|>\n<|endoftext|> z", "<|endoftext|><|endoftext|>",
    "\x01 a \x02b", "a \x1cb", "x \x85 y", " 　 q", "1 2  3   4", "a, b. c,\nd.\ne, ", "!!, x", "a , b", "_, x", "²., x", "a.\n\nb", "a\n\n\nb", ", a", "é, è. 9, x.",
]


@pytest.fixture(scope="module")
def plain(vocabulary):
    """The library as it comes: strings of special tokens are those tokens."""
    tokenizer = Tokenizer.from_file(vocabulary)
    return lambda text: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4")


def test_special_strings(vocabulary, plain):
    assert plain("<|endoftext|> a").tolist() == encoding.Encoder(vocabulary).encode(["<|endoftext|> a"])[0].tolist()
    assert 50256 in plain("x<|endoftext|>, y") and 50256 not in encoding.Encoder(vocabulary, plain=True).encode(["x<|endoftext|>, y"])[0]


@pytest.mark.parametrize("as_text", [False, True])
def test_pieces_give_the_ids_of_whole_texts(vocabulary, plain, as_text):
    if as_text:
        tokenizer = Tokenizer.from_file(vocabulary)
        tokenizer.encode_special_tokens = True
        plain = lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
    coder = encoding.Encoder(vocabulary, pieces=20, plain=as_text)  # forgets again and again
    for _ in range(3):
        ids, offsets = coder.encode(HARD, end=7)
        for i, text in enumerate(HARD):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == [*plain(text), 7], text


def test_a_piece_is_looked_up_once_however_often_it_stands_in_the_texts(vocabulary, plain):
    class Counting(type(encoding.Encoder(vocabulary).numbers)):
        looked = 0

        def __getitem__(self, piece):
            self.looked += 1
            return super().__getitem__(piece)

    coder, texts = encoding.Encoder(vocabulary), ["one two, three. " * 500 + "four", "two  \n three one", "", "three\none" * 50]
    numbers = Counting()
    numbers.update(coder.numbers)
    coder.numbers = numbers
    ids, offsets = coder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [plain(t).tolist() for t in texts]
    assert numbers.looked < 30


def test_special_tokens_stand_only_between_pieces_that_need_them(vocabulary, plain, monkeypatch):
    coder, parted = encoding.Encoder(vocabulary), []
    was = coder._parted
    monkeypatch.setattr(coder, "_parted", lambda texts: parted.extend(texts) or was(texts))
    texts = ["zero " + " ".join(f"w{i}é" for i in range(5000)), "\tx", *HARD]
    ids, offsets = coder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [plain(t).tolist() for t in texts]
    assert len(parted) < 2 * len(texts)


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 4000])
def test_packed_integers_come_back(n):
    values = (np.random.default_rng(n).zipf(1.3, n) % 50257).astype(np.uint32)
    if n > 300:
        values[[3, 300]] = 2**32 - 1
    data = frames.encode(values)
    assert frames.count(data) == n and (frames.decode(data) == values).all()
    for a, b in ((0, 1), (100, 300), (255, 257), (3, 9999)):
        assert (frames.decode(data, a, b) == values[a:b]).all()
    assert n < 300 or len(data) < 4 * n


def test_token_files(spark, odd_docs, no_docs, plain, vocabulary, tmp_path):
    token_files.write(odd_docs, str(tmp_path / "a"), vocabulary, end=2)
    rows = token_files.read_documents(spark, str(tmp_path / "a")).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d))
    want = defaultdict(list)
    for r in odd_docs.select("doc_id", "text").collect():
        ids = np.append(plain(r.text), 2).astype("<u4")
        want[r.doc_id].append((len(ids), zlib.crc32(ids.tobytes())))
    start = 0
    for r in rows:
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        assert r.start == start
        start += r.n_tokens
    assert {len(r.ids) for r in token_files.read_ids(spark, str(tmp_path / "a")).collect()} == {r.n_tokens for r in rows}
    token_files.write(no_docs, str(tmp_path / "b"), vocabulary)
    assert token_files.read_documents(spark, str(tmp_path / "b")).count() == 0


def first_fit_decreasing(lengths, demand):
    bins = []
    for length in sorted(np.repeat(lengths, demand).tolist(), reverse=True):
        at = next((i for i, room in enumerate(bins) if room >= length), None)
        if at is None:
            bins.append(packing.CAPACITY - length)
        else:
            bins[at] -= length
    return len(bins)


def test_column_generation_covers_demand():
    rng = np.random.default_rng(0)
    lengths = np.array(sorted({*range(16, 1024, 16), *range(1, 16)}))
    for demand in (rng.integers(0, 3, len(lengths)), rng.integers(0, 30, len(lengths)), np.eye(len(lengths), dtype=int)[5]):
        plan = packing.column_generation(lengths, demand.astype(float))
        assert (sum(times * pattern for times, pattern in plan) == demand).all()
        assert all((pattern * lengths).sum() <= packing.CAPACITY for _, pattern in plan)
        assert sum(times for times, _ in plan) <= 1.05 * first_fit_decreasing(lengths, demand) + 1


def test_column_generation_finds_patterns_that_first_fit_misses():
    lengths, demand = np.array([272, 288, 336, 400, 464]), np.array([300, 300, 300, 300, 300])
    plan = packing.column_generation(lengths, demand.astype(float))
    assert sum(times for times, _ in plan) < first_fit_decreasing(lengths, demand)


def test_packing(odd_docs, no_docs, plain, vocabulary):
    rows = packing.pack_documents(odd_docs.where("doc_id is null or doc_id not in (5, 9)"), vocabulary, end=0).collect()
    texts = {r.doc_id: np.append(plain(r.text), 0).astype("<u4") for r in odd_docs.collect() if r.doc_id not in (5, 9)}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for doc_id, ids in texts.items():
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(ids[at : at + r.length].tobytes()), len(ids))
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    assert sorted(sequences) == list(range(len(sequences)))
    assert packing.pack_documents(no_docs, vocabulary).count() == 0

"""Two tokenizers over the same texts: which tokens cover the same bytes, and how often each pair of ids meets.

No token of either crosses the place between a visible character and a space or line break that another visible character follows.
Texts are cut there, and each distinct piece of a run of texts (a *chunk*) is encoded and aligned once. Within a piece the ends of all
tokens cut its bytes into intervals, each inside exactly one token of either side: the intervals are the links.

A group of one token on either side whose ids are matched by the precomputed map from A ids to B ids of the same bytes is counted in
an array as long as the vocabulary. Only links of other groups become pairs of ids: once per chunk with their number, never per
document. Their totals over the corpus return to the chunks that hold them, and each document adds up its pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from querylode import lineage
from querylode.llm import common, encoding, worker

#: A chunk ends with the text that brings it to this many distinct pieces, or so many in all.
CHUNK_PIECES, CHUNK_LENGTH = 150_000, 3_000_000
#: Pieces aligned at a time, and those that A's library gets in one call.
BLOCK, CALL = 20_000, 4_000
_CUT = re.compile(r"(?<=\S)(?= \S|\n\S)")
SPACE = "▁"
#: GPT-2's byte alphabet: printable bytes stand for themselves, the others for characters from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pieces binary"
TABLE = "a binary, b binary, sizes binary, uses binary"


def _byte_alphabet() -> dict[str, int]:
    out = {chr(b): b for b in _PRINTABLE}
    rest = (b for b in range(256) if b not in set(_PRINTABLE))
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """The two tokenizers, the bytes of their tokens and the map between ids of equal bytes."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(a_path)
        self.mark_id, self.mark = next((i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = _byte_alphabet()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.a_length, self.b_length = (np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        # Of several B ids of the same bytes the one of a piece, not of a single byte, is the usual one.
        usual = {t: i for i, t in enumerate(self.b_bytes) if self.pieces.is_byte(i)}
        usual |= {t: i for i, t in enumerate(self.b_bytes) if not (self.pieces.is_byte(i) or self.pieces.is_control(i) or self.pieces.is_unknown(i))}
        self.same = np.array([usual.get(t, -1) if t else -1 for t in self.a_bytes], np.int64)
        # Texts of ids, with what may follow them.
        n = max(len(self.a_bytes), len(self.b_bytes))
        self.text = np.array([str(i) for i in range(n)], object)

    def _a_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, how many each has). Joined by a special token, whose id parts them again; a piece that holds its
        string is encoded alone."""
        own = [i for i, p in enumerate(pieces) if self.mark in p]
        self.tokenizer.encode_special_tokens = True
        found = [self.tokenizer.encode(pieces[i], add_special_tokens=False).ids for i in own]
        self.tokenizer.encode_special_tokens = False
        texts = list(pieces)
        for i in own:
            texts[i] = ""
        runs = (self.mark.join(texts[i : i + CALL]) + self.mark for i in range(0, len(texts), CALL))
        flat = np.concatenate([np.asarray(self.tokenizer.encode_batch_fast([r], add_special_tokens=False)[0].ids, np.int64) for r in runs])
        gaps = np.flatnonzero(flat == self.mark_id)
        count = np.diff(gaps, prepend=-1) - 1
        flat = np.delete(flat, gaps)
        if own:
            flat = np.insert(flat, np.repeat(np.cumsum(count)[own], [len(f) for f in found]), np.concatenate(found))
            count[own] = [len(f) for f in found]
        return flat, count

    def _b_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of B. The library puts a space first: a piece's own one is left out, and the one before a line break is a token that goes."""
        ids = self.pieces.encode([p[1:] if p[0] == " " else p for p in pieces], num_threads=1)
        for i, p in enumerate(pieces):
            if p[0] != " ":
                ids[i] = ids[i][1:]
        return np.fromiter(chain.from_iterable(ids), np.int64), np.fromiter(map(len, ids), np.int64, len(ids))

    def _right(self, tokens: list[bytes], ids: np.ndarray, count: np.ndarray, raw: list[bytes]) -> np.ndarray:
        """Which pieces come back byte by byte; nearly always all of a list, which one comparison shows."""
        ends = np.cumsum(count)
        parts = list(map(tokens.__getitem__, ids.tolist()))
        length = np.diff(np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])[np.concatenate([[0], ends])])
        if (length == [len(r) for r in raw]).all() and b"".join(parts) == b"".join(raw):
            return np.ones(len(raw), bool)
        return np.array([b"".join(parts[e - n : e]) == r for e, n, r in zip(ends.tolist(), count.tolist(), raw)], bool)

    def align(self, pieces: list[str]) -> "Aligned":
        """Aligns pieces; those that one of the two does not give back byte by byte have no tokens and are marked."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        a, n_a = self._a_ids(pieces)
        b, n_b = self._b_ids(pieces)
        right = self._right(self.a_bytes, a, n_a, raw) & self._right(self.b_bytes, b, n_b, raw)
        a, b = a[np.repeat(right, n_a)], b[np.repeat(right, n_b)]
        n_a, n_b = np.where(right, n_a, 0), np.where(right, n_b, 0)
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        ends = np.union1d(a_end, b_end)
        at_a, at_b = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(both, a_end), np.searchsorted(both, b_end)
        size_a, size_b = np.bincount(a_group, minlength=len(both)), np.bincount(b_group, minlength=len(both))
        piece_ends = np.cumsum(np.where(right, [len(r) for r in raw], 0))
        group_ends = np.searchsorted(both, piece_ends, side="right")
        link_ends = np.searchsorted(ends, piece_ends, side="right")
        link_a, link_b = a[at_a], b[at_b]
        group = a_group[at_a]
        plain = (size_a[group] == 1) & (size_b[group] == 1) & (self.same[link_a] == link_b)
        return Aligned(right, n_a, n_b, np.diff(group_ends, prepend=0), np.diff(link_ends, prepend=0), link_a, link_b, plain,
                       self._written(a, b, a_group, b_group, size_a, size_b, group_ends))

    def _written(self, a, b, a_group, b_group, size_a, size_b, group_ends) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each piece."""
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        names = np.concatenate([self.text[a], self.text[b]])[order]
        group = np.concatenate([a_group, b_group])[order]
        side = (order >= len(a)).astype(np.int8)
        last = np.ones(len(order), bool)
        last[:-1] = (group[1:] != group[:-1]) | (side[1:] != side[:-1])
        marks = np.array([",", "|", ";"], object)[np.where(last, 1 + side, 0)]
        line = names + marks
        token_ends = np.concatenate([[0], np.cumsum(size_a + size_b)])[group_ends].tolist()
        parts, at = line.tolist(), 0
        out = []
        for end in token_ends:
            out.append("".join(parts[at:end])[:-1])
            at = end
        return out


class Aligned:
    """Columns of a list of pieces, and their links in a row."""

    def __init__(self, right, n_a, n_b, n_groups, n_links, a, b, plain, written) -> None:
        self.right, self.n_a, self.n_b, self.n_groups, self.n_links = right, n_a, n_b, n_groups, n_links
        self.a, self.b, self.plain, self.written = a, b, plain, written


def pair(a_path: str, b_path: str) -> Pair:
    """One per worker, as long as no other operator needs the room."""
    return worker.resident(("pair", a_path, b_path), lambda: Pair(a_path, b_path))


class _Numbers(dict):
    """Numbers its keys by first use."""

    def __missing__(self, key: str) -> int:
        self[key] = len(self)
        return self[key]


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2^32, their lowest bytes first, then the next ones: what is small compresses."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


class _Chunk:
    """The texts of a run and the distinct pieces in them."""

    def __init__(self, both: Pair) -> None:
        self.both, self.numbers, self.docs = both, _Numbers(), []
        self.length = 0

    def full(self) -> bool:
        return len(self.numbers) >= CHUNK_PIECES or self.length >= CHUNK_LENGTH

    def add(self, doc_id: int | None, text: str) -> None:
        pieces = _CUT.split(" " + text) if text else []
        self.docs.append((doc_id, np.fromiter(map(self.numbers.__getitem__, pieces), "<u4", len(pieces))))
        self.length += len(pieces)

    def rows(self, chunk: int) -> Iterator[pa.RecordBatch]:
        """The documents' rows, then one with the links of the pieces (where a text lacks tokens, its pieces count nothing)."""
        names = list(self.numbers)
        parts = [self.both.align(names[i : i + BLOCK]) for i in range(0, len(names), BLOCK)]
        join = lambda field: np.concatenate([getattr(p, field) for p in parts]) if parts else np.zeros(0, np.int64)
        right, n_a, n_b, n_groups, n_links = join("right").astype(bool), *map(join, ("n_a", "n_b", "n_groups", "n_links"))
        written = [w for p in parts for w in p.written]
        self.docs = [(d, number if right[number].all() else number[:0]) for d, number in self.docs]
        uses = np.bincount(np.concatenate([number for _, number in self.docs]), minlength=len(names))
        # Frequent pieces get small numbers, whose upper bytes are zero.
        order = np.argsort(-uses, kind="stable")
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        out, size = [], 0
        for doc_id, number in self.docs:
            digest = hashlib.sha256(";".join([written[i] for i in number.tolist()]).encode()).hexdigest() if len(number) else ""
            counts = [int(c[number].sum()) if len(number) else 0 for c in (n_a, n_b, n_groups, n_links)]
            out.append((chunk, doc_id, *counts, digest, _planes(place[number]), None, None, None, None))
            size += len(number)
            if size > 500_000:
                yield _batch(out)
                out, size = [], 0
        a, b, plain = join("a"), join("b"), join("plain").astype(bool)
        ends = np.cumsum(n_links)
        sizes = n_links[order]
        links = np.repeat(ends[order] - np.cumsum(sizes), sizes) + np.arange(int(sizes.sum()))
        table = [np.where(plain, a, a + len(self.both.a_bytes))[links], b[links], sizes, uses[order]]
        out.append((chunk, *[None] * 7, *map(_planes, table)))
        yield _batch(out)


_SCHEMA = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                     ("groups_sha256", pa.string()), *((c, pa.binary()) for c in ("pieces", "a", "b", "sizes", "uses"))])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def _encoded(a_path: str, b_path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)
        number, chunk = TaskContext.get().partitionId() << 32, _Chunk(both)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, texts in encoding.slices(batch.column("text")):
                for doc_id, text in zip(ids[first:], texts):
                    chunk.add(doc_id, text)
                    if chunk.full():
                        yield from chunk.rows(number)
                        number, chunk = number + 1, _Chunk(both)
        if chunk.docs:
            yield from chunk.rows(number)

    return encode


class _Table:
    """A chunk's stored links: ids, whether the fast path holds them, the piece of each, and how often pieces occur."""

    def __init__(self, both: Pair, a: bytes, b: bytes, sizes: bytes, uses: bytes) -> None:
        marked, self.b, self.sizes, self.uses = map(_numbers, (a, b, sizes, uses))
        n = len(both.a_bytes)
        self.plain = marked < n
        self.a = np.where(self.plain, marked, marked - n)
        self.piece = np.repeat(np.arange(len(self.sizes)), self.sizes)


def _counted(a_path: str, b_path: str):
    """chunk, a, b, n: irregular links of each chunk; with chunk null the regular ones of the whole task, from its array."""

    def batch(chunk, a, b, n) -> pa.RecordBatch:
        chunks = pa.nulls(len(a), pa.int64()) if chunk is None else pa.array(np.full(len(a), chunk))
        return pa.RecordBatch.from_arrays([chunks, pa.array(a), pa.array(b), pa.array(n)], names=["chunk", "a", "b", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)
        width = len(both.b_bytes)
        regular = np.zeros(len(both.a_bytes), np.int64)
        for rows in batches:
            for row in rows.to_pylist():
                t = _Table(both, *(row[c] for c in ("a", "b", "sizes", "uses")))
                n = t.uses[t.piece]
                regular += np.bincount(t.a[t.plain], n[t.plain], len(regular)).astype(np.int64)
                odd = ~t.plain & (n > 0)
                pairs, at = np.unique(t.a[odd] * width + t.b[odd], return_inverse=True)
                yield batch(row["chunk"], pairs // width, pairs % width, np.bincount(at, n[odd], len(pairs)).astype(np.int64))
        used = np.flatnonzero(regular)
        yield batch(None, used, both.same[used], regular[used])

    return count


def _summed(a_path: str, b_path: str, totals: np.ndarray, best: np.ndarray):
    """Figures of the documents of one chunk, from its rows and the totals of its irregular pairs."""

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        both = pair(a_path, b_path)
        width = len(both.b_bytes)
        tables = left.filter(pa.compute.is_valid(left["a"])).select(["a", "b", "sizes", "uses"]).to_pylist()
        docs = left.filter(pa.compute.is_null(left["a"]))
        t = _Table(both, *tables[0].values())
        keys = right["a"].to_numpy() * width + right["b"].to_numpy()
        order = np.argsort(keys)
        keys, total, top = keys[order], right["total"].to_numpy()[order], right["best"].to_numpy()[order]
        link_total, link_best = totals[t.a], best[t.a]
        odd = ~t.plain & (t.uses[t.piece] > 0)
        at = np.searchsorted(keys, t.a[odd] * width + t.b[odd])
        link_total[odd], link_best[odd] = total[at], top[at]
        # Sums per piece in whole numbers: differences of running sums.
        ends = np.cumsum(t.sizes)
        per_piece = [np.diff(np.concatenate([[0], np.cumsum(v)])[np.concatenate([[0], ends])]) for v in (link_best.astype(np.int64), link_total)]
        numbers = [_numbers(p) for p in docs["pieces"].to_pylist()]
        sums = [pa.array([int(v[n].sum()) for n in numbers], pa.int64()) for v in per_piece]
        kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
        return pa.table([*[docs[c] for c in kept], *sums, docs["groups_sha256"]], names=[*kept, "n_best", "count_sum", "groups_sha256"])

    return add


def align(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """((doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs`` (doc_id, text),
    (a, b, total) of every pair of ids that are linked anywhere).

    A is a byte-level vocabulary of the tokenizers library, B a piece model with byte fallback; both paths must exist on every worker.
    A text is read with one space put before it, strings of special tokens in it are plain text. Null and empty texts, and those
    that one of the two does not give back byte by byte, have no tokens: zeros and an empty digest. Rows are judged one by one, also
    those that repeat a doc_id or lack one; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text"))
    rows = lineage.stored(texts.mapInArrow(_encoded(a_path, b_path), f"chunk long, {DOC}, {TABLE}"), "aligned")
    tables = rows.where("a is not null").select("chunk", "a", "b", "sizes", "uses")
    counted = lineage.stored(tables.mapInArrow(_counted(a_path, b_path), "chunk long, a long, b long, n long"), "pairs-by-chunk")
    total = lineage.stored(counted.groupBy("a", "b").agg(F.sum("n").alias("total")), "pair-totals")
    top = total.groupBy("b").agg(F.max("total").alias("top"))  # as many rows as B has ids
    scored = lineage.stored(total.join(F.broadcast(top), "b").select("a", "b", "total", (F.col("total") == F.col("top")).alias("best")), "scored-pairs")

    # Ids of equal bytes: as many rows as A has ids, whatever the corpus.
    regular = scored.join(F.broadcast(counted.where("chunk is null").select("a", "b").distinct()), ["a", "b"], "left_semi").toArrow()
    n = len(pair(a_path, b_path).a_bytes)
    totals, best = np.zeros(n, np.int64), np.zeros(n, bool)
    totals[regular["a"].to_numpy()], best[regular["a"].to_numpy()] = regular["total"].to_numpy(), regular["best"].to_numpy()

    odd = counted.where("chunk is not null").select("chunk", "a", "b").join(scored, ["a", "b"])
    of_docs = rows.groupBy("chunk").cogroup(odd.groupBy("chunk")).applyInArrow(
        _summed(a_path, b_path, totals, best),
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return of_docs, total

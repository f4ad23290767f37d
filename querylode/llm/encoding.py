"""Token ids of whole texts, at the cost of the distinct words in them.

The byte-level vocabulary's pre-tokeniser never lets a token cross the place before a single space that a visible character follows.
Texts are therefore cut there, every distinct piece is given to the tokenizers library once, and texts are put together from the
pieces' ids. A comma or full stop behind a letter or digit and before a space or line break is a token of its own as well. The memory
of pieces is bounded; when full it keeps those used more than once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from querylode.llm import worker

#: Pieces remembered per Python worker.
PIECES = 600_000
_CUT = re.compile(r" (?=\S)")
#: Spaces beside which, or instead of which, only the careful cut is right.
_ODD_SPACES = ("  ", " \n", "\n\n", *"\t\r\x0b\x0c\x1c\x1d\x1e\x1f")
#: Pieces of their own: a comma, a full stop, a line break; and the mark of a piece that no space precedes.
COMMA, STOP, BREAK, BARE = "\x01", "\x02", "\x03", "\x04"
_WIDE_SPACES = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_ODD_STOP = re.compile(r"[,.](?<![^\W_][,.])(?=[ \n])")


class _Pieces(dict):
    """Numbers its keys by first use and remembers the new ones."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


def _gathered(values: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the runs of ``values`` that start at ``begin``, one behind the other, and where each of them ends)."""
    ends = np.cumsum(length)
    return values[np.repeat(begin - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)], ends


class Encoder:
    """Strings of special tokens inside texts are those tokens, as in the library; with ``plain`` they are ordinary text."""

    def __init__(self, path: str, pieces: int = PIECES, plain: bool = False) -> None:
        from tokenizers import Tokenizer

        self.plain = plain
        self.tokenizer = Tokenizer.from_file(path)
        self.mark_id, self.mark = next((i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # of every token: one per character of the byte-level alphabet
        self.bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.limit = pieces
        self._begin()

    def _begin(self) -> None:
        self.numbers = _Pieces()  # of pieces as they follow a space, or with a mark
        self.ids, self.starts = np.zeros(1 << 20, np.uint32), np.zeros(1 << 18, np.int64)
        self.uses = np.zeros(0, np.int64)
        for piece in (BREAK, COMMA, STOP):
            self.numbers[piece]
        self._learn()

    def _shrink(self) -> None:
        order = np.argsort(-self.uses, kind="stable")[: self.limit // 2]
        kept = np.unique(np.concatenate([[0, 1, 2], order[self.uses[order] > 1]]))
        names = list(self.numbers)
        length = (self.starts[1:] - self.starts[:-1])[kept]
        ids, ends = _gathered(self.ids, self.starts[kept], length)
        self.numbers = _Pieces()
        self.numbers.update((names[n], i) for i, n in enumerate(kept.tolist()))
        self.ids[: len(ids)] = ids
        self.starts[: len(kept) + 1] = np.concatenate([[0], ends])
        self.uses = np.zeros(0, np.int64)

    def _pieces(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the pieces of all texts in a row, offsets of the texts in them); a piece is looked up once, however often it stands
        in the texts."""
        careful, easy, many, is_easy = [], [], [], []
        for text in texts:
            if any(m in text for m in (COMMA, STOP, BREAK, BARE)):
                careful.append(BARE + text)
                many.append(1)
                is_easy.append(False)
            elif text[-1:] == " " or any(s in text for s in _ODD_SPACES) or not text.isascii() and any(s in text for s in _WIDE_SPACES):
                first, *rest = _CUT.split(text)  # runs of spaces are tokens of their own: cut only where it is safe
                careful += [BARE + first, *rest]
                many.append(1 + len(rest))
                is_easy.append(False)
            else:
                if not _ODD_STOP.search(text):
                    text = text.replace(", ", " \x01 ").replace(". ", " \x02 ").replace(",\n", " \x01\n").replace(".\n", " \x02\n")
                easy.append(BARE + text.replace("\n", " \x03 \x04"))
                many.append(1 + easy[-1].count(" "))
                is_easy.append(True)
        of_easy = np.repeat(np.array(is_easy, bool), many)
        flat, number = np.zeros(len(of_easy), np.int64), self.numbers.__getitem__
        if easy:
            words = pc.split_pattern(pa.array([" ".join(easy)], pa.large_string()), " ").flatten().dictionary_encode()
            distinct = list(map(number, words.dictionary.to_numpy(zero_copy_only=False)))
            flat[of_easy] = np.array(distinct, np.int64)[words.indices.to_numpy(zero_copy_only=False)]
        flat[~of_easy] = list(map(number, careful))
        return flat, np.concatenate([[0], np.cumsum(many, dtype=np.int64)])

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of ``words`` behind a space in a row, their numbers). ASCII letters are one word to the pre-tokeniser and stand for themselves in
        the byte-level alphabet, so the model takes them as they are."""
        tokenize = self.tokenizer.model.tokenize
        found = [[t.id for t in tokenize("\u0120" + w)] for w in words]
        length = np.array([len(ids) for ids in found], np.int64)
        return np.fromiter((i for ids in found for i in ids), np.uint32, int(length.sum())), length

    def _joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of ``texts`` in a row, their numbers). Each is a space and what follows it from a visible character on, so no token crosses from
        one to the next, and the tokens' bytes tell where each ends."""
        # The library's own objects are large, so it gets a thousand pieces at a time.
        runs = ("".join(texts[i : i + 1000]) for i in range(0, len(texts), 1000))
        flat = np.concatenate([np.zeros(0, np.uint32), *[self._ids(r) for r in runs]])
        ends, wanted = np.cumsum(self.bytes[flat]), np.cumsum([len(t.encode()) for t in texts])
        last = np.searchsorted(ends, wanted)
        if not np.array_equal(ends[last], wanted):
            raise ValueError("a token crosses a space before a visible character")
        return flat, np.diff(last, prepend=-1)

    def _parted(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of any texts without the special token's string, whose id parts their ids."""
        flat = self._ids(self.mark.join(texts) + self.mark)
        length = np.diff(np.flatnonzero(flat == self.mark_id), prepend=-1) - 1
        return flat[flat != self.mark_id], length

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self) -> None:
        new, self.numbers.new = self.numbers.new, []
        if not new:
            return
        known = len(self.numbers) - len(new)
        marks = {COMMA: ",", STOP: ".", BREAK: "\n"}
        # Plain words go to the model, other pieces behind a space are encoded in a row, those behind none between special tokens; one that
        # holds the special token's string is encoded alone.
        kinds: tuple[list[int], ...] = ([], [], [], [])
        texts = []
        for i, p in enumerate(new):
            text = p[1:] if p[:1] == BARE else marks.get(p) or " " + p
            texts.append(text)
            kinds[0 if p.isascii() and p.isalpha() else 3 if self.mark in text else 2 if p[:1] == BARE or p in marks else 1].append(i)
        found = [self._words([new[i] for i in kinds[0]])] if kinds[0] else []
        found += [self._joined([texts[i] for i in kinds[1]])] if kinds[1] else []
        found += [self._parted([texts[i] for i in kinds[2][at : at + 4000]]) for at in range(0, len(kinds[2]), 4000)]
        self.tokenizer.encode_special_tokens = self.plain
        own = [np.asarray(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32) for i in kinds[3]]
        self.tokenizer.encode_special_tokens = False
        found += [(ids, np.array([len(ids)])) for ids in own]
        length, order = np.concatenate([n for _, n in found]), np.argsort(np.concatenate([np.array(k, np.int64) for k in kinds]))
        begin = np.cumsum(length) - length
        flat, ends = _gathered(np.concatenate([ids for ids, _ in found]), begin[order], length[order])
        ends = self.starts[known] + ends
        if len(self.numbers) >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(max(len(self.starts), len(new) + 1), np.int64)])
        self.starts[known + 1 : known + 1 + len(new)] = ends
        if ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), int(ends[-1])), np.uint32)])
        self.ids[self.starts[known] : ends[-1]] = flat

    def encode(self, texts: Sequence[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of the texts in them); ``end`` is put behind every text."""
        if len(self.numbers) > self.limit:
            self._shrink()
        number, ends = self._pieces(texts)
        self._learn()
        uses = np.bincount(number, minlength=len(self.numbers))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        begin = self.starts[number]
        ids, ended = _gathered(self.ids, begin, self.starts[number + 1] - begin)
        total = np.concatenate([[0], ended])
        offsets = total[ends]
        if end is None:
            return ids, offsets
        ids = np.insert(ids, offsets[1:], np.uint32(end))
        return ids, offsets + np.arange(len(offsets))


def encoder(path: str, plain: bool = False) -> Encoder:
    """One encoder per worker, as long as no other operator needs the room."""
    return worker.resident(("encoder", path, plain), lambda: Encoder(path, plain=plain))


def slices(texts: pa.Array, size: int = 1 << 21) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in pieces of about ``size`` bytes, so that no step holds a whole batch of long texts; null is empty."""
    texts = texts.cast(pa.large_string())
    first = 0
    while first < len(texts):
        ends = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in texts.slice(first, 4096)])
        many = max(1, int(np.searchsorted(ends, size, side="right")))
        yield first, [t or "" for t in texts.slice(first, many).to_pylist()]
        first += many


def checksum(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())

"""Sets of hashed word shingles of whole texts, computed for many texts at once."""

from __future__ import annotations

import hashlib

import numpy as np

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            row = np.full(size, base)
            row[0] = 1
            _POWERS[name] = np.cumprod(row)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(texts: list[str], fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts, offsets of the texts in them); words are runs of non-space characters, A-Z lower-cased."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    start, stop = edge[0::2], edge[1::2]
    up, down = _powers(len(data))
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(((_FOLD[data] if fold else data).astype(np.uint64) + np.uint64(1)) * up)])
        hashes = mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))
    return hashes, np.concatenate([[0], np.searchsorted(start, ends)])


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: ``size`` words in a row; with fewer words all of them as one; without any, none."""
    words, offsets = word_hashes(texts)
    with np.errstate(over="ignore"):
        n = max(0, len(words) - size + 1)
        rolled = np.zeros(n, np.uint64)
        for k in range(size):
            rolled = mix(rolled + words[k : k + n] + np.uint64(k + 1))
        out = []
        for a, b in zip(offsets[:-1], offsets[1:]):
            if b - a >= size:
                out.append(np.unique(rolled[a : b - size + 1]))
            elif b > a:
                one = np.uint64(0)
                for k in range(b - a):
                    one = mix(np.array([one + words[a + k] + np.uint64(k + 1)]))[0]
                out.append(mix(np.array([one + np.uint64(size + b - a)])))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(values: np.ndarray) -> bytes:
    """128 bits of a set."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()

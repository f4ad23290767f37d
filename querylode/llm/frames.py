"""Patched frame-of-reference coding of integers below 2**32.

A block holds ``BLOCK`` values: their minimum, the differences packed at the width that a percentile of them needs, and a list of
exceptions (position, difference) for the wider ones. The start of every block is indexed, so that any range can be read alone.

    header   magic 4 bytes, values u32, blocks u32, then the start of every block u32
    block    minimum u32, width u8, exceptions u16, packed differences, exception positions u16, exception differences u32
"""

from __future__ import annotations

import numpy as np

MAGIC = b"PFB1"
BLOCK = 256
HEAD = 7


def _bits(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1]  # 0 for 0


def encode(values: np.ndarray, percentile: float = 0.9) -> bytes:
    n = len(values)
    blocks = -(-n // BLOCK)
    if not n:
        return MAGIC + np.array([0, 0], "<u4").tobytes()
    padded = np.full(blocks * BLOCK, values[-1], np.uint32)
    padded[:n] = values
    grid = padded.reshape(blocks, BLOCK)
    least = grid.min(axis=1)
    diff = grid - least[:, None]
    need = _bits(diff)
    place = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = np.partition(need, place, axis=1)[:, place].astype(np.int64)
    at_block, at = np.nonzero(need > width[:, None])
    n_exc = np.bincount(at_block, minlength=blocks)
    packed = BLOCK // 8 * width
    size = HEAD + packed + 6 * n_exc
    head = len(MAGIC) + 8 + 4 * blocks
    start = head + np.concatenate([[0], np.cumsum(size)[:-1]])
    out = np.zeros(head + int(size.sum()), np.uint8)
    out[:head] = np.frombuffer(MAGIC + np.array([n, blocks], "<u4").tobytes() + start.astype("<u4").tobytes(), np.uint8)

    def put(where: np.ndarray, what: np.ndarray, kind: str) -> None:
        raw = np.ascontiguousarray(what.astype(kind)).view(np.uint8).reshape(len(what), -1)
        out[where[:, None] + np.arange(raw.shape[1])] = raw

    put(start, least, "<u4")
    out[start + 4] = width
    put(start + 5, n_exc, "<u2")
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        kind = "<u2" if w <= 16 else "<u4"  # exceptions lose their high bits here; the list has them whole
        raw = np.ascontiguousarray(diff[rows].astype(kind)).view(np.uint8).reshape(len(rows), BLOCK, -1)
        flags = np.unpackbits(raw, axis=2, bitorder="little")[:, :, :w]
        put(start[rows] + HEAD, np.packbits(flags.reshape(len(rows), -1), axis=1, bitorder="little"), "u1")
    if len(at):
        rank = np.arange(len(at)) - np.concatenate([[0], np.cumsum(n_exc)[:-1]])[at_block]
        lists = start[at_block] + HEAD + packed[at_block]
        put(lists + 2 * rank, at, "<u2")
        put(lists + 2 * n_exc[at_block] + 4 * rank, diff[at_block, at], "<u4")
    return out.tobytes()


def count(data: bytes) -> int:
    return int(np.frombuffer(data, "<u4", 1, 4)[0])


def decode(data: bytes, first: int = 0, stop: int | None = None) -> np.ndarray:
    """The values from ``first`` up to ``stop``; reads only their blocks."""
    if data[:4] != MAGIC:
        raise ValueError("not a block of packed integers")
    n, blocks = (int(x) for x in np.frombuffer(data, "<u4", 2, 4))
    stop = n if stop is None else min(stop, n)
    if first >= stop:
        return np.zeros(0, np.uint32)
    low, high = first // BLOCK, -(-stop // BLOCK)
    raw = np.frombuffer(data, np.uint8)
    start = np.frombuffer(data, "<u4", blocks, 12)[low:high].astype(np.int64)

    def take(where: np.ndarray, kind: str) -> np.ndarray:
        width = np.dtype(kind).itemsize
        return np.ascontiguousarray(raw[where[:, None] + np.arange(width)]).view(kind)[:, 0].astype(np.int64)

    least, width, n_exc = take(start, "<u4"), raw[start + 4].astype(np.int64), take(start + 5, "<u2")
    out = np.zeros((high - low, BLOCK), np.int64)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        packed = np.zeros((len(rows), BLOCK // 8 * w + 8), np.uint8)  # a value is read with the bytes behind it
        packed[:, :-8] = raw[(start[rows] + HEAD)[:, None] + np.arange(BLOCK // 8 * w)]
        at = np.arange(8) * w  # eight values fill w bytes, so each of the eight stands at the same bit in all groups of them
        for i, (byte, bit) in enumerate(zip(at // 8, at % 8)):
            column = np.zeros((len(rows), BLOCK // 8), np.uint64)
            for more in range((bit + w + 7) // 8):
                column |= packed[:, byte + more : byte + more + BLOCK // 8 * w : w].astype(np.uint64) << np.uint64(8 * more)
            out[rows, i::8] = (column >> np.uint64(bit)) & np.uint64((1 << int(w)) - 1)
    if n_exc.any():
        of = np.repeat(np.arange(high - low), n_exc)
        rank = np.arange(len(of)) - np.repeat(np.cumsum(n_exc) - n_exc, n_exc)
        lists = start[of] + HEAD + BLOCK // 8 * width[of]
        out[of, take(lists + 2 * rank, "<u2")] = take(lists + 2 * n_exc[of] + 4 * rank, "<u4")
    return (out + least[:, None]).reshape(-1)[first - low * BLOCK : stop - low * BLOCK].astype(np.uint32)

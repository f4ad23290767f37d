"""The binary Golay code of 23 bits: which codewords lie near a word.

Every word lies within three bits of exactly one codeword. Its keys are that codeword alone if it is within two bits, else it and the
five codewords at four bits. Two words that differ in at most two bits always have a key in common: at two bits and less from its
codeword, a word cannot leave the other's keys; two words at three bits each lie, with a parity bit, at four bits from six codewords
whose difference patterns part the 24 places into six fours, and two flips in different fours leave both at four bits from one of them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, CHECK_BITS = 23, 11
#: Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, the code's generator.
GENERATOR = 0b110001110101
KEYS = 6


def _remainder(words: np.ndarray) -> np.ndarray:
    words = words.copy()
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - CHECK_BITS), 0)
    return words


#: Remainders of the upper twelve bits; the lower eleven are their own.
_UPPER = _remainder(np.arange(1 << (LENGTH - CHECK_BITS), dtype=np.int64) << CHECK_BITS)


def syndromes(words: np.ndarray) -> np.ndarray:
    return _UPPER[words >> CHECK_BITS] ^ words & (1 << CHECK_BITS) - 1


def _patterns() -> tuple[np.ndarray, np.ndarray]:
    """(patterns that lead from a word of each remainder to its keys, how many there are)."""
    table, count = np.zeros((1 << CHECK_BITS, KEYS), np.int64), np.zeros(1 << CHECK_BITS, np.int64)
    light = np.zeros(1 << CHECK_BITS, np.int64)
    for weight in range(5):
        errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(LENGTH), weight)], np.int64)
        for error, at in zip(errors.tolist(), syndromes(errors).tolist()):
            if weight <= 3:
                light[at] = weight
            if weight <= 3 or light[at] == 3:
                table[at, count[at]] = error
                count[at] += 1
    return table, count


PATTERNS, COUNT = _patterns()


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, index of a near codeword, 12 bits) for all keys of all ``words``."""
    at = syndromes(words)
    near = (words[:, None] ^ PATTERNS[at]) >> CHECK_BITS
    used = np.arange(KEYS) < COUNT[at][:, None]
    return np.nonzero(used)[0], near[used]

"""Hashes of words and character grams of whole texts, as numpy arrays, inside tasks.

All work on code points and take a text in pieces of at most PIECE characters, so that
their memory does not grow with the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


@cache
def _table(test: str) -> np.ndarray:
    """For each code point whether the ``str`` method ``test`` holds for it."""
    method = getattr(str, test)
    return np.fromiter((method(chr(i)) for i in range(0x110000)), dtype=bool, count=0x110000)


@cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of _BASE and of its inverse modulo 2^64."""

    def up_from(base: int) -> np.ndarray:
        steps = np.full(PIECE + 1, np.uint64(base))
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return up_from(_BASE), up_from(pow(_BASE, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scattered over all 64 bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pieces(text: str) -> Iterator[str]:
    """``text`` in pieces of PIECE characters, wherever they end."""
    for start in range(0, len(text) or 1, PIECE):
        yield text[start : start + PIECE]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def words(text: str, part: str = "isspace", inside: bool = False) -> np.ndarray:
    """A 64-bit hash of each word of the lower-cased text, in order.

    Words are the runs of characters for which the ``str`` method ``part`` holds
    (``inside``) or does not hold.
    """
    found = []
    open_value, open_size = np.zeros(1, dtype=np.uint64), 0  # of a word that goes on
    for piece in _pieces(text.lower()):
        code = points(piece)
        if not code.size:
            continue
        word = _table(part)[code]
        if not inside:
            word = ~word
        edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0, append=0))
        start, end = edge[0::2], edge[1::2]
        power, inverse = powers()
        total = np.zeros(code.size + 1, dtype=np.uint64)
        np.cumsum((code + np.uint64(1)) * power[: code.size], out=total[1:])
        value = (total[end] - total[start]) * inverse[start]
        size = (end - start).astype(np.uint64)
        if open_size and start.size and start[0] == 0:
            value[:1] = open_value + value[:1] * np.uint64(pow(_BASE, open_size, 1 << 64))
            size[:1] += np.uint64(open_size)
        elif open_size:
            found.append(mixed(open_value + np.uint64(open_size)))
        open_size = 0
        if end.size and end[-1] == code.size:
            open_value, open_size = value[-1:], int(size[-1])
            value, size = value[:-1], size[:-1]
        found.append(mixed(value + size))
    if open_size:
        found.append(mixed(open_value + np.uint64(open_size)))
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def shingles(text: str, width: int = 5) -> np.ndarray:
    """The set of runs of ``width`` words as sorted hashes; one run if the words are fewer."""
    word = words(text)
    if not word.size:
        return word
    width = min(width, word.size)
    total = np.zeros(word.size - width + 1, dtype=np.uint64)
    for i in range(width):
        total += word[i : i + total.size] * np.uint64(pow(_BASE, 2 * i + 3, 1 << 64))
    return np.unique(mixed(total + np.uint64(width)))


def letter_grams(text: str, buckets_log2: int) -> np.ndarray:
    """Counts of runs of one to three letters of the lower-cased text, by hash bucket.

    What lies between letters counts as one blank, which takes part in runs of two and
    three.
    """
    counts = np.zeros(1 << buckets_log2, dtype=np.int64)
    shift = np.uint32(32 - buckets_log2)
    # the two codes before a piece, as far back as runs reach; texts begin with a blank
    before, pieces, letters = np.zeros(1, dtype=np.uint32), list(_pieces(text.lower())), False
    for n, piece in enumerate(pieces):
        code = points(piece)
        letter = _table("isalpha")[code]
        letters |= bool(letter.any())
        code = np.where(letter, code, np.uint32(0))
        # the first blank after a letter stands for all of them
        after = np.concatenate([before[-1:] > 0, letter])[: letter.size]
        end = np.zeros(int(n + 1 == len(pieces)), dtype=np.uint32)  # and end with one
        code = np.concatenate([before, code[letter | after], end]).astype(np.uint32)
        known = before.size  # of these only the runs into the new codes are counted
        before = code[-2:]
        if not letters:
            continue
        a, b = code * np.uint32(0x85EBCA6B), code * np.uint32(0xC2B2AE35)
        one = (a ^ np.uint32(0x5BD1E995))[known:][code[known:] > 0]
        two = a[:-1] + b[1:]
        three = two[:-1] * np.uint32(0x01000193) + code[2:]
        for gram in (one, two[known - 1 :], three[max(0, known - 2) :]):
            mixed_gram = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x9E3779B1)
            counts += np.bincount(mixed_gram >> shift, minlength=counts.size)
    return counts

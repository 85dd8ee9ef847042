"""Vectorised word and n-gram arithmetic on one text at a time (numpy).

A word's hash is a polynomial over its code points modulo 2**64, finished by a
mixing step; all words of a text are hashed by a handful of array operations,
without a dictionary, so memory follows the text and not the vocabulary.
"""

from __future__ import annotations

import functools

import numpy as np

_U = np.uint64
GOLDEN = _U(0x9E3779B97F4A7C15)
_BASE = _U(0x9DDFEA08EB382D69)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, b, dtype=np.uint64)])) for b in (_BASE, _INVERSE))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the hash's base and of its inverse modulo 2**64."""
    size = 1 << 17
    return _powers(size) if n <= size else _powers.__wrapped__(n)


def mix_short(x: np.ndarray) -> np.ndarray:
    """One multiplication between two shifts: enough for numbers that are hashes already."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(29))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def word_starts(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin, and which code points belong to words (all but U+0020 and U+0009-U+000D)."""
    inside = (points != 32) & ((points < 9) | (points > 13))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    return np.flatnonzero(begins), inside


def hash_words(values: np.ndarray, kept: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of each word: a polynomial over the ``values`` of its ``kept`` places,
    taken from one running sum over the whole text."""
    if not len(starts):
        return np.empty(0, np.uint64)
    at = np.flatnonzero(kept)
    first = np.searchsorted(at, starts)
    up, down = powers(len(at) + 1)
    total = np.zeros(len(at) + 1, np.uint64)
    np.cumsum((values[at].astype(np.uint64) + _U(1)) * up[:len(at)], out=total[1:])
    return mix64((total[np.append(first[1:], len(at))] - total[first]) * down[first])


def raw_word_hashes(points: np.ndarray) -> np.ndarray:
    starts, inside = word_starts(points)
    return hash_words(points, inside, starts)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words (of all words, if there are fewer)."""
    if not len(words):
        return words
    m = max(1, len(words) - n + 1)
    h = words[:m] + GOLDEN
    for k in range(1, min(n, len(words))):
        h = (h ^ (h >> _U(29))) * _BASE + words[k: m + k]
    return mix64(h)


def repeated_window_words(words: np.ndarray, n: int = 5) -> int:
    """Words that lie in an ``n``-word window found twice or more (word hashes given)."""
    if len(words) <= n:
        return 0
    codes = window_hashes(words, n)
    order = np.argsort(codes, kind="stable")
    s = codes[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(codes), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[at] += 1
    edge[at + n] -= 1
    return int((np.cumsum(edge)[:-1] > 0).sum())


def char_gram_slots(points: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hash slot (``bits`` wide) of every run of ``n`` code points."""
    m = len(points) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint32)
    h = points[:m] * np.uint32(0x85EBCA6B)
    for k in range(1, n):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + points[k: m + k] * np.uint32(0x297A2D39)
    h ^= h >> np.uint32(13)
    return (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)


def slots64(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> _U(64 - bits)).astype(np.uint32)


class Letters:
    """Look-up tables over the basic plane: lower case, letter, capital, digit."""

    def __init__(self, lookalikes: dict[str, str]):
        chars = [chr(i) if not 0xD800 <= i < 0xE000 else " " for i in range(0x10000)]
        self.lower = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in chars], dtype=np.uint32)
        self.letter = np.array([c.isalpha() for c in chars])
        self.capital = np.array([c.isupper() for c in chars]) & self.letter
        self.digit = np.array([c.isdecimal() for c in chars])
        self.symbol = np.zeros(0x10000, dtype=bool)
        for a, b in lookalikes.items():
            self.lower[ord(a)] = ord(b)
            self.symbol[ord(a)] = not a.isdecimal()

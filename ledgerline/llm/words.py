"""Words and word shingles of many texts at once, on whole Arrow columns.

Words are runs of bytes other than ASCII white space (0x20, 0x09 to 0x0D); A to Z
are lowered, every other byte stays as it is. Words and shingles are known by
64-bit hashes; an operator that must be exact compares the words themselves.
"""

from __future__ import annotations

import re

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_CODE = np.frombuffer(_LOWER, np.uint8).astype(np.uint64) + np.uint64(1)
_CODE[_SPACE] = 0
_RAW = np.arange(1, 257, dtype=np.uint64)
_RAW[_SPACE] = 0
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def word_list(text: bytes) -> list[bytes]:
    return WORD.findall(text.translate(_LOWER))


def shingle_set(text: bytes, n: int) -> set[tuple[bytes, ...]]:
    """Distinct ``n``-word shingles; fewer words: the whole sequence as one; no word: empty."""
    w = word_list(text)
    if len(w) < n:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(n))))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = -(-n // (1 << 16)) << 16
        p, q = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        p[0] = q[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return have[0][:n], have[1][:n]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words start and end, and the index of each text's first word (n + 1 values)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    left, right = np.empty(n, bool), np.empty(n, bool)
    left[0] = right[-1] = True
    left[1:], right[:-1] = space[:-1], space[1:]
    left[offsets[:-1][offsets[:-1] < n]] = True
    right[offsets[1:][offsets[1:] > 0] - 1] = True
    starts, ends = np.flatnonzero(left & ~space), np.flatnonzero(right & ~space) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, lower: bool = True, base: int = _BASE) -> np.ndarray:
    """A 64-bit hash of each word (white space between words does not count)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    p, q = powers(len(data), base)
    sums = np.add.reduceat((_CODE if lower else _RAW)[data] * p, starts)
    return mix(sums * q[starts])


def shingles(words: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n``-word shingles, text after text, and each text's first (n + 1 values).

    A text of fewer words (but at least one) gives one hash of its whole sequence.
    """
    count = np.diff(firsts)
    out_n = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    out_first = np.concatenate([[0], np.cumsum(out_n)]).astype(np.int64)
    out = np.zeros(out_first[-1], np.uint64)
    factors = powers(n + 1, 0xD6E8FEB86659FD93)[0]
    total = len(words)
    if total >= n:
        rolled = np.zeros(total - n + 1, np.uint64)
        for i in range(n):
            rolled += words[i:total - n + 1 + i] * factors[i]
        full = np.flatnonzero(count >= n)
        index = np.arange(out_n[full].sum()) + np.repeat(
            firsts[full] - np.concatenate([[0], np.cumsum(out_n[full])[:-1]]).astype(np.int64), out_n[full]) \
            if len(full) else np.zeros(0, np.int64)
        target = np.repeat(count >= n, out_n)
        out[target] = rolled[index]
    for length in range(1, n):
        short = np.flatnonzero(count == length)
        own = words[firsts[short][:, None] + np.arange(length)]
        out[out_first[short]] = (own * factors[:length]).sum(1, dtype=np.uint64) + np.uint64(
            0x632BE59BD9B4E019 * length & 0xFFFFFFFFFFFFFFFF)
    return mix(out), out_first

"""Vectorized hashes of words and word shingles of one text."""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


@cache
def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, _ODD, dtype=np.uint64))


def tokens(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased (what bytes methods do to ASCII), as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def digest(words: list[bytes]) -> bytes:
    """First half of the SHA-256 of the words, which ``near_dedup.text_class`` makes natively."""
    return hashlib.sha256(b" ".join(words)).digest()[:16]


def word_hashes(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(b" ".join(words), np.uint8)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lens + 1)[:-1]))
    place = np.arange(len(raw), dtype=np.int64) - np.repeat(starts, lens + 1)[: len(raw)]
    # table sizes are powers of two, so few are cached
    powers = _powers(1 << int(max(lens) + 1).bit_length())
    part = (raw.astype(np.uint64) + np.uint64(1)) * powers[place]
    part[raw == 32] = 0
    return mix64(np.add.reduceat(part, starts) + lens.astype(np.uint64))


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle, none has none."""
    w = word_hashes(words)
    if not len(w):
        return w
    width = min(width, len(w))
    n = len(w) - width + 1
    h = np.full(n, np.uint64(width), np.uint64)
    for j in range(width):
        h = mix64(h * _ODD + w[j : j + n])
    return np.unique(h)


@cache
def _lines(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def minhash(values: np.ndarray, count: int, seed: int, chunk: int = 20_000) -> np.ndarray:
    """``count`` minima of the set under independent hash functions; chunks bound the memory."""
    a, b = _lines(count, seed)
    least = np.full(count, np.uint64(0xFFFFFFFFFFFFFFFF))
    for k in range(0, len(values), chunk):
        v = values[k : k + chunk]
        h = v[None, :] * a[:, None] + b[:, None]
        least = np.minimum(least, (h ^ (h >> np.uint64(32))).min(axis=1))
    return least

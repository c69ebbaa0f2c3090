"""Hashes of words and of word windows, vectorised over a batch of texts.

A text is UTF-8 bytes; its words are the runs `[^\\x20\\x09-\\x0D]+`.  Hashes are
polynomials modulo 2**64, finished by a mixing step; a window's hash is a difference of
prefix sums, so every rolling window of a batch costs one subtraction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U = np.uint64
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_BYTES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
_BASE = U(0x9E3779B97F4A7C15 | 5)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse for i below ``n`` at least."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, b in enumerate((int(_BASE), _inverse(int(_BASE)))):
            steps = np.full(size, b, U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x + U((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@dataclass
class Words:
    """Words of a batch of texts: ``first[i]:first[i + 1]`` are those of text i."""

    data: bytes
    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(texts: list[bytes]) -> Words:
    data = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(_IS_WORD[raw].view(np.int8), prepend=np.int8(0)))
    begin, end = edge[::2], edge[1::2]
    up, down = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, U)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=total[1:])
    h = mix((total[end] - total[begin]) * down[begin])
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    return Words(data, begin, end, h, np.searchsorted(begin, starts))


def windows(words: Words, size: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Start indexes (among all words of the batch) of the windows of ``size`` words that lie in one text, and their hashes."""
    n = len(words.hash)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, U)
    up, down = powers(n + 1)
    h = words.hash if not salt else mix(words.hash, salt)
    total = np.zeros(n + 1, U)
    np.cumsum(h * up[:n], out=total[1:])
    at = np.ones(n - size + 1, bool)
    for last in words.first[1:-1]:
        at[max(0, last - size + 1) : last] = False
    at = np.flatnonzero(at)
    return at, mix((total[at + size] - total[at]) * down[at], size + 1)


def chunks(texts: list[bytes], size: int = 1 << 20):
    """Runs of texts of about ``size`` bytes; a longer text is a run of its own."""
    begin = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield begin, texts[begin:i]
            begin, held = i, 0
        held += len(t) + 1
    if begin < len(texts):
        yield begin, texts[begin:]

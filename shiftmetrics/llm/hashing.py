"""Words and their 64-bit hashes for whole batches of texts, by numpy.

All texts of a batch are laid end to end in one byte array.  A word's hash is
a polynomial in its bytes modulo 2**64, read off a running sum, then mixed;
words longer than ``LONG_WORD`` bytes are hashed by blake2b instead, as
polynomials modulo powers of two have known collisions among long strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

LONG_WORD = 512
#: Bytes of text that are laid out at once (one longer text stands alone).
BATCH_BYTES = 500_000

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_NEXT_WORD = np.uint64(0xD6E8FEB86659FD93)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: A byte of a word: everything but space and \x09-\x0D.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: A byte of a word: digits, letters a-z (after lower-casing) and all beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = True
ALPHANUMERIC[0x61:0x7B] = True
ALPHANUMERIC[0x80:] = True

_powers = {"n": 0}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, BATCH_BYTES + 4096)
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers.update(n=size, tables=tables)
    return _powers["tables"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def batches(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, encoded texts) of runs of about BATCH_BYTES."""
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass")
        if run and size + len(b) > BATCH_BYTES:
            yield first, run
            first, run, size = i, [], 0
        run.append(b)
        size += len(b) + 1
    if run:
        yield first, run


def words_of(encoded: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, one after another, and each text's first word
    (one entry more than texts: ``bounds[i]:bounds[i + 1]`` are the words of text i)."""
    raw = np.frombuffer(b"\n".join([*encoded, b""]), np.uint8)
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(encoded) + 1, np.int64)
    power, inverse = _power_tables(n)
    low = _LOWER[raw]
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = table[low]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    hashes = (total[ends] - total[starts]) * inverse[starts]
    lengths = ends - starts
    for i in np.flatnonzero(lengths > LONG_WORD):
        word = low[starts[i]:ends[i]].tobytes()
        hashes[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    hashes = mix(hashes + lengths.astype(np.uint64) * np.uint64(_BASE))
    at = np.cumsum([0, *(len(b) + 1 for b in encoded)])
    return hashes, np.searchsorted(starts, at)


def runs_of(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` consecutive words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n].copy()
    for j in range(1, length):
        total = total * _NEXT_WORD + words[j:n + j]
    return mix(total + np.uint64(length))


def distinct_shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingles of one text; a text of fewer words is one shingle."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(runs_of(words, min(width, len(words))))

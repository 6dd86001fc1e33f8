"""Hashes of words and byte windows over whole texts, a few megabytes at a time.

Texts of a chunk lie one after another in one byte array, a space after each. A
prefix sum of random byte codes times powers of an odd base, taken modulo 2**64,
gives the hash of any stretch by one subtraction and one product, so neither words
nor windows are ever Python objects. Hashes depend on content only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np

U = np.uint64
CHUNK_BYTES = 2_000_000
_CODES = np.random.Generator(np.random.PCG64(20_240_601)).integers(
    1, 2**63, size=256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}

#: Separators of `[^\x20\x09-\x0D]+`.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of runs of letters and digits; bytes of longer characters count as letters.
MARKS = np.ones(256, dtype=bool)
MARKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values; a bijection."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _powers_of(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 4096), U(base), dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_CODES[data] * _powers_of(_BASE, len(data)), dtype=np.uint64, out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair."""
    inverse = _powers_of(_INVERSE, len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts]
               + (ends - starts).astype(np.uint64))


def chunks(rows: Iterator[tuple[Any, bytes | None]], limit: int = CHUNK_BYTES
           ) -> Iterator[tuple[list[Any], list[bytes]]]:
    """(keys, texts) with about `limit` bytes each; one longer text comes alone."""
    keys, texts, held = [], [], 0
    for key, text in rows:
        text = text or b""
        if texts and held + len(text) > limit:
            yield keys, texts
            keys, texts, held = [], [], 0
        keys.append(key)
        texts.append(text)
        held += len(text) + 1
    if texts:
        yield keys, texts


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One byte array, and where each text starts in it (one more entry for the end)."""
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8), offsets


def word_bounds(data: np.ndarray, separators: np.ndarray = SPACES
                ) -> tuple[np.ndarray, np.ndarray]:
    inside = np.concatenate(([False], ~separators[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(texts: list[bytes], separators: np.ndarray = SPACES, lower: bool = True
                ) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the chunk, and the index of each text's first word."""
    data, offsets = joined(texts)
    if lower:
        data = LOWER[data]
    starts, ends = word_bounds(data, separators)
    return (stretch_hashes(prefix_hashes(data), starts, ends),
            np.searchsorted(starts, offsets))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of `size` words in a row; fewer words count as one shingle."""
    if not len(words):
        return words
    size = min(size, len(words))
    found = np.full(len(words) - size + 1, U(size), dtype=np.uint64)
    for i in range(size):
        found = mix(found + words[i:len(words) - size + 1 + i])
    return np.unique(found)

"""Sets of hashed word shingles of whole texts, in numpy over the bytes of many texts at once.

Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased. A word's hash is a polynomial over random
64-bit numbers for its bytes, read off prefix sums; a shingle's mixes the hashes of its words in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20
_RNG = np.random.default_rng(60_006)
BYTES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1 << 63)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
PLACES = _RNG.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits each depend on all input bits (splitmix64's finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of a number modulo 2 ** 64, as many as were ever asked for."""

    def __init__(self, base: int):
        self.base, self.known = np.uint64(base), np.ones(1, np.uint64)

    def first(self, n: int) -> np.ndarray:
        if n > len(self.known):
            steps = np.full(max(n, CHUNK * 2), self.base)
            steps[0] = 1
            self.known = np.cumprod(steps)
        return self.known[:n]


_UP, _DOWN = _Powers(BASE), _Powers(INVERSE)


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of raw, which ends with white space."""
    b = np.frombuffer(raw, np.uint8)
    space = SPACE[b]
    before = np.concatenate([[True], space[:-1]])
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTES[LOWER[b]] * _UP.first(len(b)))])
    hashes = (sums[ends] - sums[starts]) * _DOWN.first(len(b))[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * PLACES[15]), starts


def _chunk_sets(raws: list[bytes], words: int) -> Iterator[np.ndarray]:
    hashes, starts = _word_hashes(b" ".join(raws) + b" ")
    edges = np.cumsum([0] + [len(r) + 1 for r in raws])
    first = np.searchsorted(starts, edges)
    n = len(hashes) - words + 1
    total = np.zeros(max(n, 0), np.uint64)
    for k in range(words):
        total += hashes[k : k + max(n, 0)] * PLACES[k]
    grams = mix(total)
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= words:
            yield np.unique(grams[lo : hi - words + 1])
        elif hi > lo:  # the whole sequence as one, marked by its length
            yield mix((hashes[lo:hi] * PLACES[: hi - lo]).sum(keepdims=True) + PLACES[8 + hi - lo])
        else:
            yield np.empty(0, np.uint64)


def shingle_sets(texts: list[str | None], words: int = 3) -> Iterator[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes. Of fewer words than a shingle has, the sequence is
    the one shingle; a text that is null or without words has none."""
    held, size = [], 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass") if text else b""
        held.append(raw)
        size += len(raw)
        if size >= CHUNK:
            yield from _chunk_sets(held, words)
            held, size = [], 0
    if held:
        yield from _chunk_sets(held, words)

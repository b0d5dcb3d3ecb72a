"""Hashes of the words and shingles of many texts at once, in numpy.

A word is a run of bytes other than the six ASCII white-space characters, with
A-Z folded. Its 64-bit hash is a polynomial over its bytes, taken from prefix
sums over a whole block of text, and then mixed. Equal words have equal hashes;
unequal ones share one with a chance of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

# Bytes hashed at a time; an array of 8 bytes per byte of a block is held a few times.
BLOCK = 1 << 20
SHINGLE = 5

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_FACTORS = [_U(xxhash.xxh3_64_intdigest(b"factor%d" % i) | 1) for i in range(SHINGLE)]
_PART_OF_SHORT = _U(xxhash.xxh3_64_intdigest(b"short") | 1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on all bits."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(29))
    h = h * _U(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> _U(32))


class WordHasher:
    """Hashes words; keeps the powers of its base between blocks."""

    def __init__(self):
        fold = np.arange(256, dtype=np.uint8)
        fold[65:91] += 32
        values = np.array([xxhash.xxh3_64_intdigest(b"byte%d" % b) for b in range(256)], dtype=_U)
        self.values = values[fold]
        self.blank = np.zeros(256, dtype=bool)
        self.blank[[9, 10, 11, 12, 13, 32]] = True
        self.powers = self.inverses = np.ones(1, dtype=_U)

    def _grown(self, n: int) -> None:
        while len(self.powers) < n:
            top = _U(pow(_BASE, len(self.powers), 1 << 64))
            low = _U(pow(_INVERSE, len(self.inverses), 1 << 64))
            self.powers = np.concatenate([self.powers, self.powers * top])
            self.inverses = np.concatenate([self.inverses, self.inverses * low])

    def _block(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(data, dtype=np.uint8)
        dark = np.empty(len(raw) + 2, dtype=bool)
        dark[0] = dark[-1] = False
        np.logical_not(self.blank[raw], out=dark[1:-1])
        edges = np.flatnonzero(dark[1:] != dark[:-1])
        starts, ends = edges[0::2], edges[1::2]
        self._grown(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, dtype=_U)
        np.cumsum(self.values[raw] * self.powers[: len(raw)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * self.inverses[starts]
        return mixed(h + (ends - starts).astype(_U) * _U(_BASE)), starts

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of a text and where they start, block by block of whole words."""
        if len(data) <= BLOCK:
            return self._block(data)
        hashes, starts, at = [], [], 0
        while at < len(data):
            end = min(len(data), at + BLOCK)
            while end < len(data) and not self.blank[data[end]]:
                end += 1
            h, s = self._block(data[at:end])
            hashes.append(h)
            starts.append(s + at)
            at = end
        return np.concatenate(hashes), np.concatenate(starts)

    def texts(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        """The word hashes of each text, null as empty; short texts share a block."""
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end] or b"") < BLOCK):
                size += len(texts[end] or b"") + 1
                end += 1
            group = [t or b"" for t in texts[at:end]]
            hashes, starts = self.words(b" ".join(group))
            cuts = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in group]))
            for i in range(len(group)):
                yield hashes[cuts[i]:cuts[i + 1]]
            at = end


def shingles(words: np.ndarray) -> np.ndarray:
    """The distinct shingles of a text, ascending; of fewer words than a shingle, all as one."""
    n = len(words)
    if n == 0:
        return words
    if n < SHINGLE:
        whole = n * int(_PART_OF_SHORT) + sum(int(w) * int(f) for w, f in zip(words, _FACTORS))
        return mixed(np.array([whole % (1 << 64)], dtype=_U))
    h = words[: n - SHINGLE + 1] * _FACTORS[0]
    for k in range(1, SHINGLE):
        h = h + words[k : n - SHINGLE + 1 + k] * _FACTORS[k]
    return np.unique(mixed(h))


def fingerprint(found: np.ndarray) -> int:
    """A signed 64-bit name of a set given as a sorted array."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)

"""Words and word shingles of many texts as 64-bit hashes, computed on whole Arrow columns."""

from __future__ import annotations

import re

import numpy as np

WIDTH = 5
BLOCK_BYTES = 1 << 20

_SEPARATOR = re.compile(rb"[\x20\x09-\x0D]")
_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACES = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(WIDTH)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse, as many as the longest block has needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES)
            self.up, self.down = (
                np.cumprod(np.r_[np.uint64(1), np.full(size, base, np.uint64)])
                for base in (_BASE, _INVERSE)
            )
        return self.up[:n], self.down[:n]


powers = Powers()


def _hash_block(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of a block that begins and ends between words."""
    inside = ~_IS_SEPARATOR[data]
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return starts, mix((total[ends] - total[starts]) * down[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of texts, A-Z lower-cased.

    ``data`` has the bytes of all texts, each ending in a separator; ``offsets`` where each
    starts. Returns the hashes in order and where the words of each text start.
    """
    whole, begin = memoryview(data), 0
    starts, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    while begin < len(data):
        end = min(begin + BLOCK_BYTES, len(data))
        cut = _SEPARATOR.search(whole, end) if end < len(data) else None
        end = cut.start() if cut else len(data)
        at, hashed = _hash_block(data[begin:end])
        starts.append(at + begin)
        hashes.append(hashed)
        begin = end
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, mask: int = (1 << 64) - 1
) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``width`` are one.

    Only the bits of ``mask`` are kept, and hashes that then are equal are one.
    """
    words, first = word_hashes(data, offsets)
    counts = np.diff(first)
    if len(words) >= width:
        rolled = np.zeros(len(words) - width + 1, np.uint64)
        for i in range(width):
            rolled += words[i : len(words) - width + 1 + i] * _PLACES[i]
        rolled = mix(rolled) & np.uint64(mask)
    sets = []
    for begin, n in zip(first[:-1].tolist(), counts.tolist(), strict=True):
        if n >= width:
            sets.append(np.unique(rolled[begin : begin + n - width + 1]))
        else:
            short = (words[begin : begin + n] * _PLACES[:n]).sum(dtype=np.uint64, keepdims=True)
            sets.append((mix(short + np.uint64(n)) & np.uint64(mask))[: min(n, 1)])
    return sets

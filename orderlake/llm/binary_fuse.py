"""Binary fuse filters: static sets of 64-bit keys at about nine bits per key.

Three hashed slots of a key lie in three neighbouring segments, and the XOR of
their fingerprints is the fingerprint of the key. A filter never misses a key
it was built from; it accepts one in 256 others.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

U = np.uint64
MOST_SEEDS = 100


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit values that depends on ``seed``."""
    with np.errstate(over="ignore"):
        h = keys.astype(U) + U((seed * 0x9E3779B97F4A7C15) % 2**64)
        h ^= h >> U(33)
        h *= U(0xFF51AFD7ED558CCD)
        h ^= h >> U(33)
        h *= U(0xC4CEB9FE1A85EC53)
        return h ^ (h >> U(33))


@dataclass(frozen=True)
class BinaryFuse:
    seed: int
    segment: int
    segments: int
    prints: np.ndarray

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        span, mask = self.segments * self.segment, U(self.segment - 1)
        first = ((hashes >> U(32)) * U(span)) >> U(32)
        second = (first + U(self.segment)) ^ ((hashes >> U(18)) & mask)
        third = (first + U(2 * self.segment)) ^ (hashes & mask)
        return np.stack([first, second, third]).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        hashes = mixed(keys, self.seed)
        a, b, c = self.prints[self._slots(hashes)]
        return (a ^ b ^ c) == _print(hashes)


def _print(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> U(32))) & U(255)).astype(np.uint8)


def _peeled(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Layers of (keys, slot that only this key of those left uses); None when stuck."""
    keys = np.arange(slots.shape[1])
    count = np.bincount(slots.ravel(), minlength=size)
    total = np.bincount(slots.ravel(), np.tile(keys, 3).astype(float), size).astype(np.int64)
    layers, left = [], len(keys)
    alone = np.flatnonzero(count == 1)
    while len(alone):
        found, at = np.unique(total[alone], return_index=True)
        layers.append((found, alone[at]))
        touched = slots[:, found]
        np.subtract.at(count, touched.ravel(), 1)
        np.subtract.at(total, touched.ravel(), np.tile(found, 3))
        left -= len(found)
        near = np.unique(touched)
        alone = near[count[near] == 1]
    return None if left else layers


def build(keys: np.ndarray) -> BinaryFuse:
    """The filter of distinct 64-bit ``keys``; none gives a filter that accepts few."""
    n = max(len(keys), 1)
    segment = 1 << min(18, max(2, int(math.log(n) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, math.ceil(n * factor / segment) - 2)
    for seed in range(MOST_SEEDS):
        empty = BinaryFuse(seed, segment, segments, np.zeros((segments + 2) * segment, np.uint8))
        hashes = mixed(keys, seed)
        slots = empty._slots(hashes)
        layers = _peeled(slots, len(empty.prints))
        if layers is None:
            continue
        wanted = _print(hashes)
        for found, at in reversed(layers):
            a, b, c = empty.prints[slots[:, found]]
            empty.prints[at] = wanted[found] ^ a ^ b ^ c ^ empty.prints[at]
        return empty
    raise ValueError(f"no filter after {MOST_SEEDS} seeds; the keys must be distinct")

"""Words and shingle sets of Arrow text columns, a few megabytes of text at a time.

Hashes are 64 bits wide and mixed after every eight bytes, so two different shingles of a pair of documents are
taken for equal with a probability of about 2**-64 per comparison, whatever letters they are made of.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from orderlake.llm.binary_fuse import mixed
from orderlake.llm.common import SPACES

U = np.uint64
SHINGLE = 5
# Bytes of text worked on at once; a longer text is worked on alone.
PIECE_BYTES = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.isin(np.arange(256), [ord(c) for c in SPACES])
_RANDOM = np.random.default_rng(5)
_COEFFICIENTS = _RANDOM.integers(1, 2**63, SHINGLE, dtype=np.uint64) | U(1)
# Longer words are hashed one by one.
LONG_WORD = 512
# Masks that leave the first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(9)], U)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending. Sorting is much faster here than hashing, which ``unique`` does."""
    ordered = np.sort(values)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(values) else ordered


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column without NULLs, without a copy."""
    column = column.cast(pa.large_string()) if pa.types.is_string(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data, offsets


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` bytes together, or of one longer row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


@dataclass(frozen=True)
class Words:
    """Hashes of the lower-cased words of some rows; ``counts`` has the words of each row."""

    hashes: np.ndarray
    counts: np.ndarray


def word_spans(data: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word; no word spans two rows."""
    inside = ~_IS_SPACE[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[row_starts] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | fresh[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | fresh[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def hashed_spans(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes: its length, then eight bytes of all spans at a time, each mixed in."""
    lengths = ends - begins
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # The eight bytes that begin at each place.
    eights = np.ndarray(len(data) + 1, np.dtype("<u8"), padded, strides=(1,))
    # The first eight bytes of all spans, of which most have no more.
    hashes = mixed(mixed(lengths.astype(U), 1) ^ eights[begins] & _FIRST[np.minimum(lengths, 8)], 2)
    left, at = np.flatnonzero((lengths > 8) & (lengths <= LONG_WORD)), 8
    while len(left):
        rest = lengths[left] - at
        part = eights[begins[left] + at] & _FIRST[np.minimum(rest, 8)]
        hashes[left] = mixed(hashes[left] ^ part, 2)
        at += 8
        left = left[rest > 8]
    for k in np.flatnonzero(lengths > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[begins[k] : ends[k]].tobytes(), digest_size=8).digest()
        hashes[k] = int.from_bytes(digest, "little")
    return hashes


def same_spans(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, others: np.ndarray) -> bool:
    """Whether each span has the bytes of the span numbered in ``others``, eight bytes of all spans at a time."""
    lengths = ends - begins
    if not np.array_equal(lengths, lengths[others]):
        return False
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, np.dtype("<u8"), padded, strides=(1,))
    start = eights[begins] & _FIRST[np.minimum(lengths, 8)]
    if not np.array_equal(start, start[others]):
        return False
    left, at = np.flatnonzero((lengths > 8) & (lengths <= LONG_WORD) & (others != np.arange(len(others)))), 8
    while len(left):
        rest = lengths[left] - at
        apart = eights[begins[left] + at] ^ eights[begins[others[left]] + at]
        if (apart & _FIRST[np.minimum(rest, 8)]).any():
            return False
        at += 8
        left = left[rest > 8]
    for k in np.flatnonzero(lengths > LONG_WORD).tolist():
        other = others[k]
        if not np.array_equal(data[begins[k] : ends[k]], data[begins[other] : ends[other]]):
            return False
    return True


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    data = _LOWER[data[offsets[0] : offsets[-1]]]
    starts = offsets - offsets[0]
    begins, ends = word_spans(data, starts)
    counts = np.diff(np.searchsorted(begins, starts))
    return Words(hashed_spans(data, begins, ends), counts)


def shingle_sets(words: Words) -> list[np.ndarray]:
    """The distinct shingle hashes of each row, ascending."""
    hashes, made = words.hashes, []
    n = len(hashes) - SHINGLE + 1
    with np.errstate(over="ignore"):
        total = np.zeros(max(n, 0), U)
        for k in range(SHINGLE if n > 0 else 0):
            total += hashes[k : k + n] * _COEFFICIENTS[k]
        total = mixed(total, 2)
        at = 0
        for count in words.counts.tolist():
            if count >= SHINGLE:
                made.append(distinct(total[at : at + count - SHINGLE + 1]))
            elif count:
                few = (hashes[at : at + count] * _COEFFICIENTS[:count]).sum(dtype=U)
                made.append(mixed(np.array([few + U(count)]), 3))
            else:
                made.append(np.zeros(0, U))
            at += count
    return made


def sets_of(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """Shingle sets of a text column, in lists of consecutive rows."""
    data, offsets = raw_bytes(column)
    for first, last in pieces(offsets):
        yield shingle_sets(words_of(data, offsets[first : last + 1]))

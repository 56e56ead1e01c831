"""Token ids of many texts with a tokenizer of words, each distinct word encoded once.

The tokenizer works on stretches of letters, digits or punctuation one by one, so the ids of a text are
those of its units: runs between ASCII white space, cut where an ASCII letter or digit meets ASCII
punctuation. Apostrophes and all other characters stay with their neighbours, as they may belong together.
A text that holds the opening of a special token is given to the tokenizer whole. Capitals are made small
in advance in units of ASCII alone: the tokenizer composes marks first, and some do so only with a small letter.
"""

from __future__ import annotations

import os
from itertools import chain, compress, count, repeat

import numpy as np
import pyarrow as pa

from orderlake.llm.shingles import _IS_SPACE, _LOWER, hashed_spans, same_spans

SPECIAL = b"<|"
# Distinct units that a worker remembers before it forgets those unused for longest, and units per call of the library.
MOST_UNITS, PER_CALL = 600_000, 200

_SPACE = 4
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = 2
_KIND[_IS_SPACE] = _SPACE


def _mapped(part: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[part]`` of bytes, without indices eight times as wide."""
    return np.frombuffer(part.tobytes().translate(table.tobytes()), np.uint8)


class UnitCache:
    def __init__(self, tokenizer_json: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        suffix = self.tokenizer.model.end_of_word_suffix or ""
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.known: dict[bytes, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        # The call that last met each unit.
        self.met = np.zeros(0, np.int64)
        self.calls = 0

    def _forget(self) -> None:
        """Keep the half of the units that were met last."""
        kept = np.zeros(len(self.met), bool)
        kept[np.argsort(self.met, kind="stable")[len(kept) - MOST_UNITS // 2 :]] = True
        # Units lie in the order of their numbers.
        self.known = {unit: k for k, unit in enumerate(compress(self.known, kept.tolist()))}
        self.flat, until = self._ids_of(np.flatnonzero(kept))
        self.lengths, self.met = self.lengths[kept], self.met[kept]
        self.starts = until - self.lengths

    def _ids_of(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the units numbered in ``entry``, one after the other, and where each unit's end."""
        lengths = self.lengths[entry]
        until = np.cumsum(lengths)
        shift = np.repeat(self.starts[entry] - (until - lengths), lengths)
        shift += np.arange(len(shift))
        return self.flat[shift], until

    def _encode_each(self, units: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
        return [e.ids for e in found]

    def _encode_words(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of units that are one word for the tokenizer, many per call."""
        if not units:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        lines = [" ".join(units[i : i + PER_CALL]) for i in range(0, len(units), PER_CALL)]
        lists = self._encode_each(lines)
        flat = np.concatenate([np.array(ids, np.uint32) for ids in lists])
        ends = np.flatnonzero(self.ends[flat])
        if len(ends) != len(units) or ends[-1] != len(flat) - 1:
            lists = self._encode_each(units)
            flat = np.concatenate([np.array(ids, np.uint32) for ids in lists])
            return flat, np.array([len(ids) for ids in lists], np.int64)
        return flat, np.diff(ends, prepend=-1)

    def _add(self, fresh: list[bytes]) -> None:
        texts = list(map(bytes.decode, fresh))
        word = np.fromiter(map(str.isalpha, texts), bool, len(texts))
        words, others = list(compress(texts, word.tolist())), list(compress(texts, (~word).tolist()))
        flat, lengths = self._encode_words(words)
        rest = self._encode_each(others) if others else []
        sizes = np.zeros(len(fresh), np.int64)
        sizes[word], sizes[~word] = lengths, [len(ids) for ids in rest]
        offset = len(self.flat)
        first = np.zeros(len(fresh), np.int64)
        first[word] = offset + np.cumsum(lengths) - lengths
        first[~word] = offset + len(flat) + np.cumsum([0, *map(len, rest)])[:-1]
        tail = np.array(list(chain.from_iterable(rest)), np.uint32)
        self.flat = np.concatenate([self.flat, flat, tail])
        self.known.update(zip(fresh, count(len(self.starts))))
        self.starts = np.concatenate([self.starts, first])
        self.lengths = np.concatenate([self.lengths, sizes])
        self.met = np.concatenate([self.met, np.full(len(fresh), self.calls)])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each row of UTF-8 ``data`` between ``offsets``."""
        part = data[offsets[0] : offsets[-1]]
        starts = offsets - offsets[0]
        raw = part.tobytes()
        lists = self._encode_plain(part, starts)
        if SPECIAL in raw:
            for k, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
                if raw.find(SPECIAL, a, b) >= 0:
                    lists[k] = np.array(self._encode_each([raw[a:b].decode("utf-8")])[0], np.uint32)
        return lists

    def _encode_plain(self, part: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        begins, ends = self._units(part, starts)
        if not len(begins):
            return [np.zeros(0, np.uint32)] * (len(starts) - 1)
        part = self._folded(part, begins)
        first, inverse = self._same(part, begins, ends)
        raw = part.tobytes()
        spelled = [raw[a:b] for a, b in zip(begins[first].tolist(), ends[first].tolist())]
        self.calls += 1
        if len(self.known) > MOST_UNITS:
            self._forget()
        number = np.fromiter(map(self.known.get, spelled, repeat(-1)), np.int64, len(spelled))
        missing = np.flatnonzero(number < 0)
        if len(missing):
            number[missing] = len(self.starts) + np.arange(len(missing))
            self._add([spelled[k] for k in missing.tolist()])
        self.met[number] = self.calls
        ids, until = self._ids_of(number[inverse])
        before = np.concatenate([[0], until])[np.searchsorted(begins, starts)]
        return np.split(ids, before[1:-1])

    @staticmethod
    def _same(part: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One unit of each spelling, and for every unit which: found by a hash, and compared byte by byte."""
        hashes = pa.array(hashed_spans(part, begins, ends)).dictionary_encode()
        # Numbered as they first occur.
        inverse = hashes.indices.to_numpy()
        first = np.flatnonzero(np.diff(np.maximum.accumulate(inverse), prepend=-1))
        if same_spans(part, begins, ends, first[inverse]):
            return first, inverse
        raw, seen = part.tobytes(), {}
        spelled = [raw[a:b] for a, b in zip(begins.tolist(), ends.tolist())]
        inverse = np.array([seen.setdefault(unit, len(seen)) for unit in spelled])
        return np.unique(inverse, return_index=True)[1], inverse

    @staticmethod
    def _folded(part: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """``part`` with the capitals of units of ASCII alone made small."""
        folded = _mapped(part, _LOWER)
        held = np.maximum.reduceat(part, begins) >= 128
        if held.any():
            # Each unit with the white space behind it; the first may have some before it.
            upto = np.diff(begins, append=len(part))
            at = begins[0]
            folded = np.concatenate([folded[:at], np.where(np.repeat(held, upto), part[at:], folded[at:])])
        return folded

    @staticmethod
    def _units(part: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = _mapped(part, _KIND)
        edge = np.zeros(len(part) + 1, bool)
        edge[1:-1] = (kind[:-1] + kind[1:] == 3) | (kind[:-1] == _SPACE) | (kind[1:] == _SPACE)
        edge[starts] = edge[0] = edge[-1] = True
        inside = kind != _SPACE
        return np.flatnonzero(edge[:-1] & inside), np.flatnonzero(edge[1:] & inside) + 1

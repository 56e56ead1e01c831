"""Alignment of the tokens that two tokenizers give to the same documents.

Both tokenizers encode the whole document, each distinct word once per worker where that gives the ids of the whole. Where tokens of both end at the same byte and the next tokens of both begin with a
space, the document is split: these anchors are looked for after tokenisation and each is verified by the bytes, so no
group can cross one. A document is then a row of windows of token ids, about one per word. Windows repeat, so their alignment is
remembered by the two tuples of ids. Every word encoded on its own begins at an anchor, so its windows are found once and
remembered with it, and its ids are not kept.

Tokens that end together end with the same bytes, so one is a suffix of the other. The pairs that can ever be linked
follow from the two vocabularies, and their number has nothing to do with the corpus: counts of pairs are an array of that
length, which may be collected and broadcast.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import Work, whole_text
from orderlake.llm.shingles import pieces, raw_bytes

# Bytes of text aligned at once; a longer text is aligned alone.
BLOCK_BYTES = 1 << 18
# Words and windows that a worker remembers before it starts anew.
MOST_UNITS = MOST_WINDOWS = 120_000
# Links looked up at once.
MOST_LINKS = 1 << 19
# Marks the ids of B in the key of a window.
TOP = 1 << 31


@dataclass(frozen=True)
class Tokenizers:
    """Contents of a byte-level tokenizer's JSON file (A) and of a piece model with byte pieces (B)."""

    a_json: str
    b_model: bytes

    @classmethod
    def of_files(cls, a_path: str, b_path: str) -> Tokenizers:
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return cls(a.read(), b.read())


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes stand for themselves and all others, in order, for the letters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def spellings_a(a_json: str) -> list[bytes]:
    """The bytes of every id of A; added tokens have none, as texts never give them."""
    held = json.loads(a_json)
    letters = _byte_of_letter()
    added = {token["id"] for token in held["added_tokens"]}
    found = {i: bytes(letters[c] for c in s) for s, i in held["model"]["vocab"].items() if i not in added}
    return [found.get(i, b"") for i in range(max([*found, *added]) + 1)]


def spellings_b(processor) -> list[bytes]:
    """The bytes of every id of B; control and unknown pieces have none."""

    def spelled(i: int) -> bytes:
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i):
            return b""
        return piece.replace("▁", " ").encode("utf-8")

    return [spelled(i) for i in range(processor.get_piece_size())]


def linkable(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Codes ``a << 32 | b`` of all pairs of which one is a suffix of the other, ascending."""
    owners: tuple[dict[bytes, list[int]], ...] = ({}, {})
    for side, spelled in zip(owners, (a, b)):
        for i, s in enumerate(spelled):
            if s:
                side.setdefault(s, []).append(i)
    pairs = set()
    for s, ids in owners[0].items():
        for k in range(len(s)):
            pairs.update(i << 32 | j for j in owners[1].get(s[k:], ()) for i in ids)
    for s, ids in owners[1].items():
        for k in range(1, len(s)):
            pairs.update(i << 32 | j for i in owners[0].get(s[k:], ()) for j in ids)
    return np.array(sorted(pairs), np.int64)


# A space between two characters that are none: a token begins there for both tokenizers, and none goes across.
_CUT = re.compile(r"(?<=\S) (?=\S)")


class _Lists:
    """Many lists of small numbers in one array that grows."""

    def __init__(self) -> None:
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        before = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.starts = np.concatenate([self.starts, before])
        self.lengths = np.concatenate([self.lengths, lengths])

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of these numbers one behind the other, and where each begins and the last ends."""
        lengths = self.lengths[numbers]
        until = np.cumsum(lengths)
        shift = np.repeat(self.starts[numbers] - (until - lengths), lengths)
        return self.flat[shift + np.arange(len(shift))], np.concatenate([[0], until])


class _Strings:
    """Short byte strings in one array, to be laid one behind the other by their numbers."""

    def __init__(self, strings: list[bytes]):
        self.pool = np.frombuffer(b"".join(strings), np.uint8)
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def laid(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes, and where each string ends."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[numbers] - (ends - lengths), lengths)
        return self.pool[shift + np.arange(len(shift))], ends


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists one behind the other, and the length of each."""
    counts = np.array([len(own) for own in lists], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


@dataclass(frozen=True)
class Aligned:
    """Of each text of a batch: numbers of tokens, groups as text, and its links between ``starts``."""

    n_a: np.ndarray
    n_b: np.ndarray
    groups: list[str]
    links: np.ndarray
    starts: np.ndarray


class Aligner:
    def __init__(self, tokenizers: Tokenizers):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(tokenizers.a_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=tokenizers.b_model)
        self.spelled = spellings_a(tokenizers.a_json), spellings_b(self.b)
        self.strings = [_Strings(side) for side in self.spelled]
        self.lengths = [side.lengths for side in self.strings]
        # Numbers in decimal, each with room for what follows it.
        self.decimals = _Strings([b"%d," % i for i in range(max(map(len, self.spelled)))])
        self.spaced = [np.array([s[:1] == b" " for s in side], bool) for side in self.spelled]
        self.pairs = linkable(*self.spelled)
        # Words may be encoded one by one if A begins a token at such spaces and no piece of B goes on behind one.
        first = json.loads(tokenizers.a_json).get("pre_tokenizer") or {}
        by_words = first.get("type") == "ByteLevel" and first.get("use_regex", True)
        self.cuts = by_words and not any(b" " in s.lstrip(b" ") for s in self.spelled[1])
        self._clear()

    def _clear(self) -> None:
        self.units: dict[str, int] = {}
        self.whole = np.zeros(0, bool)
        self.counts = np.zeros((2, 0), np.int32)
        self.windows = _Lists()
        self.known: dict[bytes, int] = {}
        self.texts: list[str] = []
        self.links = _Lists()

    def _ids_a(self, spaced: list[str], sizes: np.ndarray, joined: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A one behind the other, and how many each word has.

        ``joined`` words, none of which begins or ends blank, are one text to A, which is cut after their bytes.
        """
        if joined:
            flat = np.array(self.a.encode_batch_fast(["".join(spaced)], add_special_tokens=False)[0].ids, np.int64)
            ends, stops = np.cumsum(self.lengths[0][flat]), np.cumsum(sizes)
            until = np.searchsorted(ends, stops, "right")
            if until[0] and until[-1] == len(flat) and np.array_equal(ends[until - 1], stops):
                return flat, np.diff(until, prepend=0)
        return _flat([e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)])

    def _add_units(self, fresh: list[str], joined: bool) -> None:
        """Encode words, with a space in front for A; B adds it, and cut them into windows.

        Whether both give the bytes back is kept; of other words no token is.
        """
        spaced = [" " + unit for unit in fresh]
        raw = [unit.encode("utf-8") for unit in spaced]
        sizes = np.array([len(r) for r in raw], np.int64)
        data, whole = np.frombuffer(b"".join(raw), np.uint8), np.ones(len(fresh), bool)
        encoded = self._ids_a(spaced, sizes, joined), _flat(self.b.encode(fresh, num_threads=1))
        for strings, (flat, counts) in zip(self.strings, encoded):
            spelled, ends = strings.laid(flat)
            begins = np.append(0, ends)[np.append(0, np.cumsum(counts))]
            if not np.array_equal(np.diff(begins), sizes) or not np.array_equal(spelled, data):
                parts = zip(raw, begins[:-1].tolist(), begins[1:].tolist())
                text = spelled.tobytes()
                whole &= np.array([text[i:j] == r for r, i, j in parts], bool)
        ids = [flat[np.repeat(whole, counts)] for flat, counts in encoded]
        kept = np.array([np.where(whole, counts, 0) for _, counts in encoded])
        numbers, cuts = self._cut(*ids)
        first = np.searchsorted(cuts, np.append(0, np.cumsum(kept[0])))
        self.windows.add(numbers, np.diff(first))
        self.units.update(zip(fresh, range(len(self.units), len(self.units) + len(fresh))))
        self.whole = np.concatenate([self.whole, whole])
        self.counts = np.concatenate([self.counts, kept.astype(np.int32)], axis=1)

    def _cut(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows of ids of both that stand for the same bytes, and at which of A's tokens each begins."""
        ends = [np.cumsum(n[ids]) for n, ids in zip(self.lengths, (a, b))]
        # Where a token of either begins with a space, by the end of the one before it; every word begins with one.
        marked = [np.flatnonzero(s[ids]) for s, ids in zip(self.spaced, (a, b))]
        begins = [own[at] - n[ids[at]] for own, at, n, ids in zip(ends, marked, self.lengths, (a, b))]
        _, p, q = np.intersect1d(*begins, assume_unique=True, return_indices=True)
        cuts_a, cuts_b = marked[0][p], marked[1][q]
        raw_a, raw_b = a.astype(np.uint32).tobytes(), (b.astype(np.uint32) + np.uint32(TOP)).tobytes()
        bounds = [np.append(c, len(ids)).tolist() for c, ids in ((cuts_a, a), (cuts_b, b))]
        keys = [
            raw_a[4 * i : 4 * j] + raw_b[4 * k : 4 * m]
            for i, j, k, m in zip(bounds[0], bounds[0][1:], bounds[1], bounds[1][1:])
        ]
        return self._windows(keys), cuts_a

    def _add_windows(self, fresh: list[bytes]) -> None:
        """Align windows of ids that stand for the same bytes, many at a time.

        Laid one behind the other they are one long text, and each ends where tokens of both end.
        """
        ids = np.frombuffer(b"".join(fresh), np.uint32)
        owner = np.repeat(np.arange(len(fresh)), [len(key) // 4 for key in fresh])
        of_b = ids >= TOP
        a, b = ids[~of_b].astype(np.int64), (ids[of_b] - TOP).astype(np.int64)
        ends_a, ends_b = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        shared, last_a, last_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        links = np.searchsorted(self.pairs, a[last_a] << 32 | b[last_b])
        counts = np.bincount(owner[~of_b][last_a], minlength=len(fresh))
        self.links.add(links, counts)
        # Groups as text: of each group the ids of A, then those of B.
        group = np.concatenate([np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)])
        order = np.argsort(2 * group + np.repeat([0, 1], [len(a), len(b)]), kind="stable")
        text, ends = self.decimals.laid(np.concatenate([a, b])[order])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        text[ends[place[last_a]] - 1] = ord("|")
        stops = ends[place[len(a) + last_b]]
        text[stops - 1] = ord(";")
        until = np.append(0, stops[np.cumsum(counts) - 1]).tolist()
        whole = text.tobytes().decode("ascii")
        self.texts += [whole[i : j - 1] for i, j in zip(until, until[1:])]
        self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))

    def _windows(self, keys: list[bytes]) -> np.ndarray:
        """Numbers of the windows with these ids; the ids of B have their top bit set."""
        known = self.known
        fresh = [key for key in dict.fromkeys(keys) if key not in known]
        if fresh:
            self._add_windows(fresh)
        return np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))

    def align(self, texts: list[str]) -> Aligned:
        """Tokens, groups and links of all texts; no tokens where bytes are not given back."""
        if len(self.units) > MOST_UNITS or len(self.known) > MOST_WINDOWS:
            self._clear()
        split = [(_CUT.split(text) if self.cuts else [text]) if text else [] for text in texts]
        known = self.units
        fresh = [unit for unit in dict.fromkeys(chain.from_iterable(split)) if unit not in known]
        plain = [unit for unit in fresh if self.cuts and unit.strip() == unit]
        odd = [unit for unit in fresh if not self.cuts or unit.strip() != unit]
        for units in filter(None, (plain, odd)):
            self._add_units(units, units is plain)
        sizes = np.array([len(own) for own in split], np.int64)
        numbers = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(texts)), sizes)
        lost = np.zeros(len(texts), bool)
        lost[owner[~self.whole[numbers]]] = True
        numbers, owner = numbers[~lost[owner]], owner[~lost[owner]]
        first = np.searchsorted(owner, np.arange(len(texts) + 1))
        n_a, n_b = (np.diff(np.append(0, np.cumsum(own[numbers], dtype=np.int64))[first]) for own in self.counts)
        windows, begins = self.windows.of(numbers)
        rows = begins[first]
        links, begin = self.links.of(windows)
        texts_of = list(map(self.texts.__getitem__, windows.tolist()))
        groups = [";".join(texts_of[i:j]) for i, j in zip(rows.tolist(), rows[1:].tolist())]
        return Aligned(n_a, n_b, groups, links, begin[rows])


_ALIGNERS: dict[Tokenizers, Aligner] = {}


def _aligner(tokenizers: Tokenizers) -> Aligner:
    if tokenizers not in _ALIGNERS:
        _ALIGNERS[tokenizers] = Aligner(tokenizers)
    return _ALIGNERS[tokenizers]


ALIGNED = "doc_id {kind}, n_a long, n_b long, groups string, links array<int>"


def _aligned(tokenizers: Tokenizers):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(tokenizers)
        for batch in batches:
            _, offsets = raw_bytes(batch["text"])
            for first, last in pieces(offsets, BLOCK_BYTES):
                texts = batch["text"].slice(first, last - first).to_pylist()
                found = aligner.align(texts)
                links = pa.array(found.links.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, last - first),
                        pa.array(found.n_a),
                        pa.array(found.n_b),
                        pa.array(found.groups, pa.string()),
                        pa.ListArray.from_arrays(pa.array(found.starts.astype(np.int32)), links),
                    ],
                    ["doc_id", "n_a", "n_b", "groups", "links"],
                )

    return rows


def _counted(n_pairs: int):
    """Counts of pairs per task, in one array whatever the number of documents."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _ALIGNERS.clear()
        total = np.zeros(n_pairs, np.int64)
        for batch in batches:
            flat = batch["links"].flatten().to_numpy()
            for first in range(0, len(flat), MOST_LINKS):
                total += np.bincount(flat[first : first + MOST_LINKS], minlength=n_pairs)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["pair", "n"])

    return counts


def _sums(counts: np.ndarray, best: np.ndarray):
    @F.arrow_udf("n_best long, count_sum long")
    def sums(links: pa.Array) -> pa.Array:
        # What this worker remembers of an earlier stage is not needed any more.
        _ALIGNERS.clear()
        flat, lengths = links.flatten().to_numpy(), links.value_lengths().to_numpy()
        found = np.zeros((2, len(lengths)), np.int64)
        for first in range(0, len(flat), MOST_LINKS):
            part = flat[first : first + MOST_LINKS]
            until = np.cumsum(lengths, dtype=np.int64)
            row = np.searchsorted(until, np.arange(first, first + len(part)), "right")
            begin = np.flatnonzero(np.diff(row, prepend=-1))
            for sums_of, values in zip(found, (best, counts)):
                sums_of[row[begin]] += np.add.reduceat(values[part], begin, dtype=np.int64)
        return pa.StructArray.from_arrays(list(map(pa.array, found)), ["n_best", "count_sum"])

    return sums


@dataclass(frozen=True)
class Alignment:
    """What documents and pairs of ids were aligned."""

    documents: DataFrame
    pairs: DataFrame


def align(
    docs: DataFrame, tokenizers: Tokenizers, kept: Mapping[str, Column] | None = None
) -> Alignment:
    """Align the tokens of every text.

    ``documents``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups``, the ids of each group as
    ``a1,a2|b1;a3|b2``. Expressions over ``groups`` in ``kept`` take its place, as the text is longer than the document.
    ``pairs``: id_a, id_b and ``n``, how many links hold them. A link is a token of A and one of B that end at the same byte; tokens
    have one byte at least, so a group ends with its one link.

    A text that is NULL or empty, or that a tokenizer does not give back byte by byte, has no tokens: zeros and empty
    groups. Repeated rows count each. No documents give no rows. Other columns are ignored.
    """
    work = Work(docs.sparkSession)
    rows = docs.select("doc_id", whole_text().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    kept = {"groups": F.col("groups")} if kept is None else kept
    found = rows.mapInArrow(_aligned(tokenizers), ALIGNED.format(kind=kind))
    aligned = work.table(
        found.select("doc_id", "n_a", "n_b", "links", *(c.alias(name) for name, c in kept.items())), "aligned"
    )
    codes = _aligner(tokenizers).pairs
    counted = aligned.select("links").mapInArrow(_counted(len(codes)), "pair int, n long")
    listed = work.table(counted.groupBy("pair").agg(F.sum("n").alias("n")), "pairs").toArrow()
    counts = np.zeros(len(codes), np.int64)
    counts[listed["pair"].to_numpy()] = listed["n"].to_numpy()
    id_b = codes & 0xFFFFFFFF
    highest = np.zeros(int(id_b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, id_b, counts)
    sums = _sums(counts, (counts > 0) & (counts == highest[id_b]))
    n_links = F.size("links").cast("long")
    documents = aligned.withColumn("sums", sums("links")).select(
        "doc_id", "n_a", "n_b", n_links.alias("n_groups"), n_links.alias("n_links"), "sums.*", *kept
    )
    seen = np.flatnonzero(counts)
    spark = docs.sparkSession
    pairs = spark.createDataFrame(
        pa.table({"id_a": codes[seen] >> 32, "id_b": id_b[seen], "n": counts[seen]})
    )
    return Alignment(documents, pairs)

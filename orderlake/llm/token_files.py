"""Token ids in binary shards, compressed by a grammar of pairs.

Documents are put in order of their ids over range partitions. A task encodes its documents and
closes a shard when it holds enough ids. In a shard frequent pairs of neighbours are replaced by new
symbols, round after round, never across documents. A shard holds the
rules, the number of ids each rule stands for, and per document where its symbols begin, so one
document, or one position in it, is decoded without the rest.

Layout of a shard, all little-endian: the magic, then four 32-bit numbers (ids of the vocabulary, rules,
documents, symbols), then the arrays: left and right side of each rule (32 bits each), number of ids per rule (32),
document ids (64), whether they are NULL (8), ids per document (64), first symbol of each
document (64), symbols (16).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.llm.common import Work, whole_text
from orderlake.llm.shingles import pieces, raw_bytes
from orderlake.llm.unit_cache import UnitCache

MAGIC = b"PAIR0001"
END = 2
# A shard is closed at the end of the document that brings it to so many ids.
SHARD_IDS = 1 << 20
# Symbols fit 16 bits. A pair is replaced when it occurs so often; so many kinds in a round, so many rounds.
SYMBOLS, LEAST, PER_ROUND, ROUNDS = 1 << 16, 12, 3000, 6
_SLOTS = 1 << 20

SHARD = "part int, shard int, n_ids long, payload binary"
DOCUMENT = "part int, shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def _spelled(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The ids of ``symbols``, of which each has its ``lengths`` ids in ``flat`` from its ``starts`` on."""
    sizes = lengths[symbols]
    until = np.cumsum(sizes)
    shift = np.repeat(starts[symbols] - (until - sizes), sizes)
    shift += np.arange(len(shift))
    return flat[shift]


@dataclass(frozen=True)
class Grammar:
    """Rules for symbols from ``base`` on, and the number of ids that each stands for."""

    base: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray

    def expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids of all symbols, with begin and length of each symbol's."""
        lengths = np.concatenate([np.ones(self.base, np.int64), self.lengths.astype(np.int64)])
        starts = np.cumsum(lengths) - lengths
        flat = np.zeros(int(lengths.sum()), np.uint32)
        flat[: self.base] = np.arange(self.base)
        # The rules of a round stand for symbols of earlier rounds alone, so they are spelled out together.
        needs = np.maximum.accumulate(np.maximum(self.left, self.right)).astype(np.int64)
        done, n = 0, len(needs)
        while done < n:
            until = int(np.searchsorted(needs, self.base + done))
            if until == done:
                raise ValueError("a rule stands for a later symbol")
            sides = np.stack([self.left[done:until], self.right[done:until]], 1).ravel()
            first, last = starts[self.base + done], starts[self.base + until - 1] + lengths[self.base + until - 1]
            flat[first:last] = _spelled(flat, starts, lengths, sides)
            done = until
        return flat, starts, lengths


def _slot(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint32(0x9E3779B1)) >> np.uint32(12)


def _replaced(seq: np.ndarray, firsts: np.ndarray, chosen: np.ndarray, base: int):
    """Replace occurrences of the pairs ``chosen``, from left to right, by symbols from ``base``."""
    slot = _slot(chosen)
    _, kept = np.unique(slot, return_index=True)
    chosen, slot = chosen[np.sort(kept)], slot[np.sort(kept)]
    table = np.full(_SLOTS, -1, np.int32)
    table[slot] = np.arange(len(chosen))
    codes = seq[:-1] << np.uint32(16) | seq[1:]
    # Few places pass the narrow table; the pairs are compared there alone.
    hit = np.flatnonzero((table >= 0)[_slot(codes)])
    rule = table[_slot(codes[hit])]
    within = np.ones(len(codes), bool)
    within[firsts[(firsts > 0) & (firsts < len(seq))] - 1] = False
    right = (chosen[rule] == codes[hit]) & within[hit]
    hit, rule = hit[right], rule[right]
    # Of hits that touch, every other one is taken.
    nth = np.arange(len(hit))
    run = np.maximum.accumulate(np.where(np.diff(hit, prepend=-2) > 1, nth, 0))
    taken = (nth - run) % 2 == 0
    take = hit[taken]
    seq = seq.copy()
    seq[take] = base + rule[taken]
    stays = np.ones(len(seq), bool)
    stays[take + 1] = False
    return np.compress(stays, seq), firsts - np.searchsorted(take, firsts - 1), chosen


def compress(ids: np.ndarray, firsts: np.ndarray, base: int) -> tuple[Grammar, np.ndarray, np.ndarray]:
    """The grammar of ``ids``, its symbols, and where the documents that begin at ``firsts`` begin there."""
    seq, left, right = ids.astype(np.uint32), [], []
    lengths = [np.ones(base, np.int64)]
    for _ in range(ROUNDS):
        room = SYMBOLS - base - sum(map(len, left))
        if len(seq) < 2 or room <= 0:
            break
        codes = seq[:-1] << np.uint32(16) | seq[1:]
        inside = np.ones(len(codes), bool)
        inside[firsts[(firsts > 0) & (firsts < len(seq))] - 1] = False
        codes = np.sort(np.compress(inside, codes))
        edges = np.flatnonzero(np.concatenate([np.ones(min(len(codes), 1), bool), codes[1:] != codes[:-1]]))
        counts = np.diff(edges, append=len(codes))
        often = np.flatnonzero(counts >= LEAST)
        # By falling count, then in order: one number each, as sorting numbers is fast.
        falling = np.sort((len(codes) - counts[often]) << 32 | np.arange(len(often)))
        often = often[falling[: min(PER_ROUND, room)] & 0xFFFFFFFF]
        if not len(often):
            break
        start = base + sum(map(len, left))
        seq, firsts, chosen = _replaced(seq, firsts, codes[edges[often]], start)
        left.append(chosen >> np.uint32(16))
        right.append(chosen & np.uint32(0xFFFF))
        known = np.concatenate(lengths)
        lengths.append(known[left[-1]] + known[right[-1]])
    none = [np.zeros(0, np.uint32)]
    grammar = Grammar(
        base,
        np.concatenate(left or none).astype(np.uint32),
        np.concatenate(right or none).astype(np.uint32),
        np.concatenate(lengths[1:] or none).astype(np.uint32),
    )
    return grammar, seq.astype(np.uint16), firsts


# Bytes of text encoded at once; the more, the more units are the same.
BLOCK_BYTES = 1 << 22
# Symbols are written in 16 bits.
MOST_SYMBOLS = 1 << 16


def packed(doc_ids: list[int | None], lists: list[np.ndarray], base: int) -> bytes:
    """The bytes of a shard; ``lists`` has the ids of each document."""
    counts = np.array([len(ids) for ids in lists], np.int64)
    ids = np.concatenate(lists) if lists else np.zeros(0, np.uint32)
    if base > MOST_SYMBOLS or len(ids) and int(ids.max()) >= base:
        raise ValueError(f"ids below {min(base, MOST_SYMBOLS)} can be written, symbols have 16 bits")
    grammar, symbols, firsts = compress(ids, np.cumsum(counts) - counts, base)
    head = np.array([base, len(grammar.left), len(lists), len(symbols)], "<u4")
    parts = [
        head,
        grammar.left.astype("<u4"),
        grammar.right.astype("<u4"),
        grammar.lengths.astype("<u4"),
        np.array([d or 0 for d in doc_ids], "<i8"),
        np.array([d is None for d in doc_ids], "u1"),
        counts.astype("<i8"),
        firsts.astype("<i8"),
        symbols.astype("<u2"),
    ]
    return MAGIC + b"".join(part.tobytes() for part in parts)


class Shard:
    """A shard's bytes, opened."""

    def __init__(self, payload: bytes):
        if payload[: len(MAGIC)] != MAGIC:
            raise ValueError("not a shard of token ids")
        self._data, self._at = payload, len(MAGIC)
        base, rules, docs, symbols = self._take("<u4", 4).tolist()
        left, right, lengths = (self._take("<u4", rules) for _ in range(3))
        self.grammar = Grammar(base, left, right, lengths)
        self.doc_ids = self._take("<i8", docs)
        self.missing = self._take("u1", docs).astype(bool)
        self.counts = self._take("<i8", docs)
        self.firsts = self._take("<i8", docs)
        self.symbols = self._take("<u2", symbols)
        self._flat, self._starts, self._lengths = self.grammar.expansions()

    def _take(self, kind: str, n: int) -> np.ndarray:
        found = np.frombuffer(self._data, kind, n, self._at)
        self._at += found.nbytes
        return found

    def _decoded(self, symbols: np.ndarray) -> np.ndarray:
        return _spelled(self._flat, self._starts, self._lengths, symbols)

    def ids(self) -> np.ndarray:
        """All ids of the shard."""
        return self._decoded(self.symbols)

    def _symbols(self, doc: int) -> np.ndarray:
        end = self.firsts[doc + 1] if doc + 1 < len(self.firsts) else len(self.symbols)
        return self.symbols[self.firsts[doc] : end]

    def document(self, doc: int) -> np.ndarray:
        """The ids of one document."""
        return self._decoded(self._symbols(doc))

    def at(self, doc: int, position: int) -> int:
        """One id of one document: only the symbol over it is expanded."""
        symbols = self._symbols(doc)
        until = np.cumsum(self._lengths[symbols])
        k = int(np.searchsorted(until, position, "right"))
        inner = position - (until[k - 1] if k else 0)
        return int(self._flat[self._starts[symbols[k]] + inner])


_CACHES: dict[int, UnitCache] = {}


def _cache(tokenizer_json: str) -> UnitCache:
    key = hash(tokenizer_json)
    if key not in _CACHES:
        _CACHES.clear()
        _CACHES[key] = UnitCache(tokenizer_json)
    return _CACHES[key]


def _encoder(tokenizer_json: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part = _cache(tokenizer_json), TaskContext.get().partitionId()
        base = len(cache.ends)
        doc_ids: list[int | None] = []
        lists: list[np.ndarray] = []
        n, shard = 0, 0
        end = np.array([END], np.uint32)

        def closed():
            columns = [[part], [shard], [n], [packed(doc_ids, lists, base)]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, ["part", "shard", "n_ids", "payload"])

        for batch in batches:
            data, offsets = raw_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            for first, last in pieces(offsets, BLOCK_BYTES):
                found = cache.encode(data, offsets[first : last + 1])
                for doc_id, tokens in zip(ids[first:last], found):
                    doc_ids.append(doc_id)
                    lists.append(np.concatenate([tokens, end]))
                    n += len(tokens) + 1
                    if n >= SHARD_IDS:
                        yield closed()
                        doc_ids, lists, n, shard = [], [], 0, shard + 1
        if lists:
            yield closed()

    return encode


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, shard, payload in zip(*(batch.column(c) for c in ("part", "shard", "payload"))):
            opened = Shard(payload.as_py())
            ids = opened.ids().astype("<u4")
            counts = opened.counts
            starts = np.cumsum(counts) - counts
            crcs = [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(starts, counts)]
            n = len(counts)
            columns = [
                pa.array(np.full(n, part.as_py(), np.int32)),
                pa.array(np.full(n, shard.as_py(), np.int32)),
                pa.array(opened.doc_ids, mask=opened.missing),
                pa.array(starts),
                pa.array(counts),
                pa.array(crcs, pa.int64()),
            ]
            names = [c.split()[0] for c in DOCUMENT.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)


def write_shards(docs: DataFrame, tokenizer_json: str, path: str) -> None:
    """Encode ``docs`` in the order of their ids, NULL first, into shards under ``path``.

    Rows with one id are ordered by a hash of their text. A NULL text is empty: its ids are the end id alone.
    """
    ordered = (
        docs.select("doc_id", whole_text().alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    ordered.mapInArrow(_encoder(tokenizer_json), SHARD).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, decoded from its shard: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.schema(SHARD).parquet(path)
    sizes = files.select("part", "shard", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # A row per partition of the writing job.
    before_part = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    before_shard = F.sum("n_ids").over(
        Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0).cast("long")
    placed = sizes.withColumn("in_part", F.coalesce(before_shard, zero)).join(
        parts.select("part", F.coalesce(before_part, zero).alias("to_part")), "part"
    )
    starts = placed.select("part", "shard", (F.col("in_part") + F.col("to_part")).alias("base"))
    found = files.select("part", "shard", "payload").mapInArrow(_documents, DOCUMENT)
    return found.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """Write ``docs`` as shards into the shared folder and read them back. No rows give no rows."""
    path = f"{Work(docs.sparkSession).folder}/shards"
    write_shards(docs, tokenizer_json, path)
    return read_shards(docs.sparkSession, path)

"""SentencePiece encoding and decoding, with giant documents encoded in parallel chunks.

With the model of ``Pieces.of_file`` the ids of a text are what SentencePiece gives for the file. A
giant document is cut where no piece of the file has both neighbours in it, so that no merge crosses the
cut, and the ids of its chunks are joined.

With the model of ``Pieces.from_file`` the ids of a text are its segmentation of greatest total score over the
pieces of a SentencePiece model file. A piece scores the logarithm of its rank in the file, in whole
units, so that sums are exact in any order. Of equal sums the one
whose last piece is longer wins, at every position.

There a giant document is cut into chunks at fixed positions. A piece may reach over
a cut, and how far is the state there. A chunk yields the matrix of best
scores from each state at its begin to each state at its end; the matrices combine
associatively under (max, +) to the scores at every cut. With these each chunk
is traced back on its own, from every end state, and the choices are composed.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import Work, whole_text

# Characters of a chunk; longer documents are cut.
CHUNK = 1 << 16
CHUNKS_PER_TASK = 4
# Units per e-fold of rank. Sums over a chunk stay below 2**24, exact as 32-bit floats.
UNITS = 16
# Below the rarest piece; runs of spaces are pieces of last resort.
SPACE_RUN, UNKNOWN_BELOW = -176.0, 10.0

_SPACE = "▁"
_NONE = -(2**60)
ENCODED = "struct<ids: array<int>, ids_crc32: bigint>"


@dataclass(frozen=True)
class Pieces:
    """A model: as the library, and if it has whole-unit scores, as tables."""

    model: bytes

    @property
    def library(self):
        return _library(self.model)

    @property
    def scores(self) -> dict[str, int]:
        return _tables(self.model)[0]

    @property
    def merges(self) -> bool:
        """Whether ids come from merges in order, not from a total score."""
        return _merging(self.model) is not None

    @classmethod
    def of_file(cls, path: str) -> Pieces:
        """The model of a file as it is."""
        with open(path, "rb") as file:
            return cls(file.read())

    @classmethod
    def from_file(cls, path: str) -> Pieces:
        """The pieces of a model file, rescored for segmentation by total score."""
        from sentencepiece import sentencepiece_model_pb2 as schema

        proto = schema.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        proto.trainer_spec.model_type = schema.TrainerSpec.UNIGRAM
        rank = 0
        for piece in proto.pieces:
            if piece.type != schema.ModelProto.SentencePiece.NORMAL:
                continue
            rank += 1
            run = len(piece.piece) > 1 and set(piece.piece) == {_SPACE}
            piece.score = SPACE_RUN if run else -float(round(UNITS * math.log(rank + 1)))
        return cls(proto.SerializeToString())


@lru_cache(4)
def _library(model: bytes):
    import sentencepiece

    loaded = sentencepiece.SentencePieceProcessor()
    loaded.LoadFromSerializedProto(model)
    return loaded


@lru_cache(4)
def _merging(model: bytes):
    """The library without a space in front, and the neighbours inside pieces; None without merges."""
    from sentencepiece import sentencepiece_model_pb2 as schema

    proto = schema.ModelProto()
    proto.ParseFromString(model)
    if proto.trainer_spec.model_type != schema.TrainerSpec.BPE:
        return None
    normalizer = proto.normalizer_spec
    as_it_is = not (normalizer.precompiled_charsmap or normalizer.remove_extra_whitespaces)
    if not (as_it_is and normalizer.add_dummy_prefix) or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("merges in chunks need a model that leaves texts as they are, one space in front")
    texts = [p.piece for p in proto.pieces]
    joined = frozenset(text[k : k + 2] for text in texts for k in range(len(text) - 1))
    normalizer.add_dummy_prefix = False
    return _library(proto.SerializeToString()), joined


@lru_cache(4)
def _tables(model: bytes) -> tuple[dict[str, int], frozenset[str], int, int]:
    """Scores, proper beginnings of pieces, the unknown character's score, longest piece."""
    lib = _library(model)
    normal = [
        i
        for i in range(lib.get_piece_size())
        if not (lib.is_unknown(i) or lib.is_control(i) or lib.is_byte(i) or lib.is_unused(i))
    ]
    scores = {lib.id_to_piece(i): int(lib.get_score(i)) for i in normal}
    begins = frozenset(p[:k] for p in scores for k in range(1, len(p)))
    return scores, begins, int(min(scores.values()) - UNKNOWN_BELOW), max(map(len, scores))


def symbols(text: str) -> str:
    """The text as the model sees it: spaces visible, one in front."""
    return (_SPACE + text.replace(" ", _SPACE)) if text else ""


class Chunk:
    """A stretch of symbols. ``ahead`` are those after it that a piece can reach into."""

    def __init__(self, pieces: Pieces, own: str, ahead: str):
        self.pieces = pieces
        self.scores, begins, unknown, self.longest = _tables(pieces.model)
        self.text, self.size = own + ahead, len(own)
        self.edges: list[list[tuple[int, int]]] = []
        for i in range(self.size):
            found = []
            if self.text[i] not in self.scores:
                found.append((i + 1, unknown))
            for j in range(i + 1, min(i + self.longest, len(self.text)) + 1):
                part = self.text[i:j]
                score = self.scores.get(part)
                if score is not None:
                    found.append((j, score))
                if part not in begins:
                    break
            self.edges.append(found)

    def _forward(self, best: list[int], back: list[int] | None, begin: int, same: list[int] | None):
        """Fill in the best scores. Stops, with the difference, where they run along ``same``."""
        alike = 0
        for i in range(begin, self.size):
            here = best[i]
            if same is not None:
                gap = here - same[i] if here > _NONE and same[i] > _NONE else None
                known = gap is not None and (alike == 0 or gap == last)
                alike = alike + 1 if known else (1 if gap is not None else 0)
                last = gap
                if alike > self.longest:
                    return gap
            if here <= _NONE:
                continue
            for j, score in self.edges[i]:
                if here + score > best[j]:
                    best[j] = here + score
                    if back is not None:
                        back[j] = i
        return None

    def matrix(self) -> np.ndarray:
        """Best score from each begin state (rows) to each end state (columns)."""
        states, width = self.longest, len(self.text) + 1
        out = np.full((states, states), _NONE, np.int64)
        first: list[int] | None = None
        for s in range(min(states, width)):
            best = [_NONE] * width
            best[s] = 0
            gap = self._forward(best, None, s, first)
            ends = first if gap is not None else best
            for t in range(min(states, width - self.size)):
                if ends[self.size + t] > _NONE:
                    out[s, t] = ends[self.size + t] + (gap or 0)
            first = first or best
        return out

    def trace(self, entry: list[int]) -> tuple[list[int], list[list[int]], list[int], list[int]]:
        """Begin state per end state, and the ids that lead there.

        ``entry`` has the best scores at the begin. Ids are those of the first reachable end state;
        another end state shares the first ``joins[t]`` of them and adds ``tails[t]``.
        """
        states, width = self.longest, len(self.text) + 1
        best = [*entry[:width], *[_NONE] * (width - len(entry))]
        back = [-1] * width
        self._forward(best, back, 0, None)
        trunk: dict[int, int] = {}
        ids: list[int] = []
        begins, tails, joins = [-1] * states, [[] for _ in range(states)], [0] * states
        for t in range(min(states, width - self.size)):
            at, path = self.size + t, []
            if best[at] <= _NONE:
                continue
            while at >= 0 and back[at] >= 0 and at not in trunk:
                path.append((back[at], at))
                at = back[at]
            path.reverse()
            spelled = [self._ids(i, j) for i, j in path]
            if not trunk:
                trunk[at] = 0
                for (_, j), found in zip(path, spelled):
                    ids += found
                    trunk[j] = len(ids)
                joins[t], begins[t] = len(ids), at
                root = at
            else:
                joins[t] = trunk.get(at, 0)
                begins[t] = root if at in trunk else at
                tails[t] = [x for found in spelled for x in found]
        return begins, tails, joins, ids

    def _ids(self, i: int, j: int) -> list[int]:
        part, lib = self.text[i:j], self.pieces.library
        if part in self.scores:
            return [lib.piece_to_id(part)]
        return [lib.piece_to_id(f"<0x{byte:02X}>") for byte in part.encode("utf-8")]


def combined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The matrix of two neighbouring stretches: product under (max, +)."""
    total = left[:, :, None] + right[None]
    total[(left[:, :, None] <= _NONE) | (right[None] <= _NONE)] = _NONE
    return total.max(1)


def prefixes(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Products of the first 0, 1, ... matrices, by doubling steps."""
    done = list(matrices)
    step = 1
    while step < len(done):
        done = [combined(done[k - step], m) if k >= step else m for k, m in enumerate(done)]
        step *= 2
    identity = np.full_like(matrices[0], _NONE)
    np.fill_diagonal(identity, 0)
    return [identity, *done[:-1]]


def cut(text: str, chunk: int, longest: int) -> list[tuple[str, str]]:
    seen = symbols(text)
    return [
        (seen[i : i + chunk], seen[i + chunk : i + chunk + longest - 1])
        for i in range(0, len(seen), chunk)
    ]


def cut_between(text: str, chunk: int, joined: frozenset[str]) -> Iterator[str]:
    """Stretches of symbols of at least ``chunk`` characters, cut between neighbours that no piece joins."""
    seen, begin = symbols(text), 0
    while begin < len(seen):
        end = begin + chunk
        while end < len(seen) and seen[end - 1 : end + 1] in joined:
            end += 1
        yield seen[begin:end]
        begin = end


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _encoded(flats: list[np.ndarray], lengths: list[int]) -> pa.Array:
    until = np.cumsum([0, *lengths])
    flat = np.concatenate(flats) if flats else np.zeros(0, np.int32)
    crcs = [_crc(flat[a:b]) for a, b in zip(until[:-1], until[1:])]
    ids = pa.ListArray.from_arrays(pa.array(until, pa.int32()), pa.array(flat))
    return pa.StructArray.from_arrays([ids, pa.array(crcs, pa.int64())], ["ids", "ids_crc32"])


# Documents given to the library at once.
AT_ONCE = 256


def encoding(pieces: Pieces, text: Column) -> Column:
    """``(ids, ids_crc32)`` of a text that one task can hold."""

    @F.arrow_udf(ENCODED)
    def encode(column: pa.Array) -> pa.Array:
        # Lists of Python numbers take ten times the memory of arrays, so few are held at a time.
        flats: list[np.ndarray] = []
        lengths: list[int] = []
        for at in range(0, len(column), AT_ONCE):
            lists = pieces.library.encode(column[at : at + AT_ONCE].to_pylist(), num_threads=1)
            sizes = [len(ids) for ids in lists]
            flats.append(np.fromiter(chain.from_iterable(lists), np.int32, sum(sizes)))
            lengths += sizes
        return _encoded(flats, lengths)

    return encode(text)


def decoding(pieces: Pieces, ids: Column) -> Column:
    """The text of ids; ids without a piece raise an error."""

    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        parts = [
            pieces.library.decode(column[at : at + AT_ONCE].to_pylist())
            for at in range(0, len(column), AT_ONCE)
        ]
        return pa.array([text for part in parts for text in part], pa.string())

    return decode(ids)


CUT = "row long, k int, own string, ahead string"
MATRICES = "row long, k int, matrix binary"
ENTRIES = "row long, k int, entry array<long>"
TRACED = "row long, k int, begins array<int>, tails array<array<int>>, joins array<int>, ids array<int>"
WHOLE = "row long, found struct<ids: array<int>, ids_crc32: bigint>"


def _cut(chunk: int, longest: int):
    def cuts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row, text in zip(frame["row"], frame["text"]):
                for k, (own, ahead) in enumerate(cut(text, chunk, longest)):
                    yield pd.DataFrame({"row": [row], "k": [k], "own": [own], "ahead": [ahead]})

    return cuts


def _measure(pieces: Pieces):
    def matrices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in frame.itertuples():
                made = Chunk(pieces, part.own, part.ahead).matrix()
                yield pd.DataFrame({"row": [part.row], "k": [part.k], "matrix": [made.tobytes()]})

    return matrices


def _entries(longest: int):
    def entries(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("k")
        made = [np.frombuffer(m, np.int64).reshape(longest, longest) for m in frame["matrix"]]
        scores = [p[0].tolist() for p in prefixes(made)]
        return pd.DataFrame({"row": frame["row"], "k": frame["k"], "entry": scores})

    return entries


def _trace(pieces: Pieces):
    def traces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in frame.itertuples():
                found = Chunk(pieces, part.own, part.ahead).trace(list(part.entry))
                names = ("begins", "tails", "joins", "ids")
                columns = {name: [value] for name, value in zip(names, found)}
                yield pd.DataFrame({"row": [part.row], "k": [part.k], **columns})

    return traces


def _whole(frame: pd.DataFrame) -> pd.DataFrame:
    """Compose the choices from the last chunk to the first, and join the ids."""
    state, parts = 0, []
    for part in frame.sort_values("k", ascending=False).itertuples():
        own = np.asarray(part.ids, np.int32)[: part.joins[state]]
        parts.append(np.concatenate([own, np.asarray(part.tails[state], np.int32)]))
        state = part.begins[state]
    ids = np.concatenate(parts[::-1]).astype(np.int32)
    found = {"ids": ids.tolist(), "ids_crc32": _crc(ids)}
    return pd.DataFrame({"row": [frame["row"].iloc[0]], "found": [found]})


STRETCHES = "row long, k int, own string"
STRETCH_IDS = "row long, k int, ids array<int>"


def _cut_between(pieces: Pieces, chunk: int):
    def cuts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row, text in zip(frame["row"], frame["text"]):
                for k, own in enumerate(cut_between(text, chunk, _merging(pieces.model)[1])):
                    yield pd.DataFrame({"row": [row], "k": [k], "own": [own]})

    return cuts


def _merge(pieces: Pieces):
    def merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in frame.itertuples():
                ids = _merging(pieces.model)[0].encode(part.own)
                yield pd.DataFrame({"row": [part.row], "k": [part.k], "ids": [ids]})

    return merged


def _joined(frame: pd.DataFrame) -> pd.DataFrame:
    ids = np.concatenate(frame.sort_values("k")["ids"].tolist()).astype(np.int32)
    found = {"ids": ids.tolist(), "ids_crc32": _crc(ids)}
    return pd.DataFrame({"row": [frame["row"].iloc[0]], "found": [found]})


def _merged_giants(texts: DataFrame, pieces: Pieces, chunk: int, work: Work) -> DataFrame:
    """``(row, found)`` of documents cut where no merge crosses."""
    n_chunks = texts.agg(F.sum(F.length("text"))).first()[0] // chunk + 1
    cuts = texts.select("row", "text").mapInPandas(_cut_between(pieces, chunk), STRETCHES)
    dealt = cuts.repartition(max(1, n_chunks // CHUNKS_PER_TASK), "row", "k")
    ids = work.table(dealt.mapInPandas(_merge(pieces), STRETCH_IDS), "merged")
    return ids.groupBy("row").applyInPandas(_joined, WHOLE)


def _giants(texts: DataFrame, pieces: Pieces, chunk: int, work: Work) -> DataFrame:
    """``(row, found)`` of documents in chunks, which are dealt over all tasks."""
    longest = _tables(pieces.model)[3]
    # Chunks take long for their size, so a task gets few of them.
    n_chunks = texts.agg(F.sum(F.length("text"))).first()[0] // chunk + 1
    tasks = max(1, n_chunks // CHUNKS_PER_TASK)
    cuts = texts.select("row", "text").mapInPandas(_cut(chunk, longest), CUT)
    chunks = work.table(cuts.repartition(tasks, "row", "k"), "chunks")
    matrices = work.table(chunks.mapInPandas(_measure(pieces), MATRICES), "matrices")
    entries = matrices.groupBy("row").applyInPandas(_entries(longest), ENTRIES)
    traced = chunks.join(work.table(entries, "entries"), ["row", "k"]).mapInPandas(
        _trace(pieces), TRACED
    )
    return work.table(traced, "traced").groupBy("row").applyInPandas(_whole, WHOLE)


def encode(docs: DataFrame, pieces: Pieces, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with ``ids`` and ``ids_crc32`` added in place of any columns of these names.

    A NULL text is an empty text, and those have no ids. Characters without a piece
    become the pieces of their bytes. No documents give no rows.
    """
    work = Work(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("ids", "ids_crc32")]
    rows = docs.select(F.struct(*names).alias("doc"), whole_text().alias("text"))
    long = F.length("text") >= chunk
    giants = work.table(
        rows.where(long).withColumn("row", F.monotonically_increasing_id()), "giants"
    )
    made = rows.where(~long).select("doc", encoding(pieces, F.col("text")).alias("found"))
    if not giants.isEmpty():
        whole = _merged_giants if pieces.merges else _giants
        found = work.table(whole(giants, pieces, chunk, work), "whole")
        made = made.unionByName(giants.join(found, "row").select("doc", "found"))
    return made.select("doc.*", "found.ids", "found.ids_crc32")


def decode(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """``encoded`` with ``decoded`` added: the texts that the ids stand for."""
    return encoded.withColumn("decoded", decoding(pieces, F.col("ids")))

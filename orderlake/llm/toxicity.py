"""Toxicity by a support vector machine with a gapped subsequence kernel.

Two strings are alike as far as they share subsequences of four symbols; each
occurrence weighs less the more it is stretched by gaps. So ``id-iot``, ``i d i o t`` and
``idxiot`` stay close to ``idiot``. The kernel is taken in windows that begin at the words of a sentence, against landmark
words: those most tied to toxic documents and frequent words of clean ones. Nyström's map of
the landmarks makes the machine linear.

Toxic documents are labelled, their sentences are not: windows of toxic documents count as
toxic where the machine says so, and it is fitted again. Since a decision is a sum over the
subsequences of a window, the fitted machine is one table of weights per subsequence.
A document's score comes from the decisions of all its windows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import held_out, whole_text
from orderlake.llm.language import documents

# Subsequences of four symbols that reach over at most seven, and the weight of each place.
REACH, DECAY = 7, 0.8
PATTERNS = [
    (a, b, c)
    for c in range(3, REACH)
    for b in range(2, c)
    for a in range(1, b)
]
BITS = 5
CODES = 1 << (4 * BITS)
# Symbols of a window, and the distance of windows within a long word.
WINDOW, STEP = 14, 6
# The machine is fitted on at most so many labelled documents of each kind, none longer than this.
TOXIC_DOCS, CLEAN_DOCS, LONGEST_DOC = 1500, 3000, 20_000
LANDMARKS, PLAIN_LANDMARKS = 96, 32
# Windows of clean documents that it is fitted on, and rounds of labelling.
CLEAN_WINDOWS, ROUNDS = 120_000, 3
RIDGE = 1.0
# Words of toxic windows that are pierced with letters to fit on, and clean words pierced for each of their forms.
PIERCED, PIERCED_CLEAN = 64, 4


def _symbol_table() -> np.ndarray:
    """Letters a to z as 1 to 26, other letters in five classes, all else 0."""
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        if chr(code).isalpha():
            table[code] = 27 + code % 5
    table[97:123] = np.arange(1, 27)
    return table


_SYMBOLS: list[np.ndarray] = []


def symbols(codes: np.ndarray) -> np.ndarray:
    """The letters of a text with 0 between its words.

    Other characters inside a word are dropped, and so are the spaces between single letters.
    """
    if not _SYMBOLS:
        _SYMBOLS.append(_symbol_table())
    every = _SYMBOLS[0][codes]
    at = np.flatnonzero(every)
    if not len(at):
        return np.zeros(0, np.uint8)
    blank = np.cumsum((codes <= 32) | (codes == 160))
    fresh = np.ones(len(at) + 1, bool)
    fresh[1:-1] = np.diff(blank[at]) > 0
    single = fresh[:-1] & fresh[1:]
    fresh[1:-1] &= ~(single[:-1] & single[1:])
    place = np.arange(len(at)) + np.cumsum(fresh[:-1])
    stream = np.zeros(place[-1] + 2, np.uint8)
    stream[place] = every[at]
    return stream


def window_starts(stream: np.ndarray) -> np.ndarray:
    """Where windows begin: in front of each word, and further on in long words."""
    gaps = np.flatnonzero(stream == 0)[:-1]
    lengths = np.diff(np.append(gaps, len(stream) - 1))
    starts = [gaps]
    more = STEP
    while (long := lengths > more + STEP).any():
        starts.append(gaps[long] + more)
        more += STEP
    return np.concatenate(starts)


def subsequences(stream: np.ndarray):
    """Per pattern the code of the subsequence that begins at each symbol, and its weight."""
    padded = np.concatenate([stream, np.zeros(REACH, np.uint8)]).astype(np.int32)
    n = len(stream)
    for a, b, c in PATTERNS:
        code = (
            padded[:n]
            | padded[a : a + n] << BITS
            | padded[b : b + n] << (2 * BITS)
            | padded[c : c + n] << (3 * BITS)
        )
        yield code, DECAY ** (c + 1)


def features(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and weights of a short string's subsequences; those across a gap only are left out."""
    codes, weights = [], []
    for code, weight in subsequences(stream):
        # The last symbol must be one of the string.
        ok = (code >> (3 * BITS)) > 0
        codes.append(code[ok])
        weights.append(np.full(ok.sum(), weight))
    codes, inverse = np.unique(np.concatenate(codes), return_inverse=True)
    return codes, np.bincount(inverse, np.concatenate(weights))


@dataclass(frozen=True)
class Machine:
    """Weights of subsequences, bias of a window, and the curve over a document's windows."""

    weights: np.ndarray
    bias: float
    curve: np.ndarray

    def windows(self, stream: np.ndarray) -> np.ndarray:
        """The decision for each window; above 0 speaks for toxic."""
        total = np.zeros(len(stream) + 1, np.float32)
        for code, weight in subsequences(stream):
            total[1:] += np.float32(weight) * self.weights[code]
        sums = np.cumsum(total, dtype=np.float64)
        starts = window_starts(stream)
        ends = np.minimum(starts + WINDOW, len(stream))
        return sums[ends] - sums[starts] + self.bias

    def score(self, codes: np.ndarray) -> float:
        z = float(summary(self.windows(symbols(codes)) if len(codes) else np.zeros(0)) @ self.curve)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def summary(decisions: np.ndarray) -> np.ndarray:
    """What a document's score depends on."""
    if not len(decisions):
        return np.array([1.0, -1.0, 0.0, 0.0, 0.0, 0.0])
    above = decisions[decisions > 0]
    n = len(decisions)
    return np.array(
        [
            1.0,
            np.clip(decisions.max(), -3, 3),
            np.log1p(len(above)),
            np.log1p(np.minimum(above, 2).sum()),
            min(10 * len(above) / n, 5),
            np.log1p(len(above)) - np.log1p(n),
        ]
    )


def _support_vectors(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A linear machine with squared hinge loss, by Newton's method in the primal.

    The last column of ``x`` is ones, for the bias.
    """
    w = np.zeros(x.shape[1])
    ridge = RIDGE * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        near = y * (x @ w) < 1
        h = (x[near] * weight[near, None]).T
        new = np.linalg.solve(ridge + h @ x[near], h @ y[near])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    ridge = 1e-2 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w
        )
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _word_list(stream: np.ndarray) -> list[bytes]:
    return stream.tobytes().strip(b"\0").split(b"\0")


def landmarks(streams: list[np.ndarray], toxic: np.ndarray) -> list[np.ndarray]:
    """Words most tied to toxic documents, and frequent words of clean ones, between gaps."""
    seen = {True: Counter(), False: Counter()}
    for stream, label in zip(streams, toxic):
        seen[bool(label)].update(set(_word_list(stream)))
    n, m = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))

    def tie(word):
        a, b = seen[True][word], seen[False][word]
        p = (a + b + 1) / (n + m + 2)
        return (a / n - b / m) / np.sqrt(p * (1 - p) * (1 / n + 1 / m))

    long = [w for w in seen[True] if len(w) >= 4]
    bad = sorted(long, key=lambda w: (-tie(w), w))[: LANDMARKS - PLAIN_LANDMARKS]
    rest = (w for w in seen[False] if len(w) >= 3 and w not in set(bad))
    plain = sorted(rest, key=lambda w: (-seen[False][w], w))[:PLAIN_LANDMARKS]
    gap = np.zeros(1, np.uint8)
    return [np.concatenate([gap, np.frombuffer(w, np.uint8), gap]) for w in bad + plain]


@dataclass(frozen=True)
class Map:
    """Nyström's map: kernels with the landmarks, made orthogonal."""

    index: np.ndarray
    phi: np.ndarray
    root: np.ndarray

    @classmethod
    def of(cls, marks: list[np.ndarray]) -> Map:
        parts = [features(mark) for mark in marks]
        codes = np.unique(np.concatenate([c for c, _ in parts]))
        phi = np.zeros((len(codes), len(marks)))
        for k, (c, w) in enumerate(parts):
            phi[np.searchsorted(codes, c), k] = w / np.sqrt((w * w).sum())
        index = np.full(CODES, -1, np.int32)
        index[codes] = np.arange(len(codes))
        values, vectors = np.linalg.eigh(phi.T @ phi)
        values = np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)
        return cls(index, phi, (vectors * values) @ vectors.T)

    def windows(self, stream: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The mapped windows that begin at ``starts``."""
        out = np.zeros((len(starts), self.phi.shape[1]))
        inside = starts[:, None] + np.arange(WINDOW)
        valid = inside < len(stream)
        inside = np.minimum(inside, len(stream) - 1)
        for code, weight in subsequences(stream):
            found = np.where(valid, self.index[code[inside]], -1)
            row, _ = hit = np.nonzero(found >= 0)
            np.add.at(out, row, weight * self.phi[found[hit]])
        return (out @ self.root).astype(np.float32)

    def table(self, w: np.ndarray) -> np.ndarray:
        """The weight of every subsequence in the decision."""
        weights = np.zeros(CODES, np.float32)
        known = np.flatnonzero(self.index >= 0)
        weights[known] = self.phi[self.index[known]] @ (self.root @ w)
        return weights


def pierced(word: np.ndarray, random: np.random.Generator) -> list[np.ndarray]:
    """A word's symbols with one letter inserted at each place, and with a letter at every place."""
    places = np.arange(1, len(word))
    one = [np.insert(word, [k], random.integers(1, 27)) for k in places]
    every = [np.insert(word, places, random.integers(1, 27, len(places))) for _ in range(len(places))]
    return [form.astype(np.uint8) for form in one + every]


def _word_at(stream: np.ndarray, start: int) -> np.ndarray:
    """The word behind the gap at ``start``."""
    rest = stream[start + 1 :]
    return rest[: int((rest == 0).argmax())]


def _pierced_windows(
    mapped: Map, bad: list[np.ndarray], starts: list[np.ndarray], picked: list[np.ndarray], clean: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Mapped windows of pierced words, those that toxic windows begin with and clean ones, before clean words."""
    random = np.random.default_rng(2)
    begun = Counter(
        _word_at(s, k).tobytes() for s, at, p in zip(bad, starts, picked) for k in at[p].tolist() if s[k] == 0
    )
    toxic = [np.frombuffer(w, np.uint8) for w, _ in begun.most_common(PIERCED) if len(w) >= 4]
    others = [np.frombuffer(w, np.uint8) for s in clean[:500] for w in _word_list(s) if len(w) >= 3 and w not in begun]
    if not toxic or not others:
        none = np.zeros((0, mapped.phi.shape[1]), np.float32)
        return none, none
    gap = np.zeros(1, np.uint8)

    def windows(forms: list[np.ndarray]) -> np.ndarray:
        behind = random.integers(0, len(others), (len(forms), 2))
        parts = [np.concatenate([gap, f, gap, others[i], gap, others[j]]) for f, (i, j) in zip(forms, behind.tolist())]
        starts = np.cumsum([0, *map(len, parts)])[:-1]
        return mapped.windows(np.concatenate([*parts, gap]), starts)

    forms = [form for word in toxic for form in pierced(word, random)]
    plain = [others[k] for k in random.integers(0, len(others), max(1, PIERCED_CLEAN * len(forms) // 8)).tolist()]
    return windows(forms), windows([form for word in plain for form in pierced(word, random)])


def train(texts: Iterable[np.ndarray], toxic: np.ndarray) -> Machine:
    """Fit on code points of labelled documents. Labels of one kind only give no toxic windows."""
    toxic = np.asarray(toxic, bool)
    streams = [symbols(t) if len(t) else np.zeros(0, np.uint8) for t in texts]
    held = [k for k, s in enumerate(streams) if len(s)]
    streams, labels = [streams[k] for k in held], toxic[held]
    base = np.log((toxic.sum() + 0.5) / ((~toxic).sum() + 0.5))
    silent = Machine(np.zeros(CODES, np.float32), -1.0, np.array([base, 0, 0, 0, 0, 0.0]))
    if not labels.any() or labels.all():
        return silent
    marks = landmarks(streams, labels)
    mapped = Map.of(marks)
    tied = {m.tobytes().strip(b"\0") for m in marks[: LANDMARKS - PLAIN_LANDMARKS]}
    per_doc = max(1, CLEAN_WINDOWS // max(1, int((~labels).sum())))
    chosen = np.random.default_rng(1)
    clean = [s for s, label in zip(streams, labels) if not label]
    good = np.concatenate(
        [mapped.windows(s, chosen.permutation(window_starts(s))[:per_doc]) for s in clean]
    )
    bad = [s for s, label in zip(streams, labels) if label]
    starts = [window_starts(s) for s in bad]
    picked = []
    for s, at in zip(bad, starts):
        listed = [w in tied for w in _word_list(s)]
        picked.append(np.array(listed + [False] * (len(at) - len(listed)), bool))
    for _ in range(ROUNDS):
        if not any(p.any() for p in picked):
            return silent
        # Only what is picked is mapped; the rest of the toxic documents is seen through the table.
        taken = np.concatenate([mapped.windows(s, at[p]) for s, at, p in zip(bad, starts, picked)])
        hidden, plain = _pierced_windows(mapped, bad, starts, picked, clean)
        x = np.ones((len(taken) + len(hidden) + len(good) + len(plain), good.shape[1] + 1), np.float32)
        x[:, :-1] = np.concatenate([taken, hidden, good, plain])
        y = np.repeat([1.0, -1.0], [len(taken) + len(hidden), len(good) + len(plain)])
        weight = np.where(y > 0, (y < 0).sum() / (y > 0).sum(), 1.0) ** 0.5
        w = _support_vectors(x, y, weight)
        fitted = Machine(mapped.table(w[:-1]), float(w[-1]), silent.curve)
        picked = [fitted.windows(s) > 0 for s in bad]
    rows = np.array([summary(fitted.windows(s)) for s in streams])
    return Machine(fitted.weights, fitted.bias, _logistic(rows, labels.astype(float)))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, text, toxic)`` of documents to learn from, outside the held-out part."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .where(~held_out())
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = known.where("toxic = 1").orderBy(*order).limit(TOXIC_DOCS)
    sample = sample.unionByName(known.where("toxic = 0").orderBy(*order).limit(CLEAN_DOCS))
    short = docs.select("doc_id", "text").where(F.length("text") <= LONGEST_DOC)
    return short.join(F.broadcast(sample), "doc_id")


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """The machine that a bounded sample of labelled documents teaches."""
    rows = labelled_sample(docs, labels).select("doc_id", F.lower("text").alias("text"), "toxic")
    rows = sorted(rows.collect(), key=lambda row: (row["doc_id"], row["text"]))
    texts = (np.frombuffer(r["text"].encode("utf-32-le"), np.uint32) for r in rows)
    return train(texts, np.array([r["toxic"] == 1 for r in rows], bool))


def scoring(machine: Machine, text: Column | None = None) -> Column:
    """The score of a text, from 0 to 1."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array([machine.score(codes) for codes in documents(column)], pa.float64())

    return score(F.lower(whole_text() if text is None else whole_text(text)))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    A NULL text is scored as an empty one, like a text without letters. A document's
    label is 1 if any of its labels is. Without labels of both kinds all scores are the same.
    Repeated rows are scored each; no documents give no rows.
    """
    scored = docs.select(
        "doc_id", held_out().alias("held_out"), scoring(fit(docs, labels)).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

"""Quality by attention over passages: multiple-instance learning from labels of documents.

A document is a bag of passages of 512 bytes. A passage is encoded by how often one kind of byte follows another (letters,
capitals, marks, ...) and how often its words repeat, through one learnt layer. Which passages tell the quality is not labelled: a gated attention,
``softmax(w . (tanh(V h) * sigmoid(U h)))`` over the passages of a document, is learnt from the documents' labels along
with the layer and the curve over the weighted representation.

Attention is a softmax, so parts of a long text are merged by their largest logit, sum of weights and weighted sum;
a text is never held as features whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import held_out, whole_text
from orderlake.llm.shingles import hashed_spans, pieces, raw_bytes, word_spans

PASSAGE = 512
# Bytes of text whose features are held at once.
BLOCK = 1 << 20
# The model is fitted on at most so many labelled documents of each label, none longer than this.
DOCS_PER_LABEL, LONGEST_DOC = 2500, 20_000
HIDDEN, GATE = 24, 12
EPOCHS, RATE, RIDGE = 300, 0.02, 1e-4

# Kinds of bytes; what is named nowhere is one more kind, and bytes beyond ASCII are another.
KINDS = [" ", "\n\r\t", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",;:", "!?", "#*$%&", "|<>", "'\"()-"]
N_KINDS = len(KINDS) + 2
PAIRS = N_KINDS * N_KINDS
# Successions of kinds, and how much of a passage are words that it has had before.
FEATURES = PAIRS + 1


def _kinds() -> np.ndarray:
    table = np.full(256, len(KINDS), np.uint8)
    for k, chars in enumerate(KINDS):
        table[[ord(c) for c in chars]] = k
    table[128:] = len(KINDS) + 1
    return table


KIND = _kinds()


def passage_starts(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where passages begin in rows between ``offsets``, and how many each row has; an empty row has one."""
    counts = np.maximum(-(-np.diff(offsets) // PASSAGE), 1)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(offsets[:-1], counts) + nth * PASSAGE, counts


def features(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Roots of the shares of byte kinds in succession, per passage of ``data`` that begins at ``starts``."""
    lengths = np.diff(np.append(starts, len(data)))
    if not len(data):
        return np.zeros((len(starts), FEATURES), np.float32)
    kind = KIND[data].astype(np.int64)
    code = kind[:-1] * N_KINDS + kind[1:] + np.repeat(np.arange(len(starts)) * PAIRS, lengths)[:-1]
    inside = np.ones(len(code), bool)
    # The last byte of a passage and the first of the next are no succession.
    last = starts[1:] - 1
    inside[last[(last >= 0) & (last < len(code))]] = False
    counts = np.bincount(code[inside], minlength=len(starts) * PAIRS).reshape(len(starts), PAIRS)
    shares = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    return np.column_stack([shares, _repeats(data, starts)]).astype(np.float32)


def _repeats(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of the words of each passage the share that it has had before."""
    begins, ends = word_spans(data, starts)
    owner = np.searchsorted(starts, begins, "right") - 1
    words = np.bincount(owner, minlength=len(starts))
    order = np.lexsort((hashes := hashed_spans(data, begins, ends), owner))
    owner, hashes = owner[order], hashes[order]
    again = (owner[1:] == owner[:-1]) & (hashes[1:] == hashes[:-1])
    return np.bincount(owner[1:][again], minlength=len(starts)) / np.maximum(words, 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


@dataclass(frozen=True)
class Model:
    """Layer ``(W, b)``, gate ``(V, U, w)`` and curve ``(c, d)``."""

    W: np.ndarray
    b: np.ndarray
    V: np.ndarray
    U: np.ndarray
    w: np.ndarray
    c: np.ndarray
    d: np.ndarray

    @classmethod
    def begin(cls, prior: float) -> Model:
        random = np.random.default_rng(7)

        def weights(*shape: int) -> np.ndarray:
            return random.normal(0, 1 / np.sqrt(shape[0]), shape)

        # Shares are small, so the first layer starts wide.
        return cls(
            3 * weights(FEATURES, HIDDEN),
            np.zeros(HIDDEN),
            weights(HIDDEN, GATE),
            weights(HIDDEN, GATE),
            weights(GATE),
            np.zeros(HIDDEN),
            np.array([prior]),
        )

    def passages(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Representation and attention logit of each passage."""
        h = np.tanh(x @ self.W + self.b)
        return h, (np.tanh(h @ self.V) * _sigmoid(h @ self.U)) @ self.w

    def bags(self, x: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest logit, sum of weights and weighted sum of each bag, in units of the largest."""
        h, logit = self.passages(x)
        first = np.cumsum(counts) - counts
        top = np.maximum.reduceat(logit, first)
        weight = np.exp(logit - np.repeat(top, counts))
        return top, np.add.reduceat(weight, first), np.add.reduceat(weight[:, None] * h, first, axis=0)

    def curve(self, z: np.ndarray) -> np.ndarray:
        return _sigmoid(z @ self.c + self.d[0])


def _gradient(model: Model, x: np.ndarray, counts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
    """Gradient of the weighted logistic loss, by the chain rule from the curve back to the layer."""
    first, owner = np.cumsum(counts) - counts, np.repeat(np.arange(len(counts)), counts)
    h = np.tanh(x @ model.W + model.b)
    t, s = np.tanh(h @ model.V), _sigmoid(h @ model.U)
    logit = (t * s) @ model.w
    a = np.exp(logit - np.maximum.reduceat(logit, first)[owner])
    a /= np.add.reduceat(a, first)[owner]
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    error = weight * (model.curve(z) - y)
    dz = error[:, None] * model.c
    da = (dz[owner] * h).sum(1)
    dlogit = a * (da - np.add.reduceat(a * da, first)[owner])
    dg = dlogit[:, None] * model.w
    dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
    dh = a[:, None] * dz[owner] + dt @ model.V.T + ds @ model.U.T
    dp = dh * (1 - h * h)
    return Model(x.T @ dp, dp.sum(0), h.T @ dt, h.T @ ds, (t * s).T @ dlogit, z.T @ error, np.array([error.sum()]))


def train(bags: list[np.ndarray], good: np.ndarray, weight: np.ndarray) -> Model:
    """Fit on the passage features of documents; labels of one kind only give their prior."""
    good = np.asarray(good, float)
    share = float((weight * good).sum() / weight.sum()) if len(good) else 0.5
    model = Model.begin(float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    if not 0 < good.sum() < len(good):
        return model
    x, counts = np.concatenate(bags).astype(np.float64), np.array([len(b) for b in bags])
    weight = weight / weight.sum()
    names = [f.name for f in fields(Model)]
    mean = {n: 0.0 for n in names}
    spread = {n: 0.0 for n in names}
    for step in range(1, EPOCHS + 1):
        slope = _gradient(model, x, counts, good, weight)
        made = {}
        for n in names:
            value = getattr(model, n)
            g = getattr(slope, n) + (RIDGE * value if n in "WVUc" else 0)
            mean[n] = 0.9 * mean[n] + 0.1 * g
            spread[n] = 0.99 * spread[n] + 0.01 * g * g
            move = (mean[n] / (1 - 0.9**step)) / (np.sqrt(spread[n] / (1 - 0.99**step)) + 1e-8)
            made[n] = value - RATE * move
        model = Model(**made)
    return model


TAUGHT = "good int, weight double, passages binary"


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = raw_bytes(batch["text"])
        made = []
        for a, b in zip(offsets, offsets[1:]):
            made.append(features(data[a:b], passage_starts(np.array([0, b - a]))[0]).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch["good"], batch["weight"], pa.array(made, pa.binary())], ["good", "weight", "passages"]
        )


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(text, good, weight)`` of documents to learn from, outside the held-out part.

    Of each label the first ``DOCS_PER_LABEL`` documents by a hash of their id; ``weight`` makes up for what is left out.
    """
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("good"))
        .where(~held_out())
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    totals = {r["good"]: r["n"] for r in known.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [
        known.where(F.col("good") == good)
        .orderBy(*order)
        .limit(DOCS_PER_LABEL)
        .withColumn("weight", F.lit(totals.get(good, 0) / max(1, min(totals.get(good, 0), DOCS_PER_LABEL))))
        for good in (0, 1)
    ]
    short = docs.select("doc_id", "text").where(F.length("text") <= LONGEST_DOC)
    return short.join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id").select("text", "good", "weight")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model that a bounded sample of labelled documents teaches; only features of passages reach the driver."""
    rows = labelled_sample(docs, labels).mapInArrow(_featured, TAUGHT).collect()
    rows = sorted(rows, key=lambda r: (bytes(r["passages"]), r["good"]))
    bags = [np.frombuffer(r["passages"], np.float32).reshape(-1, FEATURES) for r in rows]
    return train(bags, np.array([r["good"] for r in rows]), np.array([r["weight"] for r in rows]))


def _long(model: Model, text: np.ndarray) -> tuple[float, int]:
    """Score of one text, a block at a time, and the passage with the most attention."""
    top, total, z, best = -np.inf, 0.0, np.zeros(HIDDEN), 0
    step = BLOCK // PASSAGE * PASSAGE
    for first in range(0, max(len(text), 1), step):
        data = text[first : first + step]
        x = features(data, passage_starts(np.array([0, len(data)]))[0])
        (m,), (n,), (s,) = model.bags(x, np.array([len(x)]))
        if m > top:
            best = first // PASSAGE + int(model.passages(x)[1].argmax())
        high = max(top, m)
        total, z = total * np.exp(top - high) + n * np.exp(m - high), z * np.exp(top - high) + s * np.exp(m - high)
        top = high
    return float(model.curve(z / total)), best


def scores(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score and most attended passage of each row of UTF-8 ``data``."""
    score, best = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1, np.int64)
    for first, last in pieces(offsets, BLOCK):
        part = data[offsets[first] : offsets[last]]
        if last - first == 1:
            score[first], best[first] = _long(model, part)
            continue
        starts, counts = passage_starts(offsets[first : last + 1] - offsets[first])
        # Empty rows take no bytes: their passage gets none, as the next one begins at the same place.
        x = features(part, starts)
        _, total, z = model.bags(x, counts)
        score[first:last] = model.curve(z / total[:, None])
        logit, begin = model.passages(x)[1], np.cumsum(counts) - counts
        best[first:last] = [logit[i : i + n].argmax() for i, n in zip(begin.tolist(), counts.tolist())]
    return score, best


def scoring(model: Model, text: Column) -> Column:
    """``(score, top_passage)`` of a text."""

    @F.arrow_udf("score double, top_passage long")
    def scored(column: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(list(map(pa.array, scores(model, *raw_bytes(column)))), ["score", "top_passage"])

    return scored(whole_text(text))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score (1 for good) and ``top_passage``, the passage attended to most, from 0.

    A NULL text is an empty one, and that is one passage without bytes. A document's label is 1 if any of its labels is.
    Without labels of both kinds every score is the share of good ones (0.5 without any). Repeated rows are scored each; no
    documents give no rows. Long texts are read to their end, a block at a time.
    """
    found = scoring(fit(docs, labels), F.col("text")).alias("found")
    return docs.select("doc_id", held_out().alias("held_out"), found).select("doc_id", "held_out", "found.*")

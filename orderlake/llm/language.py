"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams of a language in order. A document's own
list is compared to each profile: every n-gram counts how far out of place it
is, an n-gram that the profile lacks counts the length of the profile. The language with
the smallest sum is predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import held_out, whole_text
from orderlake.llm.shingles import pieces, raw_bytes

# Letters per n-gram, and n-grams per profile and document.
LONGEST = 3
PROFILE = 400
UNKNOWN = "und"
# Profiles are fitted on at most about this many documents of each language.
SAMPLE_DOCS = 4000
# Documents of the pipeline that resemble no language even this much are rejected.
LEAST_SCORE = 0.05

_BITS = 21
_GAP = 32
PREDICTION = "struct<lang_pred: string, score: double>"
COUNTS = "lang string, code long, n long"


@lru_cache(1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _grams(codes: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of a document's words, which are padded with gaps."""
    letter = _letters()[codes]
    stream = np.where(letter, codes, _GAP).astype(np.int64)
    padded = np.concatenate([[_GAP], stream, [_GAP]])
    word = padded != _GAP
    padded = padded[word | np.concatenate([[True], word[:-1]])]
    word = padded != _GAP
    made = [padded[word]]
    code, inner = padded, word
    for n in range(2, LONGEST + 1):
        code = code[:-1] | padded[n - 1 :] << (_BITS * (n - 1))
        # Gaps only stand at the ends, and not alone.
        whole = word[: len(code)] | word[n - 1 :] if n == 2 else np.ones(len(code), bool)
        for k in range(1, n - 1):
            whole &= word[k : k + len(code)]
        made.append(code[whole])
    return np.concatenate(made)


def documents(column: pa.Array) -> Iterator[np.ndarray]:
    """Code points of each row of a text column without NULLs."""
    data, offsets = raw_bytes(column)
    for first, last in pieces(offsets):
        part = data[offsets[first] : offsets[last]]
        codes = np.frombuffer(part.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
        starts = at[offsets[first : last + 1] - offsets[first]].tolist()
        yield from (codes[a:b] for a, b in zip(starts, starts[1:]))


def ranked(grams: np.ndarray) -> np.ndarray:
    """The most frequent n-grams in order; equal counts in the order of their codes."""
    codes, counts = np.unique(grams, return_counts=True)
    return codes[np.argsort(-counts, kind="stable")[:PROFILE]]


@dataclass(frozen=True)
class Profiles:
    """All n-grams of all profiles, ascending, and their rank in each language."""

    langs: list[str]
    codes: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, ordered: dict[str, list[int]]) -> Profiles:
        langs = sorted(ordered)
        codes = np.unique(np.array([c for lang in langs for c in ordered[lang]], np.int64))
        ranks = np.full((len(codes), len(langs)), PROFILE, np.int64)
        for k, lang in enumerate(langs):
            ranks[np.searchsorted(codes, ordered[lang]), k] = np.arange(len(ordered[lang]))
        return cls(langs, codes, ranks)

    def predict(self, text: np.ndarray) -> tuple[str, float]:
        own = ranked(_grams(text)) if len(text) else np.zeros(0, np.int64)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        known = self.codes[at] == own
        apart = np.abs(self.ranks[at[known]] - np.flatnonzero(known)[:, None])
        apart = np.minimum(apart, PROFILE).sum(0) + PROFILE * (~known).sum()
        best = int(np.argmin(apart))
        return self.langs[best], 1 - float(apart[best]) / (PROFILE * len(own))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), documents(batch.column("text"))):
            if len(text):
                found.setdefault(lang, []).append(_grams(text))
        for lang, parts in found.items():
            codes, counts = np.unique(np.concatenate(parts), return_counts=True)
            columns = [pa.array([lang] * len(codes)), pa.array(codes), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "code", "n"])


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Profiles:
    """Profiles from (doc_id, text, lang) of documents outside the held-out part.

    Rows without a language teach nothing. From a language with more than
    ``sample_docs`` documents about that many are taken, by a hash of the id.
    """
    taught = docs.select("doc_id", "text", "lang").where(
        ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    share = F.least(F.lit(sample_docs) / F.count(F.lit(1)), F.lit(1.0)).alias("share")
    shares = taught.groupBy("lang").agg(share)
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("share") * 1_000_000
    sample = taught.join(F.broadcast(shares), "lang").where(drawn)
    counts = (
        sample.select("lang", F.lower("text").alias("text"))
        .mapInArrow(_counted, COUNTS)
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
    )
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    ordered: dict[str, list[int]] = {}
    best = counts.withColumn("rank", order).where(F.col("rank") <= PROFILE)
    for row in sorted(best.collect(), key=lambda row: row["rank"]):
        ordered.setdefault(row["lang"], []).append(row["code"])
    return Profiles.of(ordered)


def prediction(profiles: Profiles, text: Column | None = None) -> Column:
    """``(lang_pred, score)`` of a text; score is 1 where the profile's order is met exactly."""

    @F.arrow_udf(PREDICTION)
    def predict(column: pa.Array) -> pa.Array:
        found = [profiles.predict(text) for text in documents(column)]
        return pa.StructArray.from_arrays(
            [
                pa.array([lang for lang, _ in found], pa.string()),
                pa.array([score for _, score in found], pa.float64()),
            ],
            ["lang_pred", "score"],
        )

    return predict(F.lower(whole_text() if text is None else whole_text(text)))


def identify(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    A text that is NULL or has no letter is ``und`` with score 0, and so is
    every text when no document teaches a language. Of languages equally near the
    first by name is predicted. No documents give no rows.
    """
    found = prediction(fit(docs, sample_docs)).alias("found")
    return docs.select("doc_id", held_out().alias("held_out"), found).select(
        "doc_id", "held_out", "found.lang_pred", "found.score"
    )


def in_known_language(
    docs: DataFrame, least_score: float = LEAST_SCORE, sample_docs: int = SAMPLE_DOCS
) -> DataFrame:
    """``docs`` with all its columns, without texts in no language that its documents teach."""
    found = prediction(fit(docs, sample_docs))
    return docs.where((found["lang_pred"] != UNKNOWN) & (found["score"] >= least_score))

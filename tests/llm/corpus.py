"""Small corpora for the tests of the corpus operators."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; none may get in the way.
CLASHES = (
    "copies bucket kept digest size rank label node id ids n h score m row part stack key spans base words share"
).split()


def corpus(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*row, *("en", "s")[len(row) - 2 :])[:4] for row in rows]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], COLUMNS)


def odd(spark: SparkSession) -> DataFrame:
    """NULLs in every column, empty and blank texts, ties, repeated rows, a long text, clashing columns."""
    prose = "the quick brown fox jumps over the lazy dog and runs away from it. "
    rows = [
        (None, None, None, None),
        (None, "lost words without an id", "en", "a"),
        (1, None, "en", "a"),
        (2, "", None, "b"),
        (3, " \t\n", "en", None),
        (4, prose, "en", "a"),
        (4, prose, "en", "a"),
        (4, "another text under the same id, which is longer than the first one", "en", "a"),
        (5, prose, "en", "b"),
        (6, prose.upper(), "en", "b"),
        (7, prose * 4000, "en", "a"),
        (8, "données françaises et été", "fr", "c"),
        (9, "日本語テキスト 🎉", "ja", "c"),
        (10, "1234 5678 !!", "en", "a"),
        (-5, prose + "x", "en", "a"),
    ]
    df = corpus(spark, rows)
    for name in CLASHES:
        df = df.selectExpr("*", f"doc_id as {name}")
    return df


def empty(spark: SparkSession) -> DataFrame:
    return odd(spark).where("false")


def shingles(text: str | None) -> set[tuple[str, ...]]:
    small = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = WORD.findall(small)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def key(value) -> tuple:
    return (value is not None, value)

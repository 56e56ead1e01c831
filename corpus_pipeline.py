"""A corpus pipeline of five stages over ``documents``.

Each stage works on what the one before it wrote. The first four return the
columns of documents, the last one the encoded documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.common import Work
from orderlake.llm.exact_dedup import without_duplicates
from orderlake.llm.language import in_known_language
from orderlake.llm.mixing import mixed
from orderlake.llm.near_dedup import without_near_duplicates
from orderlake.llm.pieces import Pieces, encode
from orderlake.llm.queries import PIECES, table, tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled documents teach."""
    return in_known_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return without_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the one with the smallest id."""
    return without_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares; a document is repeated as often as it is taken."""
    return mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model's own piece ids of each document in place of its text; of other columns lang and source stay."""
    found = encode(docs.select("doc_id", "text", "lang", "source"), Pieces.of_file(tokenizer_file(PIECES)))
    return found.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids_crc32", "ids"
    )


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("mixture", mixture),
    ("encoded", encoded),
]

# Profiles, sketches and piece ids are not SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written before the next begins."""
    work = Work(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

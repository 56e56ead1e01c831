"""Exact duplicates of a new batch against an immutable snapshot, and within the batch.

A snapshot keeps one row per distinct digest in buckets and a binary fuse filter
per shard of digests. A batch is grouped by digest first, which settles its own
duplicates. The filters then screen what is left; negatives are new for sure
and go no further. Positives join the exact buckets, which removes the
filter's false positives. Texts are compared byte by byte in every class with more than one
row, and a class whose digest hides different texts is split by text.

Only digests and ids are shuffled by digest. Texts move for the byte check alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.binary_fuse import BinaryFuse, build
from orderlake.llm.common import Work, whole_text

# Distinct digests per filter; what one task holds at once.
KEYS_PER_SHARD = 4096
# Into so many parts the rows of one digest are dealt for the byte check.
PARTS = 32

FILTER = "shard long, seed int, segment int, segments int, prints binary"
SCREENED = "digest binary, n long, top long, positive boolean"

Digest = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


@dataclass(frozen=True)
class Snapshot:
    """Immutable: ``buckets`` has (digest, n, top), ``filters`` a filter per shard of them."""

    buckets: DataFrame
    filters: DataFrame
    shards: int


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards))


def _grouped(rows: DataFrame) -> DataFrame:
    """``(digest, n, top)`` per digest; rows come with their number of repetitions."""
    return rows.groupBy("digest").agg(F.sum("copies").alias("n"), F.max("doc_id").alias("top"))


def _build_filter(pdf: pd.DataFrame) -> pd.DataFrame:
    made = build(pdf["key"].to_numpy().astype(np.uint64))
    return pd.DataFrame(
        {
            "shard": [pdf["shard"].iloc[0]],
            "seed": [made.seed],
            "segment": [made.segment],
            "segments": [made.segments],
            "prints": [made.prints.tobytes()],
        }
    )


def _screen(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    positive = np.zeros(len(batch), bool)
    for row in filters.itertuples():
        prints = np.frombuffer(row.prints, np.uint8)
        known = BinaryFuse(row.seed, row.segment, row.segments, prints)
        positive |= known.contains(batch["key"].to_numpy().astype(np.uint64))
    return batch[["digest", "n", "top"]].assign(positive=positive)


def take_snapshot(rows: DataFrame, work: Work) -> Snapshot:
    """Group ``(doc_id, digest, copies)`` rows into buckets and build their filters."""
    buckets = work.table(_grouped(rows), "buckets")
    shards = max(1, -(-buckets.count() // KEYS_PER_SHARD))
    keyed = buckets.select(_shard(shards).alias("shard"), F.xxhash64("digest").alias("key"))
    filters = keyed.distinct().groupBy("shard").applyInPandas(_build_filter, FILTER)
    return Snapshot(buckets, work.table(filters, "filters"), shards)


def classes(snapshot: Snapshot, batch: DataFrame, work: Work) -> DataFrame:
    """``(digest, n, top)`` of snapshot and batch together."""
    fresh = _grouped(batch).withColumns(
        {"shard": _shard(snapshot.shards), "key": F.xxhash64("digest")}
    )
    screened = work.table(
        fresh.groupBy("shard")
        .cogroup(snapshot.filters.groupBy("shard"))
        .applyInPandas(_screen, SCREENED),
        "screened",
    )
    new = screened.where(~F.col("positive")).drop("positive")
    again = screened.where("positive").select(
        "digest", F.col("n").alias("n2"), F.col("top").alias("top2")
    )
    met = snapshot.buckets.join(again, "digest", "full_outer").select(
        "digest",
        (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n"),
        F.greatest("top", "top2").alias("top"),
    )
    return met.unionByName(new)


def _mixed_digests(docs: DataFrame, repeated: DataFrame, digest: Digest) -> DataFrame:
    """Digests under which the bytes of the texts differ. Equal texts combine before the shuffle."""
    dealt = repeated.select("digest", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    text = whole_text()
    return (
        docs.select(
            digest(text).alias("digest"),
            F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int").alias("part"),
            text.alias("text"),
        )
        .join(dealt, ["digest", "part"], "left_semi")
        .groupBy("digest")
        .agg(F.min("text").alias("low"), F.max("text").alias("high"))
        .where(F.col("low") != F.col("high"))
        .select("digest")
    )


def exact_groups(
    docs: DataFrame,
    digest: Digest = sha256,
    in_snapshot: Column | None = None,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest.

    The row with the largest doc_id stays; NULL is smaller than any id. Of
    rows that repeat both id and text one is kept. NULL texts are empty texts, and
    those are equal. No documents give no rows. ``in_snapshot`` tells which rows
    form the snapshot, a half by id unless given; the classes do not depend on it.
    """
    work = Work(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    if in_snapshot is None:
        in_snapshot = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    rows = work.table(
        docs.select("doc_id", digest(whole_text()).alias("digest"))
        .groupBy("doc_id", "digest")
        .agg(F.count(F.lit(1)).alias("copies")),
        "rows",
    )
    snapshot = take_snapshot(rows.where(in_snapshot), work)
    joined = classes(snapshot, rows.where(~F.coalesce(in_snapshot, F.lit(False))), work)
    known = work.table(joined, "classes")
    mixed = work.table(_mixed_digests(docs, known.where("n > 1"), digest), "mixed")
    plain = _placed(rows, known.join(mixed, "digest", "left_anti"), ["digest"])
    if mixed.isEmpty():
        return plain
    return plain.unionByName(_by_text(docs, mixed, digest))


def _by_text(docs: DataFrame, mixed: DataFrame, digest: Digest) -> DataFrame:
    """The same for digests that different texts share: the text itself is the class."""
    text = whole_text()
    rows = (
        docs.select("doc_id", digest(text).alias("digest"), text.alias("text"))
        .join(mixed, "digest", "left_semi")
        .groupBy("doc_id", "digest", "text")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    known = rows.groupBy("digest", "text").agg(
        F.sum("copies").alias("n"), F.max("doc_id").alias("top")
    )
    return _placed(rows, known, ["digest", "text"])


def _placed(rows: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return (
        rows.join(known, key)
        .select("doc_id", "top", "n", "digest", copy)
        .select(
            "doc_id",
            F.col("top").alias("keep_id"),
            F.col("n").alias("group_size"),
            (F.col("doc_id").eqNullSafe(F.col("top")) & (F.col("copy") == 1)).alias("kept"),
            "digest",
        )
    )


def without_duplicates(docs: DataFrame, digest: Digest = sha256) -> DataFrame:
    """``docs`` with all its columns, one row of each group of equal texts."""
    groups = exact_groups(docs, digest)
    stays = groups.where("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("digest").alias("_kept_digest")
    )
    twice = groups.where(
        F.col("doc_id").eqNullSafe(F.col("keep_id")) & ~F.col("kept")
    ).select(F.col("doc_id").alias("_kept_id"), F.col("digest").alias("_kept_digest")).distinct()

    def same():
        return F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (
            digest(whole_text()) == F.col("_kept_digest")
        )

    left = docs.join(stays, same(), "left_semi")
    if twice.isEmpty():
        return left
    once = left.join(twice, same(), "left_semi").withColumn("_text", whole_text())
    return left.join(twice, same(), "left_anti").unionByName(
        once.dropDuplicates(["doc_id", "_text"]).drop("_text")
    )

"""Mix sources to target weights by Pareto order sampling.

Every document of a source first gets the whole copies that its source's share makes
certain. The rest of the target is drawn: documents are ordered by the odds of
a random number over the odds of their inclusion probability, and taken from the
smallest on until the source has its words. The sample size is thus fixed, in
words. Which documents are drawn follows from their ids alone.

The cut in the order is found without sorting a source: words are summed by
bucket of the order, and only the rows of the bucket with the cut are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import Work, count_words, whole_text

WEIGHTS = (3, 1, 2)
# Words of the mix per word of the input, and of a source's target per word of the source.
TOTAL, MOST = 1.5, 2
BUCKETS = 1 << 14
# Inclusion probabilities stay this far from 0 and 1, which have no odds.
EDGE = 1e-9
_DIGITS = 13
_FIRST_ID = -(2**63)


def chance(doc_id: str = "doc_id") -> Column:
    """A number between 0 and 1 that only depends on the id."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    drawn = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long")
    return (drawn + F.lit(0.5)) / F.lit(float(16**_DIGITS))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL) -> DataFrame:
    """``(source, source_size, target)``; one row per source in, and few sources.

    Sources in the order of their code points, NULL last, weigh ``weights`` in turn. A target
    stops at ``MOST`` times its source, and the others share the excess by weight
    until none is above. By ascending ratio of limit to weight, a source is at its
    limit as long as what is left for it and the later ones covers its limit.
    """
    weight = F.element_at(
        F.array(*map(F.lit, weights)), ((F.col("nth") - 1) % len(weights) + 1).cast("int")
    )
    nth = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    ranked = sizes.withColumn("nth", nth).withColumn("weight", weight)
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "nth")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = F.col("source_size") * MOST
    left = F.sum("source_size").over(every) * total - F.coalesce(F.sum(limit).over(before), F.lit(0))
    level = ranked.withColumn("level", left / F.sum("weight").over(after))
    full = limit <= F.col("level") * F.col("weight")
    first = F.min(F.when(~full, F.struct("nth_limit", "level"))).over(every)["level"]
    return (
        level.withColumn("nth_limit", F.row_number().over(order))
        .withColumn("first", first)
        .select(
            "source",
            "source_size",
            F.when(full | F.col("first").isNull(), limit.cast("double"))
            .otherwise(F.col("first") * F.col("weight"))
            .alias("target"),
        )
    )


def _copies_and_rest() -> dict[str, Column]:
    """Certain copies of each document of a source, and the words that are left to draw."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(ratio), F.lit(MOST))
    return {"whole": whole, "rest": F.col("target") - whole * F.col("source_size")}


def _odds_of_inclusion(preference: Column) -> Column:
    size = F.greatest(F.col("source_size"), F.lit(1)).cast("double")
    share = F.col("rest") / size * preference
    share = F.least(F.greatest(share, F.lit(EDGE)), F.lit(1 - EDGE))
    return share / (1 - share)


def _rank(preference: Column) -> Column:
    """Odds of the random number over odds of inclusion; small ranks are drawn first."""
    u = chance()
    return u / (1 - u) / _odds_of_inclusion(preference)


def _bucket() -> Column:
    """Rises with the rank, and spreads the documents of any source over all buckets."""
    odds = F.col("rank") * _odds_of_inclusion(F.lit(1.0))
    return F.floor(odds / (odds + 1) * BUCKETS)


def _own_order() -> list[Column]:
    return [F.col("rank"), F.coalesce("doc_id", F.lit(_FIRST_ID)), F.col("size")]


def _cuts(ranked: DataFrame) -> DataFrame:
    """Per source the last document drawn, as ``(cut_rank, cut_id, cut_size)``."""
    source = ["source", "rest"]
    sums = ranked.groupBy(*source, "bucket").agg(F.sum("size").alias("words"))
    running = Window.partitionBy(*source).orderBy("bucket")
    crossed = (
        sums.withColumn("until", F.sum("words").over(running))
        .withColumn("before", F.col("until") - F.col("words"))
        .where((F.col("before") < F.col("rest")) & (F.col("until") >= F.col("rest")))
        .select(F.col("source").alias("its"), F.col("bucket").alias("at"), "before")
    )
    near = ranked.join(
        crossed, F.col("source").eqNullSafe(F.col("its")) & (F.col("bucket") == F.col("at"))
    )
    own = Window.partitionBy(*source).orderBy(*_own_order())
    until = F.col("before") + F.sum("size").over(own)
    # The document on the cut is drawn when that brings the sum nearer to the target.
    drawn = F.col("until") - F.col("rest") <= F.col("rest") - (F.col("until") - F.col("size"))
    names = ("cut_rank", "cut_id", "cut_size")
    order = F.struct(*(c.alias(n) for c, n in zip(_own_order(), names)))
    last = near.withColumn("until", until).groupBy("source").agg(
        F.max(F.when(drawn, order)).alias("cut"), F.min(F.col("at")).alias("cut_bucket")
    )
    return last.select(F.col("source").alias("its"), "cut_bucket", *(f"cut.{n}" for n in names))


def plan(rows: DataFrame, work: Work, weights: Sequence[int] = WEIGHTS, total: float = TOTAL):
    """What decides about the documents of each source, from (doc_id, source, size, preference)."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = work.table(targets(sizes, weights, total).withColumns(_copies_and_rest()), "shares")
    ranked = _with_shares(rows, shares).withColumn("rank", _rank(F.col("preference")))
    cuts = work.table(_cuts(ranked.withColumn("bucket", _bucket())), "cuts")
    joined = shares.join(cuts, F.col("source").eqNullSafe(F.col("its")), "left").drop("its")
    return work.table(joined, "plan")


def _with_shares(rows: DataFrame, shares: DataFrame) -> DataFrame:
    its = shares.withColumnRenamed("source", "share_source")
    return rows.join(its, F.col("source").eqNullSafe(F.col("share_source"))).drop("share_source")


def copies() -> Column:
    """How often a row of a source with its plan is taken."""
    earlier = F.col("bucket") < F.col("cut_bucket")
    cut = F.struct("cut_rank", "cut_id", "cut_size")
    names = ("cut_rank", "cut_id", "cut_size")
    own = F.struct(*(c.alias(n) for c, n in zip(_own_order(), names)))
    at_cut = (F.col("bucket") == F.col("cut_bucket")) & F.col("cut_rank").isNotNull() & (own <= cut)
    drawn = (F.col("rest") > 0) & F.coalesce(earlier | at_cut, F.lit(False))
    return F.col("whole") + drawn.cast("long")


def decided(rows: DataFrame, planned: DataFrame) -> DataFrame:
    ranked = _with_shares(rows, planned).withColumn("rank", _rank(F.col("preference")))
    return ranked.withColumn("bucket", _bucket()).withColumn("copies", copies())


def _rows(docs: DataFrame, preference: str | None) -> DataFrame:
    wanted = F.coalesce(F.col(preference), F.lit(1.0)) if preference else F.lit(1.0)
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        count_words(whole_text()).alias("size"),
        wanted.cast("double").alias("preference"),
    )


def mix(docs: DataFrame, preference: str | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies.

    ``taken`` are the words of all copies of the document, at most twice its size.
    ``preference`` names a column that multiplies inclusion probabilities (NULL: 1).
    Documents without a source form a source of their own; NULL texts have no words. Rows with
    one id, source and size are drawn or left together. No rows give no rows.
    """
    work = Work(docs.sparkSession)
    rows = work.table(_rows(docs, preference), "rows")
    return decided(rows, plan(rows, work)).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies",
    )


def mixed(docs: DataFrame, preference: str | None = None) -> DataFrame:
    """``docs`` with all its columns, each row as often as the mix takes it."""
    work = Work(docs.sparkSession)
    rows = work.table(_rows(docs, preference), "rows")
    planned = plan(rows, work)
    inputs = [c for c in (preference,) if c]
    kept = docs.select(F.struct(*docs.columns).alias("doc"))
    flat = kept.select(
        "doc",
        F.col("doc.doc_id").alias("doc_id"),
        F.col("doc.source").cast("string").alias("source"),
        count_words(whole_text(F.col("doc.text"))).alias("size"),
        (F.coalesce(F.col(f"doc.{inputs[0]}"), F.lit(1.0)) if inputs else F.lit(1.0))
        .cast("double")
        .alias("preference"),
    )
    taken = decided(flat, planned).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc.*"
    )

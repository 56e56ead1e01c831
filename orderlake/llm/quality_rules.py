"""Quality rules with thresholds that follow each language and source.

Counts of a text are computed within its row. The distribution of each measure, per
language and source, is kept as a sketch of logarithmic buckets: counts add up, so
sketches of parts merge to that of the whole, and a quantile is right within one
per cent. Thresholds come from the quartiles of a group, from those of its language where the group
is small, and from all documents where the language is small too.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import SPACES, Work, bound, whole_text, words

SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
WINDOW = 3

# Ratio of neighbouring bucket limits of a sketch.
GAMMA = 1.02
ZERO = -(10**6)
# Documents that a group needs for thresholds of its own.
LEAST_GROUP = 200
# Thresholds lie so many quartile distances outside the quartiles, and at least so far.
FENCES = 6.0
MARGINS = {"word_length": 3.0, "symbols": 0.15, "dup_lines": 0.3, "repeats": 0.3}


def _repeated_words(values: Column) -> Column:
    """Words in windows that occur twice or more, from the words of a text."""

    def windows(w):
        return F.transform(
            F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
            lambda i: F.xxhash64(*(F.element_at(w, i + k) for k in range(WINDOW))),
        )

    def positions(hashes):
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return bound(placed, _twice)

    def covered(at):
        # Each position reaches over the window, but not beyond the next position.
        reach = F.transform(
            at,
            lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)),
        )
        return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

    def repeated(hashes):
        every = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(every, 0).otherwise(bound(positions(hashes), covered))

    def count(w):
        return F.when(F.size(w) <= WINDOW, 0).otherwise(bound(windows(w), repeated))

    return count(values)


def _twice(placed: Column) -> Column:
    """Positions, ascending, of the hashes that a neighbour in the order shares."""

    def same(k, h):
        return F.coalesce(F.get(placed, k)["h"] == h, F.lit(False))

    hit = F.transform(
        placed, lambda s, k: F.when(same(k - 1, s["h"]) | same(k + 1, s["h"]), s["i"])
    )
    return F.array_sort(F.filter(hit, lambda i: i.isNotNull()))


def counts(text: Column) -> Column:
    """``(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)`` of a text."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(F.translate(line, SPACES, " " * 6)) != "")

    def of_words(w):
        return F.struct(F.size(w).cast("long").alias("n_words"), _repeated_words(w).cast("long").alias("n_repeat_words"))

    def of_lines(held):
        n = F.size(held)
        return F.struct(
            n.cast("long").alias("n_lines"),
            (n - F.size(F.array_distinct(held))).cast("long").alias("n_dup_lines"),
        )

    return F.struct(
        bound(words(text), of_words).alias("of_words"),
        bound(lines, of_lines).alias("of_lines"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )


def measured(docs: DataFrame) -> DataFrame:
    """The counts of each document, and whether it fails the fixed rules."""
    flat = docs.select(
        "doc_id",
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        counts(whole_text()).alias("c"),
    ).select(
        "doc_id", "lang", "source", "c.of_words.*", "c.of_lines.*", "c.word_chars", "c.n_symbols"
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return flat.withColumn("base_failed", failed)


def measures() -> dict[str, Column]:
    """What has thresholds: measures of a document that does not depend on its length."""
    n_words = F.greatest("n_words", F.lit(1)).cast("double")
    return {
        "word_length": F.col("word_chars") / n_words,
        "symbols": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)).cast("double"),
        "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)).cast("double"),
        "repeats": F.col("n_repeat_words") / n_words,
    }


def sketches(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(*by, measure, bucket, n)``: the sketch of every measure in every group."""
    pairs = [
        F.struct(F.lit(name).alias("measure"), value.alias("value"))
        for name, value in measures().items()
    ]
    bucket = F.when(F.col("m.value") <= 0, F.lit(ZERO)).otherwise(
        F.ceil(F.log(F.col("m.value")) / F.lit(math.log(GAMMA)))
    )
    return (
        rows.select(*by, F.explode(F.array(*pairs)).alias("m"))
        .groupBy(*by, F.col("m.measure").alias("measure"), bucket.cast("long").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merged(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of larger groups from those of their parts."""
    return parts.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(*by, size, <measure>_low, <measure>_high)`` from sketches."""
    group = Window.partitionBy(*by, "measure")
    until = F.sum("n").over(group.orderBy("bucket"))
    total = F.sum("n").over(group)
    value = F.when(F.col("bucket") == ZERO, 0.0).otherwise(
        F.lit(2 / (GAMMA + 1)) * F.pow(F.lit(GAMMA), F.col("bucket"))
    )
    placed = parts.withColumn("until", until).withColumn("total", total).withColumn("value", value)

    def quantile(q):
        return F.min(F.when(F.col("until") >= q * F.col("total"), F.col("value")))

    quartiles = placed.groupBy(*by, "measure").agg(
        F.first("total").alias("size"), quantile(0.25).alias("q1"), quantile(0.75).alias("q3")
    )
    margin = F.create_map(*(x for k, v in MARGINS.items() for x in (F.lit(k), F.lit(v))))
    reach = F.greatest((F.col("q3") - F.col("q1")) * FENCES, margin[F.col("measure")])
    limits = quartiles.select(
        *by, "measure", "size", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high")
    )
    return limits.groupBy(*by).agg(
        F.max("size").alias("size"),
        *(
            F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{m}_{side}")
            for m in MARGINS
            for side in ("low", "high")
        ),
    )


def _limit_names() -> list[str]:
    return [f"{m}_{side}" for m in MARGINS for side in ("low", "high")]


def thresholds(rows: DataFrame, work: Work) -> DataFrame:
    """``(its_lang, its_source, <limits>)`` for every language and source of ``rows``."""
    own = work.table(sketches(rows.where(~F.col("base_failed")), ["lang", "source"]), "sketches")
    by_lang = merged(own, ["lang"])
    levels = [
        (fences(own, ["lang", "source"]), ["lang", "source"]),
        (fences(by_lang, ["lang"]), ["lang"]),
    ]
    # One row, whatever the size of the corpus.
    every = fences(merged(by_lang, []), []).first()
    groups = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
    for k, (limits, by) in enumerate(levels):
        names = {c: f"{c}_{k}" for c in limits.columns}
        same = F.lit(True)
        for c in by:
            same &= F.col(c).eqNullSafe(F.col(names[c]))
        groups = groups.join(limits.withColumnsRenamed(names), same, "left")
    enough = [F.col("size_0") >= LEAST_GROUP, F.col("size_1") >= LEAST_GROUP]
    chosen = [
        F.when(enough[0], F.col(f"{c}_0")).when(enough[1], F.col(f"{c}_1"))
        .otherwise(F.lit(every[c] if every else None).cast("double"))
        .alias(c)
        for c in _limit_names()
    ]
    return groups.select(F.col("lang").alias("its_lang"), F.col("source").alias("its_source"), *chosen)


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, counts, base_failed, kept.

    A NULL text has no words and fails. Documents without a language or source form groups
    of their own. Where every document fails the fixed rules there are no
    thresholds, and nothing else is failed. No rows give no rows.
    """
    work = Work(docs.sparkSession)
    rows = work.table(measured(docs), "measured")
    limits = work.table(thresholds(rows, work), "thresholds")
    same = F.col("lang").eqNullSafe(F.col("its_lang")) & F.col("source").eqNullSafe(
        F.col("its_source")
    )
    within = F.lit(True)
    for name, value in measures().items():
        within &= F.coalesce(value.between(F.col(f"{name}_low"), F.col(f"{name}_high")), F.lit(True))
    return rows.join(limits, same, "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & within).alias("kept"),
    )

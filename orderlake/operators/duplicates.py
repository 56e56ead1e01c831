"""How many rows share a key.

A window over the key moves every row to the task of its key, so one hot key,
or all the rows without a key, end up in a single task. That is fine for a
table a task can hold. In a larger one the keys are counted first, with a
map-side combine: few repeated keys are broadcast to the rows, and of many only
the hot ones are, whose rows then go past the window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.operators.sizing import sized
from orderlake.operators.skew import (
    DEFAULT_POLICY,
    SkewPolicy,
    can_be_hot,
    hot_counts,
    key_codes,
    with_hot,
)

COUNT = "_duplicate_count"


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """``(key, _rows)`` for keys on more than one row; a missing key counts as a key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")


def broadcast_counts(df: DataFrame, key: str, repeated: DataFrame) -> DataFrame:
    """Add the duplicate count without a shuffle; only for ``repeated`` of a checked size.

    The keys are broadcast as their codes, whatever their length.
    """
    coded = repeated.select(*key_codes(key), F.col("_rows").alias(COUNT))
    return with_hot(df, key, coded).withColumn(COUNT, F.coalesce(COUNT, F.lit(1)))


def shuffled_counts(
    df: DataFrame, key: str, repeated: DataFrame, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Add the duplicate count for any number of repeated keys.

    Rows with a hot key, or with no key where that is hot, get their count from the short broadcast list and
    are not shuffled at all. All other rows are counted together.
    """
    hot = hot_counts(repeated, key, policy).drop("_slots").withColumnRenamed("_rows", COUNT)
    rest = sized(with_hot(df, key, hot.drop(COUNT), "left_anti"), [key], [df])
    together = F.count(F.lit(1)).over(Window.partitionBy(key))
    return rest.withColumn(COUNT, together).unionByName(with_hot(df, key, hot, "inner"))


def add_duplicate_count(
    df: DataFrame, key: str, policy: SkewPolicy = DEFAULT_POLICY, rows: int | None = None
) -> DataFrame:
    """Add ``_duplicate_count``, the number of rows with the same key, to every row.

    ``rows`` is the number of rows where it is known; else they are counted.
    """
    if can_be_hot(df, policy, rows):
        return shuffled_counts(df, key, repeated_keys(df, key), policy)
    return df.withColumn(COUNT, F.count(F.lit(1)).over(Window.partitionBy(key)))

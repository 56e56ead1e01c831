"""Shuffles with as many partitions as their input needs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

PARTITIONS = "spark.sql.shuffle.partitions"
# Of Parquet or packed text, which is about ten times that as rows in memory: a task sorts those of two or three
# tables at once, and spills where they do not fit.
BYTES_PER_PARTITION = 24 * 1024 * 1024


# What Spark plans for data that is no file and whose size it does not know.
UNKNOWN_BYTES = 2**62


def input_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def partitions_for(size: int, bytes_per_partition: int = BYTES_PER_PARTITION) -> int:
    """So many partitions that none takes more of ``size`` bytes than given."""
    return -(-size // bytes_per_partition)


def sized(
    df: DataFrame,
    keys: Sequence[str],
    inputs: Iterable[DataFrame],
    bytes_per_partition: int = BYTES_PER_PARTITION,
) -> DataFrame:
    """``df`` by ``keys`` in as many partitions as its inputs need, where that is more than the session's.

    Adaptive execution merges shuffle partitions that turn out small but never adds any.
    A join or window on the keys reuses these. The session's setting stays as it is.
    """
    needed = partitions_for(sum(map(input_bytes, inputs)), bytes_per_partition)
    now = df.sparkSession.conf.get(PARTITIONS)
    if not now.isdigit() or needed <= int(now):
        return df
    return df.repartition(needed, *keys)


def partitions_needed(
    spark: SparkSession, inputs: Iterable[DataFrame], bytes_per_partition: int = BYTES_PER_PARTITION
) -> int:
    """The number of partitions that a shuffle of these inputs takes: the session's, or more."""
    now = spark.conf.get(PARTITIONS)
    return max(int(now) if now.isdigit() else 1, partitions_for(sum(map(input_bytes, inputs)), bytes_per_partition))


def dealt(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """``df`` shuffled by ``keys`` in any case, for what is done with the rows before their join.

    Frames dealt in this way into as many partitions are joined on ``keys`` without another shuffle. The session's own
    number is left to adaptive execution to merge.
    """
    now = df.sparkSession.conf.get(PARTITIONS)
    return df.repartition(*keys) if now == str(partitions) else df.repartition(partitions, *keys)

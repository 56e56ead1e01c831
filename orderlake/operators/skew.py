"""Equi-joins that stay balanced when single keys hold a large share of the rows.

The rows of a hot key are spread over several *slots* and the other side of the join is
copied into each of them, so the join runs on ``(key, slot)`` and no task has to
take a whole hot key. Every other key lives in slot 0 and is joined as usual, so
results do not depend on which keys were found hot.

The slot of a row comes from a hash of its row key. That spreads a hot key however its
rows are scattered over the input, and a re-run task gives its rows the same slot again.

Slots may be far smaller than a task. So rows are dealt over the tasks by *groups* of slots, none above a quarter of an
average partition. What has to be in all slots of a group travels once, with the first and the last of them, and meets
the rows of each: one row stands for its copies.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.operators.sizing import dealt, partitions_needed, sized

SLOT = "_slot"
GROUP = "_group"
RANGE = ["_first_slot", "_last_slot"]
CODES = ["_code", "_more_code"]
# Longer lists of hot keys are not broadcast whole. Those of the default policy are shorter.
LISTED_KEYS = 200_000
# In a longer list: whether a key has more than a quarter of an average partition's rows.
HEAVY = "_heavy"
HEAVY_PER_PARTITION = 4
# In a longer list: the key itself, for rows that were shuffled by it.
KEY = "_key"

# Shuffles a frame by some of its columns.
Deal = Callable[[DataFrame, Sequence[str]], DataFrame]


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as hot: it has more rows than a slot, and more than its share of all rows.

    Its share is that of a quarter of an average shuffle partition, so there are at most
    ``keys_per_partition`` hot keys per partition, by arithmetic. Their list has hash codes
    and numbers only, and is broadcast.
    """

    rows_per_slot: int = 1_000_000
    keys_per_partition: int = 4
    # Lookups up to this size are left to a broadcast join; None takes Spark's threshold.
    lookup_bytes: int | None = None


DEFAULT_POLICY = SkewPolicy()


def planned_bytes(df: DataFrame) -> int:
    """Spark's own size estimate for ``df``: file sizes for scans, generous beyond joins."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_bytes(df: DataFrame) -> int:
    """The size up to which the session broadcasts a side of a join; negative for never."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame, policy: SkewPolicy) -> bool:
    """Whether a join with ``df`` on its right is left to Spark to broadcast."""
    limit = policy.lookup_bytes
    return planned_bytes(df) <= (broadcast_bytes(df) if limit is None else limit)


def can_be_hot(df: DataFrame, policy: SkewPolicy, rows: int | None = None) -> bool:
    """Whether ``df`` has more rows than a slot.

    ``rows`` is its number of rows where a record of its write tells it. Else they are counted: one number per
    partition is moved, and of a plain Parquet table the footers alone are read.
    """
    return (df.count() if rows is None else rows) > policy.rows_per_slot


def key_codes(key: str) -> list[Column]:
    """128 bits that stand for a key of any length; NULL has a code too."""
    codes = F.xxhash64(F.col(key)), F.xxhash64(F.lit(1), F.col(key))
    return [code.alias(name) for code, name in zip(codes, CODES)]


def hot_keys(
    df: DataFrame,
    key: str,
    policy: SkewPolicy = DEFAULT_POLICY,
    slots: str = "_slots",
    span: int | None = None,
) -> DataFrame:
    """Codes and slots of the hot keys. Reads one column and combines before its shuffle."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return hot_counts(counts, key, policy, slots, span).drop("_rows")


def hot_counts(
    counts: DataFrame,
    key: str,
    policy: SkewPolicy = DEFAULT_POLICY,
    slots: str = "_slots",
    span: int | None = None,
) -> DataFrame:
    """The same from ready ``(key, _rows)`` counts, which it keeps. Where no key is hot they are not made again.

    In a long list those keys are heavy that have more slots than travel together, where ``span`` tells how many do.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total, keys = counts.agg(F.sum("_rows"), F.count_if(F.col("_rows") > policy.rows_per_slot)).first()
    share = (total or 0) / (policy.keys_per_partition * partitions)
    hot = (
        counts.where(F.col("_rows") > policy.rows_per_slot)
        .where(F.col("_rows") > share)
        .select(
            *key_codes(key),
            F.col(key).alias(KEY),
            "_rows",
            F.ceil(F.col("_rows") / policy.rows_per_slot).cast("int").alias(slots),
        )
    )
    if not keys:
        return hot.where(F.lit(False)).drop(KEY)
    large = F.col("_rows") > total / (HEAVY_PER_PARTITION * partitions)
    return in_tiers(hot, keys, large if span is None else F.col(slots) > span)


def in_tiers(hot: DataFrame, keys: int, heavy: Column) -> DataFrame:
    """Mark the heavy keys of a list that is too long to broadcast: a few per partition at most, by arithmetic."""
    return hot.drop(KEY) if keys <= LISTED_KEYS else hot.withColumn(HEAVY, heavy)


def with_hot(df: DataFrame, key: str, hot: DataFrame, how: str = "left") -> DataFrame:
    """Attach the columns of ``hot`` to the rows with a hot key; NULL matches NULL.

    Of a long list the heavy keys alone are broadcast. The rest of it is shuffled to the rows, none of its keys
    being large; the rows with a heavy key are dealt out evenly meanwhile and meet nothing there.
    """
    coded = df.withColumns(dict(zip(CODES, key_codes(key))))
    if HEAVY not in hot.columns:
        return coded.join(F.broadcast(hot), CODES, how).drop(*CODES)
    names = [c for c in hot.columns if c not in (*CODES, HEAVY, KEY)]
    top = hot.where(HEAVY).select(
        *CODES, F.lit(True).alias("_top"), *(F.col(c).alias(f"_top{c}") for c in names)
    )
    rest = hot.where(~F.col(HEAVY)).select(*CODES, F.lit(True).alias("_free"), F.lit(True).alias("_rest"), *names)
    free = F.col("_top").isNull()
    topped = (
        coded.join(F.broadcast(top), CODES, "left")
        .withColumn(CODES[0], F.when(free, F.col(CODES[0])).otherwise(F.xxhash64(*df.columns)))
        .withColumn("_free", free)
    )
    on = [*CODES, "_free"]
    met = sized(topped, on, [df]).join(sized(rest, on, [df]), on, "left")
    found = F.coalesce("_top", "_rest", F.lit(False))
    if how == "left_anti":
        return met.where(~found).select(*df.columns)
    kept = met.where(found) if how == "inner" else met
    return kept.select(*df.columns, *(F.coalesce(f"_top{c}", c).alias(c) for c in names))


def with_listed(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The columns of ``hot`` by what of it is broadcast, all of it or the heavy keys: what a row must know to be dealt."""
    listed = hot.where(HEAVY).drop(HEAVY, KEY) if HEAVY in hot.columns else hot
    return with_hot(df, key, listed)


def with_rest(df: DataFrame, key: str, hot: DataFrame, groups: Sequence[str], deal: Deal) -> DataFrame:
    """Complete them with the rest of a long list, where ``df`` was dealt by ``key`` and ``groups``.

    None of those keys is heavy, so all of its rows are in the first group.
    """
    if HEAVY not in hot.columns:
        return df
    names = [c for c in hot.columns if c not in (*CODES, HEAVY, KEY)]
    rest = hot.where(~F.col(HEAVY)).select(
        F.col(KEY).alias(key),
        # A plain zero would be no key of the join.
        *(own_slot(F.lit(1), [KEY]).alias(group) for group in groups),
        *(F.col(c).alias(f"_rest{c}") for c in names),
    )
    met = df.join(deal(rest, [key, *groups]), [key, *groups], "left")
    kept = [c for c in df.columns if c not in names]
    return met.select(*kept, *(F.coalesce(c, f"_rest{c}").alias(c) for c in names))


def own_slot(slots: str | Column, row_key: Sequence[str]) -> Column:
    """The slot of this row among ``slots``."""
    return F.pmod(F.xxhash64(*row_key), F.coalesce(slots, F.lit(1))).cast("int")


def group_of(slot: Column, span: int | Column) -> Column:
    """The group that a slot is in, of ``span`` slots each."""
    return F.floor(slot / span).cast("int")


def every_group(slots: str, span: int | Column) -> Column:
    """All groups of the slots of a key, one a row."""
    return F.explode(F.sequence(F.lit(0), group_of(F.coalesce(slots, F.lit(1)) - 1, span)))


def with_range(df: DataFrame, slots: str, span: int | Column, group: str, names: Sequence[str]) -> DataFrame:
    """The first and the last slot of a row's group, which it stands for all of."""
    first = F.col(group).cast("long") * span
    last = F.least(first + span, F.coalesce(slots, F.lit(1)).cast("long")) - 1
    return df.withColumns(dict(zip(names, (first, last))))


def group_span(rows: int, policy: SkewPolicy, partitions: int) -> int:
    """How many slots travel together: they have a quarter of an average partition's rows."""
    return max(1, math.ceil(rows / (HEAVY_PER_PARTITION * partitions * policy.rows_per_slot)))


def spread(
    df: DataFrame,
    key: str,
    hot: DataFrame,
    row_key: Sequence[str],
    slots: str = "_slots",
    span: int = 1,
    deal: Deal | None = None,
) -> DataFrame:
    """Put each row with a hot key into one of the slots of its key.

    With ``deal`` rows are also shuffled by key and group, ``span`` slots a group. A key that is not broadcast has one
    group, so its slots need not be known before.
    """
    if deal is None:
        return with_hot(df, key, hot).withColumn(SLOT, own_slot(slots, row_key)).drop(slots)
    placed = with_listed(df, key, hot).withColumn(SLOT, own_slot(slots, row_key))
    placed = placed.withColumn(GROUP, group_of(F.col(SLOT), span))
    if HEAVY not in hot.columns:
        # All slots are known, so the row key need not travel.
        return deal(placed.drop(slots), [key, GROUP])
    met = with_rest(deal(placed.drop(SLOT), [key, GROUP]), key, hot, [GROUP], deal)
    return met.withColumn(SLOT, own_slot(slots, row_key)).drop(slots)


def replicate(
    df: DataFrame, key: str, hot: DataFrame, slots: str = "_slots", span: int = 1, deal: Deal | None = None
) -> DataFrame:
    """Copy each row with a hot key into all the slots of its key.

    With ``deal`` it is copied into the groups and shuffled by key and group, and stands there for its copies in all
    slots of the group, of which it tells the first and the last.
    """
    if deal is None:
        every = F.sequence(F.lit(0), F.coalesce(slots, F.lit(1)) - 1)
        return with_hot(df, key, hot).withColumn(SLOT, F.explode(every)).drop(slots)
    listed = with_listed(df, key, hot).withColumn(GROUP, every_group(slots, span))
    met = with_rest(deal(listed, [key, GROUP]), key, hot, [GROUP], deal)
    return with_range(met, slots, span, GROUP, RANGE).drop(slots)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    how: str = "left",
    policy: SkewPolicy = DEFAULT_POLICY,
    row_key: Sequence[str] = (),
    keys: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Join many ``facts`` to the few rows per key of ``lookup``.

    A lookup under Spark's broadcast threshold needs no shuffle, hence no care
    for skew. Any other is shuffled, and hot keys of the facts are spread by ``row_key``, columns
    that tell facts apart (all columns if not given). Hot keys are looked for in ``keys``: the table that the
    facts' keys come from, where ``facts`` are joined rows already. ``rows`` is how many rows that table has, if known.
    """
    if fits_broadcast(lookup, policy):
        return facts.join(lookup, F.col(key) == F.col(lookup_key), how)
    searched = facts if keys is None else keys
    rows = searched.count() if rows is None else rows
    if not can_be_hot(searched, policy, rows):
        left, right = (sized(df, [on], [facts, lookup]) for df, on in ((facts, key), (lookup, lookup_key)))
        return left.join(right, F.col(key) == F.col(lookup_key), how)
    kinds = dict(facts.dtypes)[key], dict(lookup.dtypes)[lookup_key]
    if kinds[0] != kinds[1]:
        raise TypeError(f"{key} is {kinds[0]} and {lookup_key} is {kinds[1]}")
    partitions = partitions_needed(facts.sparkSession, [facts, lookup])
    deal, span = partial(dealt, partitions=partitions), group_span(rows, policy, partitions)
    hot = hot_keys(searched, key, policy, span=span)
    left = spread(facts, key, hot, row_key or facts.columns, span=span, deal=deal)
    right = replicate(lookup, lookup_key, hot, span=span, deal=deal)
    right = right.withColumnRenamed(GROUP, "_lookup_group")
    # Slots are compared within a group: all keys of the join are those that both sides were dealt by.
    met = (F.col(key) == F.col(lookup_key)) & (F.col(GROUP) == F.col("_lookup_group"))
    return left.join(right, met & F.col(SLOT).between(*map(F.col, RANGE)), how).drop(SLOT, GROUP, "_lookup_group", *RANGE)

"""The three ways to count duplicates agree with a plain count in Python."""

from collections import Counter

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlake.operators.duplicates import (
    COUNT,
    add_duplicate_count,
    broadcast_counts,
    repeated_keys,
    shuffled_counts,
)
from orderlake.operators.skew import SkewPolicy

PLAIN = SkewPolicy()
FORCED = SkewPolicy(rows_per_slot=3, keys_per_partition=10**6)

WAYS = {
    "window": lambda df: add_duplicate_count(df, "k", PLAIN),
    "forced": lambda df: add_duplicate_count(df, "k", FORCED),
    "broadcast": lambda df: broadcast_counts(df, "k", repeated_keys(df, "k")),
    "shuffled": lambda df: shuffled_counts(df, "k", repeated_keys(df, "k"), FORCED),
    "few hot keys": lambda df: shuffled_counts(
        df, "k", repeated_keys(df, "k"), SkewPolicy(rows_per_slot=1, keys_per_partition=1)
    ),
}


def expected(keys):
    counts = Counter(keys)
    return sorted(((k, counts[k]) for k in keys), key=repr)


@pytest.mark.parametrize("way", WAYS)
def test_one_key_and_missing_keys_hold_most_rows(spark, way):
    keys = ["hot"] * 40 + [None] * 30 + ["b", "b", "c"] + [f"u{i}" for i in range(20)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    assert rows(WAYS[way](df), "k", COUNT) == expected(keys)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from([None, "", "a", "bb", "ccc"]), max_size=30))
def test_any_keys(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for way in ("window", "shuffled"):
        assert rows(WAYS[way](df), "k", COUNT) == expected(keys)


def test_other_columns_are_kept(spark):
    df = spark.range(10).withColumn("k", F.lit("x"))
    out = shuffled_counts(df, "k", repeated_keys(df, "k"), FORCED)
    assert out.columns == ["id", "k", COUNT]
    assert rows(out, "id", COUNT) == [(i, 10) for i in range(10)]


def test_rows_of_hot_keys_are_not_shuffled(spark):
    keys = ["h" * 300] * 50 + ["b", "b", "c"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    out = shuffled_counts(df, "k", repeated_keys(df, "k"), SkewPolicy(rows_per_slot=3))
    assert rows(out, "k", COUNT) == expected(keys)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in text.split("Window")[1] and "Union" in text

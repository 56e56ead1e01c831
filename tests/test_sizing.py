import os

import pytest
from pyspark.sql import functions as F

from orderlake.operators.sizing import (
    BYTES_PER_PARTITION,
    PARTITIONS,
    input_bytes,
    partitions_for,
    sized,
)


def test_input_bytes(spark, sf_dir):
    names = [f"{sf_dir}/{t}.parquet" for t in ("customer", "nation")]
    customer, nation = map(spark.read.parquet, names)
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    assert input_bytes(joined) <= sum(map(os.path.getsize, names))
    assert input_bytes(customer) == os.path.getsize(names[0])


@pytest.mark.parametrize("size", [0, 1, BYTES_PER_PARTITION, 10**14, 10**16])
def test_no_partition_is_larger_than_given(size):
    n = partitions_for(size)
    assert n * BYTES_PER_PARTITION >= size
    assert (n - 1) * BYTES_PER_PARTITION < max(size, 1)


def test_large_inputs_get_more_partitions_and_the_setting_stays(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    before = spark.conf.get(PARTITIONS)
    assert sized(orders, ["o_custkey"], [orders]) is orders
    size = input_bytes(orders)
    wide = sized(orders, ["o_custkey"], [orders, orders], size // 20)
    assert 40 <= wide.rdd.getNumPartitions() <= 42
    assert spark.conf.get(PARTITIONS) == before
    counted = wide.groupBy("o_custkey").agg(F.count(F.lit(1)))
    text = counted._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_other_settings_are_left_alone(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")

    class Frame:
        class sparkSession:
            conf = {PARTITIONS: "auto"}

    assert sized(Frame, ["o_custkey"], [orders], 1) is Frame

"""Joins that spread hot keys return what plain joins return, and do spread them."""

import re

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlake.operators.skew import (
    CODES,
    GROUP,
    HEAVY,
    HEAVY_PER_PARTITION,
    RANGE,
    SLOT,
    SkewPolicy,
    can_be_hot,
    fits_broadcast,
    group_span,
    hot_keys,
    key_codes,
    lookup_join,
    planned_bytes,
    replicate,
    spread,
    with_hot,
)
from orderlake.plans.curated import (
    BATCHES,
    GROUPS,
    LINES,
    MEET_ON,
    SHIPMENTS,
    crowded_orders,
    join_shipments,
    place,
    place_groups,
)

PLAIN = SkewPolicy(rows_per_slot=10**12)
MANY = 10**6
FORCED = SkewPolicy(rows_per_slot=10, keys_per_partition=MANY, lookup_bytes=-1)


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows share a key, and a sixth have none."""
    few = (F.col("id") % 50).cast("string")
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 != 1, few)
    return spark.range(600, numPartitions=12).withColumn("k", key)


@pytest.fixture(scope="module")
def lookup(spark):
    data = [("hot", "H"), ("7", "seven"), ("8", "eight"), ("unused", "U")]
    return spark.createDataFrame(data, "lk string, v string")


def test_counts_are_not_made_again_where_no_key_is_hot(facts):
    hot = hot_keys(facts, "k", PLAIN)
    assert hot.collect() == [] and hot.columns == [*CODES, "_slots"]
    text = with_hot(facts, "k", hot)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Exchange" not in text


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join(facts, lookup, how):
    plain = facts.join(lookup, F.col("k") == F.col("lk"), how)
    spread_out = lookup_join(facts, lookup, "k", "lk", how, FORCED)
    assert spread_out.columns == plain.columns
    assert rows(spread_out) == rows(plain)


def named(hot, keys):
    """Slots by key; the list itself has codes only."""
    coded = keys.distinct().select("k", *key_codes("k"))
    return {r.k: r._slots for r in coded.join(hot, CODES).collect()}


def test_hot_keys(facts):
    found = named(hot_keys(facts, "k", FORCED), facts.select("k"))
    counts = {r.k: r["count"] for r in facts.groupBy("k").count().collect()}
    assert found == {k: -(-n // 10) for k, n in counts.items() if n > 10}
    assert found["hot"] == 20 and None in found


def test_the_number_of_hot_keys_is_bounded_by_their_share(spark, facts):
    few = SkewPolicy(rows_per_slot=1, keys_per_partition=1)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = named(hot_keys(facts, "k", few), facts.select("k"))
    counts = {r.k: r["count"] for r in facts.groupBy("k").count().collect()}
    assert set(found) == {k for k, n in counts.items() if n > 600 / partitions}
    assert len(found) < partitions


def slot_sizes(df, hot, row_key):
    return [r["count"] for r in spread(df, "k", hot, row_key).groupBy(SLOT).count().collect()]


@pytest.mark.parametrize("key", ["hot", "x" * 300])
@pytest.mark.parametrize("layout", ["scattered", "one partition", "merged shuffle"])
def test_slots_split_a_hot_key_however_it_lies(spark, key, layout):
    df = spark.range(1200, numPartitions=24).select("id", F.lit(key).alias("k"))
    if layout == "one partition":
        df = df.coalesce(1)
    if layout == "merged shuffle":
        df = df.groupBy("id").agg(F.first("k").alias("k"))
    sizes = slot_sizes(df, hot_keys(df, "k", SkewPolicy(rows_per_slot=100)), ["id"])
    assert len(sizes) == 12 and sum(sizes) == 1200 and max(sizes) < 150


def test_a_row_is_copied_to_each_slot_of_its_key(spark, facts, lookup):
    hot = hot_keys(facts, "k", FORCED)
    counted = replicate(lookup, "lk", hot).groupBy("lk").count()
    copies = {r.lk: r["count"] for r in counted.collect()}
    assert copies["hot"] == 20 and copies["unused"] == 1


def test_sizes_are_checked(spark, sf_dir):
    small = spark.read.parquet(f"{sf_dir}/nation.parquet")
    assert fits_broadcast(small, SkewPolicy())
    assert not fits_broadcast(small, FORCED)
    assert not can_be_hot(small, SkewPolicy())
    assert not can_be_hot(small, SkewPolicy(rows_per_slot=25))
    assert can_be_hot(small, SkewPolicy(rows_per_slot=24))
    assert planned_bytes(small.select("n_name")) < planned_bytes(small)


@pytest.fixture(scope="module")
def orders_with_crowds(spark):
    """Orders with many lines, many shipments, both, few of either, and none."""
    lines = {"lines": 60, "both": 45, "ships": 2, "few": 3, "bare": 2, "bare-many": 50}
    ships = {"lines": 1, "both": 35, "ships": 70, "few": 2, "orphan": 40}
    items = spark.createDataFrame(
        [(k, f"{k}-{i}") for k, n in lines.items() for i in range(n)],
        "order_id string, order_item_id string",
    ).repartition(7)
    shipments = spark.createDataFrame(
        [(f"{k}-s{i}", k) for k, n in ships.items() for i in range(n)],
        "shipment_id string, order_id string",
    )
    for name in ("carrier", "shipment_date", "delivery_date", "shipment_status"):
        shipments = shipments.withColumn(name, F.lit("x"))
    return items, shipments.repartition(5)


def test_join_shipments(orders_with_crowds):
    items, shipments = orders_with_crowds
    plain = items.join(shipments, "order_id", "left")
    for policy in (PLAIN, FORCED, SkewPolicy(rows_per_slot=1)):
        out = join_shipments(items, shipments, policy)
        assert sorted(out.columns) == sorted(plain.columns)
        assert rows(out, *sorted(out.columns)) == rows(plain, *sorted(out.columns))


def test_join_shipments_without_adaptive_execution(spark, orders_with_crowds):
    items, shipments = orders_with_crowds
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = join_shipments(items, shipments, FORCED)
        plain = items.join(shipments, "order_id", "left")
        assert rows(out, *sorted(out.columns)) == rows(plain, *sorted(out.columns))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.sampled_from(["a", "b", "c", "d"]), min_size=1, max_size=25),
    st.lists(st.sampled_from(["a", "b", "c", "e"]), min_size=1, max_size=25),
)
def test_any_lines_and_shipments(spark, lines, ships):
    items = spark.createDataFrame(list(enumerate(lines)), "order_item_id int, order_id string")
    given_ships = spark.createDataFrame(list(enumerate(ships)), "n int, order_id string")
    shipments = given_ships.withColumnsRenamed({"n": "shipment_id"}).withColumns(
        {c: F.lit("x") for c in ("carrier", "shipment_date", "delivery_date", "shipment_status")}
    )
    out = join_shipments(items, shipments, SkewPolicy(rows_per_slot=2))
    expected = [
        (k, line, n)
        for line, k in enumerate(lines)
        for n in ([i for i, s in enumerate(ships) if s == k] or [None])
    ]
    assert rows(out, "order_id", "order_item_id", "shipment_id") == sorted(expected, key=repr)


def test_keys_need_not_be_text(spark):
    facts = spark.range(40).withColumn("k", F.col("id") % 3)
    lookup = spark.createDataFrame([(0, "zero"), (1, "one")], "lk bigint, v string")
    plain = facts.join(lookup, F.col("k") == F.col("lk"), "left")
    assert rows(lookup_join(facts, lookup, "k", "lk", "left", FORCED)) == rows(plain)


def test_keys_of_different_types_are_refused(spark):
    facts = spark.range(40).withColumn("k", F.col("id") % 3)
    lookup = spark.createDataFrame([("0", "zero")], "lk string, v string")
    with pytest.raises(TypeError):
        lookup_join(facts, lookup, "k", "lk", "left", FORCED)


def test_hot_keys_are_sought_in_the_table_they_come_from(spark, facts, lookup):
    joined = facts.join(facts.select(F.col("id").alias("same")), F.col("id") == F.col("same"))
    plain = joined.join(lookup, F.col("k") == F.col("lk"), "left")
    out = lookup_join(joined, lookup, "k", "lk", "left", FORCED, ["id"], facts)
    assert rows(out) == rows(plain)


def crowds(items, shipments, policy):
    """``{order: (batches of lines, batches of shipments)}``"""
    keys = items.select("order_id").union(shipments.select("order_id")).distinct()
    coded = keys.select("order_id", *key_codes("order_id"))
    found = coded.join(crowded_orders(items, shipments, policy), CODES)
    return {r.order_id: (r._lines, r._shipments) for r in found.collect()}


def test_crowded_orders(orders_with_crowds):
    items, shipments = orders_with_crowds
    found = crowds(items, shipments, FORCED)
    assert set(found) == {"lines", "both", "ships", "bare-many", "orphan"}
    sizes = {"lines": (60, 1), "both": (45, 35), "ships": (2, 70), "bare-many": (50, 1), "orphan": (1, 40)}
    for order, (lines, ships) in sizes.items():
        assert lines * ships / (found[order][0] * found[order][1]) <= 5
    assert crowds(items, shipments, PLAIN) == {}


def test_cells_hold_what_a_slot_does(spark):
    """900 lines and 900 shipments give 810,000 rows; no cell takes much of them."""
    policy = SkewPolicy(rows_per_slot=1000)
    items = spark.range(900).select(F.lit("O").alias("order_id"), F.col("id").alias("order_item_id"))
    shipments = spark.range(900).select(F.lit("O").alias("order_id"), F.col("id").alias("shipment_id"))
    crowded = crowded_orders(items, shipments, policy)
    lines = place(items, crowded, "_lines", "order_item_id").drop("_lines", "_shipments")
    met = lines.join(
        place(shipments, crowded, "_shipments", "shipment_id").drop("_lines", "_shipments"), MEET_ON
    )
    cells = [r["count"] for r in met.groupBy(*BATCHES).count().collect()]
    assert sum(cells) == 810_000 and max(cells) <= 1500 and len(cells) >= 810


@pytest.fixture
def long_lists(monkeypatch):
    """Every list of hot keys counts as too long to broadcast."""
    monkeypatch.setattr("orderlake.operators.skew.LISTED_KEYS", 0)
    monkeypatch.setattr("orderlake.plans.curated.LISTED_KEYS", 0)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_with_a_long_list(facts, lookup, long_lists, how):
    plain = facts.join(lookup, F.col("k") == F.col("lk"), how)
    out = lookup_join(facts, lookup, "k", "lk", how, FORCED)
    assert out.columns == plain.columns
    assert rows(out) == rows(plain)


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_a_long_list_is_met_as_a_short_one(monkeypatch, facts, how):
    policy = SkewPolicy(rows_per_slot=3, keys_per_partition=MANY)
    short = with_hot(facts, "k", hot_keys(facts, "k", policy), how)
    monkeypatch.setattr("orderlake.operators.skew.LISTED_KEYS", 0)
    hot = hot_keys(facts, "k", policy)
    heavy = {r._slots for r in hot.where(HEAVY).collect()}
    assert heavy and heavy != {r._slots for r in hot.collect()}
    long = with_hot(facts, "k", hot, how)
    assert long.columns == short.columns
    assert rows(long) == rows(short)


def test_join_shipments_with_a_long_list(orders_with_crowds, long_lists):
    items, shipments = orders_with_crowds
    plain = items.join(shipments, "order_id", "left")
    out = join_shipments(items, shipments, FORCED)
    assert rows(out, *sorted(out.columns)) == rows(plain, *sorted(out.columns))


def test_no_long_list_is_broadcast(spark, long_lists):
    """Of a list of many keys of like size none is heavy, so none goes through the driver."""
    facts = spark.range(4000).withColumn("k", F.col("id") % 1000)
    hot = hot_keys(facts, "k", SkewPolicy(rows_per_slot=3, keys_per_partition=MANY))
    assert hot.count() == 1000 and hot.where(HEAVY).count() == 0
    assert HEAVY not in hot_keys(facts, "k", SkewPolicy(rows_per_slot=4)).columns


def shuffles(df):
    """The columns of each shuffle."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((.*), \d+\)", text)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_travel_once_and_no_copies_do(facts, lookup, long_lists, no_broadcast):
    """One shuffle by key and group for each side and each side's list, and none by slot."""
    found = shuffles(lookup_join(facts, lookup, "k", "lk", "left", FORCED, ["id"]))
    assert len([by for by in found if "_group" in by]) == 4
    assert all("_group" in by or re.fullmatch(r"k#\d+", by) for by in found)


def test_lines_and_shipments_travel_once(orders_with_crowds, long_lists, no_broadcast):
    found = shuffles(join_shipments(*orders_with_crowds, FORCED))
    assert len([by for by in found if "_group" in by]) == 4
    assert all("_group" in by or re.fullmatch(r"order_id#\d+", by) for by in found)


def no_deal(df, keys):
    return df


@pytest.mark.parametrize("listed", [10**6, 0])
def test_slots_travel_in_groups(monkeypatch, facts, lookup, listed):
    """A group has what a quarter of a partition has, and a row of the other side stands in all slots of one."""
    monkeypatch.setattr("orderlake.operators.skew.LISTED_KEYS", listed)
    span = group_span(600, FORCED, 2)
    hot = hot_keys(facts, "k", FORCED, span=span)
    out = spread(facts, "k", hot, ["id"], span=span, deal=no_deal)
    sizes = {(r.k, r[GROUP]): r["count"] for r in out.groupBy("k", GROUP).count().collect()}
    assert max(sizes.values()) < 1.5 * 600 / 2 / HEAVY_PER_PARTITION + 10
    assert {g for k, g in sizes if k == "hot"} == {0, 1, 2} and {g for k, g in sizes if k == "7"} == {0}
    plain = spread(facts, "k", hot_keys(facts, "k", FORCED), ["id"])
    assert rows(out, "id", SLOT) == rows(plain, "id", SLOT)
    copies = replicate(lookup, "lk", hot, span=span, deal=no_deal)
    stands = {(r.lk, r[GROUP]): (r[RANGE[0]], r[RANGE[1]]) for r in copies.collect()}
    assert len(stands) == copies.count() and stands["unused", 0] == (0, 0)
    ends = [stands["hot", g] for g in range(3)]
    assert [s for first, last in ends for s in range(first, last + 1)] == list(range(20))


def test_orders_of_one_group_are_not_copied(spark, long_lists):
    """An order with as many rows as any other travels as it is, however many batches it has."""
    ids = spark.range(1200).select((F.col("id") % 200).cast("string").alias("order_id"), F.col("id"))
    items, shipments = ids.withColumnRenamed("id", "order_item_id"), ids.withColumnRenamed("id", "shipment_id")
    found = crowded_orders(items, shipments, SkewPolicy(rows_per_slot=3))
    assert found.where(F.col(LINES) * F.col(SHIPMENTS) > 20).count() == 200
    for df, own, row_key in ((items, LINES, "order_item_id"), (shipments, SHIPMENTS, "shipment_id")):
        placed = place_groups(df, found, no_deal, own, row_key)
        assert placed.count() == 1200 and placed.select(*GROUPS).distinct().collect() == [(0, 0)]


def test_an_order_of_several_groups_is_dealt_out(spark):
    items = spark.range(900).select(F.lit("O").alias("order_id"), F.col("id").alias("order_item_id"))
    shipments = items.withColumnRenamed("order_item_id", "shipment_id")
    found = crowded_orders(items, shipments, SkewPolicy(rows_per_slot=3))
    placed = place_groups(items, found, no_deal, LINES, "order_item_id")
    cut = placed.groupBy(*GROUPS).count().collect()
    batches = found.first()
    # Groups along the two axes, and each line in all of those along the other.
    assert 32 <= len(cut) and sum(r["count"] for r in cut) == 900 * (max(r[1] for r in cut) + 1)
    assert sum(r["count"] for r in cut) < 900 * batches[SHIPMENTS]


@pytest.mark.parametrize("listed", [10**6, 0])
def test_lines_without_an_order_are_kept(monkeypatch, spark, listed):
    monkeypatch.setattr("orderlake.operators.skew.LISTED_KEYS", listed)
    monkeypatch.setattr("orderlake.plans.curated.LISTED_KEYS", listed)
    items = spark.range(9).select(F.lit(None).cast("string").alias("order_id"), F.col("id").alias("order_item_id"))
    shipments = items.withColumnRenamed("order_item_id", "shipment_id").withColumns(
        {c: F.lit("x") for c in ("carrier", "shipment_date", "delivery_date", "shipment_status")}
    )
    out = join_shipments(items, shipments, SkewPolicy(rows_per_slot=2))
    assert rows(out, "order_item_id", "shipment_id") == [(i, None) for i in range(9)]

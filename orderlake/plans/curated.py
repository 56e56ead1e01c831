"""The wide order-line table and the joins it is made of.

The two small-per-key lookups of an order (customer, warehouse) are joined to
orders, and the product to the lines, before lines and orders meet. Then orders, lines and
shipments meet on one key, so each of the three is shuffled by it once. Zones in buckets by that
key are not shuffled at all.

What the record of the zones tells is not looked up in the rows again: where no order has many lines
and many shipments, none can be crowded, and none is searched for.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions import delivery_days, line_revenue
from orderlake.operators.sizing import dealt, partitions_needed, sized
from orderlake.operators.skew import (
    DEFAULT_POLICY,
    HEAVY,
    HEAVY_PER_PARTITION,
    KEY,
    LISTED_KEYS,
    Deal,
    SkewPolicy,
    every_group,
    fits_broadcast,
    group_of,
    in_tiers,
    key_codes,
    lookup_join,
    own_slot,
    with_hot,
    with_listed,
    with_range,
    with_rest,
)
from orderlake.schemas import ORDER_ANALYTICS_COLUMNS


@dataclass(frozen=True)
class Facts:
    """What the record of the zones tells about the inputs: nothing, if they were never written."""

    rows: Mapping[str, int] = field(default_factory=dict)
    # The most lines and the most shipments of one order.
    most_lines: int | None = None
    most_shipments: int | None = None
    # ``(order_id, rows)`` of orders with more than one line or shipment.
    lines: DataFrame | None = None
    shipments: DataFrame | None = None
    # Lines, shipments and orders lie in the same number of buckets.
    bucketed: bool = False
    buckets: int = 0

    def uncrowded(self, policy: SkewPolicy) -> bool:
        """Whether no order can give more rows than a slot."""
        if self.most_lines is None or self.most_shipments is None:
            return False
        return max(self.most_lines, 1) * max(self.most_shipments, 1) <= policy.rows_per_slot


UNKNOWN = Facts()


def raw_facts(raw_items: DataFrame, raw_shipments: DataFrame) -> Facts:
    """Facts about inputs that were never written, from the raw rows they are cleaned from.

    An order has no more valid lines than raw ones, so the largest raw counts bound the valid ones. One column of each
    table is read and nothing is judged. Rows without an order are rejected later and do not count.
    """
    order = F.trim(F.col("order_id").cast("string")).alias("order_id")
    both = raw_items.select(F.lit(True).alias("line"), order).unionAll(
        raw_shipments.select(F.lit(False), order)
    )
    counts = both.where("order_id != ''").groupBy("line", "order_id").agg(F.count(F.lit(1)).alias("rows"))
    most = {r["line"]: r["most"] for r in counts.groupBy("line").agg(F.max("rows").alias("most")).collect()}
    return Facts(most_lines=most.get(True, 0), most_shipments=most.get(False, 0))


def _named(df: DataFrame, **names: str) -> DataFrame:
    return df.select(*(F.col(old).alias(new) for new, old in names.items()))


def _known_customers(customers: DataFrame) -> DataFrame:
    return _named(
        customers,
        known_customer_id="customer_id",
        customer_name="customer_name",
        customer_segment="customer_segment",
    )


def _known_warehouses(warehouses: DataFrame) -> DataFrame:
    return _named(
        warehouses,
        known_warehouse_id="warehouse_id",
        warehouse_name="warehouse_name",
        warehouse_city="city",
    )


def _known_products(products: DataFrame) -> DataFrame:
    return _named(
        products,
        known_product_id="product_id",
        product_name="product_name",
        category="category",
        supplier_id="supplier_id",
    )


def join_customers(
    orders: DataFrame,
    customers: DataFrame,
    policy: SkewPolicy = DEFAULT_POLICY,
    keys: DataFrame | None = None,
    facts: Facts = UNKNOWN,
) -> DataFrame:
    """Customer columns for each order, NULL when the customer is unknown."""
    known = _known_customers(customers)
    rows = facts.rows.get("orders")
    return lookup_join(
        orders, known, "customer_id", "known_customer_id", "left", policy, ["order_id"], keys, rows
    )


def join_warehouses(
    orders: DataFrame,
    warehouses: DataFrame,
    policy: SkewPolicy = DEFAULT_POLICY,
    keys: DataFrame | None = None,
    facts: Facts = UNKNOWN,
) -> DataFrame:
    """Columns of the warehouse named by the order, NULL when it is unknown."""
    known = _known_warehouses(warehouses)
    rows = facts.rows.get("orders")
    return lookup_join(
        orders, known, "warehouse_id", "known_warehouse_id", "left", policy, ["order_id"], keys, rows
    )


def join_products(
    items: DataFrame,
    products: DataFrame,
    policy: SkewPolicy = DEFAULT_POLICY,
    facts: Facts = UNKNOWN,
) -> DataFrame:
    """Product columns for each line, NULL when the product is unknown."""
    known = _known_products(products)
    rows = facts.rows.get("order_items")
    return lookup_join(
        items, known, "product_id", "known_product_id", "left", policy, ["order_item_id"], rows=rows
    )


def join_orders_items(
    orders: DataFrame,
    items: DataFrame,
    policy: SkewPolicy = DEFAULT_POLICY,
    facts: Facts = UNKNOWN,
) -> DataFrame:
    """Lines with their order; lines without an order and orders without lines drop out."""
    known = orders.withColumnRenamed("order_id", "known_order_id")
    rows = facts.rows.get("order_items")
    return lookup_join(
        items, known, "order_id", "known_order_id", "inner", policy, ["order_item_id"], rows=rows
    ).drop("known_order_id")


LINES = "_lines"
SHIPMENTS = "_shipments"
BATCHES = [f"{LINES}_batch", f"{SHIPMENTS}_batch"]
# Neighbouring batches travel as a group, so many along each axis.
SPANS = [f"{LINES}_span", f"{SHIPMENTS}_span"]
GROUPS = [f"{batch}_group" for batch in BATCHES]
# The first and the last of the batches that a row stands in, along the axis of the other side.
RANGES = [[f"{axis}_first", f"{axis}_last"] for axis in (LINES, SHIPMENTS)]


def order_counts(items: DataFrame, shipments: DataFrame) -> DataFrame:
    """``(order_id, lines, shipments)`` by looking at both tables: their order ids are shuffled once."""
    both = items.select("order_id", F.lit(1).alias(LINES), F.lit(0).alias(SHIPMENTS)).unionAll(
        shipments.select("order_id", F.lit(0), F.lit(1))
    )
    return both.groupBy("order_id").agg(F.sum(LINES).alias(LINES), F.sum(SHIPMENTS).alias(SHIPMENTS))


def recorded_counts(facts: Facts) -> DataFrame:
    """The same from the counts that were kept when the zones were written."""
    lines = facts.lines.select("order_id", F.col("rows").alias(LINES), F.lit(0).alias(SHIPMENTS))
    both = lines.unionAll(facts.shipments.select("order_id", F.lit(0), "rows"))
    return both.groupBy("order_id").agg(F.sum(LINES).alias(LINES), F.sum(SHIPMENTS).alias(SHIPMENTS))


def spans(cells: int) -> list[Column]:
    """How many neighbouring batches of lines and of shipments travel together: not more than ``cells`` cells.

    An order with no more cells than that is one group.
    """
    side = math.isqrt(cells)
    axes = (LINES, SHIPMENTS), (SHIPMENTS, LINES)
    return [
        F.least(own, F.greatest(F.lit(side), F.floor(F.lit(cells) / F.col(other)))).cast("int").alias(span)
        for (own, other), span in zip(axes, SPANS)
    ]


def crowded(
    counts: DataFrame, policy: SkewPolicy, rows: int | None = None, partitions: int | None = None
) -> DataFrame:
    """Orders that give more rows than a slot, by codes, and how many batches of each side to make.

    An order gives a row per line and shipment. Of its lines and shipments so many batches are
    made that a line batch meets a shipment batch in half a slot's rows on average,
    which leaves room for uneven batches. Of the cells so many travel together as give a quarter of an average
    partition's rows.

    A crowded order has at least twice the root of a slot in lines and shipments, so where the two tables have few
    ``rows`` the list is short by arithmetic, and their half is less than what they give. Else its orders are counted,
    and a long list gets tiers: heavy are orders of several groups, twelve per partition at most.
    """
    lines = F.greatest(LINES, F.lit(1)).cast("double")
    # Shipments without an order meet no line.
    ships = F.greatest(F.when(F.col("order_id").isNotNull(), F.col(SHIPMENTS)), F.lit(1)).cast("double")
    target = policy.rows_per_slot / 2
    # The shorter side is cut to the root of the target at most, the longer one takes the rest.
    of_lines = F.ceil(lines * F.least(ships, F.lit(target**0.5)) / target)
    of_ships = F.ceil(ships * (lines / of_lines) / target)
    many = lines * ships > policy.rows_per_slot
    found = counts.where(many).select(
        *key_codes("order_id"),
        F.col("order_id").alias(KEY),
        # Never more batches than rows: an order with several batches of shipments has shipments.
        F.least(of_lines, lines).cast("int").alias(LINES),
        F.least(of_ships, ships).cast("int").alias(SHIPMENTS),
    )
    if rows is not None and rows <= LISTED_KEYS * 2 * policy.rows_per_slot**0.5:
        orders, pairs = 0, rows / 2
    else:
        orders, pairs = counts.agg(F.count_if(many), F.sum(lines * ships)).first()
    partitions = partitions or partitions_needed(counts.sparkSession, [])
    cells = max(1, int((pairs or 0) / (HEAVY_PER_PARTITION * partitions * target)))
    several = F.col(LINES).cast("long") * F.col(SHIPMENTS) > cells
    return in_tiers(found.select("*", *spans(cells)), orders, several)


def crowded_orders(
    items: DataFrame,
    shipments: DataFrame,
    policy: SkewPolicy,
    facts: Facts = UNKNOWN,
    partitions: int | None = None,
) -> DataFrame:
    """The crowded orders, from the record where there is one."""
    if facts.lines is None or facts.shipments is None:
        return crowded(order_counts(items, shipments), policy, items.count() + shipments.count(), partitions)
    known = [facts.rows.get(table) for table in ("order_items", "shipments")]
    return crowded(recorded_counts(facts), policy, None if None in known else sum(known), partitions)


def place(df: DataFrame, found: DataFrame, own: str | None = None, row_key: str = "") -> DataFrame:
    """Assign rows to the batches in which lines, shipments and their order meet.

    A row is in one batch along its ``own`` axis and is copied along the other,
    so each pair of a line and a shipment of one order meets exactly once.
    """
    placed = with_hot(df, "order_id", found)
    for axis, batch in zip((LINES, SHIPMENTS), BATCHES):
        every = F.explode(F.sequence(F.lit(0), F.coalesce(axis, F.lit(1)) - 1))
        placed = placed.withColumn(batch, own_slot(axis, [row_key]) if axis == own else every)
    return placed.drop(*SPANS)


def place_groups(
    df: DataFrame, found: DataFrame, deal: Deal, own: str | None = None, row_key: str = ""
) -> DataFrame:
    """The same by groups of batches: rows are copied into the groups only, and shuffled by order and group.

    An order that is not broadcast has one group, so its batches need not be known before.
    """
    placed = with_listed(df, "order_id", found)
    for axis, span, group, batch in zip((LINES, SHIPMENTS), SPANS, GROUPS, BATCHES):
        width = F.coalesce(span, F.lit(1))
        if axis == own:
            placed = placed.withColumn(batch, own_slot(axis, [row_key]))
            placed = placed.withColumn(group, group_of(F.col(batch), width))
        else:
            placed = placed.withColumn(group, every_group(axis, width))
    return deal(placed, MEET_BY)


def place_batches(df: DataFrame, found: DataFrame, deal: Deal, own: str, row_key: str) -> DataFrame:
    """Rows that ``place_groups`` has shuffled, in the batches of their group: in one along their ``own`` axis.

    Along the other a row is in all from a first to a last one, and stands for its copies there.
    """
    df = with_rest(df, "order_id", found, GROUPS, deal)
    for axis, span, group, batch, ends in zip((LINES, SHIPMENTS), SPANS, GROUPS, BATCHES, RANGES):
        if axis == own and HEAVY in found.columns:
            df = df.withColumn(batch, own_slot(axis, [row_key]))
        elif axis != own:
            df = with_range(df, axis, F.coalesce(span, F.lit(1)), group, ends)
    return df


MEET_BY = ["order_id", *GROUPS]
MEET_ON = ["order_id", *BATCHES]


CARRIED = ["order_id", "shipment_id", "carrier", "shipment_date", "delivery_date", "shipment_status"]


def _meeting(
    df: DataFrame, keys: list[str], inputs: list[DataFrame], facts: Facts, kept: bool = True
) -> DataFrame:
    """``df`` shuffled by ``keys`` into enough partitions, unless it lies in buckets.

    Rows that a lookup took out of their buckets (not ``kept``) go to as many partitions as there are buckets, so that
    the tables they meet stay where they are.
    """
    if not facts.bucketed:
        return sized(df, keys, inputs)
    return df if kept or not facts.buckets else df.repartition(facts.buckets, *keys)


def met_heads(
    heads: DataFrame,
    customers: DataFrame,
    warehouses: DataFrame,
    inputs: list[DataFrame],
    policy: SkewPolicy,
    facts: Facts,
) -> DataFrame:
    """Orders with their customer and warehouse, by order."""
    known = _known_customers(customers), _known_warehouses(warehouses)
    return _meeting(heads, ["order_id"], inputs, facts, all(fits_broadcast(k, policy) for k in known))


def met_lines(
    lines: DataFrame, products: DataFrame, inputs: list[DataFrame], policy: SkewPolicy, facts: Facts
) -> DataFrame:
    """Lines with their product, by order."""
    return _meeting(lines, ["order_id"], inputs, facts, fits_broadcast(_known_products(products), policy))


def join_shipments(
    lines: DataFrame,
    shipments: DataFrame,
    policy: SkewPolicy = DEFAULT_POLICY,
    facts: Facts = UNKNOWN,
) -> DataFrame:
    """Every line once per shipment of its order, or once with NULLs when it has none."""
    inputs = [lines, shipments]
    if facts.uncrowded(policy):
        met = _meeting(shipments.select(*CARRIED), ["order_id"], inputs, facts)
        return _meeting(lines, ["order_id"], inputs, facts).join(met, "order_id", "left")
    partitions = partitions_needed(lines.sparkSession, inputs)
    found = crowded_orders(lines, shipments, policy, facts, partitions)
    deal = partial(dealt, partitions=partitions)
    return _ship(place_groups(lines, found, deal, LINES, "order_item_id"), shipments, found, deal).drop(*GROUPS)


def _ship(placed: DataFrame, shipments: DataFrame, found: DataFrame, deal: Deal) -> DataFrame:
    """Lines in groups with the shipments that they meet in the batches of their group."""
    lines = place_batches(placed, found, deal, LINES, "order_item_id")
    carried = shipments.select(*CARRIED).withColumn("_shipped", F.lit(True))
    met = place_groups(carried, found, deal, SHIPMENTS, "shipment_id")
    met = place_batches(met, found, deal, SHIPMENTS, "shipment_id")
    met = met.drop(LINES, SHIPMENTS, *SPANS).withColumnsRenamed({name: f"_met{name}" for name in MEET_BY})
    on = [F.col(name) == F.col(f"_met{name}") for name in MEET_BY]
    cells = [F.col(batch).between(*map(F.col, ends)) for batch, ends in zip(BATCHES, RANGES)]
    # An order with several batches of shipments has shipments, so a line that
    # found none in one of the groups is not a line without a shipment.
    alone = F.coalesce(SHIPMENTS, F.lit(1)) == 1
    return (
        lines.join(met, [*on, *cells], "left")
        .where(alone | F.col("_shipped"))
        .drop(LINES, SHIPMENTS, *SPANS, "_shipped", *BATCHES, *sum(RANGES, []), *(f"_met{name}" for name in MEET_BY))
    )


def build_order_analytics(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    warehouses: DataFrame,
    shipments: DataFrame,
    policy: SkewPolicy = DEFAULT_POLICY,
    facts: Facts = UNKNOWN,
    months: bool = False,
) -> DataFrame:
    """One row per order line and shipment, 23 columns.

    An order with several shipments repeats its lines, so revenue summed over
    this table counts them once per shipment. That is the meaning the reports
    are defined on. ``facts`` are those of the record of the inputs; without them crowded orders are searched for.
    With ``months`` a column ``order_month`` follows, and rows are dealt by it: few files per month, and large months
    over many tasks. What is derived from a row is added behind that shuffle.
    """
    inputs = [orders, items, shipments]
    heads = orders.select("order_id", "order_date", "order_status", "customer_id", "warehouse_id")
    heads = join_customers(heads, customers, policy, orders, facts)
    heads = join_warehouses(heads, warehouses, policy, orders, facts)
    heads = heads.drop("customer_id", "warehouse_id")
    own = ["order_item_id", "order_id", "product_id", "quantity", "unit_price"]
    lines = join_products(items.select(*own), products, policy, facts).drop("product_id")
    if facts.uncrowded(policy):
        ordered = met_heads(heads, customers, warehouses, inputs, policy, facts).join(
            met_lines(lines, products, inputs, policy, facts), "order_id"
        )
        met = _meeting(shipments.select(*CARRIED), ["order_id"], inputs, facts)
        wide = ordered.join(met, "order_id", "left")
    else:
        partitions = partitions_needed(orders.sparkSession, inputs)
        found = crowded_orders(items, shipments, policy, facts, partitions)
        deal = partial(dealt, partitions=partitions)
        # An order meets the rows of a group, so it need not be in each of their batches.
        ordered = place_groups(heads, found, deal).drop(LINES, SHIPMENTS, *SPANS)
        placed = place_groups(lines, found, deal, LINES, "order_item_id")
        wide = _ship(placed, shipments, found, deal).join(ordered, MEET_BY)
    if months:
        wide = wide.withColumn("order_month", F.trunc("order_date", "month")).hint("rebalance", F.col("order_month"))
    return (
        wide.withColumnsRenamed(
            {
                "known_customer_id": "customer_id",
                "known_warehouse_id": "warehouse_id",
                "known_product_id": "product_id",
            }
        )
        .withColumns(
            {
                "line_revenue": line_revenue(),
                "delivery_days": delivery_days(),
                "curated_timestamp": F.current_timestamp(),
            }
        )
        .select(*ORDER_ANALYTICS_COLUMNS, "curated_timestamp", *(["order_month"] if months else []))
    )

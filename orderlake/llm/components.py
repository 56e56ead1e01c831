"""Connected components of links between nodes, with tables only.

Every node is moved to the smallest node it sees, first along its links to larger nodes,
then along those to smaller ones, until each component is a star around its smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import Work

MOST_ROUNDS = 100


def _step(links: DataFrame, larger: bool, work: Work) -> DataFrame:
    """One star step on distinct links ``(a, b)`` with a < b."""
    flipped = links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    seen = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(flipped) if larger else flipped
    least = work.table(seen.groupBy("u").agg(F.min("v").alias("m")), "least")
    met = seen.join(least, "u")
    m = F.least("m", "u") if larger else F.col("m")
    moved = met.where(F.col("v") > F.col("u")) if larger else met
    out = moved.select(m.alias("a"), F.col("v").alias("b"))
    if not larger:
        out = out.union(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return work.table(out.where(F.col("a") < F.col("b")).distinct(), "links")


def _settled(links: DataFrame) -> bool:
    """Whether every node sees one smaller node at most, and none that is a larger node elsewhere."""
    seen = links.select(F.col("b").alias("x"), F.col("a").alias("p"))
    seen = seen.union(links.select(F.col("a"), F.col("a")))
    return seen.groupBy("x").agg(F.min("p").alias("p"), F.max("p").alias("q")).where("p < q").isEmpty()


def connected(links: DataFrame, work: Work) -> DataFrame:
    """``(node, label)`` of all nodes of the links ``(a, b)``; the label is the smallest node."""
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = work.table(ordered.where(F.col("a") < F.col("b")).distinct(), "links")
    for _ in range(MOST_ROUNDS):
        if _settled(links):
            break
        links = _step(_step(links, True, work), False, work)
    else:
        raise RuntimeError("components did not settle")
    ends = links.select(F.col("b").alias("node"), F.col("a").alias("label"))
    return work.table(ends.union(links.select(F.col("a"), F.col("a")).distinct()), "labels")


def joined(groups: DataFrame, links: DataFrame, work: Work) -> DataFrame:
    """The components of ``groups`` and further ``links``: only labels are connected anew."""
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    fresh = nodes.join(groups, "node", "left_anti").select("node", F.col("node").alias("label"))
    groups = work.table(groups.union(fresh), "joined")
    of_a = groups.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    of_b = groups.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    between = links.join(of_a, "a").join(of_b, "b").select(
        F.col("label_a").alias("a"), F.col("label_b").alias("b")
    )
    merged = connected(between, work).select(F.col("node").alias("old"), F.col("label").alias("new"))
    return work.table(
        groups.join(merged, F.col("label") == F.col("old"), "left").select(
            "node", F.coalesce("new", "label").alias("label")
        ),
        "labels",
    )

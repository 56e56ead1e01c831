"""Near duplicates by SetSketch registers, banding, likelihood and full shingle sets.

Each distinct shingle set gets a sketch of exponentially spaced, truncated
minima. Sketches merge by the larger register. Bands of equal registers bring
candidates together; the joint likelihood of two sketches and their known set sizes
gives an estimate of the similarity, which drops most false candidates; the rest
is confirmed on full sets.

Candidates of a bucket are tried in rounds: first against two of its members,
then against another member per bucket, and at last across the components that are left in a
bucket: all against all in a small one, and in a large one those that share one of their
rarest shingles, as linked sets must. A large group of near copies is mostly one component after the
first rounds, so its pairs are never all formed. No bucket and no number of
partners is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.binary_fuse import mixed
from orderlake.llm.common import Work, whole_text
from orderlake.llm.components import connected, joined
from orderlake.llm.shingles import sets_of

U = np.uint64

# Spacing, rate and highest value of the registers.
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 2
BAND = 5
BANDS = 48
REGISTERS = BAND * BANDS
# Similarity of linked documents, as a fraction.
SHARED, OF = 75, 100
# A bucket up to this size gives all its pairs at once.
SMALL_BUCKET = 12
# Ratio of the limits of a class of set sizes.
CLASS = 1.05
# An estimate is off by less than this many of its standard errors.
ERRORS = 6.0

_RANDOM = np.random.default_rng(3)
_FACTORS = _RANDOM.integers(1, 2**63, REGISTERS, dtype=np.uint64) | U(1)
_TERMS = _RANDOM.integers(0, 2**63, REGISTERS, dtype=np.uint64)

SKETCHED = "doc_id long, some_doc long, n long, node binary, sketch binary"
# Elements hashed at once for all registers, so that they stay in the cache.
BLOCK = 1 << 15


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The smallest hash per register (columns) of each set, none of them empty (rows)."""
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    merged = np.concatenate(sets)
    least = np.empty((len(sets), REGISTERS), U)
    with np.errstate(over="ignore"):
        for k in range(REGISTERS):
            least[:, k] = np.minimum.reduceat(merged * _FACTORS[k] + _TERMS[k], starts)
    return least


def registers(least: np.ndarray) -> np.ndarray:
    """Truncated logarithms of exponentially distributed minima."""
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64)
    level = np.floor(1 - np.log(exponential / RATE) / np.log(BASE))
    return np.clip(level, 0, TOP + 1).astype(np.uint16)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Sketches of non-empty sets. A long set is sketched in blocks that are then merged."""
    blocks, owner = [], []
    for k, s in enumerate(sets):
        parts = [s[i : i + BLOCK] for i in range(0, len(s), BLOCK)]
        blocks += parts
        owner += [k] * len(parts)
    made, at, size = [], 0, 0
    for k, block in enumerate(blocks):
        size += len(block)
        if size >= BLOCK or k == len(blocks) - 1:
            made.append(registers(minima(blocks[at : k + 1])))
            at, size = k + 1, 0
    first = np.flatnonzero(np.diff([-1, *owner]))
    return np.maximum.reduceat(np.concatenate(made), first)


def _node(s: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    with np.errstate(over="ignore"):
        sums = [mixed(s, seed).sum(dtype=U) + U(len(s)) for seed in (11, 12)]
    return np.array(sums, U).tobytes()


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for sets in sets_of(batch.column("text")):
            full = [s for s in sets if len(s)]
            rows = iter(sketch(full)) if full else iter(())
            columns = [
                batch.column("doc_id").slice(at, len(sets)),
                batch.column("some_doc").slice(at, len(sets)),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_node(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
            ]
            at += len(sets)
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "some_doc", "n", "node", "sketch"]
            )


def _log_p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard similarity of greatest joint likelihood, for rows of sketches and set sizes.

    Depends on how many registers are larger, smaller and equal. The likelihood
    is concave, so its maximum is found by ternary search.
    """
    larger, smaller = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - larger - smaller
    u = na / (na + nb)
    v = 1 - u
    tiny = 1e-12

    def likelihood(j):
        p, q = _log_p(u - v * j), _log_p(v - u * j)
        rest = np.maximum(1 - p - q, tiny)
        return (
            larger * np.log(np.maximum(p, tiny))
            + smaller * np.log(np.maximum(q, tiny))
            + equal * np.log(rest)
        )

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        third = (high - low) / 3
        left, right = low + third, high - third
        better = likelihood(left) < likelihood(right)
        low, high = np.where(better, left, low), np.where(better, high, right)
    return (low + high) / 2


def least_estimate(shared: int = SHARED, of: int = OF) -> float:
    j = shared / of
    return j - ERRORS * float(np.sqrt(j * (1 - j) / REGISTERS))


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    least = least_estimate()
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            for c in ("sketch_a", "sketch_b")
        )
        na, nb = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
        keep = pa.array(similarity(a, b, na, nb) >= least)
        yield batch.select(["a", "b"]).filter(keep)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flat(column):
        return (s for sets in sets_of(column) for s in sets)

    for batch in batches:
        linked = []
        for x, y in zip(flat(batch.column("text_a")), flat(batch.column("text_b"))):
            shared = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(OF * shared >= SHARED * (len(x) + len(y) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


@dataclass
class Search:
    """Distinct sets with a document that has them, and the documents' texts."""

    docs: DataFrame
    sets: DataFrame
    work: Work

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs of ids to pairs of nodes whose sketches speak for a link."""
        one = self.sets.select("id", "node", "n", "sketch")

        def side(name):
            return one.select(*(F.col(c).alias(f"{c}_{name}") for c in one.columns))

        near = F.least("n_a", "n_b") * OF >= F.greatest("n_a", "n_b") * SHARED
        return (
            pairs.join(side("a"), "id_a")
            .join(side("b"), "id_b")
            .where(near & (F.col("node_a") != F.col("node_b")))
            .select(
                F.least("node_a", "node_b").alias("a"),
                F.greatest("node_a", "node_b").alias("b"),
                *("n_a", "n_b", "sketch_a", "sketch_b"),
            )
            .mapInArrow(_likely, "a binary, b binary")
            .distinct()
        )

    def texts(self, nodes: DataFrame, name: str) -> DataFrame:
        """``(node, text)``: a text that has the set, for each of ``nodes``."""
        wanted = self.sets.join(nodes, "node", "left_semi").select("node", "some_doc")
        found = (
            self.docs.select(_row_key().alias("some_doc"), whole_text().alias("text"))
            .join(wanted, "some_doc")
            .groupBy("node")
            .agg(F.first("text").alias("text"))
        )
        return self.work.table(found, f"texts-{name}")

    def linked(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs of nodes that are linked by their full sets."""
        likely = self.work.table(self.likely(pairs), f"likely-{name}")
        if likely.isEmpty():
            return likely
        ends = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
        texts = self.texts(ends, name)
        found = (
            likely.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .mapInArrow(_confirmed, "a binary, b binary")
        )
        return self.work.table(found, f"linked-{name}")


def _row_key():
    """Names a row by id and text; repetitions of a row share it."""
    return F.xxhash64("doc_id", whole_text())


def _pairs(ids: DataFrame, one: str, other: str) -> DataFrame:
    """Distinct pairs of different ids, the smaller first."""
    return (
        ids.where(F.col(one) != F.col(other))
        .select(F.least(one, other).alias("id_a"), F.greatest(one, other).alias("id_b"))
        .distinct()
    )


def near_groups(docs: DataFrame, with_row: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Links reach from document to document, and ``component_id`` is the smallest
    doc_id reached. Documents without words are linked with nothing and stay.
    Rows that repeat an id and a text share a component; NULL ids have no smallest id of
    their own and take that of their component, if any. No rows give no rows.
    ``with_row`` adds ``some_doc``, which names a row by its id and text.
    """
    work = Work(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    keyed = docs.select("doc_id", _row_key().alias("some_doc"), whole_text().alias("text"))
    sketched = work.table(keyed.mapInArrow(_sketched, SKETCHED), "sketched")
    sets = _distinct_sets(sketched, work)
    search = Search(docs, sets, work)
    members = _crowded(sets, work)

    stars = members.select("id", F.explode(F.array("low", "high")).alias("head"))
    links = search.linked(_pairs(stars, "id", "head"), "stars")
    groups = connected(links, work)
    for name, pairs in (("heads", _to_heads), ("rest", _rest)):
        mixed_buckets = _mixed(members, sets, groups, work)
        if mixed_buckets.isEmpty():
            break
        more = search.linked(pairs(mixed_buckets, search), name)
        if not more.isEmpty():
            groups = joined(groups, more, work)
    found = _labelled(sketched, sets, groups, work)
    return found if with_row else found.drop("some_doc")


def _distinct_sets(sketched: DataFrame, work: Work) -> DataFrame:
    """One row per distinct set: node, id (64 bits of it), n, sketch and a document that has it."""
    some = (
        sketched.where("n > 0")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("some_id"), F.first("n").alias("n"),
            F.first("sketch").alias("sketch"), F.min("some_doc").alias("some_doc"),
        )
    )
    return work.table(some.withColumn("id", F.xxhash64("node")), "sets")


def _crowded(sets: DataFrame, work: Work) -> DataFrame:
    """``(bucket, id, low, high)`` of buckets with several sets."""
    start = F.lit(2 * BAND)
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda k: F.xxhash64(F.substring(F.col("sketch"), k * start + 1, start), k),
    )
    placed = sets.select(F.explode(bands).alias("bucket"), "id")
    crowded = (
        placed.groupBy("bucket")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high")
    )
    return work.table(placed.join(work.table(crowded, "crowded"), "bucket"), "members")


def _mixed(members: DataFrame, sets: DataFrame, groups: DataFrame, work: Work) -> DataFrame:
    """``(bucket, id, label)`` of the buckets that hold more than one component."""
    label = F.coalesce("label", "node")
    named = (
        members.select("bucket", "id")
        .join(sets.select("id", "node"), "id")
        .join(groups, "node", "left")
        .select("bucket", "id", label.alias("label"))
    )
    named = work.table(named, "named")
    spread = (
        named.groupBy("bucket")
        .agg(F.min("label").alias("first"), F.max("label").alias("last"))
        .where("first < last")
        .select("bucket")
    )
    return work.table(named.join(work.table(spread, "spread"), "bucket", "left_semi"), "mixed")


def _to_heads(members: DataFrame, search: Search) -> DataFrame:
    """Pairs of each id with one id per bucket, another in every bucket."""
    heads = members.groupBy("bucket").agg(
        F.min(F.struct(F.xxhash64("bucket", "id"), "id", "label")).alias("head")
    )
    met = members.join(heads, "bucket").where(F.col("label") != F.col("head.label"))
    return _pairs(met.select("id", F.col("head.id").alias("other")), "id", "other")


def _rest(members: DataFrame, search: Search) -> DataFrame:
    """All pairs of ids that share a bucket, lie in different components and may be linked.

    A small bucket gives all its pairs. The members of large ones are paired where the rarest shingles
    of both meet, which no linked pair avoids.
    """
    work = search.work
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    small = members.join(work.table(sizes.where(F.col("size") <= SMALL_BUCKET), "small"), "bucket", "left_semi")
    large = members.join(work.table(sizes.where(F.col("size") > SMALL_BUCKET), "large"), "bucket", "left_semi")
    return _across(small).union(_rare_pairs(large, search)).distinct()


def _across(members: DataFrame) -> DataFrame:
    """All pairs of ids in one bucket with different labels."""
    other = members.select("bucket", F.col("id").alias("other"), F.col("label").alias("its"))
    met = members.join(other, "bucket")
    return _pairs(met.where(F.col("label") < F.col("its")), "id", "other")


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for sets in sets_of(batch.column("text")):
            lists = [s.view(np.int64) for s in sets]
            ends = np.cumsum([0, *map(len, lists)])
            hashes = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.concatenate(lists))
            )
            part = batch.slice(at, len(sets))
            at += len(sets)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), hashes], ["id", "label", "hashes"]
            )


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.lit(float(np.log(CLASS))))


def _rare_pairs(members: DataFrame, search: Search) -> DataFrame:
    """Pairs of ids of different components that share one of their rarest shingles.

    Sets of n and m shingles can only be linked when they share a certain part of n + m, so with
    the shingles of both in one order, rare ones first, they meet before that part begins.
    The order of a set is cut for each class of sizes that a partner may have.
    """
    work = search.work
    chosen = members.select("id", "label").distinct()
    named = work.table(chosen.join(search.sets.select("id", "node"), "id"), "large")
    texts = search.texts(named.select("node").distinct(), "large")
    shingled = work.table(
        named.join(texts, "node").select("id", "label", "text")
        .mapInArrow(_shingled, "id long, label binary, hashes array<long>"),
        "shingled",
    )
    each = shingled.select("id", "label", F.size("hashes").alias("n"), F.explode("hashes").alias("h"))
    common = work.table(
        each.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "common"
    )
    # Shingles that no other set has stand first in the order and meet nobody: their number is enough.
    ordered = (
        each.join(common, "h")
        .groupBy("id", "label", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("shared"))
    )
    n, part = F.col("n"), SHARED / (SHARED + OF)
    own = _size_class(n)
    classes = F.sequence(
        _size_class(F.greatest(F.floor(n * (SHARED / OF)), F.lit(1))) - 1,
        _size_class(F.ceil(n * (OF / SHARED))) + 1,
    )
    partner = F.floor(F.pow(F.lit(CLASS), F.col("partner")))
    reach = n - F.ceil((n + partner) * part - 1e-6) + 1
    alone = n - F.size("shared")
    keys = (
        ordered.select("id", "label", "n", "shared", own.alias("own"), F.explode(classes).alias("partner"))
        .withColumn("length", F.greatest(reach - alone, F.lit(0)).cast("int"))
        .select(
            "id", "label", "n", "own", alone.alias("alone"),
            F.least("own", "partner").alias("low"), F.greatest("own", "partner").alias("high"),
            F.posexplode(F.slice("shared", F.lit(1), F.col("length"))["h"]).alias("at", "h"),
        )
        .withColumn("at", F.col("at") + F.col("alone"))
        .drop("alone")
    )
    keys = work.table(keys, "keys")
    meet = ["low", "high", "h"]
    # One of a pair has the lower class of sizes, the other the higher.
    other = keys.where("own = high").select(
        *meet, F.col("id").alias("other"), F.col("label").alias("its"),
        F.col("n").alias("m"), F.col("at").alias("there"),
    )
    once = F.when(F.col("low") == F.col("high"), F.col("label") < F.col("its"))
    # What the exact sizes of both ask for is stricter than what their classes do.
    common = F.ceil((n + F.col("m")) * part - 1e-6)
    early = (F.col("at") <= n - common) & (F.col("there") <= F.col("m") - common)
    met = keys.where("own = low").join(other, meet)
    met = met.where(early & once.otherwise(F.col("label") != F.col("its")))
    return _pairs(met, "id", "other")


def _labelled(
    sketched: DataFrame, sets: DataFrame, groups: DataFrame, work: Work
) -> DataFrame:
    named = groups.join(sets.select("node", "some_id"), "node")
    least = named.groupBy("label").agg(F.min("some_id").alias("component_id"))
    named = work.table(
        groups.join(work.table(least, "least"), "label").select("node", "component_id"), "named"
    )
    own = work.table(
        sets.select("node", "some_id").join(named, "node", "left")
        .select("node", F.coalesce("component_id", "some_id").alias("component_id")),
        "own",
    )
    component = F.coalesce("component_id", "doc_id")
    return sketched.select("doc_id", "some_doc", F.col("n").alias("n_shingles"), "node").join(
        own, "node", "left"
    ).select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "some_doc",
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, one document of each component.

    Rows that share the id of the document that stays and are not linked with it stay too, as each
    is the smallest of its own component.
    """
    work = Work(docs.sparkSession)
    groups = work.table(near_groups(docs, with_row=True), "groups")
    gone = groups.where(~F.col("kept")).select(
        F.col("doc_id").alias("_gone_id"), F.col("some_doc").alias("_gone_doc")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (_row_key() == F.col("_gone_doc"))
    return docs.join(gone.distinct(), same, "left_anti")

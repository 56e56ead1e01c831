"""Raw to processed and rejected, and processed to curated, as written tables.

Cleaning one table takes three steps, each reading what the last one wrote:

1. Prepare the raw rows and write them as columns to shared scratch. This is
   the only time the raw text is read and parsed.
2. Count the rows per key, from that one column, and write the repeated keys.
3. Attach the counts, judge, and write the two zones. When the repeated keys
   are few, which their written size tells, they are broadcast and no row is
   shuffled. Otherwise the judged rows are shuffled, once, and written apart by verdict.

Losing an executor costs the tasks it ran, never an earlier step.

Orders, lines and shipments are written in buckets by order, so that what joins or groups them by order later does not
shuffle them. Lines and shipments are counted per order on the way. The largest counts say whether an order is too large for a
bucket, and whether the curated join must look after crowded orders.

A run becomes visible with its record, all zones at once (see ``sources.records``).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlake.operators.duplicates import broadcast_counts, repeated_keys, shuffled_counts
from orderlake.operators.quality import (
    TableSpec,
    any_broken,
    prepare,
    rejected_rows,
    valid_rows,
)
from orderlake.operators.rules import SPECS
from orderlake.operators.skew import DEFAULT_POLICY, SkewPolicy, broadcast_bytes
from orderlake.operators.sizing import PARTITIONS, input_bytes, partitions_for
from orderlake.plans.curated import Facts, build_order_analytics
from orderlake.plans.rollup import build_rollup
from orderlake.schemas import CURATED_INPUTS, TABLES
from orderlake.sources import (
    BAD_LINE,
    BAD_LINES,
    COUNTS,
    CURATED,
    CURATED_TABLE,
    PROCESSED,
    RAW_ZONE,
    REJECTED,
    ROLLUP_TABLE,
    Written,
    bad_lines_of,
    commit,
    last_record,
    new_run,
    read_raw,
    read_written,
    remove_run_folders,
    unsorted_writes,
    unused_folders,
    write_run,
)
from orderlake.sources.work import new_work_folder, observed, remove_work_folder, written


@dataclass(frozen=True)
class PipelineOptions:
    # Repeated keys are broadcast up to this size; None takes the session's threshold, or ``REPEATED_KEYS`` of them.
    broadcast_bytes: int | None = None
    policy: SkewPolicy = DEFAULT_POLICY
    # ``order_month`` is made from the order's date; slicers by date then read the months they need.
    partition_curated_by: Sequence[str] = ("order_month",)
    # Buckets of orders, lines and shipments; None for as many as their size needs, 0 for none.
    buckets: int | None = None
    # Tables cleaned side by side; small ones would leave a cluster idle.
    tables_at_once: int = 4


DEFAULT_OPTIONS = PipelineOptions()

# What a row of the list of repeated keys takes besides the text of its key.
ROW_BYTES = 32
# So many repeated keys are broadcast in a session that broadcasts at all: their number is known and not estimated, a key takes
# about 100 bytes as its codes (150 MB), and the other way moves and writes every row of the table once more.
REPEATED_KEYS = 1_500_000


# The tables that meet by order, and those of which an order has many rows.
BY_ORDER = ("orders", "order_items", "shipments")
PER_ORDER = ("order_items", "shipments")


def _repeated(prepared: DataFrame, key: str, path: str, options: PipelineOptions):
    """The repeated keys as a written table, and whether they are few enough to broadcast."""
    size = Observation()
    repeated = written(
        repeated_keys(prepared, key).observe(
            size,
            F.count(F.lit(1)).alias("keys"),
            F.coalesce(F.sum(F.length(key)), F.lit(0)).alias("chars"),
        ),
        path,
    )
    found = observed(size, {"keys": 0, "chars": 0})
    asked = options.broadcast_bytes
    limit = broadcast_bytes(prepared) if asked is None else asked
    listed = asked is None and limit > 0 and found["keys"] <= REPEATED_KEYS
    return repeated, listed or found["keys"] * ROW_BYTES + 4 * found["chars"] <= limit


def _order_counts(valid: DataFrame, out: str, table: str, run: str) -> Written:
    """Write the rows per order of a written table, where an order has several, and keep the largest count.

    Where it lies in buckets by order, nothing is shuffled.
    """
    most = Observation()
    counts = valid.groupBy("order_id").agg(F.count(F.lit(1)).alias("rows"))
    seen = counts.observe(most, F.coalesce(F.max("rows"), F.lit(0)).alias("most")).where("rows > 1")
    entry = write_run(seen, out, COUNTS, table, run)
    return replace(entry, most_per_order=observed(most, {"most": 0})["most"])


def clean_table(
    raw: DataFrame,
    spec: TableSpec,
    out: str,
    work: str,
    options: PipelineOptions = DEFAULT_OPTIONS,
    run: str | None = None,
    buckets: int = 0,
) -> list[Written]:
    """Write the processed and the rejected rows of one table; what was written is for the record.

    Without a ``run`` it is a run of its own, and its record is written too.
    """
    if run is None:
        run = new_run()
        entries = clean_table(raw, spec, out, work, options, run, buckets)
        commit(raw.sparkSession, out, entries)
        return entries
    came = Observation()
    counted = prepare(raw, spec).observe(came, F.count(F.lit(1)).alias("rows"))
    prepared = written(counted, f"{work}/prepared/{spec.name}", dictionary=False)
    repeated, small = _repeated(prepared, spec.key, f"{work}/repeated/{spec.name}", options)
    if small:
        valid = rejected = broadcast_counts(prepared, spec.key, repeated)
    else:
        judged = shuffled_counts(prepared, spec.key, repeated, options.policy)
        apart = written(
            judged.withColumn("_broken", any_broken(spec.rules)),
            f"{work}/judged/{spec.name}",
            partition_by="_broken",
            dictionary=False,
        )
        valid = apart.where(~F.col("_broken")).drop("_broken")
        rejected = apart.where("_broken").drop("_broken")
    valid, rejected = (
        rows.drop(BAD_LINE) for rows in (valid_rows(valid, spec), rejected_rows(rejected, spec))
    )
    entries = [Written(RAW_ZONE, spec.name, None, observed(came, {"rows": 0})["rows"])]
    by = "order_id" if spec.name in BY_ORDER and buckets else None
    # Few rows are rejected by each task; without this they would lie in as many small files.
    writes = [
        lambda: write_run(valid, out, PROCESSED, spec.name, run, (), buckets if by else 0, by),
        lambda: write_run(rejected.hint("rebalance"), out, REJECTED, spec.name, run),
    ]
    if BAD_LINE in prepared.columns:
        lines = bad_lines_of(prepared, spec.name).hint("rebalance")
        writes.append(lambda: write_run(lines, out, BAD_LINES, spec.name, run))
    with ThreadPoolExecutor(len(writes)) as pool:
        processed, *others = pool.map(lambda write: write(), writes)
    if spec.name in PER_ORDER:
        spark = raw.sparkSession
        entries.append(_order_counts(read_written(spark, out, PROCESSED, spec.name, processed), out, spec.name, run))
        # All rows of an order lie in one bucket, which a task must be able to hold. Else they are written anew without.
        if by and entries[-1].most_per_order > options.policy.rows_per_slot:
            remove_run_folders(spark, out, [processed.folder])
            processed = write_run(valid, out, PROCESSED, spec.name, run)
    return [*entries, processed, *others]


def buckets_for(raw: Mapping[str, DataFrame], options: PipelineOptions = DEFAULT_OPTIONS) -> int:
    """As many buckets as a shuffle of the largest of the tables would have partitions."""
    if options.buckets is not None:
        return options.buckets
    frames = [raw[table] for table in BY_ORDER if table in raw]
    if not frames:
        return 0
    now = frames[0].sparkSession.conf.get(PARTITIONS)
    return max(int(now) if now.isdigit() else 1, partitions_for(sum(map(input_bytes, frames))))


def _clean_all(
    spark: SparkSession, raw: Mapping[str, DataFrame], out: str, options: PipelineOptions, run: str
) -> list[Written]:
    work = new_work_folder(spark)
    buckets = buckets_for(raw, options)

    def clean(table: str) -> list[Written]:
        return clean_table(raw[table], SPECS[table], out, work, options, run, buckets)

    try:
        with unsorted_writes(spark), ThreadPoolExecutor(options.tables_at_once) as pool:
            found = pool.map(clean, sorted(raw, key=_largest_first))
            return [entry for entries in found for entry in entries]
    finally:
        remove_work_folder(spark, work)


def clean_all(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out: str,
    options: PipelineOptions = DEFAULT_OPTIONS,
) -> None:
    """Write the processed and rejected zones of all the given tables, which become current together.

    Orders, lines and shipments get the same buckets in one run, or where ``options`` tell their number.
    """
    with _run(spark, out) as (run, entries):
        entries += _clean_all(spark, raw, out, options, run)


def _largest_first(table: str) -> int:
    big = ("order_items", "shipments", "orders")
    return big.index(table) if table in big else len(big)


@contextmanager
def _run(spark: SparkSession, out: str) -> Iterator[tuple[str, list[Written]]]:
    """A run: its tables become current at its end, or are deleted if it fails."""
    run, entries = new_run(), []
    try:
        yield run, entries
    except BaseException:
        remove_run_folders(spark, out, [f"{zone}/{table}/{run}" for zone, table in _places()])
        raise
    commit(spark, out, entries)
    remove_run_folders(spark, out, unused_folders(spark, out))


def _places() -> list[tuple[str, str]]:
    cleaned = [(zone, table) for zone in (PROCESSED, REJECTED, BAD_LINES) for table in TABLES]
    counts = [(COUNTS, table) for table in PER_ORDER]
    return [*cleaned, *counts, (CURATED, CURATED_TABLE), (CURATED, ROLLUP_TABLE)]


def facts_of(
    spark: SparkSession, out: str, record: Mapping[tuple[str, str], Written] | None = None
) -> Facts:
    """What the record tells about the inputs of the curated join."""
    record = last_record(spark, out) if record is None else record
    inputs = {t: record[PROCESSED, t] for t in CURATED_INPUTS if (PROCESSED, t) in record}
    counts = [record.get((COUNTS, t)) for t in PER_ORDER]
    if len(inputs) < len(CURATED_INPUTS) or None in counts:
        return Facts()
    lines, shipments = (read_written(spark, out, COUNTS, c.table_name, c) for c in counts)
    return Facts(
        {t: entry.rows for t, entry in inputs.items()},
        *(c.most_per_order for c in counts),
        lines,
        shipments,
        inputs["orders"].buckets > 0 and len({inputs[t].buckets for t in BY_ORDER}) == 1,
        inputs["orders"].buckets,
    )


def _build_curated(
    spark: SparkSession,
    out: str,
    options: PipelineOptions,
    run: str,
    record: Mapping[tuple[str, str], Written],
    tables: Sequence[str] = (CURATED_TABLE, ROLLUP_TABLE),
) -> list[Written]:
    inputs = [read_written(spark, out, PROCESSED, t, record.get((PROCESSED, t))) for t in CURATED_INPUTS]
    facts = facts_of(spark, out, record)
    entries = []
    if CURATED_TABLE in tables:
        by = list(options.partition_curated_by)
        wide = build_order_analytics(*inputs, policy=options.policy, facts=facts, months="order_month" in by)
        if by and by != ["order_month"]:
            # Few files per value, and large values over many tasks.
            wide = wide.hint("rebalance", *map(F.col, by))
        with unsorted_writes(spark):
            entries.append(write_run(wide, out, CURATED, CURATED_TABLE, run, by))
    if ROLLUP_TABLE in tables:
        rollup = build_rollup(*inputs, policy=options.policy, facts=facts)
        entries.append(write_run(rollup, out, CURATED, ROLLUP_TABLE, run))
    return entries


def build_curated(
    spark: SparkSession,
    out: str,
    options: PipelineOptions = DEFAULT_OPTIONS,
    tables: Sequence[str] = (CURATED_TABLE, ROLLUP_TABLE),
) -> None:
    """Write the curated table and its roll-up, or one of them, from the processed zone."""
    with _run(spark, out) as (run, entries):
        entries += _build_curated(spark, out, options, run, last_record(spark, out), tables)


def run_pipeline(
    spark: SparkSession,
    raw: str | Mapping[str, DataFrame],
    out: str,
    options: PipelineOptions = DEFAULT_OPTIONS,
) -> None:
    """Raw files, or ready raw frames by table name, to all zones under ``out``, which become current together."""
    if isinstance(raw, str):
        raw = {table: read_raw(spark, raw, table, lines=True) for table in TABLES}
    with _run(spark, out) as (run, entries):
        entries += _clean_all(spark, raw, out, options, run)
        record = {(w.zone, w.table_name): w for w in entries}
        entries += _build_curated(spark, out, options, run, record)

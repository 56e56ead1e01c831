"""

Cleaning queries run on the raw tables. Queries on the processed or curated
zone read those zones as written by the pipeline, once per session and data,
into the shared folder of the session.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import threading
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402
from orderlake.fixtures import raw_table  # noqa: E402
from orderlake.functions import (  # noqa: E402
    dax_divide,
    normalize_blank_strings,
    parsed_name,
    safe_divide,
    type_numbers,
)
from orderlake.operators.duplicates import COUNT, add_duplicate_count  # noqa: E402
from orderlake.operators.quality import prepare, reject_summary, split  # noqa: E402
from orderlake.operators.rules import SPECS  # noqa: E402
from orderlake.operators.skew import DEFAULT_POLICY, SkewPolicy  # noqa: E402
from orderlake.plans import checks, curated, dashboard, reports, rollup  # noqa: E402
from orderlake.plans.pipeline import (  # noqa: E402
    BY_ORDER,
    PER_ORDER,
    PipelineOptions,
    buckets_for,
    build_curated,
    clean_all,
    facts_of,
)
from orderlake.schemas import CURATED_INPUTS, ORDER_ANALYTICS_COLUMNS, TABLES  # noqa: E402
from orderlake.sources import (  # noqa: E402
    CURATED,
    CURATED_TABLE,
    PROCESSED,
    RAW_ZONE,
    REJECTED,
    ROLLUP_TABLE,
    last_record,
    read_raw,
    read_zone,
    record,
    zone_path,
)
from orderlake.sources.work import new_work_folder  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    import orderlake.llm.queries as corpus  # noqa: E402
except ModuleNotFoundError as error:
    # The corpus operators can be taken out; only their own absence is passed over.
    if not (error.name or "").startswith(("orderlake.llm", "corpus_pipeline")):
        raise
    corpus = None

Query = Callable[[SparkSession, str], DataFrame]

CLOCKS = ("ingestion_timestamp", "rejected_timestamp", "curated_timestamp")

# Makes many keys of the test tables hot.
FORCED = SkewPolicy(rows_per_slot=3, keys_per_partition=10**6, lookup_bytes=-1)

SLICERS = dashboard.Slicers(
    warehouse_city=["NATION_1", "NATION_7", "NATION_12"],
    order_status=["Delivered", "Shipped"],
    category=["ECONOMY", "PROMO", "LARGE"],
    date_from=dt.date(1996, 1, 1),
    date_to=dt.date(1999, 12, 31),
)


class Zones:
    """The zones of one set of driver tables, made by the steps of the pipeline from CSV files of them.

    Each step runs once per session and data, when a query first asks for a table that it writes: the CSV files of a
    table, its cleaning (lines and shipments in one run and with orders, which may come first), the curated table, the roll-up.
    """

    _written: dict[tuple, str] = {}
    _done: dict[str, set[tuple[str, str]]] = {}
    _lock = threading.RLock()

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self._versions())
        with self._lock:
            if key not in self._written:
                self._written[key] = new_work_folder(self.spark)
            self._base = self._written[key]

    @property
    def base(self) -> str:
        """The folder of all zones, with every step done."""
        self._clean(TABLES)
        self._build(CURATED_TABLE)
        self._build(ROLLUP_TABLE)
        return self._base

    def cleaned(self) -> str:
        """The same folder, with all tables cleaned."""
        self._clean(TABLES)
        return self._base

    def _undone(self, step: str, tables: Iterable[str]) -> list[str]:
        return [t for t in tables if (step, t) not in self._done.setdefault(self._base, set())]

    def _did(self, step: str, tables: Iterable[str]) -> None:
        self._done[self._base] |= {(step, table) for table in tables}

    def _write_csv(self, tables: Iterable[str]) -> None:
        def write(table: str) -> None:
            # Packed files cannot be cut, so that none is long. Packed fast: half the time of the write for 15% more bytes.
            packed = as_csv(self.raw(table)).option("compression", "gzip").option("maxRecordsPerFile", 500_000)
            packed = packed.option("zlib.compress.level", "BEST_SPEED")
            packed.mode("overwrite").csv(zone_path(self._base, RAW_ZONE, table), header=True)

        with self._lock:
            todo = self._undone(RAW_ZONE, tables)
            with ThreadPoolExecutor(4) as pool:
                list(pool.map(write, todo))
            self._did(RAW_ZONE, todo)

    def _clean(self, tables: Iterable[str]) -> None:
        wanted = set(tables)
        if wanted & set(PER_ORDER):
            wanted |= set(BY_ORDER)
        with self._lock:
            todo = self._undone(PROCESSED, sorted(wanted))
            if todo:
                self._write_csv(todo)
                raw = {table: read_raw(self.spark, self._base, table, lines=True) for table in todo}
                # Whichever is cleaned first, the tables that meet by order lie in as many buckets.
                buckets = buckets_for({table: self.raw(table) for table in BY_ORDER})
                clean_all(self.spark, raw, self._base, PipelineOptions(buckets=buckets))
                self._did(PROCESSED, todo)

    def _build(self, table: str) -> None:
        with self._lock:
            self._clean(CURATED_INPUTS)
            if self._undone(CURATED, [table]):
                build_curated(self.spark, self._base, tables=[table])
                self._did(CURATED, [table])

    def _versions(self) -> tuple:
        """Size and age of the driver tables, so that changed data is cleaned anew."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.sf_dir)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        return tuple(
            (f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files
        )

    def processed(self, table: str) -> DataFrame:
        self._clean([table])
        return self._typed(read_zone(self.spark, self._base, PROCESSED, table), table)

    def rejected(self, table: str) -> DataFrame:
        self._clean([table])
        return self._typed(read_zone(self.spark, self._base, REJECTED, table), table)

    def _typed(self, df: DataFrame, table: str) -> DataFrame:
        """Numbers of the types that the driver tables have, for comparison."""
        kinds = {f.name: f.dataType for f in self.raw(table).schema if f.dataType.typeName() != "string"}
        return df.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})

    def csv(self, table: str) -> DataFrame:
        """The raw rows as the CSV scan reads them, with typed numbers."""
        self._write_csv([table])
        read = type_numbers(read_raw(self.spark, self._base, table), SPECS[table].schema)
        return self._typed(read, table).select(*self.raw(table).columns)

    def raw(self, table: str) -> DataFrame:
        return raw_table(self.spark, self.sf_dir, table)

    def curated(self, derived: bool = False) -> DataFrame:
        self._build(CURATED_TABLE)
        wide = read_zone(self.spark, self._base, CURATED, CURATED_TABLE, derived)
        return wide.withColumn("quantity", F.col("quantity").cast("int"))

    def rollup(self) -> DataFrame:
        self._build(ROLLUP_TABLE)
        return read_zone(self.spark, self._base, CURATED, ROLLUP_TABLE)

    def facts(self) -> curated.Facts:
        self._clean(CURATED_INPUTS)
        return facts_of(self.spark, self._base)

    def sizes(self, *tables: str) -> curated.Facts:
        """The rows of some tables, cleaned side by side: all that a join with a lookup asks for."""
        self._clean(tables)
        now = last_record(self.spark, self._base)
        return curated.Facts({table: now[PROCESSED, table].rows for table in tables})


def as_csv(raw: DataFrame):
    """A writer that keeps blanks around values."""
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return raw.write.options(**kept)


def comparable(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Without clock columns, dates as ISO text, and sums rounded where ``digits`` says so."""
    dates = {name: F.col(name).cast("string") for name, kind in df.dtypes if kind == "date"}
    rounded = {name: F.round(name, places) for name, places in (digits or {}).items()}
    return df.drop(*CLOCKS).withColumns(dates | rounded)


# Cleaning


def _raw(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_table(spark, sf_dir, table)


def _normalize(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_blank_strings(raw_table(spark, sf_dir, table), SPECS[table].text)


def _duplicates(table: str, policy: SkewPolicy, spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = _normalize(table, spark, sf_dir)
    return add_duplicate_count(normal, SPECS[table].key, policy).withColumnRenamed(
        COUNT, "duplicate_count"
    )


def _processed(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(split(raw_table(spark, sf_dir, table), SPECS[table])[0])


def _rejected(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(split(raw_table(spark, sf_dir, table), SPECS[table])[1])


def _zone(zone: str, table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the pipeline wrote into a zone."""
    rows = getattr(Zones(spark, sf_dir), zone)(table)
    return comparable(rows.drop("source_file"))


def _csv(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return Zones(spark, sf_dir).csv(table)


def _reject_summary(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_summary(split(raw_table(spark, sf_dir, table), SPECS[table])[1])


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text and parsed date of all four date columns, in one long table."""
    parts = []
    for spec in SPECS.values():
        prepared = prepare(raw_table(spark, sf_dir, spec.name), spec)
        parts += [
            prepared.select(
                F.lit(f"{spec.name}.{column}").alias("source"),
                F.col(spec.key).alias("id"),
                F.col(column).alias("text"),
                F.col(parsed_name(column)).cast("string").alias("parsed"),
            )
            for column in spec.dates
        ]
    first, *others = parts
    for other in others:
        first = first.unionAll(other)
    return first


def safe_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both divisions over stock, which is zero for some products."""
    ratio = F.col("reorder_level").cast("double"), F.col("quantity_on_hand")
    return raw_table(spark, sf_dir, "inventory").select(
        F.trim("inventory_id").alias("inventory_id"),
        safe_divide(*ratio).alias("sql_ratio"),
        dax_divide(*ratio).alias("dax_ratio"),
    )


# Joins of the processed zone


def join_orders_items(policy: SkewPolicy, spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = Zones(spark, sf_dir)
    sizes = zones.sizes("orders", "order_items")
    orders = zones.processed("orders").select("order_id", "order_date", "order_status")
    items = zones.processed("order_items").drop(*CLOCKS)
    return comparable(curated.join_orders_items(orders, items, policy, facts=sizes))


def join_customers(policy: SkewPolicy, spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = Zones(spark, sf_dir)
    sizes = zones.sizes("orders", "customers")
    orders = zones.processed("orders").select("order_id", "customer_id")
    return curated.join_customers(orders, zones.processed("customers"), policy, facts=sizes)


def join_products(policy: SkewPolicy, spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = Zones(spark, sf_dir)
    sizes = zones.sizes("order_items", "products")
    items = zones.processed("order_items").select("order_item_id", "product_id")
    return curated.join_products(items, zones.processed("products"), policy, facts=sizes)


def join_warehouses(policy: SkewPolicy, spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = Zones(spark, sf_dir)
    sizes = zones.sizes("orders", "warehouses")
    orders = zones.processed("orders").select("order_id", "warehouse_id")
    return curated.join_warehouses(orders, zones.processed("warehouses"), policy, facts=sizes)


def join_shipments(policy: SkewPolicy, spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = Zones(spark, sf_dir)
    items = zones.processed("order_items").select("order_id", "order_item_id")
    return comparable(curated.join_shipments(items, zones.processed("shipments"), policy, facts=zones.facts()))


def order_analytics(policy: SkewPolicy, spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = Zones(spark, sf_dir)
    inputs = map(zones.processed, CURATED_INPUTS)
    return comparable(curated.build_order_analytics(*inputs, policy=policy, facts=zones.facts()))


def order_analytics_searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without the record of the zones: crowded orders are searched for."""
    inputs = map(Zones(spark, sf_dir).processed, CURATED_INPUTS)
    return comparable(curated.build_order_analytics(*inputs))


JOINS = {
    join.__name__: join
    for join in (
        join_orders_items,
        join_customers,
        join_products,
        join_warehouses,
        join_shipments,
        order_analytics,
    )
}

# Reports and checks of the curated table

REVENUE = {"total_revenue": 2}
KPIS = REVENUE | {
    "avg_order_value": 2,
    "avg_delivery_days": 6,
    "missing_shipment_ratio": 6,
}


def _sliced(report: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    return lambda oa: report(dashboard.apply_slicers(oa, SLICERS))


# name: report and the digits its sums are compared at
REPORTS: dict[str, tuple[Callable[[DataFrame], DataFrame], dict[str, int]]] = {
    # In an order that makes the ten rows the same everywhere.
    "preview": (lambda oa: reports.preview(oa.orderBy(*ORDER_ANALYTICS_COLUMNS)), {}),
    "total_revenue": (reports.total_revenue, REVENUE),
    "total_orders": (reports.total_orders, {}),
    "revenue_by_category": (reports.revenue_by_category, REVENUE),
    "revenue_by_warehouse": (reports.revenue_by_warehouse, REVENUE),
    "revenue_by_segment": (reports.revenue_by_segment, REVENUE),
    "orders_by_status": (reports.orders_by_status, {}),
    "avg_delivery_days": (reports.avg_delivery_days, {"avg_delivery_days": 6}),
    "category_performance": (reports.category_performance, {}),
    "warehouse_performance": (reports.warehouse_performance, {}),
    "segment_performance": (reports.segment_performance, {}),
    "shipment_completeness": (reports.shipment_completeness, {}),
    "revenue_by_month_name": (reports.revenue_by_month_name, REVENUE),
    "revenue_month_over_month": (
        reports.revenue_month_over_month,
        REVENUE | {"previous_revenue": 2, "revenue_change": 2},
    ),
    "kpi_cards": (dashboard.kpi_cards, KPIS),
    "kpi_cards_sliced": (partial(dashboard.kpi_cards, slicers=SLICERS), KPIS),
    "category_sliced": (_sliced(reports.category_performance), {}),
    "month_sliced": (_sliced(reports.revenue_by_month_name), REVENUE),
    "status_sliced": (_sliced(reports.orders_by_status), {}),
    "segment_sliced": (_sliced(reports.revenue_by_segment), REVENUE),
    "dq_total_rows": (checks.total_rows, {}),
    "dq_missing_shipment_rows": (checks.missing_shipment_rows, {}),
    "dq_missing_shipment_by_status": (checks.missing_shipment_by_status, {}),
    "dq_affected_orders": (checks.affected_orders, {}),
    "dq_duplicate_orders": (checks.duplicate_orders, {}),
    "dq_null_customers": (checks.null_customers, {}),
    "dq_invalid_revenue": (checks.invalid_revenue, {}),
    "dq_invalid_delivery": (checks.invalid_delivery, {}),
    "dq_summary": (checks.dq_summary, {}),
}


def _report(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    build, digits = REPORTS[name]
    # Sliced reports see the month that the folders are named by.
    return comparable(build(Zones(spark, sf_dir).curated(name in SLICED)), digits)


SLICED = [name for name in REPORTS if name.endswith("_sliced")]

# The reports that the roll-up answers too: name of the report, and how.
ROLLED: dict[str, Callable[[DataFrame], DataFrame]] = {
    "total_revenue": rollup.total_revenue,
    "total_orders": rollup.total_orders,
    "revenue_by_category": partial(rollup.revenue_by, dimension="category"),
    "revenue_by_warehouse": partial(rollup.revenue_by, dimension="warehouse_city"),
    "revenue_by_segment": partial(rollup.revenue_by, dimension="customer_segment"),
    "orders_by_status": rollup.orders_by_status,
    "avg_delivery_days": rollup.avg_delivery_days,
    "category_performance": partial(rollup.performance_by, dimension="category"),
    "warehouse_performance": partial(rollup.performance_by, dimension="warehouse_city"),
    "segment_performance": rollup.segment_performance,
    "shipment_completeness": rollup.shipment_completeness,
    "revenue_by_month_name": rollup.revenue_by_month_name,
    "revenue_month_over_month": lambda rows: reports.revenue_month_over_month(
        rows.withColumnRenamed("revenue", "line_revenue")
    ),
    "kpi_cards": rollup.kpi_cards,
    "kpi_cards_sliced": partial(rollup.kpi_cards, slicers=SLICERS),
    "dq_summary": rollup.dq_summary,
    "dq_affected_orders": rollup.affected_orders,
    "dq_duplicate_orders": rollup.duplicate_orders,
}


def _rolled(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(ROLLED[name](Zones(spark, sf_dir).rollup()), REPORTS[name][1])


# Reconciliation between zones


def dq_delivered_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = Zones(spark, sf_dir)
    return checks.delivered_coverage(zones.processed("orders"), zones.processed("shipments"))


def dq_raw_vs_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = Zones(spark, sf_dir)
    return checks.raw_vs_processed(zones.raw("shipments"), zones.processed("shipments"))


def dq_delivered_missing_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.delivered_missing_raw(
        raw_table(spark, sf_dir, "orders"), raw_table(spark, sf_dir, "shipments")
    )


def dq_reconcile_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the record of the run that wrote the zones."""
    return checks.reconcile_record(record(spark, Zones(spark, sf_dir).cleaned()))


def own_queries() -> dict[str, Query]:
    """All queries but those on corpora."""
    found: dict[str, Query] = {}
    for table in TABLES:
        found[f"raw_{table}"] = partial(_raw, table)
        found[f"normalize_{table}"] = partial(_normalize, table)
        found[f"duplicate_count_{table}"] = partial(_duplicates, table, DEFAULT_POLICY)
        found[f"processed_{table}"] = partial(_processed, table)
        found[f"rejected_{table}"] = partial(_rejected, table)
        found[f"zone_processed_{table}"] = partial(_zone, "processed", table)
        found[f"zone_rejected_{table}"] = partial(_zone, "rejected", table)
        found[f"csv_{table}"] = partial(_csv, table)
        found[f"reject_summary_{table}"] = partial(_reject_summary, table)
    found |= {name: partial(join, DEFAULT_POLICY) for name, join in JOINS.items()}
    found |= {name: partial(_report, name) for name in REPORTS}
    found |= {f"rollup_{name}": partial(_rolled, name) for name in ROLLED}
    for query in (
        order_analytics_searched,
        parse_dates,
        safe_division,
        dq_delivered_coverage,
        dq_raw_vs_processed,
        dq_delivered_missing_raw,
        dq_reconcile_zones,
    ):
        found[query.__name__] = query
    # The same operators with their handling of hot keys forced on.
    for table in ("orders", "order_items", "shipments"):
        found[f"duplicate_count_{table}_spread"] = partial(_duplicates, table, FORCED)
    found |= {f"{name}_spread": partial(join, FORCED) for name, join in JOINS.items()}
    return found


def queries() -> dict[str, Query]:
    if corpus is None:
        return own_queries()
    return own_queries() | corpus.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    if corpus is None:
        return oracle.statements()
    whole = corpus_pipeline.ORACLE_SQL
    return oracle.statements() | corpus.ORACLE_SQL | ({"pipeline": whole} if whole else {})


def entry(spark: SparkSession) -> DataFrame:
    """Revenue, orders and delivery time per product category."""
    return _report("category_performance", spark, "/root/testdata/sf0.001")

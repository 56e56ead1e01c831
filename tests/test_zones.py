"""Raw CSV in, all zones out, and SQL text over them."""

import csv
import os

import pytest
from conftest import rows
from samples import GOOD
from pyspark.sql import functions as F

from orderlake.operators.skew import SkewPolicy
from orderlake.plans import checks, reports
from orderlake.operators.quality import split
from orderlake.operators.rules import SPECS
from orderlake.plans.pipeline import PipelineOptions, clean_table, run_pipeline
from orderlake.schemas import ORDER_ANALYTICS, ORDER_ANALYTICS_COLUMNS, RAW, TABLES
from orderlake.sources import (
    CURATED,
    CURATED_TABLE,
    PROCESSED,
    RAW_ZONE,
    REJECTED,
    bad_lines,
    read_raw,
    read_zone,
    register_tables,
    register_views,
    write_zone,
    zone_path,
)
from orderlake.sources import zones
from orderlake.sources.work import new_work_folder, remove_work_folder, shared_folder

# A row of each table besides the good one. Orders get a repeated and a blank id.
MORE = {
    "customers": [dict(customer_id="C2", customer_name=" ")],
    "products": [dict(product_id="P2", unit_price="")],
    "suppliers": [dict(supplier_id="S2", supplier_rating="high")],
    "warehouses": [dict(warehouse_id="W2", capacity_units="0")],
    "inventory": [dict(inventory_id="I2", inventory_date="2024-02-30")],
    "orders": [dict(order_id="O2"), dict(order_id=" O2 "), dict(order_id=""), dict(order_id="O3")],
    "order_items": [
        dict(order_item_id="L2", order_id="O3", quantity="4"),
        dict(order_item_id="L3", quantity="0"),
    ],
    "shipments": [dict(shipment_id="H2", delivery_date="never")],
}
REJECTED_ROWS = {t: 1 for t in TABLES} | {"orders": 3}


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    """A raw zone of two files per table; columns are in another order than declared."""
    folder = tmp_path_factory.mktemp("lake")
    for table in TABLES:
        path = folder / RAW_ZONE / table
        path.mkdir(parents=True)
        columns = sorted(GOOD[table])
        for number, change in enumerate([{}, *MORE[table]]):
            with open(path / f"{number}.csv", "w", newline="") as file:
                writer = csv.writer(file)
                writer.writerow([*columns, "Remark"])
                row = GOOD[table] | change
                writer.writerow([*(row[c] for c in columns), f"row {number}"])
    return str(folder)


OPTIONS = {
    "broadcast": PipelineOptions(),
    "shuffled": PipelineOptions(
        broadcast_bytes=-1,
        policy=SkewPolicy(rows_per_slot=1, keys_per_partition=10**6, lookup_bytes=-1),
    ),
    "partitioned": PipelineOptions(
        partition_curated_by=["order_status", "warehouse_id"], tables_at_once=1
    ),
}


@pytest.fixture(scope="module", params=OPTIONS)
def lake(request, spark, base, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    run_pipeline(spark, base, out, OPTIONS[request.param])
    return out


def test_read_raw(spark, base):
    raw = read_raw(spark, base, "order_items")
    assert sorted(raw.columns) == sorted([*GOOD["order_items"], "remark", "source_file"])
    kinds = dict(raw.dtypes)
    assert {kinds[c] for c in ("quantity", "unit_price", "order_id")} == {"string"}
    files = {r.source_file.rsplit("/", 1)[1] for r in raw.collect()}
    assert files == {"0.csv", "1.csv", "2.csv"}
    assert rows(raw, "order_item_id", "quantity") == [("L1", "2"), ("L2", "4"), ("L3", "0")]


def write_csv(folder, table, name, header, *lines):
    path = folder / RAW_ZONE / table
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join([header, *lines]) + "\n")


def test_a_missing_column_is_an_error(spark, tmp_path):
    write_csv(tmp_path, "suppliers", "a.csv", "supplier_id,supplier_name", "S1,Acme")
    with pytest.raises(ValueError, match="country, supplier_rating"):
        read_raw(spark, str(tmp_path), "suppliers")


def test_a_file_with_another_header_is_an_error(spark, tmp_path):
    columns = "warehouse_id,warehouse_name,city,capacity_units"
    swapped = "warehouse_name,warehouse_id,city,capacity_units"
    write_csv(tmp_path, "warehouses", "a.csv", columns, "W1,North,Oslo,5")
    write_csv(tmp_path, "warehouses", "b.csv", swapped, "South,W2,Rome,6")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, str(tmp_path), "warehouses").collect()


def test_numbers_in_text(spark, tmp_path):
    """Valid numbers stay valid however they are written, and bad ones are shown as they came."""
    header = "warehouse_id,warehouse_name,city,capacity_units"
    values = ["3000000000", "5.0", "big", "5.5", "7", "-1"]
    lines = [f"W{i},North,Oslo,{v}" for i, v in enumerate(values)]
    write_csv(tmp_path, "warehouses", "a.csv", header, *lines, "W9,North,Oslo,4,more", "W8,North")
    raw = read_raw(spark, str(tmp_path), "warehouses")
    valid, rejected = split(raw, SPECS["warehouses"])
    assert rows(valid, "warehouse_id", "capacity_units") == [
        ("W0", 3_000_000_000), ("W1", 5), ("W4", 7), ("W9", 4),
    ]
    assert rows(rejected, "warehouse_id", "capacity_units") == [
        ("W2", "big"), ("W3", "5.5"), ("W5", "-1"), ("W8", None),
    ]
    found = bad_lines(spark, str(tmp_path), "warehouses").collect()
    assert sorted(r.line for r in found) == ["W8,North", "W9,North,Oslo,4,more"]
    assert all(r.source_file.endswith("/a.csv") for r in found)


@pytest.mark.parametrize("table", TABLES)
def test_zones_hold_every_raw_row_once(spark, base, lake, table):
    raw = read_raw(spark, base, table)
    valid = read_zone(spark, lake, PROCESSED, table)
    rejected = read_zone(spark, lake, REJECTED, table)
    assert rejected.count() == REJECTED_ROWS[table]
    assert raw.count() == valid.count() + rejected.count()
    assert rows(raw, "remark") == rows(valid.select("remark").unionAll(rejected.select("remark")))
    assert valid.where("ingestion_timestamp is null").count() == 0
    key = RAW[table].fieldNames()[0]
    assert valid.select(key).distinct().count() == valid.count()


def test_zone_columns(spark, lake):
    valid = read_zone(spark, lake, PROCESSED, "shipments")
    rejected = read_zone(spark, lake, REJECTED, "shipments")
    given = [*sorted(GOOD["shipments"]), "remark"]
    assert valid.columns == [*given, "ingestion_timestamp"]
    assert rejected.columns == [*given, "source_file", "rejection_reason", "rejected_timestamp"]
    assert dict(valid.dtypes)["delivery_date"] == "date"
    assert dict(rejected.dtypes)["delivery_date"] == "string"
    row = rejected.first()
    assert (row.delivery_date, row.rejection_reason) == ("never", "INVALID_DELIVERY_DATE")
    assert row.source_file.endswith("/1.csv")


def test_rejections(spark, lake):
    def found(table):
        return rows(read_zone(spark, lake, REJECTED, table), "rejection_reason")

    assert found("suppliers") == [("MISSING_SUPPLIER_RATING",)]
    assert found("products") == [("MISSING_UNIT_PRICE",)]
    assert found("orders") == [
        ("DUPLICATE_ORDER_ID",),
        ("DUPLICATE_ORDER_ID",),
        ("MISSING_ORDER_ID",),
    ]


def test_curated(spark, lake):
    oa = read_zone(spark, lake, CURATED, CURATED_TABLE)
    assert len(oa.columns) == 23
    assert rows(oa, "order_id", "line_revenue", "shipment_id", "delivery_days") == [
        ("O1", 7.0, "H1", 3),
        ("O3", 14.0, None, None),
    ]
    assert oa.where("delivery_days < 0").count() == 0


def test_views_and_tables_run_sql_text(spark, base, tmp_path):
    run_pipeline(spark, base, base)
    register_views(spark, base)
    oa = spark.table("order_analytics")
    text = "select category, sum(line_revenue) total_revenue from {} group by category"
    assert rows(spark.sql(text.format("order_analytics"))) == rows(reports.revenue_by_category(oa))
    assert spark.table("raw_orders").count() == 5
    assert spark.table("processed_orders").count() == 2
    assert spark.table("rejected_orders").count() == 3

    names = {RAW_ZONE: "lake_raw", PROCESSED: "lake_processed", CURATED: "lake_curated"}
    register_tables(spark, base, names)
    register_tables(spark, base, names)
    assert rows(spark.sql(text.format("lake_curated.order_analytics"))) == rows(
        reports.revenue_by_category(oa)
    )
    missing = spark.sql(
        """select count(distinct o.order_id) n from lake_raw.orders o
           left join lake_raw.shipments s on trim(s.order_id) = trim(o.order_id)
           where trim(o.order_status) = 'Delivered' and s.order_id is null"""
    )
    ours = checks.delivered_missing_raw(
        read_raw(spark, base, "orders"), read_raw(spark, base, "shipments")
    )
    assert rows(missing) == rows(ours)
    assert spark.table("lake_processed.customers").count() == 1
    spark.sql("create table lake_curated.own (x int) using parquet")
    with pytest.raises(ValueError, match="own"):
        zones._free(spark, "lake_curated.own", base)
    with pytest.raises(ValueError, match="order_analytics"):
        register_tables(spark, str(tmp_path / "elsewhere"), {CURATED: "lake_curated"})
    for database in names.values():
        spark.sql(f"drop database {database} cascade")
    assert os.path.exists(zone_path(base, PROCESSED, "customers"))


def test_raw_tables_check_the_header(spark, base, tmp_path):
    for table in TABLES:
        header = ",".join(RAW[table].fieldNames())
        write_csv(tmp_path, table, "a.csv", header)
    swapped = "warehouse_name,warehouse_id,city,capacity_units"
    write_csv(tmp_path, "warehouses", "b.csv", swapped, "South,W2,Rome,6")
    register_tables(spark, str(tmp_path), {RAW_ZONE: "lake_mixed"})
    with pytest.raises(Exception, match="header"):
        spark.table("lake_mixed.warehouses").collect()
    spark.sql("drop database lake_mixed cascade")


def test_partitioned_curated_table(spark, tmp_path):
    """Types, places and rows are those of the table without partitions, also in the catalog."""
    row = dict.fromkeys(ORDER_ANALYTICS_COLUMNS) | dict(order_id="O1", line_revenue=2.5, category="A")
    data = [row | dict(warehouse_id=w, order_status=s) for w in ("007", "12") for s in ("1", "Shipped")]
    df = spark.createDataFrame([tuple(r.values()) for r in data], ORDER_ANALYTICS)
    plain, parts = str(tmp_path / "plain"), str(tmp_path / "parts")
    write_zone(df, plain, CURATED, CURATED_TABLE)
    write_zone(df, parts, CURATED, CURATED_TABLE, ["warehouse_id", "order_status"])
    back = read_zone(spark, parts, CURATED, CURATED_TABLE)
    assert back.schema == ORDER_ANALYTICS
    assert rows(back) == rows(read_zone(spark, plain, CURATED, CURATED_TABLE)) == rows(df)
    register_tables(spark, parts, {CURATED: "lake_parts"})
    table = spark.table("lake_parts.order_analytics")
    assert rows(table, *df.columns) == rows(df)
    text = "select category, sum(line_revenue) r from lake_parts.order_analytics where warehouse_id = '007' group by 1"
    assert rows(spark.sql(text)) == [("A", 5.0)]
    spark.sql("drop database lake_parts cascade")


def test_partitioned_write_prunes(spark, tmp_path):
    df = spark.range(4).withColumn("day", F.expr("date'2024-01-01' + cast(id as int)"))
    write_zone(df, str(tmp_path), CURATED, "t", ["day"])
    write_zone(df, str(tmp_path), CURATED, "t", ["day"])
    back = read_zone(spark, str(tmp_path), CURATED, "t")
    assert rows(back, "id", "day") == rows(df)
    plan = back.where("day = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: []" in plan
    assert sorted(n for n in os.listdir(tmp_path / CURATED / "t") if n[0] not in "._") == [
        f"day=2024-01-0{i}" for i in range(1, 5)
    ]


def test_few_files_for_rejected_rows(spark, tmp_path):
    """A scan of many tasks leaves few files where few rows are rejected."""
    rows_ = [GOOD["suppliers"] | dict(supplier_id=f"S{i}", country="" if i % 9 else "x") for i in range(200)]
    raw = spark.createDataFrame([tuple(r.values()) for r in rows_], RAW["suppliers"]).repartition(50)
    clean_table(raw, SPECS["suppliers"], str(tmp_path), new_work_folder(spark))
    files = os.listdir(zone_path(str(tmp_path), REJECTED, "suppliers"))
    assert len([f for f in files if f.endswith(".parquet")]) <= 4


def test_work_folder(spark):
    folder = new_work_folder(spark)
    assert folder.startswith(shared_folder(spark))
    assert folder != new_work_folder(spark)
    spark.range(1).write.parquet(f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 1
    remove_work_folder(spark, folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/t")


def test_no_work_is_left_behind(spark, base, tmp_path):
    def listed():
        folder = shared_folder(spark).removeprefix("file:")
        return {n for n in os.listdir(folder) if n.startswith("orderlake-")}

    kept = new_work_folder(spark)
    before = listed()
    assert os.path.basename(kept) in before
    run_pipeline(spark, base, str(tmp_path))
    assert listed() == before


def test_one_temporary_folder_per_session(spark, monkeypatch):
    monkeypatch.setattr(spark.conf, "get", lambda name, default=None: default)
    assert shared_folder(spark) == shared_folder(spark) is not None

"""The shape of physical plans: what is read, shuffled and broadcast."""

import re

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
from orderlake.fixtures import raw_table
from orderlake.operators.duplicates import broadcast_counts, repeated_keys
from orderlake.operators.quality import prepare, valid_rows
from orderlake.operators.rules import SPECS
from orderlake.operators.skew import planned_bytes
from orderlake.plans import checks, reports
from orderlake.plans.curated import build_order_analytics
from orderlake.plans.pipeline import PipelineOptions, _repeated
from orderlake.schemas import CURATED_INPUTS, TABLES
from orderlake.sources.work import written


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    """The columns read by each scan."""
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>", text)]


def shuffles(text):
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", text)


@pytest.fixture(scope="module")
def zones(spark):
    return entry.Zones(spark, SF_DIR)


@pytest.mark.parametrize("name", entry.own_queries())
def test_no_query_pairs_all_rows_or_runs_python(spark, name):
    text = plan(entry.own_queries()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in text


def test_reports_read_their_columns_only(zones):
    text = plan(reports.category_performance(zones.curated()))
    assert scans(text) == [{"category", "order_id", "line_revenue", "delivery_days"}]
    text = plan(checks.missing_shipment_by_status(zones.curated()))
    assert scans(text) == [{"order_status", "shipment_id"}]
    assert "PushedFilters: [IsNull(shipment_id)]" in text
    for report in (reports.shipment_completeness, reports.segment_performance):
        assert "Expand" not in plan(report(zones.curated()))


def test_reconciling_reads_no_columns(zones):
    readers = {"raw": zones.raw, "processed": zones.processed, "rejected": zones.rejected}
    counted = checks.reconcile_zones({z: {t: read(t) for t in TABLES} for z, read in readers.items()})
    assert plan(counted).count("ReadSchema: struct<>") >= 16


def test_reconciling_by_the_record_reads_no_table(spark):
    text = plan(entry.queries()["dq_reconcile_zones"](spark, SF_DIR))
    assert len(scans(text)) == 1 and "parquet" not in text.lower()


def test_few_repeated_keys_need_no_shuffle(spark, tmp_path):
    spec = SPECS["orders"]
    prepared = prepare(raw_table(spark, SF_DIR, "orders"), spec)
    repeated = written(repeated_keys(prepared, spec.key), str(tmp_path / "repeated"))
    text = plan(valid_rows(broadcast_counts(prepared, spec.key, repeated), spec))
    assert "BroadcastHashJoin" in text
    before_the_join = text.split("BroadcastExchange")[0]
    assert not shuffles(before_the_join)


def test_known_repeated_keys_beyond_the_threshold_need_no_shuffle(spark, tmp_path):
    """Their number is known, so the session's threshold for estimates does not make the rows move."""
    limit, spec = "spark.sql.autoBroadcastJoinThreshold", SPECS["orders"]
    data = [(f"long order {i // 2}",) for i in range(2000)]
    prepared = spark.createDataFrame(data, "order_id string")
    try:
        for threshold, few in (("1000", True), ("-1", False)):
            spark.conf.set(limit, threshold)
            path = str(tmp_path / f"repeated{threshold}")
            repeated, small = _repeated(prepared, spec.key, path, PipelineOptions())
            assert small == few and repeated.count() == 1000
    finally:
        spark.conf.unset(limit)
    assert not _repeated(prepared, spec.key, str(tmp_path / "asked"), PipelineOptions(broadcast_bytes=1000))[1]


def test_orders_lines_and_shipments_are_shuffled_once_each(spark, zones):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    inputs = [zones.processed(t) for t in CURATED_INPUTS]
    lookups = [zones.processed(t) for t in ("customers", "products", "warehouses")]
    spark.conf.set(limit, str(max(map(planned_bytes, lookups))))
    try:
        text = plan(build_order_analytics(*inputs))
    finally:
        spark.conf.unset(limit)
    meets = re.findall(r"Exchange hashpartitioning\(order_id#\d+L?, _lines_batch", text)
    assert len(meets) == 3
    assert text.count("SortMergeJoin") == 2


def test_delivered_orders_are_antijoined(spark):
    text = plan(entry.queries()["dq_delivered_missing_raw"](spark, SF_DIR))
    assert "LeftAnti" in text

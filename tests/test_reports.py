"""Reports, checks and measures on a table small enough to work out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from conftest import rows

from orderlake.plans import checks, dashboard, reports
from orderlake.plans.dashboard import Slicers

SCHEMA = """order_id string, order_status string, order_date date, customer_id string,
    customer_segment string, warehouse_city string, category string, line_revenue double,
    shipment_id string, shipment_date date, delivery_date date, delivery_days int"""


def day(text):
    return dt.date.fromisoformat(text)


DATA = [
    # A: two lines, one shipment. B: no shipment, unknown customer. C: two shipments of one line.
    ("A", "Delivered", day("2023-01-10"), "C1", "Home", "Oslo", "Tools", 10.0,
     "S1", day("2023-01-11"), day("2023-01-13"), 2),
    ("A", "Delivered", day("2023-01-10"), "C1", "Home", "Oslo", "Toys", 5.5,
     "S1", day("2023-01-11"), day("2023-01-13"), 2),
    ("B", "Delivered", day("2023-03-05"), None, None, "Oslo", None, 4.0, None, None, None, None),
    ("C", "Shipped", day("2024-01-31"), "C1", "Home", "Bergen", "Tools", 20.0,
     "S2", day("2024-02-01"), day("2024-02-06"), 5),
    ("C", "Shipped", day("2024-01-31"), "C1", "Home", "Bergen", "Tools", 20.0,
     "S3", day("2024-02-01"), None, None),
    ("D", "Shipped", day("2024-03-01"), "C2", "Work", None, "Toys", 0.0, None, None, None, None),
]


@pytest.fixture(scope="module")
def oa(spark):
    return spark.createDataFrame(DATA, SCHEMA).cache()


def listed(df):
    """Rows in the order of the report."""
    return [tuple(r) for r in df.collect()]


def test_totals(oa):
    assert listed(reports.total_revenue(oa)) == [(59.5,)]
    assert listed(reports.total_orders(oa)) == [(4,)]
    assert listed(reports.avg_delivery_days(oa)) == [(3.0,)]


def test_preview(oa):
    assert reports.preview(oa).count() == 6
    assert reports.preview(oa, 2).count() == 2
    assert reports.preview(oa).columns == oa.columns


def test_revenue_by(oa):
    assert listed(reports.revenue_by_category(oa)) == [("Tools", 50.0), ("Toys", 5.5), (None, 4.0)]
    assert listed(reports.revenue_by_warehouse(oa)) == [
        ("Bergen", 40.0),
        ("Oslo", 19.5),
        (None, 0.0),
    ]
    assert listed(reports.revenue_by_segment(oa)) == [("Home", 55.5), (None, 4.0), ("Work", 0.0)]
    assert rows(reports.orders_by_status(oa)) == [("Delivered", 2), ("Shipped", 2)]


def test_performance(oa):
    assert listed(reports.category_performance(oa)) == [
        ("Tools", 2, 50.0, 3.5),
        ("Toys", 2, 5.5, 2.0),
        (None, 1, 4.0, None),
    ]
    assert listed(reports.warehouse_performance(oa)) == [
        ("Bergen", 1, 40.0, 5.0),
        ("Oslo", 2, 19.5, 2.0),
        (None, 1, 0.0, None),
    ]


def test_segments(oa):
    assert listed(reports.segment_performance(oa)) == [
        ("Home", 1, 2, 55.5, 27.75),
        (None, 0, 1, 4.0, 4.0),
        ("Work", 1, 1, 0.0, 0.0),
    ]


def test_an_order_seen_under_two_customers_is_one_order(spark):
    df = spark.createDataFrame(
        [("s", "c1", "o", 1.0), ("s", "c2", "o", 2.0)],
        "customer_segment string, customer_id string, order_id string, line_revenue double",
    )
    assert listed(reports.segment_performance(df)) == [("s", 2, 1, 3.0, 3.0)]


def test_completeness(oa):
    assert rows(reports.shipment_completeness(oa)) == [
        ("Delivered", 2, 1, 50.0, 2.0),
        ("Shipped", 2, 1, 50.0, 5.0),
    ]


def test_months(oa):
    assert listed(reports.revenue_by_month_name(oa)) == [("January", 55.5), ("March", 4.0)]
    assert listed(reports.revenue_month_over_month(oa)) == [
        (day("2023-01-01"), 15.5, None, None),
        (day("2023-03-01"), 4.0, None, None),
        (day("2024-01-01"), 40.0, None, None),
        (day("2024-03-01"), 0.0, None, None),
    ]


def test_months_in_a_row_and_a_gap(spark):
    sales = [("2023-12-31", 5.0), ("2024-01-01", 1.0), ("2024-01-31", 2.0), ("2024-03-01", 9.0)]
    oa = spark.createDataFrame(sales, "order_date string, line_revenue double").withColumn(
        "order_date", F.to_date("order_date")
    )
    assert listed(reports.revenue_month_over_month(oa)) == [
        (day("2023-12-01"), 5.0, None, None),
        (day("2024-01-01"), 3.0, 5.0, -2.0),
        (day("2024-03-01"), 9.0, None, None),
    ]


def test_row_checks(oa):
    assert listed(checks.total_rows(oa)) == [(6,)]
    assert listed(checks.missing_shipment_rows(oa)) == [(2,)]
    assert rows(checks.missing_shipment_by_status(oa)) == [("Delivered", 1), ("Shipped", 1)]
    assert rows(checks.affected_orders(oa)) == [("Delivered", 1, 1), ("Shipped", 1, 1)]
    assert listed(checks.duplicate_orders(oa)) == [("A", 2), ("C", 2)]
    assert listed(checks.null_customers(oa)) == [(1,)]
    assert listed(checks.invalid_revenue(oa)) == [(0,)]
    assert listed(checks.invalid_delivery(oa)) == [(0,)]
    assert listed(checks.dq_summary(oa)) == [(6, 2, 1, 0, 0)]


def test_checks_find_what_is_wrong(spark):
    bad = spark.createDataFrame(
        [
            ("A", None, None, None, -1.0, None, None),
            ("A", "c", "s", day("2024-01-02"), None, day("2024-01-01"), None),
            ("A", "c", "s", day("2024-01-02"), 1.0, day("2024-01-02"), None),
            ("A", "c", "s", None, 0.0, day("2024-01-02"), None),
        ],
        """order_id string, customer_id string, shipment_id string, shipment_date date,
        line_revenue double, delivery_date date, order_status string""",
    )
    assert listed(checks.invalid_revenue(bad)) == [(2,)]
    assert listed(checks.invalid_delivery(bad)) == [(1,)]
    assert listed(checks.dq_summary(bad)) == [(4, 1, 1, 2, 1)]


def test_delivered_coverage(spark):
    orders = spark.createDataFrame(
        [("1", "Delivered"), ("2", "Delivered"), ("3", "Shipped")],
        "order_id string, order_status string",
    )
    shipments = spark.createDataFrame([("1",), ("1",), ("3",), ("4",)], "order_id string")
    assert listed(checks.delivered_coverage(orders, shipments)) == [(2, 1, 1)]


def test_raw_vs_processed(spark):
    raw = spark.createDataFrame([("1",), ("1 ",), ("  ",), (None,), ("2",)], "order_id string")
    done = spark.createDataFrame([("1",), ("1",)], "order_id string")
    assert listed(checks.raw_vs_processed(raw, done)) == [(4, 1)]


def test_delivered_missing_raw(spark):
    orders = spark.createDataFrame(
        [
            ("1", "Delivered"),
            ("2 ", " Delivered "),
            ("2", "Delivered"),
            ("2", "Delivered"),
            ("3", "Shipped"),
            (None, "Delivered"),
            ("", "Delivered"),
            ("5", "delivered"),
        ],
        "order_id string, order_status string",
    )
    shipments = spark.createDataFrame([(" 1",), ("9",), (None,)], "order_id string")
    # "2 " and "2" are two ids here, and the empty one is an id as well.
    assert listed(checks.delivered_missing_raw(orders, shipments)) == [(3,)]


def test_reconcile(spark):
    def frames(n):
        return {"t": spark.range(n), "empty": spark.range(0)}

    zones = {"raw": frames(5), "processed": frames(3), "rejected": frames(2)}
    assert rows(checks.reconcile_zones(zones)) == [("t", 5, 3, 2, True)]
    zones["rejected"] = frames(1)
    assert rows(checks.reconcile_zones(zones)) == [("t", 5, 3, 1, False)]


def card(oa, slicers=dashboard.ALL):
    return dashboard.kpi_cards(oa, slicers).first().asDict()


def test_kpi_cards(oa):
    assert card(oa) == dict(
        total_revenue=59.5,
        total_orders=4,
        avg_order_value=14.875,
        avg_delivery_days=3.0,
        orders_missing_shipment=2,
        missing_shipment_ratio=0.5,
    )


@pytest.mark.parametrize(
    "slicers, condition",
    [
        (Slicers(), "true"),
        (Slicers(warehouse_city=["Oslo"]), "warehouse_city = 'Oslo'"),
        (Slicers(warehouse_city=["Oslo", None]), "coalesce(warehouse_city, 'Oslo') = 'Oslo'"),
        (Slicers(category=[None]), "category is null"),
        (Slicers(order_status=["Shipped", "Lost"]), "order_status = 'Shipped'"),
        (
            Slicers(category=["Tools"], date_from=day("2024-01-31")),
            "category = 'Tools' and order_id = 'C'",
        ),
        (Slicers(date_from=day("2023-03-05"), date_to=day("2024-01-31")), "order_id in ('B','C')"),
    ],
)
def test_slicers(oa, slicers, condition):
    assert rows(dashboard.apply_slicers(oa, slicers)) == rows(oa.where(condition))
    assert card(oa, slicers) == card(oa.where(condition))


def test_slicers_that_select_nothing(oa):
    assert card(oa, Slicers(category=["None such"])) == dict(
        total_revenue=None,
        total_orders=0,
        avg_order_value=0.0,
        avg_delivery_days=None,
        orders_missing_shipment=0,
        missing_shipment_ratio=0.0,
    )


def test_slicers_filter_every_report(oa):
    sliced = dashboard.apply_slicers(oa, Slicers(warehouse_city=["Oslo"]))
    assert rows(reports.revenue_by_category(sliced)) == [
        ("Tools", 10.0),
        ("Toys", 5.5),
        (None, 4.0),
    ]

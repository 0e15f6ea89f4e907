"""Reports on edge cases: NULL groups, unknown keys, empty inputs, ties."""

from decimal import Decimal

import pytest

from sluice import schemas
from sluice.operators.skew import SkewGuard
from sluice.plans import marts


@pytest.fixture(scope="module")
def tables(spark):
    orders = spark.createDataFrame(
        [("O1", "C1", "P1", 2), ("O2", "C1", "P2", 1), ("O3", "C2", "P1", 1), ("O4", "C9", "P1", 1), ("O5", "C3", "P9", 4)],
        "order_id string, customer_id string, product_id string, quantity int",
    )
    customers = spark.createDataFrame(
        [("C1", "US", "HR"), ("C2", "FR", "HR"), ("C3", "XX1", None)],
        "customer_id string, country_code string, department_code string",
    )
    products = spark.createDataFrame([("P1", 10.1), ("P2", 0.333333)], "product_id string, price double")
    return orders, customers, products


def test_total_sales(spark, tables):
    orders, _, products = tables
    assert marts.total_sales(orders, products).first().total_sales == Decimal("40.73")
    assert marts.total_sales(orders.filter("false"), products).first().total_sales == 0


@pytest.mark.parametrize("guard", [SkewGuard(), SkewGuard(min_rows=2)])
def test_country_and_region_sales(spark, tables, guard):
    sales = marts.sales_by_country(*tables, guard=guard)
    assert {r.country_code: r.sales for r in sales.collect()} == {
        "US": Decimal("20.53"),
        "FR": Decimal("10.10"),
        "XX1": Decimal("0.00"),
        None: Decimal("10.10"),
    }
    countries = spark.createDataFrame([("US", "Ustria"), ("FR", "Frania")], schemas.COUNTRY_LOOKUP)
    top = marts.top_countries(sales, countries, 3).collect()
    assert [(r.country_code, r.country_name) for r in top] == [("US", "Ustria"), ("FR", "Frania"), ("XX1", None)]
    regions = marts.sales_by_region(sales).collect()
    assert [tuple(r) for r in regions] == [("North America", Decimal("20.53")), ("Europe", Decimal("10.10"))]


def test_departments(spark, tables):
    departments = spark.createDataFrame([("HR", "People"), ("ZZ", "Other")], schemas.DEPARTMENT_LOOKUP)
    rows = marts.customers_by_department(tables[1], departments).collect()
    assert [tuple(r) for r in rows] == [("HR", 2, "People")]


def test_entities(tables):
    assert {r.entity: r.entities for r in marts.entity_counts(*tables).collect()} == {"orders": 5, "customers": 3, "products": 2}


def test_rates(spark, tables):
    orders, customers, _ = tables
    counts = marts.layer_counts(
        {
            "orders": {"raw": orders, "structured": orders.limit(3), "rejected": orders.limit(1)},
            "customers": {"raw": customers, "structured": customers.filter("false"), "rejected": None},
        }
    )
    assert marts.quality_rate(counts).first().quality_rate == 37.5
    rates = {r.feed: (r.valid_rows, r.rejected_rows, r.rejection_rate) for r in marts.rejection_rates(counts).collect()}
    assert rates == {"orders": (3, 1, 25.0), "customers": (0, 0, 0.0)}
    assert marts.quality_rate(counts.filter("false")).first().quality_rate == 0.0


def test_reasons_and_batches(spark):
    rejects = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "rejection_reason string")
    rows = marts.reason_histogram({"orders": rejects}).collect()
    assert [tuple(r) for r in rows] == [("orders", "a", 2), ("orders", "b", 1)]
    stamps = spark.sql("SELECT timestamp_seconds(x) AS insertion_timestamp FROM VALUES (1), (1), (9), (NULL) AS t(x)")
    row = marts.ingest_batches(stamps).first()
    assert row.ingest_batches == 2 and row.last_ingest.second == 9


def test_regions_of_countries():
    assert len(schemas.REGION_OF_COUNTRY) == 38 and len(set(schemas.REGION_OF_COUNTRY.values())) == 8


def test_prices_beyond_range_are_counted(spark):
    orders = spark.createDataFrame([(k, f"P{k}", q) for k, q in enumerate([2, 3, 4, 5, 6])], "order_id int, product_id string, quantity int")
    prices = [("P0", 2e12), ("P1", float("inf")), ("P2", 1e-7), ("P3", 1e30), ("P4", None)]
    row = marts.total_sales(orders, spark.createDataFrame(prices, "product_id string, price double")).first()
    assert row.total_sales == Decimal("4000000000000.00") and row.unpriced_orders == 3

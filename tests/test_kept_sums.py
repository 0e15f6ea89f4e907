"""Kept sums against a recount, over versions that change orders, prices and customers."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.plans import kept_sums, marts
from sluice.plans.kept_sums import Versions, current_sums, refresh_sums
from sluice.sinks.snapshot import SnapshotTable

KEYS = {"orders": "order_id", "customers": "customer_id", "products": "product_id"}
SCHEMAS = {
    "orders": "order_id string, customer_id string, product_id string, quantity long",
    "customers": "customer_id string, country_code string, department_code string",
    "products": "product_id string, price double",
}


def make_tables(spark, lake, n_buckets=2):
    return {name: SnapshotTable(spark, f"{lake}/structured/{name}", key, n_buckets) for name, key in KEYS.items()}


def put(spark, tables, **rows):
    for name, values in rows.items():
        tables[name].upsert(spark.createDataFrame(values, SCHEMAS[name]))


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def read_all(spark, tables):
    return [
        tables[name].read() if tables[name].current() else spark.createDataFrame([], SCHEMAS[name]) for name in KEYS
    ]


def agree(spark, tables, sums):
    orders, customers, products = read_all(spark, tables)
    assert rows_of(kept_sums.country_sales(sums)) == rows_of(marts.sales_by_country(orders, customers, products))
    counted = customers.filter("department_code is not null").groupBy("department_code").agg(F.count("*"))
    assert rows_of(kept_sums.department_customers(sums)) == rows_of(counted)
    assert rows_of(sums) == rows_of(kept_sums.counted_sums(orders, customers, products))


def test_corrected_sums_equal_a_recount_after_random_versions(spark, tmp_path):
    draw = random.Random(5)
    lake = str(tmp_path)
    tables = make_tables(spark, lake)

    def some(prefix, n, of):
        return [f"{prefix}{k}" for k in draw.sample(range(of), n)]

    def orders(n):
        return [(o, draw.choice(["C1", "C2", "C9", f"C{draw.randrange(30)}", None]), f"P{draw.randrange(12)}", draw.randrange(1, 9))
                for o in some("O", n, 200)]

    def customers(n):
        return [(c, draw.choice(["DE", "FR", None]), draw.choice(["d1", "d2", None])) for c in some("C", n, 30)]

    def products(n):
        return [(p, draw.choice([None, 1.25, 0.1, 99.99])) for p in some("P", n, 12)]

    versions = [
        {"orders": orders(40)},
        {"customers": customers(12), "products": products(5)},
        {"orders": orders(60), "customers": customers(10)},
        {"orders": orders(30), "customers": customers(8), "products": products(6)},
    ]
    assert rows_of(refresh_sums(spark, lake, tables)) == []
    for version in versions:
        put(spark, tables, **version)
        sums = refresh_sums(spark, lake, tables, most_changed=math.inf)
        assert rows_of(sums) == rows_of(kept_sums.counted_sums(*read_all(spark, tables)))
    tables["orders"].rebucket(3)
    agree(spark, tables, refresh_sums(spark, lake, tables, most_changed=math.inf))
    assert len(kept_sums._earlier(spark, lake)) == kept_sums.KEPT


@pytest.fixture
def small(spark, tmp_path):
    tables = make_tables(spark, str(tmp_path))
    put(
        spark, tables,
        orders=[(f"O{k}", f"C{k % 5}", f"P{k % 3}", 2) for k in range(40)],
        customers=[(f"C{k}", "DE", "d") for k in range(5)],
        products=[(f"P{k}", 1.5) for k in range(3)],
    )
    refresh_sums(spark, str(tmp_path), tables)
    return str(tmp_path), tables


def folders(frame):
    return {part for name in frame.inputFiles() for part in name.split("/") if part.startswith("_version=")}


def test_new_orders_read_the_newest_version_only(spark, small, monkeypatch):
    lake, tables = small
    put(spark, tables, orders=[("N1", "C1", "P1", 4)])
    read = []
    scan = SnapshotTable.scan

    def watched(self, snapshot, segments):
        rows = scan(self, snapshot, segments)
        read.append((self.key, len(segments), folders(rows)))
        return rows

    monkeypatch.setattr(SnapshotTable, "scan", watched)
    sums = current_sums(spark, lake, tables)
    assert [found for key, _, found in read if key == "order_id"] == [{"_version=2"}]
    assert max(n for key, n, _ in read if key != "order_id") == 1  # the bucket of C1, that of P1
    monkeypatch.undo()
    agree(spark, tables, sums)


def test_orders_that_were_all_replaced_are_not_read_as_they_were(spark, small, monkeypatch):
    lake, tables = small
    put(
        spark, tables,
        orders=[(f"O{k}", f"C{k % 5}", f"P{k % 3}", 3) for k in range(40)],
        customers=[("C1", "FR", "e")],
        products=[("P1", 2.0)],
    )
    read = []
    rows_of_version = Versions.rows

    def watched(self, snapshot, segments):
        if self.name == "orders":
            read.extend(version for version, _ in segments)
        return rows_of_version(self, snapshot, segments)

    monkeypatch.setattr(Versions, "rows", watched)
    monkeypatch.setattr(Versions, "changed_keys", None)
    sums = current_sums(spark, lake, tables, most_changed=math.inf)
    assert set(read) == {2}
    monkeypatch.undo()
    agree(spark, tables, sums)


def test_nothing_is_read_if_nothing_changed(spark, small, monkeypatch):
    lake, tables = small
    monkeypatch.setattr(SnapshotTable, "scan", None)
    assert current_sums(spark, lake, tables).count() == 2


def test_new_price_reads_orders_of_that_product_at_both_prices(spark, small):
    lake, tables = small
    put(spark, tables, products=[("P1", 2.0)])
    sums = current_sums(spark, lake, tables, most_changed=math.inf)
    assert rows_of(kept_sums.country_sales(sums)) == [("DE", Decimal("133.00"))]  # 27 orders at 3, 13 at 4
    agree(spark, tables, sums)


def test_sums_are_counted_anew_where_correcting_cannot_or_should_not(spark, small):
    lake, tables = small
    put(spark, tables, orders=[(f"O{k}", "C1", "P1", 3) for k in range(40)])
    assert current_sums(spark, lake, tables) is None  # 80 changed rows, 48 there
    refresh_sums(spark, lake, tables)
    put(spark, tables, orders=[("O1", "C2", "P2", 1)])
    tables["orders"].remove_superseded(keep=1)
    assert current_sums(spark, lake, tables, most_changed=math.inf) is None
    agree(spark, tables, refresh_sums(spark, lake, tables))

    # Sums of which a write was not finished do not count.
    assert [3, 1, 1] in kept_sums._earlier(spark, lake)
    kept_sums.storage.delete(spark, f"{lake}/sums/v-3-1-1/_SUCCESS")
    assert [3, 1, 1] not in kept_sums._earlier(spark, lake)


def test_amounts_beyond_their_type_are_left_to_a_recount(spark, tmp_path):
    tables = make_tables(spark, str(tmp_path))
    put(
        spark, tables,
        orders=[(f"O{k}", "C1", "P1", 9_999_999_999_999) for k in range(20)],
        customers=[("C1", "DE", None)],
        products=[("P1", 999_999_999_999_999.0)],
    )
    sums = refresh_sums(spark, str(tmp_path), tables)
    assert kept_sums.country_sales(sums) is None


def test_versions_of_a_table_that_is_not_there(spark, tmp_path):
    none = Versions("orders", make_tables(spark, str(tmp_path))["orders"], None, None)
    assert none.added().count() == none.removed().count() == none.common().count() == none.changed_rows() == 0

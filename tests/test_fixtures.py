"""The hand-written feeds of FIXTURES.md: exact routing, reasons and structured values."""

import datetime as dt
import hashlib
import os
import re
from collections import Counter

import pytest

from sluice import schemas
from sluice.plans.feeds import CUSTOMERS, FEEDS, salted_customers
from sluice.plans.routing import outcome_counts, rejected_rows, route, structured_rows
from sluice.plans.runs import run_all, run_feed, structured_table
from sluice.sources.tables import ROW_ID, read_path, with_file_row_id

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def write_sources(folder):
    text = open(os.path.join(ROOT, "FIXTURES.md")).read()
    for feed, body in re.findall(r"```csv (\w+)\n(.*?)```", text, re.S):
        os.makedirs(folder / feed)
        (folder / feed / "first.csv").write_text(body)


def make_lookups(spark):
    return {
        "country_code": spark.createDataFrame([("US", "United States"), ("FR", "France")], schemas.COUNTRY_LOOKUP),
        "department_code": spark.createDataFrame([("HR", "People"), ("IT", "Machines")], schemas.DEPARTMENT_LOOKUP),
    }


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    write_sources(base / "source")
    lookups = make_lookups(spark)
    run_all(spark, str(base / "source"), str(base / "lake"), lookups)
    return base, lookups


def raw(spark, base, feed):
    return with_file_row_id(read_path(spark, f"{base}/lake/raw/{feed}"))


def structured(spark, base, feed):
    return structured_table(spark, FEEDS[feed], f"{base}/lake/structured/{feed}")


@pytest.mark.parametrize(
    "feed, totals",
    [
        ("orders", {"clean": 3, "corrupt": 4, "duplicate": 1, "failed": 4}),
        ("customers", {"clean": 4, "corrupt": 1, "duplicate": 1, "failed": 3}),
        ("products", {"clean": 4, "corrupt": 1, "duplicate": 1, "failed": 3}),
    ],
)
def test_totals(spark, lake, feed, totals):
    base, lookups = lake
    routed = route(FEEDS[feed], raw(spark, base, feed), lookups)
    assert {r.outcome: r.rows for r in outcome_counts(routed).collect()} == totals


def rejects(spark, base, feed):
    rows = structured(spark, base, feed).read_rejects().collect()
    key = FEEDS[feed].key
    return sorted((str(r[key]), r.rejection_reason, r.rejection_detail) for r in rows)


CORRUPT, DUPLICATE, FAILED = (
    "Corrupt record - parsing failed",
    "Duplicate record",
    "Data quality check failed",
)


def test_orders(spark, lake):
    base, _ = lake
    rows = {r.order_id: r for r in structured(spark, base, "orders").read().collect()}
    assert sorted(rows) == ["O1", "O10", "O11"]
    assert (rows["O1"].order_year, rows["O1"].order_month, rows["O1"].order_day) == (2024, 1, 1)
    assert rejects(spark, base, "orders") == [
        (" O9 ", FAILED, "Invalid quantity (zero or negative)"),
        ("O1", DUPLICATE, None),
        ("O2", CORRUPT, None),
        ("O3", CORRUPT, None),
        ("O4", CORRUPT, None),
        ("O5", CORRUPT, None),
        ("O6", FAILED, "Required field is null"),
        ("O7", FAILED, "Invalid quantity (zero or negative)"),
        ("O8", FAILED, "Invalid order date"),
    ]
    lines = {r.order_id: r._corrupt_records for r in structured(spark, base, "orders").read_rejects().collect()}
    assert lines["O2"] == "O2,C1,P1,INVALID_DATE,5"
    assert lines["O5"] == "O5,C1,P1,2024-01-01,5,extra"


def test_customers(spark, lake):
    base, _ = lake
    rows = {r.customer_id: r for r in structured(spark, base, "customers").read().collect()}
    assert sorted(rows) == ["C1", "C6", "C7", "C8"]
    assert rows["C1"].first_name == sha("Ann") and rows["C1"].email == sha("ann.lee@gmail.com")
    assert rows["C7"].phone_number is None
    found = {k: (r.country_code, r.is_valid_country, r.department_code, r.is_valid_department) for k, r in rows.items()}
    assert found == {
        "C1": ("US", "Y", "HR", "Y"),
        "C6": ("XX6", "N", "YY6", "N"),
        "C7": ("US", "N", "HR", "Y"),
        "C8": (None, "N", "IT", "Y"),
    }
    assert rejects(spark, base, "customers") == [
        ("C1", DUPLICATE, None),
        ("C2", CORRUPT, None),
        ("C3", FAILED, "Required field is null; Invalid email format"),
        ("C4", FAILED, "Invalid email format"),
        ("None", FAILED, "Required field is null"),
    ]


def test_products(spark, lake):
    base, _ = lake
    rows = {r.product_id: r for r in structured(spark, base, "products").read().collect()}
    assert {k: r.price_category for k, r in rows.items()} == {
        "P1": "Budget",
        "P5": "Mid-Range",
        "P6": "Premium",
        "P7": "Luxury",
    }
    assert rows["P1"].product_name_cleaned == "DeskLamp 2"
    price = "Invalid price (zero, negative, or non-numeric)"
    assert rejects(spark, base, "products") == [
        ("P1", DUPLICATE, None),
        ("P2", CORRUPT, None),
        ("P3", FAILED, price),
        ("P4", FAILED, "Required field is null"),
        ("P8", FAILED, price),
    ]


@pytest.mark.parametrize("feed", list(FEEDS))
def test_structured_schema_is_the_declared_one(spark, lake, feed):
    base, _ = lake
    declared = {
        "customers": schemas.STRUCTURED_CUSTOMERS,
        "orders": schemas.STRUCTURED_ORDERS,
        "products": schemas.STRUCTURED_PRODUCTS,
    }[feed]
    found = structured(spark, base, feed).read().schema
    assert [(f.name, f.dataType) for f in found.fields] == [(f.name, f.dataType) for f in declared.fields]
    rejected = structured(spark, base, feed).read_rejects().drop("batch").schema
    expected = schemas.quarantine_schema(FEEDS[feed].schema)
    assert [(f.name, f.dataType) for f in rejected.fields] == [(f.name, f.dataType) for f in expected.fields]


def test_nothing_new_changes_nothing(spark, lake):
    base, lookups = lake
    before = structured(spark, base, "orders").current()
    assert run_all(spark, str(base / "source"), str(base / "lake"), lookups) == dict.fromkeys(FEEDS)
    assert structured(spark, base, "orders").current() == before


def test_result_does_not_depend_on_row_order_or_partitioning(spark, lake):
    base, lookups = lake
    columns = [*CUSTOMERS.columns, "outcome", "rejection_detail"]
    plain = route(CUSTOMERS, raw(spark, base, "customers"), lookups).select(*columns)
    shuffled = raw(spark, base, "customers").drop(ROW_ID).repartition(5, "first_name").orderBy("email")
    again = route(CUSTOMERS, shuffled, lookups).select(*columns)
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, again.collect()))


def test_options(spark, lake):
    base, lookups = lake
    rows = raw(spark, base, "customers")
    normalized = structured_rows(CUSTOMERS, route(CUSTOMERS, rows, lookups, normalize=True))
    assert {r.customer_id: r.is_valid_country for r in normalized.collect()}["C7"] == "Y"
    salted = salted_customers("pepper")
    names = {r.customer_id: r.first_name for r in structured_rows(salted, route(salted, rows, lookups)).collect()}
    assert names["C1"] == sha("pepperAnn")
    hidden = rejected_rows(CUSTOMERS, route(CUSTOMERS, rows, lookups), ["first_name", "email"]).collect()
    assert {r.first_name for r in hidden} == {sha(n) for n in ("Ann", "Bob", "Cyd", "Dee", "Eve")}
    assert {r._corrupt_records for r in hidden} == {None, sha("C2,Bob,Ray,bob@yahoo.com,555-2,INVALID_DATE,FR,IT")}


def test_prefer_valid_and_null_keys(spark):
    day = dt.date(2024, 1, 1)
    rows = spark.createDataFrame(
        [("A", "c", "p", day, 0, None), ("A", "c", "p", day, 5, None), *[(None, "c", "p", day, 5, None)] * 2],
        schemas.ORDERS_FEED,
    )

    def outcomes(**options):
        routed = route(FEEDS["orders"], rows, **options)
        return Counter((r.order_id, r.quantity, r.outcome) for r in routed.collect())

    assert outcomes() == {("A", 0, "failed"): 1, ("A", 5, "duplicate"): 1, (None, 5, "failed"): 2}
    assert outcomes(prefer_valid=True) == {("A", 5, "clean"): 1, ("A", 0, "duplicate"): 1, (None, 5, "failed"): 2}
    assert outcomes(null_keys_are_duplicates=True)[(None, 5, "failed")] == 1
    assert outcomes(null_keys_are_duplicates=True)[(None, 5, "duplicate")] == 1


def test_incremental_and_full_runs(spark, tmp_path):
    write_sources(tmp_path / "source")
    lookups = make_lookups(spark)
    source, lake_root = str(tmp_path / "source"), str(tmp_path / "lake")
    run_all(spark, source, lake_root, lookups)
    (tmp_path / "source" / "orders" / "second.csv").write_text(
        "order_id,customer_id,product_id,order_date,quantity\n"
        "O1,C1,P1,2024-01-01,9\nO20,C1,P1,2024-05-05,2\nO21,C1,,2024-05-05,2\n"
    )
    snapshots = run_all(spark, source, lake_root, lookups)
    assert snapshots["customers"] is None and snapshots["orders"].version == 2
    target = structured_table(spark, FEEDS["orders"], f"{lake_root}/structured/orders")
    assert {r.order_id: r.quantity for r in target.read().collect()} == {"O1": 9, "O10": 1, "O11": 1, "O20": 2}
    assert Counter(r.batch for r in target.read_rejects().collect()) == {1: 9, 2: 1}

    everything = with_file_row_id(read_path(spark, f"{lake_root}/raw/orders"))
    run_feed(FEEDS["orders"], everything, target, mode="full")
    assert {r.order_id: r.quantity for r in target.read().collect()} == {"O1": 9, "O10": 1, "O11": 1, "O20": 2}
    reasons = Counter(r.rejection_reason for r in target.read_rejects().collect())
    assert reasons == {CORRUPT: 4, FAILED: 5, DUPLICATE: 2}
    assert everything.count() == 15 == target.read().count() + target.read_rejects().count()


def test_run_that_dies_leaves_nothing_and_can_be_repeated(spark, tmp_path, monkeypatch):
    write_sources(tmp_path / "source")
    lookups = make_lookups(spark)
    source, lake_root = str(tmp_path / "source"), str(tmp_path / "lake")
    with monkeypatch.context() as patch:
        def lost(*_):
            raise RuntimeError("driver lost")

        patch.setattr("sluice.storage.publish_text", lost)
        with pytest.raises(RuntimeError):
            run_all(spark, source, lake_root, lookups)
    target = structured_table(spark, FEEDS["customers"], f"{lake_root}/structured/customers")
    assert target.current() is None and target.read_rejects() is None
    run_all(spark, source, lake_root, lookups)
    assert target.read().count() == 4 and target.read_rejects().count() == 5

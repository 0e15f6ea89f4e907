"""What Catalyst makes of the plans: pushed filters, pruned scans, few shuffles."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.operators import dedup, quality
from sluice.operators.skew import SkewGuard
from sluice.plans import marts, star_schema
from sluice.plans.feeds import CUSTOMERS, ORDERS
from sluice.plans.routing import route, structured_rows
from sluice.sources.tables import ROW_ID, rows_after, select_where, with_file_row_id

FOLDER = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def table(spark, name):
    return star_schema.table(spark, FOLDER, name)


def test_filter_and_projection_reach_the_scan(spark):
    text = plan(select_where(table(spark, "orders"), ["o_orderkey"], "o_orderstatus = 'F'"))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_high_water_bound_reaches_the_scan(spark):
    text = plan(rows_after(table(spark, "events"), "ts", "2024-01-20 00:00:00").select("event_id"))
    assert "GreaterThan(ts,2024-01-20T00:00)" in text


def test_date_rule_compares_dates_without_casting_the_column(spark):
    orders = table(spark, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    text = plan(quality.check_date_range(orders.select("d"), "d", "2020-01-01"))
    assert "2020-01-01" in text and "cast(2020-01-01" not in text


def test_routing_scans_once_and_shuffles_once(spark):
    text = plan(route(ORDERS, star_schema.raw_orders(spark, FOLDER)).drop(ROW_ID))
    assert text.count("FileScan") == 1 and shuffles(text) == 1
    assert ROW_ID not in text.split("Exchange")[0]


def test_structuring_adds_no_shuffle(spark):
    assert shuffles(plan(structured_rows(ORDERS, route(ORDERS, star_schema.raw_orders(spark, FOLDER))))) == 1


def test_first_rows_are_cut_before_the_shuffle(spark):
    text = plan(dedup.keep_first(table(spark, "lineitem"), ["l_orderkey", "l_linenumber"]))
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", text)


def test_small_lookup_is_broadcast(spark):
    orders = table(spark, "orders").select("o_orderkey", "o_custkey")
    checked = quality.check_referential_integrity(orders, table(spark, "customer"), "o_custkey", "c_custkey")
    text = plan(checked)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_all_rules_are_counted_in_one_pass(spark):
    rules = ORDERS.all_rules()
    tagged = star_schema.raw_orders(spark, FOLDER).withColumns({r.flag: r.expression for r in rules})
    text = plan(quality.count_failures(tagged, rules))
    assert text.count("FileScan") == 1 and shuffles(text) == 0


def test_sales_are_summed_before_they_meet_products(spark):
    orders, _, products = star_schema.sales_tables(spark, FOLDER)
    text = plan(marts.total_sales(orders, products))
    assert text.index("Join") < text.index("HashAggregate(keys=[product_id")


def test_top_countries_keep_ten_rows_per_task(spark):
    sales = marts.sales_by_country(*star_schema.sales_tables(spark, FOLDER))
    assert "TakeOrderedAndProject(limit=10" in plan(marts.top_countries(sales, star_schema.country_names(spark, FOLDER)))


@pytest.mark.parametrize("name", ["route_orders", "sales_by_region", "dedup_rejects_hot", "check_length"])
def test_no_python_workers(spark, name):
    from __spark_entry__ import queries

    text = plan(queries()[name](spark, FOLDER))
    assert not re.search(r"Python|Pandas|Arrow", text)


def test_probes_read_raw_rows_only(spark, tmp_path, monkeypatch):
    """With every lookup over the limit and hot keys: no probe joins or ranks, and each lookup is computed once."""
    star_schema.raw_customers(spark, FOLDER).drop(ROW_ID).write.parquet(str(tmp_path / "raw"))
    raw = with_file_row_id(spark.read.parquet(str(tmp_path / "raw")))
    lookups = star_schema.customer_lookups(spark, FOLDER)
    columns = ["customer_id", "is_valid_country", "is_valid_department", "outcome"]
    plain = Counter(map(tuple, route(CUSTOMERS, raw, lookups).select(*columns).collect()))

    probes, original = [], SkewGuard.hot_keys

    def watched(self, df, keys):
        probes.append(df._jdf.queryExecution().optimizedPlan().toString())
        return original(self, df, keys)

    monkeypatch.setattr(SkewGuard, "hot_keys", watched)
    monkeypatch.setattr("sluice.operators.skew.fits_broadcast", lambda *_, **__: False)
    routed = route(CUSTOMERS, raw, lookups, guard=SkewGuard(min_rows=5))
    assert probes and not any(word in text for text in probes for word in ("Join", "Window", "Aggregate"))
    text = routed._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in text and "nation" not in text  # lookups come from where they were written
    assert Counter(map(tuple, routed.select(*columns).collect())) == plain


from __future__ import annotations

import importlib.util
import math
import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from oracle import ORACLE_SQL  # noqa: E402
from sluice.functions import flags, transforms  # noqa: E402
from sluice.operators import dedup, quality  # noqa: E402
from sluice.operators.distinct import DistinctCounts  # noqa: E402
from sluice.operators.quality import Rule  # noqa: E402
from sluice.operators.skew import SkewGuard  # noqa: E402
from sluice.plans import marts, star_schema  # noqa: E402
from sluice.plans.feeds import CUSTOMERS, ORDERS, PRODUCTS  # noqa: E402
from sluice.plans.reports import lake_reports  # noqa: E402
from sluice.plans.routing import rejected_rows, route, structured_rows  # noqa: E402
from sluice.plans.runs import rule_counts as rule_counts_of  # noqa: E402
from sluice.plans.runs import run_all, run_feed, run_feed_into_catalog  # noqa: E402
from sluice.schemas import CORRUPT, INSERTED_AT, STRUCTURED_AT  # noqa: E402
from sluice.sinks.append import write_append, write_merge, write_rejected_records  # noqa: E402
from sluice.sinks.bucketed import create_bucketed, merge_bucketed  # noqa: E402
from sluice.sinks.catalog import set_up_tables  # noqa: E402
from sluice.sinks.clustered import write_clustered  # noqa: E402
from sluice.sinks.landing import LANDING, land_in_table, landing_name, read_landed  # noqa: E402
from sluice.sinks.snapshot import SnapshotTable  # noqa: E402
from sluice.sources.csv import read_static_csv  # noqa: E402
from sluice.sources.footers import footer_totals as footer_totals_of  # noqa: E402
from sluice.sources.tables import (  # noqa: E402
    ROW_ID,
    preview,
    read_path,
    read_table,
    read_table_incremental,
    rows_after,
    select_where,
    with_file_row_id,
)
from sluice.storage import scratch_path  # noqa: E402
from sluice.streaming.ingest import append_stream, ingest_feed, upsert_stream  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

table = star_schema.table

# Low bounds, so that the plans for hot keys and large lookups run on test data too.
EAGER_GUARD = SkewGuard(min_rows=200)


def _day(column: str):
    return F.date_format(column, "yyyy-MM-dd")


def _scratch_database(spark: SparkSession) -> str:
    name = f"sluice_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


# -- scans ---------------------------------------------------------------


def scan_filter_project(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return select_where(orders, ["o_orderkey", "o_totalprice"], "o_orderdate >= DATE'1997-01-01' AND o_orderstatus = 'F'")


def scan_sql(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        f"SELECT o_orderpriority, count(*) AS orders FROM parquet.`{sf}/orders.parquet` GROUP BY o_orderpriority"
    )


def scan_incremental(spark: SparkSession, sf: str) -> DataFrame:
    newer = rows_after(table(spark, sf, "events"), "ts", "2024-01-20 12:00:00")
    return select_where(newer, ["event_id", "user_id", "value"])


def read_static_lookup(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "lookup")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    parts.write.csv(path, header=True, sep=";")
    return read_static_csv(spark, path, parts.schema, sep=";")


def read_static_lookup_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "lookup")
    table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal").write.csv(path, header=True)
    return read_static_csv(spark, path)


# -- quality rules -------------------------------------------------------


def _events_with_corrupt(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type", "value", "props")
    return events.withColumn(CORRUPT, F.when(F.col("value") > 60, F.col("props"))).drop("props")


def split_corrupt_valid(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_corrupt_records(_events_with_corrupt(spark, sf))[0].drop(CORRUPT)


def split_corrupt_bad(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_corrupt_records(_events_with_corrupt(spark, sf))[1]


def _customers_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with an email each; segments of some nations and some emails are missing."""
    address = F.concat(F.replace("c_name", F.lit("#"), F.lit("_")), F.lit("@mail.example.org"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        "c_acctbal",
        F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_mktsegment") == "FURNITURE", F.col("c_name"))
        .when(F.col("c_mktsegment") != "MACHINERY", address)
        .alias("email"),
    )


def check_required(spark: SparkSession, sf: str) -> DataFrame:
    checked = quality.check_null_values(_customers_with_gaps(spark, sf), ["c_custkey", "c_mktsegment", "email"])
    return checked.select("c_custkey", "has_null_required")


def check_email(spark: SparkSession, sf: str) -> DataFrame:
    checked = quality.check_email_format(_customers_with_gaps(spark, sf), "email")
    return checked.select("c_custkey", "email", "is_valid_email")


def check_positive(spark: SparkSession, sf: str) -> DataFrame:
    checked = quality.check_positive_values(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey", "no_such_column"])
    return checked.select("c_custkey", "is_valid_c_acctbal", "is_valid_c_nationkey")


def check_date_range(spark: SparkSession, sf: str) -> DataFrame:
    checked = quality.check_date_range(table(spark, sf, "orders"), "o_orderdate", "1996-01-01", "2000-06-30")
    return checked.select("o_orderkey", "is_valid_date")


def check_date_range_timed(spark: SparkSession, sf: str) -> DataFrame:
    checked = quality.check_date_range(table(spark, sf, "events"), "ts", "2024-01-03 12:00:00", "2024-01-20 06:30:00.5")
    return checked.select("event_id", "is_valid_date")


def check_length(spark: SparkSession, sf: str) -> DataFrame:
    bounds = {"text": (20, 2000), "lang": (None, None), "source": (5, None)}
    checked = quality.check_string_length(table(spark, sf, "documents"), bounds)
    return checked.select("doc_id", "is_valid_length_text", "is_valid_length_source")


def check_reference(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    return quality.check_referential_integrity(documents, table(spark, sf, "labels"), "doc_id", "doc_id")


def check_reference_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    lines = with_file_row_id(table(spark, sf, "lineitem")).select("l_suppkey", "l_quantity", ROW_ID)
    known = table(spark, sf, "supplier").filter("s_acctbal > 2000")
    checked = quality.check_referential_integrity(
        lines, known, "l_suppkey", "s_suppkey", "is_known_supplier", guard=EAGER_GUARD, max_broadcast_rows=0
    )
    return checked.groupBy("l_suppkey", "is_known_supplier").agg(F.count("*").alias("lines"))


def check_reference_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of few suppliers, most of which a shuffled lookup does not have."""
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_quantity")
    known = table(spark, sf, "supplier").filter("s_acctbal > 7000")
    checked = quality.check_referential_integrity(
        lines, known, "l_suppkey", "s_suppkey", "is_known_supplier", max_broadcast_rows=0, prefilter=True
    )
    return checked.groupBy("l_suppkey", "is_known_supplier").agg(F.count("*").alias("lines"))


def check_domain(spark: SparkSession, sf: str) -> DataFrame:
    checked = quality.check_domain(
        _customers_with_gaps(spark, sf), "c_mktsegment", ["BUILDING", "FURNITURE", "MACHINERY"], "is_valid_segment"
    )
    return checked.select("c_custkey", "c_mktsegment", "is_valid_segment")


def _customer_rules() -> list[Rule]:
    return [
        Rule("has_null_required", flags.any_null(["c_mktsegment", "email"]), bad_value="Y", message="Required field is null"),
        Rule("is_valid_email", flags.email_format("email"), message="Invalid email format"),
        Rule("is_valid_c_acctbal", flags.positive("c_acctbal"), message="Invalid balance"),
    ]


def rejection_reasons(spark: SparkSession, sf: str) -> DataFrame:
    rules = _customer_rules()
    tagged = _customers_with_gaps(spark, sf).withColumns({rule.flag: rule.expression for rule in rules})
    reasons = quality.add_rejection_reasons(
        tagged, {rule.flag: rule.message for rule in rules}, {rule.flag: rule.bad_value for rule in rules}
    )
    return reasons.select("c_custkey", "rejection_reason")


def rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    rules = _customer_rules()
    tagged = _customers_with_gaps(spark, sf).withColumns({rule.flag: rule.expression for rule in rules})
    return quality.count_failures(tagged, rules)


# -- deduplication -------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]


def dedup_keep(spark: SparkSession, sf: str) -> DataFrame:
    kept, _ = dedup.split_duplicates(table(spark, sf, "lineitem"), LINE_KEY)
    return kept.withColumn("l_shipdate", _day("l_shipdate"))


def dedup_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, duplicates = dedup.split_duplicates(table(spark, sf, "lineitem"), LINE_KEY)
    return duplicates.withColumn("l_shipdate", _day("l_shipdate"))


def dedup_rejects_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Six keys hold all rows, so that every key is hot."""
    lines = with_file_row_id(table(spark, sf, "lineitem"))
    _, duplicates = dedup.split_duplicates(lines, ["l_returnflag", "l_linestatus"], guard=EAGER_GUARD)
    return duplicates.withColumn("l_shipdate", _day("l_shipdate")).drop(ROW_ID)


def dedup_split_hot_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Hot keys under an order that leaves most rows tied: kept and rejected rows make up the input."""
    lines = with_file_row_id(table(spark, sf, "lineitem"))
    kept, rejects = dedup.split_duplicates(lines, ["l_returnflag", "l_linestatus"], [F.desc("l_quantity")], EAGER_GUARD)
    both = kept.withColumn("kept", F.lit(1)).unionByName(rejects.withColumn("kept", F.lit(0)))
    return both.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("kept").alias("kept"),
        F.count("*").alias("rows"),
        F.count_distinct(ROW_ID).alias("distinct_rows"),
        F.max(F.when(F.col("kept") == 1, F.col("l_quantity"))).alias("kept_quantity"),
    )


# -- transforms ----------------------------------------------------------


def hash_pii(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", transforms.hash_pii("c_name").alias("c_name"))


def normalize_codes(spark: SparkSession, sf: str) -> DataFrame:
    padded = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("code")
    )
    return padded.select("c_custkey", transforms.normalize_code("code").alias("code"))


def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", *transforms.date_parts("o_orderdate"))


def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey",
        F.trim("p_name").alias("p_name"),
        transforms.clean_name("p_brand").alias("p_brand_cleaned"),
    )


def price_bands(spark: SparkSession, sf: str) -> DataFrame:
    values = table(spark, sf, "events").selectExpr("'event' AS item", "event_id AS id", "value")
    prices = table(spark, sf, "part").selectExpr("'part' AS item", "p_partkey AS id", "p_retailprice AS value")
    return values.unionByName(prices).select("item", "id", transforms.price_band("value").alias("price_category"))


# -- routing -------------------------------------------------------------


def _routed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    if name == "customers":
        return route(CUSTOMERS, star_schema.raw_customers(spark, sf), star_schema.customer_lookups(spark, sf))
    if name == "orders":
        return route(ORDERS, star_schema.raw_orders(spark, sf))
    return route(PRODUCTS, star_schema.raw_products(spark, sf))


def route_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _routed(spark, sf, "orders").withColumn("order_date", _day("order_date")).drop(INSERTED_AT, ROW_ID)


def route_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _routed(spark, sf, "customers").withColumn("signup_date", _day("signup_date")).drop(INSERTED_AT, ROW_ID)


def route_products(spark: SparkSession, sf: str) -> DataFrame:
    return _routed(spark, sf, "products").drop(INSERTED_AT, ROW_ID)


def route_orders_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Orders keyed by supplier, every supplier hot; NULL keys compared too."""
    raw = star_schema.raw_orders(spark, sf).withColumn("order_id", F.col("customer_id"))
    routed = route(ORDERS, raw, null_keys_are_duplicates=True, guard=EAGER_GUARD)
    return routed.groupBy("order_id", "outcome").agg(F.count("*").alias("rows"))


def route_orders_prefer_valid(spark: SparkSession, sf: str) -> DataFrame:
    raw = star_schema.raw_orders(spark, sf)
    routed = route(ORDERS, raw, prefer_valid=True).withColumn("order_date", _day("order_date"))
    return routed.select("order_id", "customer_id", "product_id", "order_date", "quantity", "outcome", "rejection_detail")


def structured_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = structured_rows(ORDERS, _routed(spark, sf, "orders"))
    return rows.withColumn("order_date", _day("order_date")).drop(STRUCTURED_AT)


def structured_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """The processing time of structured rows: one for all, and not in the future."""
    rows = structured_rows(ORDERS, _routed(spark, sf, "orders"))
    stamp = F.col(STRUCTURED_AT)
    return rows.groupBy("order_year").agg(
        F.count_if(stamp.isNotNull() & (stamp <= F.current_timestamp())).alias("stamped"),
        F.count_distinct(stamp).alias("stamps"),
    )


def structured_customers(spark: SparkSession, sf: str) -> DataFrame:
    rows = structured_rows(CUSTOMERS, _routed(spark, sf, "customers"))
    return rows.withColumn("signup_date", _day("signup_date")).drop(STRUCTURED_AT)


def structured_products(spark: SparkSession, sf: str) -> DataFrame:
    return structured_rows(PRODUCTS, _routed(spark, sf, "products")).drop(STRUCTURED_AT)


def rejected_customers(spark: SparkSession, sf: str) -> DataFrame:
    rows = rejected_rows(CUSTOMERS, _routed(spark, sf, "customers"))
    return rows.withColumn("signup_date", _day("signup_date")).drop("rejected_at")


# -- reports -------------------------------------------------------------


def _outcome_layers(spark: SparkSession, sf: str) -> DataFrame:
    return marts.routed_layer_counts({name: _routed(spark, sf, name) for name in ("customers", "orders", "products")})


def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _outcome_layers(spark, sf)


def rejection_rates(spark: SparkSession, sf: str) -> DataFrame:
    return marts.rejection_rates(_outcome_layers(spark, sf))


def quality_rate(spark: SparkSession, sf: str) -> DataFrame:
    return marts.quality_rate(_outcome_layers(spark, sf))


def reason_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return marts.reason_histogram({name: _routed(spark, sf, name) for name in ("customers", "orders", "products")})


def ingest_batches(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn(INSERTED_AT, F.date_trunc("day", "ts"))
    return marts.ingest_batches(events).withColumn("last_ingest", _day("last_ingest"))


def entity_counts(spark: SparkSession, sf: str) -> DataFrame:
    return marts.entity_counts(*star_schema.sales_tables(spark, sf))


def total_sales(spark: SparkSession, sf: str) -> DataFrame:
    orders, _, products = star_schema.sales_tables(spark, sf)
    return marts.total_sales(orders, products)


def total_sales_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """Some prices are huge, infinite or tiny."""
    orders, _, products = star_schema.sales_tables(spark, sf)
    kind = F.col("product_id") % 50
    price = F.when(kind == 0, 2e12).when(kind == 1, float("inf")).when(kind == 2, 1e-7).otherwise(F.col("price"))
    return marts.total_sales(orders, products.withColumn("price", price))


def sales_by_country_top10(spark: SparkSession, sf: str) -> DataFrame:
    country_sales = marts.sales_by_country(*star_schema.sales_tables(spark, sf))
    return marts.top_countries(country_sales, star_schema.country_names(spark, sf))


def sales_by_region(spark: SparkSession, sf: str) -> DataFrame:
    country_sales = marts.sales_by_country(*star_schema.sales_tables(spark, sf))
    return marts.sales_by_region(country_sales, star_schema.region_mapping(spark, sf))


def customers_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    _, customers, _ = star_schema.sales_tables(spark, sf)
    names = customers.select("department_code", F.initcap("department_code").alias("department_name")).distinct()
    return marts.customers_by_department(customers, names.filter("department_code <> 'FURNITURE'"))


# -- sinks and streams ---------------------------------------------------


def _part_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Parts under doubled keys: about half replace a part, the others are new."""
    return table(spark, sf, "part").select(
        (F.col("p_partkey") * 2).alias("p_partkey"),
        F.concat("p_name", F.lit(" II")).alias("p_name"),
        "p_brand",
        "p_type",
        (F.col("p_size") + 1).alias("p_size"),
        "p_retailprice",
    )


def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    target = SnapshotTable(spark, scratch_path(spark, "parts"), "p_partkey")
    target.upsert(table(spark, sf, "part"))
    target.upsert(_part_changes(spark, sf))
    return target.read()


def merge_catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{_scratch_database(spark)}.parts"
    write_append(table(spark, sf, "part"), name)
    write_merge(_part_changes(spark, sf), name, "p_partkey")
    return spark.table(name)


def merge_partitioned_table(spark: SparkSession, sf: str) -> DataFrame:
    """Orders partitioned by status and merged three times: updates in place, moves, inserts and a new partition."""
    name = f"{_scratch_database(spark)}.orders"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_append(orders.filter("o_orderstatus <> 'P'"), name, ["o_orderstatus"])
    write_merge(orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1), name, "o_orderkey")
    moved = orders.filter("o_orderstatus = 'O' AND o_totalprice < 100000").withColumn("o_orderstatus", F.lit("F"))
    write_merge(moved.unionByName(orders.filter("o_orderstatus = 'P'")), name, "o_orderkey")
    late = orders.filter("o_totalprice > 400000").withColumn("o_orderstatus", F.lit("it's X/Y"))
    write_merge(late.withColumn("note", F.lit("late")), name, "o_orderkey")
    return spark.table(name)


def merge_bucketed_table(spark: SparkSession, sf: str) -> DataFrame:
    """Orders bucketed by key and merged twice: updates and inserts, then some with a new column."""
    name = f"{_scratch_database(spark)}.orders"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    create_bucketed(orders.filter("o_orderstatus <> 'P'"), name, "o_orderkey", 8)
    dearer = orders.filter("o_orderstatus <> 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    merge_bucketed(dearer, name, "o_orderkey")
    merge_bucketed(orders.filter("o_totalprice > 400000").withColumn("note", F.lit("high")), name, "o_orderkey")
    return spark.table(name)


def append_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{_scratch_database(spark)}.orders"
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("order_year")
    )
    write_append(orders.filter("o_orderstatus = 'F'").drop("o_orderpriority"), name, ["order_year"])
    write_append(orders.filter("o_orderstatus <> 'F'"), name, ["order_year"])
    return spark.table(name)


def catalog_setup(spark: SparkSession, sf: str) -> DataFrame:
    """All tables of the layers are created, twice; product records then go to theirs."""
    prefix = f"sluice_{uuid.uuid4().hex}_"
    for _ in range(2):
        set_up_tables(spark, scratch_path(spark, "catalog"), prefix)
    raw = star_schema.raw_products(spark, sf).drop(ROW_ID, INSERTED_AT)
    write_append(raw.select(*reversed(raw.columns)), f"{prefix}raw.products")
    return spark.table(f"{prefix}raw.products").drop(INSERTED_AT, LANDING)


def catalog_run(spark: SparkSession, sf: str) -> DataFrame:
    """Product records structured twice into catalog tables; rows of both tables, counted."""
    prefix = f"sluice_{uuid.uuid4().hex}_"
    set_up_tables(spark, scratch_path(spark, "catalog"), prefix)
    raw = star_schema.raw_products(spark, sf).drop(ROW_ID)
    write_append(raw.withColumn(INSERTED_AT, F.col(INSERTED_AT).cast("timestamp")), f"{prefix}raw.products")
    names = [f"{prefix}raw.products", f"{prefix}structured.products", f"{prefix}structured.products_rejected"]
    for _ in range(2):
        run_feed_into_catalog(PRODUCTS, *names)
    kept = spark.table(names[1]).select(F.col("price_category").alias("kind"), "price")
    rejects = spark.table(names[2]).select(F.col("rejection_reason").alias("kind"), "price")
    return kept.unionByName(rejects).groupBy("kind").agg(F.count("*").alias("rows"), F.max("price").alias("highest"))


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{_scratch_database(spark)}.customers_rejected"
    customers = quality.check_email_format(_customers_with_gaps(spark, sf), "email")
    bad = customers.filter("is_valid_email = 'N'").drop("is_valid_email")
    write_rejected_records(bad, name, "Data quality check failed")
    write_rejected_records(bad.filter(F.lit(False)), name, "Duplicate record")
    return spark.table(name).drop("rejected_at")


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Events as CSV lines, some unreadable; landed in two drains and one with nothing new."""
    base = scratch_path(spark, "ingest")
    lines = table(spark, sf, "events").select(
        "event_type",
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("product_id"),
        F.when(F.col("value") > 100, F.lit("INVALID_DATE")).otherwise(_day("ts")).alias("order_date"),
        F.when(F.col("value") >= 1, F.floor("value").cast("string")).alias("quantity"),
    )

    def drain() -> None:
        ingest_feed(spark, ORDERS, f"{base}/source", f"{base}/checkpoint", path=f"{base}/raw")

    lines.filter("event_type <> 'purchase'").drop("event_type").write.csv(f"{base}/source", header=True)
    drain()
    drain()
    lines.filter("event_type = 'purchase'").drop("event_type").write.mode("append").csv(f"{base}/source", header=True)
    drain()
    raw = read_path(spark, f"{base}/raw")
    first = raw.agg(F.min(INSERTED_AT)).first()[0]
    return raw.withColumn("batch", F.when(F.col(INSERTED_AT) == F.lit(first), 1).otherwise(2)).select(
        "order_id", "customer_id", "product_id", _day("order_date").alias("order_date"), "quantity", CORRUPT, "batch"
    )


def _files_as_stream(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Add rows to a folder of files and stream the folder."""
    rows.write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def _upsert_latest_events(spark: SparkSession, sf: str, sources: list[tuple[str, str]]) -> DataFrame:
    """Latest event of every user, from events that arrive in parts: ``(stream, condition)``."""
    base = scratch_path(spark, "latest")
    target = SnapshotTable(spark, f"{base}/table", "user_id")
    for name, condition in sources:
        stream = _files_as_stream(spark, f"{base}/{name}", table(spark, sf, "events").filter(condition))
        upsert_stream(stream, target, [F.desc("ts"), F.col("event_id")], f"{base}/checkpoint-{name}")
    return target.read().drop("ts", "props")


def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches; the second one brings rows older than those of the first."""
    late = "ts < TIMESTAMP_NTZ'2024-01-15 00:00:00'"
    parts = [f"NOT {late} AND user_id % 3 > 0", late, f"NOT {late} AND user_id % 3 = 0"]
    return _upsert_latest_events(spark, sf, [("events", part) for part in parts])


def stream_upsert_two_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams with checkpoints of their own feed one table, in turns."""
    parts = [("a", "event_type = 'purchase'"), ("b", "event_type = 'view'"), ("a", "event_type = 'click'")]
    return _upsert_latest_events(spark, sf, [*parts, ("b", "event_type NOT IN ('purchase', 'view', 'click')")])


def stream_widen(spark: SparkSession, sf: str) -> DataFrame:
    """A stream that gains a column, into a folder and into a table."""
    base, database = scratch_path(spark, "widen"), _scratch_database(spark)
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    small = F.col("p_partkey") % 2 == 0
    for kind, where in (("folder", {"path": f"{base}/raw"}), ("table", {"table": f"{database}.parts"})):
        for step, rows in enumerate((parts.filter(small).drop("p_size"), parts.filter(~small))):
            stream = _files_as_stream(spark, f"{base}/{kind}/{step}", rows)
            append_stream(stream, f"{base}/checkpoint-{kind}-{step}", **where)
    found = read_landed(spark, f"{base}/raw").withColumn("sink", F.lit("folder"))
    return (
        found.unionByName(spark.table(f"{database}.parts").withColumn("sink", F.lit("table")), allowMissingColumns=True)
        .select("sink", "p_partkey", "p_name", "p_size")
    )


def incremental_runs_late(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed by a stream in two batches; rows of the second have no stamp or an earlier one."""
    base = scratch_path(spark, "late")
    raw = star_schema.raw_orders(spark, sf).drop(ROW_ID)
    target = SnapshotTable(spark, f"{base}/structured", ORDERS.key)
    early = F.col("quantity") < 20
    late = F.when(F.col("quantity") % 2 != 0, F.lit("2023-01-01"))
    for rows, stamp in ((raw.filter(early), F.lit("2024-01-02")), (raw.filter(~early), late)):
        stream = _files_as_stream(spark, f"{base}/source", rows.withColumn(INSERTED_AT, stamp.cast("timestamp")))
        append_stream(stream, f"{base}/checkpoint", path=f"{base}/raw")
        for _ in range(2):  # the second time nothing is new
            run_feed(ORDERS, read_landed(spark, f"{base}/raw"), target)
    return _run_report(target)


def incremental_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed in two batches, each structured by an incremental run."""
    base = scratch_path(spark, "runs")
    raw = star_schema.raw_orders(spark, sf).drop(ROW_ID)
    target = SnapshotTable(spark, f"{base}/structured", ORDERS.key)
    early = F.col("quantity") < 20
    for batch, stamp in ((raw.filter(early), "2024-01-01"), (raw.filter(~early), "2024-01-02")):
        batch.withColumn(INSERTED_AT, F.lit(stamp).cast("timestamp")).write.mode("append").parquet(f"{base}/raw")
        run_feed(ORDERS, with_file_row_id(read_path(spark, f"{base}/raw")), target)
    return _run_report(target)


def run_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What a run counted while it wrote: outcomes, and failures of each rule."""
    raw = star_schema.raw_orders(spark, sf).withColumn(INSERTED_AT, F.lit("2024-01-01").cast("timestamp"))
    target = SnapshotTable(spark, scratch_path(spark, "counted"), ORDERS.key)
    counts = rule_counts_of(run_feed(ORDERS, raw, target))
    return spark.createDataFrame(list(counts.items()), "name string, rows long")


def lake_layers(spark: SparkSession, sf: str) -> DataFrame:
    """A round over two feeds, one of them without files yet, and a report of all layers."""
    base = scratch_path(spark, "lake")
    events = table(spark, sf, "events")
    lines = events.select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("product_id"),
        F.when(F.col("value") > 100, F.lit("INVALID_DATE")).otherwise(F.lit("2024-01-01")).alias("order_date"),
        F.when(F.col("value") >= 1, F.floor("value").cast("string")).alias("quantity"),
    )
    lines.write.csv(f"{base}/source/orders", header=True)
    names = star_schema.customer_lookups(spark, sf)
    run_all(spark, f"{base}/source", f"{base}/lake", names)
    countries, departments = (
        names[code].withColumn(code.replace("code", "name"), F.col(code)) for code in ("country_code", "department_code")
    )
    return lake_reports(spark, f"{base}/lake", countries, departments)["layer_counts"]


def _feed_files(spark: SparkSession, sf: str) -> dict[str, list[DataFrame]]:
    """CSV lines of each feed in two deliveries; the second one repeats some customers and orders with other values."""
    key = F.col("c_custkey")
    customers = table(spark, sf, "customer").select(
        key.alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("c"), key, F.lit("@example.com"))).otherwise("none").alias("email"),
        F.lit("555").alias("phone_number"),
        F.lit("2024-01-05").alias("signup_date"),
        F.concat(F.lit("N"), "c_nationkey").alias("country_code"),
        F.col("c_mktsegment").alias("department_code"),
    )
    moved = F.concat(F.lit("N"), (F.substring("country_code", 2, 9).cast("int") + 1) % 25)
    products = table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lit("Books").alias("category"),
        F.when(F.col("p_size") % 10 == 0, F.lit(-1.0)).otherwise(F.col("p_retailprice")).alias("price"),
    )
    number = F.col("o_orderkey")
    orders = table(spark, sf, "orders").select(
        number.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (number % 200 + 1).alias("product_id"),
        F.lit("2024-01-05").alias("order_date"),
        (number % 7).alias("quantity"),
    )
    again = customers.filter("customer_id % 10 = 0").withColumn("country_code", moved)
    more = orders.filter("order_id % 3 = 1").withColumn("quantity", F.col("quantity") + 1)
    return {
        "customers": [customers.filter("customer_id % 2 = 0"), customers.filter("customer_id % 2 = 1").unionByName(again)],
        "orders": [orders.filter("order_id % 3 > 0"), orders.filter("order_id % 3 = 0").unionByName(more)],
        "products": [products.filter("product_id % 2 = 0"), products.filter("product_id % 2 = 1")],
    }


def _rounds(spark: SparkSession, sf: str, **how) -> dict[str, DataFrame]:
    """The reports of a lake after two rounds over CSV files of all feeds."""
    base = scratch_path(spark, "rounds")
    countries = table(spark, sf, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("country_code"), F.col("n_name").alias("country_name"))
    departments = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("department_code")).distinct()
    departments = departments.withColumn("department_name", F.lower("department_code"))
    files = _feed_files(spark, sf)
    for delivery in range(2):
        for feed, lines in files.items():
            lines[delivery].write.mode("append").csv(f"{base}/source/{feed}", header=True)
        run_all(spark, f"{base}/source", f"{base}/lake", {"country_code": countries, "department_code": departments}, **how)
    return lake_reports(spark, f"{base}/lake", countries, departments)


def _figures(reports: dict[str, DataFrame], wanted: list[str]) -> DataFrame:
    figures = {
        "layer_counts": (F.concat_ws(" ", "feed", "layer"), "rows"),
        "reason_histogram": (F.concat_ws(" ", "feed", "rejection_reason"), "rows"),
        "entity_counts": (F.col("entity"), "entities"),
        "total_sales": (F.lit("all"), "total_sales"),
        "top_countries": (F.col("country_name"), "sales"),
        "customers_by_department": (F.col("department_name"), "customers"),
    }
    rows = [
        reports[report].select(F.lit(report).alias("report"), name.alias("name"), F.col(value).cast("decimal(28,2)").alias("value"))
        for report, (name, value) in figures.items()
        if report in wanted
    ]
    return reduce(DataFrame.unionByName, rows)


SALES_REPORTS = ["total_sales", "top_countries", "customers_by_department"]


def lake_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Two rounds over CSV files of all feeds, and the reports that the lake then gives; figures by report and name."""
    return _figures(_rounds(spark, sf), ["layer_counts", "reason_histogram", "entity_counts", *SALES_REPORTS])


def lake_sales_corrected(spark: SparkSession, sf: str) -> DataFrame:
    """The sales reports of those rounds from sums that the second round corrects, however much it changed."""
    return _figures(_rounds(spark, sf, most_changed=math.inf), SALES_REPORTS)


def scan_clustered(spark: SparkSession, sf: str) -> DataFrame:
    """Events laid out by time in two appends, then read above a bound."""
    path = scratch_path(spark, "clustered")
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    for rows in (events.filter("user_id % 2 = 0"), events.filter("user_id % 2 <> 0")):
        write_clustered(rows, path, ["ts"])
    return select_where(rows_after(read_path(spark, path), "ts", "2024-01-28 00:00:00"), ["event_id", "user_id", "value"])


def footer_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and bounds of whole tables, and of the partitions of one, from parquet footers."""
    path = scratch_path(spark, "by-status")
    table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    found = [("status " + r["o_orderstatus"], *r[1:]) for r in footer_totals_of(spark, [path], ["o_orderkey", "o_totalprice"], ["o_orderstatus"])]
    for name, key, value in (("lineitem", "l_orderkey", "l_extendedprice"), ("customer", "c_custkey", "c_acctbal"), ("part", "p_partkey", "p_size")):
        found.append((name, *footer_totals_of(spark, [f"{sf}/{name}.parquet"], [key, value])[0]))
    rows = [(name, n, a, b, float(c), float(d)) for name, n, a, b, c, d in found]
    return spark.createDataFrame(rows, "name string, rows long, min_key long, max_key long, min_value double, max_value double")


def distinct_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct orders and parts of lineitem by flag and status from kept bitmaps; the second of three deliveries comes twice."""
    lines = table(spark, sf, "lineitem")
    counted = []
    for key in ("l_orderkey", "l_partkey"):
        kept = DistinctCounts(spark, scratch_path(spark, "bitmaps"), key, ["l_returnflag", "l_linestatus"])
        for version in (0, 1, 1, 2):
            kept.add(lines.filter(F.col("l_linenumber") % 3 == version), version, clustered=key == "l_orderkey")
        for groups in (["l_returnflag", "l_linestatus"], ["l_returnflag"], []):
            rest = [F.lit("all").alias(name) for name in ("l_returnflag", "l_linestatus") if name not in groups]
            counted.append(kept.count(groups, "keys").select(F.lit(key).alias("key"), *groups, *rest, "keys"))
    return reduce(DataFrame.unionByName, counted)


def scan_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Tables read by name: filtered and pruned, above a bound, and looked at by SQL."""
    database = _scratch_database(spark)
    table(spark, sf, "events").write.format("parquet").saveAsTable(f"{database}.events")
    found = read_table(spark, f"{database}.events", ["event_id", "value"], "event_type = 'click' AND value > 20")
    newer = read_table_incremental(spark, f"{database}.events", "ts", "2024-01-20 12:00:00", ["event_id", "value"])
    top = preview(spark, f"SELECT event_id, value FROM {database}.events ORDER BY value DESC, event_id", 20)
    reads = (("filtered", found), ("newer", newer), ("preview", top))
    return reduce(DataFrame.unionByName, [rows.withColumn("read", F.lit(name)) for name, rows in reads])


def catalog_run_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customer records landed twice in the catalog, each landing structured by an incremental run."""
    prefix = f"sluice_{uuid.uuid4().hex}_"
    set_up_tables(spark, scratch_path(spark, "catalog"), prefix)
    raw = star_schema.raw_customers(spark, sf).drop(ROW_ID)
    raw = raw.withColumn(INSERTED_AT, F.col(INSERTED_AT).cast("timestamp"))
    names = [f"{prefix}raw.customers", f"{prefix}structured.customers", f"{prefix}structured.customers_rejected"]
    lookups = star_schema.customer_lookups(spark, sf)
    for number, condition in enumerate(("phone_number IS NULL", "phone_number IS NOT NULL")):
        land_in_table(raw.filter(condition), names[0], landing_name("driver", number))
        for _ in range(2):
            run_feed_into_catalog(CUSTOMERS, *names, lookups, spark=spark, mode="incremental")
    kept = spark.table(names[1]).select(
        F.concat_ws(" ", "is_valid_country", "is_valid_department").alias("kind"), "signup_date"
    )
    rejects = spark.table(names[2]).select(F.col("rejection_reason").alias("kind"), "signup_date")
    both = kept.unionByName(rejects).groupBy("kind").agg(F.count("*").alias("rows"), F.max("signup_date").alias("last"))
    return both.withColumn("last", _day("last"))


def _run_report(target: SnapshotTable) -> DataFrame:
    kept = target.read().groupBy("order_year", "order_month").agg(
        F.count("*").alias("rows"), F.sum("quantity").alias("quantity")
    )
    kept = kept.withColumns({"layer": F.lit("structured"), "reason": F.lit("")})
    rejects = target.read_rejects().groupBy("rejection_reason", "batch").agg(
        F.count("*").alias("rows"), F.sum("quantity").alias("quantity")
    )
    return kept.unionByName(
        rejects.select(
            F.lit("rejected").alias("layer"),
            F.col("rejection_reason").alias("reason"),
            F.col("batch").alias("order_year"),
            F.lit(0).alias("order_month"),
            "rows",
            "quantity",
        )
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        scan_filter_project,
        scan_sql,
        scan_incremental,
        scan_by_name,
        scan_clustered,
        footer_totals,
        distinct_bitmaps,
        read_static_lookup,
        read_static_lookup_inferred,
        split_corrupt_valid,
        split_corrupt_bad,
        check_required,
        check_email,
        check_positive,
        check_date_range,
        check_date_range_timed,
        check_length,
        check_reference,
        check_reference_shuffled,
        check_reference_filtered,
        check_domain,
        rejection_reasons,
        rule_counts,
        dedup_keep,
        dedup_rejects,
        dedup_rejects_hot,
        dedup_split_hot_ties,
        hash_pii,
        normalize_codes,
        date_parts,
        clean_names,
        price_bands,
        route_orders,
        route_customers,
        route_products,
        route_orders_hot,
        route_orders_prefer_valid,
        structured_orders,
        structured_stamp,
        structured_customers,
        structured_products,
        rejected_customers,
        layer_counts,
        rejection_rates,
        quality_rate,
        reason_histogram,
        ingest_batches,
        entity_counts,
        total_sales,
        total_sales_extremes,
        sales_by_country_top10,
        sales_by_region,
        customers_by_segment,
        merge_upsert,
        merge_catalog_table,
        merge_partitioned_table,
        merge_bucketed_table,
        append_partitioned,
        catalog_setup,
        catalog_run,
        quarantine,
        stream_ingest,
        stream_upsert,
        stream_upsert_two_sources,
        stream_widen,
        incremental_runs,
        incremental_runs_late,
        run_rule_counts,
        lake_layers,
        lake_rounds,
        lake_sales_corrected,
        catalog_run_customers,
    )
}


def _text_queries() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries of the text operators and of their pipeline, none if those are not installed."""
    spec = importlib.util.find_spec("sluice.llm")
    if spec is None or spec.origin is None:  # a left-over folder without code has no origin
        return {}, {}
    from sluice.llm.queries import ORACLE_SQL as text_sql
    from sluice.llm.queries import QUERIES as text_queries

    found, sqls = dict(text_queries), dict(text_sql)
    if importlib.util.find_spec("corpus_pipeline") is not None:
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sqls["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sqls


TEXT_QUERIES, TEXT_SQL = _text_queries()


def entry(spark: SparkSession) -> DataFrame:
    """Which order rows are structured, which are rejected, and why."""
    return route_orders(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return QUERIES | TEXT_QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLE_SQL | TEXT_SQL

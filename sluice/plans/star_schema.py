"""The feeds, shaped from star-schema tables in parquet (customer, orders, lineitem, events ...).

The tables are clean, so defects are derived from their own values: an order
line with a certain discount is unreadable, one with a certain tax lacks its
customer, and so on. Every row of the tables takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.skew import lookup_join
from sluice.schemas import CORRUPT, INSERTED_AT
from sluice.sources.tables import ROW_ID, read_path, with_file_row_id


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_path(spark, f"{folder}/{name}.parquet")


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One order row per line item; line numbers repeat within an order."""
    lines = with_file_row_id(table(spark, folder, "lineitem"))
    return lines.select(
        F.when(F.col("l_discount") != 0.09, F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("order_id"),
        F.when(F.col("l_tax") != 0.08, F.col("l_suppkey").cast("string")).alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.add_months(F.col("l_shipdate").cast("date"), 24 * 12).alias("order_date"),
        (F.col("l_quantity").cast("int") - 3).alias("quantity"),
        F.when(F.col("l_discount") == 0.1, F.concat_ws(",", "l_orderkey", "l_linenumber")).alias(CORRUPT),
        F.col("l_shipdate").alias(INSERTED_AT),
        ROW_ID,
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """A customer record per order, so most customers come many times."""
    orders = with_file_row_id(table(spark, folder, "orders"))
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customers = table(spark, folder, "customer").join(nation, "c_nationkey")
    customers = customers.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "n_name")
    joined = lookup_join(orders, customers, "o_custkey", [ROW_ID])
    address = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return joined.select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("C"), "o_custkey")).alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.when(urgent, F.col("c_name"))
        .when(F.col("o_orderstatus") != "P", address)
        .alias("email"),
        F.when(~urgent, F.col("o_orderpriority")).alias("phone_number"),
        F.col("o_orderdate").cast("date").alias("signup_date"),
        F.lower("n_name").alias("country_code"),
        F.concat(F.lit(" "), "o_orderstatus").alias("department_code"),
        F.when(F.col("o_totalprice") < 20000, F.concat_ws(",", "o_orderkey", "o_custkey")).alias(CORRUPT),
        F.col("o_orderdate").alias(INSERTED_AT),
        ROW_ID,
    )


def customer_lookups(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Known codes: nations of the first regions, and the line status values."""
    nation = table(spark, folder, "nation").filter("n_regionkey < 4")
    status = table(spark, folder, "lineitem").select(F.concat(F.lit(" "), "l_linestatus").alias("department_code"))
    return {
        "country_code": nation.select(F.lower("n_name").alias("country_code")),
        "department_code": status.distinct(),
    }


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    """A product record per event, keyed by the event's user."""
    kind = F.col("event_type")
    return with_file_row_id(table(spark, folder, "events")).select(
        F.col("user_id").cast("string").alias("product_id"),
        F.concat(F.lit(" "), "props", F.lit("-"), kind).alias("product_name"),
        F.when(kind == "purchase", F.lit("Electronics"))
        .when(kind == "view", F.lit("Books "))
        .when(kind == "click", F.lit("Clothing"))
        .when(kind == "error", F.lit("Jewels"))
        .alias("category"),
        F.when(F.col("value") > 1, (F.col("value") - 5) * 10).alias("price"),
        F.when(F.col("value") > 100, F.col("props")).alias(CORRUPT),
        F.col("ts").alias(INSERTED_AT),
        ROW_ID,
    )


def sales_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Structured orders, customers and products for the business reports."""
    lines = with_file_row_id(table(spark, folder, "lineitem"))
    headers = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    orders = lookup_join(lines, headers, "l_orderkey", [ROW_ID]).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        ROW_ID,
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_nationkey").cast("string").alias("country_code"),
        F.col("c_mktsegment").alias("department_code"),
    )
    products = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_retailprice").alias("price")
    )
    return orders, customers, products


def country_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("string").alias("country_code"), F.col("n_name").alias("country_name")
    )


def region_mapping(spark: SparkSession, folder: str) -> dict[str, str]:
    """Region of each of the 25 nations."""
    region = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    pairs = table(spark, folder, "nation").join(region, "n_regionkey").select("n_nationkey", "r_name").collect()
    return {str(row.n_nationkey): row.r_name for row in pairs}

"""Reports over the layers, as aggregations; only their few rows leave Spark.

Groups without a key are left out, and a sum over nothing is zero.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.transforms import line_amount, map_value
from sluice.operators.skew import SkewGuard, lookup_join
from sluice.schemas import INSERTED_AT, REGION_OF_COUNTRY
from sluice.sources.tables import ROW_ID

MONEY = "decimal(28,2)"


def _sum_money(column: str) -> Column:
    return F.when(F.count(column) == 0, 0).otherwise(F.try_sum(column)).try_cast(MONEY)


def _percent(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part) * F.lit(100.0), F.col(whole)), F.lit(0.0))


def _layer_rows(layer: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("layer") == layer, F.col("rows"))), F.lit(0))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -- ingestion -----------------------------------------------------------


def layer_counts(layers: Mapping[str, Mapping[str, DataFrame | None]]) -> DataFrame:
    """Rows per feed and layer, given ``{feed: {layer: frame}}``; an absent frame is not reported."""
    return _union(
        [
            frame.agg(F.count("*").alias("rows")).select(
                F.lit(feed).alias("feed"), F.lit(layer).alias("layer"), "rows"
            )
            for feed, frames in layers.items()
            for layer, frame in frames.items()
            if frame is not None
        ]
    )


def routed_layer_counts(routed: Mapping[str, DataFrame]) -> DataFrame:
    """The counts of :func:`layer_counts` from routed rows, in one pass per feed."""
    counted = []
    for feed, frame in routed.items():
        clean = F.col("outcome") == "clean"
        totals = frame.agg(
            F.count("*").alias("raw"), F.count_if(clean).alias("structured"), F.count_if(~clean).alias("rejected")
        )
        rows = totals.unpivot([], ["raw", "structured", "rejected"], "layer", "rows")
        counted.append(rows.select(F.lit(feed).alias("feed"), "layer", "rows"))
    return _union(counted)


def ingest_batches(raw: DataFrame, stamp: str = INSERTED_AT) -> DataFrame:
    """Number of ingested batches and time of the last one."""
    return raw.agg(F.count_distinct(stamp).alias("ingest_batches"), F.max(stamp).alias("last_ingest"))


def quality_rate(counts: DataFrame) -> DataFrame:
    """Structured rows per hundred raw rows, over all feeds of :func:`layer_counts`."""
    total = counts.agg(_layer_rows("raw").alias("raw_rows"), _layer_rows("structured").alias("structured_rows"))
    return total.withColumn("quality_rate", _percent("structured_rows", "raw_rows"))


# -- quality -------------------------------------------------------------


def rejection_rates(counts: DataFrame) -> DataFrame:
    """Rejected rows per hundred valid and rejected rows, for each feed of :func:`layer_counts`."""
    return (
        counts.groupBy("feed")
        .agg(_layer_rows("structured").alias("valid_rows"), _layer_rows("rejected").alias("rejected_rows"))
        .withColumn("total_rows", F.col("valid_rows") + F.col("rejected_rows"))
        .withColumn("rejection_rate", _percent("rejected_rows", "total_rows"))
        .drop("total_rows")
    )


def reason_histogram(rejects: Mapping[str, DataFrame]) -> DataFrame:
    """Rejected rows per feed and reason, most frequent first."""
    counted = [
        frame.filter(F.col("rejection_reason").isNotNull())
        .groupBy("rejection_reason")
        .agg(F.count("*").alias("rows"))
        .select(F.lit(feed).alias("feed"), "rejection_reason", "rows")
        for feed, frame in rejects.items()
    ]
    return _union(counted).orderBy("feed", F.desc("rows"), "rejection_reason")


# -- business ------------------------------------------------------------


def entity_counts(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct orders, customers and products, one row each."""
    keys = [("orders", orders, "order_id"), ("customers", customers, "customer_id"), ("products", products, "product_id")]
    return _union(
        [
            frame.agg(F.count_distinct(key).alias("entities")).select(F.lit(name).alias("entity"), "entities")
            for name, frame, key in keys
        ]
    )


def total_sales(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Sum of quantity times price over all orders, and the orders that have no amount (:func:`line_amount`).

    Quantities are summed per product before the join: every product then has
    one row, however many orders it has.
    """
    sold = orders.groupBy("product_id").agg(F.sum("quantity").alias("quantity"), F.count("*").alias("orders"))
    priced = sold.join(products.select("product_id", "price"), "product_id", "left")
    amounts = priced.select(line_amount("quantity", "price").alias("amount"), "orders")
    unpriced = F.coalesce(F.sum(F.when(F.col("amount").isNull(), F.col("orders"))), F.lit(0))
    return amounts.agg(_sum_money("amount").alias("total_sales"), unpriced.alias("unpriced_orders"))


def sales_by_country(
    orders: DataFrame, customers: DataFrame, products: DataFrame, guard: SkewGuard | None = None
) -> DataFrame:
    """Sales per country code, including NULL for orders without a known country.

    Prices join to single orders, where a best-seller may be hot: that join is
    broadcast, or its hot keys are split (:func:`lookup_join`; the identity of
    the rows, ``order_id`` if they carry no other, tells them apart). Amounts are then summed per customer, so that the join
    to customers again meets each key once.
    """
    identity = ROW_ID if ROW_ID in orders.columns else "order_id"
    lines = orders.select(identity, "customer_id", "product_id", "quantity")
    priced = lookup_join(lines, products.select("product_id", "price"), "product_id", [identity], guard)
    per_customer = (
        priced.select("customer_id", line_amount("quantity", "price").alias("amount"))
        .groupBy("customer_id")
        .agg(F.try_sum("amount").alias("amount"))
    )
    located = per_customer.join(customers.select("customer_id", "country_code"), "customer_id", "left")
    return located.groupBy("country_code").agg(_sum_money("amount").alias("sales"))


def sales_over_countries(country_sales: DataFrame) -> DataFrame:
    """Total sales from the sums of :func:`sales_by_country`."""
    return country_sales.agg(_sum_money("sales").alias("total_sales"))


def top_countries(country_sales: DataFrame, countries: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` countries with most sales, named; an unknown code has a NULL name."""
    known = country_sales.filter(F.col("country_code").isNotNull())
    named = lookup_join(known, countries, "country_code", ["country_code"])
    return named.orderBy(F.desc_nulls_last("sales"), "country_code").limit(n)


def customers_by_department(customers: DataFrame, departments: DataFrame) -> DataFrame:
    """Customers per department, named, most first."""
    counted = (
        customers.filter(F.col("department_code").isNotNull())
        .groupBy("department_code")
        .agg(F.count("*").alias("customers"))
    )
    return departments_named(counted, departments)


def departments_named(counted: DataFrame, departments: DataFrame) -> DataFrame:
    """Customers per department code as :func:`customers_by_department` reports them."""
    named = lookup_join(counted, departments, "department_code", ["department_code"])
    return named.orderBy(F.desc("customers"), "department_code")


def sales_by_region(country_sales: DataFrame, regions: Mapping[str, str] | None = None) -> DataFrame:
    """Sales per region, most first; countries without a region are left out."""
    region = map_value("country_code", REGION_OF_COUNTRY if regions is None else regions)
    return (
        country_sales.withColumn("region", region)
        .filter(F.col("region").isNotNull())
        .groupBy("region")
        .agg(_sum_money("sales").alias("sales"))
        .orderBy(F.desc_nulls_last("sales"), "region")
    )

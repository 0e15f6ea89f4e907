"""Sums of the business reports, kept with a lake and corrected by what later versions change.

Sales per country are a sum over orders, their products' prices and their
customers' countries. What changes it between two versions of the three tables:

- orders in segments that one of the versions has and the other has not;
- orders in common segments whose product has another price, or whose customer
  another country, than before; without such products or customers the common
  segments are not read at all.

Those orders are summed as they were, at old prices and countries, and as they
are, and the difference is added to what was kept. Rows that a version only
copied cancel out. Customers per department differ by the customers in segments
that are not common. Amounts are decimals, so corrected sums equal recounted ones.
Where no segment of orders is common, all that was kept per country would be
subtracted again; it is left out instead, and old orders, prices and countries
are not read.

Sums are a row per code, in a folder named by the versions they hold for and
complete once Spark has marked it so. They are counted anew where the older
versions are no longer there, where more rows changed than the tables have
(``most_changed``), and where an amount went beyond its type.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import storage
from sluice.functions.transforms import line_amount
from sluice.operators.skew import lookup_join
from sluice.plans.marts import MONEY
from sluice.sinks.catalog import TABLES
from sluice.sinks.snapshot import Snapshot, SnapshotTable
from sluice.sources.tables import read_path

COLUMNS = {
    "orders": ["order_id", "customer_id", "product_id", "quantity"],
    "customers": ["customer_id", "country_code", "department_code"],
    "products": ["product_id", "price"],
}
SUMS = "part string, code string, amount decimal(38,9), rows long, priced long, beyond boolean"
COUNTRY, DEPARTMENT = "country", "department"
# Folders of earlier sums that stay, for readers that still use them.
KEPT = 2


@dataclass(frozen=True)
class Versions:
    """A feed's table as it was when the sums were kept, and as it is; None where nothing was published yet."""

    name: str
    table: SnapshotTable
    old: Snapshot | None
    new: Snapshot | None

    def segments(self) -> tuple[set, set]:
        old, new = ({tuple(s) for s in snapshot.segments} if snapshot else set() for snapshot in (self.old, self.new))
        return old, new

    def rows(self, snapshot: Snapshot | None, segments: set) -> DataFrame:
        if snapshot is None or not segments:
            return self.table.spark.createDataFrame([], TABLES[f"structured.{self.name}"]).select(COLUMNS[self.name])
        return self.table.scan(snapshot, sorted(segments)).select(COLUMNS[self.name])

    def of_keys(self, snapshot: Snapshot | None, keys: DataFrame) -> DataFrame:
        """Rows of the buckets that ``keys`` fall into: at most as many numbers as the table has buckets."""
        if snapshot is None:
            return self.rows(None, set())
        keyed = self.rows(snapshot, set()).select(self.table.key).unionByName(keys)  # hashes depend on the key's type
        bucket = self.table.bucket_of_key(snapshot.n_buckets)
        touched = {row[0] for row in keyed.select(bucket.alias("bucket")).distinct().collect()}
        return self.rows(snapshot, {tuple(s) for s in snapshot.segments if s[1] in touched})

    def removed(self) -> DataFrame:
        old, new = self.segments()
        return self.rows(self.old, old - new)

    def added(self) -> DataFrame:
        old, new = self.segments()
        return self.rows(self.new, new - old)

    def whole(self) -> DataFrame:
        return self.rows(self.new, self.segments()[1])

    def common(self) -> DataFrame:
        old, new = self.segments()
        return self.rows(self.new, old & new)

    def changed_rows(self) -> int:
        old, new = self.segments()
        return self.table.count_rows(sorted(old ^ new))

    def changed_keys(self, value: str) -> DataFrame:
        """Keys that have another ``value`` than before, new ones among them."""
        key = self.table.key
        signed = [rows.select(key, value, F.lit(sign).alias("sign")) for rows, sign in ((self.added(), 1), (self.removed(), -1))]
        balance = signed[0].unionByName(signed[1]).groupBy(key, value).agg(F.sum("sign").alias("sign"))
        return balance.filter("sign <> 0").select(key).distinct()


def _country_sums(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """As :func:`marts.sales_by_country` joins and sums, unrounded and with the numbers of orders."""
    priced = lookup_join(orders, products, "product_id", ["order_id"])
    per_customer = (
        priced.select("customer_id", line_amount("quantity", "price").alias("amount"))
        .groupBy("customer_id")
        .agg(F.try_sum("amount").alias("amount"), F.count("*").alias("rows"), F.count("amount").alias("priced"))
        .withColumn("beyond", F.col("amount").isNull() & (F.col("priced") > 0))
    )
    located = per_customer.join(customers.select("customer_id", "country_code"), "customer_id", "left")
    return located.select(F.lit(COUNTRY).alias("part"), F.col("country_code").alias("code"), "amount", "rows", "priced", "beyond")


def _department_rows(customers: DataFrame) -> DataFrame:
    none = F.lit(None).cast("decimal(38,9)")
    counted = customers.groupBy("department_code").agg(F.count("*").alias("rows"))
    return counted.select(
        F.lit(DEPARTMENT).alias("part"), F.col("department_code").alias("code"), none.alias("amount"), "rows",
        F.lit(0).cast("long").alias("priced"), F.lit(False).alias("beyond"),
    )


def _summed(parts: list[tuple[DataFrame, int]]) -> DataFrame:
    """Signed sums per part and code; codes that have no rows left are gone."""
    signed = None
    for rows, sign in parts:
        rows = rows.withColumns({name: F.col(name) * F.lit(sign) for name in ("rows", "priced")})
        rows = rows.withColumn("amount", (F.col("amount") if sign > 0 else -F.col("amount")).cast("decimal(38,9)"))
        signed = rows if signed is None else signed.unionByName(rows)
    total = signed.groupBy("part", "code").agg(
        F.try_sum("amount").alias("amount"), F.sum("rows").alias("rows"), F.sum("priced").alias("priced"),
        F.max("beyond").alias("beyond"),
    )
    beyond = F.col("beyond") | (F.col("amount").isNull() & (F.col("priced") > 0))
    return total.filter(F.col("rows") != 0).withColumn("beyond", beyond)


def counted_sums(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """The sums of whole tables."""
    tables = {"orders": orders, "customers": customers, "products": products}
    orders, customers, products = (frame.select(COLUMNS[name]) for name, frame in tables.items())
    return _summed([(_country_sums(orders, customers, products), 1), (_department_rows(customers), 1)])


def _met(orders: DataFrame, changed: DataFrame, tag: str) -> DataFrame:
    key = changed.columns[0]
    met = lookup_join(orders, changed.withColumn(tag, F.lit(True)), key, ["order_id"])
    return met.withColumn(tag, F.coalesce(F.col(tag), F.lit(False)))


def corrected_sums(kept: DataFrame, orders: Versions, customers: Versions, products: Versions) -> DataFrame:
    """``kept``, which holds for the old versions, corrected to hold for the new ones."""
    departments = [(_department_rows(customers.added()), 1), (_department_rows(customers.removed()), -1)]
    if set.isdisjoint(*orders.segments()):
        sums = _country_sums(orders.whole(), customers.whole(), products.whole())
        return _summed([(kept.filter(F.col("part") != COUNTRY), 1), (sums, 1), *departments])
    removed, added = orders.removed(), orders.added()
    moved = {
        tag: (table, value)
        for tag, table, value in (("_priced", products, "price"), ("_moved", customers, "country_code"))
        if len(set(map(frozenset, table.segments()))) > 1
    }
    if moved:
        touched = orders.common()
        for tag, (table, value) in moved.items():
            touched = _met(touched, table.changed_keys(value), tag)
        touched = touched.filter(" or ".join(moved)).select(COLUMNS["orders"])
        # Written once: it is summed twice, and its keys are looked up.
        path = storage.scratch_path(orders.table.spark, "touched-orders")
        touched.write.parquet(path)
        touched = read_path(orders.table.spark, path)
        removed, added = removed.unionByName(touched), added.unionByName(touched)
    parts = [(kept, 1)]
    for rows, sign, at in ((added, 1, "new"), (removed, -1, "old")):
        priced_by = products.of_keys(getattr(products, at), rows.select("product_id"))
        placed_by = customers.of_keys(getattr(customers, at), rows.select("customer_id"))
        parts.append((_country_sums(rows, placed_by, priced_by), sign))
    return _summed([*parts, *departments])


def _folder(lake_root: str) -> str:
    return f"{lake_root}/sums"


def _name(snapshots: list[Snapshot | None]) -> str:
    return "-".join(["v", *(str(snapshot.version if snapshot else 0) for snapshot in snapshots)])


def _earlier(spark: SparkSession, lake_root: str) -> list[list[int]]:
    """Versions of the sums there are, oldest first; a folder that was not written to its end is none."""
    names = [name for name in storage.child_names(spark, _folder(lake_root)) if name.startswith("v-")]
    whole = [name for name in names if storage.exists(spark, f"{_folder(lake_root)}/{name}/_SUCCESS")]
    return sorted([int(part) for part in name.split("-")[1:]] for name in whole)


def current_sums(spark: SparkSession, lake_root: str, tables: dict[str, SnapshotTable], most_changed: float = 1.0) -> DataFrame | None:
    """Sums for the current versions, from the newest kept ones if that is less work; None if there is no such base."""
    now = {name: tables[name].current() for name in COLUMNS}
    found = [
        versions for versions in _earlier(spark, lake_root)
        if all(version <= (snapshot.version if snapshot else 0) for version, snapshot in zip(versions, now.values()))
    ]
    if not found:
        return None
    then = {name: tables[name].at(version) if version else None for name, version in zip(COLUMNS, found[-1])}
    if any(version and then[name] is None for name, version in zip(COLUMNS, found[-1])):
        return None  # that version was removed
    kept = spark.read.schema(SUMS).parquet(f"{_folder(lake_root)}/{_name(list(then.values()))}")
    pairs = {name: Versions(name, tables[name], then[name], now[name]) for name in COLUMNS}
    if all(pair.segments()[0] == pair.segments()[1] for pair in pairs.values()):
        return kept
    if most_changed < math.inf:
        if sum(pair.changed_rows() for pair in pairs.values()) > most_changed * sum(s.rows or 0 for s in now.values() if s):
            return None
    return corrected_sums(kept, **pairs)


def refresh_sums(spark: SparkSession, lake_root: str, tables: dict[str, SnapshotTable], most_changed: float = 1.0) -> DataFrame:
    """Keep the sums for the current versions, and return them. For the lake's single writer, between its runs."""
    now = [tables[name].current() for name in COLUMNS]
    path = f"{_folder(lake_root)}/{_name(now)}"
    if not storage.exists(spark, f"{path}/_SUCCESS"):
        sums = current_sums(spark, lake_root, tables, most_changed)
        if sums is None:
            sums = counted_sums(*[Versions(name, tables[name], None, at).added() for name, at in zip(COLUMNS, now)])
        sums.coalesce(1).write.mode("overwrite").parquet(path)  # a row per code
        for versions in _earlier(spark, lake_root)[:-KEPT]:
            storage.delete(spark, f"{_folder(lake_root)}/{'-'.join(['v', *map(str, versions)])}")
    return spark.read.schema(SUMS).parquet(path)


def country_sales(sums: DataFrame) -> DataFrame | None:
    """Sales as :func:`marts.sales_by_country` gives them; None if an amount went beyond its type."""
    if sums.filter("beyond").limit(1).count():
        return None
    sales = F.when(F.col("priced") == 0, 0).otherwise(F.col("amount")).try_cast(MONEY)
    return sums.filter(F.col("part") == COUNTRY).select(F.col("code").alias("country_code"), sales.alias("sales"))


def department_customers(sums: DataFrame) -> DataFrame:
    """Customers per department code, none for customers without one."""
    known = sums.filter((F.col("part") == DEPARTMENT) & F.col("code").isNotNull())
    return known.select(F.col("code").alias("department_code"), F.col("rows").alias("customers"))

"""All reports of a lake folder, as written by :func:`sluice.plans.runs.run_all`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice import storage
from sluice.plans import kept_sums, marts
from sluice.plans.feeds import FEEDS
from sluice.plans.routing import REASONS
from sluice.plans.runs import structured_table, structured_tables
from sluice.schemas import quarantine_schema, raw_schema
from sluice.sinks.catalog import TABLES
from sluice.sinks.landing import not_seen, read_landed
from sluice.sources.tables import read_path


Layers = dict[str, dict[str, DataFrame]]


def ingestion_reports(layers: Layers, counts: DataFrame) -> dict[str, DataFrame]:
    return {
        "layer_counts": counts,
        "quality_rate": marts.quality_rate(counts),
        "ingest_batches": marts.ingest_batches(layers["customers"]["raw"]),
    }


def quality_reports(layers: Layers, counts: DataFrame) -> dict[str, DataFrame]:
    rejects = {feed: frames["rejected"] for feed, frames in layers.items()}
    return {"rejection_rates": marts.rejection_rates(counts), "reason_histogram": marts.reason_histogram(rejects)}


def business_reports(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    countries: DataFrame,
    departments: DataFrame,
    sums: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Sales and customer figures; orders are joined and summed once for all sales reports.

    The sums per country, a row per code, are written to the scratch folder for
    the reports that share them. With ``sums`` (:mod:`sluice.plans.kept_sums`)
    no table is read for them.
    """
    country_sales = kept_sums.country_sales(sums) if sums is not None else None
    if country_sales is None:
        path = storage.scratch_path(orders.sparkSession, "country-sales")
        marts.sales_by_country(orders, customers, products).write.parquet(path)
        country_sales = read_path(orders.sparkSession, path)
    if sums is None:
        by_department = marts.customers_by_department(customers, departments)
    else:
        by_department = marts.departments_named(kept_sums.department_customers(sums), departments)
    return {
        "entity_counts": marts.entity_counts(orders, customers, products),
        "total_sales": marts.sales_over_countries(country_sales),
        "top_countries": marts.top_countries(country_sales, countries),
        "customers_by_department": by_department,
        "sales_by_region": marts.sales_by_region(country_sales),
    }


def lake_layers(spark: SparkSession, lake_root: str) -> Layers:
    """Raw, structured and rejected rows of each feed; a layer that does not exist yet has no rows."""
    layers = {}
    for name, feed in FEEDS.items():
        target = structured_table(spark, feed, f"{lake_root}/structured/{name}")
        there = target.current() is not None
        rejects = target.read_rejects() if there else None
        structured = TABLES[f"structured.{name}"]
        layers[name] = {
            "raw": read_landed(spark, f"{lake_root}/raw/{name}", raw_schema(feed.schema)),
            "structured": target.read() if there else spark.createDataFrame([], structured),
            "rejected": rejects if rejects is not None else spark.createDataFrame([], quarantine_schema(feed.schema)),
        }
    return layers


def kept_totals(spark: SparkSession, lake_root: str) -> dict[str, dict[str, int]] | None:
    """Rows of each feed by layer and by rejection reason, from what its versions keep; None if one does not.

    No layer is read but the landings that no run has taken yet, whose rows the
    raw layer has beyond those counted.
    """
    totals = {}
    for name, feed in FEEDS.items():
        snapshot = structured_table(spark, feed, f"{lake_root}/structured/{name}").current()
        state = snapshot.state if snapshot else {"totals": {}, "landings": {}}
        if state.get("totals") is None or "landings" not in state or (snapshot and snapshot.rows is None):
            return None
        raw = read_landed(spark, f"{lake_root}/raw/{name}", raw_schema(feed.schema))
        reasons = {reason: state["totals"].get(outcome, 0) for outcome, reason in REASONS.items()}
        totals[name] = {
            "raw": state["totals"].get("rows", 0) + raw.filter(not_seen(state["landings"])).count(),
            "structured": snapshot.rows if snapshot else 0,
            "rejected": sum(reasons.values()),
            **{reason: rows for reason, rows in reasons.items() if rows},
        }
    return totals


def _kept_reports(spark: SparkSession, totals: dict[str, dict[str, int]]) -> tuple[DataFrame, DataFrame]:
    """Layer counts and reason histogram from kept totals: three rows a feed each, at most."""
    layers = ("raw", "structured", "rejected")
    counts = [(feed, layer, rows[layer]) for feed, rows in totals.items() for layer in layers]
    reasons = [(feed, name, n) for feed, rows in totals.items() for name, n in rows.items() if name not in layers]
    reasons.sort(key=lambda row: (row[0], -row[2], row[1]))
    schema = "feed string, {} string, rows long"
    return spark.createDataFrame(counts, schema.format("layer")), spark.createDataFrame(reasons, schema.format("rejection_reason"))


def _sums(spark: SparkSession, lake_root: str) -> DataFrame | None:
    """The lake's sums for its current versions, written for the reports that share them; None where they are counted anew."""
    sums = kept_sums.current_sums(spark, lake_root, structured_tables(spark, lake_root))
    if sums is None:
        return None
    path = storage.scratch_path(spark, "sums")
    sums.coalesce(1).write.parquet(path)  # a row per code
    return read_path(spark, path)


def lake_reports(
    spark: SparkSession, lake_root: str, countries: DataFrame, departments: DataFrame, recount: bool = False
) -> dict[str, DataFrame]:
    """Every report, by name.

    Rows of layers and reasons are those kept with the versions, and sales and
    customers those of the lake's sums, corrected here by what was published after
    them. With ``recount``, or where a version keeps none, the layers are read:
    counted once, and the counts written for all reports.
    """
    layers = lake_layers(spark, lake_root)
    totals = None if recount else kept_totals(spark, lake_root)
    if totals is not None:
        counts, reasons = _kept_reports(spark, totals)
    else:
        path = storage.scratch_path(spark, "layer-counts")
        marts.layer_counts(layers).write.parquet(path)
        counts, reasons = read_path(spark, path), None
    tables = [layers[name]["structured"] for name in ("orders", "customers", "products")]
    reports = ingestion_reports(layers, counts) | quality_reports(layers, counts)
    sums = None if recount else _sums(spark, lake_root)
    reports |= business_reports(*tables, countries, departments, sums)
    if reasons is not None:
        reports["reason_histogram"] = reasons
    if totals is not None:  # keys of structured rows are unique and never NULL: rows are entities
        entities = [(name, totals[name]["structured"]) for name in ("orders", "customers", "products")]
        reports["entity_counts"] = spark.createDataFrame(entities, "entity string, entities long")
    return reports

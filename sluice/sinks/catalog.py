"""Databases and tables of the medallion layers."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from sluice import schemas
from sluice.sinks.landing import LANDING

TABLES: dict[str, StructType] = {
    "raw.customers": schemas.raw_schema(schemas.CUSTOMERS_FEED),
    "raw.orders": schemas.raw_schema(schemas.ORDERS_FEED),
    "raw.products": schemas.raw_schema(schemas.PRODUCTS_FEED),
    "structured.customers": schemas.STRUCTURED_CUSTOMERS,
    "structured.orders": schemas.STRUCTURED_ORDERS,
    "structured.products": schemas.STRUCTURED_PRODUCTS,
    "structured.customers_rejected": schemas.quarantine_schema(schemas.CUSTOMERS_FEED),
    "structured.orders_rejected": schemas.quarantine_schema(schemas.ORDERS_FEED),
    "structured.products_rejected": schemas.quarantine_schema(schemas.PRODUCTS_FEED),
}


def _columns_ddl(schema: StructType) -> str:
    return ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}{'' if field.nullable else ' NOT NULL'}"
        for field in schema.fields
    )


def set_up_tables(
    spark: SparkSession,
    location: str | None = None,
    prefix: str = "",
    table_format: str = "parquet",
) -> list[str]:
    """Create what is missing and return all table names.

    ``location`` keeps the databases below one folder; ``prefix`` is put before
    the database names. Raw tables are partitioned by landing.
    """
    for database in sorted({name.split(".")[0] for name in TABLES}):
        where = f" LOCATION '{location}/{database}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{database}{where}")
    names = []
    for name, schema in TABLES.items():
        landed = f", `{LANDING}` STRING" if name.startswith("raw.") else ""
        parts = f" PARTITIONED BY ({LANDING})" if landed else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({_columns_ddl(schema)}{landed}) USING {table_format}{parts}"
        )
        names.append(f"{prefix}{name}")
    return names

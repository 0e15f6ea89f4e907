"""Counts and bounds of parquet tables from their footers.

Every parquet file says at its end how many rows it has and, for each column,
the least and the largest value. Aggregates over a whole table, or over its
partitions, need nothing else: the scan hands on one row a file, and no column
is read.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

PUSHDOWN = "spark.sql.parquet.aggregatePushdown"


def _totals(spark: SparkSession, paths: list[str], bounds: list[str], by: list[str], base_path: str | None, pushed: bool) -> DataFrame:
    # A session of its own: its settings are no one else's, also while other threads plan queries.
    own = spark.newSession()
    own.conf.set(PUSHDOWN, str(pushed).lower())
    if pushed:
        own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    reader = own.read if base_path is None else own.read.option("basePath", base_path)
    found = [F.count("*").alias("rows")]
    found += [f(F.col(name)).alias(f"{end}_{name}") for name in bounds for f, end in ((F.min, "min"), (F.max, "max"))]
    return reader.parquet(*paths).groupBy(*by).agg(*found)


def footer_totals(
    spark: SparkSession, paths: list[str], bounds: list[str] | None = None, by: list[str] | None = None, base_path: str | None = None
) -> list[Row]:
    """Rows of the table in ``paths``, as ``rows``, and ``min_<c>`` and ``max_<c>`` of the columns in ``bounds``.

    ``by`` names partition columns, of which each combination gives a row:
    their number is what reaches the driver, as when the table is listed.
    Footers have no bounds that can be relied on for strings and timestamps, nor
    of columns that are NULL throughout a row group; with such bounds the columns
    are scanned. A table without files has no rows; it needs a folder that says its columns.
    """
    bounds, by = bounds or [], by or []
    try:
        found = _totals(spark, paths, bounds, by, base_path, pushed=True).collect()
    except PySparkException:
        found = _totals(spark, paths, bounds, by, base_path, pushed=False).collect()
    # Of a table without row groups the pushed count is a sum over nothing.
    return [Row(**(row.asDict() | {"rows": row["rows"] or 0})) for row in found]


def footer_count(spark: SparkSession, paths: list[str], base_path: str | None = None) -> int:
    """Rows of the files in ``paths``; ``base_path`` is the table's folder if they are partitions of one."""
    return footer_totals(spark, paths, base_path=base_path)[0]["rows"] if paths else 0

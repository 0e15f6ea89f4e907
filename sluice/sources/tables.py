"""Table scans: by name or path, filtered, pruned, incremental, with row identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.storage import ensure_checkpoint_dir

ROW_ID = "_row_id"


def read_path(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.format(file_format).load(path)


def select_where(df: DataFrame, columns: list[str] | None = None, condition: str | Column | None = None) -> DataFrame:
    """Filter first, project second, so the filter may use columns not kept."""
    if condition is not None:
        df = df.filter(condition)
    return df.select(*columns) if columns else df


def read_table(
    spark: SparkSession,
    table_name: str,
    columns: list[str] | None = None,
    filter_condition: str | Column | None = None,
) -> DataFrame:
    return select_where(spark.table(table_name), columns, filter_condition)


def rows_after(df: DataFrame, watermark_column: str, last_value=None) -> DataFrame:
    """Rows strictly above a bound; all rows without one.

    The bound is a typed literal cast to the column's type, so the comparison
    reaches the scan as a pushed filter.
    """
    if last_value is None:
        return df
    bound_type = df.schema[watermark_column].dataType
    return df.filter(F.col(watermark_column) > F.lit(last_value).cast(bound_type))


def read_table_incremental(
    spark: SparkSession,
    table_name: str,
    watermark_column: str,
    last_watermark_value=None,
    columns: list[str] | None = None,
) -> DataFrame:
    return select_where(rows_after(spark.table(table_name), watermark_column, last_watermark_value), columns)


def preview(spark: SparkSession, query: str, rows: int = 20) -> DataFrame:
    """First rows of a SQL query, for a look at a table after a load."""
    return spark.sql(query).limit(rows)


def with_file_row_id(scan: DataFrame) -> DataFrame:
    """Name each row of a parquet scan by its file and its position in it.

    Published files never change, so the name survives retries and re-reads.
    """
    position = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("position")
    )
    return scan.select("*", position.alias(ROW_ID))


def with_row_id(df: DataFrame) -> DataFrame:
    """Name each row of any frame, at the price of writing it out once.

    The checkpoint pins the rows and their order; numbering without it could
    give a row another number when a lost task is run again.
    """
    if ROW_ID in df.columns:
        return df
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint().withColumn(ROW_ID, F.monotonically_increasing_id())

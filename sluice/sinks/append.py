"""Append sinks on catalog tables, and upsert where the table format can merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice import storage
from sluice.operators.upsert import merge_rows, require_unique_keys
from sluice.sinks.evolution import conformed, widened
from sluice.sinks.merge import merge_partitions


def widen_table(spark: SparkSession, table_name: str, schema: StructType) -> None:
    """Add a schema's new columns to the table; old rows read NULL there. Changed types are refused."""
    known = spark.table(table_name).schema
    new = widened(known, schema, f"rows for {table_name}", complete=False).fields[len(known.fields) :]
    if new:
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in new)
        spark.sql(f"ALTER TABLE {table_name} ADD COLUMNS ({columns})")
        spark.catalog.refreshTable(table_name)


def _conform(spark: SparkSession, table_name: str, df: DataFrame) -> DataFrame:
    return conformed(df, spark.table(table_name).schema)


def write_append(df: DataFrame, table_name: str, partition_columns: list[str] | None = None) -> None:
    """Append by column name, creating or widening the table as needed."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table_name):
        widen_table(spark, table_name, df.schema)
        _conform(spark, table_name, df).write.insertInto(table_name)  # into the table's own partitions
        return
    writer = df.write.mode("append")
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    writer.format("parquet").saveAsTable(table_name)


def write_replace(df: DataFrame, table_name: str) -> None:
    """Replace all rows of an existing table; the frame must not read from it."""
    spark = df.sparkSession
    widen_table(spark, table_name, df.schema)
    _conform(spark, table_name, df).write.insertInto(table_name, overwrite=True)


def rejected(df: DataFrame, rejection_reason: str) -> DataFrame:
    return df.withColumns({"rejection_reason": F.lit(rejection_reason), "rejected_at": F.current_timestamp()})


def write_rejected_records(df: DataFrame, table_name: str, rejection_reason: str) -> None:
    """Append rows to a quarantine table; no rows make no difference."""
    write_append(rejected(df, rejection_reason), table_name)


def write_merge(df: DataFrame, table_name: str, key: str, check_keys: bool = True, keys_stay: bool = False) -> None:
    """Upsert into a catalog table; its single writer is the caller.

    A partitioned parquet table is rewritten in the partitions that hold a key of
    the source or receive a row of it, no others (:mod:`sluice.sinks.merge`);
    ``keys_stay`` promises that no key ever changes its partition, so that stored
    keys need not be looked up. Partitions are switched one after the other. An
    unpartitioned one is written anew beside the old files, and then the table is
    pointed there: no file in use is overwritten, and readers see the old or the
    new rows. The version before stays for readers, older ones are deleted. For
    large tables without partitions use :mod:`sluice.sinks.bucketed`, whose merge
    moves only the source, or :class:`sluice.sinks.snapshot.SnapshotTable`, which
    rewrites only the buckets a batch touches.

    A table format with row-level operations merges in place by ``MERGE``. No
    such format is installed where this was built: that branch has never run.
    """
    spark = df.sparkSession
    if check_keys:
        require_unique_keys(df, key)
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}").collect()}
    if details.get("Provider", "").lower() != "parquet":
        merge = df.alias("source").mergeInto(table_name, F.expr(f"{table_name}.`{key}` = source.`{key}`"))
        merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()
        return
    widen_table(spark, table_name, df.schema)
    target, source = spark.table(table_name), _conform(spark, table_name, df)
    partitions = [column.name for column in spark.catalog.listColumns(table_name) if column.isPartition]
    old = details["Location"].rstrip("/")
    if partitions:
        merge_partitions(target, table_name, old, source, key, partitions, keys_stay)
        return
    base, _, version = old.rpartition("/v=")
    version = int(version) + 1 if base else 1
    new = f"{base or f'{old}.versions'}/v={version}"
    merge_rows(target, source, key).write.mode("overwrite").parquet(new)
    spark.sql(f"ALTER TABLE {table_name} SET LOCATION '{new}'")
    spark.catalog.refreshTable(table_name)
    if version > 2:
        storage.delete(spark, f"{base}/v={version - 2}")

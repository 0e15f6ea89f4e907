"""Upsert into a parquet table of the catalog that is bucketed by its key.

The stored rows lie in the buckets of a shuffle by key. A merge joins them with
the source where they are: only the source is shuffled, into as many partitions
as there are buckets, and each task writes one bucket anew, as one sorted file.
The table is then pointed at the new files; those before stay for readers, older
ones are deleted. The single writer is the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import storage
from sluice.operators.upsert import require_unique_keys
from sluice.sinks.evolution import conformed, widened

_NEW = "_is_new"


def create_bucketed(df: DataFrame, table_name: str, key: str, n_buckets: int) -> None:
    """A table of ``df``'s rows, whose keys are unique, in sorted buckets of a file each."""
    placed = df.repartition(n_buckets, key)
    placed.write.format("parquet").bucketBy(n_buckets, key).sortBy(key).saveAsTable(table_name)


def _details(spark: SparkSession, table_name: str) -> dict[str, str]:
    return {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}").collect()}


def merged_in_buckets(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows with source rows of the same key in their place, and the source's other rows.

    Both sides meet in one full join, so that rows stay in the target's buckets;
    an anti join and a union would lose them.
    """
    old, new = target.alias("old"), source.withColumn(_NEW, F.lit(True)).alias("new")
    joined = old.join(new, key, "full_outer")
    return joined.select(
        *(
            F.col(f"`{name}`")
            if name == key
            else F.when(F.col(_NEW), F.col(f"new.`{name}`")).otherwise(F.col(f"old.`{name}`")).alias(name)
            for name in target.columns
        )
    )


def merge_bucketed(df: DataFrame, table_name: str, key: str, check_keys: bool = True) -> None:
    """Upsert ``df`` by ``key``; new columns are added, and a type that changed is refused."""
    spark = df.sparkSession
    if check_keys:
        require_unique_keys(df, key)
    details = _details(spark, table_name)
    if details.get("Bucket Columns") != f"[`{key}`]":
        raise ValueError(f"{table_name} is not bucketed by {key}")
    n_buckets, old = int(details["Num Buckets"]), details["Location"].rstrip("/")
    known = spark.table(table_name).schema
    wider = widened(known, df.schema, f"rows for {table_name}", complete=False)
    added = wider.fields[len(known.fields) :]
    if added:
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in added)
        spark.sql(f"ALTER TABLE {table_name} ADD COLUMNS ({columns})")
        spark.catalog.refreshTable(table_name)
    merged = merged_in_buckets(spark.table(table_name), conformed(df, wider), key)

    base, _, version = old.rpartition("/v=")
    version = int(version) + 1 if base else 1
    base = base or f"{old}.versions"
    new, draft = f"{base}/v={version}", f"{table_name}__draft"
    spark.sql(f"DROP TABLE IF EXISTS {draft}")  # of an attempt that failed; its files are overwritten
    storage.delete(spark, new)
    merged.write.format("parquet").bucketBy(n_buckets, key).sortBy(key).option("path", new).saveAsTable(draft)
    spark.sql(f"ALTER TABLE {table_name} SET LOCATION '{new}'")
    spark.catalog.refreshTable(table_name)
    spark.sql(f"DROP TABLE {draft}")  # its files are not the draft's own, so they stay
    if version > 2:
        storage.delete(spark, f"{base}/v={version - 2}")

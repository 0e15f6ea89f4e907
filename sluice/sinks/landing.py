"""Landed batches: append-only raw tables whose partitions say which batch a row came with.

Every micro-batch lands in a partition of its own, named by the stream's
identity and the batch number (``LANDING``). A batch that is repeated after a
failure replaces its partition, so rows arrive exactly once. What a reader has
seen is the last batch of each stream: no clock is involved, so a row with an
early or missing stamp is as new as its batch. A stream that starts over with
another checkpoint has another identity and hides nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice import storage
from sluice.sinks.append import widen_table
from sluice.sinks.evolution import conformed, widened
from sluice.sources.tables import with_file_row_id

LANDING = "_landing"


def landing_name(stream_id: str, batch_id: int) -> str:
    return f"{stream_id}.{batch_id:012d}"


def stream_id(spark: SparkSession, checkpoint_path: str) -> str:
    """The identity of the query that owns a checkpoint folder."""
    return json.loads(storage.read_text(spark, f"{checkpoint_path.rstrip('/')}/metadata"))["id"]


# -- folders -----------------------------------------------------------------


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema of a raw folder, which only grows; without the landing column."""
    names = storage.child_names(spark, f"{path}/_schema")
    return StructType.fromJson(json.loads(storage.read_text(spark, f"{path}/_schema/{names[-1]}"))) if names else None


def widen_folder(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """Store the folder's schema, with new columns added and changed types refused."""
    known = stored_schema(spark, path)
    wider = widened(known, schema, f"rows for {path}", complete=False)
    if wider != known:
        number = len(storage.child_names(spark, f"{path}/_schema"))
        storage.publish_text(spark, f"{path}/_schema/{number:08d}", json.dumps(wider.jsonValue()))
    return wider


def land_in_folder(batch: DataFrame, path: str, landing: str) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/{LANDING}={landing}")


def read_landed(spark: SparkSession, path: str, declared: StructType | None = None) -> DataFrame:
    """A raw folder with row identities; empty, with the declared columns, if nothing has landed yet."""
    schema = stored_schema(spark, path) or declared
    if schema is None:
        raise FileNotFoundError(f"nothing has landed at {path}")
    whole = StructType([*schema.fields, StructField(LANDING, StringType())])
    if not any(name.startswith(f"{LANDING}=") for name in storage.child_names(spark, path)):
        return spark.createDataFrame([], whole)
    return with_file_row_id(spark.read.schema(whole).parquet(path))


# -- catalog tables ------------------------------------------------------------


def land_in_table(batch: DataFrame, table_name: str, landing: str) -> None:
    """Replace one landing of a table partitioned by it.

    A table without that partition takes the rows as they are; there a batch
    that is repeated after a failure comes twice.
    """
    spark = batch.sparkSession
    schema = spark.table(table_name).schema
    if not any(c.isPartition and c.name == LANDING for c in spark.catalog.listColumns(table_name)):
        conformed(batch, schema).write.insertInto(table_name)
        return
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}").collect()}
    folder = f"{details['Location'].rstrip('/')}/{LANDING}={landing}"
    own = StructType([field for field in schema.fields if field.name != LANDING])
    conformed(batch, own).write.mode("overwrite").parquet(folder)
    spark.sql(f"ALTER TABLE {table_name} ADD IF NOT EXISTS PARTITION ({LANDING} = '{landing}') LOCATION '{folder}'")
    spark.catalog.refreshTable(table_name)


def create_landing_table(spark: SparkSession, table_name: str, schema: StructType) -> None:
    if spark.catalog.tableExists(table_name):
        widen_table(spark, table_name, schema)
        return
    whole = StructType([*schema.fields, StructField(LANDING, StringType())])
    empty = spark.createDataFrame([], whole)
    empty.write.format("parquet").partitionBy(LANDING).saveAsTable(table_name)


# -- what is new ---------------------------------------------------------------


def not_seen(seen: dict[str, int]) -> Column:
    """Rows of landings after the last one seen of their stream; decided on partition names alone."""
    old = F.lit(False)
    for stream, batch in sorted(seen.items()):
        old |= (F.col(LANDING) >= landing_name(stream, 0)) & (F.col(LANDING) <= landing_name(stream, batch))
    return ~F.coalesce(old, F.lit(False))


def last_landings(rows: DataFrame, seen: dict[str, int], complete: bool = True) -> dict[str, int]:
    """The last landing of every stream, new ones added to ``seen``; a row per new batch reaches the driver.

    Rows without a landing cannot be told apart later, so they are refused if
    the answer is to be ``complete``.
    """
    found = dict(seen)
    for (landing,) in rows.select(LANDING).distinct().collect():
        if landing is None:
            if complete:
                raise ValueError("rows without a landing; run in full mode")
            continue
        stream, _, batch = landing.rpartition(".")
        found[stream] = max(found.get(stream, -1), int(batch))
    return found

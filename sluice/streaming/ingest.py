"""Incremental ingestion of feeds with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.dedup import keep_first
from sluice.schemas import INSERTED_AT
from sluice.sinks.landing import (
    create_landing_table,
    land_in_folder,
    land_in_table,
    landing_name,
    stream_id,
    widen_folder,
)
from sluice.sinks.snapshot import SnapshotTable
from sluice.sources.csv import read_feed_stream
from sluice.storage import delete, scratch_path


def stamp(stream: DataFrame) -> DataFrame:
    """Add the insertion time; all rows of a micro-batch get the same one."""
    return stream.withColumn(INSERTED_AT, F.current_timestamp())


def append_stream(
    stream: DataFrame, checkpoint_path: str, *, table: str | None = None, path: str | None = None
) -> None:
    """Process all input not seen yet, append it to a table or folder, and stop.

    The checkpoint folder remembers which input is done, so a rerun takes up
    new files only and a failed run continues where it stopped. Every batch
    lands in a partition of its own (:mod:`sluice.sinks.landing`), which a
    repeated batch replaces. A table or folder that lacks columns of the stream
    is widened first; a column that changed its type is refused.
    """
    spark = stream.sparkSession
    if table:
        create_landing_table(spark, table, stream.schema)
    else:
        widen_folder(spark, path, stream.schema)

    def land(batch: DataFrame, batch_id: int) -> None:
        landing = landing_name(stream_id(spark, checkpoint_path), batch_id)
        if table:
            land_in_table(batch, table, landing)
        else:
            land_in_folder(batch, path, landing)

    _drain(stream, land, checkpoint_path)


def _drain(stream: DataFrame, apply, checkpoint_path: str) -> None:
    (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def ingest_feed(
    spark: SparkSession,
    feed,
    source_path: str,
    checkpoint_path: str,
    *,
    table: str | None = None,
    path: str | None = None,
    **source_options,
) -> None:
    """Land a feed's new CSV files, stamped, in its raw table or folder.

    ``source_options`` are those of :func:`sluice.sources.csv.read_feed_stream`.
    """
    stream = read_feed_stream(spark, source_path, feed.schema, **source_options)
    append_stream(stamp(stream), checkpoint_path, table=table, path=path)


def upsert_stream(
    stream: DataFrame, target: SnapshotTable, order: list[Column], checkpoint_path: str
) -> None:
    """Upsert all input not seen yet: the table holds, of all rows ever streamed, the first of each key by ``order``.

    A batch's rows are compared with the stored ones of their keys, so a late
    row replaces nothing that comes before it in ``order``, whichever batch or
    stream brought it. Of the stored rows only the segments that hold a key of
    the batch are read whole, and of other segments of their buckets the key
    column. Batch numbers are published with the rows, per stream: a batch that
    is replayed after a failure finds its number there and is skipped. A NULL key
    is refused. The winners of a batch are written to the scratch folder, since
    the table reads them more than once.
    """
    spark = stream.sparkSession

    def apply(batch: DataFrame, batch_id: int) -> None:
        name = stream_id(spark, checkpoint_path)
        snapshot = target.current()
        done = snapshot.state.get("stream_batches", {}) if snapshot is not None else {}
        if done.get(name, -1) >= batch_id:
            return
        stage = scratch_path(spark, "winners")
        try:
            keep_first(batch, [target.key], order).write.parquet(stage)
            rows = target.filled(spark.read.schema(batch.schema).parquet(stage))
            target.upsert(rows, check_keys=False, first_by=order, state={"stream_batches": done | {name: batch_id}})
        finally:
            delete(spark, stage)

    _drain(stream, apply, checkpoint_path)

"""Tables laid out by a column that scans are bounded by.

A high-water scan reads the row groups whose statistics reach above its bound.
Rows appended as they come spread every stamp over all files, and such a scan
reads everything; ranges of the column per task, sorted, leave it the row groups
at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def clustered(df: DataFrame, columns: list[str], files: int | None = None) -> DataFrame:
    """Rows dealt by range over ``columns`` and sorted within each range.

    Ranges come from a sample of the column, so that they are even whatever its
    values; rows of one value stay together. ``files`` defaults to the shuffle
    partitions, which adaptive execution merges up to its advisory size.
    """
    dealt = df.repartitionByRange(*columns) if files is None else df.repartitionByRange(files, *columns)
    return dealt.sortWithinPartitions(*columns)


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int | None = None, row_group_bytes: int | None = None) -> None:
    """Append ``df`` to a folder, clustered; each append is a run of ranges of its own."""
    writer = clustered(df, columns, files).write.mode("append")
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)

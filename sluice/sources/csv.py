"""CSV feeds and lookup files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sluice.schemas import CORRUPT


def read_feed_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = ",",
    *,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    match_header: bool = False,
) -> DataFrame:
    """Stream the CSV files of a folder, new ones as they arrive.

    A malformed line is kept: its text goes to the corrupt-record column, which
    must be part of ``schema``, and its well-formed fields are still parsed.
    Columns bind by position; ``match_header`` makes a file whose header names
    differ fail instead. The limits cut a large backlog into micro-batches.
    """
    reader = (
        spark.readStream.format("csv")
        .schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", not match_header)
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(path)


def read_static_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, sep: str = ","
) -> DataFrame:
    """Read a lookup file; give the schema to save the pass that infers it."""
    if schema is None:
        return spark.read.csv(path, header=True, sep=sep, inferSchema=True)
    return spark.read.csv(path, header=True, sep=sep, schema=schema)

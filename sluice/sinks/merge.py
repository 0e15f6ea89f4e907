"""Upsert into a partitioned parquet table of the catalog, at the cost of the partitions it touches.

Parquet tables have no row-level operations. A merge rewrites the partitions
that hold a key of the batch or receive a row of it, and no others: their rows
are found by a scan of the key column alone, and read through partition filters.

Partitions are written beside the files in use, into the one of two slots they
are not read from, and then pointed there one after the other. So the version
before stays for readers until the partition is merged again, a merge that fails
is repeated whole, and nothing piles up.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluice import storage
from sluice.operators.upsert import merge_rows

_SLOT = "_slot"
_NULL = "__HIVE_DEFAULT_PARTITION__"
# Partitions in one ALTER TABLE statement.
_ADDED_AT_ONCE = 500

Values = tuple[str | None, ...]


def _text(name: str) -> str:
    return f"_text_{name}"


def _quoted(value: str | None) -> str:
    if value is None:
        return "null"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def partition_spec(names: list[str], values: Values) -> str:
    """The partition's specification in a statement."""
    return "PARTITION (" + ", ".join(f"`{name}` = {_quoted(value)}" for name, value in zip(names, values)) + ")"


def _values(folder: str) -> Values:
    found = (unquote(part.partition("=")[2]) for part in folder.split("/"))
    return tuple(None if value == _NULL else value for value in found)


def _known_folders(spark: SparkSession, table_name: str) -> dict[Values, str]:
    """Folder names of the table's partitions, relative to a root."""
    return {_values(row[0]): row[0] for row in spark.sql(f"SHOW PARTITIONS {table_name}").collect()}


def _location(spark: SparkSession, table_name: str, spec: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name} {spec}").collect()
    names = [row.col_name for row in described]
    details = names.index("# Detailed Partition Information")  # columns come before
    return described[names.index("Location", details)].data_type


def _as_partitions(source: DataFrame, names: list[str]) -> DataFrame:
    """An empty text is stored in the partition of NULL."""
    texts = [name for name in names if isinstance(source.schema[name].dataType, StringType)]
    return source.withColumns({name: F.nullif(F.col(f"`{name}`"), F.lit("")) for name in texts})


def touched_partitions(
    target: DataFrame, source: DataFrame, key: str, names: list[str], keys_stay: bool = False
) -> list[Row]:
    """Partitions that receive a source row or hold one of its keys, a row each with values and their texts.

    ``keys_stay`` says that a key never changes its partition, which saves the
    scan of the stored keys.
    """
    partitions = [F.col(f"`{name}`") for name in names]
    touched = source.select(*partitions)
    if not keys_stay:
        touched = touched.unionByName(target.select(key, *partitions).join(source.select(key), key, "left_semi").select(*partitions))
    texts = [F.col(f"`{name}`").cast("string").alias(_text(name)) for name in names]
    return touched.distinct().select(*partitions, *texts).collect()


def _among(name: str, values: set) -> Column:
    column = F.col(f"`{name}`")
    known = column.isin([value for value in values if value is not None])
    return known | column.isNull() if None in values else known


def rows_of_partitions(target: DataFrame, names: list[str], touched: list[Row]) -> DataFrame:
    """Rows in partitions whose values occur among the touched ones, by filters that prune partitions."""
    return target.filter(reduce(Column.__and__, (_among(name, {row[name] for row in touched}) for name in names)))


def merge_partitions(
    target: DataFrame, table_name: str, location: str, source: DataFrame, key: str, names: list[str], keys_stay: bool = False
) -> int:
    """Merge ``source``, whose columns are the table's, by key; returns the number of partitions rewritten.

    ``source`` is read several times. The driver holds one entry for each
    partition touched, and the names of all partitions.
    """
    spark = target.sparkSession
    source = _as_partitions(source, names)
    touched = touched_partitions(target, source, key, names, keys_stay)
    if not touched:
        return 0
    values = [tuple(row[_text(name)] for name in names) for row in touched]
    specs = [partition_spec(names, one) for one in values]
    known = _known_folders(spark, table_name)
    new = [spec for one, spec in zip(values, specs) if one not in known]
    for start in range(0, len(new), _ADDED_AT_ONCE):  # empty until they are switched; the catalog names their folders
        spark.sql(f"ALTER TABLE {table_name} ADD IF NOT EXISTS {' '.join(new[start : start + _ADDED_AT_ONCE])}")
    folders = _known_folders(spark, table_name) if new else known

    base = f"{location}.slots"
    slots, places = [], {}
    for one, spec in zip(values, specs):
        in_first = _location(spark, table_name, spec).startswith(f"{base}/{_SLOT}=a/")
        slot = "b" if in_first else "a"
        places[spec] = f"{base}/{_SLOT}={slot}/{folders[one]}"
        storage.delete(spark, places[spec])
        if in_first:
            storage.delete(spark, f"{location}/{folders[one]}")
        slots.append((*one, slot))

    # One row for each touched partition, as the driver has just listed them.
    schema = ", ".join([*(f"`{_text(name)}` string" for name in names), f"{_SLOT} string"])
    slot_of = F.broadcast(spark.createDataFrame(slots, schema))

    def with_slots(frame: DataFrame) -> DataFrame:
        same = reduce(Column.__and__, (F.col(f"`{name}`").cast("string").eqNullSafe(F.col(f"`{_text(name)}`")) for name in names))
        return frame.join(slot_of, same).drop(*(_text(name) for name in names))

    merged = merge_rows(with_slots(rows_of_partitions(target, names, touched)), with_slots(source), key)
    merged.hint("rebalance", _SLOT, *names).write.mode("append").partitionBy(_SLOT, *names).parquet(base)
    for spec, place in places.items():
        if storage.exists(spark, place):
            spark.sql(f"ALTER TABLE {table_name} {spec} SET LOCATION '{_in_statement(place)}'")
        else:  # all its rows went elsewhere
            spark.sql(f"ALTER TABLE {table_name} DROP {spec}")
    spark.catalog.refreshTable(table_name)
    return len(touched)


def _in_statement(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")

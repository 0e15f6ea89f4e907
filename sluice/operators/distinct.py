"""Exact distinct counts that can be merged.

``count_distinct`` moves every key each time it is asked. A bitmap holds 32,768
neighbouring integer keys in 4 KB, a bit each; bitmaps of several batches, groups
or days are merged bit by bit, and the number of bits is the number of keys. So
keys are read once, when they arrive, and counts by any coarser grouping read
bitmaps only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from sluice.sources.tables import read_path

_BUCKET, _BITS = "_key_range", "_keys"


def key_bitmaps(rows: DataFrame, key: str, groups: list[str] | None = None, clustered: bool = False) -> DataFrame:
    """One bitmap for each group and range of keys.

    With ``clustered`` keys, such as those of a delivery that numbers its rows,
    each task builds its own bitmaps and only these are shuffled. Otherwise a
    task's keys would lie thinly in many ranges: keys are made distinct first,
    and those of one range, 32,768 at most, meet in one task.

    NULL keys are not counted, though their group is there.
    """
    if not isinstance(rows.schema[key].dataType, IntegralType):
        raise TypeError(f"{key} is no integer")
    groups = groups or []
    keys = rows.select(*groups, F.col(key).cast("long").alias(key))
    if not clustered:
        keys = keys.distinct()
    keys = keys.withColumn(_BUCKET, F.bitmap_bucket_number(key))
    if not clustered:
        keys = keys.repartition(*groups, _BUCKET)
    return keys.groupBy(*groups, _BUCKET).agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(_BITS))


def merge_bitmaps(bitmaps: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """The bitmaps of coarser groups."""
    return bitmaps.groupBy(*(groups or []), _BUCKET).agg(F.bitmap_or_agg(_BITS).alias(_BITS))


def count_bitmaps(bitmaps: DataFrame, groups: list[str] | None = None, name: str = "distinct") -> DataFrame:
    """Distinct keys by group."""
    merged = merge_bitmaps(bitmaps, groups)
    return merged.groupBy(*(groups or [])).agg(F.coalesce(F.sum(F.bitmap_count(_BITS)), F.lit(0)).alias(name))


class DistinctCounts:
    """Bitmaps kept by version below ``path``.

    A version that is added again replaces itself, so a failed batch is simply
    repeated. Keys are never forgotten: what is counted is every key ever added.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, groups: list[str] | None = None):
        self.spark, self.path, self.key, self.groups = spark, path.rstrip("/"), key, groups or []

    def add(self, rows: DataFrame, version: int, clustered: bool = False) -> None:
        found = key_bitmaps(rows, self.key, self.groups, clustered)
        found.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/_version={version}")

    def bitmaps(self) -> DataFrame:
        return read_path(self.spark, self.path)

    def count(self, groups: list[str] | None = None, name: str = "distinct") -> DataFrame:
        """Distinct keys by ``groups``, some or none of those that are kept."""
        return count_bitmaps(self.bitmaps(), groups, name)

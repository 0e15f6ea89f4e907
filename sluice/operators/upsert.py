"""Row-level upsert as a frame: what the target holds afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_unique_keys(source: DataFrame, key: str) -> None:
    """Refuse a source in which a key is NULL or comes twice."""
    counts = source.groupBy(key).agg(F.count("*").alias("rows"))
    bad = counts.filter((F.col("rows") > 1) | F.col(key).isNull()).limit(1).collect()
    if bad:
        raise ValueError(f"upsert source has a NULL or repeated key: {key}={bad[0][key]!r} in {bad[0]['rows']} rows")


def merge_rows(target: DataFrame, source: DataFrame, key: str, keys: DataFrame | None = None) -> DataFrame:
    """Source rows replace target rows of the same key; other target rows stay.

    ``keys`` hands in the source's keys where they can be read for less than the
    source takes, such as one that is dealt out for its write.

    Keys are unique on both sides, so the join has no hot keys. The anti join
    lets Spark broadcast the keys of a small batch and leave the target unmoved.
    """
    kept = target.join(source.select(key) if keys is None else keys, key, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)

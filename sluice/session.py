"""Session settings the plans in this package are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

from sluice.sinks.snapshot import MAX_DEFAULT_BUCKETS

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


MAX_PARTITIONS = 50_000


def sized_for(input_bytes: int, cores: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Scan and shuffle settings for a cluster's cores and the size of a run's input.

    Above ``MAX_PARTITIONS`` partitions, what the driver keeps about every pair
    of map and reduce task costs more than larger partitions do; they grow instead.

    Shuffle partitions of about ``partition_bytes`` are sorted without much
    spilling, and three tasks per core even out slow ones; adaptive execution
    merges what turns out smaller, up to the same size. Large numbers are a
    multiple of the bucket count of upsert tables, which saves those a shuffle.
    """
    partition_bytes = max(partition_bytes, -(-input_bytes // MAX_PARTITIONS))
    partitions = max(3 * cores, -(-input_bytes // partition_bytes))
    if partitions > MAX_DEFAULT_BUCKETS:
        partitions = -(-partitions // MAX_DEFAULT_BUCKETS) * MAX_DEFAULT_BUCKETS
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with adaptive execution on; ``settings`` use ``__`` for dots.

    Sizes that depend on the cluster are left to ``spark-defaults`` or to
    ``settings``; :func:`sized_for` gives those of scans and shuffles.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()

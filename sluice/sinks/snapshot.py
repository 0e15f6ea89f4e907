"""Upsert table on plain parquet: immutable version folders and a small pointer.

Layout below the table's path::

    data/_version=3/_bucket=17/...parquet   rows written by version 3
    rejects/v=3/...                         rejected rows of version 3's run
    pointer/000000000003.json               which (version, bucket) folders are current

A version becomes visible when its pointer file appears, whole; until then
nothing it wrote is read, and a failed attempt is simply written again. There
must be a **single writer** per table: parquet folders give no protection
against concurrent ones beyond refusing to publish a version twice.
"""

from __future__ import annotations

import json
from collections import Counter
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sluice import storage
from sluice.operators.dedup import keep_first
from sluice.operators.upsert import merge_rows, require_unique_keys
from sluice.sinks.evolution import conformed, widened
from sluice.sources.footers import footer_count

MAX_DEFAULT_BUCKETS = 2_048
_VERSION, _BUCKET = "_version", "_bucket"


def _from_json(schema: str) -> StructType:
    return StructType.fromJson(json.loads(schema))


@dataclass(frozen=True)
class Snapshot:
    """What the pointer file of one version says."""

    version: int
    n_buckets: int
    schema: str
    reject_schema: str | None = None
    segments: list[list[int]] = field(default_factory=list)
    reject_versions: list[int] = field(default_factory=list)
    state: dict = field(default_factory=dict)
    rows: int | None = None  # kept up by every version; unknown in one that was written before it was


class SnapshotTable:
    """Rows with a unique, non-NULL ``key``, spread over hash buckets.

    Each version adds at most one folder, a segment, per bucket. An upsert
    rewrites the segments that hold a key of its source, and no others: rows
    with new keys are only added. A bucket of ``max_segments`` is rewritten
    whole when next touched, so that files neither get many nor stay small.

    Buckets use the hash of Spark's own shuffles: with shuffle partitions equal
    to ``n_buckets`` or a multiple, a task that comes out of the join on the key
    writes to one bucket, and the layout needs no shuffle of its own. With other
    settings rows are shuffled to their buckets before the write. By default
    ``n_buckets`` is the number of shuffle partitions when the table is first
    written, up to a bound that keeps the pointer file small; :meth:`rebucket`
    changes it when the table has grown.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        n_buckets: int | None = None,
        partition_by: list[str] | None = None,
        max_segments: int = 8,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.partition_by = partition_by or []
        self.max_segments = max_segments
        self._n_buckets = n_buckets or min(self._shuffle_partitions(), MAX_DEFAULT_BUCKETS)

    def _shuffle_partitions(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    # -- reading ---------------------------------------------------------

    def _pointers(self) -> list[str]:
        return [n for n in storage.child_names(self.spark, f"{self.path}/pointer") if n.endswith(".json")]

    def _snapshot(self, pointer: str) -> Snapshot:
        return Snapshot(**json.loads(storage.read_text(self.spark, f"{self.path}/pointer/{pointer}")))

    def current(self) -> Snapshot | None:
        pointers = self._pointers()
        return self._snapshot(pointers[-1]) if pointers else None

    def at(self, version: int) -> Snapshot | None:
        """An earlier version; None if it was removed."""
        pointer = f"{version:012d}.json"
        return self._snapshot(pointer) if storage.exists(self.spark, f"{self.path}/pointer/{pointer}") else None

    def read(self) -> DataFrame:
        """Current rows."""
        snapshot = self.current()
        if snapshot is None:
            raise FileNotFoundError(f"nothing published at {self.path}")
        return self.scan(snapshot, snapshot.segments)

    def scan(self, snapshot: Snapshot, segments: list[list[int]]) -> DataFrame:
        """Rows of some segments of a version."""
        return self._scan(snapshot, segments).drop(_VERSION, _BUCKET)

    def read_rejects(self) -> DataFrame | None:
        """Rejected rows of the published runs; None before the first one."""
        snapshot = self.current()
        if snapshot is None or not snapshot.reject_versions:
            return None
        paths = [self.rejects_path(v) for v in snapshot.reject_versions]
        return self.spark.read.schema(_from_json(snapshot.reject_schema)).parquet(*paths)

    def _scan(self, snapshot: Snapshot, segments: list[list[int]]) -> DataFrame:
        schema = StructType(
            [*_from_json(snapshot.schema).fields, *(StructField(name, IntegerType()) for name in (_VERSION, _BUCKET))]
        )
        if not segments:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*self._folders(segments))
        return rows.select(*schema.fieldNames())

    # -- writing ---------------------------------------------------------

    def bucket_of_key(self, n_buckets: int) -> Column:
        return F.pmod(F.hash(self.key), F.lit(n_buckets)).cast("int")

    def filled(self, rows: DataFrame) -> DataFrame:
        """Rows with NULL for the stored columns they lack."""
        snapshot = self.current()
        known = _from_json(snapshot.schema).fields if snapshot else []
        return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in known if f.name not in rows.columns})

    def next_version(self) -> int:
        snapshot = self.current()
        return 1 if snapshot is None else snapshot.version + 1

    def rejects_path(self, version: int) -> str:
        return f"{self.path}/rejects/v={version}"

    def upsert(
        self,
        source: DataFrame,
        *,
        check_keys: bool = True,
        first_by: list[Column] | None = None,
        rejects: StructType | None = None,
        replace_rejects: bool = False,
        state: dict | None = None,
    ) -> Snapshot:
        """Merge ``source`` by key and publish the result as the next version.

        Source rows replace stored ones; with ``first_by``, the first row of a
        key by that order stays, whether it is stored or new.

        ``source`` is read several times, so hand in a table rather than a long
        plan. ``check_keys=False`` is for sources whose keys are unique by
        construction. ``rejects`` is the schema of rejects already written to
        :meth:`rejects_path` of this version; they are published in the same
        step, added to the earlier ones or replacing them. ``state`` entries
        are kept with the snapshot and carried forward.
        """
        if check_keys:
            require_unique_keys(source, self.key)
        old = self.current()
        n_buckets = old.n_buckets if old else self._n_buckets
        version = old.version + 1 if old else 1
        # Types are settled, and rejects refused, before anything is written.
        schema = widened(_from_json(old.schema) if old else None, source.schema, "upsert rows")
        source = conformed(source, schema)
        earlier = [] if replace_rejects or old is None else list(old.reject_versions)
        reject_schema = old.reject_schema if old else None
        if rejects is not None:
            reject_schema = widened(_from_json(reject_schema) if earlier else None, rejects, "rejects").json()

        source = source.withColumn(_BUCKET, self.bucket_of_key(n_buckets))
        keys = source.select(self.key)
        # At most n_buckets numbers, whether a key is missing, and their rows.
        found = source.groupBy(_BUCKET).agg(F.max(F.col(self.key).isNull()), F.count("*")).collect()
        if any(row[1] for row in found):
            raise ValueError(f"an upsert row has no {self.key}")
        touched = {row[0] for row in found}
        replaced, matched = self._segments_to_rewrite(old, touched, keys) if old else ([], 0)
        rows = sum(row[2] for row in found) - matched + (self._rows(old) if old else 0)
        if touched:
            placed = source.hint("rebalance", _BUCKET)
            if replaced:
                stored = self._scan(old, replaced).drop(_VERSION)
                if first_by is None:
                    placed = merge_rows(stored, placed, self.key, keys)
                else:  # two rows a key at most
                    placed = keep_first(stored.unionByName(placed, allowMissingColumns=True), [self.key], first_by)
                if self._shuffle_partitions() % n_buckets:
                    placed = placed.hint("rebalance", _BUCKET)
            (
                placed.write.mode("overwrite")
                .partitionBy(_BUCKET, *self.partition_by)
                .option("partitionOverwriteMode", "static")
                .parquet(f"{self.path}/data/{_VERSION}={version}")
            )
        current = [segment for segment in (old.segments if old else []) if segment not in replaced]
        snapshot = Snapshot(
            version=version,
            n_buckets=n_buckets,
            schema=schema.json(),
            reject_schema=reject_schema,
            segments=[*current, *([version, bucket] for bucket in sorted(touched))],
            reject_versions=[*earlier, version] if rejects is not None else earlier,
            state={**(old.state if old else {}), **(state or {})},
            rows=rows,
        )
        self._publish(snapshot)
        return snapshot

    def _rows(self, snapshot: Snapshot) -> int:
        return self.count_rows(snapshot.segments) if snapshot.rows is None else snapshot.rows

    def count_rows(self, segments: list[list[int]]) -> int:
        """Rows of some segments, from the footers of their files."""
        return footer_count(self.spark, self._folders(segments), f"{self.path}/data")

    def _folders(self, segments: list[list[int]]) -> list[str]:
        return [f"{self.path}/data/{_VERSION}={version}/{_BUCKET}={bucket}" for version, bucket in segments]

    def rebucket(self, n_buckets: int) -> Snapshot:
        """Publish the same rows under another number of buckets; readers of older versions are not disturbed."""
        old = self.current()
        if old is None:
            raise FileNotFoundError(f"nothing published at {self.path}")
        version = old.version + 1
        rows = self.read().withColumn(_BUCKET, self.bucket_of_key(n_buckets)).hint("rebalance", _BUCKET)
        (
            rows.write.mode("overwrite")
            .partitionBy(_BUCKET, *self.partition_by)
            .option("partitionOverwriteMode", "static")
            .parquet(f"{self.path}/data/{_VERSION}={version}")
        )
        names = storage.child_names(self.spark, f"{self.path}/data/{_VERSION}={version}")
        buckets = sorted(int(name.partition("=")[2]) for name in names if name.startswith(f"{_BUCKET}="))
        snapshot = replace(old, version=version, n_buckets=n_buckets, segments=[[version, b] for b in buckets])
        self._publish(snapshot)
        return snapshot

    def _publish(self, snapshot: Snapshot) -> None:
        name = f"{self.path}/pointer/{snapshot.version:012d}.json"
        storage.publish_text(self.spark, name, json.dumps(asdict(snapshot)))

    def _segments_to_rewrite(self, old: Snapshot, touched: set[int], keys: DataFrame) -> tuple[list[list[int]], int]:
        """Segments with a row to replace, and all segments of touched buckets that have too many; and the rows to replace."""
        candidates = [segment for segment in old.segments if segment[1] in touched]
        if not candidates:
            return [], 0
        found = self._scan(old, candidates).select(self.key, _VERSION, _BUCKET).join(keys, self.key, "left_semi")
        hit = {(row[0], row[1]): row[2] for row in found.groupBy(_VERSION, _BUCKET).agg(F.count("*")).collect()}
        held = Counter(bucket for _, bucket in candidates)
        return [[v, b] for v, b in candidates if (v, b) in hit or held[b] >= self.max_segments], sum(hit.values())

    def remove_superseded(self, keep: int = 2) -> None:
        """Delete segment and reject folders that none of the last ``keep`` versions refers to.

        Run it when no reader still uses an older version.
        """
        pointers = self._pointers()
        kept = [self._snapshot(name) for name in pointers[-keep:]]
        used = {f"data/{_VERSION}={v}/{_BUCKET}={b}" for s in kept for v, b in s.segments}
        used |= {f"rejects/v={v}" for s in kept for v in s.reject_versions}
        written = [
            f"data/{v}/{b}"
            for v in storage.child_names(self.spark, f"{self.path}/data")
            for b in storage.child_names(self.spark, f"{self.path}/data/{v}")
            if b.startswith(f"{_BUCKET}=")
        ]
        written += [f"rejects/{v}" for v in storage.child_names(self.spark, f"{self.path}/rejects")]
        for name in pointers[:-keep]:
            storage.delete(self.spark, f"{self.path}/pointer/{name}")
        for folder in written:
            if folder not in used:
                storage.delete(self.spark, f"{self.path}/{folder}")

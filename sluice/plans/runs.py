"""Whole runs: land the feeds, then structure what is new."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice import storage
from sluice.operators.skew import DEFAULT_GUARD, SkewGuard
from sluice.plans.feeds import FEEDS, Feed
from sluice.plans.kept_sums import refresh_sums
from sluice.plans.routing import CLEAN, CORRUPTED, DUPLICATE, FAILED, rejected_rows, route, structured_rows
from sluice.schemas import INSERTED_AT, raw_schema
from sluice.sinks.append import write_append, write_merge, write_replace
from sluice.sinks.landing import LANDING, last_landings, not_seen, read_landed
from sluice.sinks.snapshot import Snapshot, SnapshotTable
from sluice.sources.tables import ROW_ID, read_path, with_file_row_id
from sluice.streaming.ingest import ingest_feed


STATE_PROPERTY = "sluice.state"


def structured_table(spark: SparkSession, feed: Feed, path: str, n_buckets: int | None = None) -> SnapshotTable:
    return SnapshotTable(spark, path, feed.key, n_buckets, feed.partition_by)


def structured_tables(spark: SparkSession, lake_root: str, n_buckets: int | None = None) -> dict[str, SnapshotTable]:
    """The structured table of each feed of a lake."""
    return {name: structured_table(spark, feed, f"{lake_root}/structured/{name}", n_buckets) for name, feed in FEEDS.items()}


def run_feed(
    feed: Feed,
    raw: DataFrame,
    target: SnapshotTable,
    lookups: Mapping[str, DataFrame] | None = None,
    *,
    mode: str = "incremental",
    prefer_valid: bool = False,
    null_keys_are_duplicates: bool = False,
    normalize: bool = False,
    hash_rejects: list[str] | None = None,
    salt: str = "",
    guard: SkewGuard = DEFAULT_GUARD,
) -> Snapshot | None:
    """Route raw rows, upsert the clean ones and quarantine the others.

    ``incremental`` takes the rows landed since the last published run and adds
    to the quarantine; ``full`` takes all of them and replaces it. Rows, rejects
    and the new bound become visible in one step, so a run that dies halfway
    leaves nothing behind and is repeated whole. Returns None if nothing is new.

    New are the landings after those published (:mod:`sluice.sinks.landing`),
    whatever the stamps of their rows. Raw rows without landings are told apart
    by stamps: those above the last one are new, and rows that turn up without
    a stamp or at an earlier one are refused, since only a full run can find them.

    The outcome and the failures of each rule are counted as the routed rows are
    written, and kept with the version (``state["counts"]``), and so are the sums
    over all runs since the last full one (``state["totals"]``).
    """
    if mode not in ("incremental", "full"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = raw.sparkSession
    published = target.current()
    state = published.state if published is not None and mode == "incremental" else {}
    raw, bound = (_new_landings if LANDING in raw.columns else _new_stamps)(raw, state)
    if bound is None:
        return None

    # Landings are nothing but what tells new rows: they need not be shuffled and sorted with each row.
    routed = route(
        feed,
        raw.drop(LANDING),
        lookups,
        prefer_valid=prefer_valid,
        null_keys_are_duplicates=null_keys_are_duplicates,
        normalize=normalize,
        guard=guard,
    )
    # Routed once and written, since two sinks read it: a recomputed plan would
    # repeat the shuffle, and cached blocks are lost along with their executor.
    stage = storage.scratch_path(spark, f"routed-{feed.name}")
    try:
        staged, counts = _stage(feed, routed, stage)
        version = target.next_version()
        rejects = rejected_rows(feed, staged, hash_rejects, salt).withColumn("batch", F.lit(version))
        rejects.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target.rejects_path(version))
        return target.upsert(
            structured_rows(feed, staged),
            check_keys=False,
            rejects=rejects.schema,
            replace_rejects=mode == "full",
            state=bound | {"counts": counts, "totals": _totals(published if mode == "incremental" else None, counts)},
        )
    finally:
        storage.delete(spark, stage)


def _totals(published: Snapshot | None, counts: dict[str, int]) -> dict[str, int] | None:
    """Rows and outcomes of all runs so far; unknown if an earlier one did not keep them."""
    before = {} if published is None else published.state.get("totals")
    if before is None or (published is not None and not before):
        return None
    return {name: before.get(name, 0) + counts[name] for name in ("rows", CLEAN, CORRUPTED, DUPLICATE, FAILED)}


def _new_landings(raw: DataFrame, state: dict) -> tuple[DataFrame, dict | None]:
    seen = state.get("landings", {})
    raw = raw.filter(not_seen(seen))
    last = last_landings(raw, seen)
    # Landings that arrive from now on belong to the next run.
    return raw.filter(~not_seen(last)), None if last == seen else {"landings": last}


def _new_stamps(raw: DataFrame, state: dict) -> tuple[DataFrame, dict | None]:
    landed = F.unix_micros(INSERTED_AT)
    bound = state.get("high_water")
    fresh = F.lit(True) if bound is None else F.coalesce(landed > bound, F.lit(False))
    top, old, new = raw.agg(F.max(landed), F.count_if(~fresh), F.count_if(fresh)).first()
    if bound is not None and old != state.get("rows_seen", old):
        raise ValueError("rows landed without a stamp or at an earlier one; run in full mode, or land them in batches")
    if not new:
        return raw, None
    upto = F.lit(True) if top is None else F.coalesce(landed <= top, F.lit(True))
    return raw.filter(fresh & upto), {"high_water": top if top is not None else bound, "rows_seen": old + new}


def _stage(feed: Feed, routed: DataFrame, stage: str) -> tuple[DataFrame, dict[str, int]]:
    """Routed rows, written once since several sinks read them, and their counts from the same pass."""
    rules = feed.all_rules()
    seen = Observation(f"routed-{feed.name}-{uuid.uuid4().hex}")
    failed = [F.count_if(rule.failed & (F.col("outcome") != CORRUPTED)).alias(f"failed_{rule.flag}") for rule in rules]
    outcomes = [F.count_if(F.col("outcome") == name).alias(name) for name in (CLEAN, CORRUPTED, DUPLICATE, FAILED)]
    watched = routed.observe(seen, F.count("*").alias("rows"), *outcomes, *failed)
    watched.drop(ROW_ID).write.partitionBy("outcome").parquet(stage)
    return read_path(routed.sparkSession, stage), {name: int(value) for name, value in seen.get.items()}


def rule_counts(snapshot: Snapshot) -> dict[str, int]:
    """Rows, outcomes and failures per rule of the run that published a version."""
    return dict(snapshot.state.get("counts", {}))


def run_feed_into_catalog(
    feed: Feed,
    raw_table: str,
    structured_table_name: str,
    rejected_table: str,
    lookups: Mapping[str, DataFrame] | None = None,
    *,
    spark: SparkSession | None = None,
    mode: str = "full",
    hash_rejects: list[str] | None = None,
    salt: str = "",
    **routing,
) -> dict[str, int] | None:
    """Route a raw table into catalog tables: clean rows are merged, rejects replace the quarantine or are added.

    For lakes that live in the catalog. ``full`` takes all raw rows,
    ``incremental`` the landings after those of the last run, which a property
    of the structured table remembers; it returns None if there are none, else
    the run's counts (as in :func:`run_feed`). A run that dies halfway is simply
    run again. ``routing`` options are those of :func:`sluice.plans.routing.route`.
    """
    if mode not in ("incremental", "full"):
        raise ValueError(f"unknown mode {mode!r}")
    if spark is None:  # worker threads have no active session of their own
        spark = SparkSession.builder.getOrCreate()
    raw = with_file_row_id(spark.table(raw_table))
    state = json.loads(_property(spark, structured_table_name, STATE_PROPERTY) or "{}")
    pending = state.get("pending", {})
    if mode == "incremental":
        if LANDING not in raw.columns:
            raise ValueError(f"{raw_table} has no landings to tell new rows by; run in full mode")
        raw, bound = _new_landings(raw, state)
        if bound is None:
            return None
    else:
        bound = {"landings": last_landings(raw, {}, complete=False)} if LANDING in raw.columns else {}
    routed = route(feed, raw.drop(LANDING), lookups, **routing)
    stage = storage.scratch_path(spark, f"routed-{feed.name}")
    try:
        staged, counts = _stage(feed, routed, stage)
        # Merging is repeatable; the quarantine is not, so its growth is recorded before and after.
        write_merge(structured_rows(feed, staged), structured_table_name, feed.key, check_keys=False)
        rejects = rejected_rows(feed, staged, hash_rejects, salt)
        if mode == "full":
            write_replace(rejects, rejected_table)
        elif pending.get("landings") != bound["landings"] or spark.table(rejected_table).count() == pending["rows"]:
            before = {"pending": bound | {"rows": spark.table(rejected_table).count()}}
            _set_property(spark, structured_table_name, STATE_PROPERTY, json.dumps(state | before))
            write_append(rejects, rejected_table)
        _set_property(spark, structured_table_name, STATE_PROPERTY, json.dumps(bound | {"counts": counts}))
        return counts
    finally:
        storage.delete(spark, stage)


def _property(spark: SparkSession, table_name: str, name: str) -> str | None:
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table_name}").collect()}
    return found.get(name)


def _set_property(spark: SparkSession, table_name: str, name: str, value: str) -> None:
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table_name} SET TBLPROPERTIES ('{name}' = '{quoted}')")


def run_all(
    spark: SparkSession,
    source_root: str,
    lake_root: str,
    lookups: Mapping[str, DataFrame],
    *,
    mode: str = "incremental",
    n_buckets: int | None = None,
    most_changed: float = 1.0,
) -> dict[str, Snapshot | None]:
    """One round over all feeds: land each feed's new files, then structure them, then keep the reports' sums.

    Feeds do not depend on each other and run side by side, so that one feed's
    last tasks do not leave the cluster idle. They are read from
    ``source_root/<feed>``; raw, checkpoint, structured and sums folders are kept
    below ``lake_root``. Sums are corrected by what the round changed, or counted
    anew where that is more than ``most_changed`` times the rows there are.
    """
    targets = structured_tables(spark, lake_root, n_buckets)

    def one_round(feed: Feed) -> Snapshot | None:
        raw_path, source = f"{lake_root}/raw/{feed.name}", f"{source_root}/{feed.name}"
        if storage.exists(spark, source):  # a feed that has not begun yet holds up no other
            ingest_feed(spark, feed, source, f"{lake_root}/checkpoints/{feed.name}", path=raw_path)
        return run_feed(feed, read_landed(spark, raw_path, raw_schema(feed.schema)), targets[feed.name], lookups, mode=mode)

    with ThreadPoolExecutor(len(FEEDS)) as pool:
        published = dict(zip(FEEDS, pool.map(one_round, FEEDS.values())))
    refresh_sums(spark, lake_root, targets, most_changed)
    return published

"""Detection of hot keys, and a join that spreads them."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.key_filter import filter_blocks, tag_possible
from sluice.operators.sizing import fits_broadcast
from sluice.sources.tables import ROW_ID, with_row_id
from sluice.storage import scratch_path

_COUNTERS = 131_072


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(name) for name in keys])


def is_hot(keys: list[str], hot: Iterable[int]) -> Column:
    listed = ", ".join(f"{value}L" for value in hot)
    names = ", ".join(f"`{name}`" for name in keys)
    return F.expr(f"xxhash64({names}) IN ({listed})") if listed else F.lit(False)


@dataclass(frozen=True)
class SkewGuard:
    """A key is hot with ``min_rows`` rows and 1/``max_keys`` of all rows.

    So there are never more than ``max_keys`` hot keys, and a key that is not
    hot is no burden to an ordinary shuffle. Operators give the same result for
    a key either way; the bounds steer cost only.
    """

    min_rows: int = 1_000_000
    max_keys: int = 20_000

    def hot_keys(self, df: DataFrame, keys: list[str]) -> dict[int, float]:
        """Hashes of the hot keys, counted exactly, and their shares of all rows.

        First all rows are counted by a coarse hash, which map-side combining
        cuts to a fixed number of counters per task. Only if one of these is
        large are the keys behind it counted one by one.
        """
        hashes = df.select(key_hash(keys).alias("key_hash"))
        counter = F.pmod("key_hash", F.lit(_COUNTERS)).alias("counter")
        counters = hashes.groupBy(counter).agg(F.count("*").alias("rows"))
        total, largest = counters.agg(F.sum("rows"), F.max("rows")).first()
        bound = max(self.min_rows, (total or 0) // self.max_keys)
        if (largest or 0) < bound:
            return {}
        # At most total/bound counters, so no more than max_keys; likewise the keys below.
        large = F.broadcast(counters.filter(F.col("rows") >= bound).select("counter"))
        suspects = hashes.withColumn("counter", counter).join(large, "counter", "left_semi")
        counts = suspects.groupBy("key_hash").agg(F.count("*").alias("rows")).filter(F.col("rows") >= bound)
        return {row["key_hash"]: row["rows"] / total for row in counts.collect()}


DEFAULT_GUARD = SkewGuard()


def _splits_skew(spark: SparkSession) -> bool:
    names = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(spark.conf.get(name).lower() == "true" for name in names)


def _written(frame: DataFrame) -> DataFrame:
    path = scratch_path(frame.sparkSession, "lookup")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: list[str] | None = None,
    guard: SkewGuard | None = None,
    max_broadcast_rows: int | None = None,
    prefilter: bool = False,
) -> DataFrame:
    """Left join to a lookup that has each ``key`` once.

    A lookup of checked size is broadcast and the facts stay where they are.
    A larger one is shuffled, and adaptive execution splits the partitions of
    hot keys, which needs no look at the facts beforehand. Where that is off, or
    with a ``guard``, hot keys are counted first; their rows, those without a
    key included, are dealt out over salts, as many as an average shuffle
    partition goes into the key's share, and their lookup row is repeated once
    per salt. ``spread_by`` names columns that tell the rows of a key apart;
    without it the row identity does.

    ``prefilter`` is for facts of which many have no match in a lookup that has to
    be shuffled: a filter of the lookup's keys, broadcast at a bounded size, tells
    those apart, and they, with the rows that have no key, are never shuffled. The
    facts are read twice for that.

    The lookup is written to the scratch folder once, since measuring reads it too.
    """
    lookup = _written(lookup)
    bound = {} if max_broadcast_rows is None else {"max_rows": max_broadcast_rows}
    if fits_broadcast(lookup, **bound):
        return facts.join(F.broadcast(lookup), key, "left")
    found = filter_blocks(lookup, key) if prefilter else None
    if found is not None:
        tagged = tag_possible(facts, key, (_written(found[0]), found[1]), "_possible")
        missed = tagged.filter(~F.col("_possible")).drop("_possible")
        possible = _shuffled(tagged.filter("_possible").drop("_possible"), lookup, key, spread_by, guard)
        return possible.unionByName(missed, allowMissingColumns=True)
    return _shuffled(facts, lookup, key, spread_by, guard)


def _shuffled(facts: DataFrame, lookup: DataFrame, key: str, spread_by: list[str] | None, guard: SkewGuard | None) -> DataFrame:
    if guard is None and _splits_skew(facts.sparkSession):
        return facts.join(lookup, key, "left")
    hot = (guard or DEFAULT_GUARD).hot_keys(facts, [key])
    if not hot:
        return facts.join(lookup, key, "left")
    columns = [*facts.columns, *[name for name in lookup.columns if name != key]]
    if spread_by is None:
        facts, spread_by = with_row_id(facts), [ROW_ID]

    spark = facts.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = [(value, 1 + math.ceil(share * partitions)) for value, share in hot.items()]
    # At most guard.max_keys rows of two numbers.
    salts = F.broadcast(spark.createDataFrame(salts, "_hash long, _salts int"))

    def with_salts(frame: DataFrame) -> DataFrame:
        return frame.withColumn("_hash", key_hash([key])).join(salts, "_hash", "left")

    own_salt = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_salts")), F.lit(0)).cast("int")
    all_salts = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    salted_facts = with_salts(facts).withColumn("_salt", own_salt)
    salted_lookup = with_salts(lookup).withColumn("_salt", all_salts).drop("_hash", "_salts")
    return salted_facts.join(salted_lookup, [key, "_salt"], "left").select(*columns)

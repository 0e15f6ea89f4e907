"""Mixing sources to target weights by systematic sampling.

Every source has a target in words: its share of all words by weight, no more
than ``MAX_COPIES`` times what it has, the excess going to the others by weight.
A document of a source is expected to be taken target / source size times.
Ordered by size, the expected copies of a source's documents are summed up; one
offset per source is added, and a document is emitted once for every integer
its part of the sum crosses. So a source's copies differ from the expected
number by less than one, neighbours of one size stand in for each other, and no
document is emitted more than ``MAX_COPIES`` times. A source's few longest
documents can still move its words by their own size: of ``OFFSETS`` evenly
spaced offsets, at a random start, the one that comes nearest to the target is used.

Expected copies are whole billionths and offsets come from a hash of the
source, so reruns agree on any cluster. Prefix sums are distributed by range
(``common.prefix_sums``); a source with a third of all documents is spread. Only
the table of sources, a row each, is ordered in one place.

Defined cases: a null text has size 0 and is a row like any other; null is a
source of its own and the last one; sources without words have target 0 and
none of their documents is taken; repeated rows are sampled separately.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import ROW, columns, materialise, n_words, prefix_sums, with_rows

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
UNIT = 10**9
OFFSETS = 16


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Water-filling: in the order of limit per weight, a source is at its limit
    if that is below its share of what the sources before it leave.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit_per_weight", F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")
    ranked = sources.withColumn("weight", F.array(*[F.lit(w) for w in weights])[place])
    ranked = ranked.withColumn("limit", F.col("source_size") * MAX_COPIES)
    ranked = ranked.withColumn("limit_per_weight", F.col("limit") / F.col("weight"))
    total = F.sum("source_size").over(everything) * F.lit(share)
    left = total - F.coalesce(F.sum("limit").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = ranked.withColumn("level", left / weight_left)
    ranked = ranked.withColumn("limited", F.col("limit_per_weight") < F.col("level"))
    # The level of the first source that is not at its limit holds for all that follow.
    first = F.first(F.when(~F.col("limited"), F.col("level")), ignorenulls=True).over(everything)
    target = F.when(F.col("limited"), F.col("limit").cast("double")).otherwise(F.col("weight") * first)
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def _hash(seed: int, value: Column) -> Column:
    """The first 60 bits of an MD5."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), value)), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def _offset(seed: int) -> Column:
    """A number below UNIT for each source."""
    return _hash(seed, F.coalesce("source", F.lit("\x00"))) % UNIT


def plan_mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.0,
    seed: int = 0,
) -> DataFrame:
    """``(ROW, doc_id, source, size, source_size, target, copies)`` for every row of ``docs``, which has ``ROW``."""
    sized = docs.select(*ROW, F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(text).alias("size"))
    sized = materialise(sized, "sizes")
    wanted = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share)
    # The part below 1 is cut off to whole billionths, so limits are met exactly.
    units = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0) * UNIT)
    wanted = wanted.withColumn("units", units.cast("decimal(20,0)"))
    wanted = materialise(wanted, "targets").withColumnRenamed("source", "_source")
    planned = sized.join(wanted, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    planned = planned.withColumn("order", _hash(seed, F.col("doc_id").cast("string")))
    summed = prefix_sums(planned, "source", ["size", "order", "doc_id", *ROW], "units")
    summed = materialise(summed.withColumn("start", _offset(seed)).drop("order"), "prefixes")

    def copies(offset: Column) -> Column:
        upto = F.col("prefix") + offset
        return (F.floor(upto / UNIT) - F.floor((upto - F.col("units")) / UNIT)).cast("int")

    offsets = [(F.col("start") + k * UNIT // OFFSETS) % UNIT for k in range(OFFSETS)]
    tried = summed.groupBy("source", "start", "target").agg(
        *[F.sum(F.col("size") * copies(offset)).alias(f"taken{k}") for k, offset in enumerate(offsets)]
    )
    distances = [F.struct(F.abs(F.col(f"taken{k}") - F.col("target")), offset) for k, offset in enumerate(offsets)]
    nearest = tried.select(F.col("source").alias("_source"), F.least(*distances)["col2"].alias("offset"))
    planned = summed.join(nearest, F.col("source").eqNullSafe(F.col("_source")))
    return planned.withColumn("copies", copies(F.col("offset"))).drop("_source", "prefix", "units", "start", "offset")


def mix(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, columns unchanged."""
    own = columns(docs.columns)
    docs = with_rows(docs)
    plan = plan_mix(docs, **how).filter("copies > 0").select(*ROW, F.col("copies").alias("__copies"))
    taken = docs.join(plan, list(ROW))
    return taken.select(*own, F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy")).drop("__copy")

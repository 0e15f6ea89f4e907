"""Sharding by extendible hashing.

A directory indexed by the leading bits of a row's hash names the shard of the
row. A shard starts as the whole table; one that exceeds its byte limit splits
on the next bit, and only it does, so shards have as many bits as they need. A
row's shard is therefore the shortest prefix of its hash whose rows fit.

Sizes are summed by a prefix a few bits longer than an average shard's, combined
before the shuffle; all shorter prefixes follow from that small table. Prefixes
that are still too large are refined by further bits, their rows alone. Rows
are never gathered by shard to decide, and their texts never move.

Rows that equal each other in id and text share all bits. If such a group is
above the limit, it is dealt out to pages of the shard by rank, through
distributed prefix sums. One document above the limit is a shard of its own,
the only case in which a shard may exceed the limit.

Defined cases: a null text has 0 bytes; a null id hashes by the text alone; an
empty table has no shard; extra columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ROW, columns, materialise, prefix_sums, with_rows

LIMIT_BYTES = 8 << 20
BITS = 60
STEP = 10


def row_hash(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The first 60 bits of the MD5 of the id and the text's MD5."""
    key = F.concat_ws(":", F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def _bits(depth: Column | int, hashes: str = "hash") -> Column:
    depth = depth if isinstance(depth, Column) else F.lit(depth)
    return F.call_function("shiftright", F.col(hashes), (F.lit(BITS) - depth).cast("int"))


def _leaves(sizes: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """For prefixes of ``high`` bits with ``(bits, bytes, docs)``: their shard, or null if none of up to ``high`` bits fits.

    Shards of fewer than ``low`` bits are known not to fit.
    """
    depths = sizes.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
    depths = depths.withColumn("prefix", F.call_function("shiftright", F.col("bits"), (F.lit(high) - F.col("depth")).cast("int")))
    buckets = depths.groupBy("depth", "prefix").agg(
        F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs")
    )
    fits = buckets.filter((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1))
    found = depths.select("bits", "depth", "prefix").join(fits, ["depth", "prefix"])
    best = found.groupBy("bits").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_docs")).alias("shard"))
    return sizes.select("bits").join(best, "bits", "left").select("bits", "shard.*")


def directory(hashed: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """``[(bits, leaves)]``: which prefixes of how many bits belong to which shard.

    A leaf without a shard is refined by the next entry; in the last one such
    leaves are groups of equal hashes above the limit.
    """
    total = hashed.agg(F.sum("bytes")).first()[0] or 0
    high = min(BITS, max(1, math.ceil(math.log2(max(1, total / limit)))) + 3)
    low, rest, entries = 0, hashed, []
    while True:
        sizes = rest.groupBy(_bits(high).alias("bits")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs"))
        leaves = materialise(_leaves(sizes, low, high, limit), "leaves")
        entries.append((high, leaves))
        open_leaves = leaves.filter("depth is null").select(F.col("bits").alias("_open"))
        if high == BITS or open_leaves.isEmpty():
            return entries
        rest = rest.join(open_leaves, _bits(high) == F.col("_open"), "left_semi")
        low, high = high + 1, min(BITS, high + STEP)


def shard(docs: DataFrame, limit: int = LIMIT_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``shard`` (its bits, a page after ``#``), ``depth``, ``shard_bytes``, ``shard_docs`` and ``bytes``.

    Columns of ``docs`` with these names are replaced.
    """
    added = ["bytes", "shard", "depth", "shard_bytes", "shard_docs"]
    kept = columns([name for name in docs.columns if name not in added])
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    hashed = docs.select(*kept, row_hash(doc_id, text).alias("__hash"), size.alias("bytes"))
    entries = directory(materialise(hashed.select(F.col("__hash").alias("hash"), "bytes"), "hashes"), limit)
    named = hashed
    for k, (high, leaves) in enumerate(entries):
        leaves = leaves.filter("depth is not null").select(
            F.col("bits").alias(f"__bits{k}"), F.struct("depth", "prefix", "shard_bytes", "shard_docs").alias(f"__shard{k}")
        )
        named = named.join(leaves, _bits(high, "__hash") == F.col(f"__bits{k}"), "left").drop(f"__bits{k}")
    found = F.coalesce(*[F.col(f"__shard{k}") for k in range(len(entries))])
    named = named.select(*kept, "__hash", "bytes", found.alias("__s"))
    whole = named.select(
        *kept,
        "bytes",
        F.when(F.col("__s.depth") == 0, "").otherwise(F.lpad(F.bin("__s.prefix"), F.col("__s.depth"), F.lit("0"))).alias("shard"),
        F.col("__s.depth").cast("int").alias("depth"),
        F.col("__s.shard_bytes").alias("shard_bytes"),
        F.col("__s.shard_docs").alias("shard_docs"),
    )
    high, leaves = entries[-1]
    if high < BITS or leaves.filter("depth is null").isEmpty():
        return whole
    # Groups of equal rows above the limit: as many to a page as fit.
    equal = with_rows(named.filter("__s is null"))
    equal = prefix_sums(equal.withColumn("__one", F.lit(1)), "__hash", list(ROW), "__one", "__rank")
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("bytes")))
    equal = equal.withColumn("__page", F.floor((F.col("__rank") - 1) / per_page))
    pages = equal.groupBy("__hash", "__page").agg(F.count("*").alias("shard_docs"), F.sum("bytes").alias("shard_bytes"))
    paged = equal.join(pages, ["__hash", "__page"]).select(
        *kept,
        "bytes",
        F.concat(F.lpad(F.bin("__hash"), BITS, "0"), F.lit("#"), F.col("__page").cast("string")).alias("shard"),
        F.lit(BITS).alias("depth"),
        "shard_bytes",
        "shard_docs",
    )
    return whole.filter("shard is not null").unionByName(paged)

"""A filter of bounded size that rules out rows whose key a lookup does not have.

It is a Bloom filter in blocks of 64 bits: a key's hash names one block and three
bits in it. Tasks build the blocks, map-side combined; facts meet them in one
broadcast join on the block's number and test their bits in generated code. A
key of the lookup is never ruled out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of two numbers, whatever the lookup's size.
MOST_BLOCKS = 1 << 20
KEYS_PER_BLOCK = 4
# With more keys in a block most of its bits are set, and the filter lets nearly everything through.
FULL = 24

_BLOCK, _BITS = "_block", "_bits"


def _mask(hashed: Column) -> Column:
    one = F.lit(1).cast("long")
    places = [F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit(63)).cast("int") for shift in (40, 46, 52)]
    first, second, third = (F.call_function("shiftleft", one, place) for place in places)
    return first.bitwiseOR(second).bitwiseOR(third)


def _block(hashed: Column, blocks: int) -> Column:
    return hashed.bitwiseAND(F.lit(blocks - 1))


def filter_blocks(lookup: DataFrame, key: str, most_blocks: int = MOST_BLOCKS) -> tuple[DataFrame, int] | None:
    """The filter's blocks and their number, or None if the lookup has too many keys for one of this size."""
    keys = lookup.count()
    if keys > FULL * most_blocks:
        return None
    blocks = min(most_blocks, 1 << max(0, (keys // KEYS_PER_BLOCK)).bit_length())
    hashed = lookup.select(F.xxhash64(key).alias("hash"))
    return hashed.groupBy(_block(F.col("hash"), blocks).alias(_BLOCK)).agg(F.bit_or(_mask(F.col("hash"))).alias(_BITS)), blocks


def tag_possible(facts: DataFrame, key: str, filter_of_keys: tuple[DataFrame, int], tag: str) -> DataFrame:
    """Add a boolean: may the lookup hold the row's key? False for a NULL key."""
    rows, blocks = filter_of_keys
    hashed = F.xxhash64(key)
    probed = facts.withColumn(_BLOCK, F.when(F.col(key).isNotNull(), _block(hashed, blocks)))
    # At most MOST_BLOCKS rows.
    met = probed.join(F.broadcast(rows), _BLOCK, "left")
    mask = _mask(hashed)
    return met.withColumn(tag, F.coalesce(F.col(_BITS).bitwiseAND(mask) == mask, F.lit(False))).drop(_BLOCK, _BITS)

"""SimHash near-duplicates: fingerprints linked through BK-trees.

A document's fingerprint has 64 bits; two documents are linked if at most
``radius`` bits differ, and a group is what links reach. Steps:

1. one fingerprint per text, in the scan;
2. distinct fingerprints, each with the smallest ``doc_id`` that has it;
3. every fingerprint goes to the shards of all ways to keep ``keep`` of
   ``blocks`` bit blocks: two fingerprints within the radius differ in at most
   ``radius`` blocks, so with ``keep = blocks - radius`` they agree on at least
   one choice and meet in its shard;
4. in each shard a BK-tree (children keyed by their Hamming distance to the
   parent) answers radius queries along edges within the radius. Shards above
   ``shard_rows`` are cut into chunks by hash, and each pair of chunks is a
   shard of its own: one holds the tree, the other asks;
5. a shard emits a spanning forest of its links, never all pairs, and
   components are found over the forests of all shards.

The trees travel by shuffle to the rows that ask, since all of them together
grow with the corpus and no broadcast of them would have a bound.

Defined cases: a null text counts as empty; a text without a word has
fingerprint zero and is linked like any other; a null ``doc_id`` never names a
group: its row takes the group of its fingerprint, and a fingerprint that no
row with an id has links nothing and has a null group; repeated rows are kept
and share a group. Extra columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ROW, as_bytes, join_key, materialise, with_rows
from sluice.llm.components import connected_components

SEED = 42


def fingerprint_of(text: bytes, shingle: int = 4) -> int:
    """Majority bits of the XXH64 hashes of a text's word shingles, as an unsigned number.

    A-Z are lower-cased; words are runs of bytes other than ASCII white space.
    """
    words = text.lower().split()
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(b" ".join(words[k : k + shingle]), SEED) for k in range(last)), np.uint64, last
    )
    counts = np.zeros(64, np.int64)
    for part in range(0, last, 65536):
        bits = np.unpackbits(hashes[part : part + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > last, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | Column, shingle: int = 4) -> Column:
    """The fingerprint of a text column as a signed 64-bit number."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint_of(x, shingle) for x in texts.to_pylist()), np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    return of(as_bytes(text))


def block_masks(blocks: int, keep: int) -> list[int]:
    """Bit masks of all choices of ``keep`` out of ``blocks`` blocks that cut 64 bits evenly."""
    cuts = [round(64 * k / blocks) for k in range(blocks + 1)]
    block = [(1 << cuts[k + 1]) - (1 << cuts[k]) for k in range(blocks)]
    return [sum(block[k] for k in chosen) for chosen in combinations(range(blocks), keep)]


# -- BK-trees --------------------------------------------------------------


def grow_trees(unit: np.ndarray, prints: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One BK-tree per unit over its ``rows``: ``(roots by unit, edge keys, children)``.

    An edge key is ``parent * 65 + distance``, sorted, with the child beside it.
    All trees grow together, one level at a time. Rows of a unit have distinct
    prints.
    """
    roots = np.full(int(unit.max()) + 1, -1, np.int64)
    units, first = np.unique(unit[rows], return_index=True)
    roots[units] = rows[first]
    waiting = np.delete(rows, first)
    at = roots[unit[waiting]]
    keys, children = [], []
    while len(waiting):
        distance = np.bitwise_count(prints[waiting] ^ prints[at]).astype(np.int64)
        edge, first, which = np.unique(at * 65 + distance, return_index=True, return_inverse=True)
        child = waiting[first]
        keys.append(edge)
        children.append(child)
        placed = np.zeros(len(waiting), bool)
        placed[first] = True
        waiting, at = waiting[~placed], child[which[~placed]]
    if not keys:
        return roots, np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(key)
    return roots, key[order], child[order]


def ask_trees(
    trees: tuple[np.ndarray, np.ndarray, np.ndarray], unit: np.ndarray, prints: np.ndarray, rows: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs ``(asking row, tree row)`` within the radius, following only edges within the radius."""
    roots, keys, children = trees
    ask, node = rows, roots[unit[rows]]
    there = node >= 0
    ask, node = ask[there], node[there]
    while len(ask):
        distance = np.bitwise_count(prints[ask] ^ prints[node]).astype(np.int64)
        near = (distance <= radius) & (ask != node)
        if near.any():
            yield ask[near], node[near]
        low = np.searchsorted(keys, node * 65 + np.maximum(distance - radius, 0))
        high = np.searchsorted(keys, node * 65 + np.minimum(distance + radius, 64), side="right")
        width = high - low
        total = int(width.sum())
        ask = np.repeat(ask, width)
        start = np.repeat(low - np.concatenate(([0], np.cumsum(width)[:-1])), width)
        node = children[start + np.arange(total)] if total else np.zeros(0, np.int64)


def smallest_labels(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``size`` nodes the smallest node it is connected to."""
    label = np.arange(size)
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return label
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def forest(unit: np.ndarray, prints: np.ndarray, node: np.ndarray, tree: np.ndarray, probe: np.ndarray, radius: int):
    """Edges ``(node, smallest node it reaches)`` of a batch of whole shards."""
    order = np.lexsort((node, unit))
    unit, prints, node, tree, probe = (x[order] for x in (unit, prints, node, tree, probe))
    unit = np.unique(unit, return_inverse=True)[1]
    trees = grow_trees(unit, prints, np.flatnonzero(tree))
    asking = np.flatnonzero(probe)
    label = np.arange(len(node))
    size = np.bincount(unit[tree], minlength=int(unit.max()) + 1)[unit[asking]]
    # At most about four million visits at a time.
    cut = np.concatenate(([0], np.flatnonzero(np.diff(np.cumsum(size) // 4_000_000)) + 1, [len(asking)]))
    for begin, end in zip(cut[:-1], cut[1:], strict=True):
        for ask, found in ask_trees(trees, unit, prints, asking[begin:end], radius):
            joined = smallest_labels(len(label), label[ask], label[found])
            label = joined[label]
    moved = label != np.arange(len(label))
    return node[moved], node[label[moved]]


def _forests(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(columns: list[np.ndarray]) -> pa.RecordBatch:
            pair, masked, chunks, prints, node, tree, probe = columns
            new = (np.diff(pair) != 0) | (np.diff(masked) != 0) | (np.diff(chunks) != 0)
            where = np.concatenate(([0], np.cumsum(new)))
            u, v = forest(where, prints.view(np.uint64), node, tree.astype(bool), probe.astype(bool), radius)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        rest: list[np.ndarray] | None = None
        for batch in batches:
            columns = [np.asarray(c.to_numpy(zero_copy_only=False)) for c in batch.columns]
            if not len(columns[0]):
                continue
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
            # Rows come sorted by shard; the last shard may go on in the next batch.
            same = np.ones(len(columns[0]), bool)
            for c in columns[:3]:
                same &= c == c[-1]
            cut = len(same) - int(same[::-1].argmin()) if not same.all() else 0
            rest = [c[cut:] for c in columns]
            if cut:
                yield links([c[:cut] for c in columns])
        if rest is not None and len(rest[0]):
            yield links(rest)

    return run


def link_fingerprints(prints: DataFrame, radius: int = 4, blocks: int = 6, shard_rows: int = 8192) -> DataFrame:
    """Forest edges ``(u, v)`` of distinct fingerprints ``(print, node)`` within the radius.

    Both columns are 64-bit numbers; equal prints must have been merged before.
    """
    if not 0 <= radius < blocks:
        raise ValueError("blocks must exceed the radius")
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(blocks, blocks - radius)]
    choices = F.explode(F.array(*[F.struct(F.lit(k).alias("choice"), F.lit(m).cast("long").alias("mask")) for k, m in enumerate(masks)]))
    routed = prints.select("print", "node", choices.alias("c")).select(
        F.col("c.choice").alias("choice"), F.expr("print & c.mask").alias("masked"), "print", "node"
    )
    sizes = routed.groupBy("choice", "masked").agg(F.count("*").alias("size")).filter("size > 1")
    sizes = sizes.select(join_key("choice", "masked").alias("shard"), "size")
    met = routed.withColumn("shard", join_key("choice", "masked")).join(sizes, "shard")
    # Chunk pairs (tree chunk <= asking chunk) of a large shard; a small one is its own only pair.
    met = met.withColumn("n", F.ceil(F.col("size") / F.lit(shard_rows)).cast("int"))
    met = met.withColumn("own", F.pmod(F.xxhash64("print"), F.col("n")).cast("int"))
    units = met.withColumn("other", F.explode(F.when(F.col("n") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("n") - 1))))
    units = units.select(
        "choice",
        "masked",
        (F.least("own", "other") * F.col("n") + F.greatest("own", "other")).cast("long").alias("chunks"),
        "print",
        "node",
        (F.col("own") <= F.col("other")).alias("tree"),
        (F.col("own") >= F.col("other")).alias("probe"),
    )
    shards = units.repartition("choice", "masked", "chunks").sortWithinPartitions("choice", "masked", "chunks")
    return shards.mapInArrow(_forests(radius), "u long, v long")


def simhash_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    radius: int = 4,
    blocks: int = 6,
    shingle: int = 4,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(*keep, doc_id, print, component)`` for every row of ``docs``."""
    marked = docs.select(*keep, F.col(doc_id).alias("doc_id"), fingerprint(text, shingle).alias("print"))
    marked = materialise(marked, "prints")
    distinct = marked.groupBy("print").agg(F.min("doc_id").alias("node"))
    named = distinct.filter("node is not null")
    unnamed = distinct.filter("node is null").select("print")
    links = link_fingerprints(named, radius, blocks)
    groups = connected_components(links)
    placed = named.join(groups, named["node"] == groups["node"], "left").select(
        "print", F.coalesce(groups["component"], named["node"]).alias("component")
    )
    placed = placed.unionByName(unnamed.withColumn("component", F.lit(None).cast("long")))
    return marked.join(placed, "print", "left").select(*keep, "doc_id", "print", "component")


def keep_one_per_group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """One row of each near-duplicate group: that with the smallest id, of repeated rows the first in file order.

    Rows without an id stay only if no row with one is in their group.
    """
    rows = with_rows(docs)
    groups = simhash_groups(rows, text, doc_id, keep=ROW, **how)
    # Groups without any id are told apart by their fingerprint.
    alone = F.when(F.col("component").isNull(), F.col("print"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *ROW)).alias("best")
    winners = groups.groupBy("component", alone.alias("alone")).agg(best).select(*[f"best.{name}" for name in ROW])
    return rows.join(winners, list(ROW), "left_semi").drop(*ROW)

"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Every n-gram of words of the test items is looked up in the training texts,
   and its rows there are counted. N-grams may skip up to ``SKIP`` words, in
   items and texts alike, so that an edited word does not break them.
2. An alignment that reaches the threshold has so few edits that it must share
   n-grams at ``sure_places`` places of the item at least, wherever the edits
   are. So the most common places of an item may go unseeded, as long as ``NEED``
   of the sure ones are left; n-grams that an edit has broken take no other's place.
3. A seed is rare if at most ``MOST_ITEMS`` items have it, or as many as have the
   item's least shared one. Words that many items share, such as the form of a
   question, are no item's own: an alignment counts only if it holds a rare seed.
   Only rare seeds join, each with few items; others merely extend a passage.
4. Training passages around seeds are cut out where ``NEED`` seeded places are near
   (one, where no more are sure) and a rare seed is among them. Each passage is
   aligned with each item whose rare seed it has and enough words: local
   alignment of words, +2 for equal words, -1 for a replaced, added or missing
   one. The score is divided by that of the whole item, so 1 is a full copy
   and edited or paraphrased copies keep what their edits leave.
5. A document leaks an item if the best alignment around a rare seed holds one and
   scores ``threshold`` or more, and at least what ``least_words`` equal words
   score (or the whole of a shorter item).

What goes to every task are bitmaps of hashed n-grams, sized by their number up to
``MOST_BITS``; they only rule words out. The joins with the n-grams of items
are exact and shuffle by n-gram, so neither the number of items nor a passage
found in a third of all documents needs a bound. Texts are scanned twice, in
pieces of about a megabyte, and never shuffled; passages are.

Words are runs of letters, digits, ``_`` and non-ASCII characters in lower case.
Defined cases: null and empty texts and items share nothing; an item with fewer
than ``n`` words is its own only seed; with ``n = 3`` and a threshold of 0.5 or
more, what is found is what aligning every text with every item finds, but for
alignments without a rare seed (below that, short items may have no sure place
and are seeded with all they have);
repeated rows of a document or item give
one result per id pair; null ids are ids of their own; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import product
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import ROW, materialise, with_rows

N = 3
SKIP = 2
NEED = 2
MOST_ITEMS = 10
# Bits of a bitmap, as powers of two: the least and the most (16 MB); between, so many for each key.
LEAST_BITS, MOST_BITS, BITS_EACH = 24, 27, 256
MATCH, MISS, GAP = 2, -1, -1
# What a few words in common are worth says nothing about a short item: it takes this many, or all it has.
LEAST_WORDS = 5

_PRIME = 0x100000001B3
_PIECE = 1 << 20
_WORD = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_", np.uint8))
_WORD |= np.arange(256) >= 128
_WORD_BYTES = re.compile(rb"[0-9A-Za-z_\x80-\xff]+")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _piece_words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in a piece; no word spans a break."""
    inside = _WORD[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    at = breaks[(breaks > 0) & (breaks < len(data))]
    begins[at] = inside[at]
    ends[at - 1] = inside[at - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    size = end - start
    # A byte's power is its place in the word.
    place = np.arange(len(data)) - np.repeat(np.concatenate(([0], start)), np.diff(np.concatenate(([0], start, [len(data)]))))
    power = np.ones(int(size.max()) + 1, np.uint64)
    power[1:] = _PRIME
    power = np.multiply.accumulate(power)
    terms = np.where(inside, (data.astype(np.uint64) + np.uint64(1)) * power[np.minimum(place, len(power) - 1)], np.uint64(0))
    return start, end, _mix(np.add.reduceat(terms, start) + size.astype(np.uint64))


def batch_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of a batch of byte strings: ``(text number, start, end, hash)``; places are in the text."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    begin, last, found = int(offsets[0]), int(offsets[-1]), []
    while begin < last:
        end = min(begin + _PIECE, last)
        while end < last:  # cut where no word is cut
            step = np.flatnonzero(~_WORD[data[end : end + _PIECE]])
            next_text = int(offsets[np.searchsorted(offsets, end)])
            end = min(next_text, end + int(step[0]) if len(step) else min(end + _PIECE, last))
            if end == next_text or len(step):
                break
        low, high = np.searchsorted(offsets, begin, side="right"), np.searchsorted(offsets, end)
        start, stop, hashes = _piece_words(data[begin:end], offsets[low:high] - begin)
        found.append((start + begin, stop + begin, hashes))
        begin = end
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, np.uint64)
    start, stop, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    number = np.searchsorted(offsets, start, side="right") - 1
    return number, start - offsets[number], stop - offsets[number], hashes


def shapes(width: int) -> list[tuple[int, ...]]:
    """Places of the words of an n-gram, from its first: in a row, or with up to ``SKIP`` words skipped."""
    if width < 2:
        return [(0,)]
    steps = product(range(1, SKIP + 2), repeat=width - 1)
    return [tuple(sum(x[:k]) for k in range(width)) for x in steps if sum(x) <= width - 1 + SKIP]


def grams(number: np.ndarray, hashes: np.ndarray, shape: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """``(index of first word, hash)`` of every n-gram of a shape within one text."""
    last = len(hashes) - shape[-1]
    if last <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    value = np.full(last, len(shape), np.uint64)
    for k in shape:
        value = value * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + last]
    whole = np.flatnonzero(number[:last] == number[shape[-1] :])
    return whole, _mix(value[whole]).view(np.int64)


def least_score(size: int, threshold: float, least_words: int = LEAST_WORDS) -> int:
    """The score that an item of ``size`` words must reach."""
    return max(ceil(MATCH * size * threshold - 1e-9), MATCH * min(least_words, size))


def sure_places(size: int, n: int, threshold: float, least_words: int = LEAST_WORDS) -> int:
    """Places of an item that share an n-gram with any passage reaching the threshold, at least.

    With m equal words, a score of s leaves 2 m - s edits, in the m - 1 gaps between
    them. Each gap is in n - 1 of the m - n + 1 runs of n equal words, and a run with
    up to ``SKIP`` edits inside is an n-gram of some shape on both sides.
    """
    if size <= n:
        return 1
    score = least_score(size, threshold, least_words)
    return max(0, min(m - n + 1 - (n - 1) * (MATCH * m - score) // (SKIP + 1) for m in range(ceil(score / MATCH), size + 1)))


def _bytes(column) -> F.Column:
    return F.lower(F.coalesce(column, F.lit(""))).cast("binary")


def item_grams(items: DataFrame, text: str, n: int, threshold: float, least_words: int = LEAST_WORDS) -> DataFrame:
    """``(item, version, place, gram, width, size, spare, need)`` of every n-gram of every item.

    ``size`` is the item's number of words; of its places, the ``spare`` most common ones
    need no seed, and ``need`` of the others are in any passage that reaches the threshold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, _, _, hashes = batch_words(batch.column("text"))
            first = np.searchsorted(number, np.arange(batch.num_rows))
            size = np.bincount(number, minlength=batch.num_rows)
            parts = [(*grams(number, hashes, shape), n) for shape in shapes(n)]
            for width in range(1, n):  # items too short for an n-gram
                at, gram = grams(number, hashes, tuple(range(width)))
                short = size[number[at]] == width
                parts.append((at[short], gram[short], width))
            sure = np.array([sure_places(int(x), n, threshold, least_words) for x in size], np.int32)
            need = np.clip(sure, 1, NEED)
            spare = np.maximum(sure - need, 0)
            for at, gram, width in parts:
                which = number[at]
                columns = [batch.column("version").to_numpy()[which], at - first[which], gram, np.full(len(at), width), size[which], spare[which], need[which]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").take(pa.array(which))]
                    + [pa.array(x.astype(np.int64 if k in (0, 2) else np.int32)) for k, x in enumerate(columns)],
                    ["item", "version", "place", "gram", "width", "size", "spare", "need"],
                )

    rows = items.select("item", "version", _bytes(F.col(text)).alias("text"))
    kind = items.schema["item"].dataType.simpleString()
    return rows.mapInArrow(run, f"item {kind}, version long, place int, gram long, width int, size int, spare int, need int")


def bitmap(keys: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """A set of 64-bit keys, two bits each; at most ``2**most_bits / 64`` rows reach the driver."""
    bits = min(most_bits, max(LEAST_BITS, (BITS_EACH * keys.count()).bit_length()))
    slots = F.explode(F.array("gram", F.shiftright("gram", 32))).alias("gram")
    slot = F.col("gram").bitwiseAND((1 << bits) - 1)
    words = keys.select(slots).groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(gram & 63 as int))")).alias("bits")
    )
    rows = words.toArrow()
    held = np.zeros(1 << (bits - 6), np.int64)
    held[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return held.view(np.uint64)


def _is_set(held: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Whether a key may be in the set."""
    slots = np.uint64(64 * len(held) - 1)

    def bit(keys: np.ndarray) -> np.ndarray:
        slot = keys & slots
        return (held[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1

    keys = gram.view(np.uint64)
    there = bit(keys)
    there[there] = bit(keys[there] >> np.uint64(32))
    return there


def _matches(held, widths: list[int], n: int, number: np.ndarray, hashes: np.ndarray):
    for width in widths:
        for shape in shapes(n) if width == n else [tuple(range(width))]:
            at, gram = grams(number, hashes, shape)
            there = _is_set(held, gram)
            yield at[there], gram[there]


def _count(spark: SparkSession, docs: DataFrame, known: DataFrame, widths: list[int], n: int, most_bits: int) -> DataFrame:
    """``(gram, rows)``: occurrences in training texts of the n-grams that items have."""
    held = spark.sparkContext.broadcast(bitmap(known, most_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, _, _, hashes = batch_words(batch.column("text"))
            for _, gram in _matches(held.value, widths, n, number, hashes):
                values, times = np.unique(gram, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(times.astype(np.int64))], ["gram", "rows"])

    return docs.select("text").mapInArrow(run, "gram long, rows long").groupBy("gram").agg(F.sum("rows").alias("rows"))


def _seeds(ranked: DataFrame, most_items: int) -> DataFrame:
    """``(item, version, place, gram, need, rare)``: the n-grams at all places of an item but its ``spare`` most common ones."""
    places = ranked.groupBy("item", "version", "place", "spare", "need").agg(F.sum("rows").alias("rows"), F.collect_set("gram").alias("grams"))
    order = Window.partitionBy("item", "version").orderBy(F.desc("rows"), "place")  # at most as many rows as an item has words
    seeded = places.withColumn("rank", F.row_number().over(order)).filter("rank > spare")
    seeded = seeded.select("item", "version", "place", "need", F.explode("grams").alias("gram"))
    sharing = ranked.select("gram", "item", "version").distinct().groupBy("gram").agg(F.count("*").alias("items"))
    seeded = seeded.join(sharing, "gram")
    least = F.min("items").over(Window.partitionBy("item", "version"))
    return seeded.withColumn("rare", F.col("items") <= F.greatest(least, F.lit(most_items))).drop("items")


def _passages(spark: SparkSession, docs: DataFrame, seeds: DataFrame, widths: list[int], n: int, reach: int, most_bits: int, kind: str) -> DataFrame:
    """``(doc, first, words, at, gram)``: training passages that reach ``reach`` words around possible seeds, and where rare ones are.

    A seed of which an item needs several counts beside another place only.
    """
    held, lone, rare = (
        spark.sparkContext.broadcast(bitmap(frame, most_bits)) for frame in (seeds, seeds.filter("need = 1"), seeds.filter("rare"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            number, start, end, hashes = batch_words(texts)
            hits = list(_matches(held.value, widths, n, number, hashes))
            at, gram = np.concatenate([x[0] for x in hits]), np.concatenate([x[1] for x in hits])
            order = np.argsort(at, kind="stable")
            at, gram = at[order], gram[order]
            spots = np.unique(at)
            beside = (np.diff(spots) <= reach) & (number[spots[1:]] == number[spots[:-1]])
            beside = np.append(beside, False) | np.append(False, beside) if len(spots) else np.zeros(0, bool)
            kept = beside[np.searchsorted(spots, at)] | _is_set(lone.value, gram)
            kept &= _is_set(rare.value, gram)
            at, gram = at[kept], gram[kept]
            if not len(at):
                continue
            text = number[at]
            first_word = np.searchsorted(number, np.arange(batch.num_rows + 1))
            low = np.maximum(at - reach, first_word[text])
            high = np.minimum(at + reach, first_word[text + 1])
            apart = np.concatenate(([True], (text[1:] != text[:-1]) | (low[1:] > np.maximum.accumulate(high)[:-1])))
            cut = np.append(np.flatnonzero(apart), len(at))
            out = []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                k, lo, hi = int(text[a]), int(low[a]), int(high[a:b].max())
                begin = int(offsets[k])
                words = texts.buffers()[2][begin + int(start[lo]) : begin + int(end[hi - 1])].to_pybytes().decode("utf-8", "replace")
                out.append((k, lo - int(first_word[k]), words, at[a:b] - lo, gram[a:b]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(pa.array([x[0] for x in out])),
                    pa.array([x[1] for x in out], pa.int32()),
                    pa.array([x[2] for x in out]),
                    pa.array([x[3].astype(np.int32) for x in out], pa.list_(pa.int32())),
                    pa.array([x[4] for x in out], pa.list_(pa.int64())),
                ],
                ["doc", "first", "words", "at", "gram"],
            )

    return docs.mapInArrow(run, f"doc {kind}, first int, words string, at array<int>, gram array<long>")


def candidate_hits(passages: DataFrame, seeds: DataFrame) -> DataFrame:
    """``(passage, item, version, at, place)``: where a passage has a rare seed of an item."""
    hits = passages.select("passage", F.explode(F.arrays_zip("at", "gram")).alias("hit"))
    hits = hits.select("passage", F.col("hit.at").alias("at"), F.col("hit.gram").alias("gram"))
    return hits.join(seeds.filter("rare"), "gram").select("passage", "item", "version", "at", "place")


def align(passage: list[int], item: list[int]) -> tuple[int, int, int]:
    """Best local alignment: ``(score, first word, word after the last)`` in the passage."""
    if not passage or not item:
        return 0, 0, 0
    words = np.array(passage)
    ramp = np.arange(len(words) + 1) * -GAP
    above = np.zeros(len(words) + 1, np.int64)
    origin = np.arange(len(words) + 1)  # where the alignment that ends in a cell began
    best = (0, 0, 0)
    for word in item:
        diagonal = above[:-1] + np.where(words == word, MATCH, MISS)
        down = above[1:] + GAP
        cell = np.concatenate(([0], np.maximum(np.maximum(diagonal, down), 0)))
        begun = np.concatenate(([0], np.where(diagonal >= down, origin[:-1], origin[1:])))
        begun = np.where(cell > 0, begun, np.arange(len(cell)))
        lifted = cell + ramp
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(len(cell)), 0))
        above, origin = top - ramp, begun[source]
        k = int(above.argmax())
        if above[k] > best[0]:
            best = (int(above[k]), int(origin[k]), k)
    return best


def _align_batches(batches: Iterator[pa.RecordBatch], threshold: float, least_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for passage, item, near, held_at, first in zip(*(batch.column(c).to_pylist() for c in ("words", "text", "near", "held_at", "first"))):
            numbers: dict[bytes, int] = {}
            b = [numbers.setdefault(w, len(numbers)) for w in _WORD_BYTES.findall(item.lower().encode())]
            a = [numbers.get(w, -1) for w in _WORD_BYTES.findall(passage.encode())]
            best = (0, 0, 0)
            # Around each expected begin of the item; neighbours share one alignment.
            reach, begin, end = 2 * len(b) + 2, None, None
            spans: list[tuple[int, int]] = []
            for place in sorted(near):
                low, high = max(0, place - len(b)), min(len(a), place + reach)
                if begin is None or low > end:
                    if begin is not None:
                        spans.append((begin, end))
                    begin, end = low, high
                else:
                    end = max(end, high)
            spans.append((begin, end))
            least = least_score(len(b), threshold, least_words)
            wanted = Counter(b)
            for low, high in spans:
                # No alignment has more equal words than both sides have in common.
                held = Counter(a[low:high])
                if MATCH * sum(min(times, held[word]) for word, times in wanted.items()) < least:
                    continue
                score, start, stop = align(a[low:high], b)
                if score > best[0] and any(low + start <= place < low + stop for place in held_at):
                    best = (score, low + start, low + stop)
            enough = best[0] >= MATCH * min(least_words, len(b))
            out.append((best[0] / (MATCH * len(b)) if enough and b else 0.0, first + best[1], first + best[2]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc"),
                batch.column("item"),
                pa.array([x[0] for x in out], pa.float64()),
                pa.array([x[1] for x in out], pa.int32()),
                pa.array([x[2] for x in out], pa.int32()),
                batch.column("seeds"),
            ],
            ["doc", "item", "score", "first_word", "end_word", "seeds"],
        )


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.5,
    n: int = N,
    most_items: int = MOST_ITEMS,
    least_words: int = LEAST_WORDS,
    most_bits: int = MOST_BITS,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, score, first_word, end_word, seeds)`` of every leaked item, best passage each.

    ``first_word`` and ``end_word`` bound the aligned words in the document.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc"), _bytes(F.col(text)).alias("text"))
    items = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text"))
    doc_kind, item_kind = (x.schema[0].dataType.simpleString() for x in (docs, items))
    # Texts that share an id are items of their own until their documents are named.
    items = items.filter("text is not null").distinct().withColumn("version", F.xxhash64("text"))
    places = materialise(item_grams(items, "text", n, threshold, least_words), "item-grams")
    widths = sorted(row[0] for row in places.select("width").distinct().collect())  # at most n numbers
    reach = 2 * (places.agg(F.max("size")).first()[0] or 1)
    result = "doc_id, item_id, score, first_word, end_word, seeds"
    if not widths:
        empty = f"doc_id {doc_kind}, item_id {item_kind}, score double, first_word int, end_word int, seeds int"
        return spark.createDataFrame([], empty)
    counts = _count(spark, docs, places, widths, n, most_bits)
    ranked = places.join(counts, "gram", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    seeds = materialise(_seeds(ranked, most_items), "seeds")
    passages = materialise(_passages(spark, docs, seeds, widths, n, reach, most_bits, doc_kind), "passages")
    passages = passages.withColumn("passage", F.xxhash64("doc", "first", "words"))
    near = candidate_hits(passages, seeds).groupBy("passage", "item", "version").agg(
        F.collect_set(F.col("at") - F.col("place")).alias("near"),
        F.collect_set("at").alias("held_at"),
        F.size(F.collect_set("place")).alias("seeds"),
    )
    cut = passages.select("passage", "doc", "first", "words").dropDuplicates(["passage"])
    pairs = near.join(cut, "passage")
    texts = items.select(F.col("item").alias("_item"), F.col("version").alias("_version"), "text")
    pairs = pairs.join(texts, F.col("item").eqNullSafe(F.col("_item")) & (F.col("version") == F.col("_version")))
    pairs = pairs.select("doc", "item", "first", "words", "text", "near", "held_at", "seeds")
    aligned = pairs.mapInArrow(
        lambda batches: _align_batches(batches, threshold, least_words), f"doc {doc_kind}, item {item_kind}, score double, first_word int, end_word int, seeds int"
    )
    found = aligned.filter(F.col("score") >= threshold).groupBy("doc", "item").agg(
        F.max(F.struct("score", "seeds", "first_word", "end_word")).alias("best")
    )
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "best.*").selectExpr(*result.split(", "))


def drop_leaks(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that leak no item; each row is judged by itself, whatever its id."""
    rows = with_rows(docs)
    named = rows.withColumn("__row", F.struct(*ROW))
    leaked = find_leaks(named, items, doc_id="__row", **how).select("doc_id.*").distinct()
    return rows.join(leaked, list(ROW), "left_anti").drop(*ROW)

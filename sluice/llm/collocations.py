"""Phrases of two to five words that stand together more often than their parts would.

Counting follows the vertical partitioning of disk-based suffix trees. A suffix
is what follows a word within its piece of text, cut after five words. Suffixes
are partitioned by a prefix of words that is as long as needed for its suffixes
to fit a budget; a group of prefixes is one task's share, whose truncated suffix
subtrees are built independently of all others, and a phrase's count is the sum
of the leaves below its node.

Only frequent phrases matter, so the partition is also a sieve. Words are counted
first, then pairs of frequent words; a suffix ends at the first pair that is not
frequent, and one that starts with such a pair is not shuffled at all. Tasks know
the frequent words and pairs by bitmaps of a bounded size, whose errors only let
more through; pairs are counted by 64-bit hashes for that, which are never
spelled. Prefixes start as pairs and grow by a word while they exceed the
budget, a share of all suffixes below which few prefixes can be.

A group's suffixes arrive sorted, so its subtrees are built depth first with one
open path of five nodes, in constant memory whatever the group's size.

Defined cases: null texts are empty; a null language is ``und``, like that word
itself; repeated rows count each; overlapping occurrences count; words may hold
any character but white space and the seven that end a piece; an empty table, or
one without a frequent phrase, gives no rows; extra columns are not read. A task
holds one long text at a time.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import as_bytes, materialise

LEAST = 100
LONGEST = 5
RANKS = 2_000
UNKNOWN = "und"

# Bits of the bitmaps of frequent words and pairs: so many for each, a power of two, at most 16 MB.
BITS_EACH = 32
MOST_BITS = 1 << 27
CHUNK_BITS = 8 * 4_096  # bits of one value of Spark's bitmap functions

# A prefix is extended beyond this number of suffixes and this share of all of them.
BUDGET = 250_000
SHARES = 10_000

# Words that a task looks at together, and distinct ones whose frequency it remembers.
BLOCK_WORDS = 2_000_000
HELD_WORDS = 200_000


# -- words -------------------------------------------------------------------


def translate_table() -> bytes:
    """Lowers A-Z and turns all ends of pieces into full stops."""
    table = bytearray(range(256))
    for letter in range(26):
        table[ord("A") + letter] = ord("a") + letter
    for end in b",;:!?\n\x0b\x0c\r":
        table[end] = ord(".")
    return bytes(table)


END = b"."
PART_BYTES = 1 << 22


def parts(text: bytes, table: bytes = translate_table()) -> Iterator[list[bytes]]:
    """Words, and ``END`` between pieces, of one part of a long text after the other; parts begin with a piece.

    Of all white space only blanks and tabs are left to split at.
    """
    text, start = text.translate(table), 0
    while start < len(text):
        end = text.find(END, start + PART_BYTES)
        end = len(text) if end < 0 else end
        yield text[start:end].replace(END, b" . ").split()
        start = end


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), as_bytes("text").alias("text"))


def _phrases(lang: str, phrases: list[bytes], counts: list[int] | np.ndarray) -> pa.RecordBatch:
    names = pa.array(phrases, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(names), pa.string()), names, pa.array(counts, pa.int64())], ["lang", "phrase", "f"]
    )


COUNTS = "lang string, phrase string, f long"
MARKS = "mark long, f long"
SUFFIXES = f"{COUNTS}, heavy boolean"


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = translate_table()
    counts: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for lang, text in zip(*batch.columns):
            lang = lang.as_py()
            for words in parts(text.as_py(), table):
                counts[lang].update(words)
                if sum(map(len, counts.values())) > HELD_WORDS:
                    yield from _flush(counts)
    yield from _flush(counts)


def _flush(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, held in counts.items():
        held.pop(END, None)
        yield _phrases(lang, list(held), list(held.values()))
    counts.clear()


def word_counts(docs: DataFrame) -> DataFrame:
    """``(lang, phrase, f)`` of all words; a phrase is written with a blank between words."""
    return _rows(docs).mapInArrow(_count_words, COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


# -- bitmaps -------------------------------------------------------------------


def _mark(lang: bytes, phrase: bytes) -> int:
    return zlib.crc32(lang + b"\n" + phrase)


@dataclass
class Bitmap:
    """Which phrases may be frequent, by the CRC of language and phrase."""

    chunks: dict[int, bytes]
    bits: int

    def bytes(self) -> np.ndarray:
        whole = np.zeros((self.bits // CHUNK_BITS, CHUNK_BITS // 8), np.uint8)
        for at, chunk in self.chunks.items():
            whole[at] = np.frombuffer(chunk, np.uint8)
        return whole.reshape(-1)


def holds(whole: np.ndarray, marks: np.ndarray) -> np.ndarray:
    at = marks % (8 * len(whole))
    return (whole[at >> 3] >> (at & 7) & 1).astype(bool)


def bitmap(phrases: DataFrame, each: int = BITS_EACH, most: int = MOST_BITS) -> Bitmap:
    """Of phrases, or of ``mark`` if they are given by numbers.

    Built by tasks; the driver gets at most ``most`` bits, however many phrases there are.
    """
    bits = min(most, 1 << math.ceil(math.log2(max(CHUNK_BITS, each * phrases.count()))))
    if "mark" in phrases.columns:
        mark = F.col("mark")
    else:
        mark = F.crc32(F.concat(F.col("lang").cast("binary"), F.lit(b"\n"), F.col("phrase").cast("binary")))
    at = F.pmod(mark, F.lit(bits))
    chunk, place = F.floor(at / CHUNK_BITS), at % CHUNK_BITS
    rows = phrases.groupBy(chunk.alias("chunk")).agg(F.bitmap_construct_agg(place).alias("bits")).toArrow()
    return Bitmap(dict(zip(rows["chunk"].to_pylist(), rows["bits"].to_pylist())), bits)


# -- suffixes ------------------------------------------------------------------


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Numbering(dict):
    """Numbers for the words of a language that may be frequent, -1 for others.

    By number there are the words and 64-bit hashes of language and word.
    """

    def __init__(self, lang: str, frequent: np.ndarray):
        super().__init__({END: -1})
        self.lang, self.frequent, self.words, self.hashes = lang.encode(), frequent, [], []

    def __missing__(self, word: bytes) -> int:
        number, mark = -1, _mark(self.lang, word)
        at = mark % (8 * len(self.frequent))
        if self.frequent[at >> 3] >> (at & 7) & 1:
            number = len(self.words)
            self.words.append(word)
            self.hashes.append(int.from_bytes(hashlib.blake2b(self.lang + b"\n" + word, digest_size=8).digest(), "little"))
        self[word] = number
        return number

    def pairs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where a word and the next may both be frequent, and a 64-bit hash of the pair there."""
        at = np.flatnonzero((numbers[:-1] >= 0) & (numbers[1:] >= 0))
        hashes = np.array(self.hashes, np.uint64)
        return at, ((hashes * MULTIPLIER)[numbers[at]] ^ hashes[numbers[at + 1]]).view(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[tuple[Numbering, np.ndarray]]:
    """Numbers of words in order, texts parted by -1, in blocks of one language."""
    table = translate_table()
    known: dict[str, Numbering] = {}
    held: dict[str, list[np.ndarray]] = defaultdict(list)
    sizes: Counter = Counter()

    def done(lang: str) -> tuple[Numbering, np.ndarray]:
        numbering = known[lang]
        if len(numbering) > HELD_WORDS:
            del known[lang]
        del sizes[lang]
        return numbering, np.concatenate(held.pop(lang))

    for batch in batches:
        for lang, text in zip(*batch.columns):
            lang = lang.as_py()
            for words in parts(text.as_py(), table):
                if lang not in known:
                    known[lang] = Numbering(lang, frequent)
                words.append(END)
                held[lang].append(np.fromiter(map(known[lang].__getitem__, words), np.int64, len(words)))
                sizes[lang] += len(words)
                if sizes[lang] > BLOCK_WORDS:
                    yield done(lang)
    for lang in list(held):
        yield done(lang)


def _count_pairs(words: Bitmap):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbering, numbers in _blocks(batches, words.bytes()):
            marks, counts = np.unique(numbering.pairs(numbers)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(marks), pa.array(counts, pa.int64())], ["mark", "f"])

    return scan


def distinct_rows(columns: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct row of ``columns`` is first, and how many there are; values from -1 on, of ``width`` bits with one added.

    Rows are numbers of as many columns as 63 bits hold, and these are numbered
    anew where one more does not fit.
    """
    number, bits = columns[0] + 1, width
    for column in columns[1:]:
        if bits + width > 63:
            number = np.unique(number, return_inverse=True)[1]
            bits = len(number).bit_length()
        number = number << width | (column + 1)
        bits += width
    return np.unique(number, return_index=True, return_counts=True)[1:]


def _suffixes(words: Bitmap, pairs: Bitmap, heavy: np.ndarray):
    """Distinct suffixes of a block, each word followed by a blank, that begin with a pair that may be frequent.

    And whether that pair's hash is among ``heavy``.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = pairs.bytes()
        for numbering, numbers in _blocks(batches, words.bytes()):
            at, marks = numbering.pairs(numbers)
            good = holds(may, marks)
            link = np.zeros(len(numbers) + LONGEST, bool)  # this word and the next make a pair that may be frequent
            starts = at[good]
            link[starts] = True
            padded = np.concatenate([numbers, np.full(LONGEST, -1)])
            # -1 stands behind the end of a suffix.
            going = np.ones(len(starts), bool)
            columns = [padded[starts]]
            for k in range(1, LONGEST):
                going &= link[starts + k - 1]
                columns.append(np.where(going, padded[starts + k], -1))
            first, counts = distinct_rows(columns, len(numbering.words).bit_length())
            spelled = [*[word + b" " for word in numbering.words], b""]
            suffixes = [b"".join(map(spelled.__getitem__, row)) for row in np.stack([c[first] for c in columns], axis=1).tolist()]
            rows = _phrases(numbering.lang.decode(), suffixes, counts)
            yield rows.append_column("heavy", pa.array(np.isin(marks[good][first], heavy)))

    return scan


# -- vertical partition and subtrees --------------------------------------------


def _prefix(words: int) -> Column:
    """The first words of a suffix, with the blank behind each; the suffix itself if it has no more."""
    return F.concat(F.rtrim(F.substring_index("phrase", " ", words)), F.lit(" "))


def _prefixes(suffixes: DataFrame, budget: int) -> DataFrame:
    """Name each suffix's prefix: two words, or as many as it takes to fit the budget.

    Of ``heavy`` pairs, and of longer prefixes each, no more than n / budget can
    exceed it, which is what allows broadcasting those.
    """
    placed = suffixes.withColumn("prefix", F.when(F.col("heavy"), _prefix(3)).otherwise(_prefix(2)))
    for words in range(4, LONGEST + 1):
        sums = placed.filter(F.col("heavy") & (F.col("prefix") != F.col("phrase"))).groupBy("lang", "prefix").agg(F.sum("f").alias("f"))
        heavy = materialise(sums.filter(F.col("f") > budget).select("lang", "prefix"), "heavy-prefixes", files=1)
        if heavy.isEmpty():
            break
        placed = placed.drop("heavy").join(F.broadcast(heavy.withColumn("heavy", F.lit(True))), ["lang", "prefix"], "left")
        placed = placed.withColumn("prefix", F.when(F.col("heavy"), _prefix(words)).otherwise(F.col("prefix")))
    return placed


def subtrees(suffixes: Iterator[tuple[str, bytes, bytes, int]], least: int) -> Iterator[tuple[str, bytes, int]]:
    """Nodes ``(lang, phrase, f)`` of two words and more, from sorted ``(lang, prefix, suffix, f)``.

    Depth first: a node is open while suffixes go through it, and what a closed
    one counted is added to its parent. A node below its prefix is whole and kept
    if it is frequent; the prefix and what is above it may be parts, to be summed.
    """
    path: list[bytes] = []
    counts: list[int] = []
    tree: tuple[str, bytes] | None = None
    depth = 0

    def close(length: int) -> Iterator[tuple[str, bytes, int]]:
        while len(path) > length:
            f = counts.pop()
            if len(path) >= 2 and (f >= least or len(path) <= depth):
                yield tree[0], b" ".join(path), f
            path.pop()
            if counts:
                counts[-1] += f

    for lang, prefix, suffix, f in suffixes:
        words = suffix.split()
        if tree != (lang, prefix):
            yield from close(0)
            tree, depth = (lang, prefix), len(prefix.split())
        shared = 0
        while shared < len(path) and shared < len(words) and path[shared] == words[shared]:
            shared += 1
        yield from close(shared)
        for word in words[shared:]:
            path.append(word)
            counts.append(0)
        counts[-1] += f
    yield from close(0)


def _grow(least: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[str, bytes, bytes, int]]:
            for batch in batches:
                yield from zip(*(column.to_pylist() for column in batch.columns))

        nodes: list[tuple[str, bytes, int]] = []
        for node in subtrees(rows(), least):
            nodes.append(node)
            if len(nodes) >= 10_000:
                yield _nodes(nodes)
                nodes = []
        if nodes:
            yield _nodes(nodes)

    return scan


def _nodes(nodes: list[tuple[str, bytes, int]]) -> pa.RecordBatch:
    langs, phrases, counts = zip(*nodes)
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
        ["lang", "phrase", "f"],
    )


def phrase_counts(docs: DataFrame, least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, f)`` of all phrases of up to five words with f >= least, and ``(lang, n)``; both written out."""
    rows = _rows(docs)
    words = materialise(word_counts(docs), "words")
    sizes = materialise(words.groupBy("lang").agg(F.sum("f").alias("n")), "sizes", files=1)
    frequent = words.filter(F.col("f") >= least)
    word_bits = bitmap(frequent)

    pairs = rows.mapInArrow(_count_pairs(word_bits), MARKS).groupBy("mark").agg(F.sum("f").alias("f"))
    pairs = materialise(pairs.filter(F.col("f") >= least), "pairs")
    total = pairs.agg(F.sum("f")).first()[0] or 0
    budget = max(budget, total // SHARES)
    # At most ``SHARES`` numbers.
    heavy = np.array([row["mark"] for row in pairs.filter(F.col("f") > budget).select("mark").collect()], np.int64)
    suffixes = materialise(rows.mapInArrow(_suffixes(word_bits, bitmap(pairs), heavy), SUFFIXES), "suffixes")

    groups = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // budget))
    placed = _prefixes(suffixes, budget) if len(heavy) else suffixes.withColumn("prefix", _prefix(2))
    placed = placed.select("lang", "prefix", "phrase", "f").repartition(groups, "lang", "prefix")
    dealt = placed.groupBy("lang", "prefix", "phrase").agg(F.sum("f").alias("f")).sortWithinPartitions("lang", "prefix", "phrase")
    nodes = dealt.select("lang", F.col("prefix").cast("binary"), F.col("phrase").cast("binary"), "f").mapInArrow(_grow(least), COUNTS)
    longer = nodes.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return materialise(frequent.unionByName(longer), "phrase-counts"), sizes


# -- scores --------------------------------------------------------------------


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(15,0)")


def collocations(docs: DataFrame, least: int = LEAST, ranks: int = RANKS, budget: int = BUDGET) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first phrases by score.

    A phrase counts by the cut for which ``1000 * a * n / (l * r)`` is lowest;
    products are decimals of 38 digits. Phrases inside a longer one with the same
    count are left out.
    """
    counts, sizes = phrase_counts(docs, least, budget)
    words = F.split("phrase", " ")
    longer = counts.filter(F.contains("phrase", F.lit(" "))).select("lang", "phrase", F.col("f").alias("a"), words.alias("words"))

    # Every part of a phrase that is a phrase itself, but the whole.
    size = F.size("words")
    parts = F.flatten(
        F.transform(
            F.sequence(F.lit(1), size - 1),
            lambda start: F.transform(
                F.sequence(start + 1, size), lambda end: F.array_join(F.slice("words", start, end - start + 1), " ")
            ),
        )
    )
    inside = longer.select("lang", F.explode(parts).alias("phrase"), "a", F.col("phrase").alias("whole")).filter("phrase <> whole")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("within"))

    cut = longer.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cut = cut.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("words", 1, F.col("k")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("k") + 1, size - F.col("k")), " ").alias("tail"),
    )
    for part, name in (("head", "l"), ("tail", "r")):
        cut = cut.join(counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    cut = cut.join(sizes, "lang")
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (_exact("a") * _exact("n")), _exact("l") * _exact("r"))
    best = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    kept = best.join(inside, ["lang", "phrase"], "left").filter(F.coalesce(F.col("within"), F.lit(0)) < F.col("a"))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    # A language may have most phrases: ranked in shares first.
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))).filter(F.col("rank") <= ranks)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return kept.filter(F.col("rank") <= ranks).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

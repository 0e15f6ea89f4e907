"""Exact nearest vectors by inner product, through a vector-approximation file.

Vectors are turned into integers, and equal ones into one class. Each component
is then quantised to one of 32 cells between the extremes of all vectors, narrow
where a bounded sample has most of its values; the file of cells, five bits a
component, is what a search scans.

A cell bounds a component from both sides, hence cells bound an inner product.
Queries come in rounds of a bounded number of components, which travel with the
tasks. Of each round

1. a scan of the cells finds the k-th best lower bound of each query,
2. a second one keeps the classes whose upper bound reaches it,
3. exact vectors are read in the order of upper bounds: first a few, whose k-th
   score then rules out all classes that cannot reach it, then those that remain.

No class that could be among the best is left out: bounds hold for any marks.
Ties go to the smaller id, in the pruning as well, so that classes which merely
tie are not read. A class stands for any number of rows, of which a query can
only need the first k + 1; so copies never meet each other in pairs, and the
answer of a class serves all its query rows, each without itself.

Defined cases: vectors that are null or hold null or non-finite components take
no part; vectors of different lengths count as filled up with zeros, an empty
one as zeros; rows that repeat an id are rows of their own; a null id is a
candidate after all others and no query; an empty table gives no rows; extra
columns are not read. Scores beyond 64 bits are cut off there; sums of products
beyond 53 bits widen the bounds by their rounding error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import ROW, materialise, with_rows

K = 20
SCALE = 64
BITS = 5
CELLS = 1 << BITS

# Rows whose means and deviations set the marks, components of the queries in a round, and bounds computed at once.
SAMPLE_ROWS = 4_096
ROUND_COMPONENTS = 1 << 22
BLOCK_BOUNDS = 1 << 22

# Exact vectors read first, as a multiple of the results wanted.
FIRST_READS = 3

LAST = 2**63 - 1


def integers(vector: str | Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component; null if the vector or a component is not finite."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    infinity = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinity))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")))


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    lengths = pc.list_value_length(vectors).to_numpy()
    values = vectors.flatten().to_numpy()
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    filled = np.zeros((len(lengths), width), np.int64)
    filled[np.arange(width) < lengths[:, None]] = values
    return filled


# -- the file ----------------------------------------------------------------


def classes(rows: DataFrame, members: int) -> DataFrame:
    """Distinct vectors ``(key, ints, first_id, members)`` of rows ``(key, ints, id, row)``, written out.

    ``members`` are the first rows of a class, by id; they are cut before the shuffle.
    """
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("id", *ROW)))
    first = ranked.filter(F.col("rank") <= members).groupBy("key")
    member = F.struct("id", *ROW)
    return materialise(
        first.agg(F.any_value("ints").alias("ints"), F.min("id").alias("first_id"), F.sort_array(F.collect_list(member)).alias("members")),
        "vector-classes",
    )


def _extremes(width: int) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows and width:
                ints = _matrix(batch.column(0), width)
                lows, highs = ints.min(axis=0), ints.max(axis=0)
                low = lows if low is None else np.minimum(low, lows)
                high = highs if high is None else np.maximum(high, highs)
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(low), pa.array(high)], ["at", "low", "high"])

    return scan


class Marks:
    """The cells of each component: ``low[d, j]`` to ``high[d, j]``, both included."""

    def __init__(self, sample: np.ndarray, low: np.ndarray, high: np.ndarray):
        width = len(low)
        self.low = np.empty((width, CELLS), np.int64)
        self.high = np.empty((width, CELLS), np.int64)
        self.starts = []
        # Marks of a normal variable with the least expected error: those of one with the third power of its variance.
        steps = [NormalDist().inv_cdf(j / CELLS) * 3**0.5 for j in range(1, CELLS)]
        for d in range(width):
            values = sample[:, d].astype(float)
            cuts = np.ceil(values.mean() + values.std() * np.array(steps)) if len(values) else np.zeros(0)
            starts = np.unique([low[d], *(int(c) for c in cuts if low[d] < c <= high[d])]).astype(np.int64)
            ends = np.append(starts[1:] - 1, high[d])
            self.starts.append(starts)
            self.low[d] = np.append(starts, np.full(CELLS - len(starts), starts[-1]))
            self.high[d] = np.append(ends, np.full(CELLS - len(ends), ends[-1]))

    def cells(self, ints: np.ndarray) -> np.ndarray:
        cells = np.zeros(ints.shape, np.uint8)
        for d, starts in enumerate(self.starts):
            cells[:, d] = np.searchsorted(starts, ints[:, d], side="right") - 1
        return cells


def pack(cells: np.ndarray) -> np.ndarray:
    """``BITS`` bits a cell, row by row filled up to whole bytes."""
    bits = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - BITS :]
    return np.packbits(bits.reshape(len(cells), -1), axis=1)


def unpack(packed: np.ndarray, width: int) -> np.ndarray:
    bits = np.unpackbits(packed, axis=1, count=width * BITS).reshape(len(packed), width, BITS)
    return bits @ (1 << np.arange(BITS, dtype=np.uint8)[::-1])


def measure(vectors: DataFrame) -> Marks:
    """Marks from the extremes of all vectors and the spread of at most ``SAMPLE_ROWS``."""
    width = vectors.agg(F.max(F.size("ints"))).first()[0] or 0
    found = vectors.select("ints").mapInArrow(_extremes(width), "at long, low long, high long")
    extremes = found.groupBy("at").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("at").toArrow()
    sample = vectors.select("key", "ints").orderBy("key").limit(SAMPLE_ROWS).toArrow()["ints"].combine_chunks()
    low, high = (extremes[name].to_numpy() for name in ("low", "high"))
    return Marks(_matrix(sample, width) if len(sample) else np.zeros((0, width), np.int64), low, high)


def approximate(vectors: DataFrame, marks: Marks) -> DataFrame:
    """The approximation file ``(key, first_id, cells)``, written out."""
    width = len(marks.low)

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = pack(marks.cells(_matrix(batch.column(2), width)))
            cells = pa.array([row.tobytes() for row in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cells], ["key", "first_id", "cells"])

    return materialise(vectors.select("key", "first_id", "ints").mapInArrow(quantise, "key binary, first_id long, cells binary"), "approximations")


# -- bounds --------------------------------------------------------------------


class Bounds:
    """Bounds of the inner products of a round's queries with the cells of a batch."""

    def __init__(self, queries: np.ndarray, marks: Marks):
        reach = np.maximum(np.abs(marks.low.astype(float)), np.abs(marks.high.astype(float))).max(axis=1, initial=0)
        most = (np.abs(queries.astype(float)) @ reach).max(initial=0)
        self.kind = np.float32 if most < 2**24 else np.float64
        self.slack = 0.0 if most < 2**53 else most * 2.0**-50 * (queries.shape[1] + 4)
        self.queries = queries.astype(self.kind)
        self.low = marks.low.astype(self.kind)
        self.span = (marks.high - marks.low).astype(self.kind)

    def blocks(self, packed: pa.BinaryArray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """``(queries, cells' low corners, cells' spans)`` by blocks of queries."""
        width = len(self.low)
        raw = np.frombuffer(b"".join(packed.to_pylist()), np.uint8).reshape(len(packed), -1)
        cells, at = unpack(raw, width), np.arange(width)
        low, span = self.low[at, cells].T, self.span[at, cells].T
        step = max(1, BLOCK_BOUNDS // max(1, len(cells)))
        for start in range(0, len(self.queries), step):
            yield slice(start, start + step), low, span

    def lower(self, part: slice, low: np.ndarray, span: np.ndarray) -> np.ndarray:
        queries = self.queries[part]
        return queries @ low + np.minimum(queries, 0) @ span - self.slack

    def upper(self, part: slice, low: np.ndarray, span: np.ndarray) -> np.ndarray:
        queries = self.queries[part]
        return queries @ low + np.maximum(queries, 0) @ span + self.slack


def _best_lower(bounds: Bounds, k: int) -> Callable:
    """Each query's ``k`` best lower bounds in a task's share of the file."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(bounds.queries), k), -np.inf)
        for batch in batches:
            if batch.num_rows:
                for part, low, span in bounds.blocks(batch.column(0)):
                    lower = bounds.lower(part, low, span)
                    if lower.shape[1] > k:
                        lower = np.partition(lower, lower.shape[1] - k, axis=1)[:, -k:]
                    joined = np.hstack([best[part], lower])
                    best[part] = np.partition(joined, joined.shape[1] - k, axis=1)[:, -k:]
        for start in range(0, len(best), 10_000):
            some = best[start : start + 10_000]
            ends = pa.array(np.arange(0, some.size + 1, k), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(some.reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(start, start + len(some))), lists], ["query", "bounds"])

    return scan


def _reach(bounds: Bounds, least: np.ndarray) -> Callable:
    """Pairs of a query and a class whose upper bound is at least the query's ``least``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for part, low, span in bounds.blocks(batch.column(2)):
                    upper = bounds.upper(part, low, span)
                    query, at = np.nonzero(upper >= least[part, None])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(query + part.start),
                            batch.column(0).take(pa.array(at)),
                            batch.column(1).take(pa.array(at)),
                            pa.array(upper[query, at].astype(float)),
                        ],
                        ["query", "key", "first_id", "upper"],
                    )

    return scan


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, cut off at 64 bits."""
    most = (np.abs(left.astype(float)) * np.abs(right.astype(float))).sum(axis=1).max(initial=0)
    if most < 2**62:
        return np.einsum("ij,ij->i", left, right)
    sums = (left.astype(object) * right.astype(object)).sum(axis=1)
    return np.array([min(max(int(s), -LAST), LAST) for s in sums], np.int64)


def _score(queries: np.ndarray) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            query = batch.column(0).to_numpy()
            scores = exact_products(queries[query], _matrix(batch.column(3), queries.shape[1]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(scores, pa.int64())], ["query", "key", "first_id", "score"])

    return scan


# -- the search ------------------------------------------------------------------


def _first(pairs: DataFrame, by: str, n: int) -> DataFrame:
    """The first ``n`` classes of each query by ``by`` descending, then id; cut before the shuffle too."""
    order = Window.partitionBy("query").orderBy(F.desc(by), "first_id", "key")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _search_round(vectors: DataFrame, approximations: DataFrame, queries: np.ndarray, marks: Marks, k: int) -> DataFrame:
    """``(query, key, score)``: the best ``k`` classes of each query."""
    bounds = Bounds(queries, marks)
    lower = approximations.select("cells").mapInArrow(_best_lower(bounds, k), "query long, bounds array<double>")
    kth = F.element_at(F.sort_array(F.flatten(F.collect_list("bounds")), asc=False), k)
    found = lower.groupBy("query").agg(kth.alias("least")).toArrow()
    least = np.full(len(queries), -np.inf)
    least[found["query"].to_numpy()] = found["least"].to_numpy()

    columns = "query long, key binary, first_id long"
    reached = approximations.select("key", "first_id", "cells").mapInArrow(_reach(bounds, least), f"{columns}, upper double")
    reached = materialise(reached, "reached")

    def read(pairs: DataFrame) -> DataFrame:
        exact = pairs.select("query", "key", "first_id").join(vectors.select("key", "ints"), "key")
        return exact.select("query", "key", "first_id", "ints").mapInArrow(_score(queries), f"{columns}, score long")

    first = materialise(_first(reached, "upper", FIRST_READS * k).select("query", "key", "first_id"), "first-reads")
    scored = materialise(read(first), "first-scores")
    certain = _first(scored, "score", k).filter(F.col("rank") == k)
    certain = certain.select("query", F.col("score").alias("kth"), F.col("first_id").alias("kth_id"))
    possible = F.col("kth").isNull() | (F.col("upper") > F.col("kth")) | ((F.col("upper") == F.col("kth")) & (F.col("first_id") <= F.col("kth_id")))
    later = reached.join(certain, "query", "left").filter(possible).join(first, ["query", "key"], "left_anti")
    return _first(scored.unionByName(read(later)), "score", k).select("query", "key", "score")


def top_k(vectors: DataFrame, k: int = K, query_every: int = 20, vector_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of highest score for each row whose id ``query_every`` divides."""
    spark = vectors.sparkSession
    rows = with_rows(vectors).select(F.col(vector_id).cast("long").alias("vec_id"), integers(vector).alias("ints"), *ROW)
    rows = rows.filter(F.col("ints").isNotNull()).select(
        F.unhex(F.sha2(F.to_json("ints"), 256)).alias("key"), "ints", F.coalesce("vec_id", F.lit(LAST)).alias("id"), "vec_id", *ROW
    )
    rows = materialise(rows, "integer-vectors")
    asking = rows.filter(F.col("vec_id") % query_every == 0)
    found = classes(rows.select("key", "ints", "id", *ROW), k + 1)
    marks = measure(found)
    approximations = approximate(found, marks)

    wanted = materialise(asking.groupBy("key").agg(F.any_value("ints").alias("ints")), "query-classes")
    width = len(marks.low)
    rounds = -(-wanted.count() * max(1, width) // ROUND_COMPONENTS)
    answers = []
    for n in range(rounds):
        part = wanted.filter(F.pmod(F.xxhash64("key"), F.lit(rounds)) == n).orderBy("key").toArrow()
        if part.num_rows == 0:
            continue
        keys = part["key"].combine_chunks()
        best = _search_round(found, approximations, _matrix(part["ints"].combine_chunks(), width), marks, k + 1)
        answers.append(materialise(_named(best, keys).join(found.select("key", "members"), "key"), "answers"))
    if not answers:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    answer = F.struct((-F.col("score")).alias("cost"), "member.id", *(f"member.{c}" for c in ROW), "score")
    ranked = reduce(DataFrame.unionByName, answers).select("asked", "score", F.explode("members").alias("member"))
    ranked = ranked.groupBy("asked").agg(F.slice(F.sort_array(F.collect_list(answer)), 1, k + 1).alias("answers"))

    own = [F.col(c).alias("own" + c) for c in ROW]
    met = asking.select(F.struct("key").alias("asked"), F.col("vec_id").alias("query_id"), *own)
    met = met.join(ranked.select(F.struct(F.col("asked").alias("key")).alias("asked"), "answers"), "asked")
    others = F.filter("answers", lambda a: (a[ROW[0]] != F.col("own" + ROW[0])) | (a[ROW[1]] != F.col("own" + ROW[1])))
    met = met.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "answer"))
    return met.select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.nullif("answer.id", F.lit(LAST)).alias("vec_id"),
        F.col("answer.score").alias("score"),
    )


def _named(pairs: DataFrame, keys: pa.Array) -> DataFrame:
    """Query numbers of a round as the keys they stand for (``asked``)."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([keys.take(batch.column(0)), *batch.columns[1:]], ["asked", "key", "score"])

    return pairs.mapInArrow(name, "asked binary, key binary, score long")

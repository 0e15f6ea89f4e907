"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

    y = w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

The bracket equals the sum over all pairs of features, so a document is scored
in time linear in its features. Features, all of the text itself:

- words, hashed into ``2**WORD_BITS`` slots, counts scaled to unit length;
- structure statistics (:data:`STRUCTURE`), standardised on the sample;
- metadata: the text's length class and script class, one slot each.

Training reads at most ``SAMPLE_ROWS`` labelled rows outside the held-out third,
a bound that does not grow with the corpus; the model has a fixed size and is
sent with the scoring function. Scoring reads every whole text, in tasks.

Defined cases: a null text counts as empty; an empty text gets the score of
its structure and metadata alone; with no labelled rows, or one class only,
every score is the share of label 1 (one half without rows).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import as_bytes, labelled_sample

WORD_BITS = 12
RANK = 8
SAMPLE_ROWS = 6000

STRUCTURE = (
    "log_words", "mean_word_bytes", "upper_share", "symbol_share", "bang_share", "bar_share", "digit_share",
    "comma_period_share", "non_ascii_share", "distinct_share", "same_as_previous_share", "repeated_line_share",
    "repeated_pair_share", "line_breaks_per_word",
)
LENGTH_CLASSES, SCRIPT_CLASSES = 24, 4
WIDTH = (1 << WORD_BITS) + len(STRUCTURE) + LENGTH_CLASSES + SCRIPT_CLASSES


def _byte_class(chars: bytes) -> np.ndarray:
    return np.isin(np.arange(256), np.frombuffer(chars, np.uint8))


_UPPER = _byte_class(bytes(range(65, 91)))
_LETTER = _UPPER | _byte_class(bytes(range(97, 123)))
_SYMBOL = _byte_class(b"#*$%&<>@~^_=+{}[]\\/")
_DIGIT = _byte_class(b"0123456789")
_HIGH = np.arange(256) >= 128


def word_counts(words: list[bytes]) -> np.ndarray:
    slots = np.fromiter(map(crc32, words), np.int64, len(words)) & ((1 << WORD_BITS) - 1)
    return np.bincount(slots, minlength=1 << WORD_BITS).astype(np.float32)


def structure(text: bytes, words: list[bytes]) -> np.ndarray:
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, size = max(1, len(words)), max(1, len(text))
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = list(zip(words, words[1:]))
    return np.array(
        [
            np.log1p(len(words)),
            (len(text) - seen[32] - seen[9:14].sum()) / n,
            seen[_UPPER].sum() / max(1, seen[_LETTER].sum()),
            seen[_SYMBOL].sum() / n,
            seen[33] / n,
            seen[124] / n,
            seen[_DIGIT].sum() / size,
            (seen[44] + seen[46]) / n,
            seen[_HIGH].sum() / size,
            len(set(words)) / n,
            sum(map(eq, words, words[1:])) / n,
            1 - len(set(lines)) / max(1, len(lines)),
            1 - len(set(pairs)) / max(1, len(pairs)),
            seen[10] / n,
        ],
        np.float32,
    )


def metadata(text: bytes) -> tuple[int, int]:
    """Length class (doublings of bytes) and script class (quarters of non-ASCII bytes)."""
    high = int(np.count_nonzero(np.frombuffer(text, np.uint8) >= 128))
    return min(LENGTH_CLASSES - 1, len(text).bit_length()), min(SCRIPT_CLASSES - 1, 4 * high // max(1, len(text)))


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(word counts, everything else)`` of one text; the statistics are not standardised yet."""
    words = text.split()
    length, script = metadata(text)
    classes = np.zeros(LENGTH_CLASSES + SCRIPT_CLASSES, np.float32)
    classes[length] = classes[LENGTH_CLASSES + script] = 1
    return word_counts(words), np.concatenate([structure(text, words), classes])


@dataclass
class FactorMachine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def inputs(self, words: np.ndarray, rest: np.ndarray) -> np.ndarray:
        length = np.linalg.norm(words, axis=1, keepdims=True)
        rest = rest.copy()
        k = len(STRUCTURE)
        rest[:, :k] = np.clip((rest[:, :k] - self.mean) / self.scale, -6, 6)
        return np.concatenate([words / np.maximum(length, 1), rest], 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        crossed = x @ self.factors
        own = (x * x) @ (self.factors * self.factors)
        return self.bias + x @ self.weights + 0.5 * (crossed * crossed - own).sum(1)

    def score(self, words: np.ndarray, rest: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.inputs(words, rest)), -40, 40)))


def fit(words: np.ndarray, rest: np.ndarray, labels: np.ndarray, epochs: int = 12, seed: int = 7) -> FactorMachine:
    """Logistic loss, AdaGrad on mini-batches; the same inputs give the same model."""
    positive = (labels.sum() + 1) / (len(labels) + 2)
    k = len(STRUCTURE)
    mean = rest[:, :k].mean(0) if len(labels) else np.zeros(k, np.float32)
    scale = rest[:, :k].std(0) + 1e-3 if len(labels) else np.ones(k, np.float32)
    rng = np.random.default_rng(seed)
    model = FactorMachine(
        float(np.log(positive / (1 - positive))),
        np.zeros(WIDTH, np.float32),
        np.zeros((WIDTH, RANK), np.float32),
        mean.astype(np.float32),
        scale.astype(np.float32),
    )
    if len(np.unique(labels)) < 2:
        return model
    model.factors = rng.normal(0, 0.02, (WIDTH, RANK)).astype(np.float32)
    penalty = np.full(WIDTH, 2e-3, np.float32)
    penalty[1 << WORD_BITS :] = 1e-4
    seen_w, seen_v, seen_b = np.full(WIDTH, 1e-2), np.full((WIDTH, RANK), 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for begin in range(0, len(order), 128):
            chosen = order[begin : begin + 128]
            x = model.inputs(words[chosen], rest[chosen])
            error = (1 / (1 + np.exp(-np.clip(model.margin(x), -40, 40))) - labels[chosen]) / len(chosen)
            crossed = x @ model.factors
            step_w = x.T @ error + penalty * model.weights
            step_v = x.T @ (error[:, None] * crossed) - ((x * x).T @ error)[:, None] * model.factors
            step_v += penalty[:, None] * model.factors
            seen_w += step_w**2
            seen_v += step_v**2
            seen_b += float(error.sum()) ** 2
            model.weights -= (0.15 * step_w / np.sqrt(seen_w)).astype(np.float32)
            model.factors -= (0.05 * step_v / np.sqrt(seen_v)).astype(np.float32)
            model.bias -= 0.15 * float(error.sum()) / seen_b**0.5
    return model


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots, counts, rest = [], [], []
        for text in batch.column("text").to_pylist():
            words, others = features(text)
            there = np.flatnonzero(words)
            slots.append(there.astype(np.int32))
            counts.append(words[there])
            rest.append(others)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("label"),
                batch.column("hash"),
                pa.array(slots, pa.list_(pa.int32())),
                pa.array(counts, pa.list_(pa.float32())),
                pa.array(rest, pa.list_(pa.float32())),
            ],
            ["label", "hash", "slots", "counts", "rest"],
        )


def train(docs: DataFrame, labels: DataFrame, label: str, limit: int = SAMPLE_ROWS) -> FactorMachine:
    """Fit on at most ``limit`` labelled rows; only their features reach the driver, at most 32 KB a row."""
    sample = labelled_sample(docs, labels, label, limit)
    sample = sample.select(F.col("_label").cast("int").alias("label"), as_bytes("_text").alias("text"))
    sample = sample.withColumn("hash", F.xxhash64("text"))
    rows = sample.mapInArrow(_featurise, "label int, hash long, slots array<int>, counts array<float>, rest array<float>").toArrow()
    n = rows.num_rows
    words, rest = np.zeros((n, 1 << WORD_BITS), np.float32), np.zeros((n, WIDTH - (1 << WORD_BITS)), np.float32)
    for k in range(n):
        words[k, rows["slots"][k].values.to_numpy()] = rows["counts"][k].values.to_numpy()
        rest[k] = rows["rest"][k].values.to_numpy()
    target = rows["label"].to_numpy().astype(np.float32)
    # Rows arrive in task order; the model must not depend on it. Rows alike in hash and label are alike.
    order = np.lexsort([target, rows["hash"].to_numpy()])
    return fit(words[order], rest[order], target[order])


def quality_score(model: FactorMachine, text: str | Column = "text") -> Column:
    """Probability of label 1 as a column."""

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        scores = []
        for begin in range(0, len(texts), 64):
            pairs = [features(x) for x in texts[begin : begin + 64].to_pylist()]
            scores.append(model.score(np.stack([a for a, _ in pairs]), np.stack([b for _, b in pairs])))
        return pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())

    return of.asNondeterministic()(as_bytes(text))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, label: str = "quality", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``."""
    model = train(docs, labels, label)
    scored = docs.withColumn("__quality_score", quality_score(model, text))
    return scored.filter(F.col("__quality_score") >= threshold).drop("__quality_score")

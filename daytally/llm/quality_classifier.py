"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics of each whole text are written once. On a bounded sample of labelled rows (``MAX_LABELLED``) their mean and
spread are summed, then the normal equations of the random Fourier features, which approximate a Gaussian kernel. A
third of the sample is kept apart and calibrates the scores by pool-adjacent-violators.

Cases: null and empty texts are scored as texts without words. If there is no label to learn from, the score is 0.5
everywhere; if all labels are equal, it is that label. Repeated rows get equal scores. Rows whose id is null are scored
and never learned from. Extra columns are ignored, and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import remainder, text_or_empty, written
from daytally.llm.fitting import (
    DIGITS,
    array_column,
    bounded_sample,
    labels_of,
    matrix,
    partition_sums,
    ridge,
    with_constant,
)

MAX_LABELLED = 30_000
FOURIER = 256
GAMMA = 0.05
STRENGTH = 1.0
KNOTS = 400
ROWS_AT_ONCE = 1024

SYMBOL_BYTES = b"#*$%&|<>"
_KEEP = {
    "symbols": bytes(b for b in range(256) if b not in SYMBOL_BYTES),
    "upper": bytes(b for b in range(256) if not 65 <= b <= 90),
    "digits": bytes(b for b in range(256) if not 48 <= b <= 57),
    "stops": bytes(b for b in range(256) if b not in b".,;:"),
    "shouts": bytes(b for b in range(256) if b not in b"!?"),
    "other": bytes(b for b in range(256) if b >= 128 or chr(b).isalnum() or b in b" \t\n\r\x0b\x0c"),
}


def statistics(text: bytes) -> list[float]:
    """Shares and logarithms that describe a text, whole, whatever its language."""
    words = text.split()
    n, size = len(words), max(1, len(text))
    w = max(1, n)
    solid = max(1, sum(map(len, words)))
    distinct = set(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = set(zip(words, words[1:]))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    share = {name: len(text.translate(None, drop)) / solid for name, drop in _KEEP.items()}
    return [
        np.log1p(n),
        np.log1p(size / w),
        len(distinct) / w,
        np.log1p(w / max(1, len(distinct))),
        len(pairs) / max(1, n - 1),
        repeats / w,
        1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))),
        *share.values(),
        np.sqrt(share["symbols"]),
        np.sqrt(share["upper"]),
    ]


def statistics_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and stats, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                stats = np.array([statistics(t.as_py()) for t in batch.column(1)], np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0), array_column(stats)], names=["doc_id", "stats"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"doc_id {kind}, stats array<double>"), "stats")


def isotonic(score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: places and values of the non-decreasing steps."""
    blocks: list[list[float]] = []  # value, weight, sum of places
    for i in np.argsort(score, kind="stable"):
        blocks.append([label[i], weight[i], score[i] * weight[i]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, s = blocks.pop()
            u = blocks[-1]
            u[0] = (u[0] * u[1] + v * w) / (u[1] + w)
            u[1] += w
            u[2] += s
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] for b in blocks])


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    places: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -8, 8)
        return with_constant(np.sqrt(2 / len(self.phases)) * np.cos(x @ self.directions + self.phases))

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        # Rounded, as the last digits depend on a row's place in the matrix product.
        return np.round(np.clip(np.interp(self.raw(stats), self.places, self.values), 0, 1), DIGITS)


def fit(stats: DataFrame, labels: DataFrame, column: str, modulus: int = 3, held: int = 1) -> Model | float:
    """The model learned from rows whose remainder is not ``held``; a number if there is nothing to tell apart."""
    known = stats.filter(remainder("doc_id", modulus) != held).join(
        labels_of(labels, column), F.col("doc_id") == F.col("label_id")
    )
    known = written(known.select("doc_id", "stats", "label"), "labelled")
    sample = bounded_sample(known, "doc_id", MAX_LABELLED)
    apart = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(3)) == 0

    def moments(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        x, y = matrix(batch.column("stats")), batch.column("label").to_numpy()
        return np.array(float(len(x))), x.sum(0), (x * x).sum(0), np.array(y.sum())

    sums = partition_sums(sample, moments)
    if sums is None:
        return 0.5
    n, total, squares, ones = sums
    if ones <= 0 or ones >= n:
        return float(ones / n)
    mean = total / n
    spread = np.sqrt(np.maximum(squares / n - mean * mean, 0)) + 1e-6
    rng = np.random.default_rng(20)
    directions = rng.normal(0, np.sqrt(2 * GAMMA), (len(mean), FOURIER))
    phases = rng.uniform(0, 2 * np.pi, FOURIER)
    model = Model(mean, spread, directions, phases, np.zeros(FOURIER + 1), np.zeros(1), np.zeros(1))

    def equations(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        z = model.features(matrix(batch.column("stats")))
        return z.T @ z, z.T @ batch.column("label").to_numpy()

    fitted = partition_sums(sample.filter(~apart), equations) or partition_sums(sample, equations)
    model.weights = ridge(*fitted, STRENGTH)
    low, high = -0.5, 1.5

    def binned(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        raw, y = model.raw(matrix(batch.column("stats"))), batch.column("label").to_numpy()
        place = np.clip(((raw - low) / (high - low) * KNOTS).astype(int), 0, KNOTS - 1)
        return tuple(np.bincount(place, w, KNOTS) for w in (np.ones(len(y)), y, raw))

    count, label, raw = partition_sums(sample.filter(apart), binned) or partition_sums(sample, binned)
    full = count > 0
    model.places, model.values = isotonic(raw[full] / count[full], label[full] / count[full], count[full])
    return model


def score_table(stats: DataFrame, model: Model | float) -> DataFrame:
    """doc_id, score."""
    if isinstance(model, float):
        return stats.select("doc_id", F.lit(model).alias("score"))
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(matrix(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", "stats").mapInArrow(run, f"doc_id {kind}, score double")


def quality(docs: DataFrame, labels: DataFrame, column: str = "quality", threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    stats = statistics_table(docs)
    scored = score_table(stats, fit(stats, labels, column))
    return scored.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score at least the threshold, with all their columns."""
    model = fit(statistics_table(docs), labels, "quality")
    if isinstance(model, float):
        return docs if model >= threshold else docs.limit(0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        stats = np.array([statistics(t) for t in texts], np.float64)
        return pd.Series(shared.value.score(stats) if len(stats) else stats)

    return docs.filter(scored(text_or_empty().cast("binary")) >= threshold)

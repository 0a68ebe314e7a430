"""Fitting linear models from sums over partitions; the driver gets a fixed number of small matrices."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = 8
DIGITS = 9  # of scores
SAMPLE_STEPS = 1_000_000


def partition_sums(
    rows: DataFrame, of_batch: Callable[[pa.RecordBatch], tuple[np.ndarray, ...]]
) -> tuple[np.ndarray, ...] | None:
    """The sum, array by array, of what ``of_batch`` gives for each batch of rows; None if there is no row.

    Each partition makes one set of sums; these are dealt to ``PARTS`` tasks, which send one set each to the driver.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _one_row(of_batch(batch) for batch in batches if batch.num_rows)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _one_row(pickle.loads(row.as_py()) for batch in batches for row in batch.column(0))

    parts = rows.mapInArrow(make, "sums binary").repartition(PARTS).mapInArrow(add, "sums binary").collect()
    return _total(pickle.loads(bytes(p["sums"])) for p in parts)


def _total(sums: Iterable[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...] | None:
    total: list[np.ndarray] | None = None
    for found in sums:
        total = [np.array(a) for a in found] if total is None else [a + b for a, b in zip(total, found)]
    return None if total is None else tuple(total)


def _one_row(sums: Iterable[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    total = _total(sums)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], names=["sums"])


def bounded_sample(rows: DataFrame, key: str, most: int, seed: int = 7, count: int | None = None) -> DataFrame:
    """All rows, or about ``most`` of them: those whose key's hash is below the fraction that gives so many."""
    n = rows.count() if count is None else count
    if n <= most:
        return rows
    return rows.filter(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(SAMPLE_STEPS)) < int(SAMPLE_STEPS * most / n))


def labels_of(labels: DataFrame, column: str) -> DataFrame:
    """doc_id and label (the mean where an id has several); rows without an id or a label are left out."""
    named = labels.select(F.col("doc_id").alias("label_id"), F.col(column).cast("double").alias("label"))
    return named.dropna().groupBy("label_id").agg(F.avg("label").alias("label"))


def ridge(gram: np.ndarray, moment: np.ndarray, strength: float) -> np.ndarray:
    """Weights of the normal equations; the last feature is the constant and is not shrunk."""
    penalty = np.full(len(gram), strength)
    penalty[-1] = 1e-9
    return np.linalg.solve(gram + np.diag(penalty), moment)


def with_constant(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def matrix(column: pa.Array) -> np.ndarray:
    """An array column, all of one length and without nulls, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def array_column(values: np.ndarray) -> pa.Array:
    """A matrix as an array column."""
    rows, width = values.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(values).reshape(-1))
    )

"""Language identification by a string kernel.

The kernel of two texts is the number of character n-grams, of one to three characters, that occur in both, over the
root of the product of their numbers. Characters are folded to 64 symbols: the edge of a word, a to z, and 37 classes of
other letters. Landmarks are a bounded sample of the training rows (``LANDMARKS`` per language); with the landmarks'
kernel matrix they give Nystroem features, on which a ridge regression is fitted for each language against the rest,
from normal equations summed over partitions of a second bounded sample (``MAX_FIT`` per language).

A text's scores are (presence row) x (landmark rows) x (weights). The last two factors do not depend on the text, so
their product is made once, and batches of presence rows are multiplied by it.

Cases: a null text or one without a letter is ``und`` with score 0. Without training rows every text is ``und``; with a
single language every text with a letter gets it. Rows with a null lang are scored and not learned from. Ties go to the
first language by name. Repeated rows get equal results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import remainder, text_or_empty
from daytally.llm.fitting import DIGITS, SAMPLE_STEPS, partition_sums, ridge, with_constant

LANDMARKS = 64
MAX_FIT = 500
STRENGTH = 0.1
SHARPNESS = 4.0
SYMBOLS = 64
GRAMS = SYMBOLS + SYMBOLS**2 + SYMBOLS**3
ROWS_AT_ONCE = 256

_TABLE: list[np.ndarray] = []


def _symbols() -> np.ndarray:
    """The symbol of each code point, made once per process: 0 for what is no letter."""
    if not _TABLE:
        table = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            letter = chr(c)
            if letter.isalpha():
                low = ord(letter.lower()[0])
                table[c] = low - 96 if 97 <= low <= 122 else 27 + low % 37
        _TABLE.append(table)
    return _TABLE[0]


class Presence:
    """The n-grams that occur in a text; the marks are used again for each text."""

    def __init__(self):
        self.marks = np.zeros(GRAMS, bool)

    def __call__(self, text: str) -> np.ndarray:
        s = _symbols()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
        if not s.any():
            return np.zeros(0, np.int64)
        s = np.concatenate([[0], s, [0]]).astype(np.int32)
        s = s[(s > 0) | np.concatenate([[True], s[:-1] > 0])]
        two = s[:-1] * SYMBOLS + s[1:]
        self.marks[s] = True
        self.marks[SYMBOLS + two] = True
        self.marks[SYMBOLS + SYMBOLS**2 + two[:-1] * SYMBOLS + s[2:]] = True
        found = np.flatnonzero(self.marks)
        self.marks[found] = False
        return found


@dataclass
class Landmarks:
    """The n-grams of each landmark, and what turns kernel rows into features."""

    grams: list[np.ndarray]
    root: np.ndarray

    @classmethod
    def of(cls, grams: list[np.ndarray]) -> Landmarks:
        kernel = cls(grams, np.zeros((0, 0))).kernel(grams)
        values, vectors = np.linalg.eigh(kernel)
        inverse = np.where(values > 1e-6 * values.max(), 1 / np.sqrt(np.maximum(values, 1e-12)), 0)
        return cls(grams, vectors * inverse @ vectors.T)

    def kernel(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.empty((len(rows), len(self.grams)), np.float32)
        present = np.zeros((len(self.grams), GRAMS), bool)
        for i, g in enumerate(self.grams):
            present[i, g] = True
        sizes = np.sqrt([len(g) for g in self.grams])
        for i, row in enumerate(rows):
            out[i] = present[:, row].sum(axis=1) / (sizes * np.sqrt(len(row)))
        return out

    def features(self, rows: list[np.ndarray]) -> np.ndarray:
        return with_constant(self.kernel(rows) @ self.root)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # n-grams x languages
    constants: np.ndarray

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        """The product of the texts' presence rows, each over the root of its number of n-grams, and the weights."""
        sizes = np.array([len(r) for r in rows])
        sums = np.add.reduceat(self.weights[np.concatenate(rows)], np.cumsum(sizes) - sizes, axis=0)
        return sums / np.sqrt(sizes)[:, None] + self.constants


def training_rows(docs: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """Rows without an id are left out: they share one hash, so a sample by it has all of them or none."""
    whole = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    return docs.filter(whole & (remainder("doc_id", modulus) != held)).select("doc_id", "text", "lang")


def _per_language(rows: DataFrame, counts: dict[str, int], most: int, seed: int) -> DataFrame:
    """About ``most`` rows of each language at most, by the hash of the id."""
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(SAMPLE_STEPS, -(-SAMPLE_STEPS * most // n))).otherwise(share)
    return rows.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(SAMPLE_STEPS)) < share)


def _grams(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence()
        for batch in batches:
            found = [presence(t.as_py()).astype(np.int32) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(found, pa.list_(pa.int32()))], names=["lang", "grams"]
            )

    return rows.select("text", "lang").mapInArrow(run, "lang string, grams array<int>")


def fit(docs: DataFrame) -> Model | None:
    known = training_rows(docs)
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    languages = sorted(counts)
    found = _grams(_per_language(known, counts, LANDMARKS, 1)).collect()
    grams = [np.array(r["grams"], np.int64) for r in found if r["grams"]]
    if not grams or len(languages) == 1:
        return Model(languages, np.zeros((GRAMS, len(languages)), np.float32), np.ones(len(languages)))
    landmarks = Landmarks.of(grams)
    shared = docs.sparkSession.sparkContext.broadcast(landmarks)
    sample = _per_language(known, counts, MAX_FIT, 2)

    def equations(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        presence = Presence()
        rows = [(presence(t), lang) for t, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist())]
        rows = [(g, lang) for g, lang in rows if len(g)]
        z = shared.value.features([g for g, _ in rows])
        y = np.array([[1.0 if lang == x else -1.0 for x in languages] for _, lang in rows]).reshape(-1, len(languages))
        return z.T @ z, z.T @ y

    gram, moment = partition_sums(sample, equations)
    weights = ridge(gram, moment, STRENGTH)
    by_landmark = landmarks.root @ weights[:-1]
    by_gram = np.zeros((GRAMS, len(languages)), np.float32)
    for g, w in zip(landmarks.grams, by_landmark):
        by_gram[g] += (w / np.sqrt(len(g))).astype(np.float32)
    return Model(languages, by_gram, weights[-1])


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    model = fit(docs)
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    held = (remainder("doc_id", 4) == 2).alias("held_out")
    if model is None:
        return rows.select("doc_id", held, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence, model = Presence(), shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                grams = [presence(t.as_py()) for t in batch.column("text")]
                lang, score = ["und"] * len(grams), np.zeros(len(grams))
                some = [i for i, g in enumerate(grams) if len(g)]
                if some:
                    s = SHARPNESS * model.score([grams[i] for i in some])
                    p = np.exp(s - s.max(axis=1, keepdims=True))
                    p /= p.sum(axis=1, keepdims=True)
                    best = p.argmax(axis=1)
                    score[some] = np.round(p[np.arange(len(some)), best], DIGITS)
                    for i, b in zip(some, best):
                        lang[i] = model.languages[b]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(lang), pa.array(score)], names=["doc_id", "lang_pred", "score"]
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double").select(
        "doc_id", held, "lang_pred", "score"
    )

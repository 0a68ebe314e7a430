"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posterior labels.

Voters. Lexicon voters hold words, and beginnings of words, that labelled rows mark as toxic; each vote is cast by a
group of them. Pattern voters look at shouting, repeated characters, stretches of symbols, and at how many
lexicon entries a text has. The lexicon is learned from a bounded sample of labelled rows (``MAX_LABELLED``).

Label model. Every text's votes are written. Expectation-maximisation over sums of all of them estimates the share of toxic
texts, each voter's mean vote in both classes (its accuracy), and the covariance of the votes within the classes (the
voters' correlations), as ``RANK`` factors that voters have in common and a rest of each voter's own. Labelled rows keep
their labels, and weigh ``ANCHOR`` times as much as all others together: with less of an anchor, voters that copy each
other would be taken for the label. Weights that take the covariance into account give each text a posterior label.

Classifier. A logistic regression on votes and counts is fitted to the posterior labels by Newton steps, each a sum over
all rows; it gives the scores. The posterior label of a labelled row is its label, and such a row counts ``KNOWN`` times.

Cases: null and empty texts cast no lexicon vote and are scored like other texts without any. Without labels, or with
one kind of label only, the score is that of the labels' mean (0 without any). Rows without an id are scored and not
learned from. Repeated rows get equal scores; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import remainder, text_or_empty, written
from daytally.llm.fitting import DIGITS, array_column, bounded_sample, labels_of, matrix, partition_sums, with_constant

MAX_LABELLED = 20_000
GROUPS = 24
SHORTEST, LONGEST = 4, 8
LEAST_PRECISION = 0.7
LEAST_EVIDENCE = 20.0  # log-likelihood ratio; chance gives this to about one gram in a hundred thousand
EM_STEPS = 8
RANK = 4
ANCHOR = 2.0
AXIS_STEPS = 50
KNOWN = 10.0
NEWTON_STEPS = 6
SMOOTH = 0.02
ROWS_AT_ONCE = 1024

_LETTERS = re.compile(r"[^\W\d_]+")
_SHOUT = re.compile(r"!{2,}")
_RUN = re.compile(r"(\w)\1{3,}")
_SWEAR = re.compile(r"[#$%&*@!]{3,}")


def grams(word: str) -> Iterator[str]:
    """The word, and its beginnings (marked by a star)."""
    yield word
    for n in range(SHORTEST, min(LONGEST, len(word)) + 1):
        yield word[:n] + "*"


def words_of(text: str) -> set[str]:
    return set(_LETTERS.findall(text.lower()))


def gram_counts(sample: DataFrame) -> DataFrame:
    """gram, toxic, clean: in how many sample documents of each label it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            keys = list(counts[0].keys() | counts[1].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)],
                names=["gram", "toxic", "clean"],
            )
            counts[0].clear()
            counts[1].clear()
            return out

        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                counts[0 if label > 0.5 else 1].update({g for w in words_of(text) for g in grams(w)})
                if len(counts[0]) + len(counts[1]) > 500_000:
                    yield flush()
        yield flush()

    return (
        sample.select("text", "label")
        .mapInArrow(run, "gram string, toxic long, clean long")
        .groupBy("gram")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def learn_lexicon(sample: DataFrame, n_toxic: int, n_clean: int) -> list[tuple[str, float]]:
    """All telling grams (the most telling first, of equals the shortest, then by spelling) and how sure they are."""
    toxic, clean = F.col("toxic"), F.col("clean")
    expected = (toxic + clean) / (n_toxic + n_clean)
    evidence = 2 * (
        toxic * F.log(toxic / (expected * n_toxic))
        + F.when(clean > 0, clean * F.log(clean / (expected * n_clean))).otherwise(0.0)
    )
    gain = toxic / n_toxic * F.log((toxic / n_toxic) / ((clean + 0.5) / (n_clean + 1)))
    found = (
        gram_counts(sample)
        .filter(toxic > 0)
        .filter((toxic / (toxic + clean) >= LEAST_PRECISION) & (evidence >= LEAST_EVIDENCE))
        .withColumn("gain", gain)
        .orderBy(F.desc("gain"), F.length("gram"), "gram")
    )
    sure = lambda r: (r["toxic"] + 0.5) / (n_toxic + 1) / ((r["clean"] + 0.5) / (n_clean + 1))
    return [(r["gram"], sure(r)) for r in found.collect()]


@dataclass
class Voters:
    """Votes of a text: 1 toxic, -1 not, 0 abstains. The last columns are counts for the classifier."""

    lexicon: list[tuple[str, float]]  # entry, how sure it is
    group: dict[str, int] = field(init=False)
    beginnings: set[str] = field(init=False)

    def __post_init__(self):
        # Groups of about equal reliability, so that the label model can tell strong voters from weak ones.
        ranked = sorted(self.lexicon, key=lambda e: (-e[1], e[0]))
        self.group = {g: i * GROUPS // len(ranked) for i, (g, _) in enumerate(ranked)}
        self.beginnings = {g[:SHORTEST] for g in self.group}

    def hits(self, text: str) -> list[int]:
        """For each distinct word that the lexicon has, the most reliable group that it is in."""
        out = []
        for w in words_of(text):
            if w[:SHORTEST] in self.beginnings:
                found = [self.group[g] for g in grams(w) if g in self.group]
                if found:
                    out.append(min(found))
        return out

    def row(self, text: str) -> list[float]:
        hits = self.hits(text)
        votes = [0.0] * GROUPS
        for group in hits:
            votes[group] = 1.0
        distinct = len(hits)
        letters = max(1, len(text))
        upper = sum(1 for c in text if c.isupper()) / letters if not text.islower() else 0.0
        votes += [
            1.0 if distinct >= 1 else -1.0,
            1.0 if distinct >= 2 else (-1.0 if not distinct else 0.0),
            1.0 if distinct >= 4 else 0.0,
            1.0 if upper > 0.5 else 0.0,
            1.0 if len(_SHOUT.findall(text)) > 3 else 0.0,
            1.0 if _RUN.search(text) else 0.0,
            1.0 if _SWEAR.search(text) else 0.0,
        ]
        return [*votes, float(np.log1p(distinct)), distinct / (1 + np.log1p(letters))]


N_VOTERS = GROUPS + 7


def votes_table(docs: DataFrame, voters: Voters) -> DataFrame:
    """doc_id and votes (voters, then counts), written."""
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                rows = np.array([shared.value.row(t.as_py()) for t in batch.column("text")], np.float32)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), array_column(rows)], names=["doc_id", "votes"])

    rows = docs.select("doc_id", text_or_empty().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"doc_id {kind}, votes array<float>"), "votes")


@dataclass
class LabelModel:
    """share: of toxic texts. means: of each vote by class (0, 1). covariance: of the votes within the classes."""

    share: float
    means: np.ndarray
    covariance: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        w = np.linalg.solve(self.covariance, self.means[1] - self.means[0])
        middle = (self.means[1] + self.means[0]) / 2
        z = (votes - middle) @ w + np.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    @classmethod
    def of_labels(cls, n, toxic, total, total_toxic, outer) -> LabelModel:
        """From sums over labelled rows of: rows, labels, votes, votes by label, products of votes."""
        share = float(np.clip(toxic / n, 1e-4, 1 - 1e-4))
        means = np.stack([(total - total_toxic) / max(n - toxic, 1e-9), total_toxic / max(toxic, 1e-9)])
        within = outer / n - (1 - share) * np.outer(means[0], means[0]) - share * np.outer(means[1], means[1])
        return cls(share, means, within + SMOOTH * np.eye(len(total)))

    @classmethod
    def of_sums(cls, n, toxic, total, total_toxic, outer, rank: int = RANK) -> LabelModel:
        """The same from sums over all rows by their posterior labels, with common factors and rests as covariance."""
        model = cls.of_labels(n, toxic, total, total_toxic, outer)
        scale = np.sqrt(np.diag(model.covariance))
        model.covariance = with_common_factors(model.covariance / np.outer(scale, scale), rank) * np.outer(scale, scale)
        return model


def with_common_factors(correlation: np.ndarray, rank: int) -> np.ndarray:
    """The correlation that so many common factors leave, by principal axes: a voter's own part is in no factor."""
    shared = 1 - 1 / np.diag(np.linalg.inv(correlation))
    for _ in range(AXIS_STEPS):
        values, vectors = np.linalg.eigh(correlation - np.diag(1 - shared))
        factors = vectors[:, -rank:] * np.sqrt(np.maximum(values[-rank:], 0))
        common = factors @ factors.T
        shared = np.minimum(np.diag(common), 1 - 1e-3)
    np.fill_diagonal(common, 1)
    return common


def _sums(votes: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, ...]:
    return np.array(float(len(p))), np.array(p.sum()), votes.sum(0), p @ votes


def _voter_votes(batch: pa.RecordBatch) -> np.ndarray:
    return matrix(batch.column("votes")).astype(float)[:, :N_VOTERS]


def fit_label_model(table: DataFrame, labelled: DataFrame) -> LabelModel:
    """``table`` has all rows, the labelled ones too. Sums over the others are those of all less those of the labelled."""

    def known(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        v = _voter_votes(batch)
        return *_sums(v, batch.column("label").to_numpy()), v.T @ v

    def products(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        v = _voter_votes(batch)
        return np.array(float(len(v))), v.T @ v

    anchor = partition_sums(labelled, known)
    rows, outer = partition_sums(table, products)
    others = max(0.0, float(rows) - float(anchor[0]))
    weight = max(1.0, ANCHOR * others / float(anchor[0]))
    outer_of_others = outer - anchor[-1] if others else np.zeros_like(outer)
    model = LabelModel.of_labels(*anchor)
    for _ in range(EM_STEPS if others else 0):
        now = model

        def step(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
            v = _voter_votes(batch)
            return _sums(v, now.posterior(v))

        unknown = [a - b for a, b in zip(partition_sums(table, step), partition_sums(labelled, step))]
        model = LabelModel.of_sums(*(a + weight * b for a, b in zip([*unknown, outer_of_others], anchor)))
        if np.abs(model.means - now.means).max() < 1e-4:
            break
    return model


def fit_classifier(table: DataFrame, labelled: DataFrame, model: LabelModel) -> np.ndarray:
    """Weights of a logistic regression on the posterior labels, over all rows."""
    width = N_VOTERS + 3
    weights = np.zeros(width)
    weights[-1] = np.log(model.share / (1 - model.share))

    def sums(x: np.ndarray, target: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        return x.T @ (target - p), (x * (p * (1 - p))[:, None]).T @ x

    for _ in range(NEWTON_STEPS):
        now = weights

        def step(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
            v = matrix(batch.column("votes")).astype(float)
            return sums(with_constant(v), model.posterior(v[:, :N_VOTERS]), now)

        def known(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
            """What makes of a row with a posterior label ``KNOWN`` rows with the known one."""
            v = matrix(batch.column("votes")).astype(float)
            x = with_constant(v)
            mine, its = sums(x, batch.column("label").to_numpy(), now), sums(x, model.posterior(v[:, :N_VOTERS]), now)
            return tuple(KNOWN * a - b for a, b in zip(mine, its))

        gradient, curvature = (a + b for a, b in zip(partition_sums(table, step), partition_sums(labelled, known)))
        move = np.linalg.solve(curvature + 1e-2 * np.eye(width), gradient - 1e-2 * now)
        size = np.abs(move).max()
        weights = now + move * min(1.0, 4 / size)
        if size < 1e-3:
            break
    return weights


def toxicity(docs: DataFrame, labels: DataFrame, column: str = "toxic", threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    named = labels_of(labels, column).filter(remainder("label_id", 3) != 1)
    # At most about MAX_LABELLED ids go to the executors; so the documents' texts need no shuffle.
    ids = F.broadcast(bounded_sample(named, "label_id", MAX_LABELLED))
    sample = written(
        docs.select("doc_id", text_or_empty().alias("text"))
        .join(ids, F.col("doc_id") == F.col("label_id"))
        .select("doc_id", "text", "label"),
        "labelled",
    )
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum((F.col("label") > 0.5).cast("int")), F.lit(0))).first()
    held = (remainder("doc_id", 3) == 1).alias("held_out")
    if not toxic or toxic == n:
        score = F.lit(1.0 if n and toxic else 0.0)
        return docs.select("doc_id", held, score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
    voters = Voters(learn_lexicon(sample, toxic, n - toxic))
    table = votes_table(docs, voters)
    labelled = written(
        table.join(ids, F.col("doc_id") == F.col("label_id")).select("doc_id", "votes", "label"), "labelled-votes"
    )
    model = fit_label_model(table, labelled)
    shared = docs.sparkSession.sparkContext.broadcast(fit_classifier(table, labelled, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = with_constant(matrix(batch.column("votes")).astype(float)) @ shared.value
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), DIGITS))], names=["doc_id", "score"]
                )

    kind = table.schema["doc_id"].dataType.simpleString()
    return table.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", held, "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )

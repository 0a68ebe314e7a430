"""Held-out accuracy of the three classifiers, and their odd cases."""

import numpy as np
import pytest

from daytally.llm import language_id, quality_classifier, toxicity
from daytally.llm.quality_classifier import isotonic
from edge_cases import EDGES

FOLDER = "/root/testdata/sf0.1"


def read(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def auc(label, score):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    _, inverse, counts = np.unique(np.asarray(score), return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - (counts - 1) / 2)[inverse]
    ones = label == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def held_out(scored, labels, column):
    rows = scored.filter("held_out").join(labels.select("doc_id", column), "doc_id").toPandas()
    return rows[column].to_numpy(), rows["score"].to_numpy(), rows["predicted"].to_numpy()


def ids(rows):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in rows)


EDGE_IDS = sorted((r[0] is None, r[0] or 0) for r in EDGES)


def test_quality_on_held_out_rows(spark):
    labels = read(spark, "labels")
    label, score, predicted = held_out(quality_classifier.quality(read(spark, "documents"), labels), labels, "quality")
    assert auc(label, score) > 0.98 and (label == predicted).mean() > 0.97
    assert (predicted[label == 1] == 1).mean() > 0.99


def test_toxicity_on_held_out_rows(spark):
    labels = read(spark, "labels")
    label, score, predicted = held_out(toxicity.toxicity(read(spark, "documents"), labels), labels, "toxic")
    assert auc(label, score) > 0.93 and (label == predicted).mean() > 0.97
    assert (predicted[label == 0] == 0).mean() > 0.985


def test_toxic_held_out_rows_are_found(spark):
    labels = read(spark, "labels")
    label, _, predicted = held_out(toxicity.toxicity(read(spark, "documents"), labels), labels, "toxic")
    recall = (predicted[label == 1] == 1).mean()
    assert recall > 0.8, recall


def test_toxic_held_out_rows_of_the_large_tables_are_found(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    label, _, predicted = held_out(toxicity.toxicity(docs, labels), labels, "toxic")
    recall, precision = (predicted[label == 1] == 1).mean(), (label[predicted == 1] == 1).mean()
    assert recall >= 0.9 and precision >= 0.95, (recall, precision)


def test_expectation_maximisation_by_brute_force(spark):
    """The same model from all votes in one place, row by row."""
    rng = np.random.default_rng(8)
    n, k = 400, toxicity.N_VOTERS
    truth = rng.random(n) < 0.3
    votes = np.where(rng.random((n, k)) < 0.25, 0.0, np.where((rng.random((n, k)) < 0.7) == truth[:, None], 1.0, -1.0))
    votes = np.hstack([votes, rng.random((n, 2))]).astype(np.float32)
    known = np.arange(n) % 9 == 0
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(votes)], "doc_id long, votes array<float>").repartition(3)
    labelled = spark.createDataFrame([(i, votes[i].tolist(), float(truth[i])) for i in np.flatnonzero(known).tolist()], "doc_id long, votes array<float>, label double")
    model = toxicity.fit_label_model(table, labelled)

    v = votes[:, :k].astype(float)
    weight = np.where(known, toxicity.ANCHOR * (~known).sum() / known.sum(), 1.0)
    p, w, rank = truth.astype(float), weight * known, None
    for _ in range(toxicity.EM_STEPS + 1):
        share = (w * p).sum() / w.sum()
        means = np.stack([((w * (1 - p)) @ v) / (w * (1 - p)).sum(), ((w * p) @ v) / (w * p).sum()])
        spread = sum(
            wi * (pi * np.outer(x - means[1], x - means[1]) + (1 - pi) * np.outer(x - means[0], x - means[0])) for x, pi, wi in zip(v, p, w)
        )
        covariance = spread / w.sum() + toxicity.SMOOTH * np.eye(k)
        if rank:
            scale = np.sqrt(np.diag(covariance))
            covariance = toxicity.with_common_factors(covariance / np.outer(scale, scale), rank) * np.outer(scale, scale)
        z = (v - means.mean(0)) @ np.linalg.solve(covariance, means[1] - means[0]) + np.log(share / (1 - share))
        p = np.where(known, truth, 1 / (1 + np.exp(-np.clip(z, -30, 30))))
        w, rank = weight, toxicity.RANK
    assert np.abs(model.posterior(v)[~known] - p[~known]).max() < 1e-2
    assert ((model.posterior(v) > 0.5) == truth).mean() > 0.9


def test_every_telling_word_is_in_the_lexicon(spark):
    words = [a + b + c for a in "abcdefghi" for b in "jklmnopqr" for c in "stuvwxyz"]
    rows = [(" ".join(words), 1.0)] * 60 + [("fine clean text", 0.0)] * 600
    sample = spark.createDataFrame(rows, "text string, label double")
    assert {g for g, _ in toxicity.learn_lexicon(sample, 60, 600)} == set(words) and len(words) > 600


def test_language_on_held_out_rows(spark):
    docs = read(spark, "documents")
    rows = language_id.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (rows["lang"] == rows["lang_pred"]).mean() > 0.98
    assert rows["score"].between(0, 1).all()


@pytest.mark.parametrize(
    ("scorer", "column"), [(quality_classifier.quality, "quality"), (toxicity.toxicity, "toxic")]
)
def test_labels_change_nothing_but_what_is_learned(spark, scorer, column):
    """Labels of held-out rows are never read."""
    from daytally.llm.common import remainder

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    without = labels.filter(remainder("doc_id", 3) != 1)
    a, b = (sorted((r.doc_id, round(r.score, 6)) for r in scorer(docs, x).collect()) for x in (labels, without))
    assert a == b


@pytest.mark.parametrize("scorer", [quality_classifier.quality, toxicity.toxicity])
def test_odd_rows(edges, no_docs, edge_labels, no_labels, scorer):
    rows = scorer(edges, edge_labels).collect()
    assert ids(rows) == EDGE_IDS and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    by_text = {}
    for r in rows:
        if r.doc_id == 3 or r.doc_id == 4:
            by_text.setdefault("none", set()).add(r.score)
    assert len(by_text["none"]) == 1
    assert ids(scorer(edges, no_labels).collect()) == EDGE_IDS
    assert scorer(no_docs, edge_labels).collect() == [] and scorer(no_docs, no_labels).collect() == []


def test_equal_labels(spark, edges):
    ones = spark.createDataFrame([(i, 1, 1) for i in range(1, 9)], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_classifier.quality(edges, ones).collect()} == {1.0}
    assert {r.score for r in toxicity.toxicity(edges, ones).collect()} == {1.0}


def test_good_documents_keep_their_columns(edges, edge_labels, no_labels, no_docs):
    assert quality_classifier.keep_good(edges, edge_labels).columns == edges.columns
    assert quality_classifier.keep_good(edges, no_labels).count() == len(EDGES)
    assert quality_classifier.keep_good(no_docs, edge_labels).collect() == []


def test_languages_of_odd_rows(edges, no_docs):
    rows = language_id.identify(edges).collect()
    assert ids(rows) == EDGE_IDS
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5)} == {"und"}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert {r.lang_pred for r in rows} <= {"und", "en", "de", "fr", "es"}
    assert language_id.identify(no_docs).collect() == []


def test_one_language_or_none(spark, edges):
    rows = language_id.identify(edges.filter("lang = 'en'")).collect()
    assert {r.lang_pred for r in rows} <= {"en", "und"}
    assert {r.lang_pred for r in language_id.identify(edges.filter("lang IS NULL")).collect()} == {"und"}


def test_kernel_is_the_share_of_common_grams():
    presence = language_id.Presence()
    a, b = presence("abc"), presence("Abd")

    def grams(s):
        s = f" {s} "
        return {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}

    assert len(a) == len(grams("abc")) and len(presence("x1 9")) == len(grams("x"))
    landmarks = language_id.Landmarks.of([a, b])
    want = len(grams("abc") & grams("abd")) / len(grams("abc"))
    assert landmarks.kernel([a])[0].tolist() == pytest.approx([1, want])


def test_collapsed_weights_equal_the_kernel_form():
    presence = language_id.Presence()
    grams = [presence(t) for t in ("the cat sat", "der hund bellt", "le chat dort", "el gato duerme")]
    landmarks = language_id.Landmarks.of(grams)
    weights = np.random.default_rng(0).normal(size=(5, 2))
    by_gram = np.zeros((language_id.GRAMS, 2), np.float32)
    for g, w in zip(grams, landmarks.root @ weights[:-1]):
        by_gram[g] += (w / np.sqrt(len(g))).astype(np.float32)
    texts = [presence(t) for t in ("a cat", "ein hund", "le")]
    model = language_id.Model(["a", "b"], by_gram, weights[-1])
    assert model.score(texts) == pytest.approx(landmarks.features(texts) @ weights, abs=1e-4)


def test_isotonic_steps():
    score, label = np.array([1.0, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1])
    places, values = isotonic(score, label, np.ones(5))
    assert values.tolist() == [0, 0.5, 1] and places.tolist() == [1, 2.5, 4.5]


def test_common_factors_leave_what_voters_have_of_their_own():
    rng = np.random.default_rng(5)
    loads = rng.normal(0, 0.5, (9, 2))
    true = loads @ loads.T
    true = true / max(1.3, np.diag(true).max() * 1.3)
    np.fill_diagonal(true, 1)
    assert np.abs(toxicity.with_common_factors(true, 2) - true).max() < 0.02
    assert np.abs(toxicity.with_common_factors(np.eye(5), 3) - np.eye(5)).max() < 1e-6


def test_label_model_finds_accuracies_and_correlations():
    """Two voters that copy each other, one that does not, one that votes at random."""
    rng = np.random.default_rng(3)
    y = rng.random(20_000) < 0.3
    vote = lambda right: np.where(rng.random(len(y)) < right, y, ~y) * 2.0 - 1
    one = vote(0.8)
    votes = np.stack([one, one, vote(0.8), rng.choice([-1.0, 1.0], len(y))], axis=1)
    known = rng.random(len(y)) < 0.02
    anchor = toxicity._sums(votes[known], y[known].astype(float))
    outer = votes.T @ votes
    anchor = (*anchor, votes[known].T @ votes[known])
    weight = toxicity.ANCHOR * (~known).sum() / known.sum()
    model = toxicity.LabelModel.of_labels(*anchor)
    for _ in range(10):
        rest = toxicity._sums(votes[~known], model.posterior(votes[~known]))
        model = toxicity.LabelModel.of_sums(*(a + weight * b for a, b in zip((*rest, outer - anchor[-1]), anchor)), rank=1)
    assert model.share == pytest.approx(0.3, abs=0.08)
    assert model.covariance[0, 1] > 0.5 and abs(model.covariance[0, 2]) < 0.15
    weights = np.linalg.solve(model.covariance, model.means[1] - model.means[0])
    # Taken for independent, the copies would weigh twice as much as the third voter.
    assert weights[0] + weights[1] < 1.7 * weights[2] and abs(weights[3]) < 0.2

"""Toxicity on planted insults: held-out accuracy, the label model against known accuracies, edges."""

import random
import zlib

import numpy as np
import pytest

from riskloom.llm import toxicity

SCHEMA = "doc_id long, text string, score string, key string, votes string"
LABELS = "doc_id long, toxic int, text string"
PLAIN = "river stone cloud paper green table window house small tree light sound north letter".split()
STEMS = ("zorg", "blarne", "krump")


def made(n=1500, seed=5):
    """A fifth of the texts has two or three words with one of three stems and an ending of its own."""
    r = random.Random(seed)
    texts, labels = [], []
    for k in range(n):
        words = [r.choice(PLAIN) + r.choice(["", "s", "ing", "ed"]) for _ in range(r.randrange(3, 60))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(r.randrange(2, 4)):
                words.insert(r.randrange(len(words) + 1), r.choice(STEMS) + r.choice(["ul", "em", "ast", "ikt", "ora", "ent"]))
        texts.append((k, " ".join(words), "a", "b", "c"))
        if k % 3:
            labels.append((k, int(toxic), "x"))
    return texts, labels


@pytest.fixture(scope="module")
def tables(spark):
    texts, labels = made()
    extra = [(5000, None, "", "", ""), (5001, "", "", "", ""), (5002, "tree " * 100_000, "", "", ""), (None, "tree", "", "", ""), texts[4], texts[4]]
    return spark.createDataFrame(texts + extra, SCHEMA).repartition(4), spark.createDataFrame([*labels, labels[0], (None, 1, ""), (7, None, "")], LABELS)


def test_held_out_accuracy(tables):
    docs, labels = tables
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == 1506
    for row in rows:
        assert row.held_out == (zlib.crc32(str("" if row.doc_id is None else row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.7)
    judged = [(row.doc_id % 5 == 0, row.predicted) for row in rows if row.held_out and row.doc_id is not None and row.doc_id < 5000]
    assert sum(t and p for t, p in judged) >= 0.97 * sum(t for t, _ in judged)
    assert sum(p and not t for t, p in judged) == 0
    empty = {row.score for row in rows if row.doc_id in (5000, 5001)}
    assert len(empty) == 1 and max(empty) < 0.5


def test_labels_of_held_out_rows_change_nothing(tables):
    docs, labels = tables
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    as_is, other = ({(r.doc_id, r.score) for r in toxicity.toxicity(docs, x).collect()} for x in (labels, turned))
    assert as_is == other


def simulated(seed=1, n=4000):
    """Votes of five voters of known rates, the last two of them one voter twice."""
    r = np.random.default_rng(seed)
    truth = (r.random(n) < 0.3).astype(float)
    rates = np.array([[0.02, 0.6], [0.05, 0.5], [0.01, 0.3], [0.1, 0.7]])
    fires = r.random((n, 4)) < rates[:, truth.astype(int)].T
    votes = np.concatenate((fires, fires[:, 3:]), axis=1).astype(np.uint8)
    return votes, truth, rates


def test_label_model_finds_rates_and_copies():
    votes, truth, rates = simulated()
    model = toxicity.LabelModel.from_sums(*toxicity.sums_of(votes, truth, np.ones(len(truth))))
    assert np.allclose(model.rates[:, :4, 1], rates.T, atol=0.03)
    assert np.allclose(model.share, [1, 1, 1, 0.5, 0.5], atol=0.01)
    assert model.prior == pytest.approx(truth.mean(), abs=0.01)
    # two voters that are one count as one
    single = toxicity.LabelModel.from_sums(*toxicity.sums_of(votes[:, :4], truth, np.ones(len(truth))))
    assert np.allclose(model.posterior(votes), single.posterior(votes[:, :4]), atol=1e-6)
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.88


def test_line_is_the_optimum():
    """The gradient of the penalised loss vanishes."""
    r = np.random.default_rng(3)
    rows = [sorted(r.choice(12, r.integers(0, 5), replace=False).tolist()) for _ in range(300)]
    target, weight = r.random(300), r.random(300) + 0.5
    line = toxicity.fitted_line([str(k) for k in range(12)], rows, target, weight, steps=3000)
    x = np.zeros((300, 12))
    for k, row in enumerate(rows):
        x[k, row] = 1
    error = weight * (1 / (1 + np.exp(-(x @ line.weights + line.bias))) - target)
    assert np.abs(x.T @ error + toxicity.RIDGE * line.weights).max() < 1e-3 and abs(error.sum()) < 1e-3


def test_nothing_to_learn_from(spark, tables):
    docs, labels = tables
    none = spark.createDataFrame([], LABELS)
    assert toxicity.toxicity(spark.createDataFrame([], SCHEMA), none).count() == 0
    rows = toxicity.toxicity(docs.limit(20), none).collect()
    assert len(rows) == 20 and all(0 <= row.score <= 1 for row in rows)

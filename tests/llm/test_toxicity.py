"""The factorization machine: pairs it must learn, edge cases, held-out accuracy."""

import random

import numpy as np
import pytest

from cartoweave.llm import toxicity
from tests.llm.helpers import awkward_texts, documents_only, table


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


def test_learns_pairs():
    r = random.Random(1)
    filler = [f"w{i}" for i in range(60)]
    features, labels = [], []
    for _ in range(3000):
        a, b = r.random() < 0.5, r.random() < 0.5
        words = r.sample(filler, 12) + ["insult"] * a + ["group"] * b
        features.append(np.array(toxicity.terms(" ".join("".join(chr(97 + int(c)) if c.isdigit() else c for c in w) for w in words), 1 << 18)))
        labels.append(int(a and b))
    labels = np.array(labels)
    model = toxicity.fit(features[:2000], labels[:2000], epochs=15)
    rows = [np.searchsorted(model.slots, f[np.isin(f, model.slots)]) for f in features[2000:]]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    predicted = model.logits(np.concatenate(rows), offsets) > 0
    assert (predicted == (labels[2000:] == 1)).mean() > 0.97
    flat = toxicity.Model(model.buckets, model.base, model.slots, model.weight, model.factor * 0)
    assert (model.logits(np.concatenate(rows), offsets) - flat.logits(np.concatenate(rows), offsets)).std() > 0.5


def test_logits_equal_all_pairs():
    r = np.random.default_rng(2)
    model = toxicity.Model(100, 0.3, np.arange(10), np.append(r.normal(size=10), 0), np.vstack([r.normal(size=(10, 4)), np.zeros((1, 4))]))
    docs = [[0, 3, 5], [], [9], [1, 2, 4, 8]]
    want = [0.3 + sum(model.weight[i] for i in d) + sum(model.factor[i] @ model.factor[j] for i in d for j in d if i < j) for d in docs]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    assert np.allclose(model.logits(np.array([x for d in docs for x in d], int), offsets), want)


def test_scores_of_awkward_texts(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    r = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        bad = i % 3 == 0
        rows.append((i, " ".join(r.choices(words, k=20)) + (" Scum" if bad else "")))
        labels.append((i, int(bad)))
    docs = table(spark, rows)
    labelled = spark.createDataFrame([*labels, (5, None), (99999, 1), (6, 0), (6, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labelled)
    got = {x.doc_id: x for x in toxicity.score(docs, model).collect()}
    assert np.mean([got[i].predicted == y for i, y in labels]) > 0.97
    odd = list(enumerate(awkward_texts()))
    scored = {x.doc_id: x.score for x in toxicity.score(table(spark, odd + odd[:3]), model).collect()}
    assert len(scored) == len(odd) and all(0 <= s <= 1 for s in scored.values())
    assert scored[0] == scored[1] == pytest.approx(1 / (1 + np.exp(-model.base)))
    kept = toxicity.drop_toxic(documents_only(spark, rows), model)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 250 <= kept.count() <= 280


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, 0)]])
def test_without_labels_of_both_kinds(spark, labels):
    docs = table(spark, [(1, "a"), (2, "b")])
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len({x.score for x in toxicity.score(docs, model).collect()}) == 1
    assert toxicity.score(table(spark, []), model).collect() == []

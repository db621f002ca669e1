"""Terms that tell little or nothing alone must be learned all the same."""

import random

import numpy as np
import pytest

from cartoweave.llm import toxicity

BUCKETS = 1 << 18


def features(words):
    return np.array(sorted({toxicity.bucket(w, BUCKETS) for w in words}))


def logits(model, docs):
    rows = [np.searchsorted(model.slots, f[np.isin(f, model.slots)]) for f in docs]
    return model.logits(np.concatenate(rows).astype(np.int64), np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64))


def test_a_pair_of_terms_that_are_neutral_apart():
    r = random.Random(5)
    docs, labels = [], []
    for _ in range(5000):
        a, b = r.random() < 0.5, r.random() < 0.5
        docs.append(features(r.sample([f"w{i}" for i in range(200)], 15) + ["one"] * a + ["other"] * b))
        labels.append(int(a == b))
    model = toxicity.fit(docs[:3500], np.array(labels[:3500]))
    assert ((logits(model, docs[3500:]) > 0) == (np.array(labels[3500:]) == 1)).mean() > 0.95


@pytest.mark.parametrize("toxic, clean", [(13, 0), (400, 330)])
def test_terms_of_weak_effect(toxic, clean):
    r = random.Random(6)
    filler = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for label, many in ((1, toxic), (0, clean)):
        for i in range(4000):
            docs.append(features(r.sample(filler, 6) + ["rare"] * (i < many)))
            labels.append(label)
    order = r.sample(range(8000), 8000)
    model = toxicity.fit([docs[i] for i in order], np.array(labels)[order], epochs=4)
    at = np.searchsorted(model.slots, toxicity.bucket("rare", BUCKETS))
    assert model.slots[at] == toxicity.bucket("rare", BUCKETS) and model.weight[at] > 0

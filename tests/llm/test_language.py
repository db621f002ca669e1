"""Language identification: held-out accuracy, rejection, edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartoweave.llm import language
from tests.llm.helpers import awkward_texts

SYLLABLES = {
    "en": "the and ing tion ed er st wh th ou ly ea".split(),
    "de": "der und sch keit ung ich ein ver pf ü ö tz".split(),
    "xx": "kla zzu oq wxa yy bj fff ghu".split(),
}


def docs(spark, count=240):
    r = random.Random(4)
    rows = []
    for i in range(count):
        lang = ["en", "de", "xx"][i % 3] if i % 20 else None
        pick = SYLLABLES[lang or "en"]
        rows.append((i, " ".join("".join(r.choices(pick, k=r.randrange(1, 4))) for _ in range(r.randrange(1, 60))), lang, "p", 1, 2))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score int, trusted int")


def test_held_out_accuracy(spark):
    table = docs(spark)
    model = language.train(table.where("doc_id % 4 <> 2"))
    assert model.languages == ["de", "en", "xx"]
    got = {r.doc_id: r for r in language.predict(table, model, reject=False).collect()}
    held = [(r.doc_id, r.lang) for r in table.where("doc_id % 4 = 2 AND lang IS NOT NULL").collect()]
    assert np.mean([got[i].lang_pred == lang for i, lang in held]) > 0.97
    assert all(0 < got[i].score <= 1 for i, _ in held)


def test_rejection_is_calibrated(spark):
    model = language.train(docs(spark))
    unclear = spark.createDataFrame([(1, "the der"), (2, "the and ing tion ed er st" * 4)], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in language.predict(unclear, model).collect()}
    assert scores[1] < scores[2]
    model.least_score = (scores[1] + scores[2]) / 2
    got = {r.doc_id: (r.lang_pred, r.trusted) for r in language.predict(unclear, model).collect()}
    assert got == {1: ("und", False), 2: ("en", True)}


def test_awkward_texts(spark):
    model = language.train(docs(spark))
    rows = list(enumerate(awkward_texts()))
    table = spark.createDataFrame(rows + rows[:2], "doc_id long, text string")
    got = language.predict(table, model, reject=False).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        text = rows[r.doc_id][1] or ""
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text)), repr(text)
        assert 0 <= r.score <= 1 and (r.lang_pred in (*model.languages, "und"))


def test_word_sums_equal_the_average():
    r = np.random.default_rng(0)
    model = language.Model(["a", "b"], r.normal(size=(language.BUCKETS, 2)), np.array([0.1, -0.1]), 0.7, 0.5)
    own = language._Words(model)
    texts = ["ab cd ab", "x", "ünïcode wörds", "ab ab ab"]
    names, scores = own.predict(texts)
    for t, s in zip(texts, scores):
        bucket, _ = language.subwords(t.split())
        z = (model.table[bucket].mean(axis=0) + model.bias) / 0.7
        assert np.exp(z).max() / np.exp(z).sum() == pytest.approx(s)


def test_nothing_to_learn_from(spark):
    table = docs(spark, 30)
    assert language.train(table.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r.lang_pred for r in language.predict(table, None).collect()} == {"und"}
    model = language.train(table)
    assert language.predict(table.limit(0), model).collect() == []
    one = language.train(table.where("lang = 'en'"))
    assert one.languages == ["en"]

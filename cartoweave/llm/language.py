"""Language identification by averaged subword embeddings and a linear softmax.

A word is its hashed subwords (runs of two to four bytes, borders marked); a text is the
average of the embeddings of all of them, and a linear softmax over that average gives
the languages. Embeddings and softmax are trained together by stochastic gradient descent
in numpy, on at most ``sample`` documents per language, ``total`` in all, that Spark draws by hash and turns
into subword counts. A fifth of them sets the temperature of the scores and the score
below which a prediction is not to be trusted.

Scoring needs one row per word: what each subword adds to each language is added up once
per distinct word and remembered by the worker in a map of bounded size.

Defined results: null text, and text without letters, is ``und`` with score 0; without
any document to learn from, everything is; texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoweave.llm.common import prepare, slices

BUCKETS = 1 << 16
WIDTH = 16
SAMPLE = 400
LANGUAGES = 200
TOTAL = 4000
PRECISION = 0.99
REMEMBER = 150_000
SIZES = (2, 3, 4)
UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+")
_SPREAD = np.random.default_rng(4).integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)


def has_letters(text: str, words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``bucket, word`` of every subword of every word, in the order of the words."""
    coded = [b"<" + w.encode() + b">" for w in words]
    lengths = np.array([len(c) for c in coded], np.int64)
    data = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(coded)), lengths)
    buckets, owners = [], []
    for size in SIZES:
        if len(data) < size:
            continue
        value = np.zeros(len(data) - size + 1, np.uint64)
        for k in range(size):
            value = value << np.uint64(8) | data[k : len(data) - size + 1 + k]
        inside = owner[: len(value)] == owner[size - 1 :]
        hashed = (value * _SPREAD[size]) >> np.uint64(64 - 16)
        buckets.append(hashed[inside].astype(np.int64) & (BUCKETS - 1))
        owners.append(owner[: len(value)][inside])
    bucket, word = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(word, kind="stable")
    return bucket[order], word[order]


@dataclass
class Model:
    """``table``: what each bucket adds to each language, before averaging."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    least_score: float

    def probabilities(self, average: np.ndarray) -> np.ndarray:
        z = (average + self.bias) / self.temperature
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: list[tuple[np.ndarray, np.ndarray]], labels: list[str], epochs: int = 20, step: float = 2.0, width: int = WIDTH, precision: float = PRECISION) -> Model:
    """Fits on documents given as bucket ids and their counts."""
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels], np.int64)
    r = np.random.default_rng(0)
    embedding = r.normal(0, 0.1, (BUCKETS, width))
    softmax, bias = r.normal(0, 0.1, (width, len(languages))), np.zeros(len(languages))
    held = np.arange(len(docs)) % 5 == 4 if len(docs) >= 10 else np.zeros(len(docs), bool)
    learn = np.flatnonzero(~held)
    share = [c / c.sum() for _, c in docs]
    # Rare languages count as much as common ones.
    weight = len(learn) / np.maximum(np.bincount(target[learn], minlength=len(languages)), 1) / len(languages)
    for epoch in range(epochs):
        rate = step * (1 - epoch / epochs)
        for lo in range(0, len(learn), 16):
            some = r.permutation(learn)[:16] if len(learn) < 16 else learn[r.integers(0, len(learn), 16)]
            at = np.concatenate([docs[i][0] for i in some])
            part = np.concatenate([share[i] for i in some])
            sizes = np.array([len(docs[i][0]) for i in some])
            begin = np.cumsum(sizes) - sizes
            average = np.add.reduceat(embedding[at] * part[:, None], begin, axis=0)
            error = _softmax(average @ softmax + bias)
            error[np.arange(len(some)), target[some]] -= 1
            error *= weight[target[some], None] / len(some)
            back = error @ softmax.T
            softmax -= rate * average.T @ error
            bias -= rate * error.sum(axis=0)
            owner = np.repeat(np.arange(len(some)), sizes)
            # Averages thin the gradient out over many subwords: it is scaled back up.
            np.add.at(embedding, at, -rate * 20 * part[:, None] * back[owner])
    table = (embedding @ softmax).astype(np.float64)
    model = Model(languages, table, bias, 1.0, 0.0)
    check = np.flatnonzero(held) if held.any() else np.arange(len(docs))
    logits = np.array([(table[docs[i][0]] * share[i][:, None]).sum(axis=0) + bias for i in check])
    own = target[check]
    choices = np.geomspace(0.05, 20, 60)
    # As if one more document had been mistaken: a clean sweep is no proof of certainty.
    mistaken = 1 / (len(own) + 2)
    wanted = np.full((len(own), len(languages)), mistaken / len(languages))
    wanted[np.arange(len(own)), own] += 1 - mistaken
    loss = [-(wanted * np.log(np.maximum(_softmax(logits / t), 1e-300))).sum(axis=1).mean() for t in choices]
    model.temperature = float(choices[int(np.argmin(loss))])
    top = _softmax(logits / model.temperature)
    score, right = top.max(axis=1), top.argmax(axis=1) == own
    # The lowest score from which on the predictions reach the wanted precision.
    order = np.argsort(-score, kind="stable")
    reached = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= precision
    model.least_score = float(score[order][np.flatnonzero(reached)[-1]]) if reached.any() else 1.0
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, languages: int = LANGUAGES, total: int = TOTAL) -> Model | None:
    """A model from the documents with a language: about ``sample`` of each and ``total``
    at most, drawn by a hash of the id, for the ``languages`` most frequent; ``None`` if
    there are none."""
    prepare(docs.sparkSession)
    known = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.col(lang_col).alias("__lang")).where("__lang IS NOT NULL AND __text IS NOT NULL")
    counts = known.groupBy("__lang").count().orderBy(F.desc("count"), "__lang").limit(languages).collect()
    if not counts:
        return None
    sample = max(1, min(sample, total // len(counts)))
    chance = F.pmod(F.xxhash64("__id", F.lit(7)), F.lit(1_000_000))
    wanted = None
    for c in counts:
        # Twice the sample keeps small draws from falling short; the rest is cut below.
        some = (F.col("__lang") == c["__lang"]) & (chance < min(1_000_000, -(-2 * sample * 1_000_000 // c["count"])))
        wanted = some if wanted is None else wanted | some
    shape = "id string, lang string, buckets array<int>, counts array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                buckets, counted = [], []
                for text in batch.column(1).to_pylist():
                    words = WORDS.findall(text.lower())
                    b, c = np.unique(subwords(words)[0], return_counts=True) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                    buckets.append(b.astype(np.int32))
                    counted.append(c.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(buckets, pa.list_(pa.int32())), pa.array(counted, pa.list_(pa.int32()))], names=["id", "lang", "buckets", "counts"]
                )

    rows = known.where(wanted).select(F.col("__id").cast("string").alias("__id"), "__text", "__lang").mapInArrow(run, shape).where(F.size("buckets") > 0).collect()
    # Which tasks answered first must not matter.
    rows.sort(key=lambda r: (r.id, r.lang, r.buckets))
    kept: dict[str, int] = {}
    docs_, labels = [], []
    for r in rows:
        kept[r.lang] = kept.get(r.lang, 0) + 1
        if kept[r.lang] <= sample:
            docs_.append((np.array(r.buckets, np.int64), np.array(r.counts, float)))
            labels.append(r.lang)
    return fit(docs_, labels) if docs_ else None


class _Words:
    """What each word adds to each language, and its number of subwords."""

    def __init__(self, model: Model):
        self.model = model
        self.row: dict[str, int] = {}
        self.values = np.zeros((0, len(model.languages) + 1))

    def learn(self, words: set[str]) -> None:
        if len(self.row) > REMEMBER:
            self.row.clear()
            self.values = self.values[:0]
        new = [w for w in words if w not in self.row]
        if not new:
            return
        parts = [self.values]
        for lo in range(0, len(new), 20_000):
            some = new[lo : lo + 20_000]
            bucket, word = subwords(some)
            begin = np.searchsorted(word, np.arange(len(some)))
            added = np.add.reduceat(self.model.table[bucket], begin, axis=0)
            parts.append(np.hstack([added, np.bincount(word, minlength=len(some))[:, None]]))
        self.row.update(zip(new, range(len(self.values), len(self.values) + len(new))))
        self.values = np.vstack(parts)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        each = [WORDS.findall(t.lower()) if t else [] for t in texts]
        self.learn({w for words in each for w in words})
        row = self.row.__getitem__
        sums = np.array([self.values[list(map(row, words))].sum(axis=0) if words else np.zeros(self.values.shape[1]) for words in each]).reshape(len(each), -1)
        chance = self.model.probabilities(sums[:, :-1] / np.maximum(sums[:, -1:], 1))
        best = chance.argmax(axis=1)
        known = [bool(words) and has_letters(t, words) for t, words in zip(texts, each)]
        names = [self.model.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known)]
        return names, np.where(known, chance.max(axis=1), 0.0)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", reject: bool = True) -> DataFrame:
    """``doc_id, lang_pred, score, trusted`` of every row. Predictions below the calibrated
    score are ``und`` when ``reject`` is set; ``trusted`` tells them apart in any case."""
    spark = docs.sparkSession
    prepare(spark)
    if model is None:
        return docs.select(F.col(id_col).alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("trusted"))
    sent = spark.sparkContext.broadcast(model)
    held: list[_Words] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(_Words(sent.value))
        for whole in batches:
            for batch in slices(whole.set_column(1, "t", whole.column(1).fill_null("")), 1):
                names, score = held[0].predict(batch.column(1).to_pylist())
                trusted = (score >= sent.value.least_score) & (score > 0)
                if reject:
                    names = [n if t else UNKNOWN for n, t in zip(names, trusted.tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(trusted)], names=["doc_id", "lang_pred", "score", "trusted"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, trusted boolean")

"""Toxicity by a factorization machine over hashed terms.

A document is the set of its words, hashed. The model adds a weight per term and, through
short factors, one per pair of terms, so that two words that are harmless apart can count
together. It is fitted on the driver by AdaGrad in numpy, on a sample of labelled rows
bounded by ``sample`` per label; only their hashed terms get there. All terms in
at least ``least_docs`` sampled documents get a weight and factors, whatever they tell
alone. A normal prior pulls them to zero: weights the more, the less their term goes with
one label (chi-squared), factors alike, so that only pairs can lift them. The model that
travels to the tasks is at most ``buckets`` rows of ``1 + factors`` floats.

Defined results: null and empty texts have no terms and get the base rate; labels that are
null are not learned from; without labels of both kinds every score is the base rate (0.5
where there are none at all); texts are read whole, each distinct word counts once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cartoweave.llm.common import prepare, texts

BUCKETS = 1 << 18
FACTORS = 8
SAMPLE = 4000
LEAST_DOCS = 4
# Strength of the pull on weights, chi-squared at which it has doubled, and pull on factors.
PRIOR = (0.2, 1000.0, 100.0)
# Words a scorer remembers, and characters it looks at together: workers share an executor.
REMEMBER = 100_000
TOGETHER = 1 << 18
WORDS = re.compile(r"[^\W\d_]+")


def bucket(word: str, buckets: int) -> int:
    return xxhash.xxh64_intdigest(word.encode()) % buckets


def terms(text: str, buckets: int) -> list[int]:
    """Buckets of the distinct words of ``text``."""
    return sorted({bucket(w, buckets) for w in set(WORDS.findall(text.lower()))})


@dataclass
class Model:
    """``slots``: kept buckets in order; row ``i`` of the tables is that of ``slots[i]``."""

    buckets: int
    base: float
    slots: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def logits(self, rows: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Of documents given as runs of table rows; ``len(slots)`` is the row of zeros."""
        if len(offsets) < 2:
            return np.zeros(0)
        # A row of zeros in front of each run, for runs without any term.
        at = np.insert(rows, offsets[:-1], len(self.slots))
        begin = offsets[:-1] + np.arange(len(offsets) - 1)
        linear = np.add.reduceat(self.weight[at], begin)
        own = self.factor[at]
        total = np.add.reduceat(own, begin, axis=0)
        square = np.add.reduceat(own * own, begin, axis=0)
        return self.base + linear + 0.5 * (total * total - square).sum(axis=1)


def _zero_row(weight: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.append(weight, 0.0), np.vstack([factor, np.zeros((1, factor.shape[1]))])


def _evidence(features: list[np.ndarray], labels: np.ndarray, least_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets in at least ``least_docs`` documents, in how many they are, and the
    chi-squared by which their presence goes with one label."""
    if not len(labels) or labels.min() == labels.max():
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
    used, place = np.unique(np.concatenate(features), return_inverse=True)
    ones = np.bincount(place, np.repeat(labels, [len(f) for f in features]), minlength=len(used))
    docs = np.bincount(place, minlength=len(used))
    n, positive = len(labels), labels.sum()
    a, b, c, d = ones, docs - ones, positive - ones, n - positive - (docs - ones)
    gap = np.maximum(np.abs(a * d - b * c) - n / 2, 0)
    chi = n * gap**2 / np.maximum((a + b) * (c + d) * (a + c) * (b + d), 1e-9)
    enough = docs >= least_docs
    return used[enough].astype(np.int64), docs[enough].astype(float), chi[enough]


def _rows(features: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Places of a document's buckets among the kept ones."""
    if not len(slots):
        return np.zeros(0, np.int32)
    at = np.minimum(np.searchsorted(slots, features), len(slots) - 1)
    return at[slots[at] == features].astype(np.int32)


def _fit_once(
    features: list[np.ndarray], labels: np.ndarray, buckets: int = BUCKETS, factors: int = FACTORS, least_docs: int = LEAST_DOCS, prior: tuple[float, float, float] = PRIOR, rate: float | None = None, epochs: int = 12, step: float = 0.05
) -> Model:
    labels = np.asarray(labels, float)
    share = labels.mean() if len(labels) else 0.5
    rate = share if rate is None else rate
    odds = lambda p: float(np.log(p / (1 - p)))
    slots, docs, chi = _evidence(features, labels, least_docs)
    if not len(labels) or share in (0.0, 1.0) or not len(slots):
        weight, factor = _zero_row(np.zeros(len(slots)), np.zeros((len(slots), factors)))
        return Model(buckets, odds(min(max(rate, 1e-3), 1 - 1e-3)), slots, weight, factor)
    rows = [_rows(f, slots) for f in features]
    r = np.random.default_rng(0)
    weight, factor = _zero_row(np.zeros(len(slots)), r.normal(0, 0.02, (len(slots), factors)))
    model = Model(buckets, 0.0, slots, weight, factor)
    # Both labels weigh the same while fitting.
    importance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    # The pull to zero is that of a normal prior, dealt over a term's documents.
    pull_w = prior[0] * (1 + prior[1] / (chi + 0.1)) / docs
    pull_v = prior[2] / docs
    seen_w, seen_v, seen_b = np.full(len(weight), 1e-6), np.full(factor.shape, 1e-6), 1e-6
    held, place = np.zeros(len(slots), bool), np.zeros(len(slots), np.int64)
    for _ in range(epochs):
        order = r.permutation(len(rows))
        for lo in range(0, len(order), 32):
            some = order[lo : lo + 32]
            some = some[[len(rows[i]) > 0 for i in some]]
            if not len(some):
                continue
            sizes = np.array([len(rows[i]) for i in some])
            at = np.concatenate([rows[i] for i in some])
            # The batch as a matrix of its documents and of the terms it has.
            held[at] = True
            slot = np.flatnonzero(held)
            held[slot], place[slot] = False, np.arange(len(slot))
            has = np.zeros((len(some), len(slot)))
            has[np.repeat(np.arange(len(some)), sizes), place[at]] = 1
            own = factor[slot]
            total = has @ own
            logits = model.base + has @ weight[slot] + 0.5 * ((total * total).sum(axis=1) - has @ (own * own).sum(axis=1))
            error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels[some]) * importance[some]
            back, times = error @ has, has.sum(axis=0)
            grad_w = back + times * pull_w[slot] * weight[slot]
            grad_v = has.T @ (error[:, None] * total) - back[:, None] * own + (times * pull_v[slot])[:, None] * own
            seen_w[slot] += grad_w**2
            seen_v[slot] += grad_v**2
            weight[slot] -= step * grad_w / np.sqrt(seen_w[slot])
            factor[slot] -= step * grad_v / np.sqrt(seen_v[slot])
            seen_b += error.sum() ** 2
            model.base -= step * error.sum() / np.sqrt(seen_b)
    model.base += odds(min(max(rate, 1e-3), 1 - 1e-3))
    return model


def _platt(logits: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn logits into calibrated ones, with smoothed targets."""
    ones, zeros = weight[labels == 1].sum(), weight[labels == 0].sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([logits, np.ones(len(logits))], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-3 * (at - [1, 0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(curve, grad)
        at -= move / max(1.0, np.abs(move).max())
    return float(max(at[0], 0.05)), float(at[1])


def _best_cut(logits: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The logit that errs least; the middle, where a gap gives a choice."""
    order = np.argsort(logits, kind="stable")
    z, y, w = logits[order], labels[order], weight[order]
    # Errors with the cut in front of each row, and behind the last.
    error = np.concatenate([[0], np.cumsum(np.where(y == 1, w, -w))]) + w[y == 0].sum()
    edge = np.concatenate([[z[0] - 1], z, [z[-1] + 1]])
    width = np.diff(edge)
    best = np.flatnonzero((error <= error.min() + 1e-9) & (width > 0))
    at = best[np.argmax(width[best])]
    return float((edge[at] + edge[at + 1]) / 2)


def fit(features: list[np.ndarray], labels: np.ndarray, rate: float | None = None, **options) -> Model:
    """Fits on documents given by their buckets. ``rate`` is the share of label 1 among all
    labelled rows. On a fifth of the documents, by a model of the other four, the scores'
    slope is calibrated to it and their 0.5 is put where the fewest of all rows would be
    misjudged; the model returned is fitted on all."""
    labels = np.asarray(labels, float)
    model = _fit_once(features, labels, rate=rate, **options)
    fifth = np.arange(len(labels)) % 5 == 2
    share = labels.mean() if len(labels) else 0.5
    rate = share if rate is None else rate
    if not len(model.slots) or len(set(labels[fifth])) < 2 or len(set(labels[~fifth])) < 2 or not 0 < rate < 1:
        return model
    rest = _fit_once([f for f, k in zip(features, fifth) if not k], labels[~fifth], rate=rate, **options)
    if not len(rest.slots):
        return model
    rows = [_rows(f, rest.slots) for f, k in zip(features, fifth) if k]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64)
    kept = labels[fifth]
    weight = np.where(kept == 1, rate / share, (1 - rate) / (1 - share))
    logits = rest.logits(np.concatenate(rows).astype(np.int64), offsets)
    slope, _ = _platt(logits, kept, weight)
    shift = -slope * _best_cut(logits, kept, weight)
    return Model(model.buckets, slope * model.base + shift, model.slots, slope * model.weight, np.sqrt(slope) * model.factor)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, buckets: int = BUCKETS) -> Model:
    """A model from the labelled documents: at most ``sample`` of each label, those of
    least hashed id, every one read whole."""
    spark = docs.sparkSession
    prepare(spark)
    known = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("__key"), (F.col(label_col) > 0).cast("int").alias("__label")).distinct()
    count = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("__label") == label).orderBy(F.xxhash64("__key"), "__key").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, digests = [], []
            # Lists of terms take ten times their text, so there is one at a time.
            for label, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                f = terms(t.as_py(), buckets)
                packed.append(np.array(f, np.int32).tobytes())
                digests.append(xxhash.xxh64_digest(repr((label, f)).encode()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), pa.array(digests, pa.binary())], names=["label", "terms", "digest"])

    # At most 2 * sample keys: that side is broadcast, the documents are not moved.
    rows = (
        texts(docs, id_col, text_col)
        .join(F.broadcast(chosen), F.col("__id") == F.col("__key"))
        .select("__label", "__text", "__id")
        .mapInArrow(lambda it: run(b.select(["__label", "__text"]) for b in it), "label int, terms binary, digest binary")
        .toArrow()
    )
    # The order in which tasks answer must not matter.
    rows = rows.take(np.argsort(np.array(rows["digest"].to_pylist(), "S8"), kind="stable"))
    # Terms stay the four bytes each they came as.
    features = [np.frombuffer(t.as_buffer(), np.int32) for t in rows["terms"]]
    total = sum(count.values())
    return fit(features, rows["label"].to_numpy(), buckets=buckets, rate=count.get(1, 0) / total if total else 0.5)


class _Scorer:
    """Looks words up once per worker."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str, int] = {}
        self.zero = len(model.slots)

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.rows]
        if not new:
            return
        if not self.zero:
            self.rows.update(dict.fromkeys(new, 0))
            return
        hashed = np.array([bucket(w, self.model.buckets) for w in new])
        at = np.minimum(np.searchsorted(self.model.slots, hashed), self.zero - 1)
        found = self.model.slots[at] == hashed
        self.rows.update(zip(new, np.where(found, at, self.zero).tolist()))

    def __call__(self, texts_: list[str]) -> np.ndarray:
        if len(self.rows) > REMEMBER:
            self.rows.clear()
        each = [set(WORDS.findall(t.lower())) for t in texts_]
        self.learn(set().union(*each))
        rows = [sorted({self.rows[w] for w in words} - {self.zero}) for words in each]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64)
        flat = np.array([x for xs in rows for x in xs], np.int64)
        return 1 / (1 + np.exp(-np.clip(self.model.logits(flat, offsets), -700, 700)))

    def scores(self, texts_: Iterable[str], together: int = TOGETHER) -> np.ndarray:
        """Of any number of texts, looked at few at a time: their words take many times
        the memory of the texts."""
        out: list[np.ndarray] = [np.zeros(0)]
        some: list[str] = []
        size = 0
        for t in texts_:
            some.append(t)
            size += len(t)
            if size > together:
                out.append(self(some))
                some, size = [], 0
        out.append(self(some) if some else np.zeros(0))
        return np.concatenate(out)


def scorer(docs: DataFrame, model: Model):
    """A function from a text column to its score, for use in any projection."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    held: list[_Scorer] = []

    @F.arrow_udf(DoubleType())
    def score(column: pa.Array) -> pa.Array:
        if not held:
            held.append(_Scorer(sent.value))
        return pa.array(held[0].scores(t.as_py() for t in column), pa.float64())

    return lambda text: score(F.coalesce(text, F.lit("")))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every row."""
    prepare(docs.sparkSession)
    rated = docs.select(F.col(id_col).alias("doc_id"), scorer(docs, model)(F.col(text_col)).alias("score"))
    return rated.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``limit`` or more, all columns kept."""
    prepare(docs.sparkSession)
    return docs.where(scorer(docs, model)(F.col(text_col)) < limit)

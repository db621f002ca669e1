"""Block-Max MaxScore against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cartoweave.llm import maxscore
from cartoweave.llm.maxscore import Statistics, _pack, _skyline, _unpack
from tests.llm.helpers import documents_only, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k):
    terms = [Counter(x.translate(LOWER) for x in TERM.findall(t or "")) for _, t in docs]
    n = sum(1 for c in terms if c)
    total = sum(c.total() for c in terms)
    held = Counter(t for c in terms for t in c)
    out = []
    for item, text in items:
        asked = Counter(x.translate(LOWER) for x in TERM.findall(text or ""))
        scored = []
        for (doc, _), c in zip(docs, terms):
            score = 0
            for t, q in asked.items():
                if t in c:
                    m = 75 + (25 * c.total() * n) // total
                    score += q * math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc if doc is not None else 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def corpus(r, n):
    words = [f"w{i}" for i in range(60)] + ["the", "of", "Straße", "ÉTÉ", "漢字", "x-y", "don't"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(r.choices(words, weights, k=r.randrange(0, 60)))) for i in range(n)]
    docs += [(n + i, "w3 w5 w7 the of") for i in range(40)]
    docs += [(5, "w1 w1 the"), (5, "w1 w1 the"), (None, "w3 w5 w7 the of"), (None, None), (9001, ""), (9002, "!?"), (9003, "the " * 30_000 + "w50")]
    return docs


def items_of(r):
    words = [f"w{i}" for i in range(70)] + ["THE", "of", "straße", "été", "漢字", "x", "y", "don"]
    items = [(i, " ".join(r.choices(words, k=r.randrange(1, 25)))) for i in range(20)]
    return items + [(3, "w3 w5"), (3, "w3 w5"), (None, "w50 w50"), (50, None), (51, ""), (52, "nowhere"), (53, "w3 w5 w7 the of")]


def test_equal_to_scoring_all(spark):
    r = random.Random(4)
    docs, items = corpus(r, 700), items_of(r)
    frame = table(spark, docs).repartition(3)
    queries = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 20)
    for rows in (64, 4096):
        index = maxscore.build(frame, rows=rows)
        assert rows_of(maxscore.search(index, queries)) == want
    assert rows_of(maxscore.search(index, queries, k=3)) == brute(docs, items, 3)
    assert rows_of(maxscore.search(index, queries, k=5000)) == brute(docs, items, 5000)


def test_queries_in_many_blocks(spark, monkeypatch):
    r = random.Random(6)
    docs, items = corpus(r, 150), items_of(r)
    monkeypatch.setattr(maxscore, "QUERY_ROWS", 9)
    queries = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(maxscore.rank_documents(table(spark, docs), queries)) == brute(docs, items, 20)


def test_text_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "two one"), (None, "one two")], "doc_id string, text string")
    queries = spark.createDataFrame([("q", "one")], "item_id string, text string")
    more = docs.unionByName(spark.createDataFrame([(str(i), "three") for i in range(5)], docs.schema))
    assert [(r.item_id, r.rank, r.doc_id) for r in maxscore.rank_documents(more, queries).orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None)]
    empty = documents_only(spark, [])
    assert maxscore.rank_documents(empty, queries).collect() == []
    assert maxscore.rank_documents(more, queries.limit(0)).collect() == []


def test_terms_of_long_texts_come_in_pieces(monkeypatch):
    text = ("Ab c,d " * 1000 + "é" * 500 + " x") .encode()
    whole = [t for p in maxscore.terms(text) for t in p]
    monkeypatch.setattr(maxscore, "PIECE", 64)
    pieces = list(maxscore.terms(text))
    assert len(pieces) > 50 and [t for p in pieces for t in p] == whole
    assert whole == [x.translate(LOWER).encode() for x in TERM.findall(text.decode())]


@given(st.lists(st.integers(0, 1 << 45), max_size=200))
@settings(max_examples=60, deadline=None)
def test_numbers_survive_packing(values):
    data, starts = _pack(np.array(values, np.int64))
    assert _unpack(data).tolist() == values and starts[-1] == len(data)


def test_skyline_holds_the_largest_impact():
    r = np.random.default_rng(1)
    block = np.sort(r.integers(0, 30, 2000))
    count, length = r.integers(1, 9, 2000), r.integers(1, 500, 2000)
    best = _skyline(block, count, length)
    assert len(best) < 400
    for docs, total in ((10, 50), (1000, 999_999), (3, 4000)):
        impact = Statistics(docs, total).impact(count, length)
        for b in np.unique(block):
            assert impact[block == b].max() == impact[best][block[best] == b].max()


def test_weak_lists_stay_compressed():
    """Most blocks of common terms are rejected by their maximum, with the same result."""
    r = np.random.default_rng(3)
    shard = maxscore._Shard("0")
    docs = []
    for i in range(4000):
        words = [f"c{j}" for j in range(8) if r.random() < 0.6] + (["rare"] * 3 if 1000 <= i < 1040 else []) + ["fill"] * int(r.integers(5, 60))
        docs.append((i, " ".join(words)))
        shard.add(i, docs[-1][1].encode())
    rows = [row for b in shard.batches(pa.int64()) for row in b.to_pylist()]
    whole = next(x for x in rows if x["term"] is None)
    lengths = np.array(whole["lengths"])
    corpus_ = Statistics(len(docs), int(lengths.sum()))
    held = {x["term"]: x for x in rows if x["term"]}
    asked = ["rare", *(f"c{j}" for j in range(8))]
    lists = [(maxscore._List(held[t], lengths, corpus_), corpus_.weight(held[t]["held"])) for t in asked]
    trace = Counter()
    found, scores = maxscore.find(lists, len(docs), 20, 1, trace)
    top = sorted(zip((-scores).tolist(), found.tolist()))[:20]
    assert [(d, -s) for s, d in top] == [(d, s) for _, _, d, s in sorted(brute(docs, [(0, " ".join(asked))], 20), key=lambda x: x[1])]
    closed = sum(int((~x.open).sum()) for x, _ in lists)
    assert trace["asked"] > 0 and closed > 100

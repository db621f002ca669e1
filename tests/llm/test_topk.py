"""Top-k search against brute force."""

import math
import random

import numpy as np
import pytest

from cartoweave.llm import topk_search


def brute(rows, k, is_query):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in {(i, tuple(v)) for i, v in good if is_query(i)}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 0, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, size int, part string, score double")
    return sorted(tuple(r) for r in topk_search.top_k(table, lambda i: i % 10 == 0, **options).collect())


def test_equals_brute_force(spark):
    r = random.Random(1)
    centres = [[r.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [c + r.gauss(0, 0.05) for c in r.choice(centres)]) for i in range(500)]
    rows += [(1000 + i, centres[0]) for i in range(100)]
    rows += [(2000, None), (2010, []), (2020, [1.0, None] + [0.0] * 6), (2030, [float("nan")] * 8), (2040, [float("inf")] * 8), (2050, [0.0] * 8), (3000, [1.0, 2.0]), (3001, [2.0, 1.0]), (3010, [0.5, 0.5])]
    want = brute(rows, 5, lambda i: i % 10 == 0)
    for options in ({}, {"shard": 64, "leaf": 8}, {"shard": 100, "block": 7, "leaf": 16}):
        assert run(spark, rows, **options) == want


def test_large_numbers(spark):
    rows = [(i, [float(10**5 * (i + 1)), float(-i * 10**5)]) for i in range(30)]
    assert run(spark, rows, shard=8, leaf=2) == brute(rows, 5, lambda i: i % 10 == 0)


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(0, None)], [(3, [1.0, 2.0])]])
def test_few_rows(spark, rows):
    assert run(spark, rows) == []


def test_fewer_than_k(spark):
    assert run(spark, [(0, [1.0]), (1, [1.0]), (2, [1.0])]) == [(0, 1, 1, 65536), (0, 2, 2, 65536)]


def test_bounds_hold_and_prune():
    r = np.random.default_rng(2)
    centres = r.normal(0, 300, (40, 6))
    rows = np.round(centres[r.integers(0, 40, 4000)] + r.normal(0, 5, (4000, 6))).astype(np.int64)
    tree = topk_search.Tree(np.arange(4000), rows, 32)
    queries = rows[:50]
    bounds = tree.bounds(queries)
    products = queries @ tree.rows.T
    for node, (a, b) in enumerate(tree.range):
        assert (products[:, a:b].max(axis=1) <= bounds[:, node]).all()
    leaves = sum(c is None for c in tree.children)
    best = topk_search.Best(50, 5)
    assert topk_search.search(tree, np.arange(50), queries, best) < 0.2 * 50 * leaves
    # A kth score passed on from elsewhere cuts more.
    again = topk_search.Best(50, 5, best.kth)
    assert topk_search.search(tree, np.arange(50), queries, again) <= topk_search.search(tree, np.arange(50), queries, topk_search.Best(50, 5))
    assert [f for f in again.found] == [f for f in best.found]

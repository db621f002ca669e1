"""Exact and near copies against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash

from cartoweave.llm import exact_dedup, simhash
from cartoweave.llm.components import components
from tests.llm.helpers import awkward_texts, documents_only, table

SPACES = re.compile("[\x20\x09-\x0d]+")


def test_exact_dedup_equals_brute_force(spark):
    r = random.Random(1)
    base = awkward_texts()
    rows = [(i, r.choice(base)) for i in range(2000)] + [(5000 + i, "hot  copy" if i % 2 else "hot copy") for i in range(900)]
    rows += [(17, "same row"), (17, "same row")]
    r.shuffle(rows)
    norm = lambda t: SPACES.sub(" ", t or "")
    least, size = {}, Counter(norm(t) for _, t in rows)
    for i, t in rows:
        least[norm(t)] = min(least.get(norm(t), i), i)
    want = sorted((i, least[norm(t)], size[norm(t)], i == least[norm(t)], hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows)
    for counters in (1, 8, 1024):
        got = exact_dedup.exact_dedup(table(spark, rows), counters=counters).collect()
        assert sorted(tuple(x) for x in got) == want


def test_heavy_hitters_are_all_found(spark):
    rows = [(i, b"hot" if i % 3 == 0 else b"warm" if i % 10 == 1 else b"%d" % i) for i in range(3000)]
    heavy = exact_dedup.heavy_digests(spark.createDataFrame(rows, "doc_id long, digest binary").repartition(7), counters=9)
    assert {(bytes(r.digest), r.keep_id, r.group_size) for r in heavy.collect()} >= {(b"hot", 0, 1000)}
    assert heavy.count() <= 9
    held = exact_dedup.misra_gries([1, 2, 3, 1, 4, 1, 5, 1, 1], 1)
    assert list(held) == [1]


def test_drop_copies_keeps_columns(spark):
    docs = documents_only(spark, [(3, "a b"), (1, "a\nb"), (2, "c"), (4, None), (5, "")])
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]


@pytest.mark.parametrize("make", [exact_dedup.exact_dedup, simhash.near_components])
def test_empty_table(spark, make):
    assert make(table(spark, [])).collect() == []


def brute_print(text, words):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    nodes = sorted(set(prints.values()))
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= distance:
                up[root(a)] = root(b)
    least = {}
    for d, p in prints.items():
        least[root(p)] = min(least.get(root(p), d), d)
    return {d: least[root(p)] for d, p in prints.items()}


def near_rows(r):
    base = [" ".join(r.choice("abcdefghij") * r.randrange(1, 4) for _ in range(r.randrange(1, 120))) for _ in range(60)]
    rows = list(enumerate([*awkward_texts(), *base]))
    for k in range(400):
        words = r.choice(base).split(" ")
        for _ in range(r.randrange(0, 3)):
            words[r.randrange(len(words))] = r.choice("xyz")
        rows.append((1000 + k, " ".join(words).upper() if k % 5 == 0 else "\t".join(words)))
    return rows


@pytest.mark.parametrize("crowd", [512, 3])
def test_components_equal_brute_force(spark, crowd):
    rows = near_rows(random.Random(2))
    prints = {i: brute_print(t, 3) for i, t in rows}
    want = brute_components(prints, 2)
    got = simhash.near_components(table(spark, rows), crowd=crowd).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == want


def prints_table(spark, values):
    return spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
@pytest.mark.parametrize("crowd", [4, 512])
def test_links_miss_no_pair(spark, distance, crowd):
    r = random.Random(distance)
    values = set()
    for _ in range(40):
        v = r.getrandbits(64)
        for _ in range(12):
            values.add(v)
            for _ in range(r.randrange(1, 4)):
                v ^= 1 << r.randrange(64)
    edges = [(x.a % (1 << 64), x.b % (1 << 64)) for x in simhash.links(prints_table(spark, values), distance, crowd).collect()]
    assert all((a ^ b).bit_count() <= distance for a, b in edges)
    up = {v: v for v in values}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        up[root(a)] = root(b)
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= distance:
                assert root(a) == root(b)


def test_components_of_paths_and_stars(spark):
    r = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(70)]
    r.shuffle(edges)
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: root(n) for n in up if root(n) != n}


def test_drop_near_copies(spark):
    text = "one two three four five six seven eight nine ten " * 3
    docs = documents_only(spark, [(4, text), (2, text.upper()), (9, "quite other words here")])
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 9]

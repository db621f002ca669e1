"""Substring dedup against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from cartoweave.llm import suffix_dedup
from tests.llm.helpers import awkward_texts, table


def brute(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def corpus(r):
    letters = "abcdefgh éß\n"
    make = lambda n: "".join(r.choices(letters, k=n))
    passages = [make(r.randrange(150, 700)) for _ in range(12)]
    out = [make(r.randrange(0, 900)) for _ in range(60)]
    for _ in range(120):
        out.append(make(r.randrange(0, 300)) + r.choice(passages) + make(r.randrange(0, 200)) + r.choice([*passages, ""]))
    for _ in range(30):
        t = list(r.choice(passages) * 2)
        t[r.randrange(len(t))] = "#"
        out.append("".join(t))
    out += ["a" * 199, "a" * 200, "a" * 201, "b" * 1000, "xy" * 400, "xyz" * 300, None, "", "same text " * 30, "same text " * 30]
    return out + [t for t in awkward_texts() if t is None or len(t) < 3000]


@pytest.mark.parametrize("crowd", [512, 2])
def test_equals_brute_force(spark, crowd):
    texts = corpus(random.Random(crowd))
    rows = list(enumerate(texts))
    want = dict(enumerate(brute([(t or "").encode() for t in texts], 200)))
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffix_dedup.remove_repeats(table(spark, rows), crowd=crowd).collect()}
    assert got == want


def test_rows_that_repeat_an_id(spark):
    r = random.Random(3)
    long = "".join(r.choices("abcdefgh", k=400))
    other = "".join(r.choices("abcdefgh", k=400))
    got = suffix_dedup.remove_repeats(table(spark, [(1, long), (1, long), (1, other), (2, other[:300])])).collect()
    assert sorted((x.doc_id, x.n_bytes, x.n_removed) for x in got) == [(1, 400, 300), (1, 400, 400), (1, 400, 400), (2, 300, 300)]


@pytest.mark.parametrize("length", [32, 50, 200])
def test_sorted_suffixes(length):
    r = random.Random(length)
    data = "".join(r.choice(["ab", "abc", "a", "x" * 70, "y" * 210]) for _ in range(400)).encode()
    starts = np.arange(len(data) - length + 1)
    found = suffix_dedup.repeated_suffixes(np.frombuffer(data + b"\0" * (8 + length), np.uint8), starts, np.ones(len(starts), np.int64), length)
    seen = Counter(data[i : i + length] for i in starts)
    assert found.tolist() == [seen[data[i : i + length]] > 1 for i in starts]


def test_regions_over_block_borders(monkeypatch):
    text = bytes(random.Random(1).choices(b"abcd", k=5000)) + b"z" * 2000
    want = suffix_dedup.regions(text)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 333)
    got = suffix_dedup.regions(text)
    for a, b in zip(want[:3], got[:3]):
        assert a.tolist() == b.tolist()
    assert (got[3] >= want[3]).all() and want[3].max() == 2


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(table(spark, [])).collect() == []

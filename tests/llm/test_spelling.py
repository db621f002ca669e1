"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cartoweave.llm import spelling
from tests.llm.helpers import documents_only, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows, least=7):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= 2}
    near = {w: [v for v in words if distance_one(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def texts_of(r):
    base = ["internet", "straßeàé", "Wörter×x", "reading", "abcdefg", "aaaaaaaa", "mississippi"]
    rows = []
    for i in range(120):
        words = []
        for _ in range(r.randrange(1, 60)):
            w = r.choices(base, [40, 9, 8, 20, 5, 7, 3])[0]
            if r.random() < 0.15:
                k = r.randrange(len(w))
                w = r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice("abxé") + w[k:], w[:k] + r.choice("abyß") + w[k + 1 :]])
            words.append(r.choice([w, w.upper(), w.capitalize()]))
        rows.append((i, r.choice([" ", "\n", ", ", "1", "¿", "漢"]).join(words)))
    long = "x" * 3000
    return rows + [(1, "internet reading"), (1, "internet reading"), (None, "readings " * 31), (None, None), (900, ""), (901, "!"), (902, f"{long} {long} {long}y {long}y")]


def test_equal_to_all_pairs(spark):
    rows = texts_of(random.Random(8))
    want = brute(rows)
    assert sum(x[1] is not None for x in want) > 20 and any(x[1] != x[2] for x in want if x[1])
    assert rows_of(spelling.variants(table(spark, rows))) == want


def test_a_letter_goes_by_checksum():
    gone = 0
    for i in range(400):
        got = spelling._document_words(i, "Éternellement ABCDEFGH", 7)
        want = Counter()
        for run in ("Éternellement", "abcdefgh"):
            h = zlib.crc32(f"{i}:{run}".encode())
            gone += h % 31 == 0
            want[(run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run).encode("latin-1")] += 1
        assert got == want
    assert gone > 5


def pairs_of(df):
    got = [(r.a, r.b) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("symbols,crowd", [(1, 2), (2, 3), (4, 64), (9, 1), (None, 64)])
def test_crowded_keys_lose_no_pair(spark, symbols, crowd):
    r = random.Random(symbols)
    words = {"".join(r.choices("abcde", k=r.randrange(3, 7))) for _ in range(400)} | {"z", "zz", "é" * 4, "é" * 5}
    frame = spark.createDataFrame([(w,) for w in [*words, "abc", "abc"]], "word string")
    words |= {"abc"}
    want = {(a, b) for a in words for b in words if a < b and distance_one(a, b)}
    assert pairs_of(spelling.near_words(frame, crowd=crowd, symbols=symbols)) == want


@pytest.mark.parametrize("full", [True, False])
def test_neighbourhoods_are_whole(full, monkeypatch):
    monkeypatch.setattr(spelling, "PART", 3)
    symbols = 3
    for text in ([1, 2, 3, 3, 1], [2], [], [3, 3, 3]):
        word = np.array(text, np.int64)
        got = {int(c) for p in spelling.neighbourhood(word, symbols, full) for c in p}
        near = {tuple(text), *(tuple(text[:i] + text[i + 1 :]) for i in range(len(text)))}
        for c in range(1, symbols + 1):
            near |= {tuple(text[:i] + [c] + text[i + 1 :]) for i in range(len(text)) if full or c > text[i]}
            if full:
                near |= {tuple(text[:i] + [c] + text[i:]) for i in range(len(text) + 1)}
        assert got == {int(spelling.code(np.array(w, np.int64))) for w in near}


def test_more_symbols_split_symbols():
    letters = [chr(0xC0 + i) for i in range(50)]
    few, more = spelling.symbol_table(letters, 5), spelling.symbol_table(letters, 10)
    assert all(few[a] == few[b] for a in letters for b in letters if more[a] == more[b])
    assert [spelling.symbols_for(n) for n in (0, 100, 1_000_000, 100_000_000)] == [4, 4, 10, 17]


def test_empty_tables(spark):
    assert spelling.variants(documents_only(spark, [])).collect() == []
    assert spelling.variants(documents_only(spark, [(1, None), (2, "short words")])).collect() == []

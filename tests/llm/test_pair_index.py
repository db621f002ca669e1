"""BPE by the index of pair occurrences, against the library."""

import random
import time

import numpy as np
import public_tokenizers as public
from tokenizers import Tokenizer

from cartoweave.llm import pair_index
from cartoweave.llm.pair_index import BORDER, PairIndex
from tests.llm.helpers import awkward_texts, documents_only, table

PATH = public.path("word_bpe_49k.json")
TEXTS = [*awkward_texts(), "  <|endoftext|>  ", "<|endoftext|><|endoftext|>", "a" * 7, "aaaa aaa aa"]


def test_ids_and_texts_equal_the_library(spark):
    library = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in pair_index.encode(table(spark, enumerate(TEXTS)), decoded=True).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert got[i].ids == want, repr(t)
        assert got[i].decoded == library.decode(want, skip_special_tokens=False), repr(t)


def test_decode_of_a_column(spark):
    library = Tokenizer.from_file(PATH)
    rows = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(TEXTS)] + [(9999, None)]
    got = {r.doc_id: r.text for r in pair_index.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()}
    assert got.pop(9999) == ""
    assert all(got[i] == library.decode(ids, skip_special_tokens=False) for i, ids in rows[:-1])


def one_word(symbols, ranks):
    """The lowest rank first, leftmost first, one merge at a time."""
    out = list(symbols)
    while True:
        found = min(((ranks[p][0], i) for i, p in enumerate(zip(out, out[1:])) if p in ranks), default=None)
        if found is None:
            return out
        i = found[1]
        out[i : i + 2] = [ranks[out[i], out[i + 1]][1]]


def test_any_order_of_merges():
    """Random vocabularies, tokens with merges before their own among them."""
    r = random.Random(11)
    odd = 0
    for _ in range(120):
        names = {c: i for i, c in enumerate("abc")}
        merges = {}
        while len(merges) < 14:
            a, b = r.choice(list(names)), r.choice(list(names))
            merges.setdefault((a, b), names.setdefault(a + b, len(names)))
        pairs = list(merges)
        r.shuffle(pairs)
        index = PairIndex(np.array([(names[a], names[b], names[a + b]) for a, b in pairs]))
        odd += any(index.one_by_one)
        ranks = {(names[a], names[b]): (k, names[a + b]) for k, (a, b) in enumerate(pairs)}
        words = [[r.randrange(3) for _ in range(r.randrange(0, 25))] for _ in range(20)] + [[0] * 9, [0] * 12]
        flat = [BORDER]
        for w in words:
            flat += [*w, BORDER]
        want = [BORDER]
        for w in words:
            want += [*one_word(w, ranks), BORDER]
        assert index.encode(np.array(flat)).tolist() == want
    assert odd > 50


def test_long_words_stay_in_the_index():
    own = pair_index.Coder(PATH)
    library = Tokenizer.from_file(PATH)
    r = random.Random(2)
    long = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    start = time.perf_counter()
    got = np.frombuffer(own.encode_all([long])[0], "<i4").tolist()
    assert time.perf_counter() - start < 20
    assert got[:1000] == library.encode(long[:20_000], add_special_tokens=False).ids[:1000]
    chinese = "".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(30_000))
    got = np.frombuffer(own.encode_all([chinese])[0], "<i4").tolist()
    assert got == library.encode(chinese, add_special_tokens=False).ids


def test_repeated_rows_missing_ids_and_empty_tables(spark):
    rows = [(1, "one two"), (1, "one two"), (1, "three"), (None, "four"), (None, None)]
    got = sorted(((r.doc_id, len(r.ids)) for r in pair_index.encode(table(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 2), (1, 2), (1, 1), (None, 1), (None, 0)], key=str)
    empty = documents_only(spark, [])
    assert pair_index.encode(empty, decoded=True).collect() == []

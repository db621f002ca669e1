"""A passage with one holder that has no id is cut from all that hold it."""

import random

from cartoweave.llm import exact_dedup, queries, suffix_dedup
from tests.llm.helpers import documents_only, table
from tests.llm.test_suffix import brute


def rows():
    r = random.Random(6)
    make = lambda n: "".join(r.choices("abcdefgh \n", k=n))
    passage = make(400)
    return [(None if i in (2, 5) else i, make(150) + passage + make(90)) for i in range(8)] + [(None, make(300)), (9, make(300))]


def test_remove_repeats(spark):
    given = rows()
    want = brute([t.encode() for _, t in given], 200)
    for crowd in (512, 2):
        got = [(x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffix_dedup.remove_repeats(table(spark, given), crowd=crowd).collect()]
        assert sorted(got, key=repr) == sorted([(i, *w) for (i, _), w in zip(given, want)], key=repr)


def test_cut_repeats(spark):
    given = rows()
    want = [(i, w[3].decode()) for (i, _), w in zip(given, brute([t.encode() for _, t in given], 200))]
    got = [(x.doc_id, x.text) for x in suffix_dedup.cut_repeats(documents_only(spark, given)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_exact_dedup_marks_every_row(spark):
    given = [(None, "a b"), (3, "a  b"), (4, "a b"), (None, "own"), (None, "own"), (5, None)]
    got = exact_dedup.exact_dedup(table(spark, given)).collect()
    seen = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=repr)
    assert seen == sorted([(None, 3, 3, False), (3, 3, 3, True), (4, 3, 3, False), (None, None, 2, True), (None, None, 2, True), (5, 5, 1, True)], key=repr)


def test_rows_without_id_are_in_no_part(spark):
    rows = table(spark, [(None, "x"), (7, "y")])
    assert {r[0] for r in rows.select(queries._remainder(4).between(-1, 3)).collect()} == {True}
    assert rows.where(queries._remainder(4) == -1).count() == 1

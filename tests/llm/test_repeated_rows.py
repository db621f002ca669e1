"""Rows that repeat an id: with the same text one stays, with another text both do."""

import pytest

import corpus_pipeline
from cartoweave.llm import exact_dedup, simhash
from tests.llm.helpers import documents_only

LONG = " ".join(f"w{i}x{i * 7919 % 1013}" for i in range(80))
OTHER = " ".join(f"q{i}y{i * 104729 % 997}" for i in range(80))


@pytest.mark.parametrize("drop", [exact_dedup.drop_copies, simhash.drop_near_copies])
def test_one_row_of_each_text(spark, drop):
    rows = [(2, LONG), (2, LONG), (2, OTHER), (1, LONG), (3, OTHER), (None, OTHER), (7, "alone here"), (7, "alone here")]
    kept = drop(documents_only(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, LONG), (2, OTHER), (7, "alone here")])


@pytest.mark.parametrize("drop", [exact_dedup.drop_copies, simhash.drop_near_copies])
def test_rows_without_id(spark, drop):
    kept = drop(documents_only(spark, [(None, LONG), (None, LONG), (None, OTHER)]))
    assert sorted(r.text for r in kept.collect()) == sorted([LONG, OTHER])


def test_a_document_read_twice_keeps_its_text(spark, tmp_path):
    docs = documents_only(spark, [(1, LONG), (1, LONG), (2, OTHER), (3, "short"), (3, LONG + " " + OTHER[:20])])
    for _, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, str(tmp_path))
    kept = corpus_pipeline.drop_repeats(spark, docs.where("doc_id < 3 OR text = 'short'"), str(tmp_path))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, LONG), (2, OTHER), (3, "short")]

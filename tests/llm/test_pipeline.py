"""The pipeline over a small corpus with planted cases, and what each stage must keep."""

import random
import shutil

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from cartoweave.llm.vocabularies import default_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean, toxic, copied, nearly copied and passage-sharing documents."""
    r = random.Random(8)
    vocabulary = ["".join(r.choices("abcdefghiklmnoprstuw", k=r.randrange(2, 9))) for _ in range(4000)]
    prose = lambda n: " ".join(r.choices(vocabulary, k=n))
    rows, labels, kind = [], [], {}

    def add(text, what, toxic=None):
        i = len(rows)
        rows.append((i, text, "en", "s", len(text) if text is not None else None))
        kind[i] = what
        if toxic is not None:
            labels.append((i, 1, toxic))
        return i

    for _ in range(150):
        add(prose(120), "clean", 0)
    for _ in range(60):
        words = prose(100).split(" ")
        words[50] = "scumword"
        add(" ".join(words), "toxic", 1)
    for _ in range(20):
        words = prose(100).split(" ")
        words[20] = "scumword"
        add(" ".join(words), "toxic")
    for i in range(30):
        add(rows[i][1].replace(" ", "  ", 3), "copy")
    for i in range(30, 60):
        words = rows[i][1].split(" ")
        words[60] = "changed"
        add(" ".join(words), "near")
    passage = prose(60)
    for _ in range(25):
        add(prose(90) + " " + passage + " " + prose(90), "passage")
    add(None, "blank")
    add("", "blank")
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    yield folder, kind, rows, passage
    shutil.rmtree(folder)


def test_stages_do_their_part(spark, corpus):
    folder, kind, rows, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    left = set(kind)
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == columns
        path = f"{folder}/stage-{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        now = {r.doc_id for r in docs.collect()}
        seen[name], left = left - now, now
    assert {kind[i] for i in seen["toxicity"]} == {"toxic"}
    assert len(seen["toxicity"]) >= 78
    assert seen["exact_dedup"] == {i for i, k in kind.items() if k == "copy"} | {max(i for i, k in kind.items() if k == "blank")}
    assert len(seen["simhash_near_dedup"]) >= 27 and {kind[i] for i in seen["simhash_near_dedup"]} == {"near"}
    assert seen["suffix_array_dedup"] == set()
    texts = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
    missed = {i for i in left if kind[i] == "near"}
    for i in left:
        text, chars = texts[i]
        if i in missed or any(rows[m][1].split(" ")[:50] == (rows[i][1] or "").split(" ")[:50] for m in missed):
            # A near copy that was not found shares long strings with its original.
            continue
        if kind[i] == "passage":
            assert passage not in text and rows[i][1].startswith(text[:400])
            assert chars == len(text)
        else:
            assert (text, chars) == (rows[i][1], rows[i][4])


def test_run_packs_what_is_left(spark, corpus):
    folder, kind, _, _ = corpus
    pieces = corpus_pipeline.run(spark, folder).collect()
    library = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = {r.doc_id: r.text for r in docs.collect() if kind[r.doc_id] == "clean"}
    length = {}
    for p in pieces:
        length[p.doc_id] = length.get(p.doc_id, 0) + p.length
    assert set(clean) <= set(length)
    near = {" ".join(r.text.split(" ")[:50]) for r in docs.collect() if kind[r.doc_id] == "near"}
    for i, text in clean.items():
        if " ".join(text.split(" ")[:50]) in near:
            continue
        assert length[i] == len(library.encode(text, add_special_tokens=False).ids) + 1


def test_empty_documents(spark, corpus, tmp_path):
    folder = corpus[0]
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").where(F.lit(False)).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_all_are_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and 4 <= len(corpus_pipeline.STAGES) <= 5
    assert {"op1_kd_tree_top_k", "op6_template_lines", "op7_heavy_hitter_dedup", "op11_reduced_alphabet_variants", "op13_block_max_maxscore"} <= set(entry.oracle_sql())

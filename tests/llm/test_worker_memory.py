"""What a Python worker holds at a time: workers share an executor's memory with the JVM."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cartoweave.llm import toxicity
from cartoweave.llm.common import prepare


def test_batches_handed_to_python_are_small(spark):
    prepare(spark)
    docs = spark.range(0, 600, 1, 1).select("id", F.repeat(F.lit("word "), 2000).alias("text"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "size"])

    got = docs.mapInArrow(run, "rows long, size long").collect()
    assert sum(r.rows for r in got) == 600
    assert max(r.size for r in got) <= 2 << 20


def test_scores_of_many_texts_hold_the_words_of_few():
    r = random.Random(4)
    texts = [" ".join("".join(r.choices("abcdefghij", k=6)) for _ in range(400)) for _ in range(1500)]
    n = 5000
    g = np.random.default_rng(5)
    factor = np.vstack([g.normal(size=(n, 8)), np.zeros((1, 8))])
    model = toxicity.Model(1 << 18, 0.2, np.sort(g.choice(1 << 18, n, replace=False)), np.append(g.normal(size=n), 0), factor)
    tracemalloc.start()
    few = toxicity._Scorer(model).scores(iter(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    at_once = toxicity._Scorer(model)(texts)
    peak_at_once = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(few, at_once)
    assert peak < 25 << 20 < peak_at_once, (peak >> 20, peak_at_once >> 20)
    assert len(toxicity._Scorer(model).scores([])) == 0

"""Spelling variants of one word, found by one-edit neighbourhoods over a reduced alphabet.

Letters are hashed to a few symbols, which turns every word into a reduced word. Words one
edit apart have reduced words at most one edit apart, so the full one-edit neighbourhood
of each reduced word (itself, deletions, replacements, insertions over the few symbols) is
generated and joined with the reduced vocabulary. With few symbols a neighbourhood has
tens of members, not hundreds. What the join brings together is verified on the words
themselves, by their edit distance.

While every word generates, each pair would meet twice: generating only what leads to a
shorter reduced word, or to a higher symbol at the place replaced, meets it once. The
number of symbols follows the size of the vocabulary, so that the words met by chance stay
a few for each word.

A reduced word that more than ``CROWD`` words share is no key. Its words generate again,
in full, over twice the symbols, and again, until every letter has a symbol of its own,
where no two words share a key. Each pair is verified at the first step at which neither
of its words is crowded, so none is lost and no group of words is paired with itself
beyond ``CROWD``.

``word_counts`` reads texts; ``near_words`` and ``forms`` take any table of words.

Defined results: null texts have no words; rows without id count like others, with
nothing before the colon; rows that repeat an id count as often as they come; a word of
any length has a row (its neighbourhood is generated in bounded parts); of equally
frequent near words the smallest in code-point order is the form; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoweave.llm.common import prepare, slices, staged, texts

LEAST_LETTERS, LEAST_COUNT, RATIO = 7, 2, 10
DROP = 31
CROWD = 64
#: Distinct words that a task holds before it hands their counts on.
HELD = 300_000
#: Positions whose neighbours are made at a time.
PART = 1 << 16
#: Odd, so that it has an inverse modulo 2^64: reduced words are polynomials of it.
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Latin-1 bytes: A-Z in lower case, a-z and U+00C0 to U+00FF stay, others part words.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))


# Words of the texts


def _document_words(own_id, text: str, least: int) -> Counter:
    """Words of one text as Latin-1 bytes; one letter goes where the checksum of id and
    run says so, the same for all occurrences in this text."""
    runs = Counter(w for w in text.encode("latin-1", "replace").translate(_FOLD).split() if len(w) >= least)
    head = zlib.crc32(f"{'' if own_id is None else own_id}:".encode())
    out: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), head)
        if h % DROP == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LETTERS, times: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: words of at least ``least`` letters that occur ``times`` times or more.
    Counts are added up per task before they are shuffled."""
    prepare(docs.sparkSession)

    def batch_of(held: Counter) -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in held]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for whole in batches:
            for batch in slices(whole, 1):
                for own_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    held.update(_document_words(own_id, text, least))
                    if len(held) > HELD:
                        yield batch_of(held)
                        held.clear()
        if held:
            yield batch_of(held)

    seen = texts(docs, id_col, text_col).mapInArrow(run, "word string, n long")
    return seen.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


# Reduced words


def symbol_table(letters: list[str], symbols: int) -> dict[str, int]:
    """The hash of letters, most frequent first: dealt to the symbols in turn, from 1 on.
    Twice the symbols split each of them in two."""
    return {c: 1 + i % symbols for i, c in enumerate(letters)}


def symbols_for(words: int) -> int:
    """The least number of symbols, 4 or more, whose strings of eight outnumber the words."""
    symbols = 4
    while symbols**8 < 64 * words:
        symbols += 1
    return symbols


def _codes(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value of every beginning and every end of a word of symbols, and the powers used."""
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(word) + 1, BASE)]))
    parts = word.astype(np.uint64) * powers[: len(word)]
    begin = np.concatenate([[np.uint64(0)], np.cumsum(parts, dtype=np.uint64)])
    return begin, powers


def code(word: np.ndarray) -> np.uint64:
    return _codes(word)[0][-1]


def neighbourhood(word: np.ndarray, symbols: int, full: bool) -> Iterator[np.ndarray]:
    """Codes of all words of symbols within one edit of ``word``, itself first, a bounded
    part at a time. Without ``full`` only itself, deletions and replacements by a higher
    symbol: of two words one edit apart, one has the other among these."""
    begin, powers = _codes(word)
    whole = begin[-1]
    yield np.array([whole])
    every = np.arange(1, symbols + 1).astype(np.uint64)
    for lo in range(0, len(word) + 1, PART):
        at = np.arange(lo, min(lo + PART, len(word) + 1))
        inside = at[at < len(word)]
        after = whole - begin[inside + 1]
        yield begin[inside] + after * UNBASE
        own = word[inside].astype(np.uint64)
        changed = whole + (every[None, :] - own[:, None]) * powers[inside][:, None]
        wanted = every[None, :] != own[:, None] if full else every[None, :] > own[:, None]
        yield changed[wanted]
        if full:
            yield (begin[at][:, None] + every[None, :] * powers[at][:, None] + ((whole - begin[at]) * BASE)[:, None]).ravel()


def _reduce(words: list[str], table: dict[str, int]) -> list[np.ndarray]:
    order = np.zeros(max(map(ord, table), default=0) + 1, np.int64)
    for letter, symbol in table.items():
        order[ord(letter)] = symbol
    return [order[np.frombuffer(w.encode("utf-32-le"), np.uint32)] for w in words]


def _coded(words: DataFrame, table: dict[str, int]) -> DataFrame:
    """``word, code``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [int(code(w)) for w in _reduce(batch.column(0).to_pylist(), table)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["word", "code"])

    return words.select("word").mapInArrow(run, "word string, code long")


def _generated(words: DataFrame, table: dict[str, int], symbols: int, full: bool) -> DataFrame:
    """``near, source``: codes of the neighbourhood of each reduced word, once for all words
    that share it; ``words`` has a word for each ``code``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for word, source in zip(_reduce(batch.column(0).to_pylist(), table), batch.column(1).to_pylist()):
                for part in neighbourhood(word, symbols, full):
                    held.append((part, source))
                    size += len(part)
                    if size > PART:
                        yield out(held)
                        held, size = [], 0
            if held:
                yield out(held)

    def out(held: list) -> pa.RecordBatch:
        near = np.concatenate([p for p, _ in held]).view(np.int64)
        sources = np.repeat(np.array([s for _, s in held], np.int64), [len(p) for p, _ in held])
        return pa.RecordBatch.from_arrays([pa.array(near), pa.array(sources)], names=["near", "source"])

    return words.select("word", "code").mapInArrow(run, "near long, source long")


def _letters(words: DataFrame) -> list[str]:
    """Letters, the most frequent first: as many rows as the alphabet has letters."""
    counted = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").groupBy("letter").count()
    return [r["letter"] for r in counted.orderBy(F.desc("count"), "letter").collect()]


def near_words(words: DataFrame, crowd: int = CROWD, symbols: int | None = None) -> DataFrame:
    """``a, b`` with ``a < b``: all pairs of distinct words of column ``word`` that differ by
    one inserted, deleted or replaced code point, each once."""
    spark = prepare(words.sparkSession)
    words = staged(words.where(F.length("word") > 0).select("word").distinct())
    letters = _letters(words)
    symbols = symbols or symbols_for(words.count())
    found = spark.createDataFrame([], "a string, b string")
    active = None
    while letters:
        table = symbol_table(letters, symbols)
        coded = staged(_coded(words, table))
        keys = staged(coded.groupBy("code").agg(F.count(F.lit(1)).alias("held"), F.min("word").alias("word")))
        crowded = keys.where(F.col("held") > crowd).select("code")
        calm = keys.where(F.col("held") <= crowd)
        if active is None:
            generating, own = calm, coded
        else:
            # Only words that were crowded before generate; the others met among themselves.
            own = coded.join(active, "word", "left_semi")
            generating = calm.join(own.select("code"), "code", "left_semi")
        near = _generated(generating, table, symbols, full=active is not None)
        met = staged(near.join(calm.select(F.col("code").alias("near")), "near", "left_semi").select("source", "near").distinct())
        one = own.select(F.col("word").alias("one"), F.col("code").alias("source"))
        other = coded.select(F.col("word").alias("other"), F.col("code").alias("near"))
        pairs = met.join(one, "source").join(other, "near")
        if active is None:
            # Words of the same reduced word meet themselves and each other twice.
            pairs = pairs.where("source <> near OR one < other")
        apart = F.abs(F.length("one") - F.length("other")) <= 1
        verified = pairs.where(apart & (F.levenshtein("one", "other", 1) == 1)).select(F.least("one", "other").alias("a"), F.greatest("one", "other").alias("b"))
        found = found.unionByName(staged(verified if active is None else verified.distinct()))
        if symbols >= len(letters) or crowded.isEmpty():
            break
        active = staged(coded.join(crowded, "code", "left_semi").select("word"))
        symbols = min(2 * symbols, len(letters)) if 2 * symbols >= len(letters) else 2 * symbols
    return found


# Forms


def forms(words: DataFrame, near: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words(word, n)``. The form
    is the most frequent near word if it is ``ratio`` times as frequent; the root is reached
    from the word by following forms to the last."""
    words, near = staged(words.select("word", "n")), staged(near)
    both = near.select("a", "b").unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("m")), "b").groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("b").alias("word"))).alias("top")
    )
    held = words.join(counted, F.col("word") == F.col("a"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(-F.col("top.less") >= ratio * F.col("n"), F.col("top")).alias("top")
    )
    held = staged(held.select("word", "n", "n_near", F.col("top.word").alias("form"), (-F.col("top.less")).alias("form_n")))
    # Counts grow with every step, so chains end; each round doubles the steps taken.
    steps = staged(held.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        longer = staged(steps.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        steps = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            break
    return held.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``forms`` of the words of all texts."""
    words = staged(word_counts(docs, id_col, text_col))
    return forms(words, near_words(words))

"""Token counts of whole texts, and of every prefix, from the prefix table.

A text is cut at white space, which this vocabulary drops; each run is normalised, split
into words and counted from the table. Sums over the runs give the count at every run,
the table the counts inside one, so a budget is answered by looking up where the running
count passes it, without encoding any prefix again. Runs are remembered per worker in a
map of bounded size, since words repeat.

Defined results: null text counts as empty (no tokens); special strings inside a text
are one token each, as the library's default; a text of one endless word is walked
position by position; other columns of the input are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cartoweave.llm.common import gaps, prepare, slices, texts
from cartoweave.llm.vocabularies import byte_symbols, default_path, word_end_table

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
REMEMBER = 300_000
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
# Control characters that Python takes for white space and the vocabulary's pattern does not.
ODD_SPACE = re.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"\p{White_Space}+")


def normalised(run: str) -> str:
    """Composed and lower-cased letter by letter (a final sigma is a plain one)."""
    if not run.isascii():
        run = unicodedata.normalize("NFC", run).replace("Σ", "σ")
    return run.lower()


class Counter:
    """Counts of whole texts; one per worker and vocabulary."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.table, special = word_end_table(path)
        self.library = Tokenizer.from_file(path)
        self.symbols = byte_symbols()
        self.special = re.compile("|".join(re.escape(s) for s in special)) if special else None
        self.seen: dict[str, int] = {}

    def runs(self, text: str) -> tuple[list[str], int]:
        """The runs between white space, and how many special strings stood among them."""
        found = 0
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            found = len(parts) - 1
            return [r for p in parts for r in self.runs(p)[0]], found
        if ODD_SPACE.search(text):
            return [r for r in SPACE.split(text) if r], found
        return text.split(), found

    def words(self, run: str) -> list[bytes]:
        """The words of one run, normalised. Characters newer than this Python's tables
        may be classed otherwise by the library, so it cuts the runs that hold any."""
        if not run.isascii() and "Cn" in map(unicodedata.category, run):
            cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(run))
            return [bytes(self.symbols[c] for c in word) for word, _ in cut]
        return [w.encode() for w in WORDS.findall(normalised(run))]

    def learn(self, runs: set[str]) -> None:
        """Count runs not yet seen, all words of all of them at once."""
        new = [r for r in runs if r not in self.seen]
        words = [self.words(r) for r in new]
        distinct = list({w for ws in words for w in ws})
        count = dict(zip(distinct, self.table.counts(distinct)))
        for r, ws in zip(new, words):
            self.seen[r] = sum(count[w] for w in ws)

    def counts(self, texts_: list[str]) -> list[int]:
        if len(self.seen) > REMEMBER:
            self.seen.clear()
        found = []
        need: set[str] = set()
        for t in texts_:
            runs, special = self.runs(t)
            each = list(map(self.seen.get, runs))
            new = [runs[k] for k in gaps(each)]
            need.update(new)
            found.append((sum(filter(None, each)) + special, new))
        self.learn(need)
        seen = self.seen.__getitem__
        return [known + sum(map(seen, new)) for known, new in found]

    def run_prefixes(self, run: str) -> list[int]:
        """Tokens of every prefix of one run, by characters."""
        if run.isascii():
            out = [0]
            for word in WORDS.findall(run.lower()):
                out += [out[-1] + c for c in self.table.prefix_counts(word.encode())[1:]]
            if "'" not in run and len(out) == len(run) + 1:
                return out
        # Lower case or composition may change lengths, and a cut may change what a
        # quotation mark joins: such runs are counted prefix by prefix.
        ends = [run[:k] for k in range(len(run) + 1)]
        self.learn(set(ends))
        return [self.seen[e] for e in ends]

    def marks(self, text: str) -> Iterator[tuple[int, str, bool]]:
        """``start, run, special`` of each run and special string, as they come."""
        special = self.special is not None and self.special.search(text) is not None
        if not special and not ODD_SPACE.search(text):
            for m in re.finditer(r"\S+", text):
                yield m.start(), m.group(), False
            return
        at = 0
        for k, part in enumerate(re.split(f"({self.special.pattern})", text) if special else [text]):
            if k % 2:
                yield at, part, True
            else:
                for m in regex.finditer(r"\P{White_Space}+", part):
                    yield at + m.start(), m.group(), False
            at += len(part)

    def fit(self, text: str, limit: int) -> int:
        """Characters of the longest prefix of ``text`` with at most ``limit`` tokens. The
        runs are added up until the limit is passed; what follows is not looked at."""
        if len(self.seen) > 2 * REMEMBER:
            self.seen.clear()
        total = 0
        for begin, run, special in self.marks(text):
            if special:
                count = 1
            else:
                if run not in self.seen:
                    self.learn({run})
                count = self.seen[run]
            if total + count > limit:
                if special:
                    return begin
                inside = self.run_prefixes(run)
                return begin + max(i for i, c in enumerate(inside) if c <= limit - total)
            total += count
        return len(text)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fit_bytes`` of every row: ``fit_bytes``
    is the length of the longest prefix within ``limit`` tokens."""
    path = path or default_path(VOCABULARY)
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for whole in batches:
            for batch in slices(whole, 1):
                text = batch.column(1).to_pylist()
                sizes = pa.compute.binary_length(batch.column(1)).to_pylist()
                n = own.counts(text)
                fit = [s if c <= limit else len(t[: own.fit(t, limit)].encode()) for t, s, c in zip(text, sizes, n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array([c > limit for c in n]), pa.array(fit, pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_bytes"],
                )

    source = texts(docs, id_col, text_col)
    kind = source.schema["__id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_bytes long")


def truncated(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, text``: each text cut to the longest prefix within ``limit`` tokens, a row
    for every row: texts are cut where they are counted, whatever their ids."""
    path = path or default_path(VOCABULARY)
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for whole in batches:
            for batch in slices(whole, 1):
                text = batch.column(1).to_pylist()
                cut = [t if c <= limit else t[: own.fit(t, limit)] for t, c in zip(text, own.counts(text))]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cut, pa.string())], names=["doc_id", "text"])

    source = texts(docs, id_col, text_col)
    kind = source.schema["__id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, text string")

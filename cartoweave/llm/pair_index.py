"""Byte-pair encoding and decoding by an index of pair occurrences.

The words that a part of the partition brings anew are laid end to end. An index maps
each mergeable pair, by its rank, to all its positions there. Active ranks are taken in
ascending order from a heap; one step merges all occurrences of a pair in all words and
enters the pairs this makes to their left and right into the lists they belong to.
Entries that a merge made stale are told by the rank now held at the position.

Taking a rank for all words at once is the order of each word by itself as long as the
merged token has no merge of a lower rank. Where a vocabulary has such tokens, a step
merges the leftmost occurrence of each word only, and the rank stays active.

Words are remembered per worker in a map of bounded size. Work follows merges, not the
length of words, so texts without spaces take the same road.

Defined results: null text counts as empty and has no ids; special strings inside a text
are one id each, as the library's default; rows are encoded one by one, so repeated rows
and rows without id give a row each; an empty table gives an empty result; other columns
of the input are not read.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartoweave.llm.bpe_prefix import NONE, Lookup
from cartoweave.llm.common import gaps, prepare, slices, texts
from cartoweave.llm.token_counts import ODD_SPACE, SPACE, WORDS, normalised
from cartoweave.llm.vocabularies import byte_symbols, default_path

VOCABULARY = "word_bpe_49k.json"
REMEMBER = 300_000
#: Bytes of text that are indexed together; a longer text is a part of its own.
PART = 8 << 20
#: Stands between words; no token has this number.
BORDER = (1 << 20) - 1
#: Model settings that the encoder relies on.
EXPECTED = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}


class PairIndex:
    """Merges of a vocabulary: ``merges[r]`` is ``(left, right, token)`` of rank ``r``."""

    def __init__(self, merges: np.ndarray):
        merges = np.asarray(merges, np.int64).reshape(-1, 3)
        self.left, self.right, self.token = merges[:, 0].copy(), merges[:, 1].copy(), merges[:, 2].copy()
        rank = np.arange(len(merges))
        self.rank_of = Lookup(self.left << 20 | self.right, rank)
        first_use = np.full(BORDER + 1, len(merges), np.int64)
        for side in (self.left, self.right):
            np.minimum.at(first_use, side, rank)
        self.one_by_one = (first_use[self.token] < rank).tolist()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.rank_of(left << 20 | right)

    def encode(self, symbols: np.ndarray) -> np.ndarray:
        """The symbols with all merges done; ``BORDER`` comes before, between and after words."""
        now = np.asarray(symbols, np.int64).copy()
        follow = np.arange(1, len(now) + 1)
        before = np.arange(-1, len(now) - 1)
        word = np.cumsum(now == BORDER)
        held = np.full(len(now), NONE, np.int64)
        held[:-1] = self.ranks(now[:-1], now[1:])
        merged = np.zeros(len(now), bool)
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            ranks = held[at]
            at, ranks = at[ranks != NONE], ranks[ranks != NONE]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            starts = [0, *cuts.tolist()]
            for rank, lo, hi in zip(ranks[starts].tolist(), starts, [*starts[1:], len(at)]):
                if rank in places:
                    places[rank].append(at[lo:hi])
                else:
                    places[rank] = [at[lo:hi]]
                    heapq.heappush(active, rank)

        enter(np.arange(len(now)))
        while active:
            rank = heapq.heappop(active)
            lists = places.pop(rank)
            # A pair that a position lost does not come back there: no place is listed twice.
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            at = np.sort(at[held[at] == rank])
            if not len(at):
                continue
            if self.one_by_one[rank]:
                keep = np.zeros(len(at), bool)
                keep[np.unique(word[at], return_index=True)[1]] = True
                if not keep.all():
                    places[rank] = [at[~keep]]
                    heapq.heappush(active, rank)
                at = at[keep]
            elif self.left[rank] == self.right[rank] and len(at) > 1:
                # In a run of equal symbols every second occurrence is used up by the one before.
                joined = np.concatenate([[False], follow[at[:-1]] == at[1:]])
                index = np.arange(len(at))
                at = at[(index - np.maximum.accumulate(np.where(joined, 0, index))) % 2 == 0]
            gone = follow[at]
            now[at] = self.token[rank]
            now[gone] = NONE
            held[gone] = NONE
            follow[at] = follow[gone]
            before[follow[at]] = at
            left = before[at]
            merged[at] = True
            at = np.concatenate([at, left[~merged[left]]])
            merged[at] = False
            held[at] = self.ranks(now[at], now[follow[at]])
            enter(at)
        return now[now != NONE]


class Coder:
    """Encodes and decodes whole texts; one per worker and vocabulary."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = {k: model.get(k) for k, v in EXPECTED.items() if model.get(k, v) != v}
        if odd or spec["decoder"] is not None or any(not x["special"] or x["normalized"] for x in spec["added_tokens"]):
            raise ValueError(f"{path}: settings this encoder does not know: {odd or 'decoder, added tokens'}")
        suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        if max([*vocab.values(), *self.special.values()]) >= BORDER:
            raise ValueError(f"{path}: more tokens than {BORDER}")
        self.inner, self.final = np.zeros(256, np.int64), np.zeros(256, np.int64)
        self.symbols = byte_symbols()
        for char, byte in self.symbols.items():
            self.inner[byte], self.final[byte] = vocab[char], vocab[char + suffix]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        self.index = PairIndex(np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], np.int64))
        names = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.library = Tokenizer.from_file(path)
        self.seen: dict[str, bytes] = {}
        self.assigned: set[str] = set()

    def runs(self, text: str) -> list[str]:
        """Special strings, and the runs between white space around them, in order."""
        if self.cut is not None and "<" in text and self.cut.search(text):
            return [r for k, p in enumerate(self.cut.split(text)) for r in ([p] if k % 2 else self._plain(p))]
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        if ODD_SPACE.search(text):
            return [r for r in SPACE.split(text) if r]
        return text.split()

    def words(self, run: str) -> list[bytes]:
        """The words of one run, normalised. Characters newer than this Python's tables
        may be classed otherwise by the library, so it cuts the runs that hold any."""
        if run.isascii():
            return [run.lower().encode()] if run.isalpha() else [w.encode() for w in WORDS.findall(run.lower())]
        if not self.assigned.issuperset(run):
            self.assigned.update(c for c in run if unicodedata.category(c) != "Cn")
        if not self.assigned.issuperset(run):
            cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(run))
            return [bytes(self.symbols[c] for c in word) for word, _ in cut]
        return [w.encode() for w in WORDS.findall(normalised(run))]

    def learn(self, runs: set[str]) -> None:
        """Encode runs not yet seen: the index is built over all their words."""
        new = [r for r in runs if r not in self.seen]
        words = {r: self.words(r) for r in new}
        distinct = list({w for ws in words.values() for w in ws})
        if distinct:
            text = np.frombuffer(b"\0".join([b"", *distinct, b""]), np.uint8)
            sizes = np.array([len(w) for w in distinct])
            borders = np.concatenate([[0], np.cumsum(sizes + 1)])
            symbols = self.inner[text]
            symbols[borders[1:] - 1] = self.final[text[borders[1:] - 1]]
            symbols[borders] = BORDER
            done = self.index.encode(symbols)
            ends = np.flatnonzero(done == BORDER).tolist()
            done = done.astype("<i4")
            coded = {w: done[a + 1 : b].tobytes() for w, a, b in zip(distinct, ends, ends[1:])}
            for r, ws in words.items():
                self.seen[r] = coded[ws[0]] if len(ws) == 1 else b"".join([coded[w] for w in ws])
        else:
            self.seen |= dict.fromkeys(new, b"")

    def encode_all(self, texts_: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        if len(self.seen) > REMEMBER:
            # Frequent runs come early.
            self.seen = dict(islice(self.seen.items(), REMEMBER // 3))
        if not self.seen:
            self.seen = {s: np.int32(i).tobytes() for s, i in self.special.items()}
        found, need = [], set()
        for t in texts_:
            runs = self.runs(t)
            parts = list(map(self.seen.get, runs))
            new = [(k, runs[k]) for k in gaps(parts)]
            need.update(r for _, r in new)
            found.append((parts, new))
        self.learn(need)
        for parts, new in found:
            for k, r in new:
                parts[k] = self.seen[r]
        return [b"".join(parts) for parts, _ in found]

    def decode(self, ids: Sequence[int]) -> str:
        """Names of the tokens with a space between, as a vocabulary without decoder gives
        them, special ones included; ids beyond the vocabulary are silent."""
        try:
            return " ".join([self.names[i] for i in ids])
        except IndexError:
            return " ".join([self.names[i] for i in ids if i < len(self.names)])


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` and, on request, ``decoded``, the text those ids decode to."""
    path = path or default_path(VOCABULARY)
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for whole in batches:
            for batch in slices(whole, 1, PART):
                each = own.encode_all(batch.column(1).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in each])]).astype(np.int32)
                flat = np.frombuffer(b"".join(each), "<i4")
                columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
                if decoded:
                    ids, at = flat.tolist(), offsets.tolist()
                    columns.append(pa.array([own.decode(ids[a:b]) for a, b in zip(at, at[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

    source = texts(docs, id_col, text_col)
    kind = source.schema["__id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>" + ", decoded string" * decoded)


def decode(coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``doc_id, text`` from a column of ids; null ids decode to the empty text."""
    path = path or default_path(VOCABULARY)
    prepare(coded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            text = [own.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    source = coded.select(id_col, ids_col)
    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, text string")

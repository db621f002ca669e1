"""Sequences packed along a space-filling curve.

A document's hashed token counts are projected to a few dimensions and placed on a
Hilbert curve, so that neighbours on the curve use similar words. The rows are
range-sorted by that key (ties by ``doc_id``, so a key of many documents is split) and
cut freely into sequences along the curve. Each range fills its sequences to the last
token; what is left at its end goes into sequences of power-of-two lengths, which need
no padding. Tokens are made once, staged, and moved once.

Defined results: null and empty texts are a single end id; rows that repeat a ``doc_id``
are packed one by one; an empty table gives an empty result; other columns of the input
are not read.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cartoweave.llm.common import gaps, prepare, slices, staged, texts
from cartoweave.llm.vocabularies import byte_symbols, default_path

VOCABULARY = "byte_bpe_50k.json"
LENGTH = 2048
END_ID = 1
DIMENSIONS, BITS = 4, 8
REMEMBER = 250_000
# How byte-level vocabularies of this family cut texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A space inside a run of white space: there words cannot be cut at single spaces.
RUNS = re.compile(r"\s (?=\s|\Z)")


class Encoder:
    """Ids of whole texts, words remembered; one per worker and vocabulary.

    The vocabulary joins at most one space to the word after it, so texts are cut before
    single spaces and each word is encoded once. Its merges are ranked by their ids, so a
    new word goes through the quicker of two libraries, built from the same file; words
    with characters that the two may class differently, and texts that cannot be cut,
    go through the vocabulary's own."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        symbols = byte_symbols()
        special_texts = {t.content for t in self.library.get_added_tokens_decoder().values()}
        ranks = {bytes(symbols[c] for c in token): i for token, i in self.library.get_vocab().items() if token not in special_texts}
        self.quick = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        special = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or r"(?!)")
        # Words with the space before them, and first words, which have none.
        self.seen: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}

    def _encode_whole(self, texts_: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint16).tobytes() for e in self.library.encode_batch_fast(texts_, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        if word.isascii() or "Cn" not in map(unicodedata.category, word):
            return array("H", self.quick.encode_ordinary(word)).tobytes()
        return self._encode_whole([word])[0]

    def encode(self, text: str) -> bytes:
        """Ids of one text as 16-bit numbers."""
        if RUNS.search(text) or self.special.search(text):
            return self._encode_whole([text])[0]
        if len(self.seen) + len(self.first) > REMEMBER:
            self.seen.clear()
            self.first.clear()
        head, *words = text.split(" ")
        seen = self.seen
        parts = list(map(seen.get, words))
        for k in gaps(parts):
            word = words[k]
            found = seen.get(word)
            if found is None:
                found = seen[word] = self._word(" " + word)
            parts[k] = found
        begin = self.first.get(head)
        if begin is None:
            begin = self.first[head] = self._word(head)
        return begin + b"".join(parts)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``points`` (integers below ``2 ** bits``) on the Hilbert curve."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    # Undo the rotations and reflections of each level, coarse to fine.
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[i] = np.where(set_, x[i], x[i] ^ swap)
        q >>= 1
    # Gray code.
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip = np.where((x[n - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


@lru_cache(maxsize=1)
def _directions(dimensions: int) -> np.ndarray:
    """One random direction per hashed token, fixed by a seed."""
    return np.random.default_rng(7).standard_normal((1 << 16, dimensions)).astype(np.float32)


def curve_keys(ids: list[np.ndarray], dimensions: int = DIMENSIONS, bits: int = BITS) -> np.ndarray:
    """Hilbert key of each document from its 16-bit ids."""
    table = _directions(dimensions)
    begin = np.cumsum([0, *(len(x) for x in ids)])[:-1]
    spread = np.add.reduceat(table[np.concatenate(ids)], begin, axis=0).astype(float) if ids else np.zeros((0, dimensions))
    # Sums of similar words point one way and grow with length: only the direction counts.
    spread /= np.maximum(np.linalg.norm(spread, axis=1, keepdims=True), 1e-9)
    return hilbert_keys(np.clip(((spread + 1) / 2 * (1 << bits)).astype(np.int64), 0, (1 << bits) - 1), bits)


def tokenised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """``doc_id, curve, ids``: ids as 16-bit little-endian numbers, the end id last."""
    path = path or default_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        end = np.array([end_id], np.uint16).tobytes()
        for whole in batches:
            for batch in slices(whole, 1):
                ids = [own.encode(t) + end for t in batch.column(1).to_pylist()]
                keys = curve_keys([np.frombuffer(x, np.uint16) for x in ids])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "curve", "ids"])

    source = texts(docs, id_col, text_col)
    kind = source.schema["__id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, curve long, ids binary")


def _packer(length: int):
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ranges number their sequences apart, so none needs to know of another.
        number = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        filled = 0
        out: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            arrays = [id_type(columns[0]), *(pa.array(c, pa.int64()) for c in columns[1:6]), pa.array(columns[6], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        id_type = pa.array
        size = 0
        for batch in batches:
            kind = batch.schema.field(0).type
            id_type = lambda c, kind=kind: pa.array(c, kind)
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(ids, np.uint16)
                total, at = len(ids), 0
                while at < total:
                    n = min(total - at, length - filled)
                    held.append((doc, at, n, total, number, filled, ids[at : at + n].astype("<u4").tobytes()))
                    at += n
                    filled += n
                    size += n
                    if filled == length:
                        out += held
                        held, filled = [], 0
                        number += 1
                if size >= 1 << 20:
                    if out:
                        yield batch_of(out)
                    out, size = [], 0
        # The rest of the range: sequences of powers of two, the largest first.
        parts = iter([p for p in (1 << b for b in range(filled.bit_length() - 1, -1, -1)) if filled & p])
        room, used = next(parts, 0), 0
        for doc, start, n, total, _, _, ids in held:
            at = 0
            while at < n:
                take = min(n - at, room - used)
                out.append((doc, start + at, take, total, number, used, ids[4 * at : 4 * (at + take)]))
                at += take
                used += take
                if used == room:
                    room, used = next(parts, 0), 0
                    number += 1
        if out:
            yield batch_of(out)

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``
    (little-endian 32-bit). A sequence is its pieces in the order of ``offset``."""
    prepare(docs.sparkSession)
    rows = staged(tokenised(docs, id_col, text_col, path, end_id))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (
        rows.repartitionByRange("curve", "doc_id")
        .sortWithinPartitions("curve", "doc_id")
        .select("doc_id", "ids")
        .mapInArrow(_packer(length), f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
    )

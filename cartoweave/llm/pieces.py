"""Encoding and decoding with a piece model, from the prefix table.

Texts are cut at spaces (every piece starts a word or lies inside one; only runs of
spaces cross the cut, and they are merged last, so they are put together afterwards).
Each word goes through the prefix table; characters the model lacks become bytes.
Words are remembered per worker in a map of bounded size.

Defined results: null text counts as empty and has the end id alone; a text of spaces
only is one run; an endless word is walked position by position; other columns of the
input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartoweave.llm.common import gaps, prepare, slices, texts
from cartoweave.llm.vocabularies import PieceVocabulary, default_path, piece_vocabulary

MODEL = "piece_bpe_32k.model"
REMEMBER = 200_000


class Coder:
    """Encodes and decodes whole texts; one per worker and model."""

    def __init__(self, path: str):
        self.vocabulary: PieceVocabulary = piece_vocabulary(path)
        known = "".join(re.escape(c) for c in sorted(self.vocabulary.known))
        self.unknown = re.compile(f"([^{known}])")
        self.space = self.vocabulary.spaces[1]
        # Ids of a word with the space before it, and whether that space stayed alone.
        self.seen: dict[str, bytes] = {}
        self.alone: set[str] = set()
        mark = PieceVocabulary.SPACE.encode()
        self.bytes_of = [b.replace(mark, b" ") for b in self.vocabulary.bytes_of]

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.seen]
        mark = PieceVocabulary.SPACE
        # Odd places hold the unknown characters.
        cut = {w: self.unknown.split(mark + w) for w in new if self.unknown.search(w)}
        plain = [mark + w for w in new if w not in cut]
        rest = list({s for parts in cut.values() for s in parts[::2] if s})
        flat, bounds = self.vocabulary.table.encode_flat([s.encode() for s in [*plain, *rest]])
        data, at = flat.astype(np.int32).tobytes(), (4 * bounds).tolist()
        coded = [data[a:b] for a, b in zip(at, at[1:])]
        self.seen.update(zip((w for w in new if w not in cut), coded))
        ids = dict(zip([*plain, *rest], coded))
        of_byte = [np.int32(i).tobytes() for i in self.vocabulary.byte_id]
        for word, parts in cut.items():
            out = [b"".join([of_byte[b] for b in s.encode()]) if k % 2 else ids[s] if s else b"" for k, s in enumerate(parts)]
            self.seen[word] = b"".join(out)
        single = np.int32(self.space).tobytes()
        self.alone.update(w for w in new if self.seen[w][:4] == single)

    def encode_all(self, texts_: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        if len(self.seen) > REMEMBER:
            self.seen.clear()
            self.alone.clear()
        mark = PieceVocabulary.SPACE
        seen = self.seen
        found = []
        need: set[str] = set()
        for t in texts_:
            if not t:
                found.append(([], (), False))
                continue
            words = (t.replace(mark, " ") if mark in t else t).split(" ")
            parts = list(map(seen.get, words))
            runs = "" in words
            new = [(k, words[k]) for k in gaps(parts)]
            need.update([w for _, w in new if w])
            found.append((words if runs else parts, new, runs))
        self.learn(need)
        out = []
        for parts, new, runs in found:
            if runs:
                out.append(self._with_runs(parts))
                continue
            for k, w in new:
                parts[k] = seen[w]
            out.append(b"".join(parts))
        return out

    def _with_runs(self, words: list[str]) -> bytes:
        parts, run = [], 0
        of_run = self.vocabulary.run_of_spaces
        for w in words:
            if not w:
                run += 1
                continue
            ids = self.seen[w]
            if run:
                joins = w in self.alone
                parts.append(np.array(of_run(run + joins), np.int32).tobytes())
                ids = ids[4 * joins :]
                run = 0
            parts.append(ids)
        if run:
            parts.append(np.array(of_run(run), np.int32).tobytes())
        return b"".join(parts)

    def decode(self, ids: Sequence[int]) -> str:
        """Text of ids; the space that encoding puts in front goes, control ids are silent."""
        table = self.bytes_of
        data = b"".join([table[i] for i in ids])
        return (data[1:] if data.startswith(b" ") else data).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: bool = True, decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` and, on request, ``decoded``, the text those ids decode to."""
    path = path or default_path(MODEL)
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        end = np.array([own.vocabulary.end_id] if end_id else [], np.int32).tobytes()
        for whole in batches:
            for batch in slices(whole, 1):
                each = [ids + end for ids in own.encode_all(batch.column(1).to_pylist())]
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in each])]).astype(np.int32)
                flat = np.frombuffer(b"".join(each), np.int32)
                columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
                names = ["doc_id", "ids"]
                if decoded:
                    ids, at = flat.tolist(), offsets.tolist()
                    columns.append(pa.array([own.decode(ids[a:b]) for a, b in zip(at, at[1:])], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    source = texts(docs, id_col, text_col)
    kind = source.schema["__id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>" + ", decoded string" * decoded)


def decode(coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``doc_id, text`` from a column of ids; null ids decode to the empty text."""
    path = path or default_path(MODEL)
    prepare(coded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            text = [own.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    source = coded.select(id_col, ids_col)
    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, text string")

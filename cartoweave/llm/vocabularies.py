"""Prefix tables made from public vocabulary files; the path is always a parameter."""

from __future__ import annotations

import json
from functools import lru_cache

from cartoweave.llm.bpe_prefix import PrefixTable


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 characters
    stand for themselves, the other bytes for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def word_end_table(path: str) -> tuple[PrefixTable, tuple[str, ...]]:
    """Table of a byte-level vocabulary with word ends, and its special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    suffix = model["end_of_word_suffix"] or ""
    vocab: dict[str, int] = model["vocab"]
    symbols = byte_symbols()
    special = tuple(x["content"] for x in spec["added_tokens"])
    strings: list[bytes | None] = [None] * (max([*vocab.values(), *(x["id"] for x in spec["added_tokens"])]) + 1)
    ended, atoms = set(), []
    for text, token in vocab.items():
        if text in special:
            continue
        body = text.removesuffix(suffix) if suffix else text
        if body != text:
            ended.add(token)
        strings[token] = bytes(symbols[c] for c in body)
        if len(body) == 1:
            atoms.append(token)
    merges = []
    for rank, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges.append((vocab[a], vocab[b], vocab[a + b], rank))
    return PrefixTable(strings, atoms, merges, ended), special


class PieceVocabulary:
    """A piece model: its prefix table over UTF-8, byte ids, and the runs of spaces."""

    SPACE = "▁"

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = pb.ModelProto.SentencePiece
        pieces = model.pieces
        self.end_id = model.trainer_spec.eos_id
        self.size = len(pieces)
        self.bytes_of = [b""] * self.size
        self.byte_id = [0] * 256
        normal: dict[str, int] = {}
        for i, p in enumerate(pieces):
            if p.type == kinds.BYTE:
                value = int(p.piece[1:-1], 16)
                self.byte_id[value] = i
                self.bytes_of[i] = bytes([value])
            elif p.type in (kinds.NORMAL, 0):
                normal[p.piece] = i
                self.bytes_of[i] = p.piece.encode()
        self.spaces = {len(p): i for p, i in normal.items() if not p.strip(self.SPACE)}
        order = sorted(((-pieces[i].score, i) for p, i in normal.items() if len(p) > 1 and p.strip(self.SPACE)))
        rank = {i: r for r, (_, i) in enumerate(order)}
        merges = [
            (normal[p[:k]], normal[p[k:]], i, rank[i])
            for p, i in normal.items()
            if i in rank
            for k in range(1, len(p))
            if p[:k] in normal and p[k:] in normal and (k == 1 or p[:k].strip(self.SPACE)) and (len(p) - k == 1 or p[k:].strip(self.SPACE))
        ]
        strings = [b or None for b in self.bytes_of]
        for i in self.byte_id:
            strings[i] = None
        self.known = {p for p in normal if len(p) == 1}
        self.table = PrefixTable(strings, [normal[c] for c in self.known], merges)
        self.space_scores = {n: pieces[i].score for n, i in self.spaces.items()}
        self._runs: dict[int, list[int]] = {}

    def run_of_spaces(self, n: int) -> list[int]:
        """Ids of ``n`` spaces in a row: best score first, then leftmost."""
        if n not in self._runs:
            if len(self._runs) > 4096:
                self._runs.clear()
            self._runs[n] = [self.spaces[k] for k in _merge_run(n, self.space_scores)]
        return self._runs[n]


def _merge_run(n: int, scores: dict[int, float]) -> list[int]:
    """Lengths of the pieces that ``n`` equal symbols end in."""
    import heapq

    size, nxt, prev = [1] * n, [*range(1, n), -1], list(range(-1, n - 1))
    heap: list[tuple[float, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and nxt[i] >= 0 and size[i] + size[nxt[i]] in scores:
            heapq.heappush(heap, (-scores[size[i] + size[nxt[i]]], i, size[i], size[nxt[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = nxt[i]
        if size[i] != a or j < 0 or size[j] != b:
            continue
        size[i], size[j], nxt[i] = a + b, 0, nxt[j]
        if nxt[j] >= 0:
            prev[nxt[j]] = i
        offer(prev[i])
        offer(i)
    out, i = [], 0
    while n and i >= 0:
        out.append(size[i])
        i = nxt[i]
    return out


@lru_cache(maxsize=2)
def piece_vocabulary(path: str) -> PieceVocabulary:
    return PieceVocabulary(path)

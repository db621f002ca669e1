"""Words longer than a batch's table takes, and texts without spaces, against the libraries."""

from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece
import tokenizers

from cartoweave.llm import bpe_prefix, pieces, token_counts

VOCABULARIES = "/opt/tokenizers"


def long_texts():
    r = random.Random(5)
    han = [chr(c) for c in range(0x4E00, 0x4E00 + 900)]
    return [
        "".join(r.choice(han) for _ in range(1200)),
        "".join(r.choice("abcdefghij") for _ in range(9000)),
        "".join(r.choice("ab") for _ in range(700)) + " tail " + "z" * 500,
        "-" * 3000,
        "a" * 9000 + " " + "ha" * 600,
    ]


@pytest.mark.parametrize("longest", [8, 64, bpe_prefix.LONG])
def test_both_walks_agree_with_the_libraries(monkeypatch, longest):
    monkeypatch.setattr(bpe_prefix, "LONG", longest)
    texts = long_texts()
    lib = tokenizers.Tokenizer.from_file(f"{VOCABULARIES}/word_bpe_49k.json")
    lib.no_truncation()
    lib.no_padding()
    assert token_counts.Counter(f"{VOCABULARIES}/word_bpe_49k.json").counts(texts) == [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]
    model = sentencepiece.SentencePieceProcessor(model_file=f"{VOCABULARIES}/piece_bpe_32k.model")
    coded = pieces.Coder(f"{VOCABULARIES}/piece_bpe_32k.model").encode_all(texts)
    assert [np.frombuffer(c, np.int32).tolist() for c in coded] == [model.encode(t) for t in texts]

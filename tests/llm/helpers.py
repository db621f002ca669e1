"""Awkward inputs shared by the tests of this folder."""

import random

TYPES = "doc_id long, text string, lang string, source string, n_chars long, digest string, fp long, ids string, start int, root string, key string, a int, b int"


def table(spark, rows):
    """Documents with columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, t, None, "s", None, "x", 1, "y", 2, "r", "k", 1, 2) for i, t in rows], TYPES)


def documents_only(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def awkward_texts():
    r = random.Random(5)
    words = ["the", "Tion", "reading", "über", "naïve", "ΣΑΣ", "İstanbul", "漢字", "don't", "I'LL", "3.14", "x1y2", "###", "…", "á", "ẛ̣", "été", "🙂", "ﬁne", "Ǆ"]
    spaces = [" ", " ", " ", "  ", "\n", "\t", "\r\n", " ", " ", "\x1c", "\x1f", "   ", "\n \n", " \n", "​", "\x85", "　"]
    out = [None, "", " ", "   ", "\n", "\n\n ", " \n ", "a", " a", "a ", "▁", "▁▁a ▁", "<|endoftext|>", "x <|endoftext|> y<|startoftext|>", "<|ENDOFTEXT|>", "</s> <s> <unk> <0x0A>", "\x00 nul", "'s's 's", "a'" * 20]
    out += ["a" * 3000, "ab1" * 700, " " * 500 + "x", "漢" * 300, "é" * 200, "word " * 5000]
    for _ in range(150):
        out.append("".join(r.choice(words) + r.choice(spaces) for _ in range(r.randrange(1, 40))))
    for _ in range(60):
        out.append("".join(chr(r.choice([r.randrange(32, 127), r.randrange(1, 32), r.randrange(0xA0, 0x250), r.randrange(0x370, 0x600), r.randrange(0x2000, 0x2100), r.randrange(0x4E00, 0x4E80)])) for _ in range(r.randrange(1, 120))))
    return out

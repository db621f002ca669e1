"""Template lines against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from cartoweave.llm import template_lines
from tests.llm.helpers import awkward_texts, table

BLANK = re.compile("[\x20\x09-\x0d]+")


def brute(rows, depth=3, min_docs=3, similarity=0.75, least=0.25):
    lines, plain, holders = {}, {}, defaultdict(set)
    for n, (doc, text) in enumerate(rows):
        for place, line in enumerate((text or "").split("\n")):
            words = tuple(t for t in BLANK.split(line) if t)
            tokens = tuple("<*>" if re.search("[0-9]", t) else t for t in words)
            if tokens:
                lines[n, place] = doc, (len(tokens), tokens[:depth]), tokens
                plain[n, place] = words
                holders[words].add(doc)
    reach = defaultdict(set)
    for doc, leaf, _ in lines.values():
        reach[leaf].add(doc)
    held = {k: v for k, v in lines.items() if len(reach[v[1]]) > 1}
    # A token counts once for each document that has the masked line.
    seen = Counter((leaf, i, t) for _, leaf, tokens in set(held.values()) for i, t in enumerate(tokens))
    docs, template = defaultdict(set), {}
    for doc, leaf, tokens in held.values():
        made = tuple(t if i < depth or seen[leaf, i, t] >= min_docs else "<*>" for i, t in enumerate(tokens))
        fixed = sum(t != "<*>" for t in made)
        if fixed + tokens.count("<*>") >= similarity * len(made) and fixed >= least * len(made):
            template[leaf, tokens] = leaf, made
            docs[leaf, made].add(doc)
    out = []
    for n, (doc, text) in enumerate(rows):
        parts = (text or "").split("\n")
        often = [p for p in range(len(parts)) if len(holders[plain.get((n, p))]) >= min_docs]
        gone = [p for p in range(len(parts)) if p in often or (n, p) in held and len(docs.get(template.get(held[n, p][1:]), ())) >= min_docs]
        out.append((doc, len(parts), len(gone), "\n".join(x for p, x in enumerate(parts) if p not in gone)))
    return sorted(out, key=repr)


def corpus():
    r = random.Random(6)
    words = "alpha beta gamma delta".split()
    rows = []
    for i in range(300):
        lines = []
        for _ in range(r.randrange(0, 6)):
            kind = r.randrange(4)
            if kind == 0:
                lines.append(f"  User {r.randrange(100)} logged in from {r.choice(words)} at port {r.randrange(9)} ok")
            elif kind == 1:
                lines.append("All rights\treserved by  the owner " + r.choice(["x", "y", "z" * r.randrange(1, 9)]))
            elif kind == 2:
                lines.append(" ".join(r.choices([*words, f"q{r.randrange(50)}z"], k=r.randrange(1, 9))))
            else:
                lines.append("")
        rows.append((i, "\n".join(lines)))
    return rows + [(1000 + i, t) for i, t in enumerate(awkward_texts())] + rows[:5] + [(5, "another text\nof the same id"), (None, rows[7][1]), (None, "7 8 9\nAll rights reserved by the owner x"), (61, "7 8 9"), (62, " 7  8 9\n"), (63, "7 8 8")]


def test_equals_brute_force(spark):
    rows = corpus()
    got = template_lines.drop_recurring_lines(table(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    assert sum(r.n_dropped for r in got) > 200


def test_fields_are_general(spark):
    rows = [(i, f"Order {i} of customer {i * 7} was sent today\n{chr(97 + i) * 3} {chr(98 + i) * 4} {chr(99 + i) * 2} own") for i in range(6)]
    got = {r.doc_id: r.text for r in template_lines.drop_recurring_lines(table(spark, rows), similarity=0.6).collect()}
    assert all(t.endswith(" own") and "Order" not in t for t in got.values())


def test_empty_table(spark):
    assert template_lines.drop_recurring_lines(table(spark, [])).collect() == []


@pytest.mark.parametrize("min_docs", [2, 5])
def test_other_counts(spark, min_docs):
    rows = corpus()[:200]
    got = template_lines.drop_recurring_lines(table(spark, rows), min_docs=min_docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, min_docs=min_docs)


def test_main_path_is_native(spark):
    plan = template_lines.drop_recurring_lines(table(spark, corpus()[:20]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_lines_with_digits_go(spark):
    rows = [(i, f"\u00a9 2024 4\n2024-01-0{i} 12:33:0{i} INFO 47{i}1 done\nPage {i} of 10\n1 2 3\n{i} {i + 1} {i + 2}\nowned words of number{i}") for i in range(1, 5)]
    got = {r.doc_id: r.text for r in template_lines.drop_recurring_lines(table(spark, rows)).collect()}
    # Lines of digits alone go only where they are the same, as the first one here.
    assert got == {1: ""} | {i: f"{i} {i + 1} {i + 2}" for i in range(2, 5)}


def test_clean_prose_stays(spark):
    words = "amber birch cedar dune ember fjord grove heath".split()
    rows = [(i, "in the year " + " ".join(words[(i + k) % 8] for k in range(7))) for i in range(6)]
    got = {r.doc_id: r.text for r in template_lines.drop_recurring_lines(table(spark, rows)).collect()}
    assert got == dict(rows)

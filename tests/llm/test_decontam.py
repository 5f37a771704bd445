"""Matches against a plain search, odd rows, blocks of test items."""

import hashlib
import re

import pytest

from tickweave.llm import decontam

DOCS = "doc_id long, text string, key string, n_words int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(docs, items):
    out = []
    for doc_id, text in docs:
        words = WORD.findall(lower(text))
        hit, found = set(), set()
        for item, content in items:
            wanted = WORD.findall(lower(content))
            size = min(10, len(wanted))
            for w in range(len(wanted) - size + 1) if wanted else ():
                for at in range(len(words) - size + 1):
                    if words[at : at + size] == wanted[w : w + size]:
                        hit.update(range(at, at + size))
                        found.add(item)
        names = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


NUMBERS = "one two three four five six seven eight nine ten eleven twelve thirteen"
ITEMS = [(1, NUMBERS), (2, "the cat"), (2, "the cat sat"), (10, "Zoë's ÉTÉ"), (None, "lost item"), (4, None), (5, " ?! ")]
ITEMS += [(6, "a a a a a a a a a a a a"), (7, "x")]
TEXTS = [
    (1, NUMBERS.upper().replace(" ", ", ")),
    (1, NUMBERS.upper().replace(" ", ", ")),
    (2, " ".join(reversed(NUMBERS.split()))),
    (3, "the the cat the cat sat, the cat"),
    (None, "a lost item and ÉTÉ Zoë s ÉTÉ zoë's ÉtÉ"),
    (5, None),
    (6, ""),
    (7, "a " * 500),
    (8, "a " * 9),
    (9, "filler " * 100_000 + NUMBERS + " the cat"),
    (10, NUMBERS[:40] + " gap " + NUMBERS[40:] + " x"),
]


@pytest.mark.parametrize("block", [decontam.BLOCK_CHARS, 60])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", block)
    docs = spark.createDataFrame([(*r, "k", 0) for r in TEXTS], DOCS)
    items = spark.createDataFrame([(*r, "t") for r in ITEMS], "item_id long, text string, term string")
    got = sorted((tuple(r) for r in decontam.contamination(docs, items).collect()), key=str)
    assert got == plain(TEXTS, ITEMS)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two", "", 0)], DOCS)
    items = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontam.contamination(docs, items).collect()] == [0]
    assert decontam.contamination(docs.limit(0), items).collect() == []


def test_near_matches_and_filter(spark):
    words = NUMBERS.split()[:10]
    docs = spark.createDataFrame(
        [(1, " ".join(reversed(words)), "a", 0), (2, " ".join(words), "b", 0), (3, "clean", "c", 0)], DOCS
    )
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    _, found = decontam.find_contamination(docs, items)
    assert {(r.key, r.kind) for r in found.collect()} == {("a", "near"), ("b", "exact")}
    kept = decontam.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 3}

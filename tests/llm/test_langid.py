"""Languages: held-out accuracy, the method against plain loops, odd input."""

import zlib
from collections import Counter
from math import sqrt

import numpy as np
import pytest

from tickweave.llm import langid
from tickweave.llm.catalog import queries
from tickweave.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return langid.learn(table(spark, sf_dir, "documents"))


def test_held_out_accuracy(spark, sf_dir):
    docs = {r.doc_id: r for r in table(spark, sf_dir, "documents").collect()}
    found = queries()["op13_language_id"](spark, sf_dir)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = found.collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    judged = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert sum(judged) / len(judged) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def plain_features(text):
    """The same vector from words, strings and a dictionary."""
    words = "".join(c if c.isalpha() and (c.isascii() or c.isalnum()) else " " for c in text.lower()).split()
    data = f" {' '.join(words)} ".encode()
    counts = Counter()
    for n in range(1, 5):
        for i in range(len(data) - n + 1):
            code = int.from_bytes(data[i : i + n], "big")
            code = (code + n * 0x3C6EF372) % (1 << 32) * 0x9E3779B1 % (1 << 32)
            counts[code >> (32 - langid.BITS)] += 1
    total = sum(counts.values())
    return {at: sqrt(c / total) for at, c in counts.items()}


@pytest.mark.parametrize("block", [5, 64, 1 << 20])
def test_features_against_plain_loops(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    for text in ("Über den “Wolken” — 12 Größen.", "a", "l'été  où", "X" * 300 + " y", "x — y", "日本語 と テキスト"):
        x = langid.features(text)
        assert {i: x[i] for i in np.flatnonzero(x)} == pytest.approx(plain_features(text))


def test_prediction_against_plain_votes(model):
    """Family first, then one vote per pair of its languages."""
    for text in ("the and of thing", "und der nicht", "les aux dans été", "ción que el", "x"):
        x = langid.features(text)
        family = max(model.roots, key=lambda m: m.slope * (m.weights @ x + m.bias)).first if model.roots else next(iter(model.families))
        votes = Counter()
        for m in model.pairs.get(family, []):
            votes[m.first if m.weights @ x + m.bias >= 0 else m.second] += 1
        lang, score = model.predict(text)
        assert langid.family_of(lang) == family and 0 < score <= 1
        assert not votes or votes[lang] == max(votes.values())


def test_only_languages_of_one_family_are_told_apart_by_pairs(model):
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert {f: [(m.first, m.second) for m in ms] for f, ms in model.pairs.items()} == {
        "germanic": [("de", "en")],
        "romance": [("es", "fr")],
    }
    assert langid.family_of("de-AT") == "germanic" and langid.family_of("tlh") != langid.family_of("qya")


def test_three_languages_vote(spark):
    words = {"en": "the of thing", "de": "und nicht der", "nl": "het een zijn", "fi": "hän oli minä"}
    rows = [(i, f"{words[c]} {'xyz'[i % 3]} {words[c].split()[i % 3]}", c, "s", 1) for i in range(120) for c in words]
    rows = [(4 * n + k, *r[1:]) for n in range(120) for k, r in enumerate(rows[4 * n : 4 * n + 4])]
    model = langid.learn(spark.createDataFrame(rows, DOCS))
    assert len(model.pairs["germanic"]) == 3 and len(model.roots) == 2
    assert [model.predict(t)[0] for t in words.values()] == list(words)


def test_odd_texts(spark, model):
    rows = [(1, None), (2, ""), (3, "123 !? … ²"), (4, "the " * 200_000), (4, "the " * 200_000), (None, "und der nicht"), (5, "é" * 3)]
    docs = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], "doc_id long, text string, lang string, score string, row string")
    found = sorted((r.row.doc_id or 0, r.lang, r.score) for r in langid.identify(docs, model).collect())
    assert found[0][1] == "de"
    assert [f[:2] for f in found[1:4]] == [(1, "und"), (2, "und"), (3, "und")] and all(f[2] == 0 for f in found[1:4])
    assert found[4] == found[5] and found[4][1] == "en"


def test_nothing_or_one_language_to_learn(spark):
    docs = [(i, "the thing of", None if i < 9 else "en", "s", 1) for i in range(30)] + [(None, "x", "de", "s", 1)]
    empty = spark.createDataFrame([], DOCS)
    assert langid.languages(empty).count() == 0
    found = langid.languages(spark.createDataFrame(docs, DOCS)).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("en", 1.0)} and len(found) == 31
    assert not next(r for r in found if r.doc_id is None).held_out
    nothing = langid.languages(spark.createDataFrame(docs[:9], DOCS)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_the_sample_is_bounded_and_blind_to_the_held_out_fold(spark):
    docs = [(i % 4000, f"text {i % 4000}", "en", "s", 1) for i in range(12_000)] + [(7, "hot", "en", "s", 1)] * 3000
    rows = langid.sample(spark.createDataFrame(docs, DOCS), rows=500).collect()
    assert 350 < len(rows) < 650
    held = {f"text {i}" for i in range(4000) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert not held & {r.text for r in rows}


def test_learning_does_not_depend_on_the_order_of_rows(spark, sf_dir, model):
    again = langid.learn(table(spark, sf_dir, "documents").repartition(5))
    for a, b in zip(model.roots + model.pairs["germanic"], again.roots + again.pairs["germanic"]):
        assert (a.weights == b.weights).all() and (a.bias, a.slope) == (b.bias, b.slope)

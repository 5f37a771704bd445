"""Language of texts by hierarchical discrimination.

First the family of a text's language is predicted, then the language among its closely
related ones. Both steps are linear support vector machines over hashed character n-grams:
one against the rest for families, one versus one with votes inside a family. Every machine
is learned in a Spark task of its own, from a bounded sample, and only its weights come to
the driver; all documents are judged in batches, each by the machines of one family alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import stage, whole
from tickweave.llm.labels import held_out

FOLDS, FOLD = 3, 1
FIT_ROWS = 2_000  # documents of a language that are expected in the sample at most
MOST_LANGUAGES = 1_000  # more values of ``lang`` than that are an error
UNKNOWN = "und"
ORDERS = range(1, 5)  # bytes of the n-grams
BITS = 14  # of the hash of an n-gram
WIDTH = 1 << BITS
BLOCK = 1 << 20  # bytes of a text that are hashed at a time
COST = 4.0  # weight of the losses against the length of the weights
EPOCHS = 30
SHARE = 5  # one in so many sampled documents sets the slope of the scores alone

# Codes of languages by family; a language that is not here is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "an ast ca es fr gl it la oc pt rm ro sc wa",
    "slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "indo_aryan": "as bn gu hi mr ne or pa sa sd si ur",
    "iranian": "ckb fa ku ps tg",
    "turkic": "az ba kk ky tk tr tt ug uz",
    "uralic": "et fi hu",
    "semitic": "am ar arz he mt",
    "dravidian": "kn ml ta te",
    "austronesian": "ceb id jv mg mi ms su tl",
    "sinitic": "wuu yue zh",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_OTHER_SIGNS = re.compile(r"[^\w\x00-\x7f]+")  # signs and blanks outside ASCII
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def family_of(lang: str) -> str:
    """The family of a code such as ``de`` or ``de-AT``."""
    return FAMILY.get(re.split("[-_]", lang.lower())[0], f"={lang}")


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _words(text: str) -> np.ndarray:
    """The bytes of a text's words in lower case, one blank around each."""
    text = text.lower()
    if not text.isascii():
        text = _OTHER_SIGNS.sub(" ", text)
    data = np.frombuffer(b" " + text.encode("utf-8", "replace").translate(_LETTERS) + b" ", np.uint8)
    blank = data == 32
    return np.delete(data, np.flatnonzero(blank[1:] & blank[:-1]))


def features(text: str) -> np.ndarray:
    """Square roots of the shares of a text's n-grams, a vector of length one.

    The whole text is read, in blocks, and a text of any length gives as many numbers.
    """
    data = _words(text)
    counts = np.zeros(WIDTH, np.int64)
    for at in range(0, len(data), BLOCK):
        piece = data[at : at + BLOCK + ORDERS[-1] - 1].astype(np.uint32)
        code, hashed = np.zeros(len(piece), np.uint32), []
        for n in ORDERS:
            code = (code[: len(piece) - n + 1] << np.uint32(8)) | piece[n - 1 :]
            starts = code[:BLOCK]  # the rest starts in the next block
            hashed.append((starts + np.uint32(n * 0x3C6EF372 % (1 << 32))) * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS))
        counts += np.bincount(np.concatenate(hashed), minlength=WIDTH)
    return np.sqrt(counts / max(counts.sum(), 1))


@dataclass
class Machine:
    """A linear decision between ``first`` and ``second``, and the slope that makes its
    margin a probability."""

    first: str
    second: str
    weights: np.ndarray
    bias: float
    slope: float

    def chance(self, x: np.ndarray) -> float:
        margin = self.slope * (float(self.weights @ x) + self.bias)
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


@dataclass
class Model:
    families: dict[str, list[str]] = field(default_factory=dict)  # and their languages
    roots: list[Machine] = field(default_factory=list)  # a family against the rest
    pairs: dict[str, list[Machine]] = field(default_factory=dict)  # by family

    def predict(self, text: str) -> tuple[str, float]:
        if not self.families or not has_letter(text):
            return UNKNOWN, 0.0
        x = features(text)
        chances = {m.first: m.chance(x) for m in self.roots} or dict.fromkeys(self.families, 1.0)
        family = max(sorted(chances), key=chances.__getitem__)
        sure = chances[family] / max(sum(chances.values()), 1e-300)
        votes, shares = dict.fromkeys(self.families[family], 0), dict.fromkeys(self.families[family], 0.0)
        for m in self.pairs.get(family, []):
            chance = m.chance(x)
            votes[m.first if chance >= 0.5 else m.second] += 1
            shares[m.first] += chance
            shares[m.second] += 1 - chance
        lang = max(sorted(votes), key=lambda code: (votes[code], shares[code]))
        return lang, min(sure * (shares[lang] / (len(votes) - 1) if len(votes) > 1 else 1.0), 1.0)


def sample(docs: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(lang, text) of documents outside the held-out fold, ``rows`` of each language at
    most on average, chosen by the hash of their ids.

    Rows without id, text or language are left out. A repeated id brings one row, that
    with the least language and text. Only counts are looked at before rows are chosen, so
    nothing is sorted or gathered for it.
    """
    known = docs.filter(~held_out(FOLDS, FOLD) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row.lang, min(rows / max(row.n, 1), 1.0)).otherwise(share)
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.filter(chance < share).select("doc_id", "lang", "text")
    return chosen.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("d")).select("d.lang", "d.text")


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, value = [], []
        for text in batch.column("text").to_pylist():
            x = features(text)
            at.append(np.flatnonzero(x).astype(np.int32))
            value.append(x[at[-1]].astype(np.float32))
        kinds = pa.list_(pa.int32()), pa.list_(pa.float32())
        yield pa.record_batch({"lang": batch.column("lang"), "at": pa.array(at, kinds[0]), "value": pa.array(value, kinds[1])})


def _descent(rows: list, y: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss by dual coordinate descent (Hsieh et al.
    2008). Classes weigh alike, whatever their sizes."""
    w, bias = np.zeros(WIDTH), 0.0
    n = {s: max(int((y == s).sum()), 1) for s in (-1.0, 1.0)}
    soft = np.array([n[s] * 2 / (len(y) * 2 * COST) for s in y])
    norms = np.array([float(v @ v) + 1.0 for _, v in rows]) + soft
    alpha, order = np.zeros(len(y)), np.random.default_rng(len(y))
    for _ in range(EPOCHS):
        worst = 0.0
        for i in order.permutation(len(y)).tolist():
            at, value = rows[i]
            gradient = y[i] * (float(w[at] @ value) + bias) - 1 + soft[i] * alpha[i]
            if alpha[i] == 0 and gradient >= 0:
                continue
            worst = max(worst, abs(gradient))
            step = max(alpha[i] - gradient / norms[i], 0.0) - alpha[i]
            alpha[i] += step
            w[at] += step * y[i] * value
            bias += step * y[i]
        if worst < 1e-3:
            break
    return w, bias


def _slope(margins: np.ndarray, y: np.ndarray) -> float:
    """The slope that makes margins of documents not learned from the likeliest chances."""
    best = min(np.geomspace(0.25, 64, 33), key=lambda s: float(np.logaddexp(0, -s * margins * y).sum()) + 0.01 * s)
    return float(best)


def _machine(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """One machine from its sample; the order in which rows come does not matter."""
    group = group.sort_values(["mark", "y"])
    y, x = group.y.to_numpy(), list(zip(group["at"], group.value))
    apart = np.arange(len(x)) % SHARE == SHARE - 1
    slope = 4.0
    if apart.sum() >= 10:
        w, bias = _descent([x[i] for i in np.flatnonzero(~apart)], y[~apart])
        margins = np.array([w[at] @ v + bias for at, v in (x[i] for i in np.flatnonzero(apart))])
        slope = _slope(margins, y[apart])
    w, bias = _descent(x, y)
    found = {"family": [key[0]], "first": [key[1]], "second": [key[2]]}
    return pd.DataFrame(found | {"weights": [w.astype(np.float32)], "bias": [bias], "slope": [slope]})


def learn(docs: DataFrame, rows: int = FIT_ROWS) -> Model:
    """A model from a sample of ``docs``; without usable rows an empty one, with one
    language a model that knows that language alone.

    A machine of two languages learns from their samples, about 2 x ``rows`` documents; one
    of a family from the sampled documents of all languages, thinned to about ``rows`` on
    either side, so that no task gets more than that.
    """
    spark = docs.sparkSession
    found = stage(sample(docs, rows).mapInArrow(_featured, "lang string, at array<int>, value array<float>"), "language-features")
    counts = {r.lang: r.n for r in found.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per language
    model = Model()
    for lang in sorted(counts):
        model.families.setdefault(family_of(lang), []).append(lang)
    sizes = {family: sum(counts[c] for c in langs) for family, langs in model.families.items()}
    total, plan = sum(sizes.values()), []
    for family, langs in model.families.items():
        plan += [("", a, b, c, 1.0 if c == a else -1.0, 1.0) for a, b in combinations(langs, 2) for c in (a, b)]
        for lang in counts if len(sizes) > 1 else ():
            inside = lang in langs
            share = min(rows / (sizes[family] if inside else total - sizes[family]), 1.0)
            plan.append((family, family, "", lang, 1.0 if inside else -1.0, share))
    if not plan:
        return model
    # Who learns from what: so many rows as machines and languages, whatever the table.
    roles = spark.createDataFrame(plan, "family string, first string, second string, lang string, y double, share double")
    chance = F.pmod(F.xxhash64("mark", "first"), F.lit(1 << 20)) / float(1 << 20)
    marked = found.withColumn("mark", F.xxhash64("lang", "at", "value"))
    dealt = marked.join(F.broadcast(roles), "lang").filter(chance < F.col("share"))
    kind = "family string, first string, second string, weights array<float>, bias double, slope double"
    machines = dealt.groupBy("family", "first", "second").applyInPandas(_machine, kind).collect()  # WIDTH numbers each
    for m in sorted(machines, key=lambda m: (m.family, m.first, m.second)):
        machine = Machine(m.first, m.second, np.array(m.weights, np.float64), m.bias, m.slope)
        if m.family:
            model.roots.append(machine)
        else:
            model.pairs.setdefault(family_of(m.first), []).append(machine)
    return model


def _judged(model):
    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [model.value.predict(text.as_py()) for text in texts]
            langs, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.StructArray.from_arrays([langs, scores], ["lang", "score"])

    return F.arrow_udf(work, "struct<lang:string,score:double>")


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` as ``row`` (a struct of all its columns) with ``lang`` and ``score``, 0 to 1.

    A text that is null or without letters is ``und`` with score 0, and so is any text where
    nothing could be learned. Repeated rows are judged alike; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH numbers a machine
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    judged = docs.select(row.alias("row"), _judged(shared)(whole()).alias("found"))
    return judged.select("row", "found.lang", "found.score")


def languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred and score."""
    found = identify(docs.select("doc_id", "text"), learn(docs)).select("row.doc_id", "lang", "score")
    return found.select("doc_id", held_out(FOLDS, FOLD).alias("held_out"), F.col("lang").alias("lang_pred"), "score")

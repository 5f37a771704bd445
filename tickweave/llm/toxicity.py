"""Toxic passages as maximal scoring segments of word log-odds.

Words and their beginnings get log-odds between toxic and clean texts, with a Dirichlet
prior from the counts of the whole corpus (Monroe et al. 2008); those that differ beyond
chance make the model, and any other word costs a little. A text counts once for each
of its tokens, however often it repeats them. All maximal scoring segments
of a document are found in one scan (Ruzzo and Tompa 1999). Their scores follow an
extreme-value law (Karlin and Altschul 1990), whose parameters come from clean texts; it
turns the segments of a document into one probability by chance, which a logistic curve
maps to the score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import stage, whole
from tickweave.llm.labels import held_out, labelled

FIT_ROWS = 50_000  # labelled documents that the model is learned from
FOLDS, FOLD = 5, 0
TOXIC = 0.5
BEGINNINGS = range(4, 13)  # bytes of the beginnings of words that count as tokens
LEAST_COUNT = 5  # toxic texts that a token must occur in
PRIOR = 20_000.0  # tokens that the prior counts for, beside a half for each
LEAST_Z = 4.0  # standard errors by which the log-odds of a token must differ from zero
MOST = 8.0  # log-odds beyond which a single word says no more
OTHER = -0.1  # score of any other word
SIGNIFICANT = 0.05  # expected number of segments by chance below which one is reported
KEPT_WORDS = 500_000  # words whose score a worker remembers

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SEGMENTS = "array<struct<first:int,last:int,score:double,expected:double,passage:string>>"


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters, A-Z in lower case."""
    return text.translate(_FOLD).split()


def tokens_of(word: bytes) -> list[bytes]:
    """The beginnings of a word, shorter ones first, and the whole word."""
    return [word[:k] + b"-" for k in BEGINNINGS if k < len(word)] + [word]


@dataclass
class Model:
    weights: dict[bytes, float]
    scale: float = 1.0  # lambda of the extreme-value law
    rate: float = 0.1  # K of the extreme-value law
    curve: tuple[float, float] | None = None  # of the logistic curve


class Scores(dict):
    """The score of each word: the weight of its longest token in the model."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        weights = self.model.weights
        score = next((weights[t] for t in reversed(tokens_of(word)) if t in weights), OTHER)
        if len(self) < KEPT_WORDS:
            self[word] = score
        return score


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), in one scan.

    Words between two positive ones are one step, as no segment ends among them.
    """
    found: list[list] = []  # first, last, sum before first, sum up to last, lower
    sums = np.cumsum(scores)
    for at in np.flatnonzero(scores > 0).tolist():
        first, before, upto = at, sums[at - 1] if at else 0.0, sums[at]
        lower = len(found) - 1
        while True:
            # The nearest segment that starts from a lower sum. Each one knows its own,
            # and all between the two start higher, so none is looked at twice.
            while lower >= 0 and found[lower][2] >= before:
                lower = found[lower][4]
            if lower < 0 or found[lower][3] >= upto:
                found.append([first, at, before, upto, lower])
                break
            first, _, before, _, next_lower = found[lower]
            del found[lower:]
            lower = next_lower
    return [(first, last, float(upto - before)) for first, last, before, upto, _ in found]


def evidence(model: Model, found: list[tuple[int, int, float]], n: int) -> float:
    """-log of the probability that clean text of ``n`` words has segments as good: the
    least over the best one, two and more (sum statistics)."""
    best, total, least = 0.0, 0.0, log(max(model.rate * n, 1e-9))
    for r, score in enumerate(sorted((s for *_, s in found), reverse=True), 1):
        total += model.scale * score - least
        if total <= 0:
            break
        chance = -total + (r - 1) * log(total) - lgamma(r + 1) - lgamma(r) + log(r)
        best = max(best, -chance)
    return best


def _toxic_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").cast(pa.binary()):
            words = set(words_of(text.as_py()))
            counts.update({token for word in words for token in tokens_of(word)})
            counts[b""] += len(words)
    yield pa.record_batch({"token": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())})


class Places(dict):
    """The places of each word's candidate tokens."""

    def __init__(self, place: dict[bytes, int]):
        super().__init__()
        self.place = place

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        found = tuple(self.place[t] for t in tokens_of(word) if t in self.place)
        if len(self) < KEPT_WORDS:
            self[word] = found
        return found


def _counted(tokens):
    """In how many clean labelled texts and in how many of all texts each candidate token
    occurs; the last place holds the distinct words of the texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(tokens.value)
        counts = np.zeros((2, len(tokens.value) + 1), np.int64)
        for batch in batches:
            for text, is_clean in zip(batch.column("text").cast(pa.binary()), batch.column("clean").to_pylist()):
                words = set(words_of(text.as_py()))
                found = list(set(chain.from_iterable(map(places.__getitem__, words))))
                for row in (0, 1) if is_clean else (0,):
                    counts[row, found] += 1
                    counts[row, -1] += len(words)
        seen = np.flatnonzero(counts[0])
        yield pa.record_batch({"at": seen, "n": counts[0, seen], "clean": counts[1, seen]})

    return work


def _log_odds(y1, y0, every) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds and their standard scores; the last place of each array is the total."""
    prior = 0.5 + PRIOR * every[:-1] / max(every[-1], 1)
    total = PRIOR + 0.5 * len(prior)
    odds = []
    for y in (y1, y0):
        odds.append(np.log(y[:-1] + prior) - np.log(np.maximum(y[-1] + total - y[:-1] - prior, 0.5)))
    delta = odds[0] - odds[1]
    return delta, delta / np.sqrt(1 / (y1[:-1] + prior) + 1 / (y0[:-1] + prior))


def _weights(docs: DataFrame, chosen: DataFrame) -> dict[bytes, float]:
    context = docs.sparkSession.sparkContext
    toxic = chosen.filter("y = 1").select(whole().alias("text"))
    counted = toxic.mapInArrow(_toxic_tokens, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counted = stage(counted, "toxic-tokens")
    empty = F.lit(b"")
    # Tokens of at most FIT_ROWS documents.
    rows = counted.filter((F.col("n") >= LEAST_COUNT) & (F.col("token") != empty)).orderBy("token").toArrow()
    if not len(rows):
        return {}
    tokens = rows["token"].to_pylist()
    place = {token: i for i, token in enumerate(tokens)}
    ids = chosen.filter("y = 0").select("doc_id", F.lit(True).alias("is_clean"))
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left")  # no more than FIT_ROWS ids
    texts = texts.select(whole().alias("text"), F.coalesce("is_clean", F.lit(False)).alias("clean"))
    found = texts.mapInArrow(_counted(context.broadcast(place)), "at long, n long, clean long")
    found = found.groupBy("at").agg(F.sum("n").alias("n"), F.sum("clean").alias("clean")).toArrow()  # one row per token
    words = counted.filter(F.col("token") == empty).first()
    y1 = np.append(rows["n"].to_numpy(), words.n).astype(np.float64)
    y0, every = np.zeros(len(y1)), np.zeros(len(y1))
    y0[found["at"].to_numpy()] = found["clean"].to_numpy()
    every[found["at"].to_numpy()] = found["n"].to_numpy()
    delta, z = _log_odds(y1, y0, every)
    return {tokens[i]: float(min(delta[i], MOST)) for i in np.flatnonzero(z >= LEAST_Z)}


def _scores(n: int, at: np.ndarray, value: np.ndarray) -> np.ndarray:
    out = np.full(n, OTHER)
    out[at] = value
    return out


def _law(clean: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[float, float]:
    """Lambda and K from the word scores of clean texts."""
    words = sum(n for n, *_ in clean)
    positive = np.concatenate([v for *_, v in clean]) if clean else np.zeros(0)
    if not len(positive):
        return 1.0, 0.1
    levels, counts = np.unique(positive, return_counts=True)
    levels, shares = np.append(levels, OTHER), np.append(counts, words - len(positive)) / words
    if shares @ levels >= 0:
        return 0.1, 1.0
    low, high = 1e-6, 1.0
    while shares @ np.exp(np.minimum(high * levels, 700)) < 1:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if shares @ np.exp(np.minimum(mid * levels, 700)) < 1 else (low, mid)
    tops = sorted(s for text in clean if len(text[1]) for *_, s in segments(_scores(*text)))
    level = tops[len(tops) // 2]
    rate = sum(s >= level for s in tops) / (words * exp(-low * level))
    return low, min(max(rate, 1e-4), 10.0)


def _hits(weights):
    """The positive words of labelled texts, as (y, words, places, scores)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(Model(weights.value))
        for batch in batches:
            n, at, value = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                found = np.array([scores[w] for w in words_of(text.as_py())])
                n.append(len(found))
                at.append(np.flatnonzero(found > 0))
                value.append(found[found > 0])
            yield pa.record_batch(
                {
                    "y": batch.column("y").cast(pa.int32()),
                    "n": pa.array(n, pa.int32()),
                    "at": pa.array(at, pa.list_(pa.int32())),
                    "value": pa.array(value, pa.list_(pa.float64())),
                }
            )

    return work


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve of y over x by Newton steps, with a small ridge."""
    a = np.stack([np.ones(len(x)), x], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a @ w)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + 0.01 * np.eye(2), a.T @ (y - p) - 0.01 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS) -> Model:
    """A model from at most ``rows`` labelled documents that are not held out; the prior
    counts the words of all of ``docs``."""
    chosen = stage(labelled(docs, labels, label, held_out(FOLDS, FOLD), rows), "labelled")
    weights = _weights(docs, chosen)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    texts = chosen.select("y", whole().alias("text"))
    hits = texts.mapInArrow(_hits(shared), "y int, n int, at array<int>, value array<double>").toArrow()
    y, n = hits["y"].to_numpy(), hits["n"].to_numpy()
    if not y.any():
        return Model(weights)
    words = [(int(k), at.values.to_numpy(), v.values.to_numpy()) for k, at, v in zip(n, hits["at"], hits["value"])]
    # The order in which rows come must not matter.
    order = sorted(range(len(words)), key=lambda i: (y[i], n[i], words[i][1].tolist(), words[i][2].tolist()))
    scale, rate = _law([words[i] for i in order if not y[i]])
    model = Model(weights, scale, rate)
    x = np.array([evidence(model, segments(_scores(*words[i])), words[i][0]) if len(words[i][1]) else 0.0 for i in order])
    model.curve = _curve(x, y[order].astype(np.float64))
    return model


def _judged(model):
    kind = pa.struct(
        [("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("expected", pa.float64()), ("passage", pa.string())]
    )

    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        law = model.value
        scores = Scores(law)
        for texts in batches:
            out, passages = [], []
            for text in texts.cast(pa.binary()):
                words = words_of(text.as_py())
                found = segments(np.fromiter(map(scores.__getitem__, words), np.float64, len(words)))
                x = evidence(law, found, len(words))
                out.append(1 / (1 + exp(-min(max(law.curve[0] + law.curve[1] * x, -700), 700))) if law.curve else 0.0)
                kept = []
                for first, last, score in found:
                    expected = law.rate * len(words) * exp(-min(law.scale * score, 700))
                    if expected <= SIGNIFICANT:
                        passage = b" ".join(words[first : last + 1]).decode("utf-8", "replace")
                        kept.append({"first": first, "last": last, "score": score, "expected": expected, "passage": passage})
                passages.append(kept)
            yield pa.StructArray.from_arrays([pa.array(out, pa.float64()), pa.array(passages, pa.list_(kind))], ["score", "passages"])

    return F.arrow_udf(work, f"struct<score:double,passages:{SEGMENTS}>")


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` as ``row`` (a struct of all its columns) with ``score``, 0 to 1, and
    ``passages``, the significant segments: first and last word, score, the number
    expected by chance, and the words.

    Null and empty texts have no passages and the score of clean ones; without toxic
    labels every score is 0. Repeated rows score alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    judged = docs.select(row.alias("row"), _judged(shared)(whole()).alias("found"))
    return judged.select("row", "found.score", "found.passages")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted."""
    scored = judge(docs.select("doc_id", "text"), learn(docs, labels)).select("row.doc_id", "score")
    predicted = (F.col("score") >= TOXIC).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(FOLDS, FOLD).alias("held_out"), "score", predicted)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that score as toxic."""
    kept = judge(docs, learn(docs, labels)).filter(F.col("score") < TOXIC)
    return kept.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))

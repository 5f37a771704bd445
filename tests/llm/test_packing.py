"""Packed sequences against the library's numbers and the rules of packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickweave.llm import packing
from tickweave.llm.common import table
from tickweave.llm.tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
PLAIN.encode_special_tokens = True


def numbers(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aA é\n\t'st1 .,　\x1c<|") | st.characters(exclude_categories=["Cs"]), max_size=40))
def test_numbers_are_the_librarys(text):
    code = encoder(PATH)
    assert np.frombuffer(code(text), code.kind).tolist() + [1] == numbers(text)


def check(pieces, docs, window=packing.WINDOW):
    ids = defaultdict(list)
    for doc_id, text in docs:
        ids[doc_id].append(numbers(text))
    placed, filled = defaultdict(list), defaultdict(list)
    for p in pieces:
        filled[p.sequence_id].append((p.offset, p.length))
        placed[p.doc_id].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at == window or at & (at - 1) == 0 and at < window
    assert set(placed) == set(ids)
    for doc_id, texts in ids.items():
        wanted = defaultdict(int)
        for t in texts:
            wanted[len(t)] += 1
        for size, copies in wanted.items():
            cover = [0] * size
            for start, length, crc, n in placed[doc_id]:
                if n == size:
                    assert any(
                        zlib.crc32(np.array(t[start : start + length], "<u4").tobytes()) == crc for t in texts if len(t) == n
                    )
                    for k in range(start, start + length):
                        cover[k] += 1
            assert cover == [copies] * size


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    pieces = packing.packed(docs, PATH).collect()
    check(pieces, [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("shard", [packing.SHARD_TOKENS, 3000])
def test_odd_rows(spark, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD_TOKENS", shard)
    rng = random.Random(1)
    rows = [(None, "lost words"), (1, None), (1, ""), (2, "same text"), (2, "same text"), (3, "long text " * 20_000)]
    rows += [(10 + i, " ".join(rng.choice(["red", "green", "blue"]) for _ in range(rng.randint(1, 900)))) for i in range(60)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, start int")
    check(packing.packed(docs, PATH).collect(), rows)
    assert packing.packed(docs.limit(0), PATH).collect() == []


def test_neighbours_share_windows():
    docs = [packing.Doc(i, np.arange(100) + 1000 * (i % 5), 0, 100) for i in range(50)]
    idf = np.full(6000, 3.0)
    packer = packing.Packer(500, 0)
    packer.pack(docs, packing.Corpus(idf, 100.0))
    topics = defaultdict(set)
    for row in packer.rows:
        topics[row[5]].add(row[0] % 5)
    assert len(topics) == 10 and all(len(t) == 1 for t in topics.values())


LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext|", "|>", " ", "  ", "\n", "a", " word", "é.", "\t"]), max_size=12))
def test_added_tokens_are_the_librarys(parts):
    code, text = encoder(PATH), "".join(parts)
    assert np.frombuffer(code(text), code.kind).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_pieces_of_texts_with_added_tokens(spark):
    text = "one <|endoftext|> two<|endoftext|><|endoftext|>"
    (piece,) = packing.packed(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).filter("start = 0").collect()
    ids = [*LIBRARY.encode(text, add_special_tokens=False).ids, packing.END]
    assert ids.count(50256) == 3 and piece.doc_tokens == len(ids)
    assert piece.ids_crc32 == zlib.crc32(np.array(ids[: piece.length], "<u4").tobytes())


def test_neighbours_against_plain_bm25(spark):
    """Ranked by the terms of whole documents, also where only their end is to be placed."""
    rng = np.random.default_rng(4)
    texts = [rng.zipf(1.3, n) % 400 for n in rng.integers(20, 900, 60)]
    holders = np.array([sum((x == t).any() for x in texts) for t in range(400)])
    idf = np.log((len(texts) - holders + 0.5) / (holders + 0.5))
    mean = float(np.mean([len(x) for x in texts]))
    docs = [packing.Doc(i, x[-10:], len(x) - 10, len(x), *np.unique(x, return_counts=True)) for i, x in enumerate(texts)]
    index = packing.Index(docs, packing.Corpus(idf, mean))
    index.unused[7] = False

    def score(seed, other):
        total = 0.0
        for t in set(seed.tolist()) & set(other.tolist()):
            if idf[t] >= packing.LEAST_IDF:
                n = (other == t).sum()
                total += idf[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(other) / mean))
        return total

    for seed in range(len(texts)):
        scores = {i: score(texts[seed], x) for i, x in enumerate(texts) if i != 7}
        got = index.neighbours(seed).tolist()
        assert set(got) == {i for i, s in scores.items() if s > 0}
        assert np.allclose([scores[i] for i in got], sorted((s for s in scores.values() if s > 0), reverse=True))


def test_long_documents_carry_the_terms_of_all_their_windows():
    work = packing._coded(PATH, 16)
    text = " alpha" * 20 + " beta" * 3
    batch = pa.record_batch({"doc_id": pa.array([1], pa.int64()), "text": pa.array([text])})
    row = next(work(iter([batch]))).to_pylist()[0]
    kind, ids = encoder(PATH).kind, numbers(text)
    terms, counts = np.frombuffer(row["terms"], kind), np.frombuffer(row["counts"], "<i8")
    assert row["start"] == 16 and dict(zip(terms.tolist(), counts.tolist())) == {t: ids.count(t) for t in set(ids)}

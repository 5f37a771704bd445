"""The pipeline stage by stage against plain Python, and over odd rows."""

import random

import public_tokenizers
from test_decontam import NUMBERS
from test_decontam import plain as plain_decontam
from test_packing import check as check_packing
from test_simhash import plain_components

import corpus_pipeline
from tickweave.llm import toxicity
from tickweave.llm.common import scratch, table


def written(spark, df):
    path = scratch(spark, "stage")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages_over_a_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, kept = docs.columns, [docs]
    for _, work in corpus_pipeline.STAGES:
        kept.append(written(spark, work(spark, kept[-1], sf_dir)))
    rows = [{r.doc_id: r for r in df.collect()} for df in kept[:-1]]
    assert all(df.columns == columns for df in kept[:-1])
    assert [len(r) for r in rows] == [df.count() for df in kept[:-1]]

    toxic = toxicity.toxicity(docs, table(spark, sf_dir, "labels")).collect()
    assert set(rows[1]) == {r.doc_id for r in toxic if not r.predicted}
    assert all(rows[1][i] == rows[0][i] for i in rows[1])

    components = plain_components([(i, r.text) for i, r in rows[1].items()])
    assert set(rows[2]) == {c for _, _, c in components}
    assert all(rows[2][i] == rows[1][i] for i in rows[2])

    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    bad = {d[0] for d in plain_decontam([(i, r.text) for i, r in rows[2].items()], items) if d[-1]}
    assert set(rows[3]) == set(rows[2]) - bad

    assert set(rows[4]) == set(rows[3])
    assert all(len(r.text) == r.n_chars for r in rows[4].values())
    check_packing(kept[-1].collect(), [(i, r.text) for i, r in rows[4].items()])


def test_odd_rows(spark, tmp_path):
    rng = random.Random(1)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(80))
    base = text()
    rows = [(None, base, "en"), (1, base, "en"), (1, base, None), (2, None, "en"), (3, "", "en"), (4, text(), "de")]
    rows += [(5, text() + " " + NUMBERS, "en"), (6, "call +49 (30) 1234567 or a@b.example " + text(), "en")]
    rows += [(None, text(), "en"), (7, "long word " * 50_000, "en")]
    docs = spark.createDataFrame(
        [(i, t, lang, "s", None if t is None else len(t), 1) for i, t, lang in rows],
        "doc_id long, text string, lang string, source string, n_chars long, score int",
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, NUMBERS)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    ids, last = [], spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, work in corpus_pipeline.STAGES:
        last = written(spark, work(spark, last, str(tmp_path)))
        ids.append(sorted((r.doc_id for r in last.select("doc_id").collect()), key=str))
    assert ids[0].count(1) == 2 and ids[1] == [1, 2, 4, 5, 6, 7, None] and 5 not in ids[2]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == last.count()
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, work in corpus_pipeline.STAGES:
        empty = written(spark, work(spark, empty, str(tmp_path)))
    assert empty.count() == 0


def test_masked_texts(spark):
    text = "é write to a.b@c.example, +49 (30) 1234567, 10.0.0.1, 4111 1111 1111 1111 or DE89370400440532013000."
    docs = spark.createDataFrame([(1, text, 0, "x"), (2, None, None, "y")], "doc_id long, text string, n_chars long, pii string")
    rows = {r.doc_id: r for r in corpus_pipeline.pii(spark, docs, "").collect()}
    assert rows[1].text == "é write to [EMAIL], [PHONE], [IP], [CARD] or [IBAN]."
    assert rows[1].n_chars == len(rows[1].text) and rows[1].pii == "x" and rows[2].text is None
    assert public_tokenizers.path("byte_bpe_50k.json")

import random

import corpus_pipeline
import numpy as np
import pytest
from evalspark.llm import quality, queries
from evalspark.llm.packing import encoder
from helpers import DOC, similar, without_repeats
from test_quality import corpus

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Documents with junk, copies, near copies and a passage that several documents share."""
    rng = random.Random(9)
    rows, gold = corpus(9, 300)
    passage = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(60))
    good = [r for r in rows if gold[r[0]]]
    for k, r in enumerate(good[:30]):
        text = r[1]
        if k < 10:
            text = text + " End."  # a near copy
        elif k < 20:
            text = r[1] + " " + passage + " " + "".join(rng.choices("xyz ", k=200))
        rows.append((1000 + k, text, r[2], r[3], len(text)))
        gold[1000 + k] = 1
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, g, 0) for i, g in gold.items()], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, gold


def test_stages_against_brute_force(spark, planted, tmp_path):
    folder, rows, gold = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}

    def step(k, docs):
        out = corpus_pipeline.STAGES[k][1](spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{k}")
        return spark.read.parquet(f"{tmp_path}/{k}")

    first = step(0, docs)
    kept = texts(first)
    assert first.columns == columns and np.mean([(i in kept) == bool(g) for i, g in gold.items()]) > 0.97
    assert all(kept[i] == t for i, t, *_ in rows if i in kept)

    second = step(1, first)
    root = similar(kept.items(), 5, 80, 100)
    assert second.columns == columns and texts(second) == {i: t for i, t in kept.items() if root[i][1] == i}

    third = step(2, second)
    assert third.columns == columns
    before, after = texts(second), {r["doc_id"]: r for r in third.collect()}
    want = without_repeats(before.items(), 100)
    assert set(after) == set(before)
    for i, r in after.items():  # texts are ASCII, so characters are bytes
        assert len(r["text"]) == want[i][0] - want[i][1] == r["n_chars"]

    pieces = step(3, third).collect()
    tokens = {i: len(encoder().encode_ordinary(r["text"])) + 1 for i, r in after.items()}
    assert {p["doc_id"]: p["doc_tokens"] for p in pieces} == tokens
    assert sum(p["length"] for p in pieces) == sum(tokens.values())


def test_run_and_queries(spark):
    assert set(corpus_pipeline.run(spark, SF).columns) >= {"doc_id", "sequence_id", "offset"}
    assert list(queries.QUERIES) == sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert len(queries.QUERIES) == 10


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_null_ids_and_columns_pass(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(None, None, None, None, None), (None, "some text", "en", "a", 9), (1, None, "en", "a", None)]
    # one id for two documents, a near copy of one of them, a copy without an id, and a repeated row
    rows += [(7, long, "en", "a", 1), (7, long[::-1], "en", "a", 1), (8, long + " more", "en", "a", 1), (None, long[::-1], "en", "a", 1), (7, long, "en", "a", 1)]
    spark.createDataFrame(rows, DOC).selectExpr("*", "'x' AS quality", "'y' AS kept_text", "1 AS n", "map('a', 1) AS _doc").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.columns[-4:] == ["quality", "kept_text", "n", "_doc"]
    assert sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str) == sorted([(None, ""), (None, "some text"), (1, ""), (7, long), (7, long[::-1])], key=str)


def test_quality_model_is_small(spark, planted):
    folder, *_ = planted
    model = quality.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"), labelled=50, rounds=1)
    assert model.views is None or len(model.views[0].weights) == quality.TEXT_WIDTH + 1

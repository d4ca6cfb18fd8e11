import math
import random

import numpy as np
from evalspark.llm.topk import Blocks, top_k
from pyspark.sql import functions as F


def brute(rows, k, every):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in ok:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in ok if i != q and len(v) == len(qv))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_equals_brute_force(spark, monkeypatch):
    import evalspark.llm.topk as topk

    monkeypatch.setattr(topk, "CELL", 90)
    monkeypatch.setattr(topk, "QUERIES", 10)
    rng = random.Random(1)
    rows = [(i, [float(np.float32(rng.gauss(0, 1))) for _ in range(8)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(20)]  # ties
    rows += [(5000, None), (5010, [float("nan")] * 8), (5020, [1.0, None] * 4), (5030, [float("inf")] * 8), (None, rows[0][1]), (5040, [1.0, 2.0]), (5050, [1.0, 3.0]), (5060, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("row", F.lit(1))
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 10 == 0, 5).collect())
    assert got == brute(rows, 5, 10)
    assert top_k(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []


def test_large_weights_are_exact(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 0.00390625]), (2, [3e6, 0.0]), (3, [-3e6, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in top_k(df, F.col("vec_id") == 0, 5).collect()) == [x for x in brute(rows, 5, 4)]


def test_bounds_skip_blocks():
    rng = np.random.default_rng(0)
    near = np.floor(256 * rng.normal(3, 0.1, (256, 16)))
    far = np.floor(256 * rng.normal(-3, 0.1, (2560, 16)))
    blocks = Blocks(np.arange(2816), np.concatenate([far, near]))
    (_, ids, _), = blocks.search(np.array([-1]), near[:1], 5)
    assert blocks.scored == 256 and (ids >= 2560).all()


def test_rows_of_a_kind_share_blocks():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 64))
    rows = centres[rng.integers(0, 40, 8192)] + rng.normal(size=(8192, 64)) * 0.05
    weights = np.floor(256 * rows)
    blocks = Blocks(np.arange(8192), weights)
    found = {q: ids.tolist() for q, ids, _ in blocks.search(np.arange(0, 8192, 400), weights[::400], 5)}
    scores = weights[::400] @ weights.T
    for at, q in enumerate(range(0, 8192, 400)):
        assert found[q] == sorted((i for i in range(8192) if i != q), key=lambda i: (-scores[at, i], i))[:5]
    assert blocks.scored < 0.35 * 21 * 8191

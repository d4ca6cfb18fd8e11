import numpy as np
import pytest
from evalspark.llm.near_vectors import chunk_masks, codes_of, iterative_quantisation, near_vectors
from helpers import roots


def clustered(n, dim=64, copies=8, seed=0):
    """Centres, each with copies at cosines around 0.96 to 0.999."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n // copies):
        c = rng.normal(size=dim)
        for k in range(copies):
            out.append(c + rng.normal(size=dim) * (0 if k == 0 else rng.uniform(0.02, 0.2)))
    return np.array(out, np.float32)


def brute(rows):
    ok = [(i, np.array(v, float), label) for i, v, label in rows if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = set()
    for at, (i, v, a) in enumerate(ok):
        for j, w, b in ok[at + 1 :]:
            if a == b and len(v) == len(w) and i != j and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.98:
                links.add((min(i, j), max(i, j)))
    return links


def test_recall_and_no_wrong_link(spark):
    x = clustered(1600)
    rows = [(i, v.tolist(), i % 3 if i % 40 else None) for i, v in enumerate(x)]
    rows = [(i, v, (i // 8) % 3 if label is not None else None) for i, v, label in rows]
    rows += [(2000 + i, rows[9][1], rows[9][2]) for i in range(50)]  # equal vectors
    rows += [(3000, None, 1), (3001, [0.0] * 64, 1), (3002, [float("nan")] * 64, 1), (3003, [None] * 64, 1), (3004, [], 1), (3005, [1.0, 2.0], 1), (3006, [2.0, 4.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS n", "2 AS chunk")
    out = {r["vec_id"]: r for r in near_vectors(df).collect()}
    assert len(out) == len(rows)
    links = brute(rows)
    found = sum(r["n_links"] for r in out.values()) / 2
    assert 0.9 * len(links) <= found <= len(links)
    assert out[3000]["n_links"] == out[3001]["n_links"] == out[3004]["n_links"] == 0
    assert out[3005]["component_id"] == out[3006]["component_id"] == 3005
    root = roots(out, links)
    assert np.mean([out[i]["component_id"] == root[i] for i in out]) > 0.95
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out.values())


def test_hot_bucket_is_compared_whole(spark, monkeypatch):
    import evalspark.llm.near_vectors as nv

    monkeypatch.setattr(nv, "BLOCK", 16)
    rng = np.random.default_rng(1)
    c = rng.normal(size=64)
    rows = [(i, (c + rng.normal(size=64) * 0.01).astype(np.float32).tolist(), 1) for i in range(150)] + [(500, None, 1)]
    out = {r["vec_id"]: r for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert all(out[i]["n_links"] == 149 and out[i]["component_id"] == 0 for i in range(150))


def test_empty_and_null_ids(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert near_vectors(spark.createDataFrame([], kind)).collect() == []
    out = near_vectors(spark.createDataFrame([(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)], kind)).collect()
    assert sorted((r["n_links"], r["component_id"] or -1) for r in out) == [(0, -1), (0, 1), (0, 1)]


def test_rotation_lowers_the_quantisation_error():
    x = clustered(2000)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    error = lambda p: ((np.where(x @ p >= 0, 1, -1) - x @ p) ** 2).sum()
    assert error(iterative_quantisation(x)) < error(iterative_quantisation(x, rounds=0))
    codes = codes_of(x, iterative_quantisation(x))
    assert iterative_quantisation(x[:, :10]).shape == (10, 64)
    bits = (codes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    assert abs(bits.mean() - 0.5) < 0.05
    masks = chunk_masks(64, 6)
    assert sum(masks) == (1 << 64) - 1 and len(masks) == 6


def test_different_vectors_of_one_id(spark):
    rng = np.random.default_rng(3)
    c = rng.normal(size=64)
    near = lambda: (c + rng.normal(size=64) * 0.01).tolist()
    a, b, far = near(), near(), rng.normal(size=64).tolist()
    rows = [(1, a, 1), (2, a, 1), (1, far, 1), (3, b, 1), (4, far, 2)]
    out = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out) == [(1, 0, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4)]
    # two classes whose smallest ids are equal keep counts of their own
    rows = [(1, a, 1), (2, a, 1), (1, b, 1)]
    out = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r["vec_id"], r["n_links"]) for r in out) == [(1, 2), (1, 2), (2, 2)]


@pytest.mark.parametrize("dim", [3, 300, 3000])
def test_recall_at_other_lengths(spark, dim):
    x = clustered(240, dim, seed=dim)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    out = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    links = brute(rows)
    found = sum(r["n_links"] for r in out) / 2
    assert 0.9 * len(links) <= found <= len(links)
    codes = codes_of(x, iterative_quantisation(x.astype(float)))
    assert len(set(codes.tolist())) > 20

import random

import numpy as np
import pyarrow as pa
import xxhash
from evalspark.llm import quality
from helpers import AWKWARD, DOC


def corpus(seed=1, n=900):
    """Good prose and junk; the source tells junk apart in part, so both views have something to say."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghilmnorst", k=rng.randint(2, 9))) for _ in range(400)]
    rows, gold = [], {}
    for i in range(n):
        good = rng.random() < 0.75
        w = rng.choices(words, k=rng.randint(15, 120))
        text = " ".join(w).capitalize() + "." if good else rng.choice([" ".join(x.upper() + "!!" for x in w), " ".join(f"{x}$$$" for x in w), " ".join([w[0]] * 40)])
        source = rng.choice("abcd") if good or rng.random() < 0.3 else "spam"
        rows.append((i, text, "en", source, len(text)))
        gold[i] = int(good)
    return rows, gold


def test_held_out_accuracy_and_exchange(spark):
    rows, gold = corpus()
    docs = spark.createDataFrame(rows, DOC)
    labels = spark.createDataFrame([(i, gold[i], 0) for i in range(0, 900, 3)] + [(None, 1, 0), (1, None, 0), (2, 7, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    assert sum(a for a, _ in model.exchanged) > 0 and sum(b for _, b in model.exchanged) > 0
    out = {r["doc_id"]: r for r in quality.score(docs, model).collect()}
    other = [i for i in out if i % 3]
    assert np.mean([out[i]["accepted"] == bool(gold[i]) for i in other]) > 0.97
    assert all(0 <= r["quality"] <= 1 for r in out.values())


def test_without_both_kinds_all_are_accepted(spark):
    docs = spark.createDataFrame([*AWKWARD, (None, "no id", None, None, None), AWKWARD[4]], DOC).selectExpr("*", "'own' AS quality", "5 AS label")
    for labels in ([], [(1, 1, 0), (4, 1, 0)]):
        model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        out = quality.score(docs, model, into=("_q", "_a")).collect()
        assert len(out) == len(AWKWARD) + 2 and all(r["_a"] for r in out) and all(r["quality"] == "own" for r in out)
    assert quality.score(docs.limit(0), model).collect() == []


def test_few_positive_labels_accept_all(spark):
    docs = spark.createDataFrame(corpus(n=40)[0], DOC)
    for positive in (0, 1):
        labels = spark.createDataFrame([(i, int(i < positive), 0) for i in range(30)], "doc_id long, quality int, toxic int")
        model = quality.fit(docs, labels)
        out = quality.score(docs, model).collect()
        assert model.views is None and len(out) == 40
        assert all(r["accepted"] and r["quality"] < quality.ACCEPT for r in out)


def test_a_view_without_signal_changes_little():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400)
    text = rng.normal(size=(400, quality.TEXT_WIDTH)) * 0.01
    text[:, 0] = y * 2.0 + rng.normal(size=400)
    noise = rng.integers(0, 2, (400, quality.META)).astype(float)
    held = np.arange(400) % 4 == 0
    model = quality.co_train(np.hstack([text, noise]).astype(np.float32), y, held, lambda *a: [])
    p = model.probability((text, noise))
    assert np.mean((p > 0.5) == y) > 0.75


def test_equals_plain_co_training(spark):
    """The same method in one process over all rows at once: every score is equal."""
    rows, gold = corpus(4, 400)
    rows += [(1000 + i, *rows[i][1:]) for i in range(30)] + [(rows[5][0], "another text of a repeated id", "en", "a", 29)]
    docs = spark.createDataFrame(rows, DOC).repartition(7)
    labels = spark.createDataFrame([(i, gold[i], 0) for i in range(0, 400, 4)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)

    table = pa.table({"text": [r[1] for r in rows], "lang": [r[2] for r in rows], "source": [r[3] for r in rows], "n_chars": [r[4] for r in rows]}).to_batches()[0]
    x = np.hstack(quality._features(table))
    own = sorted({r[0] for r in rows} & {i for i in gold if i % 4 == 0})
    first = {d: min(x[k].tobytes() for k, r in enumerate(rows) if r[0] == d) for d in own}
    fit = np.stack([np.frombuffer(first[d], np.float32) for d in own])
    y = np.array([gold[d] for d in own])
    held = np.zeros(len(y), bool)
    for kind in (0, 1):
        held[[k for k in range(len(y)) if y[k] == kind][:: quality.HELD_OUT]] = True
    known = [{r.tobytes() for r in fit}, {r.tobytes() for r in fit}]

    def plainly(models, taken, most):
        out = []
        for v in (0, 1):
            for kind in (0, 1):
                sure = {}
                for row in x:
                    part = row[: quality.TEXT_WIDTH] if v == 0 else row[quality.TEXT_WIDTH :]
                    odds = float(np.asarray(part, np.float64) @ models[v].weights[:-1] + models[v].weights[-1])
                    p = 1 / (1 + np.exp(-(odds if kind else -odds)))
                    if p >= quality.CONFIDENT and row.tobytes() not in known[1 - v]:
                        sure[row.tobytes()] = p
                key = lambda raw: int(np.array([xxhash.xxh3_64_intdigest(raw)], np.uint64).view(np.int64)[0])
                chosen = sorted(sure, key=lambda raw: (-sure[raw], key(raw)))[: most[kind]]
                out += [(v, kind, sure[raw], key(raw), np.frombuffer(raw, np.float32)) for raw in chosen]
        for v, _, _, _, row in out:
            known[1 - v].add(row.tobytes())
        return out

    plain = quality.co_train(fit, y, held, plainly)
    assert model.exchanged == plain.exchanged and sum(map(sum, plain.exchanged)) > 0
    scores = {(r["doc_id"], r["text"]): r["quality"] for r in quality.score(docs, model).collect()}
    want = plain.probability((x[:, : quality.TEXT_WIDTH], x[:, quality.TEXT_WIDTH :]))
    assert all(abs(scores[r[0], r[1]] - p) < 1e-6 for r, p in zip(rows, want, strict=True))

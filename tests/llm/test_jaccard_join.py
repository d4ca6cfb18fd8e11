import random

import numpy as np
import pyarrow as pa
import pytest
from evalspark.llm.jaccard_join import CELLS, outline, prefix_length, similar_components
from evalspark.llm.shingles import shingle_sets
from helpers import AWKWARD, DOC, shingles, similar


def corpus(seed, n=250):
    """Documents, copies, near copies at many distances, one large near-copy group, and a shared passage."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    text = lambda k: [rng.choice(words) for _ in range(k)]
    passage, base, rows = text(40), text(60), []
    for i in range(n):
        kind = rng.random()
        if kind < 0.4 or not rows:
            w = text(rng.choice([1, 2, 3, 4, rng.randint(5, 120)]))
        elif kind < 0.5:
            w = rng.choice(rows)[1].split()
        else:
            w = list(base if kind < 0.7 else rng.choice(rows)[1].split())
            for _ in range(rng.choice([0, 1, 1, 2, 3, 8])):
                w[rng.randrange(len(w))] = rng.choice(words)
        if rng.random() < 0.1:
            w = w + passage
        rows.append((i, " ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("words", "num"), [(3, 90), (5, 80), (2, 50)])
def test_equals_brute_force(spark, words, num):
    rows = corpus(words) + [(r[0] + 1000, r[1]) for r in AWKWARD]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6).selectExpr("*", "1 AS n", "2 AS key", "3 AS component_id")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_components(df, words, num, 100).collect()}
    assert got == similar(rows, words, num, 100)


def test_identical_prefixes_are_expanded(spark, monkeypatch):
    import evalspark.llm.jaccard_join as jj

    # all shingles in one order and a short prefix: many classes share prefix and size
    rng = random.Random(4)
    head = [f"a{i}" for i in range(30)]
    rows = [(i, " ".join(head + [rng.choice("xyz") for _ in range(3)])) for i in range(80)]
    monkeypatch.setattr(jj, "_ordered_prefix", lambda s, w, length: np.sort(s)[:length])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_components(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80, 100).collect()}
    assert got == similar(rows, 1, 80, 100)


def test_repeats_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c d", None), (1, "a b c d", None), (None, "a b c d", None), (None, "q r s t", None), (2, None, None)], "doc_id long, text string, lang string")
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in similar_components(df, 3, 90, 100).collect())
    assert got == [(-1, -1), (-1, 1), (1, 1), (1, 1), (2, 2)]
    assert similar_components(df.limit(0)).collect() == []


def test_shingles_are_of_bytes_between_ascii_space():
    texts = [r[1] for r in AWKWARD] + ["A\x0bB\x0cC D\xa0E Éa", "ÀB c"]
    for n in (1, 3, 5):
        sets = shingle_sets(pa.array(texts), n)
        assert [len(s) for s in sets] == [len(shingles(t, n)) for t in texts]
        table: dict = {}
        for t, s in zip(texts, sets, strict=True):
            for x, h in zip([shingles(t, n)], [frozenset(s.tolist())], strict=True):
                assert table.setdefault(x, h) == h
    assert shingle_sets(pa.array(["Hello World a"]), 3)[0].tolist() == shingle_sets(pa.array(["hELLO\n world\ta "]), 3)[0].tolist()


def test_prefix_length():
    assert [prefix_length(n, 90, 100) for n in (1, 9, 10, 11, 20)] == [1, 1, 2, 2, 3]


def test_outlines_bound_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64)) for _ in "ab")
        b = np.unique(np.concatenate([b, a[: rng.integers(0, 400)]]))
        x, y = (np.frombuffer(outline(s), "<u4") for s in (a, b))
        assert len(x) == CELLS and x.sum() == len(a) and np.minimum(x, y).sum() >= len(np.intersect1d(a, b))


def test_built_words_do_not_collide(spark):
    """Thue-Morse words and their complements are equal under any polynomial hash modulo 2**64."""
    rows = []
    for k in range(6, 14):
        word = "a"
        for _ in range(k):
            word += word.translate(str.maketrans("ab", "ba"))
        rows += [(2 * k, f"one two {word}"), (2 * k + 1, f"one two {word.translate(str.maketrans('ab', 'ba'))}")]
    got = {r["doc_id"]: r["component_id"] for r in similar_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100).collect()}
    assert got == {i: i for i, _ in rows}


def test_near_texts_without_or_under_one_id(spark):
    rng = random.Random(6)
    base, other = ([f"{x}{i}" for i in rng.sample(range(900), 60)] for x in "pq")
    near = lambda w, k: " ".join([*w[:k], "new", *w[k + 1 :]])
    rows = [(None, near(base, 1)), (None, near(base, 58)), (4, near(base, 0)), (9, near(other, 1)), (9, near(base, 57)), (12, near(other, 59)), (3, "alone it is"), (None, "alone, too, here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in similar_components(df, 2, 80, 100).collect()]
    # rows are nodes of their own; those of one doc_id and those with one text are named by their smallest id
    named = similar([(k, t) for k, (_, t) in enumerate(rows)], 2, 80, 100)
    least = {}
    for k, (d, _) in enumerate(rows):
        least.setdefault(named[k][1], []).append(d)
    want = [(d, named[k][0], min((x for x in least[named[k][1]] if x is not None), default=None)) for k, (d, _) in enumerate(rows)]
    assert sorted(out, key=str) == sorted(want, key=str)


def test_long_open_lists_are_compared_whole(spark, monkeypatch):
    import evalspark.llm.jaccard_join as jj

    # one shingle leads all prefixes, and the classes that it brings together are similar in pairs only
    monkeypatch.setattr(jj, "OPEN", 8)
    monkeypatch.setattr(jj, "_ordered_prefix", lambda s, w, length: np.sort(s)[:length])
    rows = [(i, "lead " + " ".join(f"w{i // 2}x{k}" for k in range(12)) + (" end" if i % 2 else "")) for i in range(90)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_components(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80, 100).collect()}
    assert got == similar(rows, 1, 80, 100)


def test_group_posts_its_prefix_once(monkeypatch):
    import evalspark.llm.jaccard_join as jj

    # three classes of one prefix and size, one of another size
    head = [f"a{i}" for i in range(30)]
    common = shingle_sets(pa.array([" ".join(head)]), 1)[0]
    monkeypatch.setattr(jj, "_ordered_prefix", lambda s, w, length: np.intersect1d(s, common)[:length])

    class Heavy:
        value = (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    texts = pa.array([" ".join([*head, *more]) for more in ("x", "y", "z", "xy")])
    rows = [r for b in jj._postings(1, 80, 100, Heavy)([pa.RecordBatch.from_arrays([texts], ["text"])]) for r in b.to_pylist()]
    first, second, third, other = ([r for r in rows if r["key"] == key] for key in dict.fromkeys(r["key"] for r in rows))
    assert [len(first), len(second), len(third), len(other)] == [prefix_length(31, 80, 100), 1, 1, prefix_length(32, 80, 100)]
    assert len({r["group"] for r in first + second + third}) == 1 and other[0]["group"] != first[0]["group"]
    assert second[0]["shingle"] == third[0]["shingle"] == first[0]["shingle"] and second[0]["place"] == 0

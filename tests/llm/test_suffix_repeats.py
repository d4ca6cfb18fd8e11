import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from evalspark.llm.suffix_repeats import ANCHOR, _bounded, maximal_repeats, merged_spans, owned_windows, remove_repeats
from helpers import AWKWARD, DOC, without_repeats


def corpus(seed, n=120):
    """Texts over a small alphabet with copies, shared passages, edits and periodic parts."""
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choices("abcdeé ", k=k))
    passages, rows = [text(rng.randint(20, 90)) for _ in range(8)], []
    for i in range(n):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
            parts += [p[a:b] if rng.random() < 0.5 else p, text(rng.randint(0, 30))]
        if rng.random() < 0.1:
            parts.append(rng.choice("ab") * rng.randint(20, 150))
        if rng.random() < 0.1:
            parts.append(text(7) * rng.randint(3, 20))
        rows.append((i, rng.choice(rows)[1] if rows and rng.random() < 0.15 else "".join(parts)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("length", "gram", "seed"), [(24, 8, 1), (24, 8, 2), (30, 30, 3), (40, 12, 4)])
def test_equals_brute_force(spark, length, gram, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(df, length, gram).collect()}
    assert got == without_repeats(rows, length)


def test_awkward_rows(spark):
    rows = [*AWKWARD, (20, AWKWARD[4][1] * 3, "en", "a", 1), (None, "left out", None, None, None), AWKWARD[4]]
    df = spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS spans", "2 AS copy", "3 AS n_bytes")
    out = remove_repeats(df).collect()
    want = without_repeats([(r[0], r[1]) for r in rows[:-2]], 100) | without_repeats([(None, "left out")], 100)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out} == want
    assert len(out) == len(want) + 1 == len(rows)
    assert remove_repeats(df.limit(0)).collect() == []


def test_kept_text_is_of_whole_characters(spark):
    rows = [(1, "é" * 80 + "abc"), (2, "x" + "é" * 80 + "ü")]
    out = {r["doc_id"]: r["kept_text"] for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 21, 8, as_text=True).collect()}
    assert set(out[1]) <= set("éabc") and out[1].endswith("abc") and out[2].startswith("x") and out[2].endswith("ü")


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(0)
    texts = [rng.integers(97, 100, rng.integers(0, 300)).astype(np.uint8) for _ in range(60)]
    shared = rng.integers(97, 100, 50).astype(np.uint8)
    texts += [np.concatenate([t[:40], shared, t[40:]]) for t in texts[:20]]
    data, offsets = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    rows = owned_windows(data, offsets, 30, 10)
    seen: dict = {}
    total = 0
    for r in rows:
        for k in range(int(r["more"]) + 1):
            window = texts[r["doc"]][r["at"] + k : r["at"] + k + 30].tobytes()
            assert len(window) == 30
            assert seen.setdefault(window, (r["hash"], int(r["off"]) - k)) == (r["hash"], int(r["off"]) - k)
            total += 1
    assert total == sum(max(0, len(t) - 29) for t in texts)


def test_intervals_are_all_maximal_repeats():
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab", k=rng.randint(12, 25))) for _ in range(40)]
    length = 8
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]])
    rows = np.zeros(len(texts), ANCHOR)
    rows["more"] = [len(t) - length for t in texts]
    got = {}
    for size, row, delta in maximal_repeats(rows, data, starts, length):
        places = sorted(zip(row.tolist(), delta.tolist(), strict=True))
        assert len({texts[r][d : d + size] for r, d in places}) == 1
        got[texts[places[0][0]][places[0][1] : places[0][1] + size]] = places
    want = {}
    for s in {t[i:j] for t in texts for i in range(len(t)) for j in range(i + length, len(t) + 1)}:
        at = [(r, i) for r, t in enumerate(texts) for i in range(len(t) - len(s) + 1) if t.startswith(s, i)]
        before = {texts[r][i - 1] if i else (r, i) for r, i in at}
        after = {texts[r][i + len(s)] if i + len(s) < len(texts[r]) else (r, i) for r, i in at}
        if len(at) > 1 and len(before) > 1 and len(after) > 1:
            want[s] = at
    # a context's start counts as left-diverse, so only strings of one occurrence at a start may be more
    assert want.items() <= got.items()
    assert all(any(d == 0 for _, d in places) for s, places in got.items() if s not in want)


def test_long_texts_are_cut_in_overlapping_parts():
    parts = list(_bounded(np.array([0, 5, 400, 410]), 20, most=100))
    windows = set()
    for a, b, first, own, place in parts:
        assert b - a <= 100 and own[-1] == b - a
        if first == 1:
            windows |= {place + i for i in range(b - a - 19)}
    assert windows == set(range(395 - 19))


def test_merged_spans():
    starts, ends = merged_spans(np.array([5, 0, 8, 20, 3]), np.array([9, 2, 12, 30, 5]))
    assert starts.tolist() == [0, 3, 20] and ends.tolist() == [2, 12, 30]


def test_every_row_of_clashing_ids(spark):
    rng = random.Random(8)
    text = lambda: "".join(rng.choices("abcdefgh", k=150))
    shared = text()
    rows = [(5, shared + text()), (5, text() + shared), (None, shared), (None, shared), (7, text() + shared), (2, text()), (5, text())]
    rows += [rows[1], rows[5]]
    out = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    # documents in the order of id, then digest; rows without an id keep all
    documents = sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], hashlib.sha256(r[1].encode()).hexdigest()))
    by_number = without_repeats([(k, t) for k, (_, t) in enumerate(documents)], 100)
    by_row = {r: by_number[k] for k, r in enumerate(documents)}
    want = [(d, *(by_row[d, t] if d is not None else without_repeats([(0, t)], 100)[0])) for d, t in rows]
    assert sorted(out, key=str) == sorted([(w[0], w[1], w[2], w[4]) for w in want], key=str)


def test_anchor_with_many_contexts(monkeypatch):
    """One distance at a time gives what all suffixes at once give."""
    import evalspark.llm.suffix_repeats as sr

    rng = random.Random(4)
    length, gram, around = 30, 10, 20
    rows, contexts = np.zeros(400, ANCHOR), []
    for i in range(400):
        side = lambda: "".join(rng.choices("ab", weights=[9, 1], k=around))
        contexts.append(side() + "0123456789" + side())
        rows[i] = (77, rng.randint(0, 50), 1000 * i, around, around)
    table = pa.table({"rows": [rows.tobytes()], "contexts": ["".join(contexts).encode()]})

    def covered():
        out = sr._removed(length)(table)
        return {(d, p) for d, a, b in zip(*(c.to_pylist() for c in out.columns), strict=True) for p in range(a, b)}

    whole = covered()
    monkeypatch.setattr(sr, "RUN_ROWS", 50)
    assert covered() == whole and whole
    seen, want = set(), set()
    for _, d, at, text in sorted((0, int(r["doc"]), int(r["at"]), t) for r, t in zip(rows, contexts, strict=True)):
        for k in range(len(text) - length + 1):
            if text[k : k + length] in seen:
                want |= {(d, at + p) for p in range(k, k + length)}
            seen.add(text[k : k + length])
    assert whole == want


def test_colliding_hashes_do_not_fold(monkeypatch):
    import evalspark.llm.suffix_repeats as sr

    monkeypatch.setattr(sr, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    rows = np.zeros(3, ANCHOR)
    data = np.frombuffer(b"aaaabbbbaaaa", np.uint8)
    keys = sr._context_keys(rows, data, np.array([0, 4, 8]), np.array([4, 8, 12]))
    assert keys[0] == keys[2] != keys[1]


def test_span_hashes_in_parts(monkeypatch):
    from evalspark.llm import common

    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    starts = rng.integers(0, 3600, 3000)
    ends = starts + rng.choice([0, 1, 5, 30, 256, 257, 390], 3000)
    whole = common.span_hashes(data, starts, ends)
    monkeypatch.setattr(common, "CHUNK", 100)
    assert (common.span_hashes(data, starts, ends) == whole).all()
    seen: dict = {}
    for a, b, h in zip(starts.tolist(), ends.tolist(), whole.tolist(), strict=True):
        assert seen.setdefault(data[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)

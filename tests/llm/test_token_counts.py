import random

from evalspark.llm.token_counts import LONG, MARK, count_tokens, model, pretoken_counts
from helpers import AWKWARD, DOC


def best_count(word, m):
    """Plain Viterbi over one pre-token."""
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        raw = len(word[end - 1].encode())
        options = [(best[end - 1][0] + m.byte_score * raw, best[end - 1][1] - raw)]
        options += [(best[s][0] + m.pieces[word[s:end]], best[s][1] - 1) for s in range(end) if word[s:end] in m.pieces]
        best.append(max(options))
    return -best[-1][1]


def test_trie_equals_plain_viterbi():
    rng, m = random.Random(5), model()
    words = {MARK + "".join(rng.choices("abcdefgtheingron éß漢\n.", k=rng.randint(0, 20))) for _ in range(3000)}
    words |= {MARK + w for w in ("the", "therefore", "there", "internationalization", "x" * (LONG - 1), "y" * 200, "ab" * 90)}
    assert pretoken_counts(words, m) == {w: best_count(w, m) for w in words}


def test_small_word_parts_change_nothing(monkeypatch):
    import evalspark.llm.token_counts as tc

    m, words = model(), {MARK + "prefix" + "abc"[i % 3] * (i % 17) for i in range(60)}
    want = pretoken_counts(words, m)
    monkeypatch.setattr(tc, "WORDS", 7)
    assert pretoken_counts(words, m) == want


def test_on_a_table(spark):
    m = model()
    docs = spark.createDataFrame([*AWKWARD, (None, "no id", None, None, None), AWKWARD[4]], DOC).selectExpr("*", "1 AS n_tokens")
    got = [tuple(r) for r in count_tokens(docs, part_bytes=1000).collect()]
    want = []
    for row in [*AWKWARD, (None, "no id", None, None, None), AWKWARD[4]]:
        split = row[1].split(" ") if row[1] else []
        counts = {w: best_count(MARK + w, m) for w in set(split)}
        want.append((row[0], len(split), sum(counts[w] for w in split)))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert count_tokens(docs.limit(0)).collect() == []


def test_long_pretokens_share_prefixes(monkeypatch):
    import evalspark.llm.token_counts as tc

    m = model()
    words = sorted(MARK + "therefore" * 9 + w for w in ("", "s", "abc", "abd" * 40, "é漢"))
    assert m.in_order(words) == [best_count(w, m) for w in words]
    known: dict = {}
    monkeypatch.setattr(tc, "MEMO", 5)
    for some in (["a", "therefore", "x" * 90], ["there", "a", "theory", "in"], ["b", "a"]):
        assert tc.terminals(some, m, known).tolist() == [best_count(MARK + w, m) for w in some]
        assert len(known) <= 5

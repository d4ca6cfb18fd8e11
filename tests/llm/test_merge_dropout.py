import random

import numpy as np
import pyarrow as pa
import pytest

from evalspark.llm.merge_dropout import Encoder, decode, drawn, encode, gaps, model
from helpers import AWKWARD, DOC

TEXTS = ["", " ", "a", "Hello  world", "  lead", "trail  ", "Über ñandú ▁mark", "\x00\n\t", "日本語 text", "word " * 50, "\U0001f600▁"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_without_dropout_ids_are_the_librarys(library):
    rng = random.Random(3)
    coder = Encoder(0.0, 1)
    texts = [t for t in TEXTS if "▁" not in t] + [" ".join("".join(rng.choices("abcdeàñ.,!T\n", k=rng.randint(1, 14))) for _ in range(60)) for _ in range(60)]
    for text in texts:
        assert coder.encode(1, text).tolist() == library.encode(text), text


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_every_text_decodes_exactly(dropout):
    coder = Encoder(dropout, 7)
    for text in TEXTS + [r[1] or "" for r in AWKWARD]:
        assert coder.decode(coder.encode(5, text)) == text


def test_segmentations_vary_and_repeat_with_the_seed():
    text = " ".join(["segmentation"] * 400)
    split = lambda ids: {tuple(ids[i : i + 3]) for i in range(0, len(ids), 3)}
    one, two, other = Encoder(0.2, 1).encode(1, text), Encoder(0.2, 1).encode(1, text), Encoder(0.2, 2).encode(1, text)
    assert one.tolist() == two.tolist() and one.tolist() != other.tolist()
    assert len(split(one.tolist())) > 3
    plain = Encoder(0.0, 1).encode(1, text)
    assert len(one) > len(plain)


def test_full_dropout_leaves_characters():
    m = model()
    assert [m.raw[i] for i in Encoder(1.0, 1).encode(1, "abc d").tolist()] == [b" ", b"a", b"b", b"c", b" ", b"d"]


def test_memo_bounds_and_order_change_nothing(monkeypatch):
    import evalspark.llm.merge_dropout as md

    text = " ".join(f"w{i}" for i in range(500))
    want = Encoder(0.1, 11).encode(1, text).tolist()
    monkeypatch.setattr(md, "MEMO", 16)
    md._memos.clear()
    assert Encoder(0.1, 11).encode(1, text).tolist() == want


def test_on_a_table(spark):
    docs = spark.createDataFrame([*AWKWARD, (None, "no id", None, None, None)], DOC).selectExpr("*", "1 AS ids", "2 AS n_tokens")
    back = {r["doc_id"]: r for r in decode(encode(docs, 0.1, 3)).collect()}
    assert {d: r["text"] for d, r in back.items()} == {r[0]: r[1] or "" for r in AWKWARD} | {None: "no id"}
    assert all(r["n_tokens"] == len(r["ids"]) for r in back.values())
    once = {r["doc_id"]: r.asDict() for r in encode(docs, 0.1, 3, decoded=True).collect()}
    assert once == {d: r.asDict() for d, r in back.items()}
    assert decode(encode(docs.limit(0))).collect() == []


def test_agendas_in_step_equal_those_one_by_one():
    rng = random.Random(8)
    words = {"".join(rng.choices("abcdefghinorstéß\n.", k=rng.randint(1, 38))) for _ in range(2000)} | {"漢字", "a漢", "\x7f"}
    for dropout in (0.0, 0.15, 0.6):
        coder = Encoder(dropout, 21)
        for lane in range(coder.lanes):
            many = coder._many(sorted(words), lane)
            assert all(many[w] == coder._one(w, lane) for w in words)


def test_heap_and_list_agendas_agree():
    m = model()
    for dropout in (0, 1 << 30):
        for word in ("▁internationalization", "▁▁the", "▁" + "banana" * 6, "a▁b▁c"):
            marks = len(word) - len(word.lstrip("▁"))
            assert m.segment(word, marks, 12345, dropout) == m._segment_long(word, marks, 12345, dropout)


def test_every_occurrence_draws_its_own_skips():
    coder = Encoder(0.1, 5)
    for word in ("segmentation", "the", "a▁b▁c", "internationalization" * 3):
        n, plain = 4000, Encoder(0.0, 5).encode(1, word).tolist()
        lone = [tuple(coder.encode(d, word).tolist()) for d in range(n)]
        taken = coder._one(word)[1]
        as_plain = sum(x == tuple(plain) for x in lone)
        # no skip, or skips that end in the same ids
        assert as_plain >= n * (0.9**taken - 0.03), word
        assert len(set(lone)) > (1 if taken == 1 else 5), (word, len(set(lone)))


def test_segmentations_of_a_frequent_word_are_not_bounded():
    coder = Encoder(0.1, 5)
    ids = coder.encode(1, " ".join(["segmentation"] * 20_000))
    whole = b"".join(coder.model.raw[i] for i in ids.tolist())
    assert whole[1:].decode() == " ".join(["segmentation"] * 20_000)
    cuts = [i for i, x in enumerate(ids.tolist()) if coder.model.raw[x].startswith(b" ")] + [len(ids)]
    assert len({tuple(ids[a:b].tolist()) for a, b in zip(cuts, cuts[1:], strict=False)}) > 20


def test_words_of_one_merge_are_skipped_by_chance():
    # LANES segmentations left about two thirds of such words without any variation
    coder, words = Encoder(0.1, 9), []
    for piece, i in coder.model.ids.items():
        if len(piece) == 2 and piece[0] == "▁" and piece[1].isalpha() and coder._one(piece[1])[1] == 1:
            words.append((piece[1], i))
    assert len(words) > 20
    for word, i in words[:20]:
        ids = coder.encode(3, " ".join([word] * 3000)).tolist()
        assert 0.07 < 1 - ids.count(i) / 3000 < 0.13, word


def test_memos_give_what_occurrences_give_by_themselves():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghinorstéß漢.", k=rng.randint(1, 50))) for _ in range(300)] + ["the", "segmentation", "a▁b"]
    for dropout in (0.001, 0.1, 0.6, 1.0):
        coder = Encoder(dropout, 13)
        units = rng.choices(words, k=3000)
        keys = np.array([rng.getrandbits(64) for _ in units], np.uint64)
        want = [coder._one(u, int(k))[0] for u, k in zip(units, keys, strict=True)]
        for _ in range(2):
            ids, counts = coder.encode_units(pa.array(units), keys)
            assert [x.tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_draws_are_independent_trials():
    keys = np.arange(200_000, dtype=np.uint64) * np.uint64(977)
    waits = drawn(keys, np.uint64(0), int(0.1 * 2**32))
    for k in range(8):
        assert abs((waits == k).mean() - 0.1 * 0.9**k) < 0.003
    assert max(next(gaps(int(k), 1 << 20, 1 << 20)) for k in keys[:200]) > 4096  # draws that are full go on


def test_ids_of_any_type_draw_their_own_skips(spark):
    text = " ".join(["segmentation"] * 300)
    for kind in ("string", "double", "date", "decimal(20,2)", "int"):
        docs = spark.range(1, 4).selectExpr(f"CAST({'date_from_unix_date(CAST(id AS INT))' if kind == 'date' else 'id'} AS {kind}) AS doc_id", f"'{text}' AS text")
        out = decode(encode(docs, 0.2, 3)).collect()
        assert len({tuple(r["ids"]) for r in out}) == 3 and {r["text"] for r in out} == {text}
        assert sorted(r["ids"] for r in encode(docs, 0.2, 3).collect()) == sorted(r["ids"] for r in out)

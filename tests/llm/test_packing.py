import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from evalspark.llm.packing import SumOfSquares, encoder, pack, padding
from helpers import AWKWARD, DOC


def checked(pieces, docs, size):
    """Each id in one piece, sequences gapless and not too long; returns fills."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for doc, start, ids, total, window, offset in pieces:
        assert len(ids) and total == len(docs[doc])
        by_doc[doc].append((start, ids))
        by_seq[window].append((offset, len(ids)))
    for doc, ids in docs.items():
        assert np.concatenate([x for _, x in sorted(by_doc[doc], key=lambda x: x[0])]).tolist() == ids.tolist()
        at = 0
        for start, x in sorted(by_doc[doc], key=lambda x: x[0]):
            assert start == at
            at += len(x)
    fills = []
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= size
        fills.append(at)
    return fills


@pytest.mark.parametrize("size", [8, 64, 100])
def test_packer_on_random_documents(size):
    rng = random.Random(size)
    docs = {i: np.arange(rng.choice([1, 2, 3, rng.randint(1, 3 * size)]), dtype="<u4") for i in range(400)}
    packer, found = SumOfSquares(size), []
    for i, ids in docs.items():
        found += packer.add(i, ids)
    found += packer.finish()
    fills = checked(found, docs, size)
    assert sum(f not in (size, *(1 << k for k in range(12))) for f in fills) == 0


def test_level_minimises_the_sum_of_squares():
    rng, packer, size = random.Random(1), SumOfSquares(20), 20
    for step in range(300):
        n = rng.randint(1, size - 1)
        squares = {}
        for level in [0, *(h for h in range(1, size - n + 1) if packer.counts[h])]:
            c = packer.counts.copy()
            c[level] -= bool(level)
            c[level + n] += level + n < size
            squares[level] = int((c[1:size] ** 2).sum())
        assert squares[packer._level(n)] == min(squares.values())
        list(packer.add(step, np.zeros(n, "<u4")))


def test_ids_are_those_of_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r[1] or "" for r in AWKWARD] + ["<|endoftext|> a", "Ünï  \r\n  x  ", "don't WE'LL 12 345,678!!!", "mid <|endoftext|> dle", "end<|endoftext|>"]
    assert [encoder().encode(x, allowed_special="all") for x in texts] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_on_a_table(spark):
    rows = [*AWKWARD, (None, "no id", None, None, None)]
    docs = spark.createDataFrame(rows, DOC).repartition(3).selectExpr("*", "1 AS start", "2 AS ids")
    pieces = pack(docs, with_ids=True).collect()
    ids = {r[0]: np.array([*encoder().encode_ordinary(r[1] or ""), 1], "<u4") for r in rows}
    found = [(p["doc_id"], p["start"], np.array(p["ids"], "<u4"), p["doc_tokens"], p["sequence_id"], p["offset"]) for p in pieces]
    checked(found, ids, 2048)
    assert all(p["length"] == len(p["ids"]) and p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) for p in pieces)
    assert padding(pack(docs)).first()["padded_tokens"] == 0
    assert pack(docs.limit(0)).collect() == []


def test_added_tokens_are_those_of_an_unmodified_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r[1] or "" for r in AWKWARD] + ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n<|endoftext|", "ü  <|endoftext|>  \r\n don't <|ENDOFTEXT|>"]
    want = [[*e.ids, 1] for e in t.encode_batch(texts, add_special_tokens=False)]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string")
    found = defaultdict(list)
    for p in sorted(pack(docs, with_ids=True).collect(), key=lambda p: p["start"]):
        assert p["doc_tokens"] == len(want[p["doc_id"]])
        found[p["doc_id"]] += p["ids"]
    assert [found[i] for i in range(len(texts))] == want and want[len(AWKWARD)] == [64, 220, 50256, 275, 1]

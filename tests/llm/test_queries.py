"""The registered queries that SQL can't express, as they are registered, over whole tables against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import __spark_entry__
import duckdb
import numpy as np
import pytest
from evalspark.llm import quality
from evalspark.llm.merge_dropout import Encoder, drawn, id_number, mix_int
from evalspark.llm.queries import DROPOUT, DROPOUT_SEED, N_SHARDS
from evalspark.llm.token_counts import MARK, model
from helpers import similar, without_repeats
from test_packing import checked
from test_sharding import lpt
from test_token_counts import best_count

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def rows(spark, name):
    found = __spark_entry__.queries()[name](spark, SF).collect()
    assert name not in __spark_entry__.oracle_sql()
    return found


def test_op1_merge_dropout(spark, docs):
    """Each word by itself, from the draws of its own key, by the plain agenda."""
    coder, mask, segmented = Encoder(DROPOUT, DROPOUT_SEED), (1 << 64) - 1, {}
    found = rows(spark, "op1_merge_dropout")
    assert sorted(r["doc_id"] for r in found) == sorted(docs)
    for r in found:
        text, ids = docs[r["doc_id"]] or "", np.array(r["ids"], "<u4")
        assert b"".join(coder.model.raw[i] for i in r["ids"])[1:].decode() == text
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
        assert (r["decoded_bytes"], r["decoded_sha256"]) == (len(text.encode()), hashlib.sha256(text.encode()).hexdigest())
        if len(text) > 20_000:
            continue
        seed = mix_int((DROPOUT_SEED << 1 ^ id_number(r["doc_id"]) * 0x9E3779B97F4A7C15) & mask)
        want = []
        for place, unit in enumerate(coder._units(text)):
            key = mix_int((place * 0x94D049BB133111EB + seed) & mask)
            # without a draw in reach the plain segmentation, which is kept for speed
            if unit not in segmented:
                segmented[unit] = coder._one(unit)
            ids, taken = segmented[unit]
            if int(drawn(np.array([key], np.uint64), np.uint64(0), coder.threshold)[0]) < taken:
                ids = coder._one(unit, key)[0]
            want += np.frombuffer(ids, np.uint16).tolist()
        assert r["ids"] == want, r["doc_id"]


def test_op2_quality(spark, docs):
    """Accuracy on the labels, and each row's decision by its own score; the fit itself is compared in test_quality."""
    found = {r["doc_id"]: r for r in rows(spark, "op2_quality")}
    assert sorted(found) == sorted(docs)
    assert all(0 <= r["quality"] <= 1 and r["accepted"] == (r["quality"] >= quality.ACCEPT) for r in found.values())
    gold = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    assert np.mean([found[d]["accepted"] == bool(q) for d, q in gold.items() if d in found]) > 0.95


def test_op3_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder, order = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), sorted(docs)
    ids = {d: np.array([*e.ids, 1], "<u4") for d, e in zip(order, coder.encode_batch([docs[d] or "" for d in order], add_special_tokens=False), strict=True)}
    found = rows(spark, "op3_packing")
    assert all(r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) for r in found)
    fills = checked([(r["doc_id"], r["start"], ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], r["doc_tokens"], r["sequence_id"], r["offset"]) for r in found], ids, 2048)
    assert all(f == 2048 or f & (f - 1) == 0 for f in fills)


def test_op5_token_counts(spark, docs):
    m, known = model(), {}
    want = {}
    for d, text in docs.items():
        split = text.split(" ") if text else []
        known |= {w: best_count(MARK + w, m) for w in {*split} - known.keys()}
        want[d] = (len(split), sum(known[w] for w in split))
    assert {r["doc_id"]: tuple(r)[1:] for r in rows(spark, "op5_token_counts")} == want


def test_op6_suffix_repeats(spark, docs):
    found = rows(spark, "op6_suffix_repeats")
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found} == without_repeats(docs.items(), 100)


def test_op7_sharding(spark, docs):
    raw = {d: (t or "").encode() for d, t in docs.items()}
    found = rows(spark, "op7_sharding")
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in found} == {d: (len(t) + 1, zlib.crc32(t)) for d, t in raw.items()}
    shards, slots, loads, groups = defaultdict(set), defaultdict(list), Counter(), Counter()
    for r in found:
        shards[raw[r["doc_id"]]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
        groups[raw[r["doc_id"]]] += r["size"]
    assert all(len(s) == 1 for s in shards.values()) and all(sorted(s) == [*range(len(s))] for s in slots.values())
    want = Counter()
    for (size, shard), n in lpt(groups.values(), N_SHARDS).items():
        want[shard] += size * n
    assert loads == want and {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}


def test_pipeline(spark, docs):
    """The last stage's pieces are those of the documents that brute force keeps after the classifier."""
    import public_tokenizers
    from tokenizers import Tokenizer

    scored = {r["doc_id"]: r["accepted"] for r in __spark_entry__.queries()["op2_quality"](spark, SF).collect()}
    kept = {d: t for d, t in docs.items() if scored[d]}
    root = similar(kept.items(), 5, 80, 100)
    kept = {d: t for d, t in kept.items() if root[d][1] == d}
    cut = whole_characters(kept)
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {d: [*coder.encode(t, add_special_tokens=False).ids, 1] for d, t in cut.items()}
    found = rows(spark, "pipeline")
    assert {r["doc_id"]: r["doc_tokens"] for r in found} == {d: len(x) for d, x in tokens.items()}
    assert all(r["ids_crc32"] == zlib.crc32(np.array(tokens[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes()) for r in found)
    assert sum(r["length"] for r in found) == sum(map(len, tokens.values()))


def whole_characters(texts):
    """Texts without the characters all bytes of which repeat an earlier string of 100 bytes."""
    seen, out = set(), {}
    for d in sorted(texts):
        raw = (texts[d] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            window = raw[p : p + 100]
            if window in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(window)
        at, text = 0, []
        for c in texts[d] or "":
            n = len(c.encode())
            if not all(gone[at : at + n]):
                text.append(c)
            at += n
        out[d] = "".join(text)
    return out

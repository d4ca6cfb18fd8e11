import heapq
import random
import zlib
from collections import Counter, defaultdict

import pytest
from evalspark.llm import queries
from evalspark.llm.sharding import deal, shard_by_groups
from helpers import AWKWARD, DOC
from pyspark.sql import functions as F


def lpt(sizes, n_shards):
    """Plain longest processing time: the groups' shards, one after the other."""
    heap, out = [(0, k) for k in range(n_shards)], Counter()
    for size in sorted(sizes, reverse=True):
        load, shard = heapq.heappop(heap)
        out[size, shard] += 1
        heapq.heappush(heap, (load + size, shard))
    return out


@pytest.mark.parametrize("n_shards", [1, 2, 3, 16])
def test_runs_are_dealt_as_a_heap_deals_groups(n_shards):
    rng = random.Random(n_shards)
    for _ in range(120):
        sizes = [s for s in rng.choices([0, 1, 2, 3, 7, 20, 21, 500, 9999], k=rng.randint(0, 9)) for _ in range(rng.choice([1, 2, 5, rng.randint(1, 90)]))]
        got = deal(sorted(Counter(sizes).items(), reverse=True), n_shards)
        assert {(s, k): n for s, k, n in got} == lpt(sizes, n_shards)


def test_groups_stay_together_and_shards_are_even(spark):
    rng = random.Random(2)
    rows = [(i, None if i % 50 == 0 else f"g{rng.randint(0, 3000)}", rng.randint(1, 2000)) for i in range(8000)]
    rows += [(10_000 + i, "hot", 3) for i in range(4000)] + [(5, "g1", 1)]
    out = shard_by_groups(spark.createDataFrame(rows, "doc_id long, key string, size long").withColumn("part", F.lit(1)), "key", "size", 16).collect()
    assert len(out) == len(rows)
    shards, loads, slots = defaultdict(set), defaultdict(int), defaultdict(list)
    for r in out:
        shards[r["key"]].add(r["shard"])
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in shards.values())
    assert sorted(loads) == list(range(16))
    assert max(loads.values()) - min(loads.values()) <= 0.01 * max(loads.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = defaultdict(int)
    for r in out:
        groups[r["key"], r["shard"]] += r["size"]
    plain = lpt([sum(n for (k, _), n in groups.items() if k == key) for key in shards], 16)
    assert Counter((n, shard) for (_, shard), n in groups.items()) == plain


def test_empty_and_tiny(spark):
    kind = "doc_id long, key string, size long"
    assert shard_by_groups(spark.createDataFrame([], kind), "key", "size", 16).collect() == []
    out = shard_by_groups(spark.createDataFrame([(None, None, 1), (1, "b1", 5), (2, "=null", 5)], kind), "key", "size", 2).collect()
    assert len(out) == 3 and len({(r["shard"], r["slot"]) for r in out}) == 3
    names = ["_key", "_size", "_part", "_at", "_order", "shard", "slot", "_from"]
    wide = spark.createDataFrame([(i, f"g{i % 4}", 7) for i in range(40)], kind).selectExpr("*", *[f"'x' AS {c}" for c in names])
    out = shard_by_groups(wide, "key", "size", 3).collect()
    assert len(out) == 40 and sorted(out[0].asDict()) == sorted(["doc_id", "key", "size", *names])
    assert all(r["_key"] == r["_part"] == "x" and r["shard"] in (0, 1, 2) for r in out)


def test_query_on_awkward_rows(spark, tmp_path):
    rows = [*AWKWARD, (None, "no id", None, None, None), (30, None, None, None, None), AWKWARD[4]]
    spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op7_sharding(spark, str(tmp_path)).collect()
    raw = lambda t: (t or "").encode()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter((r[0], len(raw(r[1])) + 1, zlib.crc32(raw(r[1]))) for r in rows)
    by_text = defaultdict(set)
    for r in out:
        by_text[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values()) and {r["law"] for r in out} == {"bytes"} and {r["grown_shard"] for r in out} == {None}
    sizes = Counter()
    for r in rows:
        sizes[raw(r[1])] += len(raw(r[1])) + 1
    loads = Counter()
    for (size, shard), n in lpt(list(sizes.values()), 16).items():
        loads[shard] += size * n
    got = Counter()
    for r in out:
        got[r["shard"]] += r["size"]
    assert got == loads

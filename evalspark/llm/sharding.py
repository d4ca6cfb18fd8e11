"""Longest-processing-time scheduling of groups that must stay together.

Groups sorted by falling size go one after the other to the least-loaded shard,
found by a heap. Groups of equal size are interchangeable, so the schedule is a
list of runs (size, number of groups), which is all that the driver sees: a run
deals its groups as the heap would, but in one step where the heap would only
go round. A run's groups take its shards in the order of their rank by key.
Distinct sizes of positive whole numbers that sum to a total T are at most
sqrt(2 * T), 1.4 million for 1 TB, which bounds the schedule.

Defined cases: rows with a null key are one group; a key's rows all go to one
shard however many they are; sizes are whole numbers from 0 on, a null size is
0; an empty table gives an empty result; repeated ids get a slot each, and rows
with a null id have slots too; further columns pass as they are, but those
named shard and slot are replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evalspark.llm.common import written

#: Slots and ranks are counted in so many parts of a shard or size, each sorted by a task of its own.
PARTS = 256


def deal(runs: Iterable[tuple[int, int]], n_shards: int) -> Iterator[tuple[int, int, int]]:
    """Runs (size, groups) by falling size to (size, shard, groups): each group to the least-loaded shard (ties: the smaller number)."""
    heap = [(0, k) for k in range(n_shards)]
    for size, groups in runs:
        dealt = [0] * n_shards
        while groups:
            low = heap[0][0]
            most = max(load for load, _ in heap)
            if groups >= n_shards and most - low < size:
                # no shard is ahead by a group: the heap goes round from here
                rounds = groups // n_shards
                heap = [(load + rounds * size, k) for load, k in heap]
                dealt = [n + rounds for n in dealt]
                groups -= rounds * n_shards
                if not groups:
                    break
            if not size:  # nothing changes the order: all go to the first
                dealt[heap[0][1]] += groups
                break
            load, shard = heap[0]
            # as long as it is behind the second, it takes one group after the other
            second = min(heap[1:3], default=None)
            n = 1 if second is None else max(1, -(-(second[0] - load) // size))
            n = min(n if second is not None else groups, groups)
            heapq.heapreplace(heap, (load + n * size, shard))
            dealt[shard] += n
            groups -= n
        yield from ((size, k, n) for k, n in enumerate(dealt) if n)


def shard_by_groups(rows: DataFrame, key: str, size: str, n_shards: int, order: str = "doc_id") -> DataFrame:
    """Adds shard int and slot long to rows; rows of one ``key`` share a shard."""
    spark = rows.sparkSession
    own = [F.col(f"`{c}`") for c in rows.columns if c not in ("shard", "slot")]
    # '=' can't start a key made by the prefix, so no key equals the null group's
    keyed = rows.select(F.struct(*own).alias("_row"), F.coalesce(F.concat(F.lit("k"), F.col(f"`{key}`").cast("string")), F.lit("=null")).alias("_key"), F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)).alias("_size"))
    groups = written(keyed.groupBy("_key").agg(F.sum("_size").alias("_size")), "groups")
    # at most sqrt(2 * total) rows
    runs = groups.groupBy("_size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("_size")).toArrow()
    placed = [*deal(zip(runs["_size"].to_pylist(), runs["n"].to_pylist(), strict=True), n_shards)]
    sizes, shards, counts = (np.array(x, np.int64) for x in zip(*placed, strict=True)) if placed else (np.zeros(0, np.int64),) * 3
    # ranks from which and up to which a size's groups go to a shard
    ends = np.cumsum(counts)
    starts = ends - counts
    first = np.concatenate([[True], sizes[1:] != sizes[:-1]])[: len(sizes)]
    base = np.maximum.accumulate(np.where(first, starts, 0))
    ranges = spark.createDataFrame(pa.table({"_size": sizes, "_from": starts - base, "_to": ends - base, "shard": shards.astype(np.int32)}))
    ranked = numbered(groups, "_size", "_key", "_at").join(ranges, "_size").where("_from <= _at AND _at < _to").select("_key", "shard")
    dealt = keyed.join(ranked, "_key").select("_row", "shard", F.col(f"_row.`{order}`").alias("_order"))
    return numbered(dealt, "shard", "_order", "slot").select("_row.*", "shard", "slot")


def numbered(rows: DataFrame, group: str, order: str, into: str) -> DataFrame:
    """Adds a gapless number from 0 in each group.

    A group's rows are counted in PARTS parts by hash, so no task sorts a whole
    group; the parts' first numbers come from their counts (PARTS rows a group).
    """
    parted = rows.withColumn("_part", F.pmod(F.xxhash64(order), F.lit(PARTS)).cast("int"))
    counts = parted.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy(group, "_part").orderBy(order)
    return parted.withColumn("_rank", F.row_number().over(within)).join(firsts, [group, "_part"]).withColumn(into, F.col("_first") + F.col("_rank") - 1).drop("_part", "_rank", "_first")

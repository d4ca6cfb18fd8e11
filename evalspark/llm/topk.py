"""Exact top-k search by block-at-a-time pruning.

A vector's components are terms, and the integer inner product is the score.
The candidates of a cell are ordered by clusters, then vec_id, and cut into
blocks, which are ranges of BLOCK rows in this order: rows of like weights stand
together, so that a block's term maxima say something. Each block keeps, per
term, the largest and smallest weight in it. For a query the sum of its terms' best products bounds every score in the
block; blocks are scored in the order of falling bounds, through the block's
forward index, until the next bound falls below the query's k-th score.

Queries and candidates meet in a grid of cells: a cell holds about CELL
candidates and QUERIES queries at most, so memory is bounded at every size, and
the best k of each cell are merged by one aggregation. This is the stated query
set against all rows, in blocks.

Defined cases: null vectors, those with null or non-finite components, and rows
with a null vec_id take no part; only vectors of equal length are compared;
every row with the query's own vec_id is the query's own; repeated rows are
candidates each and one query; different vectors under one query id are
searched each, and the best k of all are kept; ties go to the smaller vec_id;
fewer than k candidates give all; empty tables give an empty result; further
columns are ignored, whatever their names. Scores are exact integers: products that float64 can't
hold exactly are computed with Python integers, and a score beyond a long
raises an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evalspark.llm.common import in_batches

SCALE = 256
BLOCK = 256
CELL, QUERIES = 8192, 2048
FOUND = "query_id long, vec_id long, score long"
#: Weights up to here, in up to 2**12 terms, have products and sums that float64 holds exactly.
EXACT = 1 << 20


def quantised(vectors: list) -> np.ndarray:
    """floor(SCALE * x) of equally long vectors, as float64 integers."""
    return np.floor(SCALE * np.stack([np.asarray(v, np.float64) for v in vectors]))


def _as_ints(rows: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in r] for r in rows], object).reshape(rows.shape)


def clusters(weights: np.ndarray, n: int, rounds: int = 3) -> np.ndarray:
    """The number of each row's cluster, by a few rounds of k-means from rows that stand evenly apart."""
    rows = np.asarray(weights, np.float64)
    centres = rows[np.linspace(0, len(rows) - 1, n).astype(int)]
    for turn in range(rounds + 1):
        own = ((centres**2).sum(axis=1)[None, :] - 2 * rows @ centres.T).argmin(axis=1)
        if turn < rounds:
            sums, sizes = np.zeros_like(centres), np.bincount(own, minlength=n)
            np.add.at(sums, own, rows)
            centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return own


class Blocks:
    """Candidates by cluster and vec_id, in blocks with the term maxima and minima of each.

    ``scored`` counts the query-candidate pairs whose score was computed.
    """

    def __init__(self, ids: np.ndarray, weights: np.ndarray, block: int = BLOCK) -> None:
        order = np.lexsort((ids, clusters(weights, -(-len(ids) // block)) if weights.shape[1] else np.zeros(len(ids))))
        self.ids, self.weights = ids[order], weights[order]
        self.starts = np.arange(0, len(ids), block)
        self.ends = np.minimum(self.starts + block, len(ids))
        self.most = np.maximum.reduceat(self.weights, self.starts, axis=0)
        self.least = np.minimum.reduceat(self.weights, self.starts, axis=0)
        self.scored = 0

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """(query, vec_ids, scores) of each query's best k, best first."""
        # summed term maxima: a positive term weight meets the block's largest, a negative one its smallest
        bounds = np.maximum(queries, 0) @ self.most.T + np.minimum(queries, 0) @ self.least.T
        for at, (query_id, query) in enumerate(zip(query_ids, queries, strict=True)):
            ids, scores = self.ids[:0], bounds[:0, 0]
            for b in np.argsort(-bounds[at], kind="stable"):
                # an equal bound may still bring a tie with a smaller vec_id
                if len(ids) == k and bounds[at, b] < scores[-1]:
                    break
                own = slice(self.starts[b], self.ends[b])
                others = self.ids[own] != query_id
                self.scored += int(others.sum())
                ids = np.concatenate([ids, self.ids[own][others]])
                scores = np.concatenate([scores, (self.weights[own] @ query)[others]])
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            yield query_id, ids, scores


def _cell(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            weights, queries = quantised(left["vector"].to_pylist()), quantised(right["vector"].to_pylist())
            ids, query_ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            if max(np.abs(weights).max(initial=0), np.abs(queries).max(initial=0)) >= EXACT or weights.shape[1] >= 1 << 12:
                weights, queries = _as_ints(weights), _as_ints(queries)
            for query_id, found, scores in Blocks(ids, weights).search(query_ids, queries, k):
                out["query_id"] += [int(query_id)] * len(found)
                out["vec_id"] += [int(x) for x in found]
                out["score"] += [int(x) for x in scores]
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    return search


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, vector array<double>) of the rows that take part."""
    out = vectors.select("vec_id", F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return out.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding") -> DataFrame:
    """Each query's k best rows: query_id, rank int from 1, vec_id, score."""
    rows = usable(in_batches(vectors), vector).withColumn("is_query", is_query)
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    across, down = -(-max(n, 1) // CELL), -(-max(n_queries, 1) // QUERIES)
    cells = lambda m, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id", "vector"), F.lit(m)).cast("int")
    length = F.size("vector").alias("n_terms")
    # each candidate goes to one column of cells and each query to one row of cells
    left = rows.select(length, cells(across, "candidate").alias("column"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("row"), "vec_id", "vector")
    right = rows.where("is_query").dropDuplicates(["vec_id", "vector"]).select(length, F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("column"), cells(down, "query").alias("row"), "vec_id", "vector")
    cell = ["n_terms", "column", "row"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_cell(k), FOUND)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation that makes sign codes balanced and close to the vectors is learned
on a bounded sample (FIT_ROWS rows); a vector length of which the sample has few
rows, or which is over WIDE, gets seeded random directions instead, rotated alike
where the sample has any. Each vector's code is cut into TABLES
chunks; two vectors meet in a table's bucket if their chunks are equal (and
their labels). Candidates are reranked by the cosine of the original vectors in
double precision, so no pair below the threshold is ever linked. A pair that
meets in several tables counts in the first one only, which both codes tell.

Equal vectors of a label are one class with a multiplicity. Buckets are cut
into sub-blocks of about BLOCK rows, and each pair of sub-blocks is a group of
its own, so a hot bucket is spread over many tasks and still compared whole.
A task returns counts for each vector and a spanning forest of its links, never
all pairs.

Recall: with 64 components at a cosine of exactly 0.98 a bit of the code
differs with probability acos(0.98) / pi = 0.064, so all TABLES = 6 chunks
differ in under 2 of 100 pairs; closer pairs are missed less. Measured recall
is in the README.

Defined cases: a null label, a null, empty or zero vector and one with null or
non-finite components links with nothing (n_links 0, its own component); only
vectors of equal length are compared; rows with a null vec_id keep null as
component; repeated vec_ids give a row each: equal rows under one vec_id count
as no link to themselves, and different vectors under one vec_id have links and
components of their own; columns beside the three are ignored, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.llm.common import cut, in_batches
from evalspark.llm.graph import components

THRESHOLD = 0.98
TABLES = 6
BLOCK = 1024
FIT_ROWS, FIT_ROUNDS = 4096, 30
BITS = 64
#: Principal directions are computed of vectors up to this length.
WIDE = 2048
#: A group's links are told as a tree in which a member has so many children.
CHILDREN = 16


def iterative_quantisation(sample: np.ndarray, bits: int = BITS, rounds: int = FIT_ROUNDS, seed: int = 0) -> np.ndarray:
    """A projection whose signs are the code: principal directions turned by the rotation that
    alternating minimisation of the quantisation error finds, which balances the bits.

    Vectors aren't centred, so that a bit differs for two vectors as often as
    their angle says, even where one group holds most of the sample. Short
    vectors get several rotations, one after the other, up to ``bits``.
    """
    n = sample.shape[1]
    if n > WIDE or len(sample) < 2 * n:
        kept = random_directions(n, bits, seed)
        if len(sample) < 2 * bits:
            return kept
    else:
        kept = np.linalg.svd(sample, full_matrices=True)[2][:bits].T
    view, parts = sample @ kept, []
    for k in range(-(-bits // kept.shape[1])):
        rotation, _ = np.linalg.qr(np.random.default_rng(seed + k).standard_normal((kept.shape[1],) * 2))
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(view.T @ np.where(view @ rotation >= 0, 1.0, -1.0))
            rotation = u @ vt
        parts.append(kept @ rotation)
    return np.hstack(parts)[:, :bits]


def random_directions(n: int, bits: int = BITS, seed: int = 0) -> np.ndarray:
    """Seeded directions, whose signs differ for two vectors with a probability in proportion to their angle."""
    return np.random.default_rng([seed, n]).standard_normal((n, bits))


def codes_of(vectors: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """The sign code of each vector as one uint64."""
    signs = vectors @ projection >= 0
    return (signs.astype(np.uint64) << np.arange(signs.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def chunk_masks(bits: int, tables: int = TABLES) -> list[int]:
    """Masks of consecutive chunks of a code, as even in length as can be."""
    ends = [bits * k // tables for k in range(tables + 1)]
    return [((1 << b) - (1 << a)) for a, b in zip(ends, ends[1:], strict=False) if b > a]


def _unit(table: pa.Table) -> np.ndarray:
    rows = table["vector"].combine_chunks()
    flat = (rows.flatten() if isinstance(rows, pa.Array) else pa.concat_arrays([c.flatten() for c in rows.chunks])).to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1).astype(np.float64)


def _coder(fits: dict[int, np.ndarray], seed: int):
    """Adds each class's code; fits has the models of the vector lengths that the sample has."""

    def coded(batches):
        for batch in batches:
            vectors, lengths = batch.column("vector").to_pylist(), np.array([len(v) for v in batch.column("vector").to_pylist()], int)
            codes = np.zeros(len(vectors), np.uint64)
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                projection = fits[n] if n in fits else random_directions(int(n), seed=seed)
                codes[at] = codes_of(_normed(np.array([vectors[i] for i in at], np.float64)), projection)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes.astype(np.int64))], [*batch.schema.names, "code"])

    return coded


def _normed(vectors: np.ndarray) -> np.ndarray:
    # divided by the largest component first, so that neither tiny nor huge vectors lose their norm
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _compare(masks: list[int], threshold: float):
    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        table, a, b = (x.as_py() for x in key[2:5])
        ids, codes = rows["id"].to_numpy(), rows["code"].to_numpy().astype(np.uint64)
        weights, block = rows["n"].to_numpy(), rows["block"].to_numpy()
        unit = _normed(_unit(rows))
        order = np.argsort(ids, kind="stable")
        ids, codes, weights, block, unit = ids[order], codes[order], weights[order], block[order], unit[order]
        counts = np.zeros(len(ids), np.int64)
        root = np.arange(len(ids))
        linked = np.zeros(len(ids), bool)

        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        for start in range(0, len(left), 512):
            some = left[start : start + 512]
            near = unit[some] @ unit[right].T >= threshold
            if a == b:
                near &= some[:, None] < right[None, :]
            i, j = np.nonzero(near)
            i, j = some[i], right[j]
            # the first table in which two codes meet counts the pair
            for mask in masks[:table]:
                if len(i):
                    apart = ((codes[i] ^ codes[j]) & np.uint64(mask)) != 0
                    i, j = i[apart], j[apart]
            np.add.at(counts, i, weights[j])
            np.add.at(counts, j, weights[i])
            linked[i] = linked[j] = True
            # the roots of linked pairs hook to the smaller one until no pair has two
            while len(i := i[apart := root[i] != root[j]]):
                j = j[apart]
                np.minimum.at(root, np.maximum(root[i], root[j]), np.minimum(root[i], root[j]))
                while (root[root] != root).any():
                    root = root[root]
        # each group as a tree of small degree, so that no vector has a share of all links
        members = np.flatnonzero(linked)
        members = members[np.argsort(root[members], kind="stable")]
        firsts = np.flatnonzero(np.diff(root[members], prepend=-1))
        place = np.arange(len(members)) - np.repeat(firsts, np.diff(np.append(firsts, len(members))))
        inner = np.flatnonzero(place)
        links = [*zip(members[inner - place[inner] + (place[inner] - 1) // CHILDREN].tolist(), members[inner].tolist(), strict=True)]
        at = np.flatnonzero(counts)
        return pa.table(
            {
                "id": pa.array([*ids[at], *(ids[x] for x, _ in links)], pa.int64()),
                "n": pa.array([*counts[at], *(0 for _ in links)], pa.int64()),
                "to": pa.array([*(None for _ in at), *(ids[y] for _, y in links)], pa.int64()),
            }
        )

    return compare


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, vector: str = "embedding", label: str = "label", seed: int = 0) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``threshold`` is a cosine over 0.5, so that equal vectors always link.
    """
    rows = vectors.select("vec_id", F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vector", lambda x: x != 0)
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    # equal vectors: one class under its smallest id; -0.0 and 0.0 are equal
    classes = usable.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0))).groupBy("label", "vector").agg(F.min("vec_id").alias("vec_id"), F.count_distinct("vec_id").alias("n"))
    # a class is told by a number of its own, as different vectors may share a vec_id; a checkpoint keeps the numbers
    classes = cut(classes.withColumn("id", F.monotonically_increasing_id()))
    # the fit sees a bounded sample, drawn by hash so that it is the same on every run
    sample = classes.select(F.size("vector").alias("n"), "vector", F.xxhash64(F.lit(seed), "vec_id").alias("h")).orderBy("h").limit(FIT_ROWS).collect()
    fits = {}
    for n in {r["n"] for r in sample}:
        fits[n] = iterative_quantisation(_normed(np.array([r["vector"] for r in sample if r["n"] == n], np.float64)), seed=seed)
    masks = chunk_masks(BITS, tables)
    coded = cut(in_batches(classes).mapInArrow(_coder(fits, seed), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema) + ", code long"))
    entries = coded.select(
        "label",
        F.size("vector").alias("n_terms"),
        F.posexplode(F.array(*[F.col("code").bitwiseAND(F.lit(m if m < 1 << 63 else m - (1 << 64))) for m in masks])).alias("table", "chunk"),
        "id",
        "n",
        "code",
        "vector",
    )
    bucket = ["label", "n_terms", "table", "chunk"]
    sizes = entries.groupBy(*bucket).agg(F.count(F.lit(1)).alias("m")).where("m > 1").withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    placed = entries.join(sizes, bucket).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # a row goes to every pair of sub-blocks that its own is part of
    pairs = placed.select(
        *bucket, "id", "n", "code", "vector", "block",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least(other, F.col("block")).alias("a"), F.greatest(other, F.col("block")).alias("b")))).alias("pair"),
    ).select("label", "n_terms", "table", F.col("pair.a").alias("a"), F.col("pair.b").alias("b"), "chunk", "id", "n", "code", "vector", "block")
    found = cut(pairs.groupBy("label", "n_terms", "table", "a", "b", "chunk").applyInArrow(_compare(masks, threshold), "id long, n long, to long"))
    counts = found.where("to IS NULL").groupBy("id").agg(F.sum("n").alias("others"))
    linked = components(found.where("to IS NOT NULL").select(F.col("id").alias("a"), F.col("to").alias("b"))).withColumnRenamed("component_id", "root")
    named = coded.select("id", "vec_id", "label", "vector", "n").join(linked, "id", "left")
    # a class has the smallest vec_id of its members, so the smallest of a component's classes is the smallest id reachable
    smallest = named.where("root IS NOT NULL").groupBy("root").agg(F.min("vec_id").alias("component_id"))
    summed = named.join(counts, "id", "left").join(smallest, "root", "left")
    # back to the members: a third of all rows may be one class, which the adaptive skew join splits
    by_class = summed.select(F.col("label").alias("_label"), F.col("vector").alias("_vector"), (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("_links"), F.coalesce("component_id", "vec_id").alias("_component"))
    members = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    joined = members.join(by_class, (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")), "left")
    out = joined.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("vec_id").isNotNull(), F.coalesce("_component", "vec_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))

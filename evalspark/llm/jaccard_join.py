"""Grouped prefix join: documents whose word-shingle sets have a Jaccard similarity over a threshold.

1. Documents with equal sets are one class (they link with each other). One
   pass over the texts gives each document's class and the shingles that occur
   more than once in a batch of a task; by these counts the HEAVY most frequent
   ones of the corpus are a list of fixed size, which is broadcast and orders
   shingles from rare to frequent.
2. A set of n shingles that is similar enough to another shares one of its
   first n - ceil(t * n) + 1 shingles in that order, its prefix. Classes with an
   identical prefix and size are one group, and only groups have postings.
3. Group pairs that share a prefix shingle are filtered by size and by the
   shingle's places, which bound the overlap; the pairs left are expanded to
   their classes. Counts of each set's shingles in CELLS cells bound the overlap
   again, and the pairs left are verified by intersecting the whole sets.

Only components are asked for, so a pair needs no verification once its ends are
known to be connected. First each posting list is compared with one pivot (the
member whose prefix has the shingle first) and each group with one of its
members, which is linear in any list's length; then the pairs of members that
are in different components still are compared all. No list, group or number of
partners is capped.

Comparisons are integer: DEN * intersection >= NUM * union. Sets are of 64-bit
shingle hashes, and classes of 64-bit hashes of sets with their sizes: exact but
for collisions of these hashes, of which no construction is known here.

Defined cases: a null text or one without words has no shingles and links with
nothing; repeated doc_ids are one node, their rows give a row each; a null
doc_id gives a row whose component is the smallest id that it links to, or null;
an empty table gives an empty result; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.llm.common import U64, bitmap, cut, dropped, in_batches, in_bitmap, maybe_in, mixed, slices, written
from evalspark.llm.graph import components
from evalspark.llm.shingles import set_key, shingle_sets

WORDS, NUM, DEN = 5, 80, 100
PART_BYTES = 1 << 20
#: About so many shingles of a task are held to count those that occur more than once.
COUNTED = 1 << 22
#: Posting lists that are compared whole are cut into blocks of about so many entries.
OPEN = 512
#: The size of the list of frequent shingles.
HEAVY = 1 << 18
#: A set's outline counts its shingles in so many cells by hash.
CELLS = 256


def outline(shingles: np.ndarray) -> bytes:
    """How many shingles of a set fall into each cell. Two sets share no more than the sum of the smaller counts."""
    return np.bincount((shingles >> U64(20)).astype(np.int64) % CELLS, minlength=CELLS).astype("<u4").tobytes()


def _survey(words: int):
    """Rows (kind 0) of doc_id, set size, class and outline; rows (kind 1) of a shingle and its documents among COUNTED shingles."""

    def counted(sets: dict[int, np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        flat = np.concatenate([*sets.values()])
        sets.clear()
        flat.sort()
        # the runs of equal shingles, without arrays of those that occur once
        same = np.zeros(len(flat) + 1, bool)
        same[1:-1] = flat[1:] == flat[:-1]
        starts = np.flatnonzero(~same[:-1] & same[1:])
        found, counts = flat[starts], np.flatnonzero(same[:-1] & ~same[1:]) - starts + 1
        m = len(found)
        return pa.RecordBatch.from_arrays([pa.array([1] * m, pa.int32()), pa.nulls(m, kind), pa.array(counts, pa.int64()), pa.array(found.view(np.int64), pa.int64()), pa.nulls(m, pa.binary())], ["kind", "doc_id", "n", "key", "outline"])

    def survey(batches):
        distinct: dict[int, np.ndarray] = {}
        held, kind = 0, None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for some in slices(batch, "text", PART_BYTES):
                sets = shingle_sets(some.column("text"), words)
                ids = some.column("doc_id").to_pylist()
                # a document without shingles is a class of its own
                keys = [set_key(s) if len(s) else int(mixed(np.array([hash(d)], np.int64).view(U64)).view(np.int64)[0]) for s, d in zip(sets, ids, strict=True)]
                # copies among these texts are counted once, as they are one class
                distinct |= zip(keys, sets, strict=True)
                held += sum(map(len, sets))
                yield pa.RecordBatch.from_arrays([pa.array([0] * len(ids), pa.int32()), some.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64()), pa.array([outline(s) for s in sets], pa.binary())], ["kind", "doc_id", "n", "key", "outline"])
                if held >= COUNTED:
                    yield counted(distinct, kind)
                    held = 0
        if distinct:
            yield counted(distinct, kind)

    return survey


def prefix_length(n: int, num: int, den: int) -> int:
    """How many shingles of a set of n are its prefix."""
    return n - -(-n * num // den) + 1


def _ordered_prefix(shingles: np.ndarray, weights: np.ndarray, length: int) -> np.ndarray:
    """The first shingles from rare to frequent (equal: by hash)."""
    light = shingles[weights == 0][:length]
    if len(light) == length:
        return light
    heavy = np.flatnonzero(weights)
    heavy = heavy[np.argsort(weights[heavy], kind="stable")][: length - len(light)]
    return np.concatenate([light, shingles[heavy]])


def _postings(words: int, num: int, den: int, heavy, shared=None):
    """Rows of (shingle, place, group, n, class): a task posts a group's whole prefix once, and each further class of it by the first shingle alone.

    ``shared`` is a bitmap of shingles: the others are left out.
    """

    def postings(batches):
        hashes, counts = heavy.value
        seen: set[tuple[int, int]] = set()
        posted: set[tuple[int, int]] = set()
        for batch in batches:
            for some in slices(batch, "text", PART_BYTES):
                sets = shingle_sets(some.column("text"), words)
                flat = np.concatenate(sets) if sets else np.zeros(0, U64)
                weights = np.zeros(len(flat), np.int64)
                if len(hashes) and len(flat):
                    at = np.minimum(np.searchsorted(hashes, flat), len(hashes) - 1)
                    weights = np.where(hashes[at] == flat, counts[at], 0)
                end, found = 0, []
                for s in sets:
                    start, end = end, end + len(s)
                    if not len(s) or (own := (set_key(s), len(s))) in seen:
                        continue
                    seen.add(own)
                    prefix = _ordered_prefix(s, weights[start:end], prefix_length(len(s), num, den))
                    # the group is told by the prefix, in order, and the size
                    group = int((mixed(prefix * np.arange(1, 2 * len(prefix), 2, dtype=U64)).sum(dtype=U64, keepdims=True) + U64(len(s))).view(np.int64)[0])
                    if (group, len(s)) in posted:
                        prefix = prefix[:1]
                    posted.add((group, len(s)))
                    found.append((prefix, group, *own))
                if not found:
                    continue
                lengths = [len(x[0]) for x in found]
                shingle = np.concatenate([x[0] for x in found])
                place = np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])
                rows = np.arange(len(shingle)) if shared is None else np.flatnonzero(in_bitmap(shared.value, shingle))
                of = np.repeat(np.arange(len(found)), lengths)[rows]
                column = lambda k: pa.array(np.array([x[k] for x in found], np.int64)[of], pa.int64())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array(shingle[rows].view(np.int64)), pa.array(place[rows]), column(1), column(3), column(2)], ["shingle", "place", "group", "n", "key"])

    return postings


def _sets(words: int, wanted):
    """Rows of (key, shingles) for the texts whose class may be wanted by a bitmap; a class's first row in a task only."""

    def sets(batches):
        seen: set[int] = set()
        for batch in batches:
            for some in slices(batch, "text", PART_BYTES):
                own = shingle_sets(some.column("text"), words)
                keys = np.array([set_key(s) for s in own], np.int64)
                at = [i for i in np.flatnonzero(in_bitmap(wanted.value, keys)).tolist() if len(own[i]) and not (keys[i] in seen or seen.add(keys[i]))]
                yield pa.RecordBatch.from_arrays([pa.array(keys[at], pa.int64()), pa.array([own[i].tobytes() for i in at], pa.binary())], ["key", "shingles"])

    return sets


def _may_overlap(num: int, den: int):
    """Keeps the pairs whose outlines allow enough common shingles."""

    def may(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, CELLS).astype(np.int64) for c in ("s1", "s2"))
            most, sizes = np.minimum(a, b).sum(axis=1), a.sum(axis=1) + b.sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2")], ["k1", "k2"]).filter(pa.array((den + num) * most >= num * sizes))

    return may


def _verified(num: int, den: int):
    def verified(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("s1"), batch.column("s2"), strict=True):
                a, b = np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)
                at = np.searchsorted(b, a)
                both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                keep.append(den * both >= num * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2")], ["k1", "k2"]).filter(pa.array(keep, pa.bool_()))

    return verified


def _may_link(num: int, den: int) -> str:
    """The size filter, and the place filter: what follows the first common shingle bounds the overlap."""
    overlap = f"(1 + least(n1 - place1 - 1, n2 - place2 - 1))"
    return f"n1 * {den} >= n2 * {num} AND n2 * {den} >= n1 * {num} AND ({den} + {num}) * {overlap} >= {num} * (n1 + n2)"


def similar_components(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, text) to doc_id, n_shingles long, component_id: the smallest doc_id reachable by links."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = in_batches(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    survey = written(texts.mapInArrow(_survey(words), f"kind int, doc_id {kind}, n long, key long, outline binary"), "survey")
    members = survey.where("kind = 0").select("doc_id", "n", "key")
    classes = members.groupBy("key", "n").agg(F.min("doc_id").alias("first"))

    # HEAVY rows at most, whatever the corpus: a list of fixed size is all that is broadcast
    frequent = survey.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(HEAVY).toArrow()
    hashes, counts = frequent["key"].to_numpy().view(U64), frequent["n"].to_numpy()
    by_hash = np.argsort(hashes)
    heavy = spark.sparkContext.broadcast((hashes[by_hash], counts[by_hash]))
    postings = lambda *bits: texts.mapInArrow(_postings(words, num, den, heavy, *bits), "shingle long, place int, group long, n long, key long")
    # copies in different tasks post the same class; lists of one class need no look
    shared = postings().groupBy("shingle").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high").select("shingle")
    shared = written(shared, "shared")
    listed = written(postings(spark.sparkContext.broadcast(bitmap(shared, "shingle"))).join(shared, "shingle").distinct(), "listed")

    groups = written(listed.select("group", "n", "key").distinct(), "groups")
    leaders = groups.groupBy("group", "n").agg(F.min("key").alias("leader"))
    # pivots and lists share one exchange, as both have the join's null filters; a group that several tasks posted is repeated here, which is linear
    lists = listed.select("shingle", "place", "group", "n").where(F.col("shingle").isNotNull() & F.col("group").isNotNull() & F.col("n").isNotNull()).repartition("shingle")
    pivots = lists.groupBy("shingle").agg(F.min(F.struct("place", "group", "n")).alias("p")).select("shingle", F.col("p.place").alias("place2"), F.col("p.group").alias("group2"), F.col("p.n").alias("n2"))
    named = lambda df, k: df.select(*[F.col(c).alias(f"{c}{k}") if c != "shingle" else F.col(c) for c in df.columns])

    # linear: each list against its pivot, each group against its leader
    stars = named(lists, 1).join(pivots, "shingle").where(f"group1 != group2 AND {_may_link(num, den)}").select("group1", "n1", "group2", "n2").distinct()
    of = lambda k: leaders.select(F.col("group").alias(f"group{k}"), F.col("n").alias(f"n{k}"), F.col("leader").alias(f"k{k}"))
    across = stars.join(of(1), ["group1", "n1"]).join(of(2), ["group2", "n2"]).select("k1", "k2")
    within = groups.join(leaders, ["group", "n"]).where("key != leader").select(F.col("key").alias("k1"), F.col("leader").alias("k2"))
    ordered = lambda df: df.select(F.least("k1", "k2").alias("k1"), F.greatest("k1", "k2").alias("k2")).where("k1 != k2").distinct()

    def sides(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
        """Pairs with both classes' values of a column, as s1 and s2."""
        side = lambda k: table.select(F.col("key").alias(f"k{k}"), F.col(column).alias(f"s{k}"))
        return pairs.join(side(1), "k1").join(side(2), "k2").select("k1", "k2", "s1", "s2")

    def keys_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("k1", "k2")).alias("key")).distinct()

    def verify(pairs: DataFrame) -> DataFrame:
        """The pairs whose whole sets are similar enough; sets are made of the texts of the pairs that outlines leave."""
        outlines = survey.where("kind = 0").select("key", "outline").join(keys_of(pairs), "key", "left_semi").dropDuplicates(["key"])
        left = written(sides(pairs, outlines, "outline").mapInArrow(_may_overlap(num, den), "k1 long, k2 long"), "left")
        # a class is told by its key, which is made again of the texts of its first doc_id, or of those without one
        wanted = cut(keys_of(left).join(classes, "key").select(F.col("first").alias("doc_id"), "key"))
        keys = spark.sparkContext.broadcast(bitmap(wanted, "key"))
        own = maybe_in(texts, "doc_id", wanted).join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
        if wanted.where("doc_id IS NULL").take(1):
            own = own.union(texts.where("doc_id IS NULL"))
        sets = written(own.mapInArrow(_sets(words, keys), "key long, shingles binary"), "sets")
        links = written(sides(left, sets.dropDuplicates(["key"]), "shingles").mapInArrow(_verified(num, den), "k1 long, k2 long"), "links")
        dropped(left, sets)
        return links

    tested = written(ordered(across.union(within)), "tested")
    links = verify(tested)
    found = cut(components(links.select(F.col("k1").alias("a"), F.col("k2").alias("b"))))

    # whole: the pairs in a list or group whose ends are still in different components
    label = lambda df: df.join(found.withColumnRenamed("id", "key"), "key", "left").withColumn("label", F.coalesce("component_id", "key")).drop("component_id")
    labelled = written(label(groups), "labelled")
    spread = labelled.groupBy("group", "n").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    entries = listed.select("shingle", "place", "group", "n").repartition("group", "n").distinct()
    # a group's label, where its classes have but one
    ranged = entries.join(spread.select("group", "n", "low", F.expr("low = high").alias("one")), ["group", "n"])
    open_lists = ranged.groupBy("shingle").agg(F.min("low").alias("least"), F.max("low").alias("most"), F.min("one").alias("ones"), F.ceil(F.count(F.lit(1)) / OPEN).cast("int").alias("blocks")).where("least != most OR NOT ones").select("shingle", "blocks")
    still = ranged.join(open_lists, "shingle").select("shingle", "blocks", "place", "group", "n", "low", "one")
    half = lambda df, k, *on: df.select(*on, *[F.col(c).alias(f"{c}{k}") for c in ("place", "group", "n", "low", "one")])
    # a short list's entries meet where the list is; those of a long one by pairs of blocks, so that it is spread over many tasks
    short = still.where("blocks = 1")
    cells = still.where("blocks > 1").withColumn("block", F.pmod(F.xxhash64("group", "n"), F.col("blocks")).cast("int"))
    met = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least(other, F.col("block")).alias("a"), F.greatest(other, F.col("block")).alias("b")))
    cells = cells.select("*", F.explode(met).alias("met")).select("*", "met.a", "met.b")
    side = lambda k, end: half(cells.where(f"block = {end}"), k, "shingle", "a", "b")
    differ = f"NOT (one1 AND one2 AND low1 = low2) AND {_may_link(num, den)}"
    near = half(short, 1, "shingle").join(half(short, 2, "shingle"), "shingle").where(f"group1 < group2 AND {differ}")
    far = side(1, "a").join(side(2, "b"), ["shingle", "a", "b"]).where(f"(a < b OR group1 < group2) AND {differ}")
    pairs = near.select("group1", "n1", "group2", "n2").union(far.select("group1", "n1", "group2", "n2")).distinct()
    inner = spread.where("low != high").select(F.col("group").alias("group1"), F.col("n").alias("n1"), F.col("group").alias("group2"), F.col("n").alias("n2"))
    expanded = lambda k: labelled.select(F.col("group").alias(f"group{k}"), F.col("n").alias(f"n{k}"), F.col("key").alias(f"k{k}"), F.col("label").alias(f"label{k}"))
    rest = pairs.union(inner).join(expanded(1), ["group1", "n1"]).join(expanded(2), ["group2", "n2"]).where("label1 != label2").select("k1", "k2")
    more = verify(written(ordered(rest).join(tested, ["k1", "k2"], "left_anti"), "rest"))
    # the components found are contracted, so only the new links between them are followed
    ends = lambda k: found.select(F.col("id").alias(f"k{k}"), F.col("component_id").alias(f"c{k}"))
    bridges = more.join(ends(1), "k1", "left").join(ends(2), "k2", "left").select(F.coalesce("c1", "k1").alias("a"), F.coalesce("c2", "k2").alias("b"))
    merged = components(bridges)

    joined = classes.join(found.withColumnRenamed("id", "key"), "key", "left").withColumn("c", F.coalesce("component_id", "key")).drop("component_id")
    joined = joined.join(merged.withColumnRenamed("id", "c"), "c", "left").withColumn("c", F.coalesce("component_id", "c")).drop("component_id")
    # a class is told by key and size; sets of no shingles have keys of their own and no links
    smallest = cut(joined.groupBy("c").agg(F.min("first").alias("component_id")).join(joined, "c").select("key", "n", "component_id"))
    dropped(shared, listed, groups, tested, labelled)
    # a class may hold a third of all rows: this join's keys are split by the adaptive skew join
    return members.join(smallest, ["key", "n"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")

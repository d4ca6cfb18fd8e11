"""Repeated byte strings by common-prefix intervals of an enhanced suffix array.

Every string of ``length`` bytes (a window) has one anchor: of the GRAM-byte
strings in it, the one with the smallest hash (leftmost of equal ones). Equal
windows have equal anchors at equal places, so an anchor's hash brings together
all occurrences of all windows that it owns, and only anchors that occur twice
need a look at the text around them, the context. Texts are therefore never
sorted whole: each bucket of anchors has an enhanced suffix array of its own.

In a bucket, equal contexts fold to one class with its first occurrence. The
suffixes that start at the classes' windows are sorted; their common-prefix
lengths are scanned with a stack, which yields the interval tree: an interval
is a string of ``length`` bytes or more and all its occurrences. An interval
whose occurrences are all preceded by the same byte extends to the left and is
left out (the longer string is an interval, too); what remains are the maximal
repeats, each with all its occurrences in contexts of these anchors. A byte is
removed if an occurrence other than the first of a maximal repeat covers it.

Copies of whole texts are one document for all this (their first doc_id), and
equal contexts are folded in each task before they are shuffled, so that a
passage with any number of occurrences sends one context from each task.

Equal hashes are never taken for equal bytes: contexts that fold are compared.
A bucket holds about BUCKET_BYTES of text. An anchor with very many different
contexts has its windows processed by their distance from the anchor, as equal
windows have equal ones; its contexts are still in one task, which takes about
0.7 kB for each of them.

Defined cases: a null text is the empty text; matches never cross documents and
overlap freely; every row gives a row. Rows that share doc_id and text are one
document; different texts under one doc_id are documents of their own, in the
order of their SHA-256; rows without a doc_id have no place in the order, so
they keep all and nothing is held against them; texts shorter than ``length``
keep all; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.llm.common import U64, cut, dropped, in_batches, irregular, mixed, release, shared_folder, slices, span_hashes, utf8_column, with_numbers, written

LENGTH = 100
GRAM = 32
#: Texts are read in parts of so many bytes; places in a part fit in 24 bits.
PART_BYTES = 1 << 19
_PLACE_BITS = 24
#: About so many contexts of whole anchors have their suffixes sorted at a time.
RUN_ROWS = 5000
#: Buckets hold about so many bytes of text, of which 0.7 or less become contexts.
BUCKET_BYTES = 32 << 20
#: Rows of an anchor as raw bytes; ``off`` is the anchor's distance from the first window it owns.
ANCHOR = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("at", "<u4"), ("off", "<u2"), ("more", "<u2")])


def owned_windows(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """ANCHOR rows of concatenated texts: runs of consecutive windows with one anchor.

    doc is the text's number, at the first window's place in its text, and more
    the number of further windows.
    """
    none = np.zeros(0, ANCHOR)
    n, within = len(data), length - gram + 1
    if n < length:
        return none
    hashes = span_hashes(data, np.arange(n - gram + 1), np.arange(gram, n + 1))
    low = U64((1 << _PLACE_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=U64)
    span = 1
    while 2 * span <= within:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < within:
        least = np.minimum(least[: len(least) - (within - span)], least[within - span :])
    owner = (least & low).astype(np.int64)
    # windows that would cross the end of a text have no owner
    valid = np.zeros(n + 1, np.int32)
    sizes = np.diff(offsets)
    fits = sizes >= length
    np.add.at(valid, offsets[:-1][fits], 1)
    np.add.at(valid, offsets[1:][fits] - length + 1, -1)
    owner[np.cumsum(valid)[: len(owner)] == 0] = -1
    starts = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1])
    ends = np.concatenate([starts[1:], [len(owner)]])
    held = owner[starts] >= 0
    starts, ends = starts[held], ends[held]
    out = np.zeros(len(starts), ANCHOR)
    anchors = owner[starts]
    out["hash"] = hashes[anchors]
    out["doc"] = np.searchsorted(offsets, starts, "right") - 1
    out["at"] = starts - offsets[out["doc"]]
    out["off"] = anchors - starts
    out["more"] = ends - starts - 1
    return out


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)


def _by_bucket(keys: np.ndarray, buckets: int):
    """(bucket, row numbers) for each bucket that has rows; rows stay in order."""
    bucket = (keys >> U64(32)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True):
        if b > a:
            yield int(bucket[order[a]]), order[a:b]


def _anchors(length: int, gram: int, buckets: int):
    def anchors(batches):
        for batch in batches:
            for some in slices(batch, "text", PART_BYTES):
                data, offsets = utf8_column(some.column("text"))
                for a, b, first, own, place in _bounded(offsets, length):
                    rows = owned_windows(data[a:b], own, length, gram)
                    rows["doc"] = _ids(some)[first + rows["doc"]]
                    rows["at"] += np.uint32(place)
                    found = [(k, rows[at].tobytes()) for k, at in _by_bucket(rows["hash"], buckets)]
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.binary())], ["bucket", "rows"])

    return anchors


def _bounded(offsets: np.ndarray, length: int, most: int = (1 << _PLACE_BITS) - 1):
    """(first byte, one past the last byte, first text, offsets in the part, first byte's place in its text) of parts
    of at most ``most`` bytes. A longer text is cut in parts that overlap, so that each window lies whole in one."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        start, end = int(offsets[lo]), int(offsets[hi])
        if end - start <= most:
            yield start, end, lo, offsets[lo : hi + 1] - start, 0
        else:
            for a in range(start, end, most - length + 1):
                b = min(a + most, end)
                yield a, b, lo, np.array([0, b - a]), a - start
        lo = hi


def _shared(table: pa.Table) -> pa.Table:
    """Of a bucket's anchors those whose hash occurs twice, by document."""
    rows = np.concatenate([np.frombuffer(x.as_py(), ANCHOR) for x in table["rows"]]) if table.num_rows else np.zeros(0, ANCHOR)
    order = np.argsort(rows["hash"], kind="stable")
    h = rows["hash"][order]
    same = np.zeros(len(h), bool)
    if len(h) > 1:
        equal = h[1:] == h[:-1]
        same[1:] |= equal
        same[:-1] |= equal
    rows = rows[order[same]]
    rows = rows[np.argsort(rows["doc"], kind="stable")]
    edges = np.flatnonzero(np.diff(rows["doc"], prepend=rows["doc"][:1] - 1)) if len(rows) else np.zeros(0, int)
    ends = [*edges[1:].tolist(), len(rows)] if len(edges) else []
    return pa.table({"doc_id": pa.array(rows["doc"][edges], pa.int64()), "rows": pa.array([rows[a:b].tobytes() for a, b in zip(edges.tolist(), ends, strict=True)], pa.binary())})


def _folded(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of each class's first occurrence, and of all its others; a class has one key."""
    order = np.lexsort((rows["at"], rows["doc"], keys))
    first = np.ones(len(order), bool)
    first[1:] = keys[order[1:]] != keys[order[:-1]]
    return order[first], order[~first]


def _context_keys(rows: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal for equal contexts of an anchor at an equal place, and for no others."""
    keys = mixed(span_hashes(data, starts, ends) + rows["hash"] * U64(3) + rows["off"].astype(U64))
    order = np.argsort(keys, kind="stable")
    again = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    whole, a, b, off = data.tobytes(), starts.tolist(), ends.tolist(), rows["off"]
    if all(off[i] == off[j] and whole[a[i] : b[i]] == whole[a[j] : b[j]] for i, j in zip(order[again].tolist(), order[again + 1].tolist(), strict=True)):
        return keys
    # different bytes have one hash: number the contexts themselves
    numbers: dict[tuple, int] = {}
    return np.array([numbers.setdefault((int(h), int(o), whole[x:y]), len(numbers)) for h, o, x, y in zip(rows["hash"], off, a, b, strict=True)], U64)


def _whole_spans(rows: np.ndarray, length: int) -> np.ndarray:
    """Document, start and end of whole contexts."""
    at = rows["at"].astype(np.int64)
    return np.stack([rows["doc"], at, at + rows["more"] + length]) if len(rows) else np.zeros((3, 0), np.int64)


def _by_runs(spans: np.ndarray) -> np.ndarray:
    """Spans (document, start, end), those of a document merged to maximal runs."""
    docs, number = np.unique(spans[0], return_inverse=True)
    # far apart by document, so that one pass merges all
    base = number.astype(np.int64) << 32
    starts, ends = merged_spans(base + spans[1], base + spans[2])
    low = (1 << 32) - 1
    return np.stack([docs[starts >> 32], starts & low, ends & low]) if len(starts) else np.zeros((3, 0), np.int64)


def _span_table(spans: np.ndarray) -> pa.Table:
    return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("doc_id", "start", "end"), _by_runs(spans), strict=True)})


def _contexts(length: int, buckets: int):
    """Rows (bucket, rows, contexts) of first occurrences, and rows (doc_id, start, end) of those folded here."""

    def contexts(batches):
        for batch in batches:
            for some in slices(batch, "text", PART_BYTES):
                data, offsets = utf8_column(some.column("text"))
                lists = [np.concatenate([np.frombuffer(x, ANCHOR) for x in r]) for r in some.column("rows").to_pylist()]
                rows = np.concatenate(lists)
                base = np.repeat(offsets[:-1], [len(x) for x in lists])
                starts = base + rows["at"]
                ends = starts + rows["more"] + length
                firsts, others = _folded(rows, _context_keys(rows, data, starts, ends))
                spans = _span_table(_whole_spans(rows[others], length))
                n = spans.num_rows
                yield from _batches(pa.table({"bucket": pa.nulls(n, pa.int32()), "rows": pa.nulls(n, pa.binary()), "contexts": pa.nulls(n, pa.binary())} | {c: spans[c] for c in spans.column_names}))
                firsts = np.sort(firsts)
                found = []
                for bucket, at in _by_bucket(rows["hash"][firsts], buckets):
                    own = firsts[at]
                    found.append((bucket, rows[own].tobytes(), b"".join([data[a:b].tobytes() for a, b in zip(starts[own].tolist(), ends[own].tolist(), strict=True)])))
                m = len(found)
                columns = {"bucket": pa.array([x[0] for x in found], pa.int32()), "rows": pa.array([x[1] for x in found], pa.binary()), "contexts": pa.array([x[2] for x in found], pa.binary())}
                yield from _batches(pa.table(columns | {c: pa.nulls(m, pa.int64()) for c in ("doc_id", "start", "end")}))

    return contexts


def _batches(table: pa.Table):
    return table.combine_chunks().to_batches() or []


def maximal_repeats(rows: np.ndarray, data: np.ndarray, starts: np.ndarray, length: int, distance: int | None = None):
    """(string length, occurrences as row numbers, their offsets from the rows' first windows) of every
    maximal repeat among contexts; row i's context is data[starts[i] : starts[i] + more + length].

    Only suffixes that begin at an owned window can match over ``length`` bytes;
    with ``distance`` only those that begin so far before the anchor.
    """
    if distance is None:
        per = rows["more"].astype(np.int64) + 1
        row = np.repeat(np.arange(len(rows)), per)
        delta = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    else:
        delta = rows["off"].astype(np.int64) - distance
        row = np.flatnonzero((delta >= 0) & (delta <= rows["more"]))
        delta = delta[row]
        if not len(row):
            return
    begin = starts[row] + delta
    # equal first windows are the roots of the interval tree
    keys = span_hashes(data, begin, begin + length)
    order = np.argsort(keys, kind="stable")
    edge = np.ones(len(order), bool)
    edge[1:] = keys[order[1:]] != keys[order[:-1]]
    root = np.cumsum(edge) - 1
    sizes = np.bincount(root)
    # the byte before a suffix; a context's first window extends to nothing that is known here
    left = np.where(delta > 0, data[np.maximum(begin - 1, 0)].astype(np.int16), -1)[order]
    heads = np.flatnonzero(edge)
    most, least = np.maximum.reduceat(left, heads), np.minimum.reduceat(left, heads)
    diverse = (sizes > 1) & ((most != least) | (least < 0))
    kept = diverse[root]
    if not kept.any():
        return
    order, root, left = order[kept], root[kept], left[kept]
    row, delta, begin = row[order], delta[order], begin[order]
    # the suffix array: sorted by what follows the first window, 0 for a context's end and byte + 1 else
    room = rows["more"][row].astype(np.int64) - delta
    width = int(room.max())
    tails = np.zeros((len(row), width + 1), np.uint8)
    inside = np.arange(width)[None, :] < room[:, None]
    tails[:, :width][inside] = data[(begin[:, None] + length + np.arange(width)[None, :])[inside]] + 1
    words = np.zeros((len(row), -(-(width + 1) // 8) * 8), np.uint8)
    words[:, : width + 1] = tails
    columns = words.view(">u8").astype(U64)
    suffixes = np.lexsort((*columns.T[::-1], root))
    tails, root, left, row, delta, room = tails[suffixes], root[suffixes], left[suffixes], row[suffixes], delta[suffixes], room[suffixes]
    # common-prefix lengths with the suffix before; 0 between roots
    common = np.zeros(len(row) + 1, np.int64)
    differs = tails[1:] != tails[:-1]
    beyond = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    common[1:-1] = np.where(root[1:] == root[:-1], length + np.minimum(beyond, np.minimum(room[1:], room[:-1])), 0)
    lengths, lefts = common.tolist(), left.tolist()
    # a stack of open intervals: common-prefix length, first suffix, and the one byte before all of them or None
    stack: list[list] = []
    for i in range(1, len(lengths)):
        now, first, before = lengths[i], i - 1, lefts[i - 1] if lefts[i - 1] >= 0 else None
        while stack and stack[-1][0] > now:
            size, first, inner = stack.pop()
            before = before if before == inner else None
            if before is None:
                yield size, row[first:i], delta[first:i]
        if now:
            if stack and stack[-1][0] == now:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == before else None
            else:
                stack.append([now, first, before])


def _later(rows: np.ndarray, repeats) -> np.ndarray:
    """Document, start and end of what maximal repeats cover by occurrences other than their first."""
    docs, ats = rows["doc"].astype(np.int64), rows["at"].astype(np.int64)
    # the longest interval in which a suffix isn't the first; one number for each suffix, however the intervals nest
    places, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    held, width = 0, int(rows["more"].max()) + 1

    def longest() -> None:
        place, size = np.concatenate(places), np.concatenate(sizes)
        order = np.lexsort((-size, place))
        kept = order[np.concatenate([[True], place[order[1:]] != place[order[:-1]]])] if len(order) else order
        places[:], sizes[:] = [place[kept]], [size[kept]]

    for size, at, delta in repeats:
        doc, place = docs[at], ats[at] + delta
        least = doc.min()
        later = (doc != least) | (place != place[doc == least].min())
        places.append(at[later] * width + delta[later])
        sizes.append(np.full(len(places[-1]), size, np.int64))
        held += len(places[-1])
        if held > 1 << 20:
            longest()
            held = 0
    longest()
    at, delta = places[0] // width, places[0] % width
    return np.stack([docs[at], ats[at] + delta, ats[at] + delta + sizes[0]])


def _removed(length: int):
    """A bucket's removed spans from its anchors' contexts."""

    def removed(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(x.as_py(), ANCHOR) for x in table["rows"]])
        data = np.frombuffer(b"".join(x.as_py() for x in table["contexts"]), np.uint8)
        sizes = rows["more"].astype(np.int64) + length
        ends = np.cumsum(sizes)
        starts = ends - sizes
        firsts, others = _folded(rows, _context_keys(rows, data, starts, ends))
        spans = [_whole_spans(rows[others], length)]
        # anchors left with one class have no other occurrence
        by_hash = firsts[np.argsort(rows["hash"][firsts], kind="stable")]
        h = rows["hash"][by_hash]
        same = np.zeros(len(h), bool)
        if len(h) > 1:
            same[1:] |= h[1:] == h[:-1]
            same[:-1] |= h[1:] == h[:-1]
        several = by_hash[same]
        own, own_starts = rows[several], starts[several]
        # anchors with few contexts at a time bound the suffix arrays, and so does one distance from an anchor with many
        for a, b in _runs(own["hash"], RUN_ROWS):
            for distance in [None] if b - a < 2 * RUN_ROWS else range(int((own["off"][a:b].astype(np.int64) - own["more"][a:b]).min()), int(own["off"][a:b].max()) + 1):
                spans.append(_by_runs(_later(own[a:b], maximal_repeats(own[a:b], data, own_starts[a:b], length, distance))))
        return _span_table(np.concatenate(spans, axis=1))

    return removed


def _runs(keys: np.ndarray, size: int):
    """Ranges of about ``size`` rows that don't part equal keys."""
    start = 0
    while start < len(keys):
        end = min(start + size, len(keys))
        while end < len(keys) and keys[end] == keys[end - 1]:
            end += 1
        yield start, end
        start = end


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans as maximal runs."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    if not len(starts):
        return starts, reach
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])]


def by_document(docs: DataFrame, name: str = "repeats") -> DataFrame:
    """The documents, one row each, as a table bucketed by doc_id in the shared folder.

    Later joins on doc_id then shuffle only their other side, never the texts again.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    docs.repartition(parts, "doc_id").write.bucketBy(parts, "doc_id").option("compression", "zstd").option("path", f"{shared_folder(spark).rstrip('/')}/{table}").saveAsTable(table)
    release(spark)
    return spark.table(table)


def removal_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, text), one row per document, to doc_id, copy boolean and spans array<struct<start, end>>.

    spans are byte ranges to remove, not yet merged; a copy of a whole text with
    a smaller doc_id is told by ``copy`` instead, and is removed whole.
    """
    spark = texts.sparkSession

    def keyed(batches):
        for batch in batches:
            raw = [(t or "").encode() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t) for t in raw], pa.int64()), pa.array([xxhash.xxh3_128_digest(t) for t in raw], pa.binary())], ["doc_id", "n_bytes", "key"])

    keys = texts.mapInArrow(keyed, "doc_id long, n_bytes long, key binary").where(f"n_bytes >= {length}")
    # the first document of each text stands for all its copies
    originals = cut(keys.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes")).select("doc_id", "n_bytes"))
    n_bytes = originals.agg(F.sum("n_bytes")).first()[0] or 0
    originals = originals.select("doc_id")
    buckets = max(16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // BUCKET_BYTES))
    distinct = texts.join(originals, "doc_id", "left_semi")
    anchors = distinct.mapInArrow(_anchors(length, gram, buckets), "bucket int, rows binary")
    shared = anchors.groupBy("bucket").applyInArrow(_shared, "doc_id long, rows binary")
    lists = written(shared.groupBy("doc_id").agg(F.collect_list("rows").alias("rows")), "lists")
    contexts = distinct.join(lists, "doc_id").select("doc_id", "text", "rows").mapInArrow(_contexts(length, buckets), "bucket int, rows binary, contexts binary, doc_id long, start long, end long")
    found = written(contexts, "contexts")
    repeats = found.where("bucket IS NOT NULL").select("bucket", "rows", "contexts").groupBy("bucket").applyInArrow(_removed(length), "doc_id long, start long, end long")
    spans = found.where("bucket IS NULL").select("doc_id", "start", "end").union(repeats)
    by_doc = written(spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    dropped(lists, found)
    marked = originals.withColumn("original", F.lit(True)).join(by_doc, "doc_id", "left")
    return texts.select("doc_id").join(marked, "doc_id", "left").select("doc_id", F.col("original").isNull().alias("copy"), "spans")


def _kept(length: int, snap: bool):
    """Adds n_bytes, n_removed, n_spans, kept_sha256 and kept_text (null unless ``snap``)."""

    def kept(batches):
        for batch in batches:
            for some in slices(batch, "text", PART_BYTES):
                out = []
                for text, copy, spans in zip(some.column("text").to_pylist(), some.column("copy").to_pylist(), some.column("spans"), strict=True):
                    raw = (text or "").encode()
                    if copy and len(raw) >= length:
                        starts, ends = np.array([0]), np.array([len(raw)])
                    elif spans.is_valid:
                        starts, ends = merged_spans(*(spans.values.field(c).to_numpy() for c in ("start", "end")))
                    else:
                        starts = ends = np.zeros(0, np.int64)
                    if snap:  # a character that is covered in part stays
                        data = np.frombuffer(raw, np.uint8)
                        inner = lambda x: len(raw) == x or data[x] & 0xC0 != 0x80  # noqa: B023, E731
                        pairs = [(next(a for a in range(a, b + 1) if a == b or inner(a)), next(b for b in range(b, a - 1, -1) if b == a or inner(b))) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                        pairs = [(a, b) for a, b in pairs if a < b]
                        starts, ends = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
                    rest = b"".join([raw[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(raw)], strict=True)])
                    out.append((len(raw), int((ends - starts).sum()), len(starts), hashlib.sha256(rest).hexdigest(), rest.decode() if snap else None))
                names, kinds = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([some.column("_row"), *(pa.array([x[i] for x in out], k) for i, k in enumerate(kinds))], ["_row", *names])

    return kept


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, as_text: bool = False) -> DataFrame:
    """One row per document: its columns but ``text``, then n_bytes, n_removed, n_spans, kept_sha256 and kept_text.

    kept_text is filled if ``as_text``; spans then shrink to whole characters,
    so that what is kept is text. A table's own columns of these names are replaced.
    """
    added = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (*added, "text")]
    rows = in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*others).alias("_row"))
    named, nameless = rows.where("doc_id IS NOT NULL"), rows.where("doc_id IS NULL")

    def said(of: DataFrame) -> DataFrame:
        """_row, text, copy and spans to _row and what is added."""
        schema = f"_row {of.schema['_row'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
        return of.select("_row", "text", "copy", "spans").mapInArrow(_kept(length, as_text), schema)

    def without(documents: DataFrame) -> DataFrame:
        by_doc = by_document(documents)
        return said(by_doc.join(removal_spans(by_doc.select("doc_id", "text"), length, gram), "doc_id"))

    if not irregular(named):
        found = without(named)
    else:
        # documents are told apart by doc_id and text, and numbered in this order
        keyed = with_numbers(named)
        once = keyed.groupBy(F.col("_doc").alias("doc_id")).agg(F.first("text").alias("text")).withColumn("_row", F.struct("doc_id"))
        results = without(once).select(F.col("_row.doc_id").alias("_doc"), *added)
        found = keyed.select("_doc", "_row").join(results, "_doc").select("_row", *added)
    kept = said(nameless.withColumns({"copy": F.lit(False), "spans": F.lit(None).cast("array<struct<start:long,end:long>>")}))
    return found.union(kept).select("_row.*", *added)

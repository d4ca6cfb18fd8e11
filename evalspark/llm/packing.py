"""Sum-of-squares online packing of token sequences.

Each scan task packs its own documents, in one pass and without a shuffle. A
document's ids are cut into whole windows and a rest; the rest goes into the
fill level that minimises the sum over levels of the squared count of windows
filled that far. A level array holds these counts, so a placement is one
vector expression over it. When the task's rows end, the gaps of the fuller
open windows are filled with ids cut from the emptiest ones, and what the last
window holds is laid out in sequences whose lengths are powers of two, which
need no padding. Memory is one batch plus the open windows.

Defined cases: a null text is the empty text, which has the end id only; an
empty table gives an empty result; documents that repeat, or a null doc_id, are
packed like all others; texts are encoded whole, with the strings of the
vocabulary's added tokens as these tokens; columns beside doc_id and text are
ignored.

A retried task packs the same split alike, so a lost executor changes nothing:
sequence ids come from the partition's number and a counter.
"""

from __future__ import annotations

import base64
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from evalspark.llm.common import in_batches, slices

WINDOW = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k"
BATCH_BYTES = 4 << 20
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_encoders: dict[str, object] = {}


def encoder(name: str = VOCABULARY):
    """The byte-level BPE of a public vocabulary, once per Python worker.

    With ``allowed_special="all"`` the ids equal those of tokenizers with
    ``<name>.json``, added tokens included; the same ranks are run by tiktoken,
    which is four times as fast here (tested in tests/llm).
    """
    if name not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        # tiktoken takes the strings as they are, wherever they stand
        assert not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        special = {t["content"]: t["id"] for t in added}
        _encoders[name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _encoders[name]


class SumOfSquares:
    """An online packer. ``add`` and ``finish`` yield (doc, start, ids, doc_tokens, window, offset).

    counts[h] is the number of open windows filled up to h, for 0 < h < size.
    """

    def __init__(self, size: int = WINDOW) -> None:
        self.size, self.next_window = size, 0
        self.counts = np.zeros(size + 1, np.int64)
        self.levels: list[list[int]] = [[] for _ in range(size)]
        self.open: dict[int, list[tuple]] = {}

    def _new(self) -> int:
        self.next_window += 1
        return self.next_window - 1

    def _level(self, n: int) -> int:
        """The level to which n ids go: the one that minimises the sum of squared counts then."""
        fits = self.size - n
        left, right = self.counts[: fits + 1], self.counts[n:]
        # leaving a level of count c changes its square by 1 - 2c, entering one by 1 + 2c; a full window counts no more
        cost = 2 * right - 2 * left + 2
        cost[fits] = 1 - 2 * left[fits]
        cost[1:][left[1:] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * right[0] + 1 if n < self.size else 0  # a new window
        # ties: the fullest window
        return int(fits - np.argmin(cost[::-1]))

    def add(self, doc, ids: np.ndarray):
        total = len(ids)
        whole = total - total % self.size
        for start in range(0, whole, self.size):
            yield doc, start, ids[start : start + self.size], total, self._new(), 0
        if whole == total:
            return
        rest = (doc, whole, ids[whole:], total)
        n, level = total - whole, self._level(total - whole)
        if level:
            window = self.levels[level].pop()
            self.counts[level] -= 1
        else:
            window = self._new()
            self.open[window] = []
        pieces = self.open[window]
        pieces.append((*rest, window, level))
        if level + n == self.size:
            yield from self.open.pop(window)
        else:
            self.levels[level + n].append(window)
            self.counts[level + n] += 1

    def finish(self):
        """Fills the gaps of the fuller windows from the emptiest ones; at most one window stays partial."""
        order = [(fill, w) for fill in range(self.size - 1, 0, -1) for w in self.levels[fill]]
        fills = {w: fill for fill, w in order}
        queue = [w for _, w in order]
        low, high = 0, len(queue) - 1
        while low < high:
            to, source = queue[low], queue[high]
            gap = self.size - fills[to]
            doc, start, ids, total, _, offset = self.open[source].pop()
            moved = min(gap, len(ids))
            if moved < len(ids):
                self.open[source].append((doc, start, ids[:-moved], total, source, offset))
            self.open[to].append((doc, start + len(ids) - moved, ids[len(ids) - moved :], total, to, fills[to]))
            fills[to] += moved
            fills[source] -= moved
            if fills[to] == self.size:
                yield from self.open.pop(to)
                low += 1
            if fills[source] == 0:
                self.open.pop(source)
                high -= 1
        for window in [*self.open]:
            yield from self._in_powers(self.open.pop(window))
        self.counts[:] = 0
        self.levels = [[] for _ in range(self.size)]

    def _in_powers(self, pieces: list[tuple]):
        """The pieces of one window in sequences whose lengths are powers of two, the largest first."""
        left = sum(len(p[2]) for p in pieces)
        window, room, offset = None, 0, 0
        for doc, start, ids, total, _, _ in pieces:
            while len(ids):
                if not room:
                    window, room, offset = self._new(), 1 << (left.bit_length() - 1), 0
                n = min(room, len(ids))
                yield doc, start, ids[:n], total, window, offset
                ids, start, room, offset, left = ids[n:], start + n, room - n, offset + n, left - n


def pack(docs: DataFrame, size: int = WINDOW, end_id: int = END_ID, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """(doc_id, text) to pieces: consecutive ids of a document at a place in a sequence.

    Every id lies in exactly one piece; a sequence's pieces are gapless from
    offset 0. ``with_ids`` adds the ids themselves as array<int>.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def packed(batches):
        packer, encode = SumOfSquares(size), encoder(vocabulary)
        part = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36

        def rows(found: list[tuple]) -> pa.RecordBatch:
            # a packer's next_window starts at 0 in each task, so the partition's number makes ids unique
            columns = {
                "doc_id": pa.array([x[0] for x in found], doc_type),
                "start": pa.array([x[1] for x in found], pa.int64()),
                "length": pa.array([len(x[2]) for x in found], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(x[2].tobytes()) for x in found], pa.int64()),
                "doc_tokens": pa.array([x[3] for x in found], pa.int64()),
                "sequence_id": pa.array([part + x[4] for x in found], pa.int64()),
                "offset": pa.array([x[5] for x in found], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([x[2].astype(np.int32) for x in found], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(columns)

        doc_type = None
        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            for some in slices(batch, "text", BATCH_BYTES):
                found: list[tuple] = []
                for doc, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist(), strict=True):
                    ids = np.array([*encode.encode(text or "", allowed_special="all"), end_id], "<u4")
                    found += packer.add(doc, ids)
                if found:
                    yield rows(found)
        if found := [*packer.finish()]:
            yield rows(found)

    schema = PIECES.replace("doc_id long", f"doc_id {id_type}") + (", ids array<int>" if with_ids else "")
    return in_batches(docs.select("doc_id", docs["text"].cast("string").alias("text"))).mapInArrow(packed, schema)


def padding(pieces: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row: sequences, tokens and padded_tokens (none where a sequence's length is a power of two)."""
    from pyspark.sql import functions as F

    fill = pieces.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    exact = F.expr("bit_count(fill) = 1")
    return fill.agg(F.count(F.lit(1)).alias("sequences"), F.sum("fill").alias("tokens"), F.sum(F.when(exact, 0).otherwise(size - F.col("fill"))).alias("padded_tokens"))

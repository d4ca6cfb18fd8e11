"""SentencePiece encoding with seeded merge-dropout, and decoding.

Merge-type segmentation with an agenda: all adjacent symbol pairs that form a
piece are candidates, the best-ranked (then leftmost) is taken, and the new
neighbours become candidates. Each candidate taken from the agenda is skipped
with chance ``dropout``; a skipped merge may come up again only as part of
other pairs. Skips are drawn for every occurrence of a word by itself: the
numbers of candidates merged until the next skip come from a keyed hash of
(seed, document, the word's place in it, number of the draw), by the geometric
distribution. So equal words get varied segmentations, without a bound on their
number, that are the same on every run and every cluster. Without dropout the
ids equal the library's own encoding.

What a word becomes without a skip, and with just one after so many merges,
depends on no draw and is kept in bounded memos, as most words of a corpus
repeat; an occurrence takes it if its own draws come to that, and is segmented
by itself if not. The agendas of the words that a part of a batch has besides
are processed in step, as rows of arrays; long words and those with characters
that only bytes spell have an agenda of their own (a heap where they are long),
with equal results.

Lossless: the word mark itself in a text is spelled by byte pieces, and so is
every character without a piece, so ``decode`` returns every text exactly.

Defined cases: a null text is the empty text, which has no ids; texts are
encoded whole; a null doc_id draws skips like id 0, one that is no whole number by a
hash, and repeated doc_ids with equal texts have equal ids; an empty table gives an empty result; columns
beside doc_id and text are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from bisect import bisect_right
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from evalspark.llm.common import BASE, MIX, U64, in_batches, list_array, mixed, slices

MARK = "▁"
VOCABULARY = "piece_bpe_32k"
#: No candidate. A mark that is a character of the text stands as LITERAL, which no piece has, while it is segmented.
NEVER, LITERAL = 1 << 40, "\udc81"
#: Multipliers of an occurrence's place and of a draw's number.
PLACE_KEY, DRAW_KEY = MIX[1], BASE
#: A draw tells at most so many merges; the next draw goes on from there. More than the candidates of any word processed in step.
MOST_GAP = 1 << 12
#: From this length on a word's agenda is a heap.
HEAP_FROM = 40
PART_BYTES = 2 << 20
#: So many words have their agendas processed in step.
STEP = 8192
#: Segmentations that each of the two memos of a Python worker keeps before it starts anew, and characters of their words on average.
MEMO, MEMO_CHARS = 400_000, 20
#: No candidate, as an agenda in step has it.
NONE = 1 << 30

_models: dict[str, Model] = {}
_memos: dict[str, tuple[Memo, Memo]] = {}
_gaps: dict[int, np.ndarray] = {}


class Model:
    """Ranks, ids and byte pieces of a public merge-type vocabulary."""

    def __init__(self, name: str) -> None:
        import public_tokenizers
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(public_tokenizers.path(f"{name}.model"), "rb") as f:
            proto.ParseFromString(f.read())
        kinds = proto.SentencePiece.Type
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        #: Smaller is merged earlier: scores fall along the merges.
        self.rank = {p.piece: round(-p.score) for p in proto.pieces if p.type == kinds.NORMAL}
        self.bytes = [i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE]
        self.raw: list[bytes] = [b""] * len(proto.pieces)
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.NORMAL:
                self.raw[i] = p.piece.replace(MARK, " ").encode()
        for value, i in enumerate(self.bytes):
            self.raw[i] = bytes([value])
        self._tables()
        #: Words may be segmented apart only if no piece has a mark after another character.
        assert all(MARK not in p.lstrip(MARK) for p in self.ids)

    def _tables(self) -> None:
        """What the vector agenda looks up: symbols of characters, and merges of symbol pairs."""
        #: The symbol of a character that is its own piece or, for one byte, a byte piece; 0 (unknown) else.
        self.symbol_of = np.zeros(0x110000, np.int32)
        for value, i in enumerate(self.bytes[:128]):
            self.symbol_of[value] = i
        pairs = {}
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
            for k in range(1, len(piece)):
                left, right = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left << 16 | right] = (self.rank[piece], i)
        keys = np.array(sorted(pairs), np.uint64)
        self.pair_keys = keys
        self.pair_ranks = np.array([pairs[k][0] for k in keys.tolist()], np.int32)
        self.pair_ids = np.array([pairs[k][1] for k in keys.tolist()], np.int32)
        #: Whether any pair's hash has these leading bits; most pairs that don't merge end here.
        self.pair_has = np.zeros(1 << 22, bool)
        self.pair_has[keys * U64(BASE) >> U64(42)] = True

    def _merges(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and ids of what symbol pairs merge to; NONE where they don't."""
        keys = (left.astype(U64) << U64(16)) | right.astype(U64)
        ranks, ids = np.full(len(keys), NONE, np.int32), np.zeros(len(keys), np.int32)
        maybe = np.flatnonzero(self.pair_has[keys * U64(BASE) >> U64(42)])
        at = np.minimum(np.searchsorted(self.pair_keys, keys[maybe]), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == keys[maybe]
        ranks[maybe[hit]], ids[maybe[hit]] = self.pair_ranks[at[hit]], self.pair_ids[at[hit]]
        return ranks, ids

    def segment_all(self, symbols: np.ndarray, lengths: np.ndarray, first: np.ndarray, keys: np.ndarray | None = None, threshold: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Agendas of many words in step. Rows of symbols (no 0 in a word) to their ids, one after the other, their counts and the candidates taken.

        Row i of the agenda has the rank of the pair that starts at each place;
        each round takes the best candidate of every word. ``first`` of them are
        merged before one is skipped; the draws of ``keys`` tell when the next
        are, and without keys none is.
        """
        n, width = symbols.shape
        symbols = symbols.copy()
        alive = np.arange(width)[None, :] < lengths[:, None]
        right = np.tile(np.arange(1, width + 1, dtype=np.int16), (n, 1))
        left = np.tile(np.arange(-1, width - 1, dtype=np.int16), (n, 1))
        agenda, result = np.full((n, width), NONE, np.int32), np.zeros((n, width), np.int32)
        row, place = np.nonzero(alive[:, 1:])
        agenda[row, place], result[row, place] = self._merges(symbols[row, place], symbols[row, place + 1])
        rows, wait, taken, draws = np.arange(n), first.copy(), np.zeros(n, np.int64), np.ones(n, U64)
        while len(rows):
            i = agenda[rows].argmin(axis=1)
            r = agenda[rows, i]
            on = r < NONE
            rows, i, r = rows[on], i[on], r[on]
            taken[rows] += 1
            go = wait[rows] > 0
            wait[rows] -= 1
            w = rows[~go]
            agenda[w, i[~go]] = NONE
            wait[w] = NEVER if keys is None else drawn(keys[w], draws[w], threshold)
            draws[w] += U64(1)
            w, i = rows[go], i[go]
            j = right[w, i]
            symbols[w, i] = result[w, i]
            alive[w, j] = False
            agenda[w, j] = NONE
            k = right[w, j].astype(np.int64)
            right[w, i] = k
            agenda[w, i] = NONE
            more = k < lengths[w]
            u, a, b = w[more], i[more], k[more]
            left[u, b] = a
            agenda[u, a], result[u, a] = self._merges(symbols[u, a], symbols[u, b])
            k = left[w, i].astype(np.int64)
            more = k >= 0
            u, a, b = w[more], k[more], i[more]
            agenda[u, a], result[u, a] = self._merges(symbols[u, a], symbols[u, b])
        return symbols[alive], alive.sum(axis=1), taken

    def segment(self, word: str, marks: int, key: int, threshold: int) -> list[int]:
        """The ids of a word whose first ``marks`` characters are word marks, with the skips that the key draws."""
        return self.taken(word, marks, gaps(key, threshold, 3 * len(word)))[0]

    def _segment_long(self, word: str, marks: int, key: int, threshold: int) -> list[int]:
        return self._taken_long(word, marks, gaps(key, threshold, 3 * len(word)))[0]

    def taken(self, word: str, marks: int, waits) -> tuple[list[int], int]:
        """Ids of a word, and the candidates taken; ``waits`` are the merges before each skip.

        The agenda holds each adjacent pair's rank, NEVER where the pair is no
        piece or was skipped.
        """
        if len(word) > HEAP_FROM:
            return self._taken_long(word, marks, waits)
        get, symbols = self.rank.get, [*word]
        if MARK in word[marks:]:
            symbols[marks:] = [LITERAL if c == MARK else c for c in symbols[marks:]]
        agenda = [get(x + y, NEVER) for x, y in zip(symbols, symbols[1:], strict=False)]
        taken, wait = 0, next(waits)
        while agenda and (r := min(agenda)) < NEVER:
            i = agenda.index(r)
            taken += 1
            if not wait:
                agenda[i], wait = NEVER, next(waits)
                continue
            wait -= 1
            merged = symbols[i] = symbols[i] + symbols[i + 1]
            del symbols[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = get(merged + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = get(symbols[i - 1] + merged, NEVER)
        return self._ids_of(symbols), taken

    def _ids_of(self, symbols: list[str]) -> list[int]:
        out = [*map(self.ids.get, symbols)]
        if None in out:  # only single characters lack a piece: they are spelled by bytes
            out = [x for i, s in zip(out, symbols, strict=True) for x in ([i] if i is not None else [self.bytes[b] for b in (MARK if s == LITERAL else s).encode()])]
        return out

    def _taken_long(self, word: str, marks: int, waits) -> tuple[list[int], int]:
        """The same with a heap as agenda, whose cost grows with n log n."""
        get, symbols, n = self.rank.get, [*word], len(word)
        symbols[marks:] = [LITERAL if c == MARK else c for c in symbols[marks:]]
        right, left = [*range(1, n), -1], [-1, *range(n - 1)]
        agenda = [(r, i, symbols[i] + symbols[i + 1]) for i in range(n - 1) if (r := get(symbols[i] + symbols[i + 1], NEVER)) < NEVER]
        heapq.heapify(agenda)
        taken, wait = 0, next(waits)
        while agenda:
            r, i, pair = heapq.heappop(agenda)
            j = right[i] if symbols[i] else -1
            if j < 0 or symbols[i] + symbols[j] != pair:
                continue
            taken += 1
            if not wait:
                wait = next(waits)
                continue
            wait -= 1
            symbols[i], symbols[j] = pair, ""
            k = right[i] = right[j]
            if k >= 0:
                left[k] = i
                if (r := get(pair + symbols[k], NEVER)) < NEVER:
                    heapq.heappush(agenda, (r, i, pair + symbols[k]))
            k = left[i]
            if k >= 0 and (r := get(symbols[k] + pair, NEVER)) < NEVER:
                heapq.heappush(agenda, (r, k, symbols[k] + pair))
        return self._ids_of([s for s in symbols if s]), taken

    def decode(self, ids) -> str:
        """The text of ids that ``encode`` made: pieces and bytes joined, less the first word's mark."""
        return b"".join([self.raw[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


def mix_int(x: int) -> int:
    """The finisher of one 64-bit number."""
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 31)


def id_number(doc_id) -> int:
    """What a document's draws are keyed by: a whole number itself, 0 without an id, a hash of what any other id is written as."""
    if isinstance(doc_id, int) or doc_id is None:
        return doc_id or 0
    return xxhash.xxh3_64_intdigest(str(doc_id).encode())


def gap_table(threshold: int) -> np.ndarray:
    """2**64 times the chance that k candidates in a row are merged, for k from 1 to MOST_GAP or as far as it isn't 0; ascending."""
    if threshold not in _gaps:
        chances, x = [], 1 << 64
        while len(chances) < MOST_GAP and (x := x * ((1 << 32) - threshold) >> 32):
            chances.append(min(x, (1 << 64) - 1))
        _gaps[threshold] = np.array(chances[::-1], U64)
    return _gaps[threshold]


def drawn(keys: np.ndarray, draws: np.ndarray | U64, threshold: int) -> np.ndarray:
    """The merges before the next skip, MOST_GAP at most, by the numbered draws of occurrences' keys."""
    if not threshold:
        return np.full(len(keys), NEVER, np.int64)
    table = gap_table(threshold)
    return len(table) - np.searchsorted(table, mixed(keys + draws * U64(DRAW_KEY)), "right")


def gaps(key: int, threshold: int, most: int):
    """The merges before each skip by one key's draws; what is above ``most`` isn't told exactly."""
    if not threshold:
        yield from repeat(NEVER)
    table, draw = gap_table(threshold).tolist(), 0
    while True:
        wait, full = 0, True
        while full and wait <= most:
            n = len(table) - bisect_right(table, mix_int(key + draw * DRAW_KEY & 0xFFFFFFFFFFFFFFFF))
            wait, full, draw = wait + n, n == MOST_GAP, draw + 1
        yield wait


def model(name: str = VOCABULARY) -> Model:
    if name not in _models:
        _models[name] = Model(name)
    return _models[name]


class Memo:
    """Segmentations by key: runs of ids in one array, and the candidates taken for each."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.at: dict = {}
        self.ids, self.counts, self.taken, self.chars = np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def full(self) -> bool:
        return len(self.at) >= MEMO or self.chars >= MEMO * MEMO_CHARS

    def recall(self, keys: list, made) -> np.ndarray:
        """The numbers of distinct keys; ``made`` segments those at the places that aren't kept yet."""
        before, put, at = len(self.at), self.at.setdefault, self.at
        numbers = np.fromiter((put(k, len(at)) for k in keys), np.int64, len(keys))
        fresh = np.flatnonzero(numbers >= before)
        if len(fresh):
            ids, counts, taken = made(fresh)
            self.ids, self.counts, self.taken = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts]), np.concatenate([self.taken, taken])
        return numbers


def runs(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[start : start + count] of all, one after the other."""
    ends = np.cumsum(counts)
    return values[np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """Keyed segmentation of whole texts with bounded memos."""

    #: Keys to compare the kinds of agendas with.
    lanes = 4

    def __init__(self, dropout: float, seed: int, vocabulary: str = VOCABULARY) -> None:
        self.model, self.seed = model(vocabulary), seed
        self.threshold = min(int(dropout * (1 << 32)), 1 << 32)
        #: Words without a skip, and (word, merges before its only skip), to ids and candidates taken.
        self.memo, self.memo_once = _memos.setdefault(vocabulary, (Memo(), Memo()))

    def _units(self, text: str) -> list[str]:
        """The words between spaces. Runs of spaces stay with the word after them, as pieces of several marks exist."""
        units, held = [], 0
        for word in text.split(" "):
            if word:
                units.append(" " * held + word if held else word)
                held = 0
            else:
                held += 1
        if held:  # only spaces stand at the end: they are a unit without a word
            units.append(" " * held)
        return units

    def _marked(self, unit: str) -> tuple[str, int]:
        """A unit with marks for spaces, and their number."""
        body = unit.lstrip(" ")
        # a unit of spaces alone is as many marks; else the space before the word is a mark, too
        marks = len(unit) - len(body) + (1 if body else 0)
        return MARK * marks + body, marks

    def _one(self, unit: str, key: int | None = None, first: int = NEVER) -> tuple[bytes, int]:
        """The ids of a unit of any length and characters, and the candidates taken: by a key's draws, or with one skip after ``first`` merges."""
        word, marks = self._marked(unit)
        waits = chain([first], repeat(NEVER)) if key is None else gaps(key, self.threshold, 3 * len(word))
        ids, taken = self.model.taken(word, marks, waits)
        return array("H", ids).tobytes(), taken

    def _all(self, units: list[str], first: np.ndarray, keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of many units one after the other, their counts and the candidates taken.

        In step where all characters are symbols and the word isn't long, else one by one.
        """
        n = len(units)
        lengths = np.fromiter(map(len, units), np.int64, n) + 1
        order = np.argsort(lengths, kind="stable")
        plain, order = order[: np.searchsorted(lengths[order], HEAP_FROM, "right")], order[::-1]
        alone, found = [order[: n - len(plain)]], []
        for start in range(0, len(plain), STEP):
            at = plain[start : start + STEP]
            some, length = [units[k] for k in at.tolist()], lengths[at]
            width = int(length.max())
            inside = np.arange(width)[None, :] < length[:, None]
            codes = np.zeros((len(some), width), np.uint32)
            codes[inside] = np.frombuffer((MARK + MARK.join(some)).encode("utf-32-le"), np.uint32)
            symbols = self.model.symbol_of[codes]
            # marks and spaces within a unit have an agenda of their own
            odd = (symbols == 0) | (codes == ord(" ")) | (codes == ord(MARK))
            odd[:, 0] = False
            known = ~(odd & inside).any(axis=1)
            alone.append(at[~known])
            at = at[known]
            found.append((at, *self.model.segment_all(symbols[known], length[known], first[at], None if keys is None else keys[at], self.threshold)))
        for k in np.concatenate(alone).tolist():
            ids, taken = self._one(units[k], None if keys is None else int(keys[k]), int(first[k]))
            found.append(([k], np.frombuffer(ids, np.uint16), [len(ids) // 2], [taken]))
        if not found:
            return np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, ids, counts, taken = (np.concatenate(x) for x in zip(*found, strict=True))
        back = np.argsort(at)
        starts = np.cumsum(counts) - counts
        return runs(ids.astype(np.uint16), starts[back], counts[back]), counts[back], taken[back]

    def _many(self, units: list[str], key: int) -> dict[str, tuple[bytes, int]]:
        """The ids of distinct units, and the candidates taken, by the draws of one key."""
        keys = np.full(len(units), key, U64)
        ids, counts, taken = self._all(units, drawn(keys, U64(0), self.threshold), keys)
        return {u: (x.tobytes(), t) for u, x, t in zip(units, np.split(ids, np.cumsum(counts)[:-1]), taken.tolist(), strict=True)}

    def encode_units(self, units: pa.Array, keys: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of occurrences of units one after the other, and their counts; ``keys`` draw each one's skips."""
        if self.memo.full():  # the numbers of words are keys of the other memo
            self.memo.clear()
            self.memo_once.clear()
        if self.memo_once.full():
            self.memo_once.clear()
        coded = units.dictionary_encode()
        words, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        memo, once = self.memo, self.memo_once

        def plainly(fresh: np.ndarray):
            some = [words[k] for k in fresh.tolist()]
            memo.chars += sum(map(len, some))
            return self._all(some, np.full(len(some), NEVER, np.int64))

        number = memo.recall(words, plainly)
        run = number[code]
        if keys is None:
            return runs(memo.ids, (np.cumsum(memo.counts) - memo.counts)[run], memo.counts[run]), memo.counts[run]
        first = drawn(keys, U64(0), self.threshold)
        late = np.flatnonzero(first < memo.taken[run])
        # a full draw doesn't tell where the skip is; long words hardly come again
        again = np.fromiter(map(len, words), np.int64, len(words))[code[late]] >= HEAP_FROM
        short = late[~again]
        pairs, back = np.unique(code[short].astype(np.int64) << 8 | first[short], return_inverse=True)
        which, skip = pairs >> 8, pairs & 255
        numbers = once.recall((number[which] << 8 | skip).tolist(), lambda fresh: self._all([words[k] for k in which[fresh].tolist()], skip[fresh]))[back]
        run[short] = len(memo.counts) + numbers
        again[~again] = first[short] + 1 + drawn(keys[short], U64(1), self.threshold) < once.taken[numbers]
        late = late[again]
        ids, counts, _ = self._all([words[k] for k in code[late].tolist()], first[late], keys[late])
        run[late] = len(memo.counts) + len(once.counts) + np.arange(len(late))
        counts = np.concatenate([memo.counts, once.counts, counts])
        return runs(np.concatenate([memo.ids, once.ids, ids]), (np.cumsum(counts) - counts)[run], counts[run]), counts[run]

    def encode_all(self, doc_ids: list, texts: list) -> list[np.ndarray]:
        """The ids of texts, as uint16 arrays."""
        # texts whose spaces are all single and between words are split by Arrow
        plain, other = [], []
        for k, text in enumerate(texts):
            (plain if text and "  " not in text and text[0] != " " and text[-1] != " " else other).append(k)
        parts = pc.split_pattern(pa.array([texts[k] for k in plain], pa.string()), " ")
        rest = [self._units(texts[k]) if texts[k] else [] for k in other]
        units = pa.concat_arrays([parts.flatten(), pa.array(chain.from_iterable(rest), pa.string())])
        counts = np.concatenate([pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64), np.array([*map(len, rest)], np.int64)])
        ends, keys = np.cumsum(counts), None
        if self.threshold:
            seeds = np.array([mix_int((self.seed << 1 ^ id_number(doc_ids[k]) * BASE) & 0xFFFFFFFFFFFFFFFF) for k in plain + other], U64)
            place = np.arange(len(units)) - np.repeat(ends - counts, counts)
            keys = mixed(place.astype(U64) * U64(PLACE_KEY) + np.repeat(seeds, counts))
        ids, sizes = self.encode_units(units, keys)
        cuts = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends])].tolist()
        out = [ids] * len(texts)
        for k, a, b in zip(plain + other, cuts, cuts[1:], strict=False):
            out[k] = ids[a:b]
        return out

    def encode(self, doc_id, text: str | None) -> np.ndarray:
        """The ids of a text, as uint16."""
        return self.encode_all([doc_id], [text])[0]

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids.tolist()) if len(ids) else ""


def _said(rows: list[np.ndarray], m: Model) -> list[pa.Array]:
    """n_tokens, ids_crc32 and text of id arrays."""
    return [
        pa.array([len(x) for x in rows], pa.int64()),
        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in rows], pa.int64()),
        pa.array([m.decode(x.tolist()) if len(x) else "" for x in rows], pa.string()),
    ]


SAID = ("n_tokens", "ids_crc32", "text")


def encode(docs: DataFrame, dropout: float = 0.1, seed: int = 0, vocabulary: str = VOCABULARY, decoded: bool = False) -> DataFrame:
    """(doc_id, text) to doc_id and ids array<int>; no shuffle.

    ``decoded`` adds what :func:`decode` says of the ids, without sending them through a second Python worker.
    """

    def encoded(batches):
        coder = Encoder(dropout, seed, vocabulary)
        for batch in batches:
            for some in slices(batch, "text", PART_BYTES):
                ids = coder.encode_all(some.column("doc_id").to_pylist(), some.column("text").to_pylist())
                flat = np.concatenate(ids).astype(np.int32)
                columns = [some.column("doc_id"), list_array(flat, np.array([len(x) for x in ids], np.int64), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns + (_said(ids, coder.model) if decoded else []), ["doc_id", "ids", *(SAID if decoded else ())])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>" + (", n_tokens long, ids_crc32 long, text string" if decoded else "")
    return in_batches(docs.select("doc_id", docs["text"].cast("string").alias("text"))).mapInArrow(encoded, schema)


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds n_tokens long, ids_crc32 long (of little-endian 32-bit ids) and text to rows with ids; null ids are none."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", n_tokens long, ids_crc32 long, text string"

    def decoded(batches):
        m = model(vocabulary)
        for batch in batches:
            lists = batch.column("ids").fill_null([])
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64).tolist()
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            rows = [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []
            yield pa.RecordBatch.from_arrays([*batch.columns, *_said(rows, m)], [*batch.schema.names, *SAID])

    return encoded.mapInArrow(decoded, schema)

"""Unigram token counts by dynamic programming over a trie of distinct pre-tokens.

A text's pre-tokens are what stands between its spaces, each with the word mark
that the space (or the text's start) becomes. The distinct pre-tokens of a part
of a task's texts are inserted in a trie; the forward score of a trie node, which is
the best sum of piece scores over segmentations of its prefix, is computed
once, level by level with vector operations, however many pre-tokens share the
prefix. A terminal node stores the number of pieces of the best segmentation,
and a document's count is the sum over its pre-tokens. A Python worker keeps the
terminals' numbers in a bounded memo, so that a later part's trie has only
pre-tokens that are new. The trie of very long pre-tokens is gone through one
after the other in sorted order, from the node that each shares with the last.

The unigram scores come from the ranks of the public vocabulary by Zipf's law:
log p = -log(rank + ZIPF_SHIFT). A character that no piece covers is spelled by
its UTF-8 bytes as byte pieces. Scores are integers (units of 2**-20), so that
sums are exact; ties between segmentations go to fewer pieces.

Defined cases: a null or empty text has no pre-token and no token; texts are
counted whole, very long pre-tokens included; a null doc_id and repeated rows
are counted like all others; an empty table gives an empty result; columns
beside doc_id and text are ignored.
"""

from __future__ import annotations

import math
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from evalspark.llm.common import U64, gathered, in_batches, mixed, powers

MARK = "▁"
ZIPF_SHIFT = 10
UNIT = 1 << 20
VOCABULARY = "piece_bpe_32k"
PART_BYTES = 16 << 20
#: So many trie words are handled at once, of up to so many characters in the vector part.
WORDS, LONG = 50_000, 48
#: Terminals (of at most LONG characters) that a worker keeps.
MEMO = 400_000
NONE = np.int64(-(1 << 60))

_models: dict[str, Model] = {}
_terminals: dict[str, dict[str, int]] = {}


class Model:
    """Pieces with integer scores, and a hash table of them for vector look-ups."""

    def __init__(self, name: str) -> None:
        import public_tokenizers
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(public_tokenizers.path(f"{name}.model"), "rb") as f:
            proto.ParseFromString(f.read())
        normal, byte = proto.SentencePiece.Type.NORMAL, proto.SentencePiece.Type.BYTE
        score = lambda rank: round(-UNIT * math.log(rank + ZIPF_SHIFT))
        self.pieces = {p.piece: score(rank) for rank, p in enumerate(proto.pieces) if p.type == normal}
        self.byte_scores = [score(rank) for rank, p in enumerate(proto.pieces) if p.type == byte]
        self.byte_score = min(self.byte_scores)
        self.longest = max(map(len, self.pieces))
        hashes = np.array([_hash_of(p) for p in self.pieces], U64)
        order = np.argsort(hashes)
        self.hashes, self.scores = hashes[order], np.fromiter(self.pieces.values(), np.int64)[order]
        assert len(np.unique(hashes)) == len(hashes)
        #: Whether any piece's hash has these leading bits; most look-ups end here.
        self.shift = U64(64 - 22)
        self.has = np.zeros(1 << 22, bool)
        self.has[hashes >> self.shift] = True

    def spelled(self, char: str) -> tuple[int, int]:
        """(score, pieces) of a character by its bytes."""
        raw = char.encode()
        return self.byte_score * len(raw), len(raw)

    def in_order(self, words: list[str]) -> list[int]:
        """Piece counts of sorted pre-tokens, node by node along the trie: for very long ones."""
        out, before, best, count = [], "", [0], [0]
        for word in words:
            shared = len(commonprefix([before, word]))
            del best[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                score, n = self.spelled(word[end - 1])
                top = (best[end - 1] + score, -(count[end - 1] + n))
                for start in range(max(0, end - self.longest), end):
                    if (own := self.pieces.get(word[start:end])) is not None:
                        top = max(top, (best[start] + own, -(count[start] + 1)))
                best.append(top[0])
                count.append(-top[1])
            out.append(count[-1])
            before = word
        return out


def _hash_of(text: str) -> int:
    codes = np.array([ord(c) for c in text], U64) + U64(1)
    with np.errstate(over="ignore"):
        return int(mixed((codes * powers(len(codes))).sum(dtype=U64) ^ U64(len(text) * 0x94D049BB133111EB % (1 << 64))))


def model(name: str = VOCABULARY) -> Model:
    if name not in _models:
        _models[name] = Model(name)
    return _models[name]


def _level_counts(words: list[str], m: Model) -> np.ndarray:
    """Piece counts of distinct sorted pre-tokens of at most LONG characters, by trie level."""
    n, lengths = len(words), np.fromiter(map(len, words), np.int64, len(words))
    width = int(lengths.max())
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    codes = np.zeros((n, width), np.uint32)
    codes[np.arange(width)[None, :] < lengths[:, None]] = flat
    # shared[i]: characters that word i shares with the word before it, so its first new trie node is one deeper
    shared = np.zeros(n, np.int64)
    if n > 1:
        differs = codes[1:] != codes[:-1]
        shared[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        shared[1:] = np.minimum(shared[1:], np.minimum(lengths[1:], lengths[:-1]))
    sums = np.zeros((n, width + 1), U64)
    np.cumsum((codes.astype(U64) + U64(1)) * powers(width)[None, :], axis=1, out=sums[:, 1:])
    inverse = powers(width + 1, inverse=True)
    # of the trie node at each depth of the first word that has it; other words of the node find it by owner
    best = np.full((n, width + 1), NONE)
    count = np.zeros((n, width + 1), np.int64)
    best[:, 0] = 0
    owner = np.zeros((n, width + 1), np.int64)
    every = np.arange(n)
    for depth in range(1, width + 1):
        fresh = (shared < depth) & (lengths >= depth)
        owner[:, depth] = np.maximum.accumulate(np.where(shared < depth, every, 0))
        at = np.flatnonzero(fresh)
        if not len(at):
            break
        last = codes[at, depth - 1]
        size = 1 + (last > 0x7F).astype(np.int64) + (last > 0x7FF) + (last > 0xFFFF)
        before = owner[at, depth - 1]
        top = best[before, depth - 1] + m.byte_score * size
        pieces = count[before, depth - 1] + size
        for start in range(max(0, depth - m.longest), depth):
            h = mixed(((sums[at, depth] - sums[at, start]) * inverse[start]) ^ U64((depth - start) * 0x94D049BB133111EB % (1 << 64)))
            maybe = np.flatnonzero(m.has[h >> m.shift])
            slot = np.searchsorted(m.hashes, h[maybe])
            hit = m.hashes[np.minimum(slot, len(m.hashes) - 1)] == h[maybe]
            maybe, slot = maybe[hit], slot[hit]
            from_node = owner[at[maybe], start]
            score, number = best[from_node, start] + m.scores[slot], count[from_node, start] + 1
            better = (score > top[maybe]) | ((score == top[maybe]) & (number < pieces[maybe]))
            top[maybe[better]], pieces[maybe[better]] = score[better], number[better]
        best[at, depth], count[at, depth] = top, pieces
    return count[owner[every, lengths], lengths]


def pretoken_counts(words: set[str], m: Model) -> dict[str, int]:
    """Distinct marked pre-tokens to the piece counts that their terminal nodes store."""
    long = sorted(w for w in words if len(w) > LONG)
    counts = dict(zip(long, m.in_order(long), strict=True))
    # by code points, as the trie's levels are
    short = sorted(w for w in words if len(w) <= LONG)
    for start in range(0, len(short), WORDS):
        some = short[start : start + WORDS]
        counts.update(zip(some, _level_counts(some, m).tolist(), strict=True))
    return counts


def terminals(words: list[str], m: Model, known: dict[str, int]) -> np.ndarray:
    """The piece counts of distinct pre-tokens, given without their marks; ``known`` keeps them."""
    fresh = {MARK + w for w in words if w not in known}
    found = {w[1:]: c for w, c in pretoken_counts(fresh, m).items()}
    counts = np.fromiter((known[w] if w in known else found[w] for w in words), np.int64, len(words))
    if len(known) + len(found) > MEMO:
        known.clear()
    known.update((w, c) for w, c in found.items() if len(w) < LONG)
    return counts


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, text) to doc_id, n_pretokens long, n_tokens long; no shuffle."""

    def counted(batches):
        m, known = model(vocabulary), _terminals.setdefault(vocabulary, {})
        for some in gathered(batches, "text", part_bytes):
            texts = some.column("text").fill_null("")
            parts = pc.split_pattern(texts, " ")
            coded = parts.flatten().dictionary_encode()
            counts = terminals(coded.dictionary.to_pylist(), m, known)[coded.indices.to_numpy()]
            lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
            sums, ends = np.concatenate([[0], np.cumsum(counts)]), np.cumsum(lengths)
            # an empty text is one empty part, which is no pre-token
            none = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            n_tokens = np.where(none, 0, sums[ends] - sums[ends - lengths])
            yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(np.where(none, 0, lengths)), pa.array(n_tokens)], ["doc_id", "n_pretokens", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_batches(docs.select("doc_id", docs["text"].cast("string").alias("text"))).mapInArrow(counted, f"doc_id {kind}, n_pretokens long, n_tokens long")

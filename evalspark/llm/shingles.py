"""Word shingles of whole texts as 64-bit hashes, by vector operations over a batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from evalspark.llm.common import U64, mixed, span_hashes, utf8_column

#: The bytes that end words: 0x20 and 0x09 to 0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case and all else as it is."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each document's first word (n + 1 numbers)."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # words end where a document does
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Each text's distinct n-word shingles, sorted.

    A text with fewer words has its whole word sequence as one shingle; one
    without words, or a null, has none.
    """
    data, offsets = utf8_column(column)
    if not len(data):
        return [np.zeros(0, U64)] * (len(offsets) - 1)
    starts, ends, first = word_spans(lowered(data), offsets)
    words = span_hashes(lowered(data), starts, ends)
    total = len(words)
    folded = words.copy()
    for k in range(1, n):
        m = max(0, total - k)
        folded[:m] = mixed(folded[:m] * U64(31) + words[k : k + m])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(folded[a : b - n + 1]))
        elif b > a:
            short = words[a : a + 1].copy()
            for k in range(a + 1, b):
                short = mixed(short * U64(31) + words[k : k + 1])
            out.append(mixed(short + U64(b - a)))
        else:
            out.append(np.zeros(0, U64))
    return out


def set_key(shingles: np.ndarray) -> int:
    """A signed 64-bit key of a set, from two independent sums over its members."""
    a = mixed(shingles).sum(dtype=U64, keepdims=True)
    b = np.bitwise_xor.reduce(mixed(shingles ^ U64(0xA5A5A5A5A5A5A5A5)), initial=U64(0), keepdims=True)
    return int(mixed(a + U64(3) * b).view(np.int64)[0])

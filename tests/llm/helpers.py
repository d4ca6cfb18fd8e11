"""Brute-force versions that the operators are held against."""

from __future__ import annotations

import hashlib
from collections import defaultdict

DOC = "doc_id long, text string, lang string, source string, n_chars long"

#: Rows that every operator on documents has to take: nulls, empty and very long texts, ties, repeats.
AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "   \n\t ", "en", "a", 6),
    (4, "one", "en", None, 3),
    (5, "Same words here again and again, same words here again and again.", "en", "a", 66),
    (6, "Same words here again and again, same words here again and again.", "en", "a", 66),
    (7, "x" * 30_000, "de", "b", 30_000),
    (8, "äöü ▁ \x00 \U0001f600 <turn> \\ ñ " * 40, "es", "b", 1),
    (9, " ".join(f"w{i % 97}" for i in range(40_000)), "en", "c", 1),
    (10, "tail spaces   ", "en", "c", 1),
    (11, "   lead  and   middle", "en", "c", 1),
]


def shingles(text: str | None, n: int) -> frozenset:
    w = (text or "").encode().lower().split()
    if len(w) >= n:
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def roots(nodes, links) -> dict:
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    return {n: find(n) for n in nodes}


def similar(rows, n: int, num: int, den: int) -> dict:
    """doc_id to (set size, smallest doc_id reachable)."""
    sets = {d: shingles(t, n) for d, t in rows}
    posts = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            posts[x].append(d)
    both = defaultdict(int)
    for ds in posts.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                both[a, b] += 1
    links = [(a, b) for (a, b), c in both.items() if den * c >= num * (len(sets[a]) + len(sets[b]) - c)]
    root = roots(sets, links)
    return {d: (len(sets[d]), root[d]) for d in sets}


def without_repeats(rows, length: int) -> dict:
    """doc_id to (n_bytes, n_removed, n_spans, kept_sha256)."""
    seen, out = set(), {}
    for d, t in sorted(rows):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            window = raw[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        out[d] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out

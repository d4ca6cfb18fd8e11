"""Text operators as Column expressions: no Python on the executors.

Patterns are Java's. ``(?U)`` makes \\s, \\d and \\b follow Unicode and ``(?d)``
makes a dot stop at newlines only, which is what Python's re does.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Marks sentence ends between the two regular expressions that split a text.
_MARK = "\u0001"

#: Expressions that tell a negative sentence.
NEGATIVE_PATTERNS = [
    r"\bshortcoming(?:s)?\b",
    r"\bweakness(?:es)?\b",
    r"\blimit(?:ed|ations?)?\b",
    r"\bincremental(?:ly)?\b",
    r"\black(?:s|ing)?\b",
    r"\binsufficient(?:ly)?\b",
    r"\bunclear(?:ly)?\b",
    r"\bvague(?:ly|ness)?\b",
    r"\bnot\s+(?:sufficiently|fully|clearly|completely|adequate(?:ly)?|convincing|described|addressed)\b",
]

#: Fillers that are blanked before a sentence is encoded, in order.
NOISE_PATTERNS = [
    r"\bnot\s+(?:adequately|sufficiently)\b",
    r"\binsufficiently\b",
    r"\badequately\b",
    r"\bsufficiently\b",
    r"\bconvincing\b",
    r"\bthis\s+is\s+a\s+(?:weakness|shortcoming)\b",
    r"\bas\s+a\s+result\b",
    r"\bhowever\b",
    r"\bmoreover\b",
    r"\binadequately\b",
]

#: Words of a verdict, and the length below which a sentence is only that.
VERDICT_WORDS = ["shortcoming", "weakness"]
MIN_VERDICT_LENGTH = 60

_BLANK = r"[\s\x1c-\x1f]"


def any_of(patterns: Iterable[str]) -> str:
    """One pattern that finds what any of ``patterns`` finds."""
    return "(?:" + "|".join(patterns) + ")"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, rf"(?U)\A{_BLANK}+|{_BLANK}+\z", "")


def first_only(c: Column, pattern: str) -> Column:
    """Without the first match of ``pattern``, in which a dot matches newlines too."""
    return F.regexp_replace(c, rf"(?Us)\A(.*?){pattern}", "$1")


def replace_unless(c: Column, pattern: str, replacement: str, keep: Column | Iterable[str]) -> Column:
    """``replacement`` for each match of ``pattern`` that isn't in ``keep`` (words, or a function's Column).

    The text is split at the matches and put together again, so that no UDF is
    needed for a replacement that depends on the match.
    """
    words = sorted(set(keep))
    kept = (lambda m: m.isin(words)) if words else (lambda m: F.lit(False))
    parts = F.split(c, pattern, -1)
    found = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), lambda m: F.when(kept(m), m).otherwise(F.lit(replacement)))
    # one part more than matches: the last has no match after it
    joined = F.zip_with(parts, found, lambda p, m: F.concat(F.coalesce(p, F.lit("")), F.coalesce(m, F.lit(""))))
    return F.array_join(joined, "")


def sentences(c: Column) -> Column:
    """The sentences of a text: newlines are spaces, ends are stripped, none is empty; null has none."""
    marked = F.regexp_replace(F.coalesce(c, F.lit("")), r"""([.!?]["')\]]*)\s+([A-Z"'(\[])""", f"$1{_MARK}$2")
    flat = F.transform(F.split(marked, _MARK, -1), lambda s: F.trim(F.regexp_replace(s, r"\n", " ")))
    return F.filter(flat, lambda s: s != "")


def is_negative(c: Column, patterns: Iterable[str] = NEGATIVE_PATTERNS) -> Column:
    """Whether a sentence has any of the expressions, in either case."""
    return c.rlike("(?iU)" + any_of(patterns))


def is_verdict_only(c: Column, words: Iterable[str] = VERDICT_WORDS, min_length: int = MIN_VERDICT_LENGTH) -> Column:
    """Whether a sentence names a verdict (as part of a word, too) and is too short to say more."""
    lowered = F.lower(c)
    named = F.lit(False)
    for w in words:
        named = named | lowered.contains(w)
    return named & (F.length(strip(c)) < min_length)


def clean_for_encoding(c: Column, patterns: Iterable[str] = NOISE_PATTERNS) -> Column:
    """Lower case, fillers and runs of white space as one space, stripped."""
    return strip(F.regexp_replace(F.regexp_replace(F.lower(c), "(?U)" + any_of(patterns), " "), rf"(?U){_BLANK}+", " "))

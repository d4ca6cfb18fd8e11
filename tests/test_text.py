import random
import re

from evalspark.functions.text import NEGATIVE_PATTERNS, NOISE_PATTERNS, clean_for_encoding, first_only, is_negative, is_verdict_only, replace_unless, sentences, strip
from pyspark.sql import functions as F


def values(spark, rows, column):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, t string").orderBy("i").select(column(F.col("t"))).collect()]


def test_strip_is_pythons(spark):
    rows = ["  a ", " x ", "\x1c\x1fy\n\t", "", " \n ", "a b"]
    assert values(spark, rows, strip) == [r.strip() for r in rows]


def test_first_only(spark):
    rows = ["a Score: x\ny end. b Score: z end.", "no match", "Score: end."]
    assert values(spark, rows, lambda c: first_only(c, r"Score:.*?end\.")) == [re.sub(r"Score:.*?end\.", "", r, count=1, flags=re.DOTALL) for r in rows]


def test_replace_unless_equals_a_callback(spark):
    rng = random.Random(1)
    pattern, keep = r"\b[A-Z][a-z]{3,}\b", {"Kept", "Also"}
    rows = ["".join(rng.choice(["Kept ", "Name ", "Also", "x", "\n", "Éabc ", "Abcdé "]) for _ in range(20)) for _ in range(200)] + ["", "Name", "NameName"]
    want = [re.sub(pattern, lambda m: m[0] if m[0] in keep else "[N]", r) for r in rows]
    assert values(spark, rows, lambda c: replace_unless(c, "(?U)" + pattern, "[N]", keep)) == want
    assert values(spark, rows[:5], lambda c: replace_unless(c, "(?U)" + pattern, "[N]", [])) == [re.sub(pattern, "[N]", r) for r in rows[:5]]


def test_sentences(spark):
    rows = ['One. Two is\nhere! "Three?" (Four.) five. six', None, "", "  \n ", "No end"]
    assert values(spark, rows, sentences) == [["One.", "Two is here!", '"Three?"', "(Four.) five. six"], [], [], [], ["No end"]]


def test_filters_equal_python(spark):
    rng = random.Random(2)
    words = "shortcomings weakness limited limits limitation incrementally lacking lack insufficiently unclear vague vagueness not sufficiently fully described however this is a weakness as result moreover adequately Slack delimit".split()
    rows = [" ".join(rng.choices(words, k=rng.randint(1, 12))).capitalize() + rng.choice([".", "  x y ", "\nz"]) for _ in range(300)]
    negative = re.compile("|".join(NEGATIVE_PATTERNS), re.IGNORECASE)
    noise = re.compile("|".join(NOISE_PATTERNS))
    assert values(spark, rows, is_negative) == [bool(negative.search(r)) for r in rows]
    assert values(spark, rows, is_verdict_only) == [any(w in r.lower() for w in ("shortcoming", "weakness")) and len(r.strip()) < 60 for r in rows]
    assert values(spark, rows, clean_for_encoding) == [re.sub(r"\s+", " ", noise.sub(" ", r.lower())).strip() for r in rows]

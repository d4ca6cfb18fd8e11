import base64
import random
import re

import pytest
from evalspark.operators import privacy as p
from pyspark.sql import functions as F

KEY = bytes(range(16))


def test_roundtrip_layout_nulls_and_wrong_tags(spark):
    df = spark.createDataFrame([("123456789", None, "Ti"), (None, "", "é")], "Number string, Acronym string, Title string")
    coded = p.encrypted(df, p.SENSITIVE, KEY).cache()
    assert len(coded.first()["Number"]) == 2 * (12 + 9 + 16) and coded.first()["Number"] == coded.first()["Number"].lower()
    assert sorted(p.decrypted(coded, key=KEY).collect(), key=str) == sorted(df.collect(), key=str)
    assert p.decrypted(coded, key=None) is coded
    wrong = p.decrypted(coded, ["Title"], bytes(16), lenient=True).collect()
    assert all(r["Title"] is None for r in wrong)
    with pytest.raises(Exception, match="AES"):
        p.decrypted(coded, ["Title"], bytes(16)).collect()


def test_key_is_in_no_plan(spark, capsys):
    key = b"sixteen byte key"
    p.encrypted(spark.createDataFrame([("a",)], "Title string"), ["Title"], key).explain(True)
    shown = capsys.readouterr().out
    assert key.decode() not in shown and key.hex() not in shown.lower() and base64.b64encode(key).decode() not in shown


def test_key_loading(monkeypatch):
    monkeypatch.setenv("K", base64.urlsafe_b64encode(KEY).decode())
    assert p.load_key("K") == KEY and p.load_key("ABSENT") is None and len(p.generate_key()) == 16
    with pytest.raises(ValueError):
        p.checked_key(b"short")


def masked(text, number, acronym, title, keep_words, keep):
    """Plain Python version."""
    if not text:
        return ""
    for v, m in ((number, p.NUMBER), (acronym, p.ACRONYM), (title, p.TITLE)):
        if v and v != p.NOT_FOUND:
            text = text.replace(v, m)
    text = re.sub(p.NAME_IN_CONTEXT.removeprefix("(?U)"), lambda m: m[0] if m[0] in keep_words else p.NAME, text)
    text = re.sub(p.TWO_CAPITALS.removeprefix("(?U)"), p.NAME, text)
    return re.sub(p.CAPITALS.removeprefix("(?U)"), lambda m: m[0] if m[0] in keep else p.NAME, text)


def test_masks_equal_python(spark):
    rng = random.Random(4)
    parts = ["Maria ", "Work ", "The ", "HORIZON ", "CNR ", "AI4EU ", "OW2 ", "GAIA-X ", ". ", "\n", "ACR ", "12345 ", "A title ", "éMaria ", "Mariaé ", "[NAME] ", "IBM IBM ", "EU-X1 Z9 ", "x", "? Then "]
    rows = [("".join(rng.choices(parts, k=rng.randint(1, 25))), rng.choice(["12345", None, p.NOT_FOUND, ""]), rng.choice(["ACR", None]), rng.choice(["A title", None])) for _ in range(400)]
    rows += [(None, "1", "a", "b"), ("", None, None, None), ("Maria", None, None, None), (" Maria", None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, n string, a string, ti string")
    got = [r[0] for r in df.orderBy("i").select(p.mask_text(F.col("t"), F.col("n"), F.col("a"), F.col("ti"), entities=["HORIZON"])).collect()]
    assert got == [masked(*r, set(p.KEPT_WORDS), set(p.KEPT_CAPITALS) - {"HORIZON"}) for r in rows]


def test_anonymize_forms(spark):
    wide = spark.createDataFrame([("1", "AC", "T", "near Maria and AC", "x", None)], "Number string, Acronym string, Title string, C_Excellence string, C_Impact string, C_Implement string")
    out = p.anonymize(wide).first()
    assert out["C_Excellence"] == "near [NAME] and [ACRONYM]" and out["C_Implement"] == "" and out["Number"] == "1"
    coded = p.anonymize(wide, KEY, encrypt=True).first()
    assert coded["Number"] != "1" and coded["Title"] != "T"
    lists = spark.createDataFrame([(["see Maria", "AC"], "AC"), (None, "B")], "Criterion array<string>, Acronym string")
    assert [r["Criterion"] for r in p.anonymize(lists).collect()] == [["see [NAME]", "[ACRONYM]"], None]
    with pytest.raises(ValueError):
        p.anonymize(wide, None, encrypt=True)

import numpy as np
import pytest
from evalspark.operators.classify import UNCLASSIFIED, classify_sentences, cosine, flag_outliers_and_ambiguous, negative_sentences, score_topics, select_blocks, top_matches
from evalspark.operators.report import activity_summary, block_weights, occurring, pivot_block, raw_sheet, workbook_sheets
from evalspark.operators.stats import exact_quantiles
from evalspark.operators.topics import TOPICS, HashingEncoder, encoded, topic_catalog, topic_index
from evalspark.schema import CLASSIFIED_SCHEMA, RESULT_COLUMNS
from pyspark.sql import functions as F

CL = "sentence string, primary_topic string, primary_val double, secondary_topic string, secondary_val double, Call string, Activity string, Number string, Score double, Block string"


def row(s, t, v, t2=None, v2=None, call="C", act="A", num="1", score=1.0, block="C_Excellence"):
    return (s, t, v, t2, v2, call, act, num, score, block)


def test_cosine(spark):
    rng = np.random.default_rng(0)
    rows = [(rng.normal(size=5).tolist(), rng.normal(size=5).tolist()) for _ in range(20)] + [([0.0] * 5, [1.0] * 5)]
    got = [r[0] for r in spark.createDataFrame(rows, "a array<double>, b array<double>").coalesce(1).select(cosine(F.col("a"), F.col("b"))).collect()]
    want = [0.0 if not any(a) else float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)) for a, b in rows]
    assert np.allclose(got, want)


def test_ranking_ties_threshold_and_single_topic(spark):
    index = spark.createDataFrame([("B", 0, "x", [1.0, 0.0]), ("B", 1, "y", [1.0, 0.0]), ("B", 2, "z", [0.0, 1.0]), ("S", 0, "only", [1.0, 0.0])], "Block string, topic_ord int, topic string, vec array<double>")
    df = spark.createDataFrame([(1, "B", [1.0, 0.1]), (2, "B", [-1.0, -1.0]), (3, "S", [1.0, 1.0]), (4, "none", [1.0, 1.0])], "id int, Block string, vec array<double>")
    out = {r["id"]: r for r in score_topics(df, index).withColumn("m", top_matches(F.col("ranked"), 2, 0.3)).collect()}
    assert [t["topic"] for t in out[1]["ranked"]] == ["x", "y", "z"] and [m["topic"] for m in out[1]["m"]] == ["x", "y"]
    assert [m["topic"] for m in out[2]["m"]] == [UNCLASSIFIED] and len(out[3]["ranked"]) == 1 and 4 not in out
    full = df.selectExpr("*", "'s' AS sentence", "'c' AS Call", "'a' AS Activity", "'1' AS Number", "1.0D AS Score")
    got = classify_sentences(full, index, top_k=2).collect()
    # sentence 1 has two matches and so two equal rows
    assert sorted(r["primary_topic"] for r in got) == ["only", "x", "x", "x"]
    assert [r["secondary_topic"] for r in got if r["primary_topic"] == "only"] == [None]
    assert "vec" in classify_sentences(full, index, keep_embeddings=True).columns
    assert [f.name for f in CLASSIFIED_SCHEMA] == classify_sentences(full, index).columns


def statuses(rows, multiplier=1.5, ratio=0.98):
    d = [1 - r[2] for r in rows]
    out = []
    for i, r in enumerate(rows):
        group = [d[j] for j in range(len(rows)) if rows[j][1] == r[1] and r[1] is not None]
        q1, q3 = np.percentile(group, [25, 75]) if len(group) >= 4 else (0, float("inf"))
        d2 = None if r[4] is None else 1 - r[4]
        ambiguous = d2 is not None and (d[i] / d2 > ratio if d2 else d[i] > 0)
        out.append("Outlier" if len(group) >= 4 and d[i] > q3 + multiplier * (q3 - q1) else "Ambiguous" if ambiguous else "Valid")
    return out


def test_flags_equal_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [row(f"s{i}", f"t{rng.integers(0, 6)}", float(rng.normal(0.7, 0.1)), "u", float(rng.normal(0.6, 0.12)), num=str(i)) for i in range(200)]
    rows += [row("three", "small", 0.1), row("t2", "small", 0.9), row("t3", "small", 0.9), row("zero", "q", 1.0, "u", 1.0), row("inf", "q", 0.5, "u", 1.0), row("null", None, 0.5, "u", 0.5)]
    out = {r["sentence"]: r["classification_status"] for r in flag_outliers_and_ambiguous(spark.createDataFrame(rows, CL)).collect()}
    assert out == dict(zip([r[0] for r in rows], statuses(rows), strict=True))
    assert out == {r["sentence"]: r["classification_status"] for r in flag_outliers_and_ambiguous(spark.createDataFrame(rows, CL), bracketed=True).collect()}
    assert "Outlier" in out.values() and "Ambiguous" in out.values()
    empty = flag_outliers_and_ambiguous(spark.createDataFrame([], CL))
    assert empty.collect() == [] and "classification_status" in empty.columns
    assert {"dist_primary", "ambiguity_ratio"} <= set(flag_outliers_and_ambiguous(spark.createDataFrame(rows, CL), keep_intermediate=True).columns)


def test_distance_at_the_fence_is_no_outlier(spark):
    rows = [row(f"s{i}", "t", v) for i, v in enumerate([1.0, 0.75, 0.5, 0.25])]
    assert {r["classification_status"] for r in flag_outliers_and_ambiguous(spark.createDataFrame(rows, CL), iqr_multiplier=0.25).collect()} == {"Valid", "Outlier"}
    assert {r["classification_status"] for r in flag_outliers_and_ambiguous(spark.createDataFrame(rows, CL), iqr_multiplier=0.5).collect()} == {"Valid"}


STATUS = CL + ", classification_status string"
ROWS = [
    (*row("a", "x", 0.9, "y", 0.5), "Valid"),
    (*row("b", "x", 0.6, "y", 0.59, num="2"), "Ambiguous"),
    (*row("out", "x", 0.1, "y", 0.05, num="3"), "Outlier"),
    (*row("a", "x", 0.9, "y", 0.5), "Valid"),
    (*row("n", "y", 0.7, "x", 0.1, score=None), "Valid"),
    (*row("i", "z", 0.7, "x", 0.1, act="B", block="C_Impact"), "Valid"),
]


def test_sheets(spark):
    df = spark.createDataFrame(ROWS, STATUS)
    raw = raw_sheet(df)
    assert raw.columns == RESULT_COLUMNS
    assert sorted((r["sentence"], r["keyword"], r["dist"]) for r in raw.collect()) == [("a", "x", 0.9), ("a", "x", 0.9), ("b", "x", 0.6), ("b", "y", 0.59), ("i", "z", 0.7), ("n", "y", 0.7)]
    weights = block_weights(df, "C_Excellence")
    assert sorted((r["sentence"], r["keyword"], r["dist"]) for r in weights.collect()) == [("a", "x", 1.0), ("a", "x", 1.0), ("b", "x", 0.5), ("b", "y", 0.5), ("n", "y", 1.0)]
    pivoted = pivot_block(weights, ["x", "y", "z"])
    # equal rows are one, and a null score leaves the sheet
    assert sorted((r["sentence"], r["x"], r["y"], r["z"]) for r in pivoted.collect()) == [("a", 1.0, 0.0, 0.0), ("b", 0.5, 0.5, 0.0)]
    assert "z" not in occurring(pivoted, ["x", "y", "z"]).columns
    summary = activity_summary(pivoted, ["x", "y", "z"], 10).first()
    assert (summary["Activity"], summary["x"], summary["y"], summary["Top_10_Sentences"]) == ("A", 0.75, 0.25, "- a\n- b")
    assert activity_summary(pivoted, ["x"], 1).first()["Top_1_Sentences"] == "- a"
    sheets = workbook_sheets(df, {b: dict.fromkeys("xyz", "") for b in ("C_Excellence", "C_Impact", "C_Implement")})
    assert list(sheets) == ["All_raw_data", "Excellence", "Impact", "Implementation", "Excellence_Summary", "Impact_Summary", "Implementation_Summary"]
    assert {k: v.count() for k, v in sheets.items()} == {"All_raw_data": 6, "Excellence": 2, "Impact": 1, "Implementation": 0, "Excellence_Summary": 1, "Impact_Summary": 1, "Implementation_Summary": 0}
    # flags off: all rows are valid
    assert raw_sheet(df.drop("classification_status")).count() == 6


def test_results_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(ROWS * 5, STATUS)
    one = [activity_summary(pivot_block(block_weights(df.repartition(n), "C_Excellence"), ["x", "y"]), ["x", "y"]).collect() for n in (1, 7)]
    assert one[0] == one[1]


def test_blocks_and_negative_sentences(spark):
    reports = spark.createDataFrame([("C", "A", 7, 1.0, 2.0, None, "It lacks depth. Good. A weakness.", "Unclear plan for the whole consortium and its partners, with a weakness in governance.", None)], "Call string, Activity string, Number long, S_Excellence double, S_Impact double, S_Implement double, C_Excellence string, C_Impact string, C_Implement string")
    out = sorted((r["Block"], r["sentence"], r["Score"], r["Number"]) for r in negative_sentences(select_blocks(reports)).collect())
    assert [(b, n) for b, _, _, n in out] == [("C_Excellence", "7"), ("C_Impact", "7")] and out[0][1] == "It lacks depth."
    with pytest.raises(ValueError):
        select_blocks(reports, ["C_Other"])
    with pytest.raises(KeyError):
        select_blocks(reports.drop("Call"))


def test_catalog_and_encoder(spark):
    assert [len(t) for t in TOPICS.values()] == [10, 11, 14] and len({t for b in TOPICS.values() for t in b}) == 35
    index = topic_index(topic_catalog(spark), HashingEncoder(32))
    assert index.count() == 35 and len(index.first()["vec"]) == 32
    v = HashingEncoder(64).encode(["same words", "words same", "", "other"])
    assert np.allclose(v[0], v[1]) and not v[2].any() and not np.allclose(v[0], v[3])
    assert encoded(spark.createDataFrame([(None,)], "t string"), "t", HashingEncoder(8)).first()["vec"] == [0.0] * 8


def test_exact_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [(g, float(v)) for g, n in (("a", 1), ("b", 2), ("c", 7), ("d", 1000), ("e", 30_000)) for v in rng.normal(size=n).round(3)] + [("a", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    for whole in (10**6, 100):  # all groups whole, or the larger ones by brackets
        out = {r["g"]: r for r in exact_quantiles(df, "g", "v", {"q1": 0.25, "q3": 0.75}, whole=whole, accuracy=2000).collect()}
        for g in "abcde":
            own = [v for k, v in rows if k == g and v is not None]
            assert out[g]["n"] == len(own) and np.allclose([out[g]["q1"], out[g]["q3"]], np.percentile(own, [25, 75]), rtol=0, atol=1e-12)

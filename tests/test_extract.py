import re

import pytest
from evalspark.operators.extract import extract_reports
from evalspark.schema import ERROR_MEANINGS, NOT_FOUND, REPORT_SCHEMA

HEAD = "Call: HORIZON-X\nType of action: {kind}\nProposal number: 101012345\nProposal acronym: ACR-1\nTitle: A long\ntitle here\nActivity: ACT.1\nAbstract: Some\nabstract.  Evaluation Summary Report\n"
BODY = """Criterion 1 - Excellence
Score: (Threshold: 3/5) 4.5000 text {e1} First \t point.
- bullet Score: kept {e1}
Criterion 2 - Impact
Score: 3.25 more {e2} Second.
Criterion 3 - Quality and efficiency of the implementation
Score: 5 none Score: 2.5 x {e3} Third.
Scope of the proposal
end"""
ENDS = {"HORIZON-CSA": ("methodology.", "activities.", "expertise."), "HORIZON-FPA": ("objectives", "and impacts specified in the work programme.", "participants"), "HORIZON-RIA": ("appropriate.", "activities.", "expertise.")}


def extracted(spark, *texts):
    rows = [(i, t, t is not None) for i, t in enumerate(texts)]
    return [r.asDict() for r in extract_reports(spark.createDataFrame(rows, "id int, text string, ok boolean"), pdf_ok="ok").orderBy("id").collect()]


@pytest.mark.parametrize("kind", ENDS)
def test_complete_report(spark, kind):
    e1, e2, e3 = ENDS[kind]
    r = extracted(spark, HEAD.format(kind=kind) + BODY.format(e1=e1, e2=e2, e3=e3))[0]
    assert (r["Call"], r["Type"], r["Number"], r["Acronym"], r["Title"], r["Activity"], r["Abstract"]) == ("HORIZON-X", kind, "101012345", "ACR-1", "A long\ntitle here", "ACT.1", "Some\nabstract.")
    assert r["Total Score"] == 10.25 and (r["S_Excellence"], r["S_Impact"], r["S_Implement"]) == (4.5, 3.25, 2.5)
    assert r["C_Excellence"] == f"First point.\nbullet Score: kept {e1}"
    assert (r["C_Impact"], r["C_Implement"]) == ("Second.", "Third.")
    assert r["error_code"] == 0


def test_error_codes_last_wins(spark):
    full = HEAD.format(kind="HORIZON-RIA") + BODY.format(e1="appropriate.", e2="activities.", e3="expertise.")
    no_title = full.replace("Title:", "Tilte:")
    no_scores = re.sub(r"\d\.\d+", "4", full)
    three = full.replace("Scope of the proposal", "")
    rows = extracted(spark, full, no_title, no_scores, three, None, "")
    assert [r["error_code"] for r in rows] == [0, 2, 3, 4, 4, 4]
    assert rows[1]["Title"] == NOT_FOUND and not rows[1]["basic_ok"] and rows[1]["criteria_ok"]
    assert rows[2]["Total Score"] == 0.0 and rows[2]["S_Excellence"] is None
    assert rows[3]["C_Excellence"] == "" and not rows[4]["pdf_ok"] and rows[5]["pdf_ok"]
    assert len(ERROR_MEANINGS) == 5


def test_footer_across_lines_and_integer_scores(spark):
    text = "a 101012345/part-x\ny-01/02/2020-10:11:12\n 3\n/ 17 b 12345678/q-01/02/2020-10:11:12 1 / 2 c\nScore: 4"
    r = extracted(spark, "Call: " + text.replace("a ", "k", 1))[0]
    assert r["Call"] == "k" and not r["score_ok"]


def test_schema_and_other_columns(spark):
    df = extract_reports(spark.createDataFrame([("z.zip", "x")], "archive string, text string"))
    assert [f.name for f in REPORT_SCHEMA] == df.columns[1:15] and df.columns[0] == "archive"
    assert extract_reports(spark.createDataFrame([], "archive string, text string")).collect() == []

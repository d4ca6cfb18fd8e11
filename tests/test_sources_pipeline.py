import io
import zipfile
import zlib

import pytest
from evalspark import cli
from evalspark.operators.summarize import OUT_OF_MEMORY, ExtractiveSummarizer, build_prompt, generate_all, summarize, summarize_sheets
from evalspark.plans.pipeline import EvaluationPipeline
from evalspark.operators.stats import observed
from evalspark.schema import REPORT_SCHEMA, report_frame, without_nan
from evalspark.sources.archives import Limits, PlainTextDecoder, SimplePdfDecoder, copy_files, error_log, expand_archives, file_log, read_archives, walk_archive
from evalspark.sources.tables import convert_workbook, export, load, result_path, save_results, write_tables
from evalspark.sources.xlsx import read_workbook, write_workbook
from evalspark.streaming.ingest import flags_by_batch, stream_reports, to_table
from test_classify_report import CL, ROWS, STATUS
from test_extract import BODY, ENDS, HEAD


def zipped(**files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in files.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), content)
    return out.getvalue()


def report(number="101012345", kind="HORIZON-RIA"):
    e1, e2, e3 = ENDS[kind]
    text = HEAD.format(kind=kind).replace("101012345", number) + BODY.format(e1=e1, e2=e2, e3=e3)
    return text.replace("Second.", "The plan is unclear and lacks a schedule. It shows a serious weakness in the way that risks are handled over time.")


@pytest.fixture
def folder(tmp_path):
    inner = zipped(deep__one_ESR_dot_pdf=report("100000001"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.ZIP").write_bytes(zipped(x__esr_dot_pdf=report(), inner_dot_zp=inner, notes_dot_txt="no", broken_dot_zip=b"junk"))
    (tmp_path / "in/b.zip").write_bytes(zipped(y__esr_dot_pdf=report("100000002")))
    (tmp_path / "in/bad.zip").write_bytes(b"not a zip")
    (tmp_path / "in/other.txt").write_text("x")
    return tmp_path


def test_archives(spark, folder):
    entries = expand_archives(read_archives(spark, str(folder / "in"))).cache()
    good = entries.where("error IS NULL")
    assert sorted(r["entry"] for r in good.collect()) == ["inner.zp!deep/one_ESR.pdf", "x/esr.pdf", "y/esr.pdf"]
    assert error_log(entries).count() == 2
    log = {(r["ZIP"], r["stored_as"]) for r in file_log(entries).collect()}
    assert log == {("a.ZIP", "esr.pdf"), ("b.zip", "esr_1.pdf"), ("a.ZIP", "one_ESR.pdf")}
    assert copy_files(entries, str(folder / "files")).count() == 3
    assert sorted(p.name for p in (folder / "files").iterdir()) == ["esr.pdf", "esr_1.pdf", "one_ESR.pdf"]


def test_limits():
    nested = zipped(a_esr_dot_pdf="x")
    for _ in range(4):
        nested = zipped(n_dot_zip=nested)
    assert [e for *_, e in walk_archive(nested)] == [None]
    assert "deeper" in [e for *_, e in walk_archive(nested, limits=Limits(depth=2))][0]
    assert [e is None for *_, e in walk_archive(zipped(a_esr_dot_pdf="x" * 99, b_esr_dot_pdf="x"), limits=Limits(entry_bytes=10))] == [False, True]


def test_decoders():
    page = zlib.compress(b"BT (Call: C\\(1\\)) Tj 0 -1 Td <4869> Tj ET")
    pdf = b"%PDF-1.4\n1 0 obj << /Filter /FlateDecode >>\nstream\n" + page + b"\nendstream\nendobj"
    assert SimplePdfDecoder().decode(pdf) == ("Call: C(1)\nHi\n", True)
    assert SimplePdfDecoder().decode(b"dummy") == ("", False)
    assert PlainTextDecoder().decode(b"\xff")[1] is False


def test_pipeline_end_to_end(spark, folder):
    pipeline = EvaluationPipeline(spark)
    run = pipeline.run(str(folder / "in"), extract_options={"mask": True})
    assert run.extraction.reports.count() == 3 and {r["error_code"] for r in run.extraction.reports.collect()} == {0}
    assert run.classified.count() == 6 and {r["Block"] for r in run.classified.collect()} == {"C_Impact"}
    text = run.summaries["Impact_Summary"].first()
    assert text["LLM_Summary"] and "LLM_Summary" not in run.summaries["Impact"].columns
    skipped = pipeline.run(reports=run.extraction.reports, classify=False)
    assert skipped.classified is None and skipped.summaries is None
    with pytest.raises(ValueError):
        pipeline.run()
    given = pipeline.index
    assert EvaluationPipeline(spark, index=given).index is given
    earlier = pipeline.extract(str(folder / "in/b.zip"), earlier=run.extraction.reports.select("Number", "C_Impact"))
    assert earlier.reports.count() == 4


def test_workbooks(spark, tmp_path):
    df = spark.createDataFrame([("a<&>\"é\n", 1.5, None, True), (None, 2.0, 7, False)], "t string, d double, i long, b boolean")
    path = str(tmp_path / "w.xlsx")
    assert write_workbook({"One": df, "Empty": df.limit(0)}, path) == ["One"]
    assert write_workbook({"One": df, "Empty": df.limit(0)}, path, skip_empty=False) == ["One", "Empty"]
    back = read_workbook(spark, path)
    assert list(back) == ["One", "Empty"] and [tuple(r) for r in back["One"].collect()] == [("a<&>\"é\n", "1.5", None, "1"), (None, "2.0", "7", "0")]
    assert back["Empty"].columns == ["t", "d", "i", "b"] and back["Empty"].count() == 0
    assert list(read_workbook(spark, path, "One")) == ["One"] and list(read_workbook(spark, path, 1)) == ["Empty"]
    with pytest.raises(KeyError):
        read_workbook(spark, path, "Absent")
    target = convert_workbook(spark, path, str(tmp_path / "v.xlsx"), lambda x: x.select("t"))
    assert load(spark, target).columns == ["t"]


def test_exports_and_paths(spark, tmp_path):
    df = spark.createDataFrame([("x,\"y\"\nz", "1")], "a string, b string")
    for name in ("t.csv", "t.parquet", "t.xlsx"):
        assert load(spark, export(df, str(tmp_path / name))).collect() == df.collect()
    for bad in ("t.doc", "t"):
        with pytest.raises(ValueError):
            export(df, bad)
    assert result_path(None, "excel") == "classified_all_results.xlsx" and result_path("a/b.x", "both") == "a/b.parquet"
    classified = spark.createDataFrame(ROWS, STATUS)
    topics = {b: dict.fromkeys("xyz", "") for b in ("C_Excellence", "C_Impact", "C_Implement")}
    made = save_results(classified, str(tmp_path / "r.xlsx"), "both", topics)
    assert load(spark, made[0]).columns == classified.columns and "Implementation" not in read_workbook(spark, made[1])
    with pytest.raises(ValueError):
        save_results(classified, None, "pdf")
    assert set(write_tables({"a": df, "none": df.limit(0)}, str(tmp_path / "tables"))) == {"a"}
    assert without_nan(spark.createDataFrame([(float("nan"),)], "x double")).first()["x"] is None


def test_summaries(spark):
    class Small:
        calls: list = []

        def generate(self, prompts):
            if len(prompts) > 1 or "huge" in prompts[0]:
                raise MemoryError
            return [f"S{len(p)}" for p in prompts]

    out = generate_all(Small(), ["one", None, " ", "huge", "two"], 4)
    assert out[1] == out[2] == "" and out[3] == OUT_OF_MEMORY and out[0].startswith("S") and out[4].startswith("S")
    assert build_prompt(3) == "" and build_prompt("x").endswith("\n\nx")
    df = spark.createDataFrame([("- a b\n- c",), (None,)], "t string")
    assert [r["LLM_Summary"] for r in summarize(df, "t", ExtractiveSummarizer(2)).collect()] == ["a b", ""]
    assert summarize(df, "absent") is df
    sheets = summarize_sheets({"x": df, "y": df}, "t", "x")
    assert "LLM_Summary" in sheets["x"].columns and "LLM_Summary" not in sheets["y"].columns


def test_streams(spark, folder):
    stream = stream_reports(spark, str(folder / "in"), PlainTextDecoder())
    to_table(stream, str(folder / "out"), str(folder / "cp")).awaitTermination()
    assert spark.read.parquet(str(folder / "out")).count() == 3
    rows = spark.createDataFrame([r[:-1] for r in ROWS], CL)
    rows.write.parquet(str(folder / "cl"))
    seen = []
    flags_by_batch(spark.readStream.schema(rows.schema).parquet(str(folder / "cl")), str(folder / "history"), lambda df: seen.append(df.count()), str(folder / "cp2")).awaitTermination()
    assert seen[-1] == len(ROWS)


def test_command_line(spark, folder, monkeypatch):
    monkeypatch.setattr(cli, "local_session", lambda: spark)
    monkeypatch.setattr(cli, "SimplePdfDecoder", PlainTextDecoder)
    out = str(folder / "o")
    assert cli.main(["--log-level", "DEBUG", "full", "--input-folder", str(folder / "in"), "--output-dir", out]) == 0
    assert "LLM_Summary" in load(spark, f"{out}/classified_with_summary.xlsx", "Impact_Summary").columns
    assert cli.main(["extract", "--zips", str(folder / "in/b.zip"), "--output-dir", f"{out}2", "--export", f"{out}/e.csv"]) == 0
    assert load(spark, f"{out}/e.csv").count() == 1
    assert cli.main(["classify", "--input", f"{out}/extracted", "--output", f"{out}/c", "--output-format", "parquet", "--no-flag-outliers"]) == 0
    assert cli.main(["summarize", "--input", f"{out}/classified.xlsx", "--output", f"{out}/s.xlsx"]) == 0
    assert cli.parser().parse_args(["--log-level", "DEBUG", "extract"]).log_level == "DEBUG"
    with pytest.raises(SystemExit):
        cli.main(["extract"])
    with pytest.raises(ValueError):
        cli.main(["extract", "--zips", str(folder / "in/b.zip"), "--encrypt", "--aesgcm-key-env", "ABSENT"])


def test_records_and_counts(spark):
    frame = report_frame(spark, [{"Call": "C", "Number": 101012345, "Total Score": 14.5, "S_Impact": float("nan"), "other": 1}])
    row = frame.first()
    assert (row["Number"], row["Total Score"], row["S_Impact"], row["Title"]) == ("101012345", 14.5, None, None)
    assert report_frame(spark, []).schema == REPORT_SCHEMA and report_frame(spark, []).count() == 0
    df, seen = observed(frame)
    df.collect()
    assert seen.get == {"n": 1}


def test_texts_longer_than_a_cell_are_an_error(spark, tmp_path):
    path = str(tmp_path / "long.xlsx")
    texts = lambda n: spark.createDataFrame([("x" * n,)], "t string")
    write_workbook({"s": texts(32_767)}, path)
    assert len(read_workbook(spark, path)["s"].first()["t"]) == 32_767
    with pytest.raises(ValueError, match="write_tables"):
        write_workbook({"s": texts(32_768)}, path)

"""Report text to typed fields, scores and criterion texts, with error codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions.text import first_only, strip
from evalspark.schema import BLOCKS, ERROR_MEANINGS, NOT_FOUND, SCORE_OF_BLOCK, UNKNOWN_ERROR

#: The page footer; each field's expression (group 1); scores and thresholds; criterion headings.
FOOTER = r"\d{8,9}/.*?-\d{2}/\d{2}/\d{4}-\d{2}:\d{2}:\d{2}\s+\d+\s+/\s*\d+"
FIELD_PATTERNS = {
    "Call": r"Call: (\S+)",
    "Type": r"Type of action: (\S+)",
    "Number": r"Proposal number: (\d+)",
    "Acronym": r"Proposal acronym: ([a-zA-Z0-9 ._-]+)",
    "Title": r"(?:Proposal )?[Tt]itle:\s*([\s\S]+?)(?:\n[A-Z][^:\n]+:|$)",
    "Activity": r"Activity: (\S+)",
    "Abstract": r"Abstract:\s*(.*?)\s*Evaluation Summary Report",
}
SCORE = r"Score:\s*(\d+\.\d{1,4})"
THRESHOLD = r"\(Threshold:.*?\)"
HEADINGS = r"Criterion 1 - Excellence|Criterion 2 - Impact|Criterion 3 - Quality and efficiency of the implementation|Scope of the (?:application|proposal)"
#: Where the boilerplate after a criterion's score ends, by type of action.
ENDS_BY_TYPE = {
    "HORIZON-CSA": [r"methodology\.", r"activities\.", r"expertise\."],
    "HORIZON-FPA": ["objectives", r"and impacts specified in the work programme\.", "participants"],
}
ENDS = [r"appropriate\.", r"activities\.", r"expertise\."]


def strip_footer(text: Column) -> Column:
    """Without page footers, also those that a line break parts."""
    return F.regexp_replace(text, "(?Us)" + FOOTER, "")


def field(text: Column, name: str) -> Column:
    """A field's first match, or null."""
    pattern = ("(?Us)" if name == "Abstract" else "(?Ud)") + FIELD_PATTERNS[name]
    return F.when(F.regexp_like(text, F.lit(pattern)), F.regexp_extract(text, pattern, 1))


def without_thresholds(text: Column) -> Column:
    return F.regexp_replace(text, "(?Ud)" + THRESHOLD, "")


def scores(text: Column) -> Column:
    """All scores with a decimal point, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit("(?Ud)" + SCORE), F.lit(1)), lambda s: s.try_cast("double"))


def criterion_part(parts: Column, index: int) -> Column:
    """The index-th criterion between the headings, with single blanks and without list marks."""
    return F.regexp_replace(F.regexp_replace(F.get(parts, F.lit(index + 1)), r"[ \t]+", " "), r"\n- ", "\n")


def criterion(part: Column, kind: Column, index: int) -> Column:
    """A criterion's part without its score's boilerplate."""
    cleaned = first_only(part, "Score:.*?" + ENDS[index])
    for name, ends in ENDS_BY_TYPE.items():
        cleaned = F.when(kind == name, first_only(part, "Score:.*?" + ends[index])).otherwise(cleaned)
    return strip(cleaned)


def error_code(pdf_ok: Column, basic_ok: Column, score_ok: Column, criteria_ok: Column) -> Column:
    """The last stage that failed."""
    return F.when(~criteria_ok, 4).when(~score_ok, 3).when(~basic_ok, 2).when(~pdf_ok, 1).otherwise(0)


def error_message(code: Column) -> Column:
    out = F.lit(UNKNOWN_ERROR)
    for k, v in ERROR_MEANINGS.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def is_valid(code: Column) -> Column:
    return code == 0


def united(new: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """New and earlier reports by column names; a column that one lacks is null there."""
    return new if earlier is None else new.unionByName(earlier, allowMissingColumns=True)


def extract_reports(texts: DataFrame, text: str = "text", pdf_ok: str | None = None) -> DataFrame:
    """One report row for each text; other columns stay in front.

    ``pdf_ok`` names a boolean column that says whether the text was read well.
    A null text is the empty text of a file that couldn't be read.
    """
    read_ok = F.coalesce(F.col(pdf_ok), F.lit(False)) if pdf_ok else F.col(text).isNotNull()
    kept = [c for c in texts.columns if c not in (text, pdf_ok)]
    base = texts.select(*[F.col(f"`{c}`") for c in kept], read_ok.alias("pdf_ok"), strip_footer(F.coalesce(F.col(text), F.lit(""))).alias("_text"))
    fields = base.select("*", *[field(F.col("_text"), n).alias(n) for n in FIELD_PATTERNS], without_thresholds(F.col("_text")).alias("_scored"))
    scored = fields.withColumn("_scores", scores(F.col("_scored")))
    # columns of their own, so that texts are split and cleaned once; criteria are null unless the headings part a text in 5
    split = scored.withColumn("_parts", F.split("_scored", HEADINGS, -1))
    split = split.withColumns({f"_part{i}": F.when(F.size("_parts") == 5, criterion_part(F.col("_parts"), i)) for i in range(len(BLOCKS))})
    texts3 = split.select("*", *[criterion(F.col(f"_part{i}"), F.col("Type"), i).alias(b) for i, b in enumerate(BLOCKS)])
    found = F.lit(True)
    for n in FIELD_PATTERNS:
        found = found & F.col(n).isNotNull()
    checked = texts3.select("*", found.alias("basic_ok"), (F.size("_scores") > 0).alias("score_ok"), F.col(BLOCKS[0]).isNotNull().alias("criteria_ok"))
    return checked.select(
        *[F.col(f"`{c}`") for c in kept],
        *[F.coalesce(n, F.lit(NOT_FOUND)).alias(n) for n in FIELD_PATTERNS],
        F.aggregate("_scores", F.lit(0.0), lambda a, x: a + x).alias("Total Score"),
        *[F.get("_scores", F.lit(i)).alias(s) for i, s in enumerate(SCORE_OF_BLOCK.values())],
        *[F.coalesce(b, F.lit("")).alias(b) for b in BLOCKS],
        error_code(F.col("pdf_ok"), F.col("basic_ok"), F.col("score_ok"), F.col("criteria_ok")).alias("error_code"),
        "pdf_ok",
        "basic_ok",
        "score_ok",
        "criteria_ok",
    )

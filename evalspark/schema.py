"""Schemas and fixed names of the data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What an absent field holds, and the names of blocks, criterion and score columns.
NOT_FOUND = "No encontrado"
BLOCKS = ["C_Excellence", "C_Impact", "C_Implement"]
SCORE_OF_BLOCK = {"C_Excellence": "S_Excellence", "C_Impact": "S_Impact", "C_Implement": "S_Implement"}
SHEET_OF_BLOCK = {"C_Excellence": "Excellence", "C_Impact": "Impact", "C_Implement": "Implementation"}
RAW_SHEET = "All_raw_data"
TEXT_FIELDS = ["Call", "Type", "Number", "Acronym", "Title", "Activity", "Abstract"]

#: Meanings of error codes; a later stage's code replaces an earlier one's.
ERROR_MEANINGS = {
    0: "OK - No errors detected.",
    1: "PDF - Error during PDF reading or content extraction.",
    2: "BasicInfo - Error extracting basic information (e.g., Call, Type, Number, Acronym, Title, Activity).",
    3: "Scores - Error extracting scores.",
    4: "Criteria - Error extracting criteria sections.",
}
UNKNOWN_ERROR = "Unknown Error Code"

_text = lambda *names: [T.StructField(n, T.StringType()) for n in names]
_double = lambda *names: [T.StructField(n, T.DoubleType()) for n in names]

#: The 14 fields of a report, in order.
REPORT_SCHEMA = T.StructType([*_text(*TEXT_FIELDS), *_double("Total Score", *SCORE_OF_BLOCK.values()), *_text(*BLOCKS)])

#: What is added to a report about where it comes from and what went wrong.
STATUS_FIELDS = ["source_path", "archive", "error_code", "pdf_ok", "basic_ok", "score_ok", "criteria_ok"]

CLASSIFIED_SCHEMA = T.StructType(
    [*_text("sentence", "primary_topic"), *_double("primary_val"), *_text("secondary_topic"), *_double("secondary_val"), *_text("Call", "Activity", "Number"), *_double("Score"), *_text("Block")]
)

#: Columns of the raw sheet, and the index of the block sheets.
RESULT_COLUMNS = ["sentence", "keyword", "dist", "Call", "Activity", "Number", "Score", "Block", "classification"]
PIVOT_INDEX = ["Activity", "Call", "Number", "Score", "Block", "classification", "sentence"]


def require_columns(df: DataFrame, names: list[str]) -> None:
    """KeyError naming the columns that ``df`` lacks."""
    if missing := [n for n in names if n not in df.columns]:
        raise KeyError(f"missing columns: {missing}")


def without_nan(df: DataFrame) -> DataFrame:
    """Null in place of NaN in all floating-point columns, for tables that come from pandas or spreadsheets."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({n: F.when(~F.isnan(F.col(f"`{n}`")), F.col(f"`{n}`")) for n in floats})


def report_frame(spark: SparkSession, records: list[dict]) -> DataFrame:
    """Reports from dictionaries: fields that a record lacks are null, others are ignored, none gives an empty table."""
    kinds = {f.name: float if isinstance(f.dataType, T.DoubleType) else str for f in REPORT_SCHEMA}
    missing = lambda v: v is None or v != v
    rows = [tuple(None if missing(r.get(n)) else kind(r[n]) for n, kind in kinds.items()) for r in records]
    return spark.createDataFrame(rows, REPORT_SCHEMA)

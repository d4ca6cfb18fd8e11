"""Loading and exporting of tables by file type, workbooks as folders of tables, and their paths."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession

from evalspark.operators.report import workbook_sheets
from evalspark.sources.xlsx import read_workbook, write_workbook


def _kind(path: str) -> str:
    return PurePosixPath(path.rstrip("/")).suffix.lower().lstrip(".")


def load(spark: SparkSession, path: str, sheet: str | int = 0, **options) -> DataFrame:
    """A table by its extension: parquet, csv (with header), json, xlsx. ValueError for another; a missing file is Spark's error."""
    match _kind(path):
        case "parquet" | "":
            return spark.read.parquet(path)
        case "csv":
            return spark.read.options(**({"header": True, "multiLine": True, "escape": '"'} | options)).csv(path)
        case "json" | "jsonl":
            return spark.read.options(**options).json(path)
        case "xlsx":
            return next(iter(read_workbook(spark, path, sheet).values()))
        case other:
            raise ValueError(f"unknown table type {other!r}: {path}")


def export(df: DataFrame, path: str, mode: str = "overwrite", **options) -> str:
    """Writes a table by its extension and returns the path. ValueError for an unknown one."""
    match _kind(path):
        case "parquet":
            df.write.mode(mode).options(**options).parquet(path)
        case "csv":
            df.write.mode(mode).options(**({"header": True, "escape": '"'} | options)).csv(path)
        case "xlsx" | "xls":
            write_workbook({"Sheet1": df}, path, skip_empty=False)
        case other:
            raise ValueError(f"unknown export type {other!r}: {path}")
    return path


def write_tables(sheets: dict[str, DataFrame], folder: str, mode: str = "overwrite", skip_empty: bool = True) -> dict[str, str]:
    """A workbook as a folder with a Parquet table per sheet: for results of any size."""
    paths = {}
    for name, df in sheets.items():
        if skip_empty and df.isEmpty():
            continue
        paths[name] = f"{folder.rstrip('/')}/{name}"
        df.write.mode(mode).parquet(paths[name])
    return paths


def result_path(output: str | None, kind: str) -> str:
    """Where results go: the given path with the right suffix, or the default name."""
    suffix = ".parquet" if kind in ("parquet", "both") else ".xlsx"
    if output is None:
        return f"classified_all_results{suffix}"
    return str(PurePosixPath(output).with_suffix(suffix))


def save_results(classified: DataFrame, output: str | None = None, kind: str = "excel", topics=None, top_n: int = 10) -> list[str]:
    """Parquet gets the classified table, Excel the sheets, "both" both. ValueError for another kind."""
    if kind not in ("parquet", "excel", "both"):
        raise ValueError(f"unknown output format {kind!r}")
    path, out = result_path(output, kind), []
    if kind in ("parquet", "both"):
        classified.write.mode("overwrite").parquet(path)
        out.append(path)
    if kind in ("excel", "both"):
        book = str(PurePosixPath(path).with_suffix(".xlsx"))
        write_workbook(workbook_sheets(classified, topics, top_n, only_occurring=True), book)
        out.append(book)
    return out


def convert_workbook(spark: SparkSession, source: str, target: str, change: Callable[[DataFrame], DataFrame], sheet: str | int | None = 0) -> str:
    """Reads sheets, applies ``change`` (for example masking or decryption) and writes them again."""
    write_workbook({k: change(v) for k, v in read_workbook(spark, source, sheet).items()}, target, skip_empty=False)
    return target

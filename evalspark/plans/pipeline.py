"""From archives to sheets and summaries: lazy DataFrames between stages, files only where asked for."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from evalspark.operators.classify import classify_reports, flag_outliers_and_ambiguous
from evalspark.operators.extract import extract_reports, united
from evalspark.operators.privacy import anonymize
from evalspark.operators.report import TOP_N, workbook_sheets
from evalspark.operators.summarize import Summarizer, summarize_sheets
from evalspark.operators.topics import Encoder, HashingEncoder, topic_catalog, topic_index
from evalspark.schema import BLOCKS, REPORT_SCHEMA, SHEET_OF_BLOCK
from evalspark.sources.archives import PlainTextDecoder, TextDecoder, decode_entries, error_log, expand_archives, file_log, read_archives


@dataclass
class Extraction:
    reports: DataFrame
    files: DataFrame
    errors: DataFrame


@dataclass
class Run:
    """What a run made; stages that were skipped are None."""

    extraction: Extraction | None = None
    classified: DataFrame | None = None
    sheets: dict[str, DataFrame] = field(default_factory=dict)
    summaries: dict[str, DataFrame] | None = None


class EvaluationPipeline:
    """Holds decoder, encoder, summarizer and topic index; every method returns lazy tables."""

    def __init__(self, spark: SparkSession, decoder: TextDecoder | None = None, encoder: Encoder | None = None, summarizer: Summarizer | None = None, index: DataFrame | None = None, topics: dict | None = None) -> None:
        self.spark, self.decoder, self.encoder = spark, decoder or PlainTextDecoder(), encoder or HashingEncoder()
        self.summarizer, self.topics = summarizer, topics
        self._index = index

    @property
    def index(self) -> DataFrame:
        """The topic index: the one given, or the catalog's, encoded once (it has a few dozen rows)."""
        if self._index is None:
            lazy = topic_index(topic_catalog(self.spark, self.topics), self.encoder)
            self._index = self.spark.createDataFrame(lazy.collect(), lazy.schema)
        return self._index

    def extract(self, archives: str | Iterable[str], suffix: str = "esr.pdf", earlier: DataFrame | None = None, mask: bool = False, key: bytes | None = None, encrypt: bool = False) -> Extraction:
        """Archives to reports. ``earlier`` reports are united with the new ones before masking, so none stays unmasked."""
        entries = expand_archives(read_archives(self.spark, archives), suffix)
        reports = united(extract_reports(decode_entries(entries, self.decoder), "text", "pdf_ok"), earlier)
        if mask or encrypt:
            reports = anonymize(reports, key, encrypt=encrypt)
        return Extraction(reports, file_log(entries), error_log(entries))

    def classify(self, reports: DataFrame, blocks: Iterable[str] = BLOCKS, flag: bool = True, rows: int | None = None, iqr_multiplier: float = 1.5, ratio_threshold: float = 0.98, **how) -> DataFrame:
        """Reports to classified sentences with their status. The encoder's result is kept, as several sheets read it."""
        found = classify_reports(reports, self.index, self.encoder, blocks, rows, **how)
        if not flag:
            return found
        # quartiles and rows read the encoded sentences both; the level spills and survives a lost executor by recomputation
        return flag_outliers_and_ambiguous(found.persist(StorageLevel.DISK_ONLY), iqr_multiplier=iqr_multiplier, ratio_threshold=ratio_threshold)

    def sheets(self, classified: DataFrame, top_n: int = TOP_N, **how) -> dict[str, DataFrame]:
        return workbook_sheets(classified, self.topics, top_n, **how)

    def summarize(self, sheets: dict[str, DataFrame], top_n: int = TOP_N, batch: int = 4) -> dict[str, DataFrame]:
        """Summaries of the top sentences in the summary sheets."""
        return summarize_sheets(sheets, f"Top_{top_n}_Sentences", [f"{s}_Summary" for s in SHEET_OF_BLOCK.values()], self.summarizer, batch)

    def run(self, archives: str | Iterable[str] | None = None, reports: DataFrame | None = None, classify: bool = True, summarize: bool = True, top_n: int = TOP_N, extract_options: dict | None = None, classify_options: dict | None = None) -> Run:
        """All stages or some: given reports win over archives; without classification there is nothing to summarize."""
        out = Run()
        if reports is None:
            if archives is None:
                raise ValueError("neither archives nor reports were given")
            out.extraction = self.extract(archives, **(extract_options or {}))
            reports = out.extraction.reports
        if classify:
            out.classified = self.classify(reports.select(*[f"`{f.name}`" for f in REPORT_SCHEMA]), **(classify_options or {}))
            out.sheets = self.sheets(out.classified, top_n)
            if summarize:
                out.summaries = self.summarize(out.sheets, top_n)
        return out

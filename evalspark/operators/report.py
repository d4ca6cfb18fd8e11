"""Classified sentences to the sheets of a report."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evalspark.operators.classify import AMBIGUOUS, VALID
from evalspark.operators.topics import TOPICS
from evalspark.schema import BLOCKS, PIVOT_INDEX, RAW_SHEET, RESULT_COLUMNS, SHEET_OF_BLOCK

TOP_N = 10


def _rows(df: DataFrame, primary: Column, secondary: Column) -> DataFrame:
    """Valid sentences once, ambiguous ones under both topics, in one scan; outliers are left out."""
    if "classification_status" not in df.columns:  # flags are off: every row is valid
        df = df.withColumn("classification_status", F.lit(VALID))
    status = F.col("classification_status")
    first = F.struct(F.col("primary_topic").alias("keyword"), primary.alias("dist"))
    second = F.struct(F.col("secondary_topic").alias("keyword"), secondary.alias("dist"))
    kept = df.where(status.isin(VALID, AMBIGUOUS))
    out = kept.select("*", F.explode(F.when(status == AMBIGUOUS, F.array(first, second)).otherwise(F.array(first))).alias("_k"))
    return out.select("sentence", F.col("_k.keyword").alias("keyword"), F.col("_k.dist").alias("dist"), "Call", "Activity", "Number", "Score", "Block", status.alias("classification")).select(RESULT_COLUMNS)


def raw_sheet(df: DataFrame) -> DataFrame:
    """Every kept sentence with its topic; ``dist`` is the similarity."""
    return _rows(df, F.col("primary_val"), F.col("secondary_val"))


def block_weights(df: DataFrame, block: str | None = None) -> DataFrame:
    """The same with ``dist`` as weight: 1 for a valid sentence, 0.5 for each topic of an ambiguous one."""
    weight = F.when(F.col("classification_status") == AMBIGUOUS, 0.5).otherwise(1.0) if "classification_status" in df.columns else F.lit(1.0)
    return _rows(df if block is None else df.where(F.col("Block") == block), weight, weight)


def pivot_block(weights: DataFrame, topics: Iterable[str]) -> DataFrame:
    """Mean weights with topics as columns, in alphabetical order, 0 where a sentence lacks a topic.

    Rows with a null in any key are left out. Topics are given, so Spark needs
    no job to find them.
    """
    topics = sorted(topics)
    pivoted = weights.dropna(subset=PIVOT_INDEX).groupBy(*PIVOT_INDEX).pivot("keyword", topics).agg(F.avg("dist"))
    return pivoted.na.fill(0.0, subset=topics)


def occurring(pivoted: DataFrame, topics: Iterable[str]) -> DataFrame:
    """Without the topics that no sentence has (this runs a job)."""
    topics = list(topics)
    sums = pivoted.agg(*[F.max(F.col(f"`{t}`") > 0).alias(t) for t in topics]).first() if topics else {}
    return pivoted.drop(*[t for t in topics if not sums[t]])


def activity_summary(pivoted: DataFrame, topics: Iterable[str], top_n: int = TOP_N) -> DataFrame:
    """One row per activity: topic means, the first report's Call, Score and Block, and the top sentences as text.

    Top sentences have the largest weight of any topic; ties go by Number, then
    sentence. Only ``top_n`` sentences of an activity reach the list.
    """
    topics = sorted(topics)
    weight = F.greatest(*[F.col(f"`{t}`") for t in topics]) if len(topics) > 1 else F.col(f"`{topics[0]}`") if topics else F.lit(1.0)
    key = F.struct("Call", "Number", "Score", "Block", "classification", "sentence")
    means = pivoted.groupBy("Activity").agg(*[F.avg(f"`{t}`").alias(t) for t in topics], *[F.min_by(c, key).alias(c) for c in ("Call", "Score", "Block")])
    order = Window.partitionBy("Activity").orderBy(F.desc("_w"), "Number", "sentence", "Call", "Score", "classification")
    top = pivoted.withColumn("_w", weight).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= top_n)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("_r", "sentence"))), lambda s: F.concat(F.lit("- "), s["sentence"]))
    texts = top.groupBy("Activity").agg(F.array_join(lines, "\n").alias(f"Top_{top_n}_Sentences"))
    return means.join(texts, "Activity").select("Activity", "Call", "Score", "Block", *topics, f"Top_{top_n}_Sentences")


def workbook_sheets(df: DataFrame, topics: dict[str, dict[str, str]] | None = None, top_n: int = TOP_N, only_occurring: bool = False) -> dict[str, DataFrame]:
    """Sheet name to table: raw data, three block sheets, three summaries; lazy unless ``only_occurring``."""
    topics = TOPICS if topics is None else topics
    sheets = {RAW_SHEET: raw_sheet(df)}
    pivots = {}
    for block in BLOCKS:
        pivots[block] = pivot_block(block_weights(df, block), topics[block])
        sheets[SHEET_OF_BLOCK[block]] = occurring(pivots[block], topics[block]) if only_occurring else pivots[block]
    for block in BLOCKS:
        sheets[f"{SHEET_OF_BLOCK[block]}_Summary"] = activity_summary(pivots[block], topics[block], top_n).orderBy("Activity")
    return sheets

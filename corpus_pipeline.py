"""A corpus pipeline: quality filter, near-duplicate removal, removal of repeated passages, packing.

Each stage reads what its predecessor has written as Parquet, and all but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.llm import quality
from evalspark.llm.common import irregular, table, with_numbers, written
from evalspark.llm.jaccard_join import similar_components
from evalspark.llm.packing import pack
from evalspark.llm.suffix_repeats import remove_repeats


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the co-trained classifier rejects.

    Every row is judged by its own columns: a null text is the empty text, rows
    without a doc_id and repeated ones are judged like all others, and equal rows
    alike; without labels of both kinds all stay.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, into=("_quality", "_accepted")).where("_accepted").select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group whose 5-word shingles are similar by 0.8 or more.

    Texts without words, nulls among them, are in no group and stay. Where rows
    share a doc_id or have none, documents are told apart by doc_id and text
    (those without an id come last), and of equal rows of one document one stays:
    the first by its columns as JSON.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def gone(named: DataFrame) -> DataFrame:
        groups = similar_components(named, words=5, num=80, den=100)
        return groups.where("doc_id != component_id").select("doc_id").distinct()

    if not irregular(docs):
        return docs.join(gone(docs), "doc_id", "left_anti").select(*columns)
    rows = with_numbers(docs.select("doc_id", "text", F.struct(*columns).alias("_row")))
    left = rows.join(gone(rows.select(F.col("_doc").alias("doc_id"), "text")).withColumnRenamed("doc_id", "_doc"), "_doc", "left_anti")
    return left.groupBy("_doc").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of 100 bytes or more that occur earlier in the corpus out of the texts, in whole characters.

    Null texts become empty texts, and rows without a doc_id pass as they are, as
    they have no place in the order. Rows that share doc_id and text are cut
    alike; different texts of one doc_id are cut one after the other.
    """
    kept = remove_repeats(docs, as_text=True).withColumn("text", F.when(F.col("n_bytes") > 0, F.col("kept_text")).otherwise(""))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens: every row, a null text as the empty one, which has the end id only."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_filter),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("packing", packing),
]

#: SQL can't express the classifier; tests/llm compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents one after the other, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

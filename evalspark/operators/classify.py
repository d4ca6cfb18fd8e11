"""Sentences to topics by cosine within their block, and the status of each assignment."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evalspark.functions.text import NEGATIVE_PATTERNS, clean_for_encoding, is_negative, is_verdict_only, sentences
from evalspark.operators.stats import exact_quantiles
from evalspark.operators.topics import Encoder, encoded
from evalspark.schema import BLOCKS, SCORE_OF_BLOCK, require_columns

#: Defaults of the classification.
SIMILARITY_THRESHOLD, IQR_MULTIPLIER, AMBIGUITY_RATIO, MIN_GROUP = 0.30, 1.5, 0.98, 4
UNCLASSIFIED = "unclassified"
#: Columns that tell in which order reports were read.
INGEST_ORDER = ("archive", "source_path")
VALID, AMBIGUOUS, OUTLIER = "Valid", "Ambiguous", "Outlier"


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 where one has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def select_blocks(reports: DataFrame, blocks: Iterable[str] = BLOCKS) -> DataFrame:
    """One row per report and block: Call, Activity, Number, Score, Block, text. ValueError for an unknown block."""
    blocks = list(blocks)
    if unknown := [b for b in blocks if b not in SCORE_OF_BLOCK]:
        raise ValueError(f"unknown blocks: {unknown}")
    require_columns(reports, ["Call", "Activity", "Number", *blocks, *(SCORE_OF_BLOCK[b] for b in blocks)])
    rows = F.array(*[F.struct(F.lit(b).alias("Block"), F.col(SCORE_OF_BLOCK[b]).cast("double").alias("Score"), F.col(b).alias("text")) for b in blocks])
    return reports.select("Call", "Activity", F.col("Number").cast("string").alias("Number"), F.explode(rows).alias("r")).select("Call", "Activity", "Number", "r.Score", "r.Block", "r.text")


def negative_sentences(blocks: DataFrame, text: str = "text", patterns: Iterable[str] = NEGATIVE_PATTERNS) -> DataFrame:
    """One row per negative sentence that is more than a verdict, with its position in the text; ``text`` goes."""
    split = blocks.select(*[c for c in blocks.columns if c != text], F.posexplode(sentences(F.col(text))).alias("pos", "sentence"))
    return split.where(is_negative(F.col("sentence"), patterns) & ~is_verdict_only(F.col("sentence")))


def score_topics(vectors: DataFrame, index: DataFrame, vec: str = "vec") -> DataFrame:
    """Adds ``ranked``: the block's topics as array<struct<val, topic>>, best first, ties by catalog order.

    The index has a few topics for each block and is broadcast as one row per
    block, so that sentences are scored where they are, without a shuffle.
    """
    lists = index.groupBy("Block").agg(F.array_sort(F.collect_list(F.struct("topic_ord", "topic", F.col("vec").alias("v")))).alias("_topics"))
    joined = vectors.join(F.broadcast(lists), "Block")
    scored = F.transform("_topics", lambda t: F.struct((-cosine(F.col(vec), t["v"])).alias("n"), t["topic_ord"].alias("o"), t["topic"].alias("t")))
    return joined.withColumn("ranked", F.transform(F.array_sort(scored), lambda s: F.struct((-s["n"]).alias("val"), s["t"].alias("topic")))).drop("_topics")


def top_matches(ranked: Column, k: int = 1, threshold: float = SIMILARITY_THRESHOLD) -> Column:
    """The best k topics of at least ``threshold``; if none, one entry "unclassified" with the best value."""
    found = F.filter(F.slice(ranked, 1, k), lambda s: s["val"] >= threshold)
    none = F.array(F.struct(F.get(ranked, F.lit(0))["val"].alias("val"), F.lit(UNCLASSIFIED).alias("topic")))
    return F.when(F.size(found) > 0, found).otherwise(none)


def classify_sentences(sentences_: DataFrame, index: DataFrame, encoder: Encoder | None = None, top_k: int = 1, threshold: float = SIMILARITY_THRESHOLD, keep_embeddings: bool = False) -> DataFrame:
    """One row per sentence and match with its two best topics.

    Sentences that have a ``vec`` column already need no encoder.
    """
    if encoder is not None:
        sentences_ = encoded(sentences_.withColumn("_clean", clean_for_encoding(F.col("sentence"))), "_clean", encoder).drop("_clean")
    scored = score_topics(sentences_, index)
    best = lambda i, f: F.get("ranked", F.lit(i))[f]
    # equal rows for further matches weigh in the quartiles
    matches = F.explode(F.sequence(F.lit(1), F.size(top_matches(F.col("ranked"), top_k, threshold))))
    out = scored.select(
        "sentence",
        best(0, "topic").alias("primary_topic"),
        best(0, "val").alias("primary_val"),
        best(1, "topic").alias("secondary_topic"),
        best(1, "val").alias("secondary_val"),
        "Call",
        "Activity",
        "Number",
        "Score",
        "Block",
        *(["vec"] if keep_embeddings else []),
        matches.alias("_match"),
    )
    return out.drop("_match")


def first_rows(df: DataFrame, rows: int | None, *order: str) -> DataFrame:
    """The first ``rows`` by columns that say in which order they came; all rows without a number."""
    return df.orderBy(*order).limit(rows) if rows else df


def classify_reports(reports: DataFrame, index: DataFrame, encoder: Encoder, blocks: Iterable[str] = BLOCKS, rows: int | None = None, patterns: Iterable[str] = NEGATIVE_PATTERNS, **how) -> DataFrame:
    """Reports to classified sentences. ``rows`` takes that many reports in the order of archive and file, as far as the
    table has them, then of Number, Call and Activity."""
    reports = first_rows(reports, rows, *[c for c in (*INGEST_ORDER, "Number", "Call", "Activity") if c in reports.columns])
    return classify_sentences(negative_sentences(select_blocks(reports, blocks), patterns=patterns), index, encoder, **how)


def flag_outliers_and_ambiguous(
    df: DataFrame,
    topic: str = "primary_topic",
    primary: str = "primary_val",
    secondary: str = "secondary_val",
    iqr_multiplier: float = IQR_MULTIPLIER,
    ratio_threshold: float = AMBIGUITY_RATIO,
    min_group: int = MIN_GROUP,
    keep_intermediate: bool = False,
    bracketed: bool = True,
) -> DataFrame:
    """Adds classification_status: Outlier over Ambiguous over Valid.

    An outlier's distance is over its topic's upper fence (exact quartiles with
    linear interpolation; topics of fewer than ``min_group`` rows have none).
    There is one row of quartiles per topic, which Spark joins as it sees fit,
    and a topic's rows stay where they are. The quartiles are found in three
    passes over ``df``, which should be stored, without holding a topic's
    distances in one task; without ``bracketed`` it is one pass that does.
    """
    d = df.withColumns({"dist_primary": 1 - F.col(primary), "dist_secondary": 1 - F.col(secondary)})
    if bracketed:
        quartiles = exact_quantiles(d, topic, "dist_primary", {"_q1": 0.25, "_q3": 0.75}).select(F.col(topic).alias("_topic"), F.col("n").alias("_n"), "_q1", "_q3")
    else:
        both = F.percentile("dist_primary", F.array(F.lit(0.25), F.lit(0.75)))
        quartiles = d.where(F.col(topic).isNotNull()).groupBy(F.col(topic).alias("_topic")).agg(F.count(F.lit(1)).alias("_n"), both.alias("_q")).select("_topic", "_n", F.col("_q")[0].alias("_q1"), F.col("_q")[1].alias("_q3"))
    fences = quartiles.where(F.col("_n") >= min_group).select("_topic", (F.col("_q3") + iqr_multiplier * (F.col("_q3") - F.col("_q1"))).alias("_fence"))
    joined = d.join(fences, d[topic] == fences["_topic"], "left")
    ratio = F.when((F.col("dist_secondary") == 0) & (F.col("dist_primary") > 0), F.lit(float("inf"))).otherwise(F.try_divide("dist_primary", "dist_secondary"))
    flagged = joined.withColumns({"is_outlier": F.coalesce(F.col("dist_primary") > F.col("_fence"), F.lit(False)), "ambiguity_ratio": ratio})
    flagged = flagged.withColumn("is_ambiguous", F.coalesce(F.col("ambiguity_ratio") > ratio_threshold, F.lit(False)) & F.col(secondary).isNotNull())
    out = flagged.withColumn("classification_status", F.when(F.col("is_outlier"), OUTLIER).when(F.col("is_ambiguous"), AMBIGUOUS).otherwise(VALID)).drop("_topic", "_fence")
    return out if keep_intermediate else out.drop("dist_primary", "dist_secondary", "is_outlier", "is_ambiguous", "ambiguity_ratio")


def flag_outliers_window(df: DataFrame, group: str, value: str, multiplier: float = IQR_MULTIPLIER, min_group: int = MIN_GROUP) -> DataFrame:
    """Adds q1, q3 and is_outlier for any numeric column; for groups that are many and small."""
    w = Window.partitionBy(group)
    q = df.withColumns({"q1": F.percentile(value, F.lit(0.25)).over(w), "q3": F.percentile(value, F.lit(0.75)).over(w), "_n": F.count(F.lit(1)).over(w)})
    fence = F.col("q3") + multiplier * (F.col("q3") - F.col("q1"))
    return q.withColumn("is_outlier", (F.col("_n") >= min_group) & (F.col(value) > fence)).drop("_n")

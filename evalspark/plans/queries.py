"""Queries over the test tables for every operator, and DuckDB SQL of the same meaning.

Documents stand for reports: Number is doc_id, Activity source, Call lang, Score
the label's quality, and the text is in the block doc_id % 3. Embeddings give
sentence vectors, and their means by label and vec_id % 3 the topics. Report
texts are rendered from orders and customers by SQL that both engines run.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.functions.text import clean_for_encoding, is_negative, is_verdict_only, sentences
from evalspark.operators import privacy
from evalspark.operators.classify import classify_sentences, cosine, first_rows, flag_outliers_and_ambiguous, flag_outliers_window, negative_sentences, score_topics, select_blocks, top_matches
from evalspark.operators.extract import error_message, extract_reports, is_valid, strip_footer, united
from evalspark.operators.report import activity_summary, block_weights, pivot_block, raw_sheet, workbook_sheets
from evalspark.operators.summarize import summarize
from evalspark.operators.topics import centroid_index, encoded, topic_catalog, topic_index
from evalspark.schema import BLOCKS, SHEET_OF_BLOCK, TEXT_FIELDS
from evalspark.sources.archives import PlainTextDecoder, decode_entries, expand_archives, file_log
from evalspark.sources.tables import export, load

Query = Callable[[SparkSession, str], DataFrame]

#: Expressions that occur in the test documents, in place of the default negative ones.
CORPUS_WORDS = ["idiot", "worthless", "moron", "pathetic", "stupid"]
CORPUS_NEGATIVE = [rf"\b{w}\b" for w in CORPUS_WORDS]
TOPIC_NAMES = [str(i) for i in range(10)]
N_TOP, THRESHOLD = 10, 0.30
#: Ends of sentences that have the default negative expressions, or nearly.
PHRASES = [
    ".", " Shortcomings remain.", " A WEAKNESS.", " limited", " unlimited", " incrementally", " black", " It is not  fully shown.", " not addressed", " not full", " vagueness", " unclear", " insufficient",
]
LETTERS = "abcdefghijklmnopqrstuvwxyz"

#: One report text per order, in SQL of both engines: footers, thresholds, gaps in some fields, 2 to 4 scores.
RENDER = """
SELECT o_orderkey AS report_id, concat(
  'Call: CALL-', c_mktsegment, chr(10), 'Type of action: ', CASE o_orderkey % 3 WHEN 0 THEN 'HORIZON-CSA' WHEN 1 THEN 'HORIZON-FPA' ELSE 'HORIZON-RIA' END, chr(10),
  'Proposal number: ', CAST(100000000 + o_custkey AS STRING), chr(10), 'Proposal acronym: ', CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE c_name END, chr(10),
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE concat('Title: Work on ', o_orderpriority, chr(10), 'second line', chr(10)) END, 'Activity: A', CAST(o_custkey % 20 AS STRING), chr(10),
  CAST(100000000 + o_orderkey AS STRING), '/part-01/02/2020-10:11:12', chr(10), ' 3 / 17', 'Abstract: About ', o_orderstatus, ' and', chr(10), 'more. Evaluation Summary Report', chr(10),
  CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE concat('Criterion 1 - Excellence', chr(10), 'Score: ', CAST(o_orderkey % 5 AS STRING), '.', CAST(o_orderkey % 10 AS STRING), '0 (Threshold: 3.0/5.0) boiler methodology. x objectives appropriate.', chr(10), '- First   point', chr(9), 'of ', c_name, chr(10), '- next', chr(10)) END,
  'Criterion 2 - Impact', chr(10), 'Score: (Threshold: 3/5) ', CAST(o_custkey % 5 AS STRING), '.25 scale and impacts specified in the work programme. activities. Impact text here. Score: again activities.', chr(10),
  'Criterion 3 - Quality and efficiency of the implementation', chr(10), CASE WHEN o_orderkey % 2 = 0 THEN 'Score: 4' ELSE 'Score: 4.5' END, ' participants expertise.  Team is fine.', chr(10),
  CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE 'Scope of the application' END, chr(10), 'Yes') AS text
FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""


class LetterEncoder:
    """An encoder that SQL can express: the counts of the small letters."""

    def encode(self, texts: list[str]) -> np.ndarray:
        return np.array([[t.count(c) for c in LETTERS] for t in texts], float).reshape(len(texts), len(LETTERS))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RENDER, orders=_table(spark, sf_dir, "orders"), customer=_table(spark, sf_dir, "customer"))


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_reports(_rendered(spark, sf_dir))


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    joined = docs.join(labels, "doc_id", "left")
    own = lambda i: F.when(F.col("doc_id") % 3 == i, F.col("text"))
    return joined.select(
        F.col("lang").alias("Call"), F.col("source").alias("Activity"), F.col("doc_id").cast("string").alias("Number"),
        *[F.col("quality").cast("double").alias(s) for s in ("S_Excellence", "S_Impact", "S_Implement")],
        *[own(i).alias(b) for i, b in enumerate(BLOCKS)],
    )


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = F.element_at(F.array(*map(F.lit, BLOCKS)), (F.col("vec_id") % 3 + 1).cast("int"))
    return centroid_index(_table(spark, sf_dir, "embeddings").withColumn("Block", block), "Block", "label", "embedding")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))


def _negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negative_sentences(select_blocks(_reports(spark, sf_dir)), patterns=CORPUS_NEGATIVE)


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified sentences, stored, as their flags and sheets read them several times."""
    vectors = _vectors(spark, sf_dir)
    n = vectors.count()
    keyed = _negative(spark, sf_dir).withColumn("vec_id", (F.col("Number").cast("long") * 131 + F.col("pos")) % n)
    found = classify_sentences(keyed.join(vectors.select("vec_id", "vec"), "vec_id"), _index(spark, sf_dir))
    path = _shared_folder(spark, "classified")
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_outliers_and_ambiguous(_classified(spark, sf_dir))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(f"`{n}`"), 6) for n in names})


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding against the topics of every block."""
    vectors = _vectors(spark, sf_dir).crossJoin(F.broadcast(spark.createDataFrame([(b,) for b in BLOCKS], "Block string")))
    return score_topics(vectors, _index(spark, sf_dir))


def extract_basic_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(spark, sf_dir).select("report_id", *TEXT_FIELDS, "basic_ok")


def extract_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_extracted(spark, sf_dir).select("report_id", F.col("Total Score").alias("total"), "S_Excellence", "S_Impact", "S_Implement", "score_ok"), "total")


def extract_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(spark, sf_dir).select("report_id", *BLOCKS, "criteria_ok")


def footer_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rendered(spark, sf_dir).select("report_id", strip_footer(F.col("text")).alias("text"))


def error_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(spark, sf_dir).select("report_id", "error_code", is_valid(F.col("error_code")).alias("valid"), error_message(F.col("error_code")).alias("message"))


def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(sentences(F.col("text"))).alias("pos", "sentence"))


def negative_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _negative(spark, sf_dir).select("Number", "Block", "pos", "sentence")


def verdict_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_split(spark, sf_dir).select("doc_id", "pos", is_verdict_only(F.col("sentence"), CORPUS_WORDS).alias("verdict_only"), is_negative(F.col("sentence"), CORPUS_NEGATIVE).alias("negative"))


def clean_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_split(spark, sf_dir).select("doc_id", "pos", clean_for_encoding(F.col("sentence")).alias("cleaned"))


def row_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first reports in input order: the limit is the operator."""
    return first_rows(_table(spark, sf_dir, "documents"), 25, "doc_id").select("doc_id", "source", "n_chars")


def cosine_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("vec_id", "Block", F.explode("ranked").alias("r")).select("vec_id", "Block", "r.topic", F.round("r.val", 6).alias("val"))


def topk_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = _scored(spark, sf_dir).select("vec_id", "Block", F.posexplode(top_matches(F.col("ranked"), 3, THRESHOLD)).alias("k", "m"))
    return matches.select("vec_id", "Block", "k", "m.topic", F.round("m.val", 6).alias("val"))


def top_two_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda i, f: F.get("ranked", F.lit(i))[f]
    return _scored(spark, sf_dir).select("vec_id", "Block", at(0, "topic").alias("primary_topic"), at(1, "topic").alias("secondary_topic"), F.round(at(0, "val") - at(1, "val"), 6).alias("lead"))


def centroid_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).select("Block", "topic_ord", "topic", F.round(cosine(F.col("vec"), F.col("vec")), 6).alias("self"), F.round(F.get("vec", F.lit(0)), 6).alias("first"), F.size("vec").alias("dim"))


def classified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_classified(spark, sf_dir), "primary_val", "secondary_val")


def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper-fence outliers of line prices within each part."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    out = flag_outliers_window(lines, "l_partkey", "l_extendedprice")
    return _rounded(out, "q1", "q3").select("l_orderkey", "l_linenumber", "l_partkey", "q1", "q3", "is_outlier")


def ambiguity_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = flag_outliers_and_ambiguous(_classified(spark, sf_dir), keep_intermediate=True)
    return _rounded(out, "ambiguity_ratio").select("Number", "Block", "sentence", "primary_topic", "ambiguity_ratio", "is_outlier", "is_ambiguous", "classification_status")


def all_raw_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(raw_sheet(_flagged(spark, sf_dir)), "dist")


def weighted_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_weights(_flagged(spark, sf_dir))


def _pivot(block: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(pivot_block(block_weights(_flagged(spark, sf_dir), block), TOPIC_NAMES).withColumnsRenamed({t: f"t{t}" for t in TOPIC_NAMES}), *[f"t{t}" for t in TOPIC_NAMES])

    return query


def activity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: from documents to one row per activity with topic means and top sentences."""
    pivoted = pivot_block(block_weights(_flagged(spark, sf_dir), BLOCKS[0]), TOPIC_NAMES)
    out = activity_summary(pivoted, TOPIC_NAMES, N_TOP).withColumnsRenamed({t: f"t{t}" for t in TOPIC_NAMES})
    return _rounded(out, *[f"t{t}" for t in TOPIC_NAMES])


def top_n_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three longest texts of each source: top-N of a group by a window."""
    from pyspark.sql.window import Window

    docs = _table(spark, sf_dir, "documents")
    ranked = docs.withColumn("rank", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id")))
    return ranked.where("rank <= 3").groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))), lambda s: F.concat(F.lit("- "), s["doc_id"].cast("string"))), "\n").alias("top"))


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return united(docs.drop("text"), items.select(F.col("item_id").alias("doc_id"), F.length("text").cast("long").alias("n_chars")))


def mask_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's size, language and source masked in its text."""
    masked = privacy.mask_literals(F.col("text"), F.col("n_chars").cast("string"), F.col("lang"), F.col("source"))
    return _table(spark, sf_dir, "documents").select("doc_id", masked.alias("masked"))


def mask_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", privacy.mask_names(F.col("text")).alias("masked"))


def mask_acronyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", privacy.mask_capitals(F.col("text")).alias("masked"))


def anonymize_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All masks, on every report's criterion texts."""
    return privacy.anonymize(_reports(spark, sf_dir)).select("Number", *BLOCKS)


def default_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default negative expressions and verdicts, on sentences that end in phrases like them."""
    phrase = F.element_at(F.array(*map(F.lit, PHRASES)), ((F.col("doc_id") + F.col("pos")) % len(PHRASES) + 1).cast("int"))
    said = sentence_split(spark, sf_dir).withColumn("t", F.concat("sentence", phrase))
    return said.select("doc_id", "pos", is_negative(F.col("t")).alias("negative"), is_verdict_only(F.col("t")).alias("verdict_only"))


def encoded_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document by an encoder against the encoded catalog: the best topic of its block."""
    block = F.element_at(F.array(*map(F.lit, BLOCKS)), (F.col("doc_id") % 3 + 1).cast("int"))
    vectors = encoded(_table(spark, sf_dir, "documents").select("doc_id", block.alias("Block"), "text"), "text", LetterEncoder())
    known = vectors.where(F.exists("vec", lambda x: x != 0))
    best = F.get("ranked", F.lit(0))
    return score_topics(known, topic_index(topic_catalog(spark), LetterEncoder())).select("doc_id", "Block", best["topic"].alias("topic"), F.round(best["val"], 6).alias("val"))


def mask_list_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list form: literal masks in each line of a document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", F.split("text", "\n").alias("Criterion"))
    return docs.select("doc_id", F.transform("Criterion", lambda c: privacy.mask_literals(c, acronym=F.col("lang"))).alias("m")).select("doc_id", F.size("m").alias("lines"), F.array_join("m", "\n").alias("masked"))


def aes_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encrypted and decrypted names; ciphertexts are random, so their length stands for them."""
    key = bytes(range(16))
    customers = _table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("Title"), F.col("c_name").alias("plain"))
    coded = privacy.encrypted(customers, ["Title"], key)
    back = privacy.decrypted(coded.withColumn("coded", F.col("Title")), ["Title"], key)
    return back.select("c_custkey", F.col("Title").alias("decoded"), (F.length("coded") / 2).cast("int").alias("coded_bytes"), (F.col("coded") != F.lower(F.hex("plain"))).alias("differs"))


def _shared_folder(spark: SparkSession, name: str) -> str:
    """A new path that executors share: the cluster's checkpoint folder, or below the warehouse in local sessions."""
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, with newlines and quotes in their texts, written as CSV and read again."""
    path = export(_table(spark, sf_dir, "documents"), _shared_folder(spark, "round") + ".csv")
    return load(spark, path).select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.length("text").alias("chars"), F.sha2("text", 256).alias("digest"))


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = export(_table(spark, sf_dir, "orders"), _shared_folder(spark, "round") + ".parquet")
    return load(spark, path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def workbook_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each sheet of the workbook."""
    topics = {b: dict.fromkeys(TOPIC_NAMES, "") for b in BLOCKS}
    out = None
    for name, df in workbook_sheets(_flagged(spark, sf_dir), topics, N_TOP).items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("sheet"), "n")
        out = one if out is None else out.union(one)
    return out.where("n > 0")


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 120 words of every conversation's text by the extractive summarizer."""
    turns = _table(spark, sf_dir, "conversations")
    texts = turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]), "\n").alias("text"))
    return summarize(texts, "text").select("conv_id", F.col("LLM_Summary").alias("summary"))


def zip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as report files in ZIPs in a ZIP: scanned, decoded, extracted."""
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey")

    def pack(batches):
        import pyarrow as pa

        for batch in batches:
            contents = []
            for key, name in zip(batch.column("n_nationkey").to_pylist(), batch.column("n_name").to_pylist(), strict=True):
                inner, outer = io.BytesIO(), io.BytesIO()
                with zipfile.ZipFile(inner, "w") as z:
                    z.writestr(f"{key}_ESR.pdf", f"Call: C{key}\nActivity: {name}\nScore: 4.5")
                    z.writestr("ignored.txt", "x")
                with zipfile.ZipFile(outer, "w") as z:
                    z.writestr("inner.zp", inner.getvalue())
                contents.append(outer.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array([f"{k}.zip" for k in batch.column("n_nationkey").to_pylist()]), pa.array(contents, pa.binary())], ["path", "content"])

    entries = expand_archives(nations.mapInArrow(pack, "path string, content binary"))
    reports = extract_reports(decode_entries(entries, PlainTextDecoder()), "text", "pdf_ok")
    named = file_log(entries).select("archive", F.col("entry").alias("source_path"), "stored_as")
    return reports.join(named, ["archive", "source_path"]).select("archive", "source_path", "stored_as", "Call", "Activity", F.col("S_Excellence").alias("score"), "error_code")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        extract_basic_info, extract_scores, extract_criteria, footer_strip, error_code, sentence_split, negative_filter, verdict_filter,
        clean_sentences, row_limit, cosine_matrix, topk_threshold, top_two_topics, centroid_topics, classified_rows, iqr_outliers,
        ambiguity_status, all_raw_data, weighted_blocks, activity_report, top_n_sentences, union_by_name, mask_literals, mask_context,
        mask_acronyms, anonymize_reports, default_negative, encoded_topics, mask_list_column, aes_roundtrip, csv_roundtrip, parquet_roundtrip, workbook_counts, summaries, zip_scan,
    )
} | {f"pivot_{SHEET_OF_BLOCK[b].lower()}": _pivot(b) for b in BLOCKS}


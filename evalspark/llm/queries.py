"""Queries of this subpackage, each over its whole table with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.llm import quality
from evalspark.llm.chat_format import END, LOSS_ROLE, MORE, TEXT, TURN, format_conversations, read_back
from evalspark.llm.common import table
from evalspark.llm.jaccard_join import similar_components
from evalspark.llm.merge_dropout import encode
from evalspark.llm.near_vectors import near_vectors
from evalspark.llm.packing import pack
from evalspark.llm.sharding import shard_by_groups
from evalspark.llm.suffix_repeats import remove_repeats
from evalspark.llm.token_counts import count_tokens
from evalspark.llm.topk import top_k

DROPOUT, DROPOUT_SEED = 0.1, 20240501
N_SHARDS = 16
#: The conversation that is formatted besides the table's own.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def op1_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids with merge-dropout, and a digest of what they decode to."""
    coded = encode(table(spark, sf_dir, "documents"), DROPOUT, DROPOUT_SEED, decoded=True)
    return coded.select("doc_id", "ids", "n_tokens", "ids_crc32", F.octet_length("text").cast("long").alias("decoded_bytes"), F.sha2("text", 256).alias("decoded_sha256"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability of quality by the co-trained views, and whether it is accepted."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", "quality", "accepted")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows for every vector whose id is divisible by 50, against all rows."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's unigram token count."""
    return count_tokens(table(spark, sf_dir, "documents"))


def op6_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes less those that an earlier equal string of 100 bytes covers."""
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept_text")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot; equal texts together, shards of near equal bytes."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.sha2("text", 256).alias("key"),
    )
    return shard_by_groups(docs, "key", "size", N_SHARDS).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.98 or more among equal labels, and their components."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's 3-word shingles and its component among similarities of 0.9 or more."""
    return similar_components(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and the probe, formatted and read back from the string."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kind = dict(turns.dtypes)["conv_id"]
    probe = spark.range(2).select(F.lit(PROBE_ID).cast(kind).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(LOSS_ROLE).alias("role"), F.lit(PROBE_TEXT).alias("text"))
    back = read_back(format_conversations(turns.union(probe)))
    said = F.expr("array_join(transform(turns, t -> concat(t.role, '\n', t.text, '\n')), '')")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_merge_dropout,
        op2_quality,
        op3_packing,
        op4_topk_search,
        op5_token_counts,
        op6_suffix_repeats,
        op7_sharding,
        op8_near_vectors,
        op9_jaccard_join,
        op10_chat_format,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op4_topk_search": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        ), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
        SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 5""",
    "op8_near_vectors": """
        WITH RECURSIVE v AS (
          SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
        ), u AS (
          SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(e, lambda x: x <> 0)) > 0
        ), links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98
        ), reach(id, node) AS (
          SELECT vec_id, vec_id FROM v UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.node = l.a
        ), c AS (SELECT id, min(node) AS component_id FROM reach GROUP BY id),
        n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
        SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
        FROM v JOIN c ON c.id = v.vec_id LEFT JOIN n ON n.a = v.vec_id""",
    "op9_jaccard_join": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l
          FROM documents
        ), s AS (
          SELECT doc_id, CASE WHEN len(l) >= 3 THEN list_distinct(list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2]))
            WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END AS t FROM w
        ), p AS (SELECT doc_id, len(t) AS n, unnest(t) AS x FROM s),
        i AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM p a JOIN p b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM i WHERE 100 * c >= 90 * (na + nb - c)),
        reach(id, node) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.node = l.a)
        SELECT s.doc_id, CAST(len(t) AS BIGINT) AS n_shingles, min(node) AS component_id FROM s JOIN reach ON id = s.doc_id GROUP BY ALL""",
    "op10_chat_format": rf"""
        WITH t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT {PROBE_ID}, 0, 'user', '{PROBE_TEXT}' UNION ALL SELECT {PROBE_ID}, 1, '{LOSS_ROLE}', '{PROBE_TEXT}'
        ), e AS (
          SELECT *, replace(replace(text, '\', '\b'), '<', '\l') AS x, replace(replace(role, '\', '\b'), '<', '\l') AS y,
            lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
          CAST(coalesce(sum(length(text)) FILTER (role = '{LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
          CAST(sum(length(x) + CASE WHEN role IS NOT DISTINCT FROM before THEN {len(MORE)} ELSE {len(TURN) + len(TEXT) + len(END)} + length(y) END) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
}

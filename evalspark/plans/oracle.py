"""DuckDB SQL for the queries of :mod:`evalspark.plans.queries`."""

from __future__ import annotations

from evalspark.operators.privacy import KEPT_CAPITALS, KEPT_WORDS
from evalspark.operators.topics import TOPICS
from evalspark.plans.queries import CORPUS_WORDS, LETTERS, N_TOP, PHRASES, RENDER

#: Fixed values, written out again here, so that the queries are held against them and not against themselves.
BLOCKS = ["C_Excellence", "C_Impact", "C_Implement"]
SHEET_OF_BLOCK = {"C_Excellence": "Excellence", "C_Impact": "Impact", "C_Implement": "Implementation"}
NOT_FOUND = "No encontrado"
SIMILARITY = 0.30
ERROR_MEANINGS = {
    0: "OK - No errors detected.",
    1: "PDF - Error during PDF reading or content extraction.",
    2: "BasicInfo - Error extracting basic information (e.g., Call, Type, Number, Acronym, Title, Activity).",
    3: "Scores - Error extracting scores.",
    4: "Criteria - Error extracting criteria sections.",
}
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
ENDS_BY_TYPE = {
    "HORIZON-CSA": [r"methodology\.", r"activities\.", r"expertise\."],
    "HORIZON-FPA": ["objectives", r"and impacts specified in the work programme\.", "participants"],
}
ENDS = [r"appropriate\.", r"activities\.", r"expertise\."]
NEGATIVE = (
    r"\b(?:shortcomings?|weakness(?:es)?|limit(?:ed|ations?)?|incremental(?:ly)?|lack(?:s|ing)?|insufficient(?:ly)?|unclear(?:ly)?|vague(?:ly|ness)?"
    r"|not\s+(?:sufficiently|fully|clearly|completely|adequate(?:ly)?|convincing|described|addressed))\b"
)
NOISE = (
    r"\bnot\s+(?:adequately|sufficiently)\b|\binsufficiently\b|\badequately\b|\bsufficiently\b|\bconvincing\b|\bthis\s+is\s+a\s+(?:weakness|shortcoming)\b"
    r"|\bas\s+a\s+result\b|\bhowever\b|\bmoreover\b|\binadequately\b"
)

_TEXTS = f"r AS ({RENDER.format(orders='orders', customer='customer')}), f AS (SELECT report_id, regexp_replace(text, '(?s){FOOTER}', '', 'g') AS text FROM r)"


def _field(name: str) -> str:
    p = ("(?s)" if name == "Abstract" else "") + FIELD_PATTERNS[name]
    return f"CASE WHEN regexp_matches(text, '{p}') THEN regexp_extract(text, '{p}', 1) END"


def _criterion(i: int) -> str:
    own = f"regexp_replace(regexp_replace(parts[{i + 2}], '[ \\t]+', ' ', 'g'), '\\n- ', chr(10), 'g')"
    cut = lambda end: f"regexp_replace({own}, '(?s)Score:.*?{end}', '')"
    cases = " ".join(f"WHEN '{k}' THEN {cut(v[i])}" for k, v in ENDS_BY_TYPE.items())
    return f"CASE WHEN len(parts) = 5 THEN regexp_replace(CASE Type {cases} ELSE {cut(ENDS[i])} END, '\\A\\s+|\\s+\\z', '', 'g') ELSE '' END"


_FIELDS = ", ".join(f'{_field(n)} AS "{n}"' for n in FIELD_PATTERNS)
_OK = " AND ".join(f'"{n}" IS NOT NULL' for n in FIELD_PATTERNS)
_REPORTS = f"""{_TEXTS}, b AS (SELECT *, {_FIELDS}, regexp_replace(text, '{THRESHOLD}', '', 'g') AS s FROM f),
c AS (SELECT *, {_OK} AS basic_ok, list_transform(regexp_extract_all(s, '{SCORE}', 1), lambda x: CAST(x AS DOUBLE)) AS sc, string_split_regex(s, '{HEADINGS}') AS parts FROM b)"""

_SENTENCES = r"""sl AS (SELECT doc_id, lang, source, list_filter(list_transform(string_split(regexp_replace(text, '([.!?]["'')\]]*)\s+([A-Z"''(\[])', '\1' || chr(1) || '\2', 'g'), chr(1)),
  lambda s: trim(replace(s, chr(10), ' '))), lambda s: s <> '') AS l FROM documents),
s AS (SELECT doc_id, lang, source, unnest(range(len(l))) AS pos, unnest(l) AS sentence FROM sl)"""
_NEGATIVE = rf"(?i)\b(?:{'|'.join(CORPUS_WORDS)})\b"
_BLOCK = "[" + ", ".join(f"'{b}'" for b in BLOCKS) + "]"
_INDEX = f"""e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v, {_BLOCK}[CAST(vec_id % 3 AS INTEGER) + 1] AS Block FROM embeddings),
cx AS (SELECT Block, label, unnest(range(len(v))) AS i, unnest(v) AS x FROM e),
cm AS (SELECT Block, label, i, avg(x) AS m FROM cx GROUP BY ALL),
ix AS (SELECT Block, row_number() OVER (PARTITION BY Block ORDER BY label) - 1 AS topic_ord, CAST(label AS VARCHAR) AS topic, list(m ORDER BY i) AS tv FROM cm GROUP BY Block, label)"""
_SIMS = f"{_INDEX}, sm AS (SELECT e.vec_id, ix.Block, topic, topic_ord, list_cosine_similarity(v, tv) AS val FROM e CROSS JOIN ix), rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id, Block ORDER BY val DESC, topic_ord) AS k FROM sm)"
_CLASSIFIED = f"""{_SENTENCES}, {_INDEX},
ng AS (SELECT s.*, {_BLOCK}[CAST(s.doc_id % 3 AS INTEGER) + 1] AS Block, CAST(quality AS DOUBLE) AS Score FROM s LEFT JOIN labels USING (doc_id) WHERE regexp_matches(sentence, '{_NEGATIVE}')),
sc AS (SELECT ng.*, topic, row_number() OVER (PARTITION BY ng.doc_id, pos ORDER BY list_cosine_similarity(v, tv) DESC, topic_ord) AS k, list_cosine_similarity(v, tv) AS val
  FROM ng JOIN e ON e.vec_id = (ng.doc_id * 131 + pos) % (SELECT count(*) FROM embeddings) JOIN ix ON ix.Block = ng.Block),
cl AS (SELECT sentence, max(topic) FILTER (k = 1) AS primary_topic, max(val) FILTER (k = 1) AS primary_val, max(topic) FILTER (k = 2) AS secondary_topic, max(val) FILTER (k = 2) AS secondary_val,
  lang AS "Call", source AS Activity, CAST(doc_id AS VARCHAR) AS Number, Score, Block FROM sc GROUP BY doc_id, pos, sentence, lang, source, Score, Block)"""
_FLAGGED = f"""{_CLASSIFIED},
qt AS (SELECT primary_topic, quantile_cont(1 - primary_val, 0.25) AS q1, quantile_cont(1 - primary_val, 0.75) AS q3 FROM cl GROUP BY 1 HAVING count(*) >= 4),
fl AS (SELECT cl.*, (1 - primary_val) / (1 - secondary_val) AS ambiguity_ratio, coalesce(1 - primary_val > q3 + 1.5 * (q3 - q1), false) AS is_outlier,
  coalesce((1 - primary_val) / (1 - secondary_val) > 0.98, false) AS is_ambiguous FROM cl LEFT JOIN qt USING (primary_topic)),
st AS (SELECT *, CASE WHEN is_outlier THEN 'Outlier' WHEN is_ambiguous THEN 'Ambiguous' ELSE 'Valid' END AS classification_status FROM fl)"""


def _both(first: str, second: str) -> str:
    cols = '"Call", Activity, Number, Score, Block, classification_status AS classification'
    return f"""SELECT sentence, primary_topic AS keyword, {first} AS dist, {cols} FROM st WHERE NOT is_outlier
  UNION ALL SELECT sentence, secondary_topic, {second}, {cols} FROM st WHERE classification_status = 'Ambiguous'"""


_WEIGHTS = _both("CASE WHEN is_ambiguous THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END", "0.5::DOUBLE")
_KEYS = 'Activity, "Call", Number, Score, Block, classification, sentence'
_MEANS = ", ".join(f"coalesce(avg(dist) FILTER (keyword = '{t}'), 0) AS t{t}" for t in range(10))


def _pivoted(block: str | None = None) -> str:
    where = " AND ".join(f"{c.strip()} IS NOT NULL" for c in _KEYS.split(",")) + (f" AND Block = '{block}'" if block else "")
    return f"{_FLAGGED}, w AS ({_WEIGHTS}), p AS (SELECT {_KEYS}, {_MEANS} FROM w WHERE {where} GROUP BY {_KEYS})"


_ROUNDED = ", ".join(f"round(t{t}, 6) AS t{t}" for t in range(10))
_FIRST = ", ".join(f'first({c} ORDER BY "Call", Number, Score, Block, classification, sentence) AS {c}' for c in ('"Call"', "Score", "Block"))
_TOP = ", ".join(f"round(avg(t{t}), 6) AS t{t}" for t in range(10))
_RANK = f"row_number() OVER (PARTITION BY Activity ORDER BY greatest({', '.join(f't{t}' for t in range(10))}) DESC, Number, sentence, \"Call\", Score, classification)"
_MESSAGES = " ".join(f"WHEN {k} THEN '{v}'" for k, v in ERROR_MEANINGS.items())
_MASK = lambda text, value, mark: f"CASE WHEN {value} IS NOT NULL AND {value} <> '' THEN replace({text}, {value}, '{mark}') ELSE {text} END"



def _marked(text: str) -> str:
    """Between underscores all characters outside ASCII that are part of words, as \\b knows only ASCII here."""
    word = r"\p{L}\p{M}\p{Nd}\p{Pc}"
    every = rf"regexp_replace({text}, '([^\x00-\x7F])', '_' || chr(1) || '\1' || chr(1) || '_', 'g')"
    return rf"regexp_replace({every}, '_\x01([^{word}])\x01_', '\1', 'g')"


def _masked(text: str, pattern: str, keep: list[str]) -> str:
    """[NAME] for the matches that aren't kept; what was marked is as before."""
    kept = ", ".join(f"'{w}'" for w in sorted(keep))
    parts = f"string_split(regexp_replace({text}, '({pattern})', chr(2) || '\\1' || chr(3), 'g'), chr(2))"
    each = f"list_transform({parts}, lambda x: CASE WHEN NOT contains(x, chr(3)) THEN x WHEN string_split(x, chr(3))[1] IN ({kept}) THEN replace(x, chr(3), '') ELSE '[NAME]' || string_split(x, chr(3))[2] END)"
    return f"replace(replace(replace(array_to_string({each}, ''), '_' || chr(1), ''), chr(1) || '_', ''), chr(4) || '_', '')"


_WHITE = r"[\s\x0B\x{85}\p{Z}]"


def _names(text: str) -> str:
    # after the end of a sentence or one white space at the start a capital is marked, so that no word starts there
    after = rf"regexp_replace(regexp_replace({_marked(text)}, '([.!?]{_WHITE})([A-Z])', '\1' || chr(4) || '_\2', 'g'), '\A({_WHITE})([A-Z])', '\1' || chr(4) || '_\2')"
    return _masked(after, r"\b[A-Z][a-z]{3,}\b", KEPT_WORDS)


def _capitals(text: str) -> str:
    two = rf"regexp_replace({_marked(text)}, '\b[A-Z][A-Z0-9-]{{2,}}[A-Z0-9]{_WHITE}+[A-Z][A-Z0-9-]{{1,}}[A-Z0-9]\b', '[NAME]', 'g')"
    return _masked(two, r"\b[A-Z][A-Z0-9-]{1,}[A-Z]\b", KEPT_CAPITALS)


def _own(i: int) -> str:
    text = f"CASE WHEN doc_id % 3 = {i} THEN coalesce(text, '') ELSE '' END"
    return f"{_capitals(_names(_MASK(text, 'CAST(doc_id AS VARCHAR)', '[NUMBER]')))} AS {BLOCKS[i]}"


def _letters(text: str) -> str:
    return "[" + ", ".join(f"CAST(length({text}) - length(replace({text}, '{c}', '')) AS DOUBLE)" for c in LETTERS) + "]"


_CATALOG = ", ".join(f"('{b}', {i}, '{t}', '{d}')" for b, own in TOPICS.items() for i, (t, d) in enumerate(own.items()))

ORACLE_SQL: dict[str, str] = {
    "extract_basic_info": f"WITH {_REPORTS} SELECT report_id, " + ", ".join(f"coalesce(\"{n}\", '{NOT_FOUND}') AS \"{n}\"" for n in FIELD_PATTERNS) + ", basic_ok FROM c",
    "extract_scores": f"WITH {_REPORTS} SELECT report_id, round(coalesce(list_sum(sc), 0.0), 6) AS total, sc[1] AS S_Excellence, sc[2] AS S_Impact, sc[3] AS S_Implement, len(sc) > 0 AS score_ok FROM c",
    "extract_criteria": f"WITH {_REPORTS} SELECT report_id, " + ", ".join(f"{_criterion(i)} AS {b}" for i, b in enumerate(BLOCKS)) + ", len(parts) = 5 AS criteria_ok FROM c",
    "footer_strip": f"WITH {_TEXTS} SELECT report_id, text FROM f",
    "error_code": f"WITH {_REPORTS}, d AS (SELECT report_id, CAST(CASE WHEN len(parts) <> 5 THEN 4 WHEN len(sc) = 0 THEN 3 WHEN NOT basic_ok THEN 2 ELSE 0 END AS INTEGER) AS error_code FROM c) SELECT *, error_code = 0 AS valid, CASE error_code {_MESSAGES} END AS message FROM d",
    "sentence_split": f"WITH {_SENTENCES} SELECT doc_id, CAST(pos AS INTEGER) AS pos, sentence FROM s",
    "negative_filter": f"WITH {_SENTENCES} SELECT CAST(doc_id AS VARCHAR) AS Number, {_BLOCK}[CAST(doc_id % 3 AS INTEGER) + 1] AS Block, CAST(pos AS INTEGER) AS pos, sentence FROM s WHERE regexp_matches(sentence, '{_NEGATIVE}')",
    "verdict_filter": f"WITH {_SENTENCES} SELECT doc_id, CAST(pos AS INTEGER) AS pos, ({' OR '.join(f'''contains(lower(sentence), '{w}')''' for w in CORPUS_WORDS)}) AND length(trim(sentence)) < 60 AS verdict_only, regexp_matches(sentence, '{_NEGATIVE}') AS negative FROM s",
    "clean_sentences": rf"WITH {_SENTENCES} SELECT doc_id, CAST(pos AS INTEGER) AS pos, trim(regexp_replace(regexp_replace(lower(sentence), '(?:{NOISE})', ' ', 'g'), '\s+', ' ', 'g')) AS cleaned FROM s",
    "row_limit": "SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id LIMIT 25",
    "cosine_matrix": f"WITH {_SIMS} SELECT vec_id, Block, topic, round(val, 6) AS val FROM rk",
    "topk_threshold": f"WITH {_SIMS}, hit AS (SELECT * FROM rk WHERE k <= 3 AND val >= {SIMILARITY}) SELECT vec_id, Block, CAST(k - 1 AS INTEGER) AS k, topic, round(val, 6) AS val FROM hit UNION ALL SELECT vec_id, Block, 0, 'unclassified', round(val, 6) FROM rk WHERE k = 1 AND val < {SIMILARITY}",
    "top_two_topics": f"WITH {_SIMS} SELECT a.vec_id, a.Block, a.topic AS primary_topic, b.topic AS secondary_topic, round(a.val - b.val, 6) AS lead FROM rk a JOIN rk b ON a.vec_id = b.vec_id AND a.Block = b.Block AND a.k = 1 AND b.k = 2",
    "centroid_topics": f"WITH {_INDEX} SELECT Block, CAST(topic_ord AS INTEGER) AS topic_ord, topic, 1.0::DOUBLE AS self, round(tv[1], 6) AS first, CAST(len(tv) AS INTEGER) AS dim FROM ix",
    "classified_rows": f'WITH {_CLASSIFIED} SELECT sentence, primary_topic, round(primary_val, 6) AS primary_val, secondary_topic, round(secondary_val, 6) AS secondary_val, "Call", Activity, Number, Score, Block FROM cl',
    "iqr_outliers": """WITH q AS (SELECT l_partkey, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3, count(*) AS n FROM lineitem GROUP BY 1)
        SELECT l_orderkey, l_linenumber, l.l_partkey, round(q1, 6) AS q1, round(q3, 6) AS q3, n >= 4 AND l_extendedprice > q3 + 1.5 * (q3 - q1) AS is_outlier FROM lineitem l JOIN q ON l.l_partkey = q.l_partkey""",
    "ambiguity_status": f"WITH {_FLAGGED} SELECT Number, Block, sentence, primary_topic, round(ambiguity_ratio, 6) AS ambiguity_ratio, is_outlier, is_ambiguous, classification_status FROM st",
    "all_raw_data": f'WITH {_FLAGGED}, w AS ({_both("primary_val", "secondary_val")}) SELECT sentence, keyword, round(dist, 6) AS dist, "Call", Activity, Number, Score, Block, classification FROM w',
    "weighted_blocks": f"WITH {_FLAGGED} {_WEIGHTS}",
    "activity_report": f"""WITH {_pivoted(BLOCKS[0])}, t AS (SELECT *, {_RANK} AS r FROM p), x AS (SELECT Activity, string_agg('- ' || sentence, chr(10) ORDER BY r) AS Top_{N_TOP}_Sentences FROM t WHERE r <= {N_TOP} GROUP BY 1),
        m AS (SELECT Activity, {_FIRST}, {_TOP} FROM p GROUP BY 1) SELECT m.*, x.Top_{N_TOP}_Sentences FROM m JOIN x USING (Activity)""",
    "top_n_sentences": "WITH t AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS r FROM documents) SELECT source, string_agg('- ' || CAST(doc_id AS VARCHAR), chr(10) ORDER BY r) AS top FROM t WHERE r <= 3 GROUP BY 1",
    "union_by_name": "SELECT doc_id, lang, source, n_chars FROM documents UNION ALL SELECT item_id, NULL, NULL, length(text) FROM benchmark",
    "mask_literals": f"""WITH a AS (SELECT doc_id, lang, source, {_MASK('text', 'CAST(n_chars AS VARCHAR)', '[NUMBER]')} AS t FROM documents), b AS (SELECT doc_id, source, {_MASK('t', 'lang', '[ACRONYM]')} AS t FROM a)
        SELECT doc_id, {_MASK('t', 'source', '[TITLE]')} AS masked FROM b""",
    "mask_list_column": f"SELECT doc_id, CAST(len(string_split(text, chr(10))) AS INTEGER) AS lines, array_to_string(list_transform(string_split(text, chr(10)), lambda c: {_MASK('c', 'lang', '[ACRONYM]')}), chr(10)) AS masked FROM documents",
    "mask_context": f"SELECT doc_id, {_names('text')} AS masked FROM documents",
    "mask_acronyms": f"SELECT doc_id, {_capitals('text')} AS masked FROM documents",
    "anonymize_reports": f"SELECT CAST(doc_id AS VARCHAR) AS Number, {', '.join(map(_own, range(3)))} FROM documents",
    "default_negative": f"""WITH {_SENTENCES}, p AS (SELECT doc_id, pos, sentence || [{', '.join(f"'{x}'" for x in PHRASES)}][(doc_id + pos) % {len(PHRASES)} + 1] AS t FROM s)
        SELECT doc_id, CAST(pos AS INTEGER) AS pos, regexp_matches(t, '(?i){NEGATIVE}') AS negative, regexp_matches(lower(t), 'shortcoming|weakness') AND length(trim(t)) < 60 AS verdict_only FROM p""",
    "encoded_topics": f"""WITH d AS (SELECT doc_id, {_BLOCK}[CAST(doc_id % 3 AS INTEGER) + 1] AS Block, {_letters("coalesce(text, '')")} AS v FROM documents),
        c AS (SELECT col0 AS Block, col1 AS topic_ord, col2 AS topic, {_letters('col3')} AS tv FROM (VALUES {_CATALOG})),
        m AS (SELECT doc_id, Block, topic, topic_ord, list_cosine_similarity(v, tv) AS val FROM d JOIN c USING (Block) WHERE list_sum(v) > 0),
        k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY val DESC, topic_ord) AS k FROM m)
        SELECT doc_id, Block, topic, round(val, 6) AS val FROM k WHERE k = 1""",
    "aes_roundtrip": "SELECT c_custkey, c_name AS decoded, CAST(28 + strlen(c_name) AS INTEGER) AS coded_bytes, true AS differs FROM customer",
    "csv_roundtrip": "SELECT doc_id, source, CAST(length(text) AS INTEGER) AS chars, sha256(text) AS digest FROM documents",
    "parquet_roundtrip": "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
    "workbook_counts": f"WITH {_pivoted()}, n AS (SELECT 'All_raw_data' AS sheet, count(*) AS n FROM w "
    + " ".join(f"UNION ALL SELECT '{s}', count(*) FROM p WHERE Block = '{b}' UNION ALL SELECT '{s}_Summary', count(DISTINCT Activity) FROM p WHERE Block = '{b}'" for b, s in SHEET_OF_BLOCK.items())
    + ") SELECT * FROM n WHERE n > 0",
    "summaries": r"""WITH t AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY 1)
        SELECT conv_id, array_to_string(list_filter(string_split_regex(trim(text), '\s+'), lambda w: w <> '')[1:120], ' ') AS summary FROM t""",
    "zip_scan": "SELECT CAST(n_nationkey AS VARCHAR) || '.zip' AS archive, 'inner.zp!' || CAST(n_nationkey AS VARCHAR) || '_ESR.pdf' AS source_path, CAST(n_nationkey AS VARCHAR) || '_ESR.pdf' AS stored_as, 'C' || CAST(n_nationkey AS VARCHAR) AS \"Call\", regexp_extract(n_name, '^\\S+') AS Activity, 4.5::DOUBLE AS score, CAST(4 AS INTEGER) AS error_code FROM nation",
} | {f"pivot_{s.lower()}": f"WITH {_pivoted(b)} SELECT {_KEYS}, {_ROUNDED} FROM p" for b, s in SHEET_OF_BLOCK.items()}

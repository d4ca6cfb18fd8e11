"""Relational chat formatting: DataFrame expressions only.

Turns are collected as structs, sorted, and adjacent turns of one role become
one block by array functions; blocks are concatenated into one string with a
loss mask. Every marker of the template starts with ``<``; in roles and texts
``\\`` becomes ``\\b`` and ``<`` becomes ``\\l``, so a text can't imitate a
marker and escaping is reversible for every text:

    <turn>user<text>first<more>second</turn><turn>assistant<text>reply</turn>

``<more>`` stands between the texts of merged turns, so that reading the string
back yields the original turns.

Defined cases: a null text is the empty text, a null role the empty role (two
null or empty roles count as the same role); turns that tie in ``turn`` are
ordered by role, then text; repeated rows are repeated turns; null ``turn``
comes first; a null conv_id is a conversation of its own; an empty table gives
an empty result; columns beside the four are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, MORE, END = "<turn>", "<text>", "<more>", "</turn>"
LOSS_ROLE = "assistant"

#: Running offsets are built from sums over chunks of so many texts, so that a
#: conversation of n turns costs about n * (n / CHUNK + CHUNK) additions.
CHUNK = 256
#: The loss text is read in windows of so many spans.
RUN = 16


def _escaped(column: str) -> str:
    return f"replace(replace({column}, '\\\\', '\\\\b'), '<', '\\\\l')"


def _unescaped(column: str) -> str:
    # every backslash in the output is followed by b or l, so this order is exact
    return f"replace(replace({column}, '\\\\l', '<'), '\\\\b', '\\\\')"


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, which is computed once.

    A column used inside a lambda would be inlined there and computed for every element.
    """
    return f"transform(array({value}), {name} -> {body})[0]"


def format_conversations(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, turn, role, text) to one row per conversation.

    Returns conv_id, n_blocks int, formatted string and loss_mask
    array<struct<start bigint, chars bigint>>: the code points of ``formatted``
    that a model is trained on, which are the escaped texts of ``loss_role``.
    """
    role = loss_role.replace("\\", "\\\\").replace("'", "\\'")
    collected = turns.groupBy("conv_id").agg(
        F.expr("collect_list(struct(coalesce(turn, -9223372036854775808) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text))").alias("collected")
    )
    # a block starts where the role changes; each block is a slice of the sorted turns
    firsts = "filter(sequence(0, size(turns) - 1), i -> i = 0 OR get(turns, i).role != get(turns, i - 1).role)"
    blocks = f"""transform(firsts, (f, j) -> struct(
        get(turns, f).role AS role,
        transform(slice(turns, f + 1, coalesce(get(firsts, j + 1), size(turns)) - f), t -> {_escaped("t.text")}) AS texts))"""
    # one row of pieces: what stands before a text, the text, and whether it is trained on
    pieces = f"""flatten(transform(blocks, (b, j) -> transform(b.texts, (x, i) -> struct(
        CASE WHEN i > 0 THEN '{MORE}' ELSE concat(IF(j > 0, '{END}', ''), '{TURN}', {_escaped("b.role")}, '{TEXT}') END AS before,
        x AS text,
        b.role = '{role}' AS loss))))"""
    ends = "transform(pieces, p -> CAST(length(p.before) + length(p.text) AS BIGINT))"
    sums = f"transform(sequence(0, (size(ends) - 1) DIV {CHUNK}), c -> aggregate(slice(ends, c * {CHUNK} + 1, {CHUNK}), 0L, (a, x) -> a + x))"
    mask = f"""filter(transform(pieces, (p, i) -> struct(
        aggregate(slice(sums, 1, i DIV {CHUNK}), 0L, (a, x) -> a + x)
          + aggregate(slice(ends, (i DIV {CHUNK}) * {CHUNK} + 1, i % {CHUNK}), 0L, (a, x) -> a + x) + length(p.before) AS start,
        CAST(length(p.text) AS BIGINT) AS chars,
        p.loss AS loss)), m -> m.loss AND m.chars > 0)"""
    row = f"""struct(
        size(blocks) AS n_blocks,
        concat(array_join(transform(pieces, p -> concat(p.before, p.text)), ''), '{END}') AS formatted,
        transform({mask}, m -> struct(m.start AS start, m.chars AS chars)) AS loss_mask)"""
    for name, value in (("sums", sums), ("ends", ends), ("pieces", pieces), ("blocks", blocks), ("firsts", firsts), ("turns", "array_sort(collected)")):
        row = _let(name, value, row)
    return collected.select("conv_id", F.expr(row).alias("r")).select("conv_id", "r.n_blocks", "r.formatted", "r.loss_mask")


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds to formatted conversations what their strings say.

    turns: array<struct<role, text>>, merged turns apart again and unescaped;
    loss_text: all text under the loss mask, unescaped.
    """
    blocks = f"transform(slice(parts, 2, greatest(size(parts) - 1, 0)), b -> split(left(b, length(b) - {len(END)}), '{TEXT}', -1))"
    turns = f"""flatten(transform({blocks}, b -> transform(split(b[1], '{MORE}', -1), x -> struct(
        {_unescaped("b[0]")} AS role, {_unescaped("x")} AS text))))"""
    # spans are cut out of windows of RUN spans, so that long conversations aren't walked through for each span
    window = f"""struct(get(mask, w * {RUN}).start AS start,
        substring(formatted, CAST(get(mask, w * {RUN}).start + 1 AS INT),
                  CAST(get(mask, least((w + 1) * {RUN}, size(mask)) - 1).start + get(mask, least((w + 1) * {RUN}, size(mask)) - 1).chars - get(mask, w * {RUN}).start AS INT)) AS text)"""
    spans = f"""transform(slice(mask, w * {RUN} + 1, {RUN}), m -> {_unescaped("substring(v.text, CAST(m.start - v.start + 1 AS INT), CAST(m.chars AS INT))")})"""
    windows = f"flatten(transform(filter(sequence(0, size(mask) DIV {RUN}), w -> w * {RUN} < size(mask)), w -> {_let('v', window, spans)}))"
    return formatted.select(
        *formatted.columns,
        F.expr(_let("parts", f"split(formatted, '{TURN}', -1)", turns)).alias("turns"),
        F.expr(_let("mask", "loss_mask", f"array_join({windows}, '')")).alias("loss_text"),
    )

"""Relational chat formatting (native: DataFrame expressions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template's control strings.
START, END, JOIN, BREAK = "<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|nl|>"


def _escaped(x: str) -> str:
    """SQL: one backslash more between each '<', its backslashes, and a '|'."""
    return rf"regexp_replace({x}, r'<(\\*)\|', r'<$1\\|')"


def _plain(x: str) -> str:
    """SQL: undoes _escaped."""
    return rf"regexp_replace({x}, r'<\\(\\*)\|', r'<$1|')"


def _with_starts(df: DataFrame, lengths: str, part: int = 256) -> DataFrame:
    """Adds starts: for each of an array's lengths the sum of those before it.

    Sums run inside parts of the array and over the parts' sums, so the time grows with the array's
    length and not with its square.
    """
    total = "0L, (a, x) -> a + x"
    return (
        df.withColumn("chunks", F.expr(f"transform(sequence(0, greatest(size({lengths}) - 1, 0) div {part}), c -> slice({lengths}, cast(c * {part} + 1 as int), {part}))"))
        .withColumn("sums", F.expr(f"transform(chunks, c -> aggregate(c, {total}))"))
        .withColumn("bases", F.expr(f"transform(sequence(1, size(sums)), c -> aggregate(slice(sums, 1, c - 1), {total}))"))
        .withColumn("starts", F.expr(f"flatten(transform(arrays_zip(chunks, bases), z -> transform(z.chunks, (y, i) -> z.bases + aggregate(slice(z.chunks, 1, i), {total}))))"))
        .drop("chunks", "sums", "bases")
    )


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    r"""One row for each conversation: conv_id, formatted, loss_spans.

    Turns are collected as structs and sorted; neighbours with the same role become one block
    `<|im_start|>role\ntext<|im_sep|>text<|im_end|>\n`. A '<' that backslashes (or nothing) and a
    '|' follow gets one backslash more in texts and roles, and a line break in a role becomes
    `<|nl|>` after that, so the template can be read back exactly. loss_spans lists start (from 0)
    and length in code points of each assistant text.

    Defined cases: a null text or role is an empty one; equal turn numbers go by role, then text;
    repeated rows are separate turns; null turn numbers come first; a null conv_id is a
    conversation of its own; further columns are dropped; an empty table gives an empty result.
    """
    one = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    pieces = (
        sorted_turns.withColumn("firsts", F.expr("filter(sequence(0, size(ts) - 1), i -> i = 0 or ts[i].role != ts[greatest(i - 1, 0)].role)"))
        .withColumn(
            "blocks",
            F.expr("transform(firsts, (s, j) -> struct(ts[s].role as role, slice(ts, s + 1, coalesce(get(firsts, j + 1), size(ts)) - s) as parts))"),
        )
        .withColumn(
            "pieces",
            F.expr(
                f"""flatten(transform(blocks, b -> concat(
                    array(struct(concat('{START}', replace({_escaped('b.role')}, '\\n', '{BREAK}'), '\\n') as s, false as loss)),
                    flatten(transform(b.parts, (p, j) -> array(
                        struct(if(j = 0, '', '{JOIN}') as s, false as loss),
                        struct({_escaped('p.text')} as s, b.role = 'assistant' as loss)))),
                    array(struct('{END}\\n' as s, false as loss)))))"""
            ),
        )
        .withColumn("lengths", F.expr("transform(pieces, p -> cast(char_length(p.s) as bigint))"))
    )
    spans = "transform(filter(arrays_zip(pieces, starts, lengths), z -> z.pieces.loss), z -> struct(z.starts as start, z.lengths as length))"
    return _with_starts(pieces, "lengths").select("conv_id", F.expr("array_join(transform(pieces, p -> p.s), '')").alias("formatted"), F.expr(spans).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text) and loss_text, all from formatted and its spans.

    The text is split at its control strings once. Where the spans are those of the assistant's
    parts, as format_chat makes them, their texts are taken from there; other spans are cut out of
    the text one by one.
    """
    head, tail = len(START) + 1, len(END) + 1
    cut = f"array_join(transform(loss_spans, s -> {_plain('substring(formatted, cast(s.start + 1 as int), cast(s.length as int))')}), '')"
    parts = (
        formatted.withColumn("blocks", F.expr(r"split(formatted, r'<\|im_end\|>\n', -1)"))
        .withColumn("blocks", F.expr(f"transform(slice(blocks, 1, size(blocks) - 1), b -> substring(b, {head}))"))
        .withColumn(
            "parts",
            F.expr(
                rf"""flatten(transform(blocks, (b, i) -> transform(
                    split(substring(b, locate('\n', b) + 1), r'<\|im_sep\|>', -1),
                    (p, j) -> struct(substring_index(b, '\n', 1) as role, p as raw,
                        cast(if(j > 0, {len(JOIN)}, if(i > 0, {tail}, 0) + {head} + char_length(substring_index(b, '\n', 1))) as bigint) as gap))))"""
            ),
        )
        .withColumn("lengths", F.expr("transform(parts, p -> p.gap + char_length(p.raw))"))
    )
    told = _with_starts(parts, "lengths").withColumn("told", F.expr("filter(arrays_zip(parts, starts), z -> z.parts.role = 'assistant')"))
    same = "transform(told, z -> struct(z.starts + z.parts.gap as start, cast(char_length(z.parts.raw) as bigint) as length)) = loss_spans"
    return told.select(
        *formatted.columns,
        F.expr(rf"transform(parts, p -> struct({_plain(f"replace(p.role, '{BREAK}', '\n')")} as role, {_plain('p.raw')} as text))").alias("turns"),
        F.expr(f"if({same}, array_join(transform(told, z -> {_plain('z.parts.raw')}), ''), {cut})").alias("loss_text"),
    )

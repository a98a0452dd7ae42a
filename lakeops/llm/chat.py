"""Chat formatting: marked turns and one training example per assistant turn.

Only DataFrame expressions. A conversation is formatted once; an example is that text up to the
end of its reply, so examples are places in it and take no more room than the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.native import let, running_starts

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Text in which no control string can occur."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    """As :func:`escape`, on one line."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\;"))


def unescape_role(role: Column) -> Column:
    # A backslash before ";" counts only after an even number of them.
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\;", "$1\n"))


def format_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``replies``.

    Each turn becomes ``<|im_start|>role``, a line break, the text and ``<|im_end|>`` with a line
    break; control strings inside roles and texts are escaped reversibly. ``replies`` has one entry
    per assistant turn, in order: ``start`` (code points before its mark, which is the length
    of its context), ``loss_start`` and ``loss_end`` (the trainable text).

    Null roles and texts are empty, null turns come first, and equal turn numbers are ordered by role
    and text, so repeated rows stay repeated turns. Rows without a conversation id are one
    conversation. An empty table gives an empty result; further columns are ignored.
    """
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv_id"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        ).alias("said"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    marked = grouped.select(
        "conv_id",
        F.transform(
            "said",
            lambda t: F.struct(
                (t["role"] == TRAINED_ROLE).alias("trained"),
                F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
                escape(t["text"]).alias("body"),
            ),
        ).alias("parts"),
    )

    def replies(parts: Column) -> Column:
        whole = len(END)
        starts = running_starts(parts, lambda p: F.char_length(p["head"]) + F.char_length(p["body"]) + whole)
        placed = F.zip_with(
            parts,
            starts,
            lambda p, s: F.struct(
                p["trained"].alias("trained"),
                s.alias("start"),
                (s + F.char_length(p["head"])).alias("loss_start"),
                (s + F.char_length(p["head"]) + F.char_length(p["body"])).alias("loss_end"),
            ),
        )
        return F.transform(
            F.filter(placed, lambda p: p["trained"]),
            lambda p: F.struct(p["start"], p["loss_start"], p["loss_end"]),
        )

    return marked.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        replies(F.col("parts")).alias("replies"),
    )


def prefix_targets(formatted: DataFrame, context: bool = True) -> DataFrame:
    """One row per assistant turn: the example whose only trainable text is that reply.

    Columns ``conv_id``, ``example`` (0, 1, ...), ``context_chars``, ``loss_start``, ``loss_end``
    (code points of the example's text), ``reply`` (the trainable text as formatted) and, with
    ``context``, ``text``: all preceding turns and the reply's turn. Texts of all examples together
    grow with the square of a conversation's length; without ``context`` nothing does, and an
    example is the formatted conversation's first ``loss_end`` code points and the end mark.
    A conversation without assistant turns has no examples.
    """

    def example(r: Column) -> Column:
        size = r["loss_end"] - r["loss_start"]
        fields = [
            r["start"].alias("context_chars"),
            r["loss_start"].alias("loss_start"),
            r["loss_end"].alias("loss_end"),
            F.substring(F.col("formatted"), (r["loss_start"] + 1).cast("int"), size.cast("int")).alias("reply"),
        ]
        if context:
            fields.append(F.substring(F.col("formatted"), F.lit(1), (r["loss_end"] + len(END)).cast("int")).alias("text"))
        return F.struct(*fields)

    examples = formatted.select("conv_id", F.posexplode(F.transform("replies", example)).alias("example", "e"))
    return examples.select("conv_id", "example", "e.*")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of ``role`` and ``text``, as they were given."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    turns = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        return let(
            F.instr(piece, F.lit("\n")),
            lambda at: F.struct(
                unescape_role(F.substring(piece, F.lit(len(START) + 1), at - len(START) - 1)).alias("role"),
                unescape(F.substring(piece, at + 1, F.char_length(piece))).alias("text"),
            ),
        )

    return F.transform(turns, turn)

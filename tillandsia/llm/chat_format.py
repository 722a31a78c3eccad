"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as
context and only its text trainable. Turns after the last assistant turn, and
conversations without one, form an example with nothing trainable, so the
examples of a conversation hold all of it. Only DataFrame functions are used.

A turn reads ``<s>[INST]role[/INST]text</s>``. Control strings inside a role
or text get a backslash after their first character, and those that already
have backslashes there get one more, so no text holds a control string and
removing one backslash gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings of the template. None holds ``<`` or ``[`` after its start.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
_REST = r"s>|/s>|INST\]|/INST\]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)(" + _REST + ")", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)(" + _REST + ")", r"$1$2$3")


def chat_examples(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    target_role: str = "assistant",
) -> DataFrame:
    """``(conv_id, example, formatted, loss_start, loss_chars)``, one row per example.

    ``formatted`` is the context and the target turn; the loss mask is the
    ``loss_chars`` characters from offset ``loss_start`` (from 0, code points):
    the target's escaped text, without the marks around it. ``example`` counts
    from 0; the largest one holds the whole conversation. Rows are ordered by
    turn, equal turns by role and then text, null turns first; repeated rows
    stay turns of their own. A null role or text counts as empty. Rows with a
    null conversation form one conversation. An empty table gives no rows.
    Other columns are ignored, whatever their names.
    """
    turns = conversations.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    marked = turns.select(
        "conv_id",
        F.struct(
            "t.turn",
            "t.role",
            "t.text",
            F.concat(F.lit("<s>[INST]"), escaped(F.col("t.role")), F.lit("[/INST]")).alias("head"),
            escaped(F.col("t.text")).alias("body"),
        ).alias("t"),
    )
    whole = marked.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    ends = F.expr(
        "filter(sequence(1, size(turns)), i -> i = size(turns) OR turns[i - 1].role = '{}')".format(
            target_role.replace("'", r"\'")
        )
    )
    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit("</s>")))
    examples = whole.select("conv_id", "turns", pieces.alias("pieces"), F.posexplode(ends).alias("example", "end"))
    target = F.col("turns")[F.col("end") - 1]
    context = F.array_join(F.slice("pieces", F.lit(1), F.col("end") - 1), "")
    is_target = target["role"] == target_role
    start = F.char_length("context") + F.char_length("target.head")
    return examples.select(
        "conv_id",
        "example",
        context.alias("context"),
        target.alias("target"),
        F.col("pieces")[F.col("end") - 1].alias("piece"),
        is_target.alias("is_target"),
    ).select(
        "conv_id",
        "example",
        F.concat("context", "piece").alias("formatted"),
        F.when(F.col("is_target"), start).otherwise(F.lit(0)).cast("bigint").alias("loss_start"),
        F.when(F.col("is_target"), F.char_length("target.body")).otherwise(F.lit(0)).cast("bigint").alias("loss_chars"),
    )


def parsed_turns(formatted: Column) -> Column:
    """The turns of a formatted example as an array of ``(role, text)``."""
    # nothing follows the last </s>
    parts = F.split(formatted, "</s>", -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(
        F.transform(parts, lambda p: F.split(p, r"\[/INST\]", 2)),
        lambda p: F.struct(
            unescaped(F.substring(p[0], len("<s>[INST]") + 1, 2**31 - 1)).alias("role"),
            unescaped(p[1]).alias("text"),
        ),
    )


def loss_text(formatted: Column, loss_start: Column, loss_chars: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescaped(F.substring(formatted, loss_start.cast("int") + 1, loss_chars.cast("int")))

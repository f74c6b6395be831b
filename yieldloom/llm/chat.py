"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and only its text under the
loss mask. A conversation whose last turn is somebody else's gives one more example without a target, so that no
turn is lost. Turns are marked with the control strings below; inside texts and role names a backslash goes behind
the first character of a control string, and backslashes are doubled, so marks never occur in a text and every text
can be read back.

Nulls: a null text or role is empty; rows without a conversation id form one conversation. Turns come by number (null
first), then role, then text. Repeated rows stay. A conversation without assistant turns gives one example without a
target. An empty table gives no examples. Columns other than the four named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
USER = ("[INST] ", " [/INST]")
ASSISTANT = (" ", " </s>")
SYSTEM = ("<<SYS>> ", " <</SYS>>")
OTHER = ("[ROLE] ", " [ROLE] ", " [/ROLE]")
CONTROL_START = r"(\\|<(?=/?s>|</?SYS>>)|\[(?=/?(?:INST|ROLE)\]))"
ONE_TURN = r"(?s)(<<SYS>> .*? <</SYS>>|\[INST\] .*? \[/INST\]|\[ROLE\] .*? \[/ROLE\]| .*? </s>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL_START, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\|<|\[)\\", "$1")


def mark(role: Column, text: Column) -> Column:
    """One turn between its marks."""
    body = escape(text)
    return (
        F.when(role == "user", F.concat(F.lit(USER[0]), body, F.lit(USER[1])))
        .when(role == "assistant", F.concat(F.lit(ASSISTANT[0]), body, F.lit(ASSISTANT[1])))
        .when(role == "system", F.concat(F.lit(SYSTEM[0]), body, F.lit(SYSTEM[1])))
        .otherwise(F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]), body, F.lit(OTHER[2])))
    )


def _inside(turn: Column, marks: tuple[str, str]) -> Column:
    before, after = marks
    return F.substring(turn, F.lit(len(before) + 1), F.length(turn) - len(before) - len(after))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""

    def read(turn: Column) -> Column:
        other = F.split(_inside(turn, (OTHER[0], OTHER[2])), r" \[ROLE\] ", 2)
        role = (
            F.when(turn.startswith(USER[0]), "user")
            .when(turn.startswith(SYSTEM[0]), "system")
            .when(turn.startswith(OTHER[0]), unescape(other[0]))
            .otherwise("assistant")
        )
        body = (
            F.when(turn.startswith(USER[0]), _inside(turn, USER))
            .when(turn.startswith(SYSTEM[0]), _inside(turn, SYSTEM))
            .when(turn.startswith(OTHER[0]), other[1])
            .otherwise(_inside(turn, ASSISTANT))
        )
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(ONE_TURN), F.lit(1)), read)


def prefix_target_examples(conversations: DataFrame) -> DataFrame:
    """Rows ``(conv_id, example, n_turns, formatted, loss_start, loss_chars, is_whole)``.

    ``loss_start`` (0-based) and ``loss_chars`` are code points of ``formatted``; an example without a target has
    0 and 0. ``is_whole`` marks the example that holds every turn of the conversation.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(2**62))).alias("turn"), "role", "text"))).alias("turns"))
    marked = turns.select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), mark(t["role"], t["text"]).alias("turn"))).alias("turns"),
    ).withColumn("n", F.size("turns"))
    wanted = F.filter(
        F.sequence(F.lit(1), F.col("n")),
        lambda k: (F.element_at("turns", k)["role"] == "assistant") | (k == F.col("n")),
    )
    each = marked.select("conv_id", "turns", "n", F.explode(wanted).alias("example"))
    last = F.element_at("turns", F.col("example"))
    is_target = last["role"] == "assistant"
    before = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("example") - 1), lambda t: t["turn"]), "")
    cut = each.select("conv_id", "example", "n", before.alias("before"), last["turn"].alias("reply"), is_target.alias("is_target"))
    return cut.select(
        "conv_id",
        "example",
        F.col("example").alias("n_turns"),
        F.concat("before", "reply").alias("formatted"),
        F.when(F.col("is_target"), F.length("before") + len(ASSISTANT[0])).otherwise(0).alias("loss_start"),
        F.when(F.col("is_target"), F.length("reply") - len("".join(ASSISTANT))).otherwise(0).alias("loss_chars"),
        F.col("is_target").alias("has_target"),
        (F.col("example") == F.col("n")).alias("is_whole"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Digest of each conversation, taken from the formatted examples alone."""
    target = unescape(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_chars")))
    turns = read_turns(F.col("formatted"))
    as_text = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = examples.select(
        "conv_id",
        F.when(F.col("has_target"), F.struct("example", target.alias("text"))).alias("target"),
        F.length("formatted").alias("chars"),
        F.when(F.col("is_whole"), F.size(turns)).alias("n_turns"),
        F.when(F.col("is_whole"), F.sha2(as_text, 256)).alias("turns_sha256"),
    )
    grouped = read.groupBy("conv_id").agg(
        F.max("n_turns").cast("long").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.transform(F.array_sort(F.collect_list("target")), lambda t: t["text"]), "").alias("loss"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
    return grouped.select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )

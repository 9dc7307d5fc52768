r"""Chat formatting with a grammar round trip.

A turn is written as `### role: text </turn>` and a line end, a conversation as a head line with the
level of escaping, then its turns in order. The writer starts at level 0, nothing escaped, reads its
output with the parser below and compares the turns; where they differ, or a text holds a control
string, the conversation is written again at level 1: every `### name: ` and `</turn>` in a text, after
any number of backslashes, gets one more backslash. The parser takes one away again, and sees a
control string only where no backslash stands before it, so level 1 always reads back as it was.

All of it is column expressions; the turns of a conversation meet in one row, as its text does.

Null text is empty; a null role is an empty one; roles are percent-encoded. Rows of equal turn are
ordered by role, then text; null turns come first. Repeated rows are turns of their own. Empty table:
no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

ROLE = r"[A-Za-z0-9.*_%+-]*"
CONTROL = rf"### {ROLE}: |</turn>"
END = " </turn>\n"
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*(?:{CONTROL}))", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*(?:{CONTROL}))", "$1")


def render(turns: Column, level: int) -> Column:
    """Head line and turns as one text."""
    body = F.transform(
        turns,
        lambda t: F.concat(
            F.lit("### "), F.url_encode(t["role"]), F.lit(": "), escaped(t["text"]) if level else t["text"], F.lit(END)
        ),
    )
    return F.concat(F.lit(f"<chat escape={level}>\n"), F.array_join(body, ""))


def pieces(formatted: Column) -> Column:
    """The written turns: what stands between turn ends, without the head line."""
    body = F.regexp_replace(formatted, r"\A<chat escape=[01]>\n", "")
    return F.filter(F.split(body, r"(?<!\\)</turn>\n?"), lambda p: p != "")


HEADER = rf"(?s)\A### ({ROLE}): (.*) \z"


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation; null for a piece that is no turn."""
    level = F.regexp_extract(formatted, r"\A<chat escape=([01])>", 1)

    def turn(piece: Column) -> Column:
        raw = F.regexp_extract(piece, HEADER, 2)
        inside = raw.rlike(rf"(?<!\\)(?:{CONTROL})")
        return F.when(
            piece.rlike(HEADER) & ~inside,
            F.struct(
                F.url_decode(F.regexp_extract(piece, HEADER, 1)).alias("role"),
                F.when(level == "1", unescaped(raw)).otherwise(raw).alias("text"),
            ),
        )

    return F.transform(pieces(formatted), turn)


def format_turns(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    learned_role: str = LEARNED_ROLE,
) -> DataFrame:
    """One row per conversation: formatted, escape_level, loss_runs, round_trip.

    loss_runs gives the loss mask as runs of code points that cover the formatted text in order.
    round_trip says that the parser has read the source's turns back.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    talks = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("_all"))
    talks = talks.select(
        "conv_id", F.transform("_all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("_turns")
    )
    plain = talks.withColumn("_plain", render(F.col("_turns"), 0))
    tried = plain.withColumn("_same", F.coalesce(parse(F.col("_plain")) == F.col("_turns"), F.lit(False)))
    written = tried.select(
        "conv_id",
        "_turns",
        F.when(F.col("_same"), F.col("_plain")).otherwise(render(F.col("_turns"), 1)).alias("formatted"),
        F.when(F.col("_same"), 0).otherwise(1).alias("escape_level"),
    )
    read = written.withColumn("_read", parse(F.col("formatted"))).withColumn("_pieces", pieces(F.col("formatted")))
    return read.select(
        "conv_id",
        "formatted",
        "escape_level",
        loss_runs(F.col("_pieces"), F.length(F.regexp_substr("formatted", F.lit(r"\A[^\n]*\n"))), learned_role).alias("loss_runs"),
        F.coalesce(F.col("_read") == F.col("_turns"), F.lit(False)).alias("round_trip"),
    )


def loss_runs(written: Column, head: Column, learned_role: str) -> Column:
    """Runs of (chars, loss): head line, then of each turn the header, the text and the end."""

    def runs(piece: Column) -> Column:
        role = F.regexp_extract(piece, HEADER, 1)
        n_text = F.length(F.regexp_extract(piece, HEADER, 2))
        n_header = F.length(role) + len("### : ")
        learned = role == F.url_encode(F.lit(learned_role))
        return F.array(run(n_header, F.lit(False)), run(n_text, learned), run(F.lit(len(END)), F.lit(False)))

    def run(chars: Column, loss: Column) -> Column:
        return F.struct(chars.cast("long").alias("chars"), loss.alias("loss"))

    return F.concat(F.array(run(head, F.lit(False))), F.flatten(F.transform(written, runs)))


def masked_texts(formatted: Column, runs: Column) -> Column:
    """What stands under the loss mask, run by run, read from the formatted text."""
    cut = "array<struct<start: bigint, end: bigint>>"

    def step(at: Column, r: Column) -> tuple[Column, Column]:
        end = at + r["chars"]
        inside = F.array(F.struct(at.alias("start"), end.alias("end")))
        return end, F.when(r["loss"], inside).otherwise(F.array().cast(cut))

    return common.cut_out(formatted, common.walked(runs, step, cut))


def digests(formatted: DataFrame) -> DataFrame:
    """What the parser and the loss mask read back from the output, as digests."""
    read = formatted.withColumn("_turns", parse(F.col("formatted"))).withColumn(
        "_loss", masked_texts(F.col("formatted"), F.col("loss_runs"))
    )
    learned = F.array_join(F.transform("_loss", lambda t: F.when(F.col("escape_level") == 1, unescaped(t)).otherwise(t)), "")
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "escape_level",
        "round_trip",
    )

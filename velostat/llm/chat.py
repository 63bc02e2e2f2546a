"""Chat formatting with a grammar round trip (DataFrame functions only).

    conversation := turn*
    turn         := "<s>" role "\n" text "</s>"

Every turn is first rendered as it is.  A deterministic parser reads it back; if
the turn it finds is not the source, or a control string stands inside the text,
the content conflicts and is rendered again with one backslash put into every
control string (and one more into those that have backslashes already), which the
parser takes out.  The rendered conversation is parsed once more and compared.

Output: conv_id, formatted, segments (pieces of the formatted text in order, each
with its loss flag: texts of ``loss_role`` only) and identical (the result of the
comparison).

Defined results: NULL text and NULL role count as empty; turns are ordered by
(turn, role, text), NULL first, so ties and repeated rows have one order; NULL
conv_id is a conversation of its own; an empty table gives an empty one.  A
conversation is one output row, so its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<s>", "</s>"
# what may follow "<" or "[" in a control string: <s> </s> [INST] [/INST] <<SYS>> <</SYS>>
_TAIL = r"(?=/?s>|/?INST\]|</?SYS>>)"
_CONTROL = rf"[<\[]{_TAIL}"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){_TAIL}", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){_TAIL}", "$1$2")


def _encode_role(role: Column) -> Column:
    """One line: backslash doubled, newline as backslash n, then as any text."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _decode_role(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def render_turn(role: Column, body: Column) -> Column:
    return F.concat(F.lit(BEGIN), role, F.lit("\n"), body, F.lit(END))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation; NULL if the grammar does not fit."""
    parts = F.split(formatted, END)
    inside = F.slice(parts, F.lit(1), F.size(parts) - 1)
    fits = (F.get(parts, F.size(parts) - 1) == "") & F.forall(
        inside, lambda p: p.startswith(BEGIN) & p.contains("\n") & ~F.substr(p, F.lit(len(BEGIN) + 1)).rlike(_CONTROL)
    )

    def turn(p: Column) -> Column:
        line_end = F.locate("\n", p)
        head = F.substr(p, F.lit(len(BEGIN) + 1), line_end - F.lit(len(BEGIN) + 1))
        return F.struct(_decode_role(head).alias("role"), unescape(F.substr(p, line_end + 1)).alias("text"))

    return F.when(fits, F.transform(inside, turn))


def format_conversations(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    r = rows.select(
        F.col("conv_id"),
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    source = F.array(F.struct("role", "text"))
    r = r.withColumn("_head", _encode_role(F.col("role")))
    r = r.withColumn("_verbatim", parse(render_turn(F.col("_head"), F.col("text"))))
    body = F.when(F.col("_verbatim").eqNullSafe(source), F.col("text")).otherwise(escape(F.col("text")))
    r = r.withColumn("body", body)
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "_head", "body")))
    c = r.groupBy("conv_id").agg(turns.alias("_turns"))

    def pieces(t: Column) -> Column:
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        head = piece(F.concat(F.lit(BEGIN), t["_head"], F.lit("\n")), F.lit(False))
        return F.array(head, piece(t["body"], t["role"] == loss_role), piece(F.lit(END), F.lit(False)))

    c = c.withColumn("segments", F.flatten(F.transform("_turns", pieces)))
    c = c.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    said = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return c.select("conv_id", "formatted", "segments", parse(F.col("formatted")).eqNullSafe(said).alias("identical"))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from the output of ``format_conversations``."""
    t = formatted.withColumn("_turns", parse(F.col("formatted"))).withColumn(
        "_loss",
        F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), ""),
    )
    told = F.transform("_turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return t.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("_loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "identical",
    )

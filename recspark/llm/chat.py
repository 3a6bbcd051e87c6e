"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes one example: all turns up to it, formatted, with only that reply trainable.
A conversation that does not end with an assistant turn gives one more row without a trainable span, so that
its last turns are kept.  Turns are ordered by (turn, role, text), nulls first; a null role or text is empty;
repeated rows are repeated turns; rows without a conversation id are one conversation of their own.

A turn is ``### role: text</turn>`` and a line feed.  Inside texts and roles a backslash and the control strings
are replaced by two-character codes, so control strings occur in the output only as controls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "###", "</turn>"
TURN_END = CLOSE + "\n"
# Fixed codes; the backslash comes first when escaping and last when reading back.
CODES = [("\\", "\\0"), (OPEN, "\\1"), (CLOSE, "\\2"), (":", "\\3")]


def escape(text: Column, role: bool = False) -> Column:
    for plain, code in CODES if role else CODES[:3]:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_examples(conversations: DataFrame, conv="conv_id", turn="turn", role="role", text="text",
                    trained_role="assistant") -> DataFrame:
    """``conv_id, example, target, formatted, loss_start, loss_length``.

    ``example`` counts from 0 in a conversation; ``target`` is the place of the trained turn (null in a row kept
    for trailing turns); ``loss_start`` (from 0) and ``loss_length`` give the trainable code points of ``formatted``.
    Other columns of the input are ignored.  One conversation must fit a row, as its longest example does.
    """
    turns = F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                                                 F.coalesce(F.col(text), F.lit("")).alias("text"))))
    grouped = conversations.groupBy(F.col(conv).alias("conv_id")).agg(turns.alias("turns"))
    parts = F.transform("turns", lambda t: F.concat(F.lit(OPEN + " "), escape(t.role, role=True), F.lit(": "),
                                                    escape(t.text), F.lit(TURN_END)))
    places = F.filter(F.sequence(F.lit(0), F.size("turns") - 1),
                      lambda i: (F.get("turns", i).role == trained_role) | (i == F.size("turns") - 1))
    exploded = (grouped.select("conv_id", "turns", parts.alias("parts"), places.alias("places"))
                .select("conv_id", "turns", "parts", F.posexplode("places").alias("example", "place")))
    trained = F.get("turns", F.col("place")).role == trained_role
    body = F.char_length(escape(F.get("turns", F.col("place")).text))
    rows = exploded.select(
        "conv_id", "example", F.when(trained, F.col("place")).alias("target"),
        F.array_join(F.slice("parts", F.lit(1), F.col("place") + 1), "").alias("formatted"),
        F.when(trained, body).otherwise(0).alias("loss_length"))
    start = F.char_length("formatted") - len(TURN_END) - F.col("loss_length")
    return rows.select("conv_id", "example", "target", "formatted",
                       F.when(F.col("target").isNotNull(), start).otherwise(0).alias("loss_start"), "loss_length")


def trained_text(formatted="formatted", start="loss_start", length="loss_length") -> Column:
    """The unescaped text under the loss mask."""
    return unescape(F.substring(F.col(formatted), F.col(start) + 1, F.col(length)))


def parse_turns(formatted: Column) -> Column:
    """Reads ``array<struct<role, text>>`` back from a formatted example."""
    pieces = F.split(formatted, TURN_END, -1)
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece):
        header = F.substring_index(piece, ": ", 1)
        return F.struct(unescape(F.substring(header, F.lit(len(OPEN) + 2), F.char_length(header))).alias("role"),
                        unescape(F.substring(piece, F.char_length(header) + 3, F.char_length(piece))).alias("text"))

    return F.transform(whole, turn)


def digests(examples: DataFrame) -> DataFrame:
    """One row per conversation, read back from the examples: the longest holds all turns, each mask one reply."""
    per = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sort_array(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("example", trained_text().alias("reply"))))).alias("replies"),
        F.sum(F.char_length("formatted").cast("long")).alias("formatted_chars"))
    read = per.select("conv_id", "formatted_chars", parse_turns(F.col("whole")).alias("turns"),
                      F.array_join(F.transform("replies", lambda r: r.reply), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       "formatted_chars")

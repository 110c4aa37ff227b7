"""Chat formatting with Spark expressions only: turns to one marked string per conversation, and back.

A run of adjacent turns of one role becomes ``<s>[INST]role[/INST]text[JOIN]text</s>``. Marks inside roles and texts get
a backslash behind their bracket (``</s>`` becomes ``<\\/s>``), one more each time, so the way back is exact. The loss mask
is kept by segment: a conversation is an array of (text, loss) pieces whose concatenation is the formatted string, and
only assistant texts are under the mask.

Turns are ordered by (turn, role, text), nulls first; a null role or text is empty; a null conversation id is a
conversation; repeated rows are repeated turns; an empty table gives no rows; further columns are ignored. A conversation
is one string by definition, so its turns meet in one row; everything inside the row takes linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed values of the template.
BEGIN, END, ROLE_END, JOIN = "<s>[INST]", "</s>", "[/INST]", "[JOIN]"
_MARK = r"(/?(?:s>|INST\]|JOIN\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _MARK, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)\\" + _MARK, "$1$2$3")


def format_conversations(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """``(conv_id, turn, role, text)`` rows to ``(conv_id, segments array<struct<text, loss>>, formatted)``."""
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    # where a run of one role begins
    t = t.withColumn("starts", F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.col("turns")[i - 1]["role"])))

    def merged(start, k):
        end = F.coalesce(F.get("starts", k + 1), F.size("turns")) - 1
        texts = F.transform(F.sequence(start, end), lambda j: escape(F.col("turns")[j]["text"]))
        return F.struct(F.col("turns")[start]["role"].alias("role"), texts.alias("texts"))

    t = t.withColumn("runs", F.transform("starts", merged))

    def piece(text, loss):
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)

    def pieces(run):
        head = F.array(piece(F.concat(F.lit(BEGIN), escape(run["role"]), F.lit(ROLE_END)), no))
        body = F.flatten(
            F.transform(run["texts"], lambda x, i: F.array(piece(F.when(i > 0, F.lit(JOIN)).otherwise(F.lit("")), no), piece(x, run["role"] == learn)))
        )
        return F.concat(head, body, F.array(piece(F.lit(END), no)))

    out = t.select("conv_id", F.flatten(F.transform("runs", pieces)).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parse_formatted(formatted: Column) -> Column:
    """A formatted string back to its turns: array<struct<role, text>>."""
    runs = F.filter(F.split(formatted, END), lambda r: r != "")

    def turns_of(run):
        parts = F.split(run, r"\[/INST\]")
        role = unescape(F.substring(parts[0], len(BEGIN) + 1, 1 << 30))
        return F.transform(F.split(parts[1], r"\[JOIN\]"), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(runs, turns_of))


def masked_text(segments: Column) -> Column:
    """The texts under the loss mask, unescaped and concatenated."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def format_digest(formatted: DataFrame) -> DataFrame:
    """What was formatted, read back from the output."""
    back = formatted.select("conv_id", "formatted", parse_formatted(F.col("formatted")).alias("turns"), masked_text(F.col("segments")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )

"""Chat formatting with prefix targets, as DataFrame operations only.

Every turn is rendered once, with its control strings, at a running offset in its conversation: the
``segments``. Every assistant turn is an example of its own: all turns before it are context, and of the
example's text only the reply's is trainable. The ``examples`` are all written with their whole text and the span
under the loss mask. Where a conversation's examples take more than ``EXPANDED_CHARS`` together, each is put together
from its own segments and no row holds more than one example. Written contexts grow with the square of a conversation;
a caller who wants spans over the segments instead for such conversations gives the bound ``most`` (``text`` null).

Control strings inside texts are escaped by a backslash behind their first character, and one more
if there already are some, so that unescaping gives back every text.

Order of turns: turn number (null last), then role, then text. Cases: null text or role is empty; a
null conversation id is a conversation; repeated rows are turns of their own; a conversation without an
assistant turn has segments and no example; empty tables give empty tables; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The template's control strings.
BEGIN, END = "<s>", "</s>"
USER, USER_END = "[INST] ", " [/INST]"
ROLE, ROLE_END = "[ROLE] ", " [/ROLE]"

# Turns of one conversation that are numbered by one task at a time.
BLOCK_TURNS = 256
# Code points of all examples of one conversation that are cut from one row of its whole text.
EXPANDED_CHARS = 1 << 20

PLAIN = r"([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\]|/?ROLE\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def before_text(role: Column) -> Column:
    """What a turn has before its text; an assistant's reply follows the begin mark directly."""
    return (
        F.when(role == "assistant", F.lit(BEGIN))
        .when(role == "user", F.lit(BEGIN + USER))
        .otherwise(F.concat(F.lit(BEGIN + ROLE), escape(role), F.lit(ROLE_END)))
    )


def after_text(role: Column) -> Column:
    return F.when(role == "user", F.lit(USER_END + END)).otherwise(F.lit(END))


def key_of(conv_id: Column) -> Column:
    """The conversation as text, for joins and windows that keep a null id as a conversation."""
    return F.coalesce(conv_id.cast("string"), F.lit("-"))


def segments(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``conv_key, conv_id, position, is_reply, segment, start, text_start, text_end`` per turn.

    Positions and offsets count from 0 within the conversation; offsets are code points.
    They are cumulated within blocks of turn numbers and over the blocks' totals.
    """
    last_block = F.lit((1 << 63) - 1)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select(
        key_of(F.col("conv_id")).alias("conv_key"), F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce(F.floor(F.col("turn") / block_turns), last_block).alias("block"),
        role.alias("role"), text.alias("text"),
    )
    rendered = rows.select(
        "conv_key", "conv_id", "turn", "block", "role", "text", (F.col("role") == "assistant").alias("is_reply"),
        F.char_length(before_text(F.col("role"))).alias("lead"), F.char_length(escape(F.col("text"))).alias("body"),
        F.concat(before_text(F.col("role")), escape(F.col("text")), after_text(F.col("role"))).alias("segment"),
    ).withColumn("size", F.char_length("segment").cast("long"))

    totals = rendered.groupBy("conv_key", "block").agg(F.count("*").alias("turns"), F.sum("size").alias("chars"))
    earlier = W.partitionBy("conv_key").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        "conv_key", "block", F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("turns_ahead"),
        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars_ahead"),
    )
    order = W.partitionBy("conv_key", "block").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    inside = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rendered.withColumn("turn_no", F.row_number().over(order)).withColumn(
        "chars_to", F.sum("size").over(inside)
    )
    start = F.col("chars_ahead") + F.col("chars_to") - F.col("size")
    return placed.join(totals, ["conv_key", "block"]).select(
        "conv_key", "conv_id", (F.col("turns_ahead") + F.col("turn_no") - 1).alias("position"), "is_reply", "segment",
        start.alias("start"), (start + F.col("lead")).alias("text_start"), (start + F.col("lead") + F.col("body")).alias("text_end"),
    )


def examples(turns: DataFrame) -> DataFrame:
    """An example per assistant turn of ``segments``.

    The example is the formatted conversation up to ``end``; its context ends at
    ``context_end`` and code points ``loss_start`` to ``loss_end`` (exclusive) are trainable.
    """
    return turns.where("is_reply").select(
        "conv_key", "conv_id", "position", F.col("start").alias("context_end"),
        F.col("text_start").alias("loss_start"), F.col("text_end").alias("loss_end"),
        (F.col("start") + F.char_length("segment")).alias("end"),
    )


def materialized(turns: DataFrame, wanted: DataFrame) -> DataFrame:
    """``conv_key, conv_id, position, text, loss_start, loss_end`` with every context written out."""
    parts = turns.select("conv_key", F.col("position").alias("part"), "segment")
    joined = wanted.join(parts, "conv_key").where(F.col("part") <= F.col("position"))
    grouped = joined.groupBy("conv_key", "conv_id", "position", "loss_start", "loss_end").agg(
        F.array_sort(F.collect_list(F.struct("part", "segment"))).alias("parts")
    )
    return grouped.select(
        "conv_key", "conv_id", "position", F.array_join("parts.segment", "").alias("text"), "loss_start", "loss_end"
    )


def expanded(turns: DataFrame, most: int | None = None) -> DataFrame:
    """The examples with their ``text``; null where a conversation's examples pass ``most`` code points, if that is given."""
    wanted = examples(turns)
    sizes = wanted.groupBy("conv_key").agg(F.sum("end").alias("chars"))
    bound = EXPANDED_CHARS if most is None else most
    short = sizes.where(F.col("chars") <= bound).select("conv_key")
    # At most ``bound`` code points of segments meet: a conversation's last example holds all turns up to it.
    reach = wanted.groupBy("conv_key").agg(F.max("end").alias("reach"))
    parts = turns.join(short, "conv_key").join(reach, "conv_key").where(F.col("start") < F.col("reach"))
    whole = parts.groupBy("conv_key").agg(F.array_join(F.array_sort(F.collect_list(F.struct("start", "segment")))["segment"], "").alias("whole"))
    text = F.substring("whole", F.lit(1), F.col("end").cast("int"))
    if most is not None:
        return wanted.join(whole, "conv_key", "left").withColumn("text", text).drop("whole")
    cut = wanted.join(whole, "conv_key").withColumn("text", text).drop("whole")
    long = wanted.join(sizes.where(F.col("chars") > bound).select("conv_key"), "conv_key")
    texts = materialized(turns, long).select("conv_key", "position", "text")
    return cut.unionByName(long.join(texts, ["conv_key", "position"]))


def write(
    conversations: DataFrame, folder: str, block_turns: int = BLOCK_TURNS, most: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Write segments and expanded examples below ``folder``; both as they read back."""
    spark = conversations.sparkSession
    segments(conversations, block_turns).write.parquet(f"{folder}/segments")
    turns = spark.read.parquet(f"{folder}/segments")
    expanded(turns, most).write.parquet(f"{folder}/examples")
    return turns, spark.read.parquet(f"{folder}/examples")


def parsed(turns: DataFrame) -> DataFrame:
    """Role and text of every segment, from its control strings alone."""
    inner = F.col("segment").substr(F.lit(len(BEGIN) + 1), F.char_length("segment") - len(BEGIN) - len(END))
    rows = turns.withColumn("inner", inner)
    role_close = F.instr("inner", ROLE_END)

    def tail(first, dropped=0):
        return F.col("inner").substr(first, F.char_length("inner") - first + 1 - dropped)

    role = (
        F.when(F.col("inner").startswith(USER), "user")
        .when(F.col("inner").startswith(ROLE), unescape(F.col("inner").substr(F.lit(len(ROLE) + 1), role_close - len(ROLE) - 1)))
        .otherwise("assistant")
    )
    text = (
        F.when(F.col("inner").startswith(USER), tail(F.lit(len(USER) + 1), len(USER_END)))
        .when(F.col("inner").startswith(ROLE), tail(role_close + len(ROLE_END)))
        .otherwise(F.col("inner"))
    )
    return rows.withColumn("role", role).withColumn("text", unescape(text)).drop("inner")


def summary(turns: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per conversation what the written tables say: turns, text under the loss mask, sizes.

    A digest over a whole conversation needs its texts in one row; nothing else does.
    """
    length = (F.col("loss_end") - F.col("loss_start")).cast("int")
    # What is trainable is read from the example itself; the sizes are those of its text.
    spans = wanted.select(
        "conv_key", "position", "loss_start", "loss_end", F.col("text").substr((F.col("loss_start") + 1).cast("int"), length).alias("reply"),
        F.coalesce(F.char_length("text"), "end").cast("long").alias("example_end"),
    )
    read = parsed(turns).join(spans, ["conv_key", "position"], "left")
    masked = unescape(F.coalesce("reply", F.col("segment").substr((F.col("loss_start") - F.col("start") + 1).cast("int"), length)))
    line = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    grouped = read.select(
        "conv_key", "conv_id", F.char_length("segment").cast("long").alias("size"), "example_end",
        F.char_length(masked).cast("long").alias("loss"),
        F.struct("position", line.alias("line"), masked.alias("masked")).alias("turn"),
    ).groupBy("conv_key", "conv_id").agg(
        F.count("*").alias("n_turns"), F.array_sort(F.collect_list("turn")).alias("turns"),
        F.coalesce(F.sum("loss"), F.lit(0)).alias("loss_chars"), F.sum("size").alias("formatted_chars"),
        F.count("example_end").alias("n_examples"), F.coalesce(F.sum("example_end"), F.lit(0)).alias("example_chars"),
    )
    return grouped.select(
        "conv_id", "n_turns", F.sha2(F.array_join("turns.line", ""), 256).alias("turns_sha256"), "loss_chars",
        F.sha2(F.array_join("turns.masked", ""), 256).alias("loss_sha256"), "formatted_chars", "n_examples",
        "example_chars",
    )

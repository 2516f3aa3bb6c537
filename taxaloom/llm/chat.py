"""Conversations as training windows of whole turns within a token budget.

A turn is ``<|im_start|>role``, a line break, its text and ``<|im_end|>``. Prefix
sums of the turns' tokens choose where windows begin. A system turn at the head
of a conversation heads every window; after it a limited history of earlier
turns is repeated, and only what a window shows first is under the loss mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END = "<|im_start|>", "<|im_end|>"
WORD = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
TURN_TOKENS = 5   # of the marks around a turn


def escaped(text: Column) -> Column:
    """Text without any ``<|``: a backslash becomes ``\\0``, and ``\\1`` parts the two signs."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit("<|"), F.lit("<\\1|"))


def escaped_role(role: Column) -> Column:
    """A role that is one line as well: a line break becomes ``\\2``."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\2"))


def unescaped(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\\2"), F.lit("\n")), F.lit("\\1"), F.lit(""))
    return F.replace(text, F.lit("\\0"), F.lit("\\"))


def format_chats(turns: DataFrame, budget: int = 1024, history: int = 256) -> DataFrame:
    """(conv_id, window, text, repeated, loss_spans, n_tokens, n_turns) from (conv_id, turn, role, text).

    A window holds at most ``budget`` tokens (words and other signs of the
    texts, and the marks of turns), unless its system turn, history and one
    turn alone need more: turns are never cut. It repeats turns of at most
    ``history`` tokens before its first new one; ``repeated`` counts these and
    the repeated system turn. ``loss_spans`` are (start from 0, length) of the
    new assistant texts in ``text``.

    Null roles and texts are empty; rows are turns, ordered by turn, then role
    and text, repeated rows too; a null conversation is one of its own. The
    turns of a conversation meet in one row, as a window needs them in order.
    """
    rows = turns.select(
        "conv_id", "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    conv = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.select(
        "conv_id", "role", "turn", "text",
        (F.row_number().over(conv) - 1).alias("pos"),
        (F.regexp_count("text", F.lit(WORD)) + TURN_TOKENS).cast("long").alias("tokens"),
        escaped_role(F.col("role")).alias("head"), escaped(F.col("text")).alias("body"),
    ).withColumn("system", (F.col("pos") == 0) & (F.col("role") == "system"))
    order = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(
        "before", F.coalesce(F.sum(F.when(~F.col("system"), F.col("tokens"))).over(order), F.lit(0)).cast("long")
    )
    near = Window.partitionBy("conv_id", "system").orderBy("before").rangeBetween(-history, -1)
    rows = rows.select(
        "conv_id", "pos", "role", "tokens", "system",
        F.concat(F.lit(START), "head", F.lit("\n"), "body", F.lit(END + "\n")).alias("part"),
        (F.length("head") + len(START) + 1).alias("skip"), F.length("body").alias("chars"),
        F.when(F.col("system"), 0).otherwise(F.count("*").over(near)).cast("int").alias("past"),
        F.when(F.col("system"), 0).otherwise(F.col("before") - F.coalesce(F.min("before").over(near), F.col("before")))
        .cast("long").alias("past_tokens"),
    )
    turn = F.struct("pos", "role", "tokens", "system", "part", "skip", "chars", "past", "past_tokens")
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("ts"))
    whole = whole.withColumn("sys", F.col("ts")[0]["system"]).withColumn(
        "sys_tokens", F.when(F.col("sys"), F.col("ts")[0]["tokens"]).otherwise(F.lit(0).cast("long"))
    )

    def place(acc: Column, t: Column) -> Column:
        fits = t["system"] | ((F.size(acc["starts"]) > 0) & (t["tokens"] <= acc["room"]))
        room = F.lit(budget) - F.col("sys_tokens") - t["past_tokens"] - t["tokens"]
        return F.when(
            fits,
            F.struct(
                acc["starts"].alias("starts"),
                F.when(t["system"], acc["room"]).otherwise(acc["room"] - t["tokens"]).alias("room"),
            ),
        ).otherwise(
            F.struct(F.concat(acc["starts"], F.array(t["pos"])).alias("starts"), room.alias("room"))
        )

    empty = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).cast("long").alias("room"))
    starts = F.aggregate("ts", empty, place)["starts"]
    # A lone system turn is a window too.
    whole = whole.withColumn("starts", F.when(F.size(starts) > 0, starts).otherwise(F.array(F.lit(1))))
    windows = whole.select("conv_id", "ts", "sys", "starts", F.posexplode("starts").alias("window", "first"))
    windows = windows.withColumn(
        "end", F.when(F.col("window") + 1 < F.size("starts"), F.get("starts", F.col("window") + 1)).otherwise(F.size("ts"))
    ).withColumn("past", F.coalesce(F.get("ts", F.col("first"))["past"], F.lit(0)))
    shown = F.concat(
        F.when(F.col("sys"), F.slice("ts", 1, 1)).otherwise(F.slice("ts", 1, 0)),
        F.slice("ts", F.col("first") - F.col("past") + 1, F.col("past") + F.col("end") - F.col("first")),
    )
    windows = windows.select(
        "conv_id", "window", shown.alias("shown"),
        (F.col("past") + F.when(F.col("sys") & (F.col("window") > 0), 1).otherwise(0)).alias("repeated"),
    )

    def mark(acc: Column, t: Column) -> Column:
        new = acc["n"] >= F.col("repeated")
        span = F.struct((acc["at"] + t["skip"]).alias("start"), t["chars"].alias("length"))
        return F.struct(
            (acc["n"] + 1).alias("n"), (acc["at"] + F.length(t["part"])).alias("at"),
            F.when(new & (t["role"] == "assistant"), F.concat(acc["spans"], F.array(span)))
            .otherwise(acc["spans"]).alias("spans"),
        )

    none = F.struct(
        F.lit(0).alias("n"), F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,length:int>>").alias("spans"),
    )
    return windows.select(
        "conv_id", "window",
        F.array_join(F.transform("shown", lambda t: t["part"]), "").alias("text"),
        "repeated", F.aggregate("shown", none, mark)["spans"].alias("loss_spans"),
        F.aggregate("shown", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("n_tokens"),
        F.size("shown").alias("n_turns"),
    )


def read_turns(windows: DataFrame) -> DataFrame:
    """The windows with ``turns`` array<struct<role, text>>, read back from ``text`` without the repeated ones."""
    parts = F.split("text", r"<\|im_start\|>", -1)

    def read(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        skip = F.length(head) + 1
        body = F.substring(part, skip + 1, F.length(part) - skip - F.lit(len(END) + 1))
        return F.struct(unescaped(head).alias("role"), unescaped(body).alias("text"))

    new = F.slice(parts, F.col("repeated") + 2, F.col("n_turns") - F.col("repeated"))
    return windows.withColumn("turns", F.transform(new, read))


def read_loss(windows: DataFrame) -> DataFrame:
    """The windows with ``targets``: the texts under the loss mask."""
    return windows.withColumn(
        "targets",
        F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("text"), s["start"] + 1, s["length"]))),
    )

"""Quotation linking: conversations in the order of replies, without quoted text.

A line is quoted at the level of its leading '>' marks. The text behind them, with white
space collapsed and A-Z lowered, is hashed; a quoted passage is one such line. It links to
the earliest earlier message of the conversation that holds the passage as its own. A
message replies to what its shallowest quotes link to (most passages first, then the latest
message). Threads are the trees of these links, and a thread is named by its first message.

Everything is built-in SQL functions. Own passages are reduced to one row per conversation
and hash before the join, so that a line that everyone writes costs no pairs; roots are found
by doubling pointers on tables in the checkpoint folder, in as many rounds as the logarithm
of the longest chain. The result is in reply order by range, so a conversation of any length
spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vecspark.llm.common import ascii_lower
from vecspark.session import materialise

MARKS = r"^(?:\x20?>)+\x20?"
ATTRIBUTION = r"^On .{1,200} wrote:\s*$"
SPACE = r"[\x20\x09-\x0D]+"


def _level(line: Column) -> Column:
    marks = F.regexp_extract(line, f"({MARKS})", 1)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))


def normal(line: Column) -> Column:
    """A line without marks, with single spaces and A-Z lowered."""
    return F.trim(F.regexp_replace(ascii_lower(F.regexp_replace(line, MARKS, "")), SPACE, " "))


def body(text: Column) -> Column:
    """The text without quoted lines and, if it quotes, without the lines that announce quotes."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    quotes = F.exists(lines, lambda x: x.rlike(MARKS))
    own = F.filter(lines, lambda x: ~x.rlike(MARKS) & ~(quotes & x.rlike(ATTRIBUTION)))
    return F.when(quotes, F.regexp_replace(F.array_join(own, "\n"), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")).otherwise(
        F.coalesce(text, F.lit(""))
    )


def _roots(links: DataFrame) -> DataFrame:
    """Columns conv, turn, root, depth for every linked message (conv, turn, parent)."""
    state = materialise(links.select("conv", "turn", F.col("parent").alias("root"), F.lit(1).alias("depth")), "threads")
    while True:
        up = state.select(
            F.col("conv").alias("c2"), F.col("turn").alias("t2"), F.col("root").alias("r2"), F.col("depth").alias("d2")
        )
        joined = state.join(up, (F.col("conv") == F.col("c2")) & (F.col("root") == F.col("t2")), "left")
        state = materialise(
            joined.select(
                "conv", "turn", F.coalesce("r2", "root").alias("root"),
                (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"), F.col("r2").isNotNull().alias("moved"),
            ),
            "threads",
        )
        if not state.where("moved").limit(1).count():
            return state.drop("moved")


def link(
    messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", text: str = "text", *carry: str
) -> DataFrame:
    """One row per message: conversation, turn, ``carry``, thread (turn of the thread's first
    message), parent (turn replied to, or null), depth, n_quoted and n_linked (passages), body;
    ordered by conversation, thread and turn.

    Null conversations and turns link to nothing and are threads of their own. Null texts
    are empty. Rows that share conversation and turn are one message with the passages of
    all; each row is returned. A carried column that has the name of a result gets ``_carried`` after it.
    """
    results = {conversation, turn, "thread", "parent", "depth", "n_quoted", "n_linked", "body"}
    named = {c: f"{c}_carried" if c in results else c for c in carry}
    rows = messages.select(
        F.col(f"`{conversation}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), *[F.col(f"`{c}`").alias(f"_{c}") for c in carry],
    )
    lines = rows.where("conv IS NOT NULL AND turn IS NOT NULL").select(
        "conv", "turn", F.explode(F.split("text", "\n", -1)).alias("line")
    )
    lines = lines.select("conv", "turn", _level(F.col("line")).alias("level"), normal(F.col("line")).alias("n"))
    lines = lines.where("n <> ''").select("conv", "turn", "level", F.xxhash64("n").alias("h"))
    own = lines.where("level = 0").groupBy("conv", "h").agg(F.min("turn").alias("target"))
    quoted = lines.where("level > 0").groupBy("conv", "turn", "level", "h").agg(F.count("*").alias("times"))
    found = quoted.join(own, ["conv", "h"], "left").withColumn(
        "target", F.when(F.col("target") < F.col("turn"), F.col("target"))
    )
    votes = found.groupBy("conv", "turn", "level", "target").agg(F.sum("times").alias("times"))
    best = F.struct("level", (-F.col("times")).alias("a"), (-F.col("target")).alias("b"))
    replies = votes.groupBy("conv", "turn").agg(
        F.sum("times").alias("n_quoted"), F.sum(F.when(F.col("target").isNotNull(), F.col("times")).otherwise(0)).alias("n_linked"),
        F.min_by("target", F.when(F.col("target").isNotNull(), best)).alias("parent"),
    )
    replies = materialise(replies, "replies")
    roots = _roots(replies.where("parent IS NOT NULL"))
    info = replies.join(roots, ["conv", "turn"], "left").select(
        F.col("conv").alias("c3"), F.col("turn").alias("t3"), "n_quoted", "n_linked", "parent", "root", "depth"
    )
    out = rows.join(info, (F.col("conv") == F.col("c3")) & (F.col("turn") == F.col("t3")), "left").select(
        F.col("conv").alias(conversation), F.col("turn").alias(turn), *[F.col(f"`_{c}`").alias(named[c]) for c in carry],
        F.coalesce("root", "turn").alias("thread"), "parent", F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), body(F.col("text")).alias("body"),
    )
    return out.orderBy(conversation, "thread", turn)

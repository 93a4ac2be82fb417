"""Prefix trie of conversations by ROLLUP over positional columns of turn ids.

A conversation is a row of turn ids ``t1 .. tB``; GROUP BY ... ROLLUP (t1, .., tB) makes all its
prefixes at once, and grouping_id tells their depth. Conversations of more than B turns go on in
further rows, whose key names the node at which the row before ended, so one statement serves
the blocks of all depths. A second ROLLUP, over the nodes, sums what lies below each node inside
its block; totals of deeper blocks are added to the nodes they hang on, along the chain of blocks,
by doubling (as many joins as the binary logarithm of the longest chain).

A turn id is the start of a SHA-256 of role and text, so texts are read once and never shuffled.
The key of a block is an exclusive or of hashes of (number, turns) of the blocks before it.
Such sums can be taken in parts, so a conversation with any share of all turns is numbered, cut into
rows and keyed by many tasks; the SHA-256 of the conversations that end in a node is streamed over
blocks of text that many tasks have joined before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from vecspark.session import materialise, number_rows

#: Positional columns in a block.
WIDTH = 8
#: Blocks of one conversation whose keys one task derives; the parts are combined afterwards.
PART = 4096
#: Ids of conversations that are joined to one text before they meet the others of their node.
JOINED = 4096
SPACES = r"[\x20\x09-\x0D]+"


def turn_table(conversations: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``c, pos, n, t, w``: turns by position from 0, with n (turns of the conversation), id and words."""
    role_, text_ = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_), 256)
    words = F.size(F.array_remove(F.split(text_, SPACES, -1), "")).cast("long")
    rows = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("c"), F.col(turn).alias("o"), digest.substr(1, 32).alias("t"), words.alias("w")
    )
    # Ranges, not hashes of the conversation: a long one is spread over many tasks.
    rows = rows.repartitionByRange("c", F.col("o").asc_nulls_first(), "t").sortWithinPartitions(
        "c", F.col("o").asc_nulls_first(), "t"
    )
    numbered = number_rows(rows.drop("o"), -1, "g")
    first = numbered.groupBy("c").agg(F.min("g").alias("first"), F.count("*").alias("n"))
    placed = numbered.join(first, "c").select("c", (F.col("g") - F.col("first")).alias("pos"), "n", "t", "w")
    return materialise(placed, "trie-turns")


def rebuilt(turns: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """``c, pos, t, w`` of rebuilt conversations: the first ``head`` turns of the conversation ``base``
    and then c's own after its first ``head``. A conversation left without turns has one row of nulls.

    ``head`` is at most ``most``, so at most that many rows of a conversation serve others.
    """
    plan = turns.where("pos = 0").select("c", base.alias("b"), head.alias("h"), "n")
    given = turns.where(F.col("pos") < most).select(F.col("c").alias("b"), "pos", F.col("n").alias("bn"), "t", "w")
    heads = plan.join(given, "b").where("pos < h").select("c", "pos", "t", "w")
    sizes = turns.where("pos = 0").select(F.col("c").alias("b"), F.col("n").alias("bn"))
    shift = plan.join(sizes, "b", "left").select("c", "h", "n", F.least("h", F.coalesce("bn", F.lit(0))).alias("m"))
    tails = turns.drop("n").join(shift, "c").where("pos >= h").select("c", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "t", "w")
    bare = shift.where("m = 0 AND n <= h").select(
        "c", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("string").alias("t"), F.lit(None).cast("long").alias("w")
    )
    typed = lambda df: df.select("c", F.col("pos").cast("long").alias("pos"), "t", "w")
    return typed(heads).unionByName(typed(tails)).unionByName(bare)


def _lane(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def block_rows(turns: DataFrame, width: int) -> DataFrame:
    """``c, j, k1, k2, t1.., w1..``: a row for each block of ``width`` turns, keyed by what precedes it."""
    slot = F.col("pos") % width
    cells = [F.max(F.when(slot == i, F.col(n))).alias(f"{n}{i + 1}") for n in ("t", "w") for i in range(width)]
    blocks = turns.groupBy("c", F.floor(F.col("pos") / width).cast("long").alias("j")).agg(*cells)
    blocks = materialise(blocks, "trie-blocks")
    names = [f"t{i + 1}" for i in range(width)]
    long_ones = blocks.where("j > 0").select("c").distinct()
    lanes = blocks.join(long_ones, "c", "left_semi").select(
        "c", "j", F.floor(F.col("j") / PART).alias("p"),
        _lane(1, "j", *names).alias("x1"), _lane(2, "j", *names).alias("x2"),
    )
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    xor = lambda n, w: F.coalesce(F.bit_xor(n).over(w), F.lit(0).cast("long"))
    inside = before("c", "p").orderBy("j")
    own = lanes.select("c", "j", "p", xor("x1", inside).alias("a1"), xor("x2", inside).alias("a2"))
    parts = lanes.groupBy("c", "p").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    earlier = before("c").orderBy("p")
    parts = parts.select("c", "p", xor("x1", earlier).alias("b1"), xor("x2", earlier).alias("b2"))
    keys = own.join(parts, ["c", "p"]).select(
        "c", "j", F.col("a1").bitwiseXOR(F.col("b1")).alias("k1"), F.col("a2").bitwiseXOR(F.col("b2")).alias("k2")
    )
    zero = F.lit(0).cast("long")
    return blocks.join(keys, ["c", "j"], "left").withColumns({"k1": F.coalesce("k1", zero), "k2": F.coalesce("k2", zero)})


def _named(a: Column, b: Column) -> Column:
    return F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0"))


def node_id(width: int, depth: Column) -> Column:
    """The node at ``depth`` of the block row: the key itself, a hash of the turns, or the key of the block after it."""
    names = [f"t{i + 1}" for i in range(width)]
    key = _named(F.col("k1"), F.col("k2"))
    after = _named(*[F.col(f"k{i}").bitwiseXOR(_lane(i, "j", *names)) for i in (1, 2)])
    turns = F.array_join(F.slice(F.array(*names), 1, F.greatest(depth, F.lit(1)).cast("int")), "/")
    inner = F.sha2(F.concat(key, F.lit("/"), turns), 256).substr(1, 32)
    return F.when(depth == 0, key).when(depth == width, after).otherwise(inner)


def _rolled(rows: DataFrame, width: int, aggregates: str) -> DataFrame:
    """ROLLUP over the positional columns inside each block; ``d`` is the depth inside it."""
    names = ", ".join(f"t{i + 1}" for i in range(width))
    found = rows.sparkSession.sql(
        f"SELECT j, k1, k2, {names}, {width} - bit_count(grouping_id()) AS d, {aggregates} "
        f"FROM {{rows}} GROUP BY j, k1, k2, ROLLUP ({names})",
        rows=rows,
    )
    last = F.get(F.array(*[f"t{i + 1}" for i in range(width)]), (F.col("d") - 1).cast("int"))
    return found.where((F.col("d") == 0) | last.isNotNull())


def ends(blocks: DataFrame, width: int) -> DataFrame:
    """``id, ends_sha256``: SHA-256 of the comma-joined ids of the conversations that end in a node."""
    spark = blocks.sparkSession
    depth = sum((F.col(f"t{i + 1}").isNotNull().cast("int") for i in range(width)), F.lit(0))
    last = blocks.groupBy("c").agg(F.max("j").alias("j"))
    final = blocks.join(last, ["c", "j"]).select(node_id(width, depth).alias("id"), "c")
    final = final.repartitionByRange("id", "c").sortWithinPartitions("id", "c")

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for node, part in batch.groupby("id", sort=True):
                keys = part["c"].tolist()
                for at in range(0, len(keys), JOINED):
                    found.append((node, keys[at], ",".join(map(str, keys[at : at + JOINED]))))
            yield pd.DataFrame(found, columns=["id", "first", "ids"])

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = ((r.id, r.ids) for batch in batches for r in batch.itertuples(index=False))
        found = []
        for node, own in groupby(pieces, key=lambda p: p[0]):
            state = hashlib.sha256(next(own)[1].encode())
            for _, ids in own:
                state.update(b"," + ids.encode())
            found.append((node, state.hexdigest()))
            if len(found) == 10_000:
                yield pd.DataFrame(found, columns=["id", "ends_sha256"])
                found = []
        yield pd.DataFrame(found, columns=["id", "ends_sha256"])

    joined = materialise(final.mapInPandas(join, "id string, first long, ids string"), "trie-ends")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    together = joined.repartition(n, "id").sortWithinPartitions("id", "first").drop("first")
    return together.mapInPandas(digest, "id string, ends_sha256 string")


def block_totals(nodes: DataFrame, width: int) -> DataFrame:
    """``id, leaves, saved`` of everything below the nodes on which further blocks hang."""
    spark = nodes.sparkSession
    longest = nodes.agg(F.max("j")).first()[0] or 0
    own = nodes.where("j > 0").groupBy("key").agg(F.sum("leaf").alias("leaves"), F.sum("saving").alias("saved"))
    # A block's parent is the block whose last node is this block's key.
    above = nodes.where((F.col("d") == width) & (F.col("j") > 0)).select(F.col("id").alias("key"), F.col("key").alias("up"))
    state = materialise(own.join(above, "key", "left"), "trie-totals")
    steps = max(0, longest - 1).bit_length()
    for _ in range(steps):
        below = state.where("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(
            F.sum("leaves").alias("l"), F.sum("saved").alias("s")
        )
        jump = state.select(F.col("key").alias("up"), F.col("up").alias("far"))
        state = materialise(
            state.join(below, "key", "left").join(jump, "up", "left").select(
                "key", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), F.col("far").alias("up"),
            ),
            "trie-totals",
        )
    return state.select(F.col("key").alias("id"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))


def trie(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    base: Column | None = None, head: Column | None = None, most: int = 0, width: int = WIDTH,
) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``base`` and ``head`` (over the column ``c``, the conversation) rebuild conversations first, see
    :func:`rebuilt`. Turns are ordered by ``turn``, null first, ties by the hash of role and text;
    repeated rows are turns each. Null role or text is empty. Rows with a null key take no part,
    and an empty table has no nodes. Other columns are not read.
    """
    turns = turn_table(conversations, key, turn, role, text)
    if base is not None:
        turns = rebuilt(turns, base, head, most)
    blocks = materialise(block_rows(turns, width), "trie-rows")
    words = F.get(F.array(*[f"w{i + 1}" for i in range(width)]), (F.col("d") - 1).cast("int"))
    maxima = ", ".join(f"max(w{i + 1}) AS w{i + 1}" for i in range(width))
    nodes = _rolled(blocks, width, f"count(*) AS n_convs, min(c) AS conv_id, {maxima}")
    nodes = nodes.where("j = 0 OR d > 0")  # the first row of a further block is the node before it
    up = F.when(F.col("d") > 0, node_id(width, F.col("d") - 1))
    nodes = nodes.select(
        node_id(width, F.col("d")).alias("id"), up.alias("up"), _named(F.col("k1"), F.col("k2")).alias("key"), "j", "k1", "k2",
        *[f"t{i + 1}" for i in range(width)], "d", (F.col("j") * width + F.col("d")).alias("depth"), "conv_id", "n_convs",
        F.coalesce((F.col("n_convs") - 1) * words, F.lit(0)).cast("long").alias("saving"),
    )
    nodes = materialise(nodes, "trie-nodes")
    children = nodes.where("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = materialise(nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")), "trie-nodes")
    zero = F.lit(0).cast("long")
    hung = nodes.join(block_totals(nodes, width), "id", "left").withColumns({
        "leaf": F.col("leaf") + F.coalesce("more_leaves", zero), "saving": F.col("saving") + F.coalesce("more_saved", zero),
    })
    sums = _rolled(hung, width, "sum(leaf) AS n_leaves, sum(saving) AS saved_tokens").where("j = 0 OR d > 0")
    sums = sums.select(node_id(width, F.col("d")).alias("id"), "n_leaves", "saved_tokens")
    # Many nodes share a parent: adaptive execution splits the side of the children.
    parents = nodes.select(F.col("id").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.drop("leaf").join(sums, "id").join(ends(blocks, width), "id", "left").join(parents, "up", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )

"""Benchmark decontamination by a broadcast hash set of the benchmark's word windows.

Words are runs of letters, digits and non-ASCII characters, A-Z lowered. A window is
``size`` consecutive words of an item; a shorter item is one window. Everything is built-in
SQL functions. The hashes of a document's windows are an array of longs made inside its
row; exploding it feeds a broadcast join on the hash, in the same stage as the scan, whose
condition compares the words themselves. Only hits leave the stage, and one row for each
document that carries its word count, so there is no join back to the documents. They are
aggregated by document, first by task.

The broadcast holds at most ``BLOCK`` windows; a larger benchmark is taken block by block,
one scan each, with the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vecspark.llm.common import ascii_lower, words_of
from vecspark.session import materialise

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SIZE = 13
#: Windows in one broadcast: some 100 bytes each.
BLOCK = 400_000


def normal_words(text: Column) -> Column:
    return words_of(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)


def _starts(words: Column, length: int | Column) -> Column:
    """0-based starts of the windows of ``length`` words (>= 1), as an array."""
    last = F.size(words) - length
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _window_hashes(words: Column, length: int) -> Column:
    return F.transform(_starts(words, length), lambda i: F.xxhash64(F.slice(words, i + 1, length)))


def benchmark_windows(benchmark: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """Columns words, length, hash, items: one row per distinct window, with the sorted ids of
    the items that hold it (null ids are left out)."""
    rows = benchmark.select(F.col(item).cast("string").alias("_item"), normal_words(F.col(text)).alias("_w"))
    rows = rows.where(F.size("_w") > 0).withColumn("_n", F.least(F.size("_w"), F.lit(size)))
    cut = F.transform(_starts(F.col("_w"), F.col("_n")), lambda i: F.slice("_w", i + 1, F.col("_n")))
    windows = rows.select("_item", F.explode(cut).alias("words"))
    windows = windows.groupBy("words").agg(F.sort_array(F.collect_set("_item")).alias("items"))
    return windows.withColumn("length", F.size("words")).withColumn("hash", F.xxhash64("words"))


def _hits(docs: DataFrame, windows: DataFrame, lengths: list[int], sentinel: bool) -> DataFrame:
    """Columns _id, _h, _n, start, length, set: the windows that occur, and with ``sentinel`` a
    row with a null start for each document."""
    hashed, counts = [], []
    for n in lengths:
        hashed.append(_window_hashes(F.col("_w"), n))
        counts.append(F.greatest(F.size("_w") - (n - 1), F.lit(0)))
    hashed.append(F.array(F.lit(0).cast("long")))  # the sentinel is the last place
    rows = docs.select("_id", "_h", "_w", F.posexplode(F.concat(*hashed)).alias("_at", "_hash"))
    start, length, before = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(0)
    for n, count in zip(lengths, counts):
        inside = (F.col("_at") >= before) & (F.col("_at") < before + count)
        start, length = F.when(inside, F.col("_at") - before).otherwise(start), F.when(inside, n).otherwise(length)
        before = before + count
    rows = rows.withColumn("start", start).withColumn("_len", length)
    found = F.broadcast(windows.select("hash", "length", "words", "set"))
    joined = rows.join(found, F.col("_hash") == F.col("hash"), "left" if sentinel else "inner")
    # Behind an OR the words are compared for equal hashes only, and are no part of the key.
    same = F.slice("_w", F.col("start") + 1, F.col("_len")) == F.col("words")
    joined = joined.where(F.col("start").isNull() | same)
    return joined.select("_id", "_h", F.size("_w").alias("_n"), "start", "length", "set")


def scan(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", size: int = SIZE, share: int = 20,
) -> DataFrame:
    """One row per document: key, row_key (hash of the text), n_words, n_hit (words inside any
    occurrence of a window), items (sorted ids), contaminated (n_hit > 0 and
    share * n_hit >= n_words). Null texts have no words; repeated rows give repeated rows.
    Documents with a common key and other texts are told apart by the text's hash.
    """
    if not 1 <= size < 16:
        raise ValueError("a window has 1 to 15 words")  # lengths take four bits below
    windows = benchmark_windows(benchmark, item, item_text, size)
    windows = materialise(windows.withColumn("set", F.sha2(F.concat_ws(",", "items"), 256)), "bench-windows")
    sets = windows.groupBy("set").agg(F.first("items").alias("items"))
    lengths = [r["length"] for r in windows.select("length").distinct().orderBy("length").collect()]  # <= size
    n_blocks = max(1, -(-windows.count() // BLOCK))
    source = docs.select(
        F.col(key).alias("_id"), F.xxhash64(text).alias("_h"), normal_words(F.col(text)).alias("_w")
    )
    hits = None
    for k in range(n_blocks):
        part = windows if n_blocks == 1 else windows.where(F.pmod("hash", F.lit(n_blocks)) == k)
        found = _hits(source, part, lengths, sentinel=k == 0)
        hits = found if hits is None else hits.unionByName(found)

    # start * 16 + length sorts by start; a set of them is as long as the document at most.
    code = F.when(F.col("start").isNotNull(), F.col("start").cast("long") * 16 + F.col("length"))
    per_doc = hits.groupBy("_id", "_h").agg(
        F.max("_n").alias("_n"), F.count_if(F.col("start").isNull()).alias("_rows"),
        F.sort_array(F.collect_set(code)).alias("_codes"), F.collect_set(F.when(F.col("start").isNotNull(), F.col("set"))).alias("_sets"),
    )
    covered = F.aggregate(
        "_codes", F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, c: F.struct(
            (F.shiftright(c, 4) + c.bitwiseAND(F.lit(15).cast("long"))).alias("end"),
            (acc["n"] + F.shiftright(c, 4) + c.bitwiseAND(F.lit(15).cast("long"))
             - F.greatest(F.shiftright(c, 4), acc["end"])).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    per_doc = per_doc.select(
        "_id", "_h", "_n", "_rows", F.when(F.size("_codes") > 0, covered).otherwise(F.lit(0)).alias("_hit"), "_sets"
    )
    per_doc = materialise(per_doc, "bench-hits")  # read twice below
    named = per_doc.where(F.size("_sets") > 0).select("_id", "_h", F.explode("_sets").alias("set"))
    named = named.join(sets, "set").select("_id", "_h", F.explode("items").alias("item"))
    named = named.groupBy("_id", "_h").agg(F.sort_array(F.collect_set("item")).alias("items"))
    named = named.select(F.col("_id").alias("_id2"), F.col("_h").alias("_h2"), "items")
    out = per_doc.join(named, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_h") == F.col("_h2")), "left")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_rows")))
    return out.select(
        F.col("_id").alias(key), F.col("_h").alias("row_key"), F.col("_n").cast("long").alias("n_words"),
        F.col("_hit").cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((F.col("_hit") > 0) & (share * F.col("_hit") >= F.col("_n"))).alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated rows; all columns as they were.

    The contaminated keys are few against the documents, but not bounded: a plain anti-join,
    which Spark turns into a broadcast only below its own threshold.
    """
    bad = scan(docs, benchmark, key, text, **options).where("contaminated").select(
        F.col(key).alias("_bk"), F.col("row_key").alias("_bh")
    ).distinct()
    # The row travels as one struct, so that no column of it can be taken for one of ours.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    row = F.col("_row")
    same = row[key].eqNullSafe(F.col("_bk")) & (F.xxhash64(row[text]) == F.col("_bh"))
    return rows.join(bad, same, "left_anti").select(*[row[c].alias(c) for c in docs.columns])

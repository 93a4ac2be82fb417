"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def small_batches(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches of 8 MB at most to Python workers: texts are long, and a
    worker holds several copies of its batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def fold(key: Column | str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; -1 for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string") if isinstance(key, str) else key) % modulus, F.lit(-1))


def ascii_lower(text: Column) -> Column:
    """Only A-Z in lower case. ``lower`` does that faster where all characters are ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column, separators: str) -> Column:
    """The non-empty pieces of ``text`` between runs that match ``separators``."""
    return F.array_remove(F.split(text, separators, -1), "")


def blocks(sizes: Sequence[int], limit: int) -> Iterator[slice]:
    """Consecutive slices of rows whose sizes add up to ``limit`` at most; a larger row stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def utf8(texts: Iterable) -> list[bytes]:
    """Texts as bytes; null is empty."""
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, key: str, label: str, use: Column, per_class: int, *columns: str
) -> DataFrame:
    """At most ``per_class`` labelled rows of each class 0 and 1, the first by a hash of the key.

    ``_w`` is the number of labelled keys of the class that a row stands for: all of them over
    the chosen ones. Fits that weigh rows by it learn the natural rate, whatever the bound is.

    ``use`` says which keys may be learned from. Only the chosen keys (2 * per_class rows
    at most) are broadcast; ``docs`` is scanned once, and of its rows only those of chosen keys
    are shuffled. Rows that share a key leave the one whose hash is smallest (each task
    reduces its own first), so the outcome has 2 * per_class rows at most. Repeated labels of
    a key count once (the largest), null keys and labels do not count.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("_y"))
    known = known.where(use).withColumn("_o", F.xxhash64(key))
    sizes = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    picked = None
    for y in (0, 1):
        weight = max(1.0, sizes.get(y, 0) / max(1, per_class))
        part = known.where(F.col("_y") == y).orderBy("_o", key).limit(per_class).withColumn("_w", F.lit(weight))
        picked = part if picked is None else picked.unionByName(part)
    picked = picked.select(F.col(key).alias("_k"), "_y", "_w")
    rows = docs.select(F.col(key).alias("_dk"), *columns)
    rows = rows.join(F.broadcast(picked), F.col("_dk") == F.col("_k"))
    least = F.min(F.struct(F.xxhash64(*columns).alias("_h"), *columns)).alias("_r")
    once = rows.groupBy("_dk", "_y", "_w").agg(least)
    return once.select("_dk", "_y", "_w", *[F.col("_r")[c].alias(c) for c in columns])


def spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def polynomial_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each span of bytes."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    offset = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    terms = (data[np.repeat(starts, lengths) + offset].astype(np.uint64) + np.uint64(1)) * _POWERS[offset & 63]
    sums = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
    return sums * np.uint64(0x9E3779B97F4A7C15)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def auc(score: np.ndarray, label: np.ndarray) -> float:
    """Area under the ROC curve, ties at one half."""
    values, place = np.unique(score, return_inverse=True)
    counts = np.bincount(place, minlength=len(values))
    rank = (np.cumsum(counts) - (counts - 1) / 2)[place]
    pos = label == 1
    n1, n0 = int(pos.sum()), int((~pos).sum())
    return float((rank[pos].sum() - n1 * (n1 + 1) / 2) / max(1, n1 * n0))

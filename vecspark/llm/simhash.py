"""Near duplicates by SimHash, found with vantage-point trees.

A fingerprint has a bit for each bit that more than half of the XXH64 hashes of the text's
word shingles have set. Two texts are linked if their fingerprints differ in at most
``radius`` bits, and the components of these links are the groups.

Finding the links. Equal fingerprints are reduced to one row first, so that copies cost
nothing. The 64 bits are cut into ``bands``; a pair within ``radius`` bits is within
``radius // bands`` bits in one band at least, and the Hamming distance inside a band is a
metric too. Every band has a vantage-point tree: an inner node parts the fingerprints by
their distance to a vantage point. By the triangle inequality a pair within r can be parted
only if the inner one lies in the outermost r rings of the ball, so those also visit the
outer side: every pair meets in some leaf, and all other branches are pruned. (A tree over
all 64 bits prunes next to nothing: distances to a vantage point are 32 +- 4, so that a
ring as wide as the radius holds a third of the rows at every level.)

The trees are grown on the driver from a bounded sample of fingerprints; their depth
follows the number of distinct fingerprints, every fingerprint is routed, and leaves that
are crowded are cut into blocks that meet pairwise. A leaf emits a forest of the links
among its rows, not all pairs, which has the same components. Components come from
alternating large-star and small-star rounds on tables in the checkpoint folder.

Four bits are a narrow rule: texts that share 0.8 of their shingles differ in ten bits on average,
and no cut of 64 bits finds those without meeting most other texts too. With ``similar`` further
links join texts by minwise sketches: ``SKETCH`` least values of the shingles under as many hash
functions, of which ``SKETCH_BANDS`` runs of ``SKETCH_ROWS`` are keys. Only keys that hold different
fingerprints meet; their rows are compared by one byte of each value, whose equal share estimates
the similarity of the shingle sets. A key is searched breadth first, so a group of copies of
each other takes few passes, and a crowded key is cut into blocks that meet pairwise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from vecspark.llm.common import utf8
from vecspark.session import materialise

SEED = 42
SHINGLE = 4
RADIUS = 4
BANDS = 3
#: Fingerprints that a leaf should hold, and beyond which it is cut into blocks.
LEAF, LEAF_BLOCK = 128, 4096
#: Fingerprints from which the trees are grown.
TREE_SAMPLE = 100_000
_BYTES = np.uint64(0x0101010101010101)
#: Values of a sketch, and the runs of them that are keys: a pair of similarity 0.8 shares one of 16 keys in 99.8% of cases.
SKETCH, SKETCH_BANDS, SKETCH_ROWS = 192, 16, 5
#: One standard deviation of the estimate at 0.8, by which a pair may seem less similar than it is.
SKETCH_ERROR = 0.03
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 32, (2, SKETCH), dtype=np.uint32) | np.uint32(1)
#: Rows that one task compares at a time, of many small keys together.
SKETCH_ROWS_A_GROUP = 16384


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    words = text.lower().split()
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1:] - 1).tolist())], np.uint64
    )


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; zero for none.

    Bits j, j + 8, ... are counted side by side in the bytes of a word, 255 hashes at a time.
    """
    n = len(hashes)
    if n == 0:
        return 0
    counts = np.zeros((8, 8), np.int64)
    starts = np.arange(0, n, 255)
    for j in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(j)) & _BYTES, starts)
        counts[j] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0)
    set_bits = counts * 2 > n
    return sum(1 << (8 * byte + j) for j in range(8) for byte in range(8) if set_bits[j, byte])


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint of each text as a signed long; null and empty texts have zero."""

    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            values = [majority(shingle_hashes(t, size)) for t in utf8(batch)]
            yield pd.Series(np.array(values, np.uint64).view(np.int64), dtype="int64")

    prints.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(prints, "long")(text)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The least value of the hashes under each of the ``SKETCH`` functions, as 32 bits."""
    least = np.full(SKETCH, np.iinfo(np.uint32).max, np.uint32)
    short = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    for at in range(0, len(short), 128):  # a block that fits the nearest cache
        np.minimum(least, (short[at: at + 128, None] * _FACTORS[0] + _FACTORS[1]).min(axis=0), out=least)
    return least


def sketched(text: Column, size: int = SHINGLE) -> Column:
    """A struct of the fingerprint ``p``, the sketch's bytes ``s`` and its keys ``k``; both null without words."""

    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in utf8(batch):
                hashes = shingle_hashes(text, size)
                p = int(np.array(majority(hashes), np.uint64).view(np.int64))
                if not len(hashes):
                    out.append((p, None, None))
                    continue
                values = sketch(hashes)
                runs = values[: SKETCH_BANDS * SKETCH_ROWS].reshape(SKETCH_BANDS, SKETCH_ROWS)
                keys = np.array([xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(runs)], np.uint64)
                out.append((p, values.astype(np.uint8).tobytes(), keys.view(np.int64).tolist()))
            yield pd.DataFrame(out, columns=["p", "s", "k"])

    prints.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(prints, "p long, s binary, k array<long>")(text)


@dataclass
class VantageTree:
    """A complete binary tree in heap order; node i parts by popcount((x ^ point[i]) & mask) <= cut[i]."""

    mask: int
    radius: int
    depth: int
    points: np.ndarray
    cuts: np.ndarray

    @classmethod
    def grow(cls, sample: np.ndarray, mask: int, radius: int, depth: int) -> VantageTree:
        """Vantage points come from the sample; the cut near the median that fewest rows overlap."""
        points, cuts = np.zeros(2**depth, np.uint64), np.zeros(2**depth, np.int64)
        held = {1: np.unique(sample & np.uint64(mask))}
        for node in range(1, 2**depth):
            rows = held.pop(node, sample[:0])
            if len(rows) == 0:
                rows = np.zeros(1, np.uint64)
            spread, best = -1.0, None
            for point in rows[:: max(1, len(rows) // 4)][:4]:  # the candidate with the widest spread
                d = np.bitwise_count(rows ^ point).astype(np.int64)
                if d.std() > spread:
                    spread, best = d.std(), (point, d)
            point, d = best
            middle = int(np.median(d))
            cut = min(
                range(max(0, middle - 2), middle + 2),
                key=lambda c: (abs(np.mean(d <= c) - 0.5) + np.mean((d > c - radius) & (d <= c)), c),
            )
            points[node], cuts[node] = point, cut
            inside = d <= cut
            held[2 * node], held[2 * node + 1] = rows[inside], rows[~inside]
        return cls(mask, radius, depth, points, cuts)

    def route(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf that each fingerprint visits."""
        row, node = np.arange(len(prints)), np.ones(len(prints), np.int64)
        value = prints & np.uint64(self.mask)
        for _ in range(self.depth):
            d = np.bitwise_count(value[row] ^ self.points[node]).astype(np.int64)
            cut = self.cuts[node]
            inside, outside = d <= cut, d > cut - self.radius
            row = np.concatenate((row[inside], row[outside]))
            node = np.concatenate((2 * node[inside], 2 * node[outside] + 1))
        return row, node


def band_masks(bands: int) -> list[int]:
    edges = [round(64 * i / bands) for i in range(bands + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is joined by all pairs within ``radius`` among ``left``
    (or between ``left`` and ``right``), at most one for each row."""
    other = left if right is None else right
    every = left if right is None else np.concatenate((left, right))
    base = 0 if right is None else len(left)
    parent = np.arange(len(every))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    a, b = [], []
    step = max(1, (1 << 20) // max(1, len(other)))
    for start in range(0, len(left), step):
        near = np.bitwise_count(left[start: start + step, None] ^ other[None, :]) <= radius
        if right is None:
            near &= np.arange(len(other))[None, :] > np.arange(start, start + near.shape[0])[:, None]
        x, y = np.nonzero(near)
        for i, j in zip((x + start).tolist(), (y + base).tolist()):
            p, q = root(i), root(j)
            if p != q:
                parent[max(p, q)] = min(p, q)
                a.append(i)
                b.append(j)
    return every[a], every[b]


def links(prints: DataFrame, column: str, radius: int = RADIUS, bands: int = BANDS) -> DataFrame:
    """Columns a, b: links among the distinct values of ``column`` with the components of all
    pairs within ``radius`` bits. Every link is such a pair."""
    spark = prints.sparkSession
    distinct = prints.select(F.col(column).alias("p")).distinct()
    total = distinct.count()
    if total < 2:
        return spark.createDataFrame([], "a long, b long")
    share = min(1.0, 0.9 * TREE_SAMPLE / total)
    sample = distinct.where(F.pmod(F.hash("p"), F.lit(1 << 20)) <= int(share * (1 << 20)))
    sample = sample.toPandas()["p"].to_numpy(np.int64).view(np.uint64)
    sample.sort()
    depth = max(0, math.ceil(math.log2(total / LEAF)))
    grown = min(depth, int(math.log2(max(1, len(sample)))))
    trees = [VantageTree.grow(sample, m, radius // bands, grown) for m in band_masks(bands)]

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["p"].to_numpy(np.int64)
            for band, tree in enumerate(trees):
                for at in range(0, len(values), 4096):
                    part = values[at: at + 4096]
                    row, leaf = tree.route(part.view(np.uint64))
                    yield pd.DataFrame({"leaf": leaf * bands + band, "p": part[row]})

    visits = distinct.mapInPandas(routed, "leaf long, p long")
    # A crowded leaf is cut into n blocks; a row goes to the n pairs that hold its own block.
    sizes = visits.groupBy("leaf").count().where(F.col("count") > LEAF_BLOCK)
    sizes = sizes.select("leaf", F.ceil(F.col("count") / LEAF_BLOCK).cast("long").alias("n"))
    visits = visits.join(sizes, "leaf", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    visits = visits.withColumn("own", F.pmod(F.xxhash64("p"), "n"))
    visits = visits.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    visits = visits.select(
        "leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "p"
    )

    def linked(key, rows: pd.DataFrame) -> pd.DataFrame:
        values = rows["p"].to_numpy(np.int64).view(np.uint64)
        if key[1] == key[2]:
            a, b = forest(values, None, radius)
        else:
            first = (rows["own"] == key[1]).to_numpy()
            a, b = forest(values[first], values[~first], radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return visits.groupBy("leaf", "i", "j").applyInPandas(linked, "a long, b long").distinct()


def alike(prints: np.ndarray, sketches: list[bytes], similar: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is joined by all pairs whose sketches agree in the share that
    ``similar`` calls for, less ``SKETCH_ERROR``; at most one for each row."""
    values = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, SKETCH)
    share = similar - SKETCH_ERROR
    need = SKETCH * (share + (1 - share) / 256)  # bytes of different values agree in one of 256 cases
    left, a, b = np.arange(len(prints)), [], []
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            row = reached.pop()
            near = (values[left] == values[row]).sum(axis=1, dtype=np.uint8) >= need  # SKETCH fits a byte
            hit = left[near]
            a.append(np.repeat(prints[row], len(hit)))
            b.append(prints[hit])
            reached.extend(hit.tolist())
            left = left[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (prints[:0], prints[:0])


def sketch_links(rows: DataFrame, similar: float) -> DataFrame:
    """Columns a, b: links among the fingerprints of ``rows`` (``_p``, ``_s``, ``_k``) by their sketches."""
    distinct = rows.where("_s IS NOT NULL").groupBy("_p", "_s").agg(F.first("_k").alias("_k"))
    distinct = materialise(distinct.withColumn("_r", F.monotonically_increasing_id()), "simhash-sketches")
    keyed = distinct.select(F.explode("_k").alias("leaf"), "_p", "_r")
    shared = keyed.groupBy("leaf").agg(F.min("_p").alias("x"), F.max("_p").alias("y"), F.count("*").alias("c"))
    shared = shared.where("x <> y").select("leaf", F.ceil(F.col("c") / LEAF_BLOCK).cast("long").alias("n"))
    visits = keyed.select("leaf", "_r").join(shared, "leaf")
    # A crowded key is cut into n blocks; a row goes to the n pairs that hold its own block.
    visits = visits.withColumn("own", F.pmod(F.xxhash64("_r"), "n"))
    visits = visits.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    visits = visits.select("leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "_r")
    visits = materialise(visits.join(distinct.select("_r", "_p", "_s"), "_r"), "simhash-keys")
    # Most keys hold a few rows, so a task takes many keys in one call.
    groups = max(1, math.ceil(visits.count() / SKETCH_ROWS_A_GROUP))
    visits = visits.withColumn("_g", F.pmod(F.xxhash64("leaf", "i", "j"), F.lit(groups)))

    def linked(key, rows: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((2, 0), np.int64)]
        for _, own in rows.groupby(["leaf", "i", "j"], sort=False).indices.items():
            part = rows.iloc[own]
            out.append(np.stack(alike(part["_p"].to_numpy(np.int64), part["_s"].tolist(), similar)))
        a, b = np.concatenate(out, axis=1)
        return pd.DataFrame({"a": a, "b": b})

    return visits.groupBy("_g").applyInPandas(linked, "a long, b long").where("a <> b").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Columns node, root for every node of ``edges`` (a, b): the smallest node that it reaches.

    Alternates large stars (each node's larger neighbours move to its smallest neighbour) and
    small stars (its smaller ones do) until nothing changes: the number of rounds grows with
    the logarithm of the nodes. Each round is one table in the checkpoint folder. A hub's
    neighbours are never gathered: the smallest one is an aggregate that is joined back.
    """
    edges = materialise(edges.where("a <> b"), label)
    stamp = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = materialise(small, label)
        now = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.countDistinct("a")
        ).first()
        if tuple(now) == stamp or now[0] == 0:
            break
        stamp = tuple(now)
    return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")


def group(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
    bands: int = BANDS, row_hash: Column | None = None, similar: float | None = None,
) -> DataFrame:
    """One row per document: key, fingerprint (long), component (smallest key that it reaches).

    Null keys group like others and are never the smallest one unless alone; null texts are
    empty. Repeated rows give repeated rows. Other columns are left out, but for ``row_hash``.
    With ``similar`` texts whose sets of shingles are about that similar are linked too.
    """
    more = [] if row_hash is None else [row_hash.alias("_h")]
    if similar is None:
        rows = docs.select(F.col(key).alias("_id"), fingerprint(F.col(text), shingle).alias("_p"), *more)
    else:
        rows = docs.select(F.col(key).alias("_id"), sketched(F.col(text), shingle).alias("_f"), *more)
        rows = rows.select("_id", F.col("_f.p").alias("_p"), F.col("_f.s").alias("_s"), F.col("_f.k").alias("_k"), *(["_h"] if more else []))
    rows = materialise(rows, "simhash")
    edges = links(rows, "_p", radius, bands)
    if similar is not None:
        edges = edges.unionByName(sketch_links(rows, similar))
    roots = components(edges, "simhash-links")
    named = rows.groupBy("_p").agg(F.min("_id").alias("_own"))  # one row per distinct fingerprint
    named = named.join(roots, F.col("_p") == F.col("node"), "left")
    named = named.select("_p", "_own", F.coalesce("root", "_p").alias("_root"))
    least = named.groupBy("_root").agg(F.min("_own").alias("_component"))
    named = named.join(least, "_root").select("_p", "_root", "_component")
    return rows.join(named, "_p").select(
        F.col("_id").alias(key), F.col("_p").alias("fingerprint"), F.col("_component").alias("component"),
        F.col("_root").alias("group_print"), *(["_h"] if more else []),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group, the one with the smallest key; all columns as they were.

    A null key counts as the largest. Rows that share key and group leave the one whose hash
    is smallest; of rows that are equal in all columns one stays.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row_hash = F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in t else c for c, (_, t) in zip(columns, docs.dtypes)])
    grouped = group(docs, key, text, row_hash=row_hash, **options)
    same = grouped.groupBy("group_print", key, "_h").agg(F.count("*").alias("_same"))
    first = F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.col("_h").alias("h"), F.col("_same"))
    chosen = same.groupBy("group_print").agg(F.min(first).alias("c")).select(
        F.col("c.k").alias("_ck"), F.col("c.h").alias("_ch"), F.col("c._same").alias("_cn")
    )
    # The row travels as one struct, so that no column of it can be taken for one of ours.
    mine = docs.select(F.struct(*columns).alias("_row"), row_hash.alias("_mh"))
    kept = mine.join(chosen, (F.col("_mh") == F.col("_ch")) & F.col("_row")[key].eqNullSafe(F.col("_ck")))
    out = [F.col("_row")[c].alias(c) for c in docs.columns]
    once = kept.where("_cn = 1").select(*out)
    # Equal rows (all columns) are rare where keys are unique; only they pass another exchange.
    again = kept.where("_cn > 1").dropDuplicates(["_ck", "_ch"]).select(*out)
    return once.unionByName(again)

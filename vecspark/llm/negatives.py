"""Hard negatives by bounds along spanning trees of anchors.

The anchors that meet in a task are cut into groups of near ones, and each group gets a minimum
spanning tree. For an edge from anchor p to anchor a and a candidate c,
|<a, c> - <p, c>| <= |a - p| * |c|. So the score at p, or the interval that is known there, gives an
interval at a, and only candidates whose interval overlaps a's window are scored again. The window
of positives reaches from the k-th best score so far upwards; that of negatives is given by the scores
of the positives. Only exact integer scores decide; a bound that cannot exclude leaves the
candidate in.

Anchors and candidates meet in a grid of bundles and slices whose numbers follow the counts: a label
with a large share of the rows is spread over many tasks. Each cell of the grid returns a few rows
for each of its anchors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from vecspark.session import materialise

#: Anchors and candidates in one cell of the grid, and anchors in one spanning tree.
BUNDLE, SLICE, TREE = 16_384, 16_384, 256
#: Squared norms from here on take no part: products stay inside 63 bits below it.
LARGEST = 2.0**62


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int, *more: Column) -> DataFrame:
    """``id, v, d`` and more columns, one row a key: the smallest of rows that repeat a key.

    Out go null keys, null vectors, and those with a component that is null or not finite, or
    whose whole numbers floor(scale * x) have a squared norm of 2**62 or more.
    """
    x = F.col(vector)
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")), F.lit(False)))
    square = lambda e: F.pow(F.floor(F.least(F.greatest(e.cast("double") * scale, F.lit(-4e9)), F.lit(4e9))).cast("double"), 2)
    norm = F.aggregate(x, F.lit(0.0), lambda s, e: s + square(e))
    rows = df.where(F.col(key).isNotNull() & x.isNotNull()).where(finite).where(norm < LARGEST)
    rows = rows.select(F.col(key).cast("long").alias("id"), F.struct(x.alias("v"), *more).alias("r"))
    rows = rows.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.*")
    return rows.withColumn("d", F.size("v"))


def whole(vectors: pd.Series, scale: int) -> np.ndarray:
    rows = np.array(vectors.tolist(), np.float64).reshape(len(vectors), -1)
    return np.floor(rows * scale)


class Scorer:
    """Exact products of whole vectors; as doubles where every partial sum fits 53 bits."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray):
        self.norms, self.lengths = np.linalg.norm(rows, axis=1), np.linalg.norm(anchors, axis=1)
        self.small = float(self.norms.max(initial=0)) * float(self.lengths.max(initial=0)) < 2.0**52
        self.anchors, self.rows = (anchors, rows) if self.small else (anchors.astype(np.int64), rows.astype(np.int64))

    def __call__(self, anchor: int, which: np.ndarray | slice) -> np.ndarray:
        return (self.rows[which] @ self.anchors[anchor]).astype(np.int64)


def near_groups(vectors: np.ndarray, size: int = TREE) -> Iterator[np.ndarray]:
    """Positions in groups of at most ``size``, by halving along the line through two far rows."""
    todo = [np.arange(len(vectors))]
    while todo:
        own = todo.pop()
        if len(own) <= size:
            yield own
            continue
        part = vectors[own]
        a = part[np.argmax(((part - part.mean(axis=0)) ** 2).sum(axis=1))]
        b = part[np.argmax(((part - a) ** 2).sum(axis=1))]
        order = np.argsort(part @ (a - b), kind="stable")
        todo += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float]]:
    """(position, parent or -1, edge length) of a minimum spanning tree, parents first (Prim)."""
    far = np.full(len(vectors), np.inf)
    parent = np.full(len(vectors), -1)
    root = int(np.argmin(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1)))
    far[root], left, out = 0.0, np.ones(len(vectors), bool), []
    for _ in range(len(vectors)):
        i = int(np.argmin(np.where(left, far, np.inf)))
        out.append((i, int(parent[i]), float(far[i])))
        left[i] = False
        distance = np.sqrt(((vectors - vectors[i]) ** 2).sum(axis=1))
        nearer = left & (distance < far)
        far[nearer], parent[nearer] = distance[nearer], i
    return out


def walk(
    scorer: Scorer, vectors: np.ndarray, choose: Callable[[int, np.ndarray, np.ndarray, Callable], None]
) -> int:
    """Call ``choose(anchor, low, high, score)`` for every anchor, parents first.

    ``low`` and ``high`` enclose the scores of all candidates; ``score(which)`` gives exact ones
    and narrows the intervals that the anchor's children inherit. Returns the number of
    scores that were taken.
    """
    taken = 0
    for group in near_groups(vectors):
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        tree = spanning_tree(vectors[group])
        waiting = np.bincount([p for _, p, _ in tree if p >= 0], minlength=len(group))
        for i, parent, edge in tree:
            anchor = int(group[i])
            # What rounding can move: products of lengths, to one part in 1e9.
            slack = 1e-9 * scorer.lengths[anchor] * scorer.norms + 1e-6
            if parent < 0:
                high = scorer.lengths[anchor] * scorer.norms + slack
                low = -high
            else:
                low, high = known[parent]
                reach = edge * scorer.norms + slack
                low, high = low - reach, high + reach
                waiting[parent] -= 1
                if not waiting[parent]:
                    del known[parent]

            def score(which: np.ndarray) -> np.ndarray:
                nonlocal taken
                taken += len(which)
                exact = scorer(anchor, which)
                low[which] = high[which] = exact
                return exact

            choose(anchor, low, high, score)
            if waiting[i]:
                known[i] = (low, high)
    return taken


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def cell_positives(a_id, a_rows, c_id, c_rows, k: int) -> list[tuple]:
    """(anchor, candidate, score) of the k best candidates of each anchor but itself."""
    out = []

    def choose(anchor, low, high, score):
        other = c_id != a_id[anchor]
        upper = np.where(other, high, -np.inf)
        first = np.argpartition(-upper, min(k, len(upper)) - 1)[:k]
        first = first[other[first]]
        exact = score(first)
        if len(first) >= k:  # with fewer there is no bar, and every other candidate is among them
            rest = other & (upper >= exact.min())
            rest[first] = False
            more = np.flatnonzero(rest)
            first, exact = np.concatenate((first, more)), np.concatenate((exact, score(more)))
        top = best(exact, c_id[first], k)
        out.extend((a_id[anchor], c_id[first[j]], int(exact[j])) for j in top)

    walk(Scorer(a_rows, c_rows), a_rows, choose)
    return out


def cell_negatives(a_id, a_label, a_rows, positives, c_id, c_label, c_rows, k: int, least: int, most: int) -> list[tuple]:
    """(anchor, positive, its score, candidate, score): the k best of other labels in each positive's window."""
    out = []

    def choose(anchor, low, high, score):
        # Whole scores n with least * p <= 100 * n <= most * p.
        windows = [(i, s, -(-least * s // 100), most * s // 100) for i, s in positives[anchor]]
        windows = [w for w in windows if w[2] <= w[3]]
        if not windows:
            return
        other = c_label != a_label[anchor]
        bottom, top = min(w[2] for w in windows), max(w[3] for w in windows)
        which = np.flatnonzero(other & (high >= bottom) & (low <= top))
        exact = score(which)
        for i, s, bottom, top in windows:
            inside = np.flatnonzero((exact >= bottom) & (exact <= top))
            chosen = inside[best(exact[inside], c_id[which[inside]], k)]
            out.extend((a_id[anchor], i, s, c_id[which[j]], int(exact[j])) for j in chosen)

    walk(Scorer(a_rows, c_rows), a_rows, choose)
    return out


def _meet(anchors: DataFrame, rows: DataFrame, by: list[str], task, schema: str, bundle: int, slice_rows: int) -> DataFrame:
    """``task(anchors, rows)`` for every bundle of anchors and slice of rows that agree in ``by``."""
    n_rows = rows.groupBy(*by).agg(F.ceil(F.count("*") / slice_rows).cast("int").alias("ns"))
    grid = anchors.groupBy(*by).agg(F.ceil(F.count("*") / bundle).cast("int").alias("nb")).join(n_rows, by)
    grid = materialise(grid, "negatives-grid")  # a row for each length, or length and label
    number = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = anchors.join(grid, by).withColumn("b", F.pmod(F.xxhash64("id"), "nb").cast("int")).withColumn("s", number("ns"))
    right = rows.join(grid, by).withColumn("s", F.pmod(F.xxhash64("id"), "ns").cast("int")).withColumn("b", number("nb"))
    keys = [*by, "b", "s"]
    left = left.select(*[F.col(c).alias(f"a_{c}") for c in [*dict.fromkeys([*keys, *anchors.columns])]])
    right = right.select(*dict.fromkeys([*keys, *rows.columns]))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found = task(a, c) if len(a) and len(c) else []
        return pd.DataFrame(found, columns=names) if found else pd.DataFrame({n: pd.Series([], dtype="int64") for n in names})

    return left.groupBy(*[f"a_{k}" for k in keys]).cogroup(right.groupBy(*keys)).applyInPandas(run, schema)


def mine(
    vectors: DataFrame, anchors: Callable[[Column], Column], key: str = "vec_id", label: str = "label", vector: str = "embedding",
    n_positives: int = 5, n_negatives: int = 3, least: int = 50, most: int = 95, scale: int = 256,
    bundle: int = BUNDLE, slice_rows: int = SLICE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose key ``anchors`` selects. A score is the product of whole vectors
    floor(scale * x); the positives of an anchor are its ``n_positives`` best other rows of its label, and
    for each positive come the ``n_negatives`` best rows of other labels that reach from ``least`` to
    ``most`` hundredths of the positive's score. Ties go to smaller keys.

    Rows with a null key, label or vector, or a component that is null or not finite, take no part, nor do
    vectors so long that a product could leave 64 bits (squared norm of 2**62 after scaling). Only
    vectors of one length meet; empty ones score 0. Of rows that repeat a key the smallest
    (vector, then label) counts. Other columns are not read; an empty table gives no rows.
    """
    rows = whole_vectors(vectors.where(F.col(label).isNotNull()), key, vector, scale, F.col(label).cast("long").alias("y"))
    rows = materialise(rows, "negatives-rows")
    asked = rows.where(anchors(F.col("id")))
    pack = lambda s: whole(s, scale)

    def positives(a: pd.DataFrame, c: pd.DataFrame) -> list[tuple]:
        return cell_positives(a["a_id"].to_numpy(), pack(a["a_v"]), c["id"].to_numpy(), pack(c["v"]), n_positives)

    found = _meet(asked, rows, ["d", "y"], positives, "anchor_id long, positive_id long, score long", bundle, slice_rows)
    order = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "positive_id")
    found = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n_positives)
    found = materialise(found.select("anchor_id", "positive_id", "score"), "negatives-positives")
    lists = found.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "score")).alias("p"))

    def negatives(a: pd.DataFrame, c: pd.DataFrame) -> list[tuple]:
        given = [[(int(x["positive_id"]), int(x["score"])) for x in p] for p in a["a_p"]]
        return cell_negatives(
            a["a_id"].to_numpy(), a["a_y"].to_numpy(), pack(a["a_v"]), given, c["id"].to_numpy(), c["y"].to_numpy(),
            pack(c["v"]), n_negatives, least, most,
        )

    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    out = _meet(asked.join(lists, "id"), rows, ["d"], negatives, schema, bundle, slice_rows)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

"""Approximate nearest neighbours by a forest of random-projection trees.

A tree halves the vectors by their projection on a random direction (the one of a few on which
they spread most), at the median, until ``leaf`` are left. Each tree is grown in a task from a bounded
sample; then every row is routed to one leaf of each tree. A query keeps one priority queue for all
trees: nodes are opened in the order of the smallest margin by which the query missed a side
on the way, until the opened leaves hold ``share`` of the rows (``floor`` at least). The rows of opened leaves are
ranked by exact distances.

Queries meet the rows where the leaves are: a leaf's rows are cut into slices and its queries into
blocks by their counts, so a leaf of any size is searched whole, by tasks of bounded size. Leaves that no
query opens are not moved. Equal vectors are one entry with the ``k + 1`` smallest keys, which is all that
an answer can hold of them, so a large group of copies costs one entry and one search.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from vecspark.session import materialise

#: Trees; distinct vectors they are grown from; of these in a leaf; directions tried for a split.
TREES, SAMPLE, LEAF, DIRECTIONS = 4, 65_536, 512, 16
#: Rows to search: this share of all (a row counts once for each tree), and this many at least.
SHARE, FLOOR = 1.25, 10_000
#: Rows and queries of a leaf in one task.
SLICE, BLOCK = 16_384, 4096
#: Rows x queries compared at once.
_TILE = 4_000_000


@dataclass(frozen=True)
class Tree:
    """``children[n]`` are the nodes below plane n; a leaf l is -1 - l. ``root`` may be a leaf."""

    planes: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    root: int
    n_leaves: int


def grow(vectors: np.ndarray, leaf: int, seed: int, directions: int = DIRECTIONS) -> Tree:
    rng = np.random.default_rng(seed)
    planes, offsets, children, n_leaves = [], [], [], 0
    root = -1
    todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(vectors)), -1, 0)]
    while todo:
        own, parent, side = todo.pop()
        node = None
        if len(own) > max(1, leaf):
            ways = rng.normal(size=(directions, vectors.shape[1]))
            ways /= np.linalg.norm(ways, axis=1, keepdims=True)
            spread = vectors[own] @ ways.T
            way = int(np.argmax(spread.var(axis=0)))
            middle = float(np.median(spread[:, way]))
            right = spread[:, way] > middle
            if right.any() and not right.all():
                node = len(planes)
                planes.append(ways[way])
                offsets.append(middle)
                children.append([0, 0])
                todo += [(own[~right], node, 0), (own[right], node, 1)]
        if node is None:
            node, n_leaves = -1 - n_leaves, n_leaves + 1
        if parent < 0:
            root = node
        else:
            children[parent][side] = node
    width = vectors.shape[1]
    return Tree(
        np.array(planes).reshape(-1, width), np.array(offsets, float), np.array(children, int).reshape(-1, 2), root, n_leaves
    )


class Forest:
    """Trees of one length of vectors, their leaves numbered through from ``first``."""

    def __init__(self, trees: list[Tree], first: int = 0):
        self.trees = trees
        self.starts = first + np.concatenate(([0], np.cumsum([t.n_leaves for t in trees])))

    @property
    def end(self) -> int:
        return int(self.starts[-1])

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree (vectors x trees)."""
        out = np.empty((len(vectors), len(self.trees)), np.int64)
        for t, tree in enumerate(self.trees):
            node = np.full(len(vectors), tree.root)
            while True:
                inner = np.flatnonzero(node >= 0)
                if not len(inner):
                    break
                at = node[inner]
                margin = np.einsum("ij,ij->i", vectors[inner], tree.planes[at]) - tree.offsets[at]
                node[inner] = tree.children[at, (margin > 0).astype(int)]
            out[:, t] = self.starts[t] - 1 - node
        return out

    def opened(self, query: np.ndarray, sizes: np.ndarray, wanted: float) -> list[int]:
        """Leaves in the order of one queue over all trees, until they hold ``wanted`` rows."""
        margins = [t.planes @ query - t.offsets for t in self.trees]
        queue = [(-np.inf, i, t.root) for i, t in enumerate(self.trees)]
        heapq.heapify(queue)
        found, held = [], 0
        while queue and held < wanted:
            missed, i, node = heapq.heappop(queue)
            if node < 0:
                leaf = int(self.starts[i]) - 1 - node
                found.append(leaf)
                held += sizes[leaf]
                continue
            margin, (left, right) = margins[i][node], self.trees[i].children[node]
            heapq.heappush(queue, (max(missed, margin), i, left))
            heapq.heappush(queue, (max(missed, -margin), i, right))
        return found


def nearest(queries: np.ndarray, rows: np.ndarray, order: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, positions, distances) of the k nearest rows, ties to smaller ``order``."""
    lengths = np.einsum("ij,ij->i", rows, rows)
    step = max(1, _TILE // max(1, len(rows)))
    for start in range(0, len(queries), step):
        part = queries[start : start + step]
        own = np.einsum("ij,ij->i", part, part)
        rough = own[:, None] + lengths[None, :] - 2.0 * (part @ rows.T)
        error = 1e-12 * (own + lengths.max(initial=0.0))
        kth = np.partition(rough, min(k, len(rows)) - 1, axis=1)[:, min(k, len(rows)) - 1]
        for i in range(len(part)):
            # Not "<=": vectors so long that their squares overflow stay in.
            near = np.flatnonzero(~(rough[i] > kth[i] + 2.0 * error[i]))
            distance = exact_distances(part[i], rows[near])
            best = np.lexsort((order[near], distance))[:k]
            yield start + i, near[best], distance[best]


def exact_distances(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    rest = rows - query
    return np.sqrt((rest * rest).sum(axis=1))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.float64).reshape(len(vectors), -1)


def entries(vectors: DataFrame, key: str, vector: str, k: int) -> tuple[DataFrame, DataFrame]:
    """(``id, h1, h2``: a row a key; ``h1, h2, v, ids, d``: a row a distinct vector with its k smallest keys)."""
    x = F.col(vector)
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")), F.lit(False)))
    rows = vectors.where(F.col(key).isNotNull() & x.isNotNull()).where(finite & F.exists(x, lambda e: e != 0))
    rows = rows.groupBy(F.col(key).cast("long").alias("id")).agg(F.min(x).alias("v"))
    rows = materialise(
        rows.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")), "forest-rows"
    )
    smallest = Window.partitionBy("h1", "h2").orderBy("id")
    few = rows.withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k)
    # A copy after the first adds its key only.
    few = few.withColumn("v", F.when(F.col("r") == 1, F.col("v")))
    same = few.groupBy("h1", "h2").agg(F.max("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids"))
    return rows.select("id", "h1", "h2"), same.withColumn("d", F.size("v"))


def plant(distinct: DataFrame, trees: int, sample: int, leaf: int, seed: int) -> dict[int, Forest]:
    """A forest for each length of vectors in a sample of about ``sample`` rows, chosen by hash."""
    share = sample / max(1, distinct.count())
    chosen = distinct if share >= 1 else distinct.where(F.pmod("h2", F.lit(1 << 30)) < int(share * (1 << 30)))
    spread = chosen.select("d", "h1", "v", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = _matrix(rows.sort_values("h1", kind="stable")["v"])
        grown = vars(grow(own, leaf, seed + int(key[1])))
        return pd.DataFrame({"d": [key[0]], "tree": [key[1]], "data": [pickle.dumps(grown)]})

    grown = spread.groupBy("d", "tree").applyInPandas(run, "d int, tree int, data binary")
    forests: dict[int, Forest] = {}
    first, by = 0, {}
    for row in sorted(grown.collect(), key=lambda r: (r["d"], r["tree"])):  # planes of at most sample / leaf nodes a tree
        by.setdefault(row["d"], []).append(Tree(**pickle.loads(bytes(row["data"]))))
    for d, own in by.items():
        forests[d] = Forest(own, first)
        first = forests[d].end
    return forests


def search(
    vectors: DataFrame, queries: Callable[[Column], Column], key: str = "vec_id", vector: str = "embedding", k: int = 10,
    trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF, share: float = SHARE, floor: int = FLOOR, seed: int = 11,
    slice_rows: int = SLICE, block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: about the k nearest other rows of each row whose key ``queries``
    selects, by Euclidean distance in double precision; ties to the smaller key.

    Every row is indexed. Scores are exact; which rows are found depends on the leaves opened.
    Rows with a null key, and vectors that are null, empty, zero or hold a component that is null or not
    finite, take no part. A key is one vector: of rows that repeat it the smallest vector counts. Only
    vectors of one length meet; a length that the sample lacks is searched whole. Other columns are not
    read; an empty table gives no rows.
    """
    rows, distinct = entries(vectors, key, vector, k + 1)
    distinct = materialise(distinct, "forest-distinct")
    forests = plant(distinct, trees, sample, leaf, seed)
    end = max([f.end for f in forests.values()], default=0)
    # The functions below carry the forests: at most trees * sample / leaf planes.

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            leaves = pd.Series([[-1]] * len(batch), index=batch.index, dtype=object)
            for d, own in batch.groupby("d"):
                if d in forests:
                    leaves[own.index] = list(forests[d].leaves(_matrix(own["v"])))
            yield batch.assign(leaves=leaves)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema)
    index = materialise(distinct.mapInPandas(route, f"{fields}, leaves array<long>"), "forest-index")
    placed = index.withColumn("leaf", F.explode("leaves")).drop("leaves")
    counts = materialise(placed.groupBy("d", "leaf").agg(F.count("*").alias("n")), "forest-leaves")
    sizes = np.zeros(end, np.int64)
    totals: dict[int, int] = {}
    for row in counts.where("leaf >= 0").collect():  # a row a leaf
        sizes[row["leaf"]] = row["n"]
        totals[row["d"]] = totals.get(row["d"], 0) + row["n"] / trees

    asked = rows.where(queries(F.col("id")))
    searched = index.join(asked.select("h1", "h2").distinct(), ["h1", "h2"]).select("h1", "h2", "v", "d")

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                opened = [
                    forests[d].opened(np.asarray(v, np.float64), sizes, max(floor, share * totals[d])) if d in forests else [-1]
                    for d, v in zip(part["d"], part["v"])
                ]
                yield part.assign(leaf=opened).explode("leaf").astype({"leaf": "int64"})

    visits = materialise(searched.mapInPandas(visit, "h1 long, h2 long, v " + distinct.schema["v"].dataType.simpleString() + ", d int, leaf long"), "forest-visits")
    grid = visits.groupBy("d", "leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("nb"))
    grid = grid.join(counts, ["d", "leaf"]).withColumn("ns", F.ceil(F.col("n") / slice_rows).cast("int")).drop("n")
    grid = materialise(grid, "forest-grid")
    number = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = visits.join(grid, ["d", "leaf"]).withColumn("b", F.pmod("h1", "nb").cast("int")).withColumn("s", number("ns"))
    right = placed.join(grid, ["d", "leaf"]).withColumn("s", F.pmod("h1", "ns").cast("int")).withColumn("b", number("nb"))
    keys = ["d", "leaf", "b", "s"]
    left = left.select(*[F.col(c).alias(f"q_{c}") for c in [*keys, "h1", "h2", "v"]])
    right = right.select(*keys, "h1", "h2", "v", "ids")
    names = ["q1", "q2", "h1", "h2", "distance", "first", "ids"]

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({n: pd.Series([], dtype=object) for n in names})
        ids, first = b["ids"].to_numpy(), b["ids"].str[0].to_numpy(np.int64)
        q1, q2, h1, h2 = a["q_h1"].to_numpy(), a["q_h2"].to_numpy(), b["h1"].to_numpy(), b["h2"].to_numpy()
        found = [
            pd.DataFrame({"q1": q1[i], "q2": q2[i], "h1": h1[at], "h2": h2[at], "distance": d, "first": first[at], "ids": ids[at]})
            for i, at, d in nearest(_matrix(a["q_v"]), _matrix(b["v"]), first, k + 1)
        ]
        return pd.concat(found, ignore_index=True)[names]

    schema = "q1 long, q2 long, h1 long, h2 long, distance double, first long, ids array<long>"
    met = left.groupBy(*[f"q_{c}" for c in keys]).cogroup(right.groupBy(*keys)).applyInPandas(meet, schema)
    once = met.groupBy("q1", "q2", "h1", "h2").agg(F.min(F.struct("distance", "first", "ids")).alias("m")).select("q1", "q2", "m.*")
    near = Window.partitionBy("q1", "q2").orderBy("distance", "first")
    once = once.withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 1)
    pairs = asked.join(once, (F.col("h1") == F.col("q1")) & (F.col("h2") == F.col("q2")))
    pairs = pairs.select(F.col("id").alias("query_id"), F.explode("ids").alias("vec_id"), F.col("distance").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    out = pairs.where("query_id <> vec_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")

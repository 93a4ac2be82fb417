"""The forest, the prefix trie and the hard negatives against brute force, on awkward inputs."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecspark.llm import forest, negatives, prefixtrie

CLASHING = "d int, v string, h1 string, leaf string, ids string, y string, b int, s int, id string"


def vectors(spark, rows):
    """(vec_id, embedding, label) rows with extra columns whose names the operators use inside."""
    extra = (1, "v", "h", "l", "i", "y", 2, 3, "x")
    return spark.createDataFrame([(*r, *extra) for r in rows], f"vec_id long, embedding array<float>, label int, {CLASHING}")


def awkward_vectors(n=400, dim=8, copies=150, seed=4):
    """Rows in clusters, a third of them copies of one vector, and all that takes no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    rows = [(i, (centres[i % 5] + 0.3 * rng.normal(size=dim)).astype(np.float32).tolist(), i % 4) for i in range(n)]
    rows += [(1000 + i, rows[7][1], i % 2) for i in range(copies)]
    rows += [(2000, None, 1), (2010, [float("nan")] * dim, 1), (2020, [None] + [1.0] * (dim - 1), 1), (None, rows[0][1], 1)]
    rows += [(2030, [float("inf")] + [0.0] * (dim - 1), 1), (2040, [1.0, 2.0], 1), (2050, [2.0, 1.0], 1), (2060, [1.0, 1.0], 2)]
    rows += [(2070, [0.0] * dim, 1), (2080, [], 1), rows[0], (2090, rows[3][1], None), rows[20]]
    return rows


# --- forest -----------------------------------------------------------------------------------


def usable(rows, zero=False):
    kept = {}
    for i, v, _ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not zero and not any(v):
            continue
        kept[i] = min(kept.get(i, v), v)
    return kept


def slow_nearest(rows, wanted, k):
    kept = {i: np.array(v, np.float64) for i, v in usable(rows).items()}
    out = set()
    for q in (i for i in kept if wanted(i)):
        near = sorted((float(np.sqrt(((kept[q] - v) ** 2).sum())), i) for i, v in kept.items() if i != q and len(v) == len(kept[q]))
        out |= {(q, r + 1, i, d) for r, (d, i) in enumerate(near[:k])}
    return out


def test_forest_that_opens_all_leaves_is_exact(spark):
    rows = awkward_vectors()
    got = forest.search(vectors(spark, rows), lambda key: key % 10 == 0, k=6, leaf=100, slice_rows=32, block=15)
    assert {tuple(r) for r in got.collect()} == slow_nearest(rows, lambda i: i % 10 == 0, 6)


def test_forest_recall_and_exact_scores(spark):
    rows = awkward_vectors(3000, 16)
    settings = {"leaf": 32, "floor": 1, "share": 0.25, "sample": 500, "trees": 6}
    got = {tuple(r) for r in forest.search(vectors(spark, rows), lambda key: key % 20 == 0, k=5, **settings).collect()}
    want = slow_nearest(rows, lambda i: i % 20 == 0, 5)
    pairs = lambda found: {(q, i): d for q, _, i, d in found}
    assert len(pairs(got).keys() & pairs(want).keys()) / len(want) >= 0.9
    kept = {i: np.array(v, np.float64) for i, v in usable(rows).items()}
    assert all(d == float(np.sqrt(((kept[q] - kept[i]) ** 2).sum())) for q, _, i, d in got)
    again = {tuple(r) for r in forest.search(vectors(spark, rows[::-1]), lambda key: key % 20 == 0, k=5, **settings).collect()}
    assert again == got


def test_queue_opens_leaves_by_least_margin():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(500, 6))
    grown = [forest.grow(points, 20, seed) for seed in (1, 2, 3)]
    woods = forest.Forest(grown)
    leaves = woods.leaves(points)
    sizes = np.bincount(leaves.ravel(), minlength=woods.end)
    assert (sizes.reshape(-1)[: woods.end] <= 20).all() and sizes.sum() == 1500

    def worst_margins(query):
        found = {}

        def go(tree, start, node, missed):
            if node < 0:
                found[int(start) - 1 - node] = missed
                return
            margin = float(tree.planes[node] @ query - tree.offsets[node])
            go(tree, start, tree.children[node][0], max(missed, margin))
            go(tree, start, tree.children[node][1], max(missed, -margin))

        for tree, start in zip(woods.trees, woods.starts):
            go(tree, start, tree.root, -math.inf)
        return found

    query = rng.normal(size=6)
    margins = worst_margins(query)
    opened = woods.opened(query, sizes, 300)
    assert [margins[leaf] for leaf in opened] == sorted(margins.values())[: len(opened)]
    assert sum(sizes[opened]) >= 300 > sum(sizes[opened[:-1]])
    assert sorted(woods.opened(query, sizes, math.inf)) == list(range(woods.end))


def test_forest_of_long_components_and_nothing(spark):
    big = float(np.float32(3e38))
    rows = [(0, [big, 1.0], 0), (10, [-big, 1.0], 0), (11, [big, 2.0], 0), (12, [1.0, 1.0], 0)]
    got = forest.search(vectors(spark, rows), lambda key: key % 10 == 0, k=2)
    assert {tuple(r) for r in got.collect()} == slow_nearest(rows, lambda i: i % 10 == 0, 2)
    assert forest.search(vectors(spark, []), lambda key: key % 10 == 0).count() == 0
    assert forest.search(vectors(spark, [(0, [1.0], 0)]), lambda key: key % 10 == 0).count() == 0


# --- prefix trie ------------------------------------------------------------------------------


def slow_trie(rows, base=None, head=None):
    words = lambda t: len([w for w in re.split(r"[\x20\x09-\x0D]+", t) if w])
    name = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, name(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    if base:
        own = {c: own.get(base(c), [])[: head(c)] + ts[head(c):] for c, ts in own.items()}
    nodes = {}
    for c, ts in own.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    children, leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for x in nodes:
        if x:
            children[x[:-1]] += 1
    for x, members in nodes.items():
        for d in range(len(x) + 1):
            leaves[x[:d]] += not children[x]
            saved[x[:d]] += (len(members) - 1) * words(x[-1][1]) if x else 0
    ends = lambda x: hashlib.sha256(",".join(str(c) for c in sorted(nodes[x]) if len(own[c]) == len(x)).encode()).hexdigest()
    return {
        (min(m), len(x), min(nodes[x[:-1]]) if x else None, len(m), children[x], leaves[x], saved[x], ends(x)) for x, m in nodes.items()
    }


def conversations(spark, rows):
    schema = "conv_id long, turn long, role string, text string, c long, t1 string, j int, k1 long, id string, pos long, n long"
    return spark.createDataFrame([(*r, 5, "t", 1, 2, "i", 3, 4) for r in rows], schema)


def awkward_conversations(seed=6):
    rng = random.Random(seed)
    rows = []
    for c in range(-3, 90):
        for turn in range(rng.choice([1, 1, 2, 3, 4, 9])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), f"{rng.choice('ab')} word\t{rng.choice('xy')}"))
    long_one = [("user", f"turn {i % 7} x") for i in range(75)]
    rows += [(c, i, *t) for c in (100, 101, 140) for i, t in enumerate(long_one)]  # three equal long ones
    rows += [(102, i, *t) for i, t in enumerate(long_one[:40] + [("user", "other")] * 30)]
    rows += [(c, 0, "system", "hello hello") for c in range(200, 290)]  # a large group of copies
    rows += [(300, None, None, "null turn first"), (300, 0, "user", None), (300, 0, "user", None), (300, 1, None, None), (300, 1, "a", "tie")]
    rows += [(None, 0, "user", "no key"), (321, 5, "", ""), (361, 1, "user", "z " * 20_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [3, 8])
def test_trie_matches_brute_force(spark, width):
    rows = awkward_conversations()
    got = prefixtrie.trie(conversations(spark, rows), width=width)
    assert {tuple(r) for r in got.collect()} == slow_trie(rows)


def test_rebuilt_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "PART", 2)  # keys of long conversations in parts
    monkeypatch.setattr(prefixtrie, "JOINED", 7)  # texts of ids in parts
    rows = [r for r in awkward_conversations() if r[0] not in (0, 20)]  # two bases are absent
    crc = lambda c: zlib.crc32(str(c).encode()) % 4
    got = prefixtrie.trie(
        conversations(spark, rows), base=F.col("c") - F.col("c") % 20, head=F.crc32(F.col("c").cast("string")) % 4, most=3, width=4
    )
    want = slow_trie(rows, lambda c: c - int(math.fmod(c, 20)), crc)
    assert any(n[1] == 0 and n[7] != hashlib.sha256(b"").hexdigest() for n in want)  # some are left without turns
    assert {tuple(r) for r in got.collect()} == want


def test_trie_of_nothing(spark):
    assert prefixtrie.trie(conversations(spark, [])).count() == 0
    assert prefixtrie.trie(conversations(spark, [(None, 1, "a", "b")])).count() == 0


# --- hard negatives ---------------------------------------------------------------------------


def slow_negatives(rows, wanted, scale=256):
    kept = {}
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(x * scale) for x in v]
        if sum(x * x for x in whole) < 2**62:
            kept[i] = min(kept.get(i, (v, y, whole)), (v, y, whole))
    score = lambda a, b: sum(x * z for x, z in zip(kept[a][2], kept[b][2]))
    out = set()
    for a in (i for i in kept if wanted(i)):
        others = [i for i in kept if i != a and len(kept[i][2]) == len(kept[a][2])]
        ranked = lambda same: sorted((-score(a, i), i) for i in others if (kept[i][1] == kept[a][1]) == same)
        other = ranked(False)
        for s, p in ranked(True)[:5]:
            inside = [(-n, i) for n, i in other if 50 * -s <= 100 * -n <= 95 * -s]
            out |= {(a, p, r + 1, i, -s, n) for r, (n, i) in enumerate(inside[:3])}
    return out


def test_negatives_match_brute_force(spark):
    rows = awkward_vectors(dim=6)
    rows += [(3000, [3e38] + [1.0] * 5, 1), (3010, [4e6] * 6, 1), (3020, [4.1e6] * 6, 2), (3030, [3.3e6] * 6, 2), (3040, [-4e6] * 6, 1)]
    got = {tuple(r) for r in negatives.mine(vectors(spark, rows), lambda key: key % 10 == 0, bundle=16, slice_rows=100).collect()}
    assert got == slow_negatives(rows, lambda i: i % 10 == 0)
    assert got and {tuple(r) for r in negatives.mine(vectors(spark, rows), lambda key: key % 10 == 0).collect()} == got
    assert negatives.mine(vectors(spark, []), lambda key: key % 10 == 0).count() == 0


def test_tree_bounds_save_scores_and_lose_none():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 12)) * 3
    rows = np.floor((centres[rng.integers(0, 6, 3000)] + 0.05 * rng.normal(size=(3000, 12))) * 256)
    anchors = rows[:300]
    scorer = negatives.Scorer(anchors, rows)
    exact = anchors @ rows.T
    taken = []

    def choose(anchor, low, high, score):
        assert (low <= exact[anchor]).all() and (exact[anchor] <= high).all()
        bar = np.sort(exact[anchor])[-50]
        which = np.flatnonzero(high >= bar)
        taken.append(len(which))
        assert (score(which) == exact[anchor][which]).all()

    assert negatives.walk(scorer, anchors, choose) == sum(taken)
    assert len(taken) == 300 and sum(taken) < 0.5 * exact.size


def test_spanning_tree_is_minimal():
    rng = np.random.default_rng(8)
    points = rng.integers(-50, 50, (60, 3)).astype(float)
    points[10:20] = points[5]
    tree = negatives.spanning_tree(points)
    seen = set()
    for i, parent, edge in tree:
        assert (parent in seen) if seen else parent == -1
        seen.add(i)
        if parent >= 0:
            assert edge == np.sqrt(((points[i] - points[parent]) ** 2).sum())
    far = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    edges, root, total = sorted((far[i, j], i, j) for i in range(60) for j in range(i)), list(range(60)), 0.0
    for length, i, j in edges:  # Kruskal
        if root[i] != root[j]:
            old, total = root[i], total + length
            root = [root[j] if r == old else r for r in root]
    assert len(seen) == 60 and abs(sum(e for _, _, e in tree) - total) < 1e-9

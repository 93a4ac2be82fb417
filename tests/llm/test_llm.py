"""The operators of vecspark.llm against brute force, on small and awkward inputs."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vecspark.llm import bpe, ctw, decontaminate, licenses, quality, quotes, secrets, simhash, topk, toxicity
from vecspark.llm.common import auc, fold
from vecspark.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, n_chars long, score double, _id string, _t string, fingerprint string, hash int, row int"
HEX = "3f9a0c41d2b7e86655aa10fe23cd987b04e1a5c8"
TOKEN = "q7Zp2LxV9mKt4RbW8nYc3HsD6fGj1AuE5oTi0QwS"


def frame(spark, rows):
    """(doc_id, text) rows with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None if t is None else len(t), 0.5, "x", "y", "z", 1, 2) for i, t in rows], SCHEMA)


def awkward():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéñ") for _ in range(rng.randint(2, 7)))
    base = [" ".join(word() for _ in range(60)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(10, None), (11, ""), (12, "   \n "), (13, "one two"), (14, None), (None, base[0]), (None, None)]
    rows += [(0, base[0]), (20, base[0].upper()), (21, base[1] + " tail"), (22, base[1].replace(" ", "  "))]
    rows += [(30, " ".join(word() for _ in range(30000)))]
    rows += [(40, f'my password = "{HEX}" and AKIA{"Z9" * 9} é {HEX}'), (41, f"key {TOKEN} end"), (42, "token:token:abcdefgh")]
    return rows


def rows_of(df):
    return sorted(df.collect(), key=str)


# --- near duplicates ---------------------------------------------------------------------------


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(prints, radius=4):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    keys = list(parent)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    return {p: root(p) for p in keys}


def test_simhash_group_matches_brute_force(spark):
    rows = awkward()
    got = simhash.group(frame(spark, rows)).collect()
    prints = [slow_print(t) for _, t in rows]
    roots = slow_components(set(prints))
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    want = sorted(str((i, p, least.get(roots[p]))) for (i, _), p in zip(rows, prints))
    assert sorted(str((r["doc_id"], r["fingerprint"] % 2**64, r["component"])) for r in got) == want


def test_links_lose_no_pair(spark):
    rng = random.Random(1)
    prints = set()
    for _ in range(150):
        p = rng.getrandbits(64)
        for _ in range(rng.choice((1, 1, 8))):
            prints.add(p)
            for b in rng.sample(range(64), rng.randint(1, 6)):
                p ^= 1 << b
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    old = simhash.LEAF, simhash.LEAF_BLOCK
    simhash.LEAF, simhash.LEAF_BLOCK = 4, 6  # deep trees and crowded leaves
    try:
        roots = simhash.components(simhash.links(spark.createDataFrame(signed, "p long"), "p")).collect()
    finally:
        simhash.LEAF, simhash.LEAF_BLOCK = old
    got = {p: p for p in prints} | {r["node"] % 2**64: r["root"] % 2**64 for r in roots}
    want = slow_components(prints)
    groups = lambda m: sorted(tuple(sorted(k for k in m if m[k] == v)) for v in set(m.values()))
    assert groups(got) == groups(want)


def test_keep_one(spark):
    docs = frame(spark, awkward())
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == sorted({r["component"] for r in simhash.group(docs).collect()})
    assert simhash.keep_one(docs.where("false")).count() == 0
    assert simhash.keep_one(frame(spark, [(None, "a b"), (None, "a b")])).count() == 1


# --- decontamination -----------------------------------------------------------------------------


def slow_scan(rows, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for i, t in rows:
        w = split(t)
        hit, found = set(), set()
        for item, text in items:
            x = split(text)
            n = min(13, len(x))
            wins = {tuple(x[k: k + n]) for k in range(len(x) - n + 1)} if x else set()
            for k in range(len(w) - n + 1 if x else 0):
                if tuple(w[k: k + n]) in wins:
                    hit.update(range(k, k + n))
                    found |= {str(item)} if item is not None else set()
        out.append(str((i, len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w))))
    return sorted(out)


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 7])
def test_decontamination_matches_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    rows = awkward()
    long = rows[2][1].split()
    items = [(1, " ".join(long[5:25])), (10, " ".join(long[10:40]).upper()), (2, "one"), (3, " ".join(long[:13])), (4, None), (5, "!?")]
    items += [(2, "one"), (None, " ".join(rows[3][1].split()[:15])), (6, "two, ONE")]
    rows += [(50, "x. " * 300 + " ".join(long[5:20])), (51, "two one two one")]
    bench = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, words string")
    got = decontaminate.scan(frame(spark, rows), bench).collect()
    got = sorted(str((r["doc_id"], r["n_words"], r["n_hit"], sorted(r["items"]), r["contaminated"])) for r in got)
    assert got == slow_scan(rows, items)
    kept = decontaminate.remove(frame(spark, rows), bench)
    assert kept.columns == SCHEMA.replace(",", "").split()[::2]
    assert kept.count() == sum("True" not in x for x in got)
    assert decontaminate.scan(frame(spark, rows), bench.where("false")).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.scan(frame(spark, rows).where("false"), bench).count() == 0


# --- secrets --------------------------------------------------------------------------------------


def slow_spans(text):
    out = []
    for m in re.finditer(r"""((?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or "", re.A):
        out += [(m.start(), 0, m.end())] if len(m[2]) >= 6 else []
    for k, (p, n) in enumerate((("AKIA[A-Z0-9]+", 20), ("[0-9a-f]+", 24)), 1):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, text or "") if len(m[0]) >= n]
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_base_spans_match_brute_force(spark):
    rng = random.Random(3)
    bits = ["token", "TOKEN", "secret", "=", ":", " ", '"', "'", "abc", "9f" * 13, "AKIA", "Q7" * 9, "é", "\n", "-", ".", "api_key", "ApiKey", "ſecret"]
    rows = awkward() + [(100 + i, "".join(rng.choice(bits) for _ in range(40))) for i in range(300)]
    got = secrets.scan(frame(spark, rows)).select("doc_id", secrets.span_text(F.col("base")).alias("b")).collect()
    assert sorted(str((r["doc_id"], r["b"])) for r in got) == sorted(str((i, slow_spans(t))) for i, t in rows)


def test_battery_tells_random_from_text(spark):
    rng = random.Random(9)
    sets = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"]
    random_ones = ["".join(rng.choice(rng.choice(sets[1:]) if k % 2 else sets[0]) for _ in range(48)) for k in range(60)]
    text = ["".join(rng.choice(["the", "ing", "and", "er", "tion", "es", "_"]) for _ in range(16)) for _ in range(60)]
    regular = ["ab" * 20, "0123456789abcdef" * 3, "a" * 40, "-" * 50, "1" * 30]
    rows = [(i, f"see {t} there") for i, t in enumerate(random_ones + text + regular)]
    got = {r["doc_id"]: r["s"] for r in secrets.scan(frame(spark, rows)).select("doc_id", secrets.span_text(F.col("spans")).alias("s")).collect()}
    found = [i for i, s in got.items() if "random" in s or "hex" in s]
    assert sum(i < 60 for i in found) >= 55
    assert sum("random" in s for i, s in got.items() if i >= 60) <= 3


def test_mask(spark):
    docs = frame(spark, awkward())
    masked = secrets.mask(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    by_id = {r["doc_id"]: r["text"] for r in masked.where("doc_id IS NOT NULL").collect()}
    assert by_id[40] == 'my [SECRET]" and [SECRET] é [SECRET]'
    assert by_id[10] is None and by_id[13] == "one two"
    assert secrets.scan(docs.where("false")).count() == 0


# --- byte pairs -------------------------------------------------------------------------------------


def test_bpe_equals_whole_encoding(spark):
    voc = vocabulary()
    rows = awkward() + [(60, "a" * 3000 + " b  \n\n c's 123 " * 300), (61, "don't  \t stop　é" * 400), (62, "\n" * 2500), (63, "ab" * 64)]
    enc, pieces = voc.encoding(), voc.bytes_of()
    for chunk, overlap in ((128, 40), (bpe.CHUNK, bpe.OVERLAP)):
        got = bpe.decode(bpe.encode(frame(spark, rows), voc, chunk=chunk, overlap=overlap), voc).collect()
        want = sorted(str((i, np.array(enc.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode())) for i, t in rows)
        assert sorted(str((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"]))) for r in got) == want
    assert bpe.encode(frame(spark, rows).where("false"), voc).count() == 0
    assert b"".join(pieces[i] for i in enc.encode_ordinary("héllo")) == "héllo".encode()
    with open(__import__("public_tokenizers").path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        token, rank = f.readline().split()
    assert pieces[int(rank)] == base64.b64decode(token)


# --- exact search -------------------------------------------------------------------------------------


def test_topk_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = [(int(i), [float(x) for x in rng.normal(size=7)], 1) for i in range(300)]
    vectors += [(i + 1000, list(vectors[i][1]), 1) for i in range(100)]  # ties
    vectors += [(5000, None, 1), (5100, [1.0, None] + [0.0] * 5, 1), (5200, [float("nan")] * 7, 1), (5300, [float("inf")] * 7, 1)]
    vectors += [(6000, [3e6] * 7, 1), (6100, [-3e6] * 7, 1), (None, [1.0] * 7, 1), (6200, [], 1), (6300, [], 1)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, score int")
    good = {i: [math.floor(x * 1024) for x in v] for i, v, _ in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in good if i % 100 == 0):
        scored = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:10], 1)]
    for sizes in ({}, {"row_block": 50, "query_block": 2}):
        got = topk.topk(df, lambda key: key % 100 == 0, **sizes).collect()
        assert sorted(map(tuple, got)) == sorted(want)
    assert topk.topk(df.where("false"), lambda key: key % 100 == 0).count() == 0


def test_topk_blocks_meet_in_many_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-9, 9, 5)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = np.array([v for _, v in rows], np.int64) * 1024
    want = set()
    for q in range(0, 300, 100):
        near = sorted((-int(whole[q] @ whole[i]), i) for i in range(300) if i != q)
        want |= {(q, r, i, -s) for r, (s, i) in enumerate(near[:10], 1)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = topk.topk(df, lambda key: key % 100 == 0, row_block=30, query_block=1).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(map(tuple, got)) == want


def test_bounds_hold():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(20, 37)), rng.normal(size=(30, 37))
    for n in (1, 4, 16, 64):
        (s, d), (t, e) = topk.segment_statistics(a, n), topk.segment_statistics(b, n)
        assert (s @ t.T + d @ e.T >= a @ b.T - 1e-9).all()


# --- context trees -------------------------------------------------------------------------------------


def slow_ctw(train, texts, depth):
    counts = {}

    def walk(text):
        data = bytes([255]) * depth + text.lower() + bytes([255])
        for i in range(depth, len(data)):
            for k in range(8):
                place, bit = (1 << k) | (data[i] >> (8 - k)), data[i] >> (7 - k) & 1
                yield [(place, data[i - d: i]) for d in range(depth + 1)], bit

    for t in train:
        for path, bit in walk(t):
            for node in path:
                counts.setdefault(node, [0, 0])[bit] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
    children = {}
    for place, context in counts:
        if context:
            children.setdefault((place, context[1:]), []).append((place, context))
    pw = {}
    for node in sorted(counts, key=lambda n: -len(n[1])):
        pe = kt(*counts[node])
        below = sum(pw[c] for c in children.get(node, []))
        pw[node] = pe if len(node[1]) == depth else math.log(0.5) + np.logaddexp(pe, below)
    out = []
    for t in texts:
        bits = 0.0
        for path, bit in walk(t):
            seen = [n for n in path if n in counts]
            p = 0.5 if not seen else None
            for node in reversed(seen):
                a, b = counts[node]
                own = ((b if bit else a) + 0.5) / (a + b + 1)
                w = 1.0 if len(node[1]) == depth else min(1.0, math.exp(math.log(0.5) + kt(a, b) - pw[node]))
                p = own if p is None else w * own + (1 - w) * p
            bits -= math.log2(p)
        out.append(bits)
    return out


@pytest.mark.parametrize("block", [ctw.BLOCK, 400])
def test_ctw_matches_brute_force(spark, block):
    texts = ["the cat sat on the mat", "The dog sat\ton the log " + "w" * 60, "", None, "chat élevé", "zzz the unseen", "the cat sat on the mat"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[1])]
    got = ctw.score(frame(spark, rows), F.col("doc_id") != 5, depth=3, block=block).collect()
    raw = [(t or "").encode() for _, t in rows]
    train = [t for (i, _), t in zip(rows, raw) if i != 5]
    want = slow_ctw(train, raw, 3)
    split = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", t.lower()) + [b""]
    counts = Counter(w for t in train for w in split(t))
    total, kinds = sum(counts.values()), len(counts)
    expected = [
        (i, sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in split(t)), len(split(t)), sum(counts[w] > 0 for w in split(t)), bits)
        for (i, _), t, bits in zip(rows, raw, want)
    ]
    got = sorted((r["doc_id"], r["base_score"], r["n_tokens"], r["n_known"], r["bits"]) for r in got)
    for g, w in zip(got, sorted(expected), strict=True):
        assert g == pytest.approx(w, rel=1e-6)
    assert ctw.score(frame(spark, rows).where("false"), F.lit(True)).count() == 0
    none = ctw.score(frame(spark, rows), F.lit(False)).collect()
    assert all(r["bits"] == pytest.approx(8 * (len((t or "").encode()) + 1)) for r, t in zip(sorted(none, key=lambda r: -r["bits"])[:1], [texts[1]]))


# --- classifiers -------------------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    rng = random.Random(8)
    bad = ["idiotface", "scumlord", "trashbag"]
    rows, labels = [], []
    for i in range(400):
        words = ["".join(rng.choice(["ka", "lo", "mi", "ter", "un"]) for _ in range(3)) for _ in range(rng.randint(5, 80))]
        y = i % 4 == 0
        for _ in range(2 * y):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(y)))
    rows += [(1000, None), (1001, ""), (1002, "x" * (2 << 20) + " idiotface scumlord")]
    docs, table = frame(spark, rows), spark.createDataFrame(labels + [(None, 1), (3, None), (0, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, table, fold("doc_id", 4) != 2)
    scores = {r[0]: r[1] for r in docs.select("doc_id", model.column("text")).collect()}
    held = [(i, y) for i, y in labels if __import__("zlib").crc32(str(i).encode()) % 4 == 2]
    assert auc(np.array([scores[i] for i, _ in held]), np.array([y for _, y in held])) > 0.99
    assert scores[1002] > 0.5 and scores[1000] == scores[1001] < 0.3
    assert toxicity.reject(docs, model).columns == docs.columns
    empty = toxicity.train(docs, table.where("false"), F.lit(True))
    assert empty.score([None, "a"]).tolist() == pytest.approx([0.5, 0.5])


def test_quality_held_out(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        words = ["".join(rng.choice(["ka", "lo", "mi", "ter", "un"]) for _ in range(3)) for _ in range(rng.randint(5, 80))]
        y = i % 3 != 0
        rows.append((i, " ".join(words if y else [w.upper() + "!!" for w in words])))
        labels.append((i, int(y)))
    rows += [(1000, None), (1001, ""), (1002, "a" * 3_000_000)]
    docs, table = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(docs, table, fold("doc_id", 3) != 1)
    scores = {r[0]: r[1] for r in docs.select("doc_id", model.column("text", "n_chars")).collect()}
    held = [(i, y) for i, y in labels if __import__("zlib").crc32(str(i).encode()) % 3 == 1]
    assert auc(np.array([scores[i] for i, _ in held]), np.array([y for _, y in held])) > 0.98
    assert all(0 <= s <= 1 for s in scores.values())
    quality.train(docs, table.where("false"), F.lit(True)).raw(quality.featurise([b"a b"], np.array([np.nan]), 16))


def test_factorisation_identity():
    texts = [b"a b b c\nd", b"", b"X1 ## y"]
    bags = quality.featurise(texts, np.array([9.0, np.nan, 100.0]), 8)
    rng = np.random.default_rng(0)
    size = 256 + len(quality.STATISTICS) * quality.STEPS
    model = quality.QualityModel(8, 0.3, rng.normal(size=size), rng.normal(size=(size, 3)))
    cut = np.concatenate(([0], np.cumsum(bags.counts)))
    for i, got in enumerate(model.raw(bags)):
        ids = [*bags.slots[cut[i]: cut[i + 1]], *(bags.steps[i] + 256)]
        x = [1 / math.sqrt(max(1, bags.counts[i]))] * bags.counts[i] + [1.0] * bags.steps.shape[1]
        want = 0.3 + sum(model.w[a] * v for a, v in zip(ids, x))
        want += sum(model.v[a] @ model.v[b] * x[m] * x[n] for m, a in enumerate(ids) for n, b in enumerate(ids) if m < n)
        assert got == pytest.approx(want)


def test_licences(spark):
    plain = [(i, t) for i, t in awkward()]
    texts = {
        200: ("one two three\nLicensed under the Apache License, Version 2.0.\nmore", "Apache-2.0"),
        201: ("Released under the MIT License.", "MIT"), 202: ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"),
        203: ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        204: ("the license plate of this software van is under the seat", None), 205: (None, None),
    }
    docs = frame(spark, plain + [(i, t) for i, (t, _) in texts.items()])
    model = licenses.train(docs)
    got = {r["doc_id"]: r["paragraphs"] for r in licenses.scan(docs, model).where("doc_id >= 200").collect()}
    for i, (text, family) in texts.items():
        confirmed = [p for p in got[i] if p["confirmed"]]
        assert [p["family"] for p in confirmed] == ([family] if family else [])
        for p in confirmed:
            assert "icense" in text[p["start"]: p["end"]] and p["probability"] > 0.5
    assert licenses.scan(docs.where("false"), licenses.train(docs.where("false"))).count() == 0


# --- quotations -----------------------------------------------------------------------------------------------


def test_quotes(spark):
    rows = [
        (1, 0, "a", "Hello world\nsecond  line"), (1, 1, "b", "other talk"),
        (1, 2, "c", "On Monday a wrote:\n> hello   World\nI agree"), (1, 3, "a", "> I agree\n>> Hello world\nfine"),
        (1, 4, "d", "> never said\nodd"), (1, 4, "d", "> never said\nodd"), (2, 0, "a", "> Hello world"), (2, 1, "b", None),
        (None, 0, "a", "> x"), (3, None, "a", "x"), (1, 5, "e", "> other talk\n> second line\n> hello world"),
    ]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, thread int")
    got = {(r["conv_id"], r["turn"]): r for r in quotes.link(df, "conv_id", "turn", "text", "role").collect()}
    assert (got[1, 2]["parent"], got[1, 2]["thread"], got[1, 2]["body"]) == (0, 0, "I agree")
    assert (got[1, 3]["parent"], got[1, 3]["thread"], got[1, 3]["depth"], got[1, 3]["n_linked"]) == (2, 0, 2, 2)
    assert (got[1, 4]["parent"], got[1, 4]["thread"], got[1, 4]["n_quoted"], got[1, 4]["n_linked"]) == (None, 4, 2, 0)
    assert (got[1, 5]["parent"], got[1, 5]["body"]) == (0, "")
    assert got[2, 0]["parent"] is None and got[2, 1]["body"] == "" and got[None, 0]["thread"] == 0
    assert quotes.link(df, "conv_id", "turn").count() == len(rows)
    assert quotes.link(df.where("false"), "conv_id", "turn").count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = awkward() + [(70, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i == 5)) for i in (*range(6), 13, 21, 22, 30)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, rows[-1][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert 70 not in {r["doc_id"] for r in out}
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in out)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "encoding"]
    assert hashlib.sha256(b"").hexdigest() in {r["text_sha256"] for r in out}

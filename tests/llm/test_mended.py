"""Names that clash, very long texts, huge components, and the battery against plain computation."""

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from vecspark.llm import bpe, decontaminate, licenses, quotes, secrets, simhash, topk
from vecspark.llm.queries import vocabulary
from tests.llm.test_llm import awkward, slow_spans

#: Every name that the operators give to a column of their own.
INTERNAL = sorted({
    name for module in (decontaminate, licenses, quotes, secrets, simhash, topk)
    for name in re.findall(r"""["'`](_?[a-z][a-z0-9_]{0,12})["'`]""", open(module.__file__).read())
} - {"doc_id", "text"})


def clashing(spark, rows):
    """(doc_id, text) rows with a column of each internal name."""
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in INTERNAL)
    return spark.createDataFrame([(i, t, *range(len(INTERNAL))) for i, t in rows], schema)


def test_names_that_clash(spark):
    assert {"_k", "_bk", "_mh", "_ck", "row", "spans"} <= set(INTERNAL)
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, words), (2, words + " more and more of them"), (3, "token = abcdef12345"), (4, None), (5, words), (5, words)]
    docs = clashing(spark, rows)
    bench = spark.createDataFrame([("i", words)], "item_id string, text string")
    same = lambda df: df.columns == docs.columns and all(tuple(r)[2:] == tuple(range(len(INTERNAL))) for r in df.collect())
    kept = decontaminate.remove(docs, bench)
    assert same(kept) and sorted(r["doc_id"] for r in kept.collect()) == [3, 4]
    kept = simhash.keep_one(docs)
    assert same(kept) and 1 in {r["doc_id"] for r in kept.collect()} and kept.where("doc_id = 5").count() == 0
    masked = secrets.mask(docs)
    assert same(masked) and masked.where("text = '[SECRET]'").count() == 1
    assert licenses.scan(docs, licenses.train(docs)).count() == 6


def test_carried_names_that_clash(spark):
    names = ["thread", "parent", "depth", "body", "conv", "turn_", "c3", "t3", "root", "a.b"]
    schema = "conv_id long, turn long, text string, " + ", ".join(f"`{n}` int" for n in names)
    rows = [(1, 0, "hello there", *range(10)), (1, 1, "> hello there\nyes", *range(10)), (None, None, None, *range(10))]
    got = quotes.link(spark.createDataFrame(rows, schema), "conv_id", "turn", "text", *names)
    assert len(got.columns) == len(set(got.columns)) and {"thread_carried", "body_carried", "a.b"} <= set(got.columns)
    reply = [r for r in got.collect() if r["turn"] == 1][0]
    assert (reply["thread"], reply["parent"], reply["thread_carried"], reply["c3"]) == (0, 0, 0, 6)


def test_huge_components_saturate(spark):
    rows = [(0, [3e38, 1.0]), (100, [1.0, 2.0]), (101, [-3e38, 1.0]), (102, [1.4e6, 1.4e6]), (103, [2e38, 2e38]), (200, [1.4e6, -1.4e6])]
    got = topk.topk(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), lambda key: key % 100 == 0)
    clip = lambda x: min(max(x, -(2**63)), 2**63 - 1)
    whole = {i: [clip(math.floor(1024 * x)) for x in v] for i, v in rows}
    want = set()
    for q in (0, 100, 200):
        near = sorted((-clip(sum(a * b for a, b in zip(whole[q], v))), i) for i, v in whole.items() if i != q)
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(near)}
    assert (0, 1, 100, 2**63 - 1) in want and (0, 3, 103, 2**63 - 1) in want
    assert {tuple(r) for r in got.collect()} == want


# --- secrets --------------------------------------------------------------------------------------


def slow_free(text):
    base = [tuple(map(int, s.split(":")[1:])) for s in slow_spans(text).split(",") if s]
    spans = [m.span() for m in re.finditer(secrets.TOKEN, text or "")]
    return [(a, b) for a, b in spans if not any(x < b and a < y for x, y in base)]


def test_free_tokens_match_brute_force(spark):
    rng = random.Random(13)
    bits = ["token", "=", ":", " ", '"', "9f" * 13, "AKIA", "Q7" * 9, "é", "\n", "-", ".", "api_key", "Zq" * 8, "x" * 7, "\x01", "A" * 3, "AKIA" + "B2" * 9]
    rows = awkward() + [(100 + i, "".join(rng.choice(bits) for _ in range(60))) for i in range(400)]
    df = spark.createDataFrame([(i, t or "") for i, t in rows], "doc_id long, text string")
    has_base = F.col("text").rlike("|".join((secrets.ASSIGN, secrets.ACCESS, secrets.HEX)))
    got = df.select("text", secrets.free_tokens(F.col("text"), has_base).alias("c")).collect()
    for r in got:
        assert [(c["start"], c["end"]) for c in r["c"]] == slow_free(r["text"])
        assert all(c["token"] == r["text"][c["start"]: c["end"]] for c in r["c"])


def normal(z):
    return 0.5 * math.erfc(-z / math.sqrt(2))


def slow_battery(token):
    """(encoding, p_chi, p_runs, p_serial, p_random, p_text) by the textbook formulas."""
    encoding, _, alphabet = next(e for e in secrets.ENCODINGS if re.fullmatch(e[1], token))
    n, k = len(token), len(alphabet)
    chi2 = sum((token.count(c) - n / k) ** 2 / (n / k) for c in alphabet)
    spread = 2 / (9 * (k - 1))
    p_chi = 1 - normal(((chi2 / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
    upper = [alphabet.index(c) >= k // 2 for c in token]
    ones, zeros = sum(upper), n - sum(upper)
    runs = 1 + sum(a != b for a, b in zip(upper, upper[1:]))
    mean = 2 * ones * zeros / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    p_runs = 2 * (1 - normal(abs(runs - mean) / math.sqrt(variance))) if ones and zeros and variance > 0 else 1e-12
    places = [alphabet.index(c) for c in token]
    centre = sum(places) / n
    energy = sum((v - centre) ** 2 for v in places)
    lagged = sum((a - centre) * (b - centre) for a, b in zip(places, places[1:]))
    p_serial = 2 * (1 - normal(abs(((lagged / energy if energy else 1.0) + 1 / n) * math.sqrt(n))))
    half = -sum(math.log(max(p, 1e-12)) for p in (p_chi, p_runs, p_serial))
    extra = n * (k * (secrets.COLLISION if k > 16 else secrets.COLLISION_DIGITS) - 1)
    p_text = normal((chi2 - (k - 1) - extra) / math.sqrt(2 * (k - 1) + 4 * extra))
    return encoding, p_chi, p_runs, p_serial, math.exp(-half) * (1 + half + half * half / 2), p_text


def test_battery_matches_plain_computation(spark):
    rng = random.Random(17)
    tokens = ["".join(rng.choice(a) for _ in range(rng.randint(20, 90))) for _, _, a in secrets.ENCODINGS for _ in range(12)]
    tokens += ["a" * 30, "ab" * 20, "0123456789" * 3, "-" * 25, "the_quick_brown_fox_jumps_over"]
    rows = secrets.battery(spark.createDataFrame([(t,) for t in set(tokens)], "token string")).collect()
    for r in rows:
        want = slow_battery(r["token"])
        assert r["encoding"] == want[0]
        got = [r[c] for c in ("p_chi", "p_runs", "p_serial", "p_random", "p_text")]
        assert got == pytest.approx(want[1:], abs=3e-6, rel=1e-3)


def test_discoveries_match_plain_procedure(spark):
    """The weighted Benjamini-Hochberg bound, to the width of a bin."""
    rng = random.Random(19)
    found = [(rng.randint(20, 200), 10 ** rng.uniform(-12, 0), rng.randint(1, 4)) for _ in range(400)]
    bound, mean = secrets.discoveries(spark.createDataFrame(found, "n int, p_text double, times long"))
    power = lambda n: 1 - math.exp(-n / 32)
    total = sum(t for *_, t in found)
    assert mean == pytest.approx(sum(power(n) * t for n, _, t in found) / total)
    adjusted = sorted(p * mean / power(n) for n, p, t in found for _ in range(t))
    most = max((p for i, p in enumerate(adjusted, 1) if p * total / i <= secrets.FDR), default=0.0)
    assert most / 10 ** (1 / secrets.BINS_PER_TEN) <= bound <= most * 10 ** (1 / secrets.BINS_PER_TEN)
    assert secrets.discoveries(spark.createDataFrame([], "n int, p_text double, times long")) == (0.0, 1.0)


def test_long_text_takes_time_in_proportion(spark):
    rng = random.Random(23)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    token = lambda n: "".join(rng.choice(letters) for _ in range(n))
    spent = []
    for n in (3000, 24_000):
        text = " ".join(token(30) + (f' secret = "{token(9)}é"' if i % 3 == 0 else "") for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        secrets.mask(df).collect()  # the first is compiled
        start = time.time()
        masked = secrets.mask(df).first()["text"]
        spent.append(time.time() - start)
        spans = [(s["start"], s["end"]) for s in secrets.scan(df).first()["spans"]]
        want, at = [], 0
        for a, b in spans:
            want.append(text[at:a])
            at = b
        assert masked == "[SECRET]".join([*want, text[at:]])
        assert len(spans) >= n
    assert spent[1] < 8 * 2.5 * spent[0] + 5


def test_decoding_and_encoding_share_no_stage(spark):
    """A stage that does both holds two Python workers a task, and an executor keeps them all."""
    voc = vocabulary()
    rows = [(1, "one text"), (2, None), (None, "x" * 9), (1, "one text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = bpe.decode(bpe.encode(docs, voc), voc)
    udfs = out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")
    assert udfs == 1
    got = sorted((str(r["doc_id"]), bytes(r["decoded"]).decode()) for r in out.collect())
    assert got == sorted((str(k), t or "") for k, t in rows)

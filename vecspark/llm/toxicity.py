"""Toxicity by a linear classifier on character n-grams with naive Bayes scaling.

A feature is the presence of a hashed n-gram of bytes (A-Z lowered). Its value is the
naive Bayes log-count ratio of its document counts among toxic and other training texts;
a logistic regression learns a weight for each. N-grams whose ratio is near zero carry
nothing and are left out, which keeps the sum over a very long text from drowning the
few n-grams that matter. The model is one array of ``2 ** bits`` floats.

The training rows are a bounded, documented sample of labelled rows (``per_class`` of each
class, the first by a hash of the key), weighed by how many labelled rows of its class each
stands for. Scoring is one scan, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from vecspark.llm.common import blocks, labelled_sample, sigmoid, utf8
from vecspark.session import materialise

SIZES = (3, 4, 5)
PER_CLASS = 4000
#: Bytes of text that are hashed at a time.
BLOCK = 1 << 18


def gram_slots(texts: list[bytes], bits: int, live: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of the distinct n-grams of each text; with ``live``, only the slots it marks.

    Every text stands between spaces, so that the ends of words at its ends look like others.
    """
    found = []
    for part in blocks([len(t) for t in texts], BLOCK):
        for piece, at in _pieces(texts[part], part.start):
            lengths = np.array([len(p) for p in piece])
            data = np.frombuffer(b"".join(piece), np.uint8)
            ends = np.repeat(np.cumsum(lengths), lengths)
            owner = np.repeat(np.asarray(at), lengths)
            key = np.zeros(len(data), np.uint64)
            place = np.arange(len(data))
            for n in range(1, max(SIZES) + 1):
                shifted = np.zeros(len(data), np.uint64)
                shifted[: max(0, len(data) - n + 1)] = data[n - 1:]
                key = (key << np.uint64(8)) | shifted
                if n not in SIZES:
                    continue
                slot = (((key + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)
                keep = place + n <= ends
                if live is not None:
                    keep &= live[slot]
                found.append(np.unique((owner[keep].astype(np.int64) << bits) | slot[keep]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique(np.concatenate(found))
    return both >> bits, both & ((1 << bits) - 1)


def _pieces(texts: list[bytes], start: int):
    """Texts between spaces; one longer than a block comes in overlapping pieces."""
    if len(texts) > 1 or len(texts[0]) <= BLOCK:
        yield [b" " + t.lower() + b" " for t in texts], [start + i for i in range(len(texts))]
        return
    text = b" " + texts[0].lower() + b" "
    for at in range(0, len(text), BLOCK):
        yield [text[at: at + BLOCK + max(SIZES) - 1]], [start]


def fit_logistic(rows, slots, values, labels, weights, n_rows, size, l2=1e-3, steps=200, rate=0.1):
    """Weights and bias of a logistic regression on sparse rows, by Adam on all rows.

    ``weights`` says how many rows each row stands for.
    """
    share = weights / max(1e-12, weights.sum())
    w, bias = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, steps + 1):
        z = np.bincount(rows, weights=w[slots] * values, minlength=n_rows) + bias
        d = (sigmoid(z) - labels) * share
        g = np.bincount(slots, weights=d[rows] * values, minlength=size) + l2 * w
        gb = d.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        fix1, fix2 = 1 - 0.9**step, 1 - 0.99**step
        w -= rate * (m / fix1) / (np.sqrt(v / fix2) + 1e-8)
        bias -= rate * (mb / fix1) / (np.sqrt(vb / fix2) + 1e-8)
    return w, bias


@dataclass
class ToxicityModel:
    bits: int
    theta: np.ndarray
    bias: float

    def score(self, texts) -> np.ndarray:
        """Probability of the toxic class for each text."""
        raw = utf8(texts)
        out = np.full(len(raw), self.bias)
        rows, slots = gram_slots(raw, self.bits, self.theta != 0)
        return sigmoid(out + np.bincount(rows, weights=self.theta[slots], minlength=len(raw)))

    def column(self, text: str) -> Column:
        """The score as a column."""
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(self.score(batch))

        score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(score, DoubleType())(F.col(text))


def train(
    docs: DataFrame, labels: DataFrame, use: Column, key: str = "doc_id", text: str = "text", label: str = "toxic",
    bits: int = 20, per_class: int = PER_CLASS, least_ratio: float = 1.5, least_rows: int = 4,
) -> ToxicityModel:
    """Fit the classifier on labelled rows for which ``use`` (a column of the key) holds.

    Without a row of each class the score is the constant share of the toxic class
    (one half without any row). Null and empty texts take part as texts without n-grams.
    """
    picked = labelled_sample(docs, labels, key, label, use, per_class, text)
    sample = materialise(picked.select("_y", "_w", F.col(text).alias("_t")).repartition(8), "toxic-sample")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = {0: np.zeros(1 << bits, np.int64), 1: np.zeros(1 << bits, np.int64)}
        for batch in batches:
            for y in (0, 1):
                own = batch["_t"][batch["_y"] == y]
                texts = utf8(own)
                for part in blocks([len(t) for t in texts], BLOCK):
                    _, slots = gram_slots(texts[part], bits)
                    seen[y] += np.bincount(slots, minlength=1 << bits)
        some = np.flatnonzero(seen[0] + seen[1])
        yield pd.DataFrame({"slot": some, "n0": seen[0][some], "n1": seen[1][some]})

    counts = sample.mapInPandas(counted, "slot long, n0 long, n1 long").groupBy("slot")
    sizes = {r["_y"]: r["n"] for r in sample.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        share = n1 / (n0 + n1) if n0 + n1 else 0.5
        return ToxicityModel(bits, np.zeros(1 << bits, np.float32), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    ratio_of = F.log((F.col("n1") + 1) / F.lit(n1 + 2.0)) - F.log((F.col("n0") + 1) / F.lit(n0 + 2.0))
    table = (
        counts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(F.col("n0") + F.col("n1") >= least_rows)
        .select("slot", ratio_of.alias("r")).where(F.abs("r") >= least_ratio).toPandas()
    )  # 2 ** bits rows at most
    ratio = np.zeros(1 << bits)
    ratio[table["slot"]] = table["r"]

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        live = ratio != 0
        for batch in batches:
            rows, slots = gram_slots(utf8(batch["_t"]), bits, live)
            cut = np.searchsorted(rows, np.arange(len(batch) + 1))
            packed = [slots[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:])]
            yield pd.DataFrame({"y": batch["_y"], "w": batch["_w"], "slots": packed})

    rows = sample.mapInPandas(featured, "y int, w double, slots binary").toPandas()  # 2 * per_class rows at most
    slots = [np.frombuffer(x, "<i4") for x in rows["slots"]]
    owner = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
    slots = np.concatenate(slots).astype(np.int64)
    used, place = np.unique(slots, return_inverse=True)
    labels_of, weights = rows["y"].to_numpy(float), rows["w"].to_numpy(float)
    w, bias = fit_logistic(owner, place, ratio[slots], labels_of, weights, len(rows), len(used))
    theta = np.zeros(1 << bits, np.float32)
    theta[used] = w * ratio[used]
    return ToxicityModel(bits, theta, float(bias))


def reject(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows scored ``threshold`` or more; all columns as they were."""
    return docs.where(model.column(text) < threshold)

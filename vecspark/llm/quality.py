"""Quality by a factorisation machine over hashed words, structure and metadata.

A text is a bag of features i with values x: every word occurrence (hashed, 1 / sqrt(words)),
statistics of the text's structure in steps (shares of upper case, digits, symbols and
repeated words and lines, lengths), and its metadata (the stated length, in steps and against the
real one). The score is

    sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)),

so all pairs of features interact through vectors of ``rank`` numbers at linear cost.

Trained by Adam on a bounded, documented sample of labelled rows (``per_class`` of each
class), weighed by how many labelled rows of its class each stands for. The model is an array of (2 ** bits + steps) x (rank + 1) floats. Scoring is one scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from vecspark.llm.common import blocks, labelled_sample, polynomial_hashes, sigmoid, spans, utf8
from vecspark.session import materialise

PER_CLASS = 4000
BLOCK = 1 << 20
#: Steps into which each statistic is cut.
STEPS = 16
STATISTICS = (
    "upper", "digit", "symbol", "space", "other", "repeated_words", "repeated_lines", "word_length", "words", "lines",
    "stated_length", "length_gap",
)
_KIND = np.zeros(256, np.uint8)  # 0 other letters, 1 upper, 2 digit, 3 symbol, 4 space
_KIND[65:91], _KIND[48:58] = 1, 2
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 4


@dataclass
class Bags:
    """Word slots of all texts one after another, the number of words of each, and its steps."""

    slots: np.ndarray
    counts: np.ndarray
    steps: np.ndarray


def _repeated(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """For each owner, how many of its hashes have occurred in it before."""
    order = np.lexsort((hashes, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    return np.bincount(owner[order][1:][same], minlength=n)


def featurise(texts: list[bytes], stated: np.ndarray, bits: int) -> Bags:
    """Features of texts; ``stated`` is their length by metadata (NaN where unknown)."""
    slots, counts, steps = [], [], []
    for part in blocks([len(t) for t in texts], BLOCK):
        own = texts[part]
        n = len(own)
        sizes = np.array([len(t) for t in own])
        data = np.frombuffer(b"\n".join(own) + b"\n", np.uint8)
        ends_at = np.cumsum(sizes + 1)
        kind = _KIND[data]
        starts, ends = spans(kind != 4)
        owner = np.searchsorted(ends_at, starts, side="right")
        words = np.bincount(owner, minlength=n)
        hashes = polynomial_hashes(data, starts, ends)
        line_starts, line_ends = spans(data != 10)
        line_owner = np.searchsorted(ends_at, line_starts, side="right")
        lines = np.bincount(line_owner, minlength=n)
        line_hashes = polynomial_hashes(data, line_starts, line_ends)
        byte_owner = np.repeat(np.arange(n), sizes + 1)
        of = lambda k: np.bincount(byte_owner[kind == k], minlength=n)
        size = np.maximum(1, sizes)
        chars = np.bincount(byte_owner, weights=(data & 0xC0) != 0x80, minlength=n) - 1
        told = stated[part]
        gap = np.abs(told - chars) / np.maximum(1, chars)
        share = lambda x: np.sqrt(np.clip(x, 0, 1)) * (STEPS - 1)
        grown = lambda x: np.log2(1 + np.maximum(0, x))
        columns = [
            share(of(1) / size), share(of(2) / size), share(of(3) / size), share(of(4) / size),
            share(np.bincount(byte_owner[data >= 128], minlength=n) / size),
            share(_repeated(owner, hashes, n) / np.maximum(1, words)),
            share(_repeated(line_owner, line_hashes, n) / np.maximum(1, lines)),
            sizes / np.maximum(1, words), grown(words), grown(lines), grown(np.nan_to_num(told, nan=-1)), share(np.nan_to_num(gap, nan=1)),
        ]
        table = np.stack([np.clip(np.floor(c), 0, STEPS - 1) for c in columns], axis=1).astype(np.int64)
        slots.append((hashes >> np.uint64(64 - bits)).astype(np.int64))
        counts.append(words)
        steps.append(table + np.arange(len(STATISTICS)) * STEPS)
    if not counts:
        return Bags(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(STATISTICS)), np.int64))
    return Bags(np.concatenate(slots), np.concatenate(counts), np.concatenate(steps))


@dataclass
class QualityModel:
    bits: int
    w0: float
    w: np.ndarray
    v: np.ndarray

    def raw(self, bags: Bags) -> np.ndarray:
        n = len(bags.counts)
        value = 1 / np.sqrt(np.maximum(1, bags.counts))
        owner = np.repeat(np.arange(n), bags.counts)
        steps = bags.steps + (1 << self.bits)
        out = self.w0 + self.w[steps].sum(axis=1)
        out += np.bincount(owner, weights=self.w[bags.slots], minlength=n) * value
        for f in range(self.v.shape[1]):
            v = self.v[:, f]
            of_words, of_steps = v[bags.slots], v[steps]
            total = np.bincount(owner, weights=of_words, minlength=n) * value + of_steps.sum(axis=1)
            squares = np.bincount(owner, weights=of_words**2, minlength=n) * value**2 + (of_steps**2).sum(axis=1)
            out += 0.5 * (total**2 - squares)
        return out

    def column(self, text: str, stated: str | None) -> Column:
        """The score as a column of the text and the stated length (null for none)."""

        def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for texts, told in batches:
                raw = utf8(texts)
                told = told.to_numpy(float, na_value=np.nan)
                out = np.zeros(len(raw))
                for part in blocks([len(t) for t in raw], 4 * BLOCK):
                    out[part] = sigmoid(self.raw(featurise(raw[part], told[part], self.bits)))
                yield pd.Series(out)

        score.__annotations__ = {
            "batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]
        }
        given = F.lit(None).cast("double") if stated is None else F.col(stated).cast("double")
        return F.pandas_udf(score, DoubleType())(F.col(text), given)


def fit(
    bags: Bags, labels: np.ndarray, weights: np.ndarray, bits: int, rank: int, passes: int, l2: float, rate: float,
) -> QualityModel:
    """Adam over batches of rows; gradients of the pairs come from the same linear-time sums.

    ``weights`` says how many rows each row stands for."""
    weights = weights / max(1e-12, weights.mean()) if len(weights) else weights
    rng = np.random.default_rng(7)
    size = (1 << bits) + bags.steps.shape[1] * STEPS
    p = np.concatenate((np.zeros((size, 1)), rng.normal(0, 0.02, (size, rank))), axis=1)  # w and v side by side
    m, s, w0, step = np.zeros_like(p), np.zeros_like(p), 0.0, 0
    value = 1 / np.sqrt(np.maximum(1, bags.counts))
    cut = np.concatenate(([0], np.cumsum(bags.counts)))
    for _ in range(passes if len(labels) else 0):
        for rows in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // 256)):
            step += 1
            counts = bags.counts[rows]
            slots = np.concatenate([bags.slots[cut[r]: cut[r + 1]] for r in rows])
            ids = np.concatenate((slots, (bags.steps[rows] + (1 << bits)).ravel()))
            owner = np.concatenate((np.repeat(np.arange(len(rows)), counts), np.repeat(np.arange(len(rows)), bags.steps.shape[1])))
            x = np.concatenate((np.repeat(value[rows], counts), np.ones(len(rows) * bags.steps.shape[1])))
            used, place = np.unique(ids, return_inverse=True)
            q = p[used]
            part = q[place] * x[:, None]
            sums = np.stack([np.bincount(owner, weights=part[:, f], minlength=len(rows)) for f in range(rank + 1)], axis=1)
            squares = np.bincount(owner, weights=(part[:, 1:] ** 2).sum(axis=1), minlength=len(rows))
            z = w0 + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - squares)
            d = (sigmoid(z) - labels[rows]) * weights[rows] / len(rows)
            each = np.empty_like(part)
            each[:, 0] = d[owner] * x
            each[:, 1:] = (d[owner] * x)[:, None] * (sums[owner, 1:] - part[:, 1:])
            g = np.stack([np.bincount(place, weights=each[:, f], minlength=len(used)) for f in range(rank + 1)], axis=1)
            g += l2 * q
            m[used] = 0.9 * m[used] + 0.1 * g
            s[used] = 0.99 * s[used] + 0.01 * g * g
            p[used] -= rate * (m[used] / (1 - 0.9**step)) / (np.sqrt(s[used] / (1 - 0.99**step)) + 1e-8)
            w0 -= rate * d.sum()
    return QualityModel(bits, float(w0), p[:, 0].astype(np.float32), p[:, 1:].astype(np.float32))


def train(
    docs: DataFrame, labels: DataFrame, use: Column, key: str = "doc_id", text: str = "text",
    stated: str | None = "n_chars", label: str = "quality", bits: int = 16, rank: int = 4,
    per_class: int = PER_CLASS, passes: int = 6, l2: float = 1e-4, rate: float = 0.02,
) -> QualityModel:
    """Fit the machine on labelled rows for which ``use`` (a column of the key) holds.

    Null and empty texts take part with their steps alone. With one class only the score
    is nearly constant, with no row one half.
    """
    told = F.lit(None).cast("double") if stated is None else F.col(stated).cast("double")
    rows = docs.select(key, text, told.alias("_told"))
    picked = labelled_sample(rows, labels, key, label, use, per_class, text, "_told")
    sample = materialise(
        picked.select("_y", "_w", F.col(text).alias("_t"), "_told", F.xxhash64("_dk").alias("_o")).repartition(8), "quality-sample"
    )

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bags = featurise(utf8(batch["_t"]), batch["_told"].to_numpy(float, na_value=np.nan), bits)
            cut = np.concatenate(([0], np.cumsum(bags.counts)))
            yield pd.DataFrame({
                "o": batch["_o"], "y": batch["_y"], "w": batch["_w"],
                "slots": [bags.slots[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:])],
                "steps": [row.astype("<i4").tobytes() for row in bags.steps],
            })

    # 2 * per_class rows at most, four bytes a word. In one order, so that training repeats.
    table = sample.mapInPandas(featured, "o long, y int, w double, slots binary, steps binary").toPandas().sort_values("o")
    slots = [np.frombuffer(x, "<i4") for x in table["slots"]]
    bags = Bags(
        np.concatenate([np.zeros(0, np.int64), *slots]).astype(np.int64), np.array([len(x) for x in slots], np.int64),
        np.array([np.frombuffer(x, "<i4") for x in table["steps"]], np.int64).reshape(-1, len(STATISTICS)),
    )
    return fit(bags, table["y"].to_numpy(float), table["w"].to_numpy(float), bits, rank, passes, l2, rate)

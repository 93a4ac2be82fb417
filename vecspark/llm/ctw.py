"""Language-model scores by context-tree weighting over bytes.

A text (A-Z lowered) is its bytes and an end mark, after ``depth`` start marks (both 0xFF,
which no UTF-8 text holds). Each byte is eight binary choices; every place in that binary
tree has a context tree of its own over the ``depth`` bytes before. A node s with counts a
of 0 and b of 1 estimates by Krichevsky and Trofimov, (count + 1/2) / (a + b + 1), and

    Pw(s) = 1/2 Pe(s) + 1/2 prod_c Pw(cs),      Pw(s) = Pe(s) at full depth.

What the training texts have taught is the weight of "stop here" in each node,
w(s) = 1/2 Pe(s) / Pw(s); the probability of a choice mixes the estimates of all depths,
P(s) = w(s) KT(s) + (1 - w(s)) P(cs), where a child that was never seen predicts as its
parent does. The tree stays as trained, so the code length of a byte depends on it and the
``depth`` bytes before only - on one gram of depth + 1 bytes.

As jobs: (1) blocks of documents, as they are scanned, are packed and reduced to their distinct grams; counts over all
training texts are a shuffle of those. (2) The nodes below the two last bytes of a context
form a group of grams; one pass over the groups gives each such root's weighted
probability, the two depths above it (256 x 255 nodes at most) are combined from these, and a
second pass gives each gram its code length. (3) The code lengths are joined to the distinct
grams of each block - never to each place of each text - and meet the block's texts again
for the sums. Nothing is broadcast but the two top depths.

The word unigram model that scores are compared with travels along: words are keys as grams
are, by a 63-bit hash with the sign bit set, which no gram has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from vecspark.llm.common import blocks, polynomial_hashes, spans, utf8
from vecspark.session import materialise, scratch_path

DEPTH = 5
MARK = 0xFF
#: Key of the end of a text as a word; an empty span of bytes is no word.
END = 0
#: Bytes of text after which a block of documents is full, and that are turned into grams at a time.
BLOCK, PART = 32 << 20, 1 << 19
#: log Gamma(n + 1/2) and log n! come from a table up to here, beyond it from Stirling's series.
_TABLE = 4096
_HALVES = np.concatenate(([0.5 * np.log(np.pi)], 0.5 * np.log(np.pi) + np.cumsum(np.log(np.arange(_TABLE) + 0.5))))
_WHOLES = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, _TABLE + 1)))))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def kt_log(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    n = a + b

    def half(x):
        return np.where(x <= _TABLE, _HALVES[np.minimum(x, _TABLE)], _log_gamma(x + 0.5))

    whole = np.where(n <= _TABLE, _WHOLES[np.minimum(n, _TABLE)], _log_gamma(n + 1.0))
    return half(a) + half(b) - np.log(np.pi) - whole


def grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, gram) for every place of each text, its end included; a gram is the place's byte
    after the ``depth`` before it, as one number."""
    lead = bytes([MARK]) * depth
    data = np.frombuffer(b"".join(lead + t + bytes([MARK]) for t in texts), np.uint8).astype(np.uint64)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    key = np.zeros(max(0, len(data) - depth), np.uint64)
    for i in range(depth + 1):
        key = (key << np.uint64(8)) | data[i: i + len(key)]
    owner = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(lengths.sum()) + owner * depth
    return owner, key[place].view(np.int64)


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, key) for every word of each text and its end."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends_at = np.cumsum([len(t) + 1 for t in texts])
    starts, ends = spans((data != 32) & ((data < 9) | (data > 13)))
    keys = polynomial_hashes(data, starts, ends)
    for i in np.flatnonzero(ends - starts > 48).tolist():
        keys[i] = xxhash.xxh3_64_intdigest(data[starts[i]: ends[i]])
    keys = np.concatenate((keys, np.full(len(texts), END, np.uint64))) | np.uint64(1 << 63)
    owner = np.concatenate((np.searchsorted(ends_at, starts, side="right"), np.arange(len(texts))))
    return owner, keys.view(np.int64)


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, the place of each key among them, and sums of values by key."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, place, *[np.bincount(place, weights=v, minlength=len(distinct)) for v in values]


def _levels(gram: np.ndarray, count: np.ndarray, depth: int, split: int) -> list[dict]:
    """Nodes of a group of grams by depth, deepest first: key (context and place), a, b, log Pe,
    log Pw. Keys of depth d are (the last d bytes of the context) * 256 + place (1 to 255)."""
    byte, context = gram & 0xFF, gram >> 8
    keys, bits, weights = [], [], []
    for k in range(8):
        place = (1 << k) | (byte >> (8 - k))
        keys.append((context << 8) | place)
        bits.append((byte >> (7 - k)) & 1)
        weights.append(count)
    key, bit, n = np.concatenate(keys), np.concatenate(bits), np.concatenate(weights)
    key, _, a, b = _sums(key, n * (1 - bit), n * bit)
    out, below = [], None
    for d in range(depth, split - 1, -1):
        if d < depth:
            shorter = (((key >> 8) & ((1 << (8 * d)) - 1)) << 8) | (key & 0xFF)
            key, _, a, b, below = _sums(shorter, a, b, weighted)
        a, b = a.astype(np.int64), b.astype(np.int64)
        estimate = kt_log(a, b)
        weighted = estimate if below is None else np.log(0.5) + np.logaddexp(estimate, below)
        out.append({"depth": d, "key": key, "a": a, "b": b, "pe": estimate, "pw": weighted})
    return out


def _stop(pe: np.ndarray, pw: np.ndarray) -> np.ndarray:
    return np.minimum(1.0, np.exp(np.log(0.5) + pe - pw))


def _log2(gram: np.ndarray, levels: list[dict], top: np.ndarray, depth: int) -> np.ndarray:
    """log2 of the probability of each gram's last byte. ``top`` [last byte, place, (w1, kt1)] and
    [256, place] for depth 0; levels reach from full depth to depth 2."""
    byte, context = gram & 0xFF, gram >> 8
    last = context & 0xFF
    total = np.zeros(len(gram))
    for k in range(8):
        place = (1 << k) | (byte >> (8 - k))
        bit = (byte >> (7 - k)) & 1
        # Weights and estimates of the chosen bit, shallow to deep; the chain ends at the first unseen node.
        left = np.ones(len(gram))
        p = np.zeros(len(gram))
        estimate = np.full(len(gram), 0.5)
        open_ = np.ones(len(gram), bool)
        for d in range(depth + 1):
            if d < 2:
                row = top[256 if d == 0 else last, place]
                stop, one, seen = row[:, 0], row[:, 1], row[:, 2] > 0
            else:
                level = levels[depth - d]
                want = ((context & ((1 << (8 * d)) - 1)) << 8) | place
                at = np.minimum(np.searchsorted(level["key"], want), max(0, len(level["key"]) - 1))
                seen = level["key"][at] == want if len(level["key"]) else np.zeros(len(gram), bool)
                a, b = (level["a"][at], level["b"][at]) if len(level["key"]) else (0, 0)
                one = (b + 0.5) / (a + b + 1.0)
                stop = np.ones(len(gram)) if d == depth else _stop(level["pe"][at], level["pw"][at]) if len(level["key"]) else 0
            open_ &= seen
            mine = np.where(bit == 1, one, 1 - one)
            estimate = np.where(open_, mine, estimate)
            p += np.where(open_, left * stop * mine, 0.0)
            left = np.where(open_, left * (1 - stop), left)
        total += np.log2(p + left * estimate)
    return total


def code_lengths(counts: DataFrame, depth: int) -> DataFrame:
    """Columns gram, bits: log2 of the probability of each gram of ``counts`` (gram, n), where n
    is how often it occurs in training texts (0 for grams that are only asked for)."""
    group = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF).cast("long")).alias("g")
    counts = counts.withColumn("g", group)

    def roots(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[rows["n"] > 0]
        top = _levels(rows["gram"].to_numpy(), rows["n"].to_numpy(float), depth, 2)[-1]
        return pd.DataFrame({"key": top["key"], "a": top["a"], "b": top["b"], "pw": top["pw"]})

    shape = "key long, a long, b long, pw double"
    second = counts.where("n > 0").groupBy("g").applyInPandas(roots, shape)
    key = F.shiftleft(F.shiftright("key", 8).bitwiseAND(F.lit(0xFF).cast("long")), 8) + F.col("key").bitwiseAND(F.lit(0xFF).cast("long"))
    first = second.groupBy(key.alias("key")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("pw").alias("below"))
    first = first.toPandas().sort_values("key")  # 256 * 255 rows at most
    top = np.zeros((257, 256, 3))
    if len(first):
        key, a, b = (first[c].to_numpy(np.int64) for c in ("key", "a", "b"))
        pe = kt_log(a, b)
        pw = np.log(0.5) + np.logaddexp(pe, first["below"].to_numpy())
        top[key >> 8, key & 0xFF] = np.stack([_stop(pe, pw), (b + 0.5) / (a + b + 1.0), np.ones(len(key))], axis=1)
        key, _, a, b, below = _sums(key & 0xFF, a, b, pw)
        pe = kt_log(a.astype(np.int64), b.astype(np.int64))
        pw = np.log(0.5) + np.logaddexp(pe, below)
        top[256, key] = np.stack([_stop(pe, pw), (b + 0.5) / (a + b + 1.0), np.ones(len(key))], axis=1)

    def lengths(rows: pd.DataFrame) -> pd.DataFrame:
        gram, n = rows["gram"].to_numpy(), rows["n"].to_numpy(float)
        seen = n > 0
        levels = _levels(gram[seen], n[seen], depth, 2)
        return pd.DataFrame({"gram": gram, "bits": _log2(gram, levels, top, depth)})

    return counts.groupBy("g").applyInPandas(lengths, "gram long, bits double")


def score(
    docs: DataFrame, use: Column, key: str = "doc_id", text: str = "text", depth: int = DEPTH, block: int = BLOCK,
) -> DataFrame:
    """One row per document: key, learned (``use``), bits (code length of the text and its end),
    base_score (log10 probability of its words and end by the smoothed unigram model), n_tokens,
    n_known (tokens that training texts hold) and train_tokens.

    The tree is trained on the rows for which ``use`` (a column of the input) holds. Null
    texts are empty; repeated rows count and are scored each. Without training texts every
    bit costs one.
    """
    if not 2 <= depth <= 6:
        raise ValueError("depth is 2 to 6")
    rows = docs.select(
        F.col(key).cast("string").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"),
        F.coalesce(use, F.lit(False)).alias("_use"),
    )  # as text, because pandas would turn whole numbers beside nulls into floats

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Consecutive rows as blocks: a row with the packed texts, and a row for each distinct key."""
        task, number = TaskContext.get().partitionId(), 0
        ids, use_of, texts, keys, size = [], [], [], [], 0

        def emit():
            data = b"".join(texts)
            yield pd.DataFrame({
                "b": [(task << 24) + number], "ids": [list(ids)], "use": [np.array(use_of, bool)],
                "sizes": [np.array([len(t) for t in texts], np.int64)], "texts": [pa.compress(data, "zstd", asbytes=True)],
                "gram": pd.array([None], "Int64"), "n": pd.array([None], "Int64"),
            })
            gram, n = _merge(keys)
            for at in range(0, len(gram), 1 << 17):
                part = slice(at, at + (1 << 17))
                yield pd.DataFrame({
                    "b": (task << 24) + number, "ids": None, "use": None, "sizes": None, "texts": None,
                    "gram": gram[part], "n": n[part],
                })

        for batch in batches:
            own_ids = [None if pd.isna(i) else i for i in batch["_id"]]
            own, learned = [t.lower() for t in utf8(batch["_t"])], batch["_use"].to_numpy(bool)
            for part in blocks([len(t) for t in own], PART):
                mine = learned[part].astype(np.int64)
                keys.append(_merge([(k, mine[o]) for o, k in (grams(own[part], depth), words(own[part]))]))
                if len(keys) >= 8:
                    keys = [_merge(keys)]
                ids += own_ids[part]
                use_of += learned[part].tolist()
                texts += own[part]
                size += sum(map(len, own[part]))
                if size >= block:
                    yield from emit()
                    ids, use_of, texts, keys, size, number = [], [], [], [], 0, number + 1
        if ids:
            yield from emit()

    shape = "b long, ids array<string>, use array<boolean>, sizes array<long>, texts binary, gram long, n long"
    path = scratch_path(docs.sparkSession, "ctw-blocks")
    rows.mapInPandas(packed, shape).write.option("compression", "zstd").parquet(path)
    both = docs.sparkSession.read.schema(shape).parquet(path)
    packs = both.where("texts IS NOT NULL").select("b", "ids", "use", "sizes", "texts")
    wanted = both.where("gram IS NOT NULL").select("b", "gram", "n")
    counts = materialise(wanted.groupBy("gram").agg(F.sum("n").alias("n")), "ctw-counts")
    known = code_lengths(counts.where("gram >= 0"), depth).select("gram", F.col("bits").alias("price"))
    told = counts.where("gram < 0")
    tokens, kinds = told.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    # Without training texts N and V are 0.
    base = told.select("gram", F.log10((F.col("n") + 1.0) / (tokens + kinds + 1.0)).alias("price"))
    least_known = math.log10(1.5 / (tokens + kinds + 1.0))  # between a count of 0 and of 1
    priced = wanted.select("b", "gram").join(materialise(known.unionByName(base), "ctw-prices"), "gram")

    def summed(packs: pd.DataFrame, prices: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(prices["gram"].to_numpy())
        gram, price = prices["gram"].to_numpy()[order], prices["price"].to_numpy()[order]
        pack = packs.iloc[0]
        sizes = np.asarray(pack["sizes"], np.int64)
        data = pa.decompress(pack["texts"], int(sizes.sum()), "zstd", asbytes=True)
        cut = np.concatenate(([0], np.cumsum(sizes)))
        out = np.zeros((4, len(sizes)))
        for part in blocks(sizes.tolist(), PART):
            n = part.stop - part.start
            raw = [data[a:b] for a, b in zip(cut[part], cut[part.start + 1: part.stop + 1])]
            owner, own = grams(raw, depth)
            out[0, part] = np.bincount(owner, weights=_looked_up(gram, price, own), minlength=n)
            owner, own = words(raw)
            paid = _looked_up(gram, price, own)
            out[1, part] = np.bincount(owner, weights=paid, minlength=n)
            out[2, part] = np.bincount(owner, minlength=n)
            out[3, part] = np.bincount(owner, weights=paid > least_known, minlength=n)
        return pd.DataFrame({
            "_id": pd.Series(list(pack["ids"]), dtype=object), "learned": np.asarray(pack["use"], bool), "bits": -out[0],
            "base_score": out[1], "n_tokens": out[2].astype(np.int64), "n_known": out[3].astype(np.int64), "train_tokens": tokens,
        })

    merged = packs.groupBy("b").cogroup(priced.select(F.col("b").alias("pb"), "gram", "price").groupBy("pb"))
    result = "_id string, learned boolean, bits double, base_score double, n_tokens long, n_known long, train_tokens long"
    scored = merged.applyInPandas(summed, result)
    return scored.withColumn("_id", F.col("_id").cast(docs.schema[key].dataType)).withColumnRenamed("_id", key)


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted key. ``keys`` is sorted and holds all of them; asking in order
    keeps the search within the cache."""
    order = np.argsort(wanted)
    out = np.empty(len(wanted))
    out[order] = values[np.searchsorted(keys, wanted[order])]
    return out


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram = np.concatenate([p[0] for p in parts])
    order = np.argsort(gram)
    gram = gram[order]
    first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
    return gram[first], np.add.reduceat(np.concatenate([p[1] for p in parts])[order], first)

"""Byte-level BPE encoding and decoding with overlapping chunks.

A text up to ``CHUNK`` code points is encoded as it is. A longer one is cut into chunks that
overlap by ``OVERLAP``; the chunks are dealt over the cluster and split into pre-tokens in
parallel, each from its own start. A chunk that starts inside a pre-token is wrong at first,
but the pattern looks at what follows only, so from the first boundary that two neighbours
share they agree. There they are stitched: each chunk's piece runs from the boundary shared
with the chunk before to that shared with the chunk after. Pieces are encoded one by one,
and the ids are joined in order. A text whose neighbours share no boundary (one pre-token
longer than the overlap) is encoded whole.

Shared boundaries follow a character that is not white space, because the pattern looks one
character past white space, and lie ``MARGIN`` before a chunk's end.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from vecspark.session import materialise

CHUNK, OVERLAP, MARGIN = 1 << 16, 1 << 10, 16


class Vocabulary:
    """Ranks and pattern of a byte-level BPE; ``ranks_file`` holds base64 bytes and ids by line.

    The file's content (about a megabyte) travels with the tasks, so executors need no path.
    """

    def __init__(self, ranks_file: str, pattern: str):
        with open(ranks_file, "rb") as f:
            self.content = f.read()
        self.pattern = pattern

    def encoding(self) -> tiktoken.Encoding:
        return _encoding(self.content, self.pattern)

    def bytes_of(self) -> list[bytes]:
        return _bytes_of(self.content)


@lru_cache(maxsize=4)
def _ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}


@lru_cache(maxsize=4)
def _encoding(content: bytes, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_ranks(content), special_tokens={})


@lru_cache(maxsize=4)
def _bytes_of(content: bytes) -> list[bytes]:
    ranks = _ranks(content)
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        out[rank] = piece
    return out


def boundaries(text: str, pattern: str, high: int) -> list[int]:
    """Ends of the pre-tokens of ``text`` below ``high`` that follow no white space."""
    ends = (match.end() for match in regex.finditer(pattern, text))
    return [e for e in ends if e < high and not text[e - 1].isspace()]


def _packed(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def encode(
    docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text", chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per document: key and ids (binary, little-endian unsigned 32-bit integers).

    Null texts are empty and give no ids; repeated rows are encoded each. Rows with long
    texts are numbered and written first, so that neither key nor text must be unique.
    """
    content, pattern = vocabulary.content, vocabulary.pattern
    rows = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    short, long = rows.where(F.length("_t") <= chunk), rows.where(F.length("_t") > chunk)

    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoding(content, pattern)
        for batch in batches:
            yield pd.Series([_packed(enc.encode_ordinary(t)) for t in batch], dtype=object)

    whole.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    in_one = F.pandas_udf(whole, "binary")
    done = short.select("_id", in_one("_t").alias("ids"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, body in zip(batch["_rid"], batch["_t"]):
                for c, start in enumerate(range(0, len(body), chunk)):
                    yield pd.DataFrame({"_rid": [number], "c": [c], "part": [body[start: start + chunk + overlap]]})

    def pre_tokenised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left, right = [], []
            for part in batch["part"]:
                # A part that is shorter than a chunk and its overlap reaches the end of the text.
                high = len(part) + 1 if len(part) < chunk + overlap else len(part) - MARGIN
                ends = boundaries(part, pattern, high)
                left.append([0] + [e for e in ends if e < overlap])
                right.append([e - chunk for e in ends if e >= chunk])
            yield batch.assign(left=left, right=right)

    long = materialise(long.select(F.monotonically_increasing_id().alias("_rid"), "_id", "_t"), "bpe-long")
    parts = long.select("_rid", "_t").mapInPandas(cut, "_rid long, c int, part string")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.repartition(n, "_rid", "c").mapInPandas(
        pre_tokenised, "_rid long, c int, part string, left array<int>, right array<int>"
    )
    parts = materialise(parts, "bpe-chunks")
    # Neighbours exchange their boundaries, not their texts.
    before = parts.select("_rid", (F.col("c") + 1).alias("c"), F.col("right").alias("theirs"))
    stitch = parts.select("_rid", "c", "left").join(before, ["_rid", "c"], "left").select(
        "_rid", "c", F.array_min(F.array_intersect("left", "theirs")).alias("begin")
    )
    stitch = materialise(stitch, "bpe-stitches")
    following = stitch.select("_rid", (F.col("c") - 1).alias("c"), F.col("begin").alias("until"))
    broken = stitch.where("c > 0 AND begin IS NULL").select("_rid").distinct()
    pieces = parts.select("_rid", "c", "part").join(broken, "_rid", "left_anti")
    pieces = pieces.join(stitch, ["_rid", "c"]).join(following, ["_rid", "c"], "left")

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoding(content, pattern)
        for batch in batches:
            out = []
            for part, begin, until in zip(batch["part"], batch["begin"], batch["until"]):
                a = 0 if pd.isna(begin) else int(begin)
                b = len(part) if pd.isna(until) else chunk + int(until)
                out.append(_packed(enc.encode_ordinary(part[a:b])))
            yield pd.DataFrame({"_rid": batch["_rid"], "c": batch["c"], "ids": out})

    encoded_parts = pieces.select("_rid", "c", "part", "begin", "until").mapInPandas(
        encoded, "_rid long, c int, ids binary"
    )
    # As much as the document's own text, one row in any case.
    joined = encoded_parts.groupBy("_rid").agg(F.sort_array(F.collect_list(F.struct("c", "ids"))).alias("p"))
    hexed = F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), ""))
    stitched = long.select("_rid", "_id").join(joined, "_rid").select("_id", hexed.alias("ids"))
    rest = long.join(broken, "_rid").select("_id", in_one("_t").alias("ids"))
    return done.unionByName(stitched).unionByName(rest).withColumnRenamed("_id", key)


def decode_bytes(ids: bytes, pieces: list[bytes]) -> bytes:
    """The bytes of packed ids: their pieces, joined."""
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the binary column ``out``: the bytes that the ids stand for (null for null).

    The ids are written first. In one stage with the encoding, each task would hold two Python workers at
    a time, and idle workers stay, so that an executor would keep twice as many from then on.
    """
    encoded, content = materialise(encoded, "bpe-ids"), vocabulary.content

    def joined(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = _bytes_of(content)
        for batch in batches:
            yield pd.Series([None if x is None else decode_bytes(x, pieces) for x in batch])

    joined.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return encoded.withColumn(out, F.pandas_udf(joined, "binary")(F.col(ids)))


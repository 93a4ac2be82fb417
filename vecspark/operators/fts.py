"""Full-text search: postings, match filters and BM25 ranking."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vecspark.functions import text as tx
from vecspark.operators import impact
from vecspark.operators.read import filtered
from vecspark.operators.sparse import of_terms, write_postings
from vecspark.session import materialise
from vecspark.sources.tables import ConcurrentChange, _Files

# Segments an index may have, and the share of its documents that may be marked as gone, before it is folded.
FOLD_SEGMENTS, FOLD_GONE = 8, 0.2

def document_tokens(columns: str | Sequence[str], parser: str = "space") -> Column:
    """Tokens of one column, or of several columns one after another."""
    names = [columns] if isinstance(columns, str) else list(columns)
    if not names:
        raise ValueError("a text index needs at least one column")
    empty = F.array().cast("array<string>")
    arrays = [F.coalesce(tx.tokens(c, parser), empty) for c in names]
    return arrays[0] if len(arrays) == 1 else F.concat(*arrays)


def postings(df: DataFrame, columns: str | Sequence[str], primary_key: str, parser: str = "space") -> DataFrame:
    """One row per (term, document): ``(term, <key>, tf, doc_len)``.

    A document is one row, so its terms are counted inside the row, as runs of equal
    values in its sorted tokens. No shuffle, and nothing depends on how often a term
    occurs elsewhere. Tokens are letters and digits only, so they are joined by spaces and a run is
    one match of a pattern; a lambda on every token takes several times as long.
    """
    tokens = df.select(primary_key, F.sort_array(document_tokens(columns, parser)).alias("tokens"))
    runs = F.regexp_extract_all(F.array_join("tokens", " "), F.lit(tx.RUN), F.lit(0))
    rows = tokens.select(primary_key, F.size("tokens").alias("doc_len"), F.explode(runs).alias("run"))
    term = F.substring_index("run", " ", 1)
    tf = (F.octet_length("run") + 1) / (F.octet_length(term) + 1)  # without a rest
    return rows.select(term.alias("term"), primary_key, tf.cast("bigint").alias("tf"), "doc_len")


def document_frequency(term_postings: DataFrame) -> DataFrame:
    return term_postings.groupBy("term").agg(F.count("*").alias("doc_freq"), F.sum("tf").alias("term_count"))


def match_filter(df: DataFrame, query: str, *columns: str, parser: str = "space", where=None) -> DataFrame:
    """Rows in which some query word occurs, that also pass ``where``."""
    return filtered(df.where(tx.match_any(query, *columns, parser=parser)), where)


@dataclass(frozen=True)
class TextIndex:
    """Postings of one or more columns on disk, with the corpus totals.

    The postings lie in segments that are never rewritten. New rows come as a further segment; rows that
    go or change are named in a set of (key, last segment that holds them), which reads leave out. Once there are many
    of either they are folded into one segment, from the postings alone. A change is a
    numbered file of the index's own log, which one writer can create.
    """

    spark: SparkSession
    path: str
    columns: tuple[str, ...]
    parser: str
    primary_key: str
    key_type: str
    n_docs: int = 0
    n_tokens: int = 0
    segments: tuple[int, ...] = ()
    gone: tuple[str, ...] = ()
    n_gone: int = 0
    number: int = 0

    @property
    def avg_len(self) -> float:
        return self.n_tokens / self.n_docs if self.n_docs else 0.0

    @classmethod
    def build(cls, df: DataFrame, columns, primary_key: str, path: str, parser: str = "space") -> TextIndex:
        """Write the postings as the first segment."""
        names = (columns,) if isinstance(columns, str) else tuple(columns)
        kind = df.schema[primary_key].dataType.simpleString()
        return cls(df.sparkSession, path, names, tx.parser_name(parser), primary_key, kind).append(df)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextIndex:
        files = _Files(spark, path)
        last = max(int(n[:10]) for n in files.names(f"{path}/_meta") if n.endswith(".json"))
        meta = json.loads(files.read(f"{path}/_meta/{last:010d}.json"))
        lists = {k: tuple(meta[k]) for k in ("columns", "segments", "gone")}
        return cls(spark, path, **{**meta, **lists, "number": last})

    def _publish(self, changed: TextIndex) -> TextIndex:
        meta = {k: v for k, v in vars(changed).items() if k not in ("spark", "path", "number")}
        if not _Files(self.spark, self.path).publish(f"{self.path}/_meta/{self.number + 1:010d}.json", json.dumps(meta)):
            raise ConcurrentChange(f"{self.path} was changed by another writer after change {self.number}")
        return replace(changed, number=self.number + 1)

    # --- what is stored ----------------------------------------------------------------------

    def _stored(self, kind: str) -> DataFrame:
        """``postings`` or ``docs`` of all segments, without what is gone."""
        root, key = f"{self.path}/{kind}", f"`{self.primary_key}` {self.key_type}"
        schema = {
            "postings": f"term string, {key}, tf bigint, doc_len int, tier int, bucket int, segment int",
            "docs": f"{key}, row_hash bigint, doc_len bigint, segment int",
        }
        reader = self.spark.read.schema(schema[kind]).option("basePath", root)
        rows = reader.parquet(*[f"{root}/segment={n}" for n in self.segments])
        if not self.gone:
            return rows.drop("segment")
        gone = self.spark.read.schema(f"{key}, doc_len bigint, _last int").parquet(*self.gone)
        gone = gone.select(F.col(self.primary_key).alias("_gone"), "_last")
        return rows.join(gone, (F.col(self.primary_key) == F.col("_gone")) & (F.col("segment") <= F.col("_last")), "left_anti").drop("segment")

    def postings(self) -> DataFrame:
        return self._stored("postings").drop("tier")

    def documents(self) -> DataFrame:
        """``<key>, row_hash, doc_len`` of every indexed row."""
        return self._stored("docs")

    def terms(self, terms: Sequence[str]) -> DataFrame:
        return of_terms(self.postings(), terms, "string")

    # --- changes -------------------------------------------------------------------------------

    def _row_hash(self) -> Column:
        return F.xxhash64(*[F.col(c) for c in self.columns])

    def _write_segment(self, term_rows: DataFrame, docs: DataFrame) -> tuple[int, int, int]:
        """(number, documents, tokens) of a new segment."""
        names = _Files(self.spark, self.path).names(f"{self.path}/docs")  # an unfinished one keeps its number
        number = max([int(n[8:]) for n in names if n.startswith("segment=")], default=-1) + 1
        docs.write.parquet(f"{self.path}/docs/segment={number}")
        # A smaller share of the document's length gives a smaller tier, whatever the corpus totals become.
        share = F.col("tf") / F.col("doc_len")
        write_postings(term_rows.withColumn("tier", impact.step(share)), f"{self.path}/postings/segment={number}")
        stored = self.spark.read.parquet(f"{self.path}/postings/segment={number}")
        tiers = stored.groupBy("term", "tier").agg(F.count("*").alias("n"), F.max(share).alias("share"), F.max("tf").alias("tf"))
        write_postings(tiers, f"{self.path}/tiers/segment={number}")
        own = self.spark.read.parquet(f"{self.path}/docs/segment={number}").agg(F.count("*"), F.sum("doc_len")).first()
        return number, own[0], own[1] or 0

    def append(self, df: DataFrame) -> TextIndex:
        """The index with further rows, whose keys it does not hold."""
        docs = df.select(self.primary_key, self._row_hash().alias("row_hash"), F.size(document_tokens(self.columns, self.parser)).cast("long").alias("doc_len"))
        number, n_docs, n_tokens = self._write_segment(postings(df, self.columns, self.primary_key, self.parser), docs)
        return self._publish(replace(
            self, segments=(*self.segments, number), n_docs=self.n_docs + n_docs, n_tokens=self.n_tokens + n_tokens
        ))

    def remove(self, keys: DataFrame) -> TextIndex:
        """The index without the rows of ``keys`` (its key column); no posting is rewritten."""
        hit = self.documents().join(keys.select(self.primary_key).distinct(), self.primary_key, "left_semi")
        path = f"{self.path}/gone-{self.number + 1:010d}-{max(self.segments)}"
        hit.select(self.primary_key, "doc_len", F.lit(max(self.segments)).alias("_last")).write.mode("overwrite").parquet(path)
        n_docs, n_tokens = self.spark.read.parquet(path).agg(F.count("*"), F.sum("doc_len")).first()
        if not n_docs:
            return self
        return self._publish(replace(
            self, gone=(*self.gone, path), n_docs=self.n_docs - n_docs, n_tokens=self.n_tokens - (n_tokens or 0), n_gone=self.n_gone + n_docs
        ))

    def fold(self, force: bool = False) -> TextIndex:
        """One segment in place of many, once there are more than ``FOLD_SEGMENTS`` or many rows are gone."""
        if not force and len(self.segments) <= FOLD_SEGMENTS and self.n_gone <= FOLD_GONE * (self.n_docs + self.n_gone):
            return self
        number, n_docs, n_tokens = self._write_segment(self.postings().drop("bucket"), self.documents())
        return self._publish(replace(self, segments=(number,), gone=(), n_gone=0, n_docs=n_docs, n_tokens=n_tokens))

    def refresh(self, base: DataFrame) -> TextIndex:
        """Follow the table: keys and hashes are compared in one shuffle, and only rows that differ are read into tokens."""
        key = self.primary_key
        now = base.select(key, self._row_hash().alias("row_hash"), F.lit(True).alias("now"))
        sides = now.unionByName(self.documents().select(key, "row_hash", F.lit(False).alias("now")))
        found = sides.groupBy(key, "row_hash").agg(F.bool_or("now").alias("_new"), F.bool_and("now").alias("_only_now"))
        found = materialise(found.where((~F.col("_new")) | F.col("_only_now")), "text-differences")
        index = self
        if not found.where("NOT _new").isEmpty():
            index = index.remove(found.where("NOT _new"))
        if not found.where("_new").isEmpty():
            index = index.append(base.join(found.where("_new").select(key), key, "left_semi"))
        return index.fold()

    def matching_keys(self, query: str) -> DataFrame:
        """Keys of the rows :func:`match_filter` would keep."""
        words = tx.query_words(query, self.parser)
        tokens = tx.query_tokens(query, self.parser)
        if not tokens:
            return self.documents().select(self.primary_key).where(F.lit(False))
        hits = self.terms(tokens)
        if all(len(w) == 1 for w in words):
            return hits.select(self.primary_key).distinct()
        found = hits.groupBy(self.primary_key).agg(
            *[F.max(F.col("term") == t).alias(f"t{i}") for i, t in enumerate(tokens)]
        )
        place = {t: i for i, t in enumerate(tokens)}
        test = F.lit(False)
        for word in words:
            every = F.lit(True)
            for t in dict.fromkeys(word):
                every = every & F.col(f"t{place[t]}")
            test = test | every
        return found.where(test).select(self.primary_key)

    def bm25(self, query: str) -> DataFrame:
        """BM25 score of every row with a query term: ``(<key>, score)``.

        Document frequencies are one value per query term, counted from the same
        postings and attached by a broadcast join bounded by the query length.
        """
        tokens = tx.query_tokens(query, self.parser)
        hits = self.terms(tokens)
        freq = hits.groupBy("term").agg(F.count("*").alias("df"))
        scored = hits.join(F.broadcast(freq), "term")
        part = tx.bm25_term(
            F.col("tf"), F.col("doc_len"), F.lit(float(self.avg_len)), tx.idf(F.lit(self.n_docs), F.col("df"))
        )
        return scored.groupBy(self.primary_key).agg(F.sum(part).alias("score"))

    def topk(self, query: str, k: int) -> DataFrame:
        """The k best rows by BM25: ``(<key>, score)``. Postings that cannot reach the k-th score are not read.

        The number of documents with a term is the sum of its tiers; once rows are gone it is counted from the postings.
        """
        terms, root = tx.query_tokens(query, self.parser), f"{self.path}/tiers"
        schema = "term string, tier int, n bigint, share double, tf bigint, bucket int, segment int"
        reader = self.spark.read.schema(schema).option("basePath", root)
        tiers = of_terms(reader.parquet(*[f"{root}/segment={n}" for n in self.segments]), terms, "string")
        tiers = tiers.groupBy("term", "tier").agg(F.sum("n").alias("n"), F.max("share").alias("share"), F.max("tf").alias("tf")).collect()
        if self.gone:
            df = {r["term"]: r["n"] for r in self.terms(terms).groupBy("term").agg(F.count("*").alias("n")).collect()}
        else:
            df = {t: sum(r["n"] for r in tiers if r["term"] == t) for t in terms}
        weights = {t: math.log(1 + (self.n_docs - n + 0.5) / (n + 0.5)) for t, n in df.items()}
        bounds = []
        for r in tiers:
            norm = 1 + tx.BM25_K1 * ((1 - tx.BM25_B) / r["tf"] + tx.BM25_B / (r["share"] * (self.avg_len or 1.0)))
            bounds.append(impact.Tier(r["term"], r["tier"], r["n"], weights.get(r["term"], 0.0) * (tx.BM25_K1 + 1) / norm))
        weight = F.lit(0.0)
        for t, w in weights.items():
            weight = F.when(F.col("term") == F.lit(t), w).otherwise(weight)
        adds = tx.bm25_term(F.col("tf"), F.col("doc_len"), F.lit(float(self.avg_len)), weight)
        scores = impact.best(of_terms(self._stored("postings"), terms, "string"), bounds, adds, k, self.primary_key)
        scores = self.bm25(query) if scores is None else scores
        return scores.orderBy(F.desc("score"), self.primary_key).limit(k)


def term_columns(tokens: Column, terms: Sequence[str], prefix: str = "") -> dict[str, Column]:
    """Term counts and length of a token array, as named columns."""
    columns = {f"{prefix}tf{i}": tx.term_frequency(tokens, t) for i, t in enumerate(terms)}
    columns[f"{prefix}len"] = F.size(tokens)
    return columns


def corpus_stats(n_terms: int, prefix: str = "") -> list[Column]:
    """Aggregates for BM25 over columns made by :func:`term_columns`."""
    return [
        F.count("*").alias(f"{prefix}n"),
        F.avg(F.col(f"{prefix}len").cast("double")).alias(f"{prefix}avg"),
        *[F.count_if(F.col(f"{prefix}tf{i}") > 0).alias(f"{prefix}df{i}") for i in range(n_terms)],
    ]


def bm25_scores(
    df: DataFrame, query: str, columns: str | Sequence[str], primary_key: str, parser: str = "space"
) -> DataFrame:
    """BM25 without an index: ``(<key>, score)`` for rows with a query token.

    The text is read once. Its few counts per document are stored, because they are
    needed twice: for the corpus totals (one row, read as a scalar subquery) and for
    the scores.
    """
    terms = tx.query_tokens(query, parser)
    tokens = df.select(primary_key, document_tokens(columns, parser).alias("tokens"))
    counted = tokens.select(primary_key, *[c.alias(n) for n, c in term_columns(F.col("tokens"), terms).items()])
    counted = materialise(counted, "bm25")
    totals = counted.agg(*corpus_stats(len(terms))).select(F.struct("*").alias("s"))
    any_hit = F.lit(False)
    for i in range(len(terms)):
        any_hit = any_hit | (F.col(f"tf{i}") > 0)
    with_totals = counted.where(any_hit).withColumn("_s", totals.scalar())
    score = F.lit(0.0)
    for i in range(len(terms)):
        score = score + tx.bm25_term(
            F.col(f"tf{i}"), F.col("len"), F.col("_s")["avg"], tx.idf(F.col("_s")["n"], F.col("_s")[f"df{i}"])
        )
    return with_totals.select(primary_key, score.alias("score"))


def bm25_topk(
    df: DataFrame, query: str, columns, primary_key: str, k: int = 10, parser: str = "space",
    index: TextIndex | None = None, where=None,
) -> DataFrame:
    """The k best rows by BM25: ``(<key>, score)``, ties by key."""
    if index is not None and where is None:
        return index.topk(query, k)
    scores = index.bm25(query) if index else bm25_scores(df, query, columns, primary_key, parser)
    if where is not None:
        scores = scores.join(filtered(df, where).select(primary_key), primary_key, "left_semi")
    return scores.orderBy(F.desc("score"), primary_key).limit(k)

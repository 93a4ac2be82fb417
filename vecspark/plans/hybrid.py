"""Hybrid search: text, scalar and vector conditions in one request body.

A request becomes one plan. The query part turns into a predicate and a score over
term counts; the vector part is a top-k search; both meet by adding scores. Text
hits are never shuffled: the few vector hits are joined to them, and each task
keeps the rows that can still reach the page.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame, functions as F

from vecspark.functions import text as tx
from vecspark.functions.distance import resolve_metric
from vecspark.operators import ivf
from vecspark.operators.fts import TextIndex
from vecspark.operators.search import query_distance
from vecspark.session import materialise

# Page size and vector candidates where a request names none.
DEFAULT_SIZE = 10
DEFAULT_KNN = 10


@dataclass
class _Field:
    """What the request asks of one text column."""

    name: str
    parser: str
    prefix: str
    terms: list[str] = dc_field(default_factory=list)
    phrases: list[tx.Clause] = dc_field(default_factory=list)

    def term(self, term: str) -> int:
        if term not in self.terms:
            self.terms.append(term)
        return self.terms.index(term)

    def phrase(self, clause: tx.Clause) -> int:
        for term in clause.terms:
            self.term(term)
        same = [i for i, p in enumerate(self.phrases) if (p.terms, p.slop) == (clause.terms, clause.slop)]
        if same:
            return same[0]
        self.phrases.append(clause)
        return len(self.phrases) - 1

    def tokens(self) -> Column:
        return F.coalesce(tx.tokens(self.name, self.parser), F.array().cast("array<string>"))


def _weighted(field: str) -> tuple[str, float]:
    name, _, weight = field.partition("^")
    return name, float(weight) if weight else 1.0


def _as_list(value) -> list:
    return list(value) if isinstance(value, (list, tuple)) else [value]


def _only(node: Mapping) -> tuple[str, Mapping]:
    if not isinstance(node, Mapping) or len(node) != 1:
        raise ValueError(f"a query node has exactly one kind, got {node!r}")
    return next(iter(node.items()))


class _Request:
    def __init__(self, parsers: Mapping[str, str], default_parser: str):
        self.parsers, self.default_parser = parsers, default_parser
        self.fields: dict[str, _Field] = {}
        self.columns: list[str] = []

    def field(self, name: str) -> _Field:
        if name not in self.fields:
            parser = self.parsers.get(name, self.default_parser)
            self.fields[name] = _Field(name, parser, f"_f{len(self.fields)}_")
        return self.fields[name]

    def collect(self, node: Mapping) -> None:
        """Note the terms, phrases and plain columns of a query tree."""
        kind, spec = _only(node)
        if kind == "bool":
            for part in ("must", "should", "must_not", "filter"):
                for child in _as_list(spec.get(part, [])):
                    self.collect(child)
        elif kind == "query_string":
            for name in _as_list(spec["fields"]):
                f = self.field(_weighted(name)[0])
                for clause in tx.query_clauses(spec["query"], f.parser):
                    f.phrase(clause) if clause.is_phrase else f.term(clause.terms[0])
        else:
            self.columns += [c for c in spec if c != "boost" and c not in self.columns]

    def needs_text(self, node: Mapping) -> bool:
        """True when every hit must hold a query term."""
        kind, spec = _only(node)
        if kind == "query_string":
            return True
        if kind != "bool":
            return False
        required = _as_list(spec.get("must", [])) + _as_list(spec.get("filter", []))
        if required:
            return any(self.needs_text(c) for c in required)
        should = _as_list(spec.get("should", []))
        return bool(should) and all(self.needs_text(c) for c in should)

    def uses_text(self, node: Mapping) -> bool:
        """True where a part of the query looks into text columns."""
        kind, spec = _only(node)
        if kind != "bool":
            return kind == "query_string"
        return any(self.uses_text(c) for part in ("must", "should", "must_not", "filter") for c in _as_list(spec.get(part, [])))

    # --- (predicate, score) of a node -------------------------------------------------

    def compile(self, node: Mapping) -> tuple[Column, Column]:
        kind, spec = _only(node)
        builders = {
            "bool": self._bool, "query_string": self._query_string, "terms": self._terms, "range": self._range
        }
        if kind not in builders:
            raise ValueError(f"unknown query kind {kind!r}; use one of {sorted(builders)}")
        predicate, score = builders[kind](spec)
        return predicate, score * F.lit(float(spec.get("boost", 1.0)))

    def _bool(self, spec: Mapping) -> tuple[Column, Column]:
        predicate, score = F.lit(True), F.lit(0.0)
        for child in _as_list(spec.get("must", [])):
            p, s = self.compile(child)
            predicate, score = predicate & p, score + s
        for child in _as_list(spec.get("filter", [])):
            predicate = predicate & self.compile(child)[0]
        for child in _as_list(spec.get("must_not", [])):
            predicate = predicate & ~self.compile(child)[0]
        should = [self.compile(child) for child in _as_list(spec.get("should", []))]
        if should:
            some = F.lit(False)
            for p, s in should:
                some = some | p
                score = score + F.when(p, s).otherwise(0.0)
            if not spec.get("must") and not spec.get("filter"):
                predicate = predicate & some
        return predicate, score

    def _terms(self, spec: Mapping) -> tuple[Column, Column]:
        predicate = F.lit(True)
        for column, values in spec.items():
            if column != "boost":
                predicate = predicate & F.coalesce(F.col(column).isin(_as_list(values)), F.lit(False))
        return predicate, F.lit(1.0)

    def _range(self, spec: Mapping) -> tuple[Column, Column]:
        tests = {
            "lt": lambda c, v: c < v, "lte": lambda c, v: c <= v,
            "gt": lambda c, v: c > v, "gte": lambda c, v: c >= v,
        }
        predicate = F.lit(True)
        for column, limits in spec.items():
            if column == "boost":
                continue
            for name, value in limits.items():
                if name not in tests:
                    raise ValueError(f"unknown range limit {name!r}")
                predicate = predicate & F.coalesce(tests[name](F.col(column), F.lit(value)), F.lit(False))
        return predicate, F.lit(1.0)

    def _query_string(self, spec: Mapping) -> tuple[Column, Column]:
        if spec.get("type", "best_fields") != "best_fields":
            raise ValueError("query_string supports type best_fields")
        any_field, scores = F.lit(False), [F.lit(0.0)]
        for name in _as_list(spec["fields"]):
            name, weight = _weighted(name)
            f = self.field(name)
            clauses = tx.query_clauses(spec["query"], f.parser)
            if not clauses:
                continue
            matched, score = F.lit(0), F.lit(0.0)
            for clause in clauses:
                hit, value = self._clause(f, clause)
                matched = matched + hit.cast("int")
                score = score + F.lit(clause.weight) * value
            enough = matched >= minimum_matches(spec.get("minimum_should_match"), len(clauses))
            any_field = any_field | enough
            scores.append(F.when(enough, score * F.lit(weight)).otherwise(0.0))
        return any_field, F.greatest(*scores) if len(scores) > 1 else scores[0]

    def _clause(self, f: _Field, clause: tx.Clause) -> tuple[Column, Column]:
        def part(term: str) -> Column:
            return F.col(f"{f.prefix}bm{f.term(term)}")

        if not clause.is_phrase:
            return F.col(f"{f.prefix}tf{f.term(clause.terms[0])}") > 0, part(clause.terms[0])
        hit = F.col(f"{f.prefix}ph{f.phrase(clause)}")
        total = F.lit(0.0)
        for term in dict.fromkeys(clause.terms):
            total = total + part(term)
        return hit, F.when(hit, total).otherwise(0.0)

    # --- term counts, phrase hits and BM25 parts as columns ----------------------------

    def with_features(
        self, df: DataFrame, key: str, indexes: Mapping[str, TextIndex], required: bool, carried: Sequence[str]
    ) -> DataFrame:
        """Add the columns :meth:`compile` refers to, for every requested text column.

        Without an index the text is read once: its counts are stored with the
        ``carried`` columns, for the corpus totals and then for the scores.
        """
        scanned = [f for f in self.fields.values() if f.name not in indexes]
        for f in self.fields.values():
            if f.name in indexes:
                df = self._from_index(df, key, f, indexes[f.name], required and len(self.fields) == 1)
        if not scanned:
            return df
        df = df.withColumns({f"{f.prefix}tok": f.tokens() for f in scanned})
        columns = {}
        for f in scanned:
            tokens = F.col(f"{f.prefix}tok")
            for i, term in enumerate(f.terms):
                columns[f"{f.prefix}tf{i}"] = tx.term_frequency(tokens, term)
            for j, clause in enumerate(f.phrases):
                columns[f"{f.prefix}ph{j}"] = tx.phrase_match(tokens, clause)
            columns[f"{f.prefix}len"] = F.size(tokens)
        made = [c for f in self.fields.values() if f not in scanned for c in df.columns if c.startswith(f.prefix)]
        df = df.select(*carried, *made, *[c.alias(name) for name, c in columns.items()])
        df = materialise(df, "hybrid")
        totals = []
        for f in scanned:
            totals.append(F.count("*").alias(f"{f.prefix}n"))
            totals.append(F.avg(F.col(f"{f.prefix}len").cast("double")).alias(f"{f.prefix}avg"))
            totals += [F.count_if(F.col(f"{f.prefix}tf{i}") > 0).alias(f"{f.prefix}df{i}") for i in range(len(f.terms))]
        stats = df.agg(*totals).select(F.struct("*").alias("s"))
        df = df.withColumn("_s", stats.scalar())
        parts = {}
        for f in scanned:
            for i in range(len(f.terms)):
                parts[f"{f.prefix}bm{i}"] = tx.bm25_term(
                    F.col(f"{f.prefix}tf{i}"), F.col(f"{f.prefix}len"), F.col("_s")[f"{f.prefix}avg"],
                    tx.idf(F.col("_s")[f"{f.prefix}n"], F.col("_s")[f"{f.prefix}df{i}"]),
                )
        return df.withColumns(parts).drop("_s")

    def _from_index(self, df: DataFrame, key: str, f: _Field, index: TextIndex, required: bool) -> DataFrame:
        hits = index.terms(f.terms)
        freq = {r["term"]: r["n"] for r in hits.groupBy("term").agg(F.count("*").alias("n")).collect()}
        counts = hits.groupBy(key).agg(
            F.max("doc_len").alias(f"{f.prefix}len"),
            *[
                F.coalesce(F.max(F.when(F.col("term") == t, F.col("tf"))), F.lit(0)).alias(f"{f.prefix}tf{i}")
                for i, t in enumerate(f.terms)
            ],
        )
        df = df.join(counts, key, "inner" if required else "left")
        tfs = {f"{f.prefix}tf{i}": F.coalesce(F.col(f"{f.prefix}tf{i}"), F.lit(0)) for i in range(len(f.terms))}
        df = df.withColumns({**tfs, f"{f.prefix}len": F.coalesce(F.col(f"{f.prefix}len"), F.lit(0))})
        columns = {}
        for i, term in enumerate(f.terms):
            idf = tx.idf(F.lit(index.n_docs), F.lit(freq.get(term, 0)))
            columns[f"{f.prefix}bm{i}"] = tx.bm25_term(
                F.col(f"{f.prefix}tf{i}"), F.col(f"{f.prefix}len"), F.lit(float(index.avg_len or 1.0)), idf
            )
        for j, clause in enumerate(f.phrases):
            present = F.lit(True)
            for term in dict.fromkeys(clause.terms):
                present = present & (F.col(f"{f.prefix}tf{f.term(term)}") > 0)
            # Only rows that hold every term are split into tokens again.
            columns[f"{f.prefix}ph{j}"] = F.when(present, tx.phrase_match(f.tokens(), clause)).otherwise(False)
        return df.withColumns(columns)


def minimum_matches(setting: str | int | None, n: int) -> int:
    """``"30%"`` of n clauses rounded down, or a plain count; at least one."""
    if setting is None:
        return 1
    text = str(setting).strip()
    wanted = int(float(text[:-1]) / 100.0 * n) if text.endswith("%") else int(text)
    return max(1, min(wanted, n))


def knn_score(distance: Column, metric: str) -> Column:
    """A score that grows with similarity, from a distance."""
    metric = resolve_metric(metric)
    if metric == "l2":
        return F.lit(1.0) / (F.lit(1.0) + distance)
    if metric == "cosine":
        return (F.lit(2.0) - distance) / 2.0
    return distance if metric == "ip" else F.lit(0.0) - distance


def knn_hits(
    df: DataFrame, spec: Mapping, key: str, metric: str, condition: Column | None, index: ivf.IvfIndex | None = None
) -> DataFrame:
    """The vector part of a request: ``(<key>, knn_score)``, at most k rows.

    With an index of the field whose lists hold the columns of ``condition``, the nearest lists are probed
    until they hold ``num_candidates`` rows, and at least as many as the index probes by default.
    """
    # Search by closeness: the inner product itself ascends from the least similar.
    closest = "neg_ip" if resolve_metric(metric) == "ip" else resolve_metric(metric)
    k = int(spec.get("k", DEFAULT_KNN))
    candidates = max(k, int(spec.get("num_candidates", k)))
    if index is not None and index.metric == closest and ivf.carries(df.sparkSession, index, condition):
        query = spec["query_vector"]
        nprobe = max(index.default_nprobe, index.lists_holding(df.sparkSession, query, candidates))
        near = ivf.filtered_search(df, index, query, condition, k, nprobe).withColumnRenamed("distance", "_dist")
    else:
        scope = df if condition is None else df.where(condition)
        dist = query_distance(spec["field"], spec["query_vector"], closest)
        near = scope.select(key, dist.alias("_dist")).orderBy(F.asc_nulls_last("_dist"), key).limit(candidates)
    scored = near.where("_dist is not null").select(key, "_dist", knn_score(F.col("_dist"), closest).alias("knn_score"))
    if "similarity" in spec:
        scored = scored.where(F.col("knn_score") >= float(spec["similarity"]))
    scored = scored.select(key, (F.col("knn_score") * F.lit(float(spec.get("boost", 1.0)))).alias("knn_score"), "_dist")
    return scored.orderBy("_dist", key).limit(k).select(key, "knn_score")


def hybrid_search(
    df: DataFrame,
    body: Mapping,
    primary_key: str = "id",
    parsers: Mapping[str, str] | None = None,
    default_parser: str = "ik",
    metric: str = "l2",
    indexes: Mapping[str, TextIndex] | None = None,
    columns: Sequence[str] | None = None,
    score_name: str = "score",
    vector_indexes: Mapping[str, ivf.IvfIndex] | None = None,
) -> DataFrame:
    """Run a request body over a table: rows of the page with their score, best first.

    ``parsers`` names the tokeniser per text column; ``indexes`` holds built text
    indexes, whose postings then replace the scan of that column. ``vector_indexes`` holds the index of a
    vector column; it serves ``knn`` unless its filter looks into text or columns that the index lacks.
    """
    query, knn = body.get("query"), body.get("knn")
    if query is None and knn is None:
        raise ValueError("a request needs a query or a knn part")
    offset, size = int(body.get("from", 0)), int(body.get("size", DEFAULT_SIZE))
    request = _Request(parsers or {}, default_parser)
    knn_filter = None
    if knn is not None and knn.get("filter") is not None:
        knn_filter = {"bool": {"filter": _as_list(knn["filter"])}}
    for node in (query, knn_filter):
        if node is not None:
            request.collect(node)
    required = all(node is not None and request.needs_text(node) for node in (query, knn_filter) if node is not None)
    required = required and (knn is None or knn_filter is not None)
    carried = list(dict.fromkeys([primary_key, *request.columns]))
    featured = df
    if request.fields:
        featured = request.with_features(df, primary_key, indexes or {}, required, carried)

    vector_hits = None
    if knn is not None:
        source, condition = df, None if knn_filter is None else request.compile(knn_filter)[0]
        served = (vector_indexes or {}).get(knn["field"])
        if knn_filter is not None and request.uses_text(knn_filter):
            # Only the keys that pass the filter meet the vectors.
            source, condition, served = df.join(featured.where(condition).select(primary_key), primary_key, "left_semi"), None, None
        vector_hits = knn_hits(source, knn, primary_key, metric, condition, served)
    if query is None:
        page = vector_hits.select(primary_key, F.col("knn_score").alias("_score"))
    else:
        predicate, score = request.compile(query)
        page = featured.where(predicate).select(primary_key, score.alias("_score"))
        if vector_hits is not None:
            page = _fuse(page, vector_hits, primary_key, offset + size, int(knn.get("k", DEFAULT_KNN)))
    page = page.orderBy(F.desc("_score"), primary_key).offset(offset).limit(size)
    wanted = list(columns) if columns else df.columns
    if wanted == [primary_key]:
        return page.select(primary_key, F.col("_score").alias(score_name))
    rows = df.select(*dict.fromkeys([primary_key, *wanted])).join(page, primary_key)
    return rows.orderBy(F.desc("_score"), primary_key).select(*wanted, F.col("_score").alias(score_name))


def _fuse(text_hits: DataFrame, vector_hits: DataFrame, key: str, page_end: int, k: int) -> DataFrame:
    """Rows that can reach the page, scores added.

    A row outside the vector hits reaches the page only from the first ``page_end``
    text hits. A vector hit that is also a text hit but not among those cannot reach
    it either, and its vector score alone ranks it no higher.
    """
    both = text_hits.join(vector_hits, key, "left").select(
        key, (F.col("_score") + F.coalesce("knn_score", F.lit(0.0))).alias("_score")
    )
    best = both.orderBy(F.desc("_score"), key).limit(page_end).withColumn("_full", F.lit(1))
    alone = vector_hits.select(key, F.col("knn_score").alias("_score"), F.lit(0).alias("_full"))
    return best.unionByName(alone).groupBy(key).agg(F.max_by("_score", "_full").alias("_score"))

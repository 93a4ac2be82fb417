"""Hybrid requests over documents joined with their vectors and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.operators import ivf
from vecspark.plans.hybrid import hybrid_search
from vecspark.queries.bm25sql import bm25, counts, phrase, words
from vecspark.queries.registry import ORACLES, query, table
from vecspark.queries.vectors import QUERY, Q, V
from vecspark.session import scratch_path

PARSERS = {"text": "space", "source": "space"}

_SOURCE = """(
    SELECT d.*, e.embedding, e.label, l.quality, l.toxic FROM documents d
    LEFT JOIN embeddings e ON e.vec_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
_KEEP = "lang, n_chars, quality, toxic, label, embedding"


def rows(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id")
    docs = table(spark, sf_dir, "documents")
    return docs.join(vectors, "doc_id", "left").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def _run(spark, sf_dir, body):
    found = hybrid_search(rows(spark, sf_dir), body, "doc_id", PARSERS, columns=["doc_id"])
    return found.withColumn("score", F.round("score", 5))


def _sql(fields, predicate: str, score: str, size: int, offset: int = 0) -> str:
    return f"""
    WITH {counts(_SOURCE, 'doc_id', fields, _KEEP)},
    scored AS (SELECT doc_id, {score} AS s FROM cnt, stat WHERE {predicate})
    SELECT doc_id, round(s, 5) AS score FROM scored ORDER BY s DESC, doc_id LIMIT {size} OFFSET {offset}
    """


def _total(prefix: str, n: int) -> str:
    return "(" + " + ".join(bm25(prefix, i) for i in range(n)) + ")"


_BOOL_FIELDS = {"a": (words("text"), ["which", "from", "avec"])}


@query(
    "hybrid_bool",
    _sql(
        _BOOL_FIELDS,
        "(atf0 > 0 OR atf1 > 0) AND n_chars >= 500 AND NOT coalesce(toxic >= 1, false)",
        f"0.7 * (({bm25('a', 0)} + {bm25('a', 1)}) + 2 * (CASE WHEN atf2 > 0 THEN {bm25('a', 2)} ELSE 0 END)"
        " + CASE WHEN lang IN ('fr', 'es') THEN 0.5 ELSE 0 END)",
        60,
    ),
)
def hybrid_bool(spark, sf_dir):
    body = {
        "query": {
            "bool": {
                "must": [{"query_string": {"fields": ["text"], "query": "which from"}}],
                "should": [
                    {"query_string": {"fields": ["text"], "query": "avec", "boost": 2}},
                    {"terms": {"lang": ["fr", "es"], "boost": 0.5}},
                ],
                "must_not": [{"range": {"toxic": {"gte": 1}}}],
                "filter": [{"bool": {"filter": {"range": {"n_chars": {"gte": 500}}}}}],
                "boost": 0.7,
            }
        },
        "size": 60,
    }
    return _run(spark, sf_dir, body)


_QS_TERMS = ["which", "from", "src7", "avec", "this", "para", "nicht"]
_QS_FIELDS = {"a": (words("text"), _QS_TERMS), "b": (words("source"), _QS_TERMS)}


def _enough(p: str) -> str:
    return "(" + " + ".join(f"({p}tf{i} > 0)::INTEGER" for i in range(7)) + ") >= 2"


@query(
    "hybrid_query_string",
    _sql(
        _QS_FIELDS,
        f"{_enough('a')} OR {_enough('b')}",
        f"1.5 * greatest(0, CASE WHEN {_enough('a')} THEN 3 * {_total('a', 7)} ELSE 0 END,"
        f" CASE WHEN {_enough('b')} THEN {_total('b', 7)} ELSE 0 END)",
        40,
    ),
)
def hybrid_query_string(spark, sf_dir):
    """30 % of seven clauses: at least two must match in one column."""
    body = {
        "query": {
            "query_string": {
                "fields": ["text^3", "source"], "type": "best_fields",
                "query": "which from src7 avec this para nicht", "minimum_should_match": "30%", "boost": 1.5,
            }
        },
        "size": 40,
    }
    return _run(spark, sf_dir, body)


_PHRASE = phrase("atok", ["of", "that", "with"], 4)


@query(
    "hybrid_phrase",
    _sql(
        {"a": (words("text"), ["which", "of", "that", "with"])},
        f"atf0 > 0 OR {_PHRASE}",
        f"0.5 * {bm25('a', 0)} + 1.5 * (CASE WHEN {_PHRASE} THEN {bm25('a', 1)} + {bm25('a', 2)} + {bm25('a', 3)} ELSE 0 END)",
        40,
    ),
)
def hybrid_phrase(spark, sf_dir):
    text = '((which)^0.5 ("of that with"~4)^1.5)'
    return _run(spark, sf_dir, {"query": {"query_string": {"fields": ["text"], "query": text}}, "size": 40})


@query(
    "hybrid_terms",
    _sql(
        {"a": (words("text"), ["the"])},
        "lang IN ('en', 'de') AND source IN ('src1', 'src7') AND atf0 > 0".replace("source", "btok[1]"),
        f"{bm25('a', 0)} + 1",
        50,
    ).replace("AS atok FROM", f"AS atok, {words('source')} AS btok FROM"),
)
def hybrid_terms(spark, sf_dir):
    body = {
        "query": {
            "bool": {
                "must": [
                    {"query_string": {"fields": ["text"], "query": "the"}},
                    {"terms": {"lang": ["en", "de"]}},
                ],
                "filter": [{"terms": {"source": ["src1", "src7"]}}],
            }
        },
        "size": 50,
    }
    return _run(spark, sf_dir, body)


@query(
    "hybrid_range",
    _sql(
        {"a": (words("text"), ["from"])},
        "atf0 > 0 AND n_chars >= 1000 AND n_chars < 20000 AND quality > 0 AND toxic <= 0",
        bm25("a", 0), 30, 5,
    ),
)
def hybrid_range(spark, sf_dir):
    body = {
        "query": {
            "bool": {
                "must": {"query_string": {"fields": ["text"], "query": "from"}},
                "filter": [
                    {"range": {"n_chars": {"gte": 1000, "lt": 20000}}},
                    {"range": {"quality": {"gt": 0}, "toxic": {"lte": 0}}},
                ],
            }
        },
        "from": 5,
        "size": 30,
    }
    return _run(spark, sf_dir, body)


_D = f"list_distance({V}, {Q})"


@query(
    "hybrid_knn",
    f"""
    WITH near AS (SELECT doc_id, {_D} AS d FROM {_SOURCE} WHERE lang IN ('en', 'fr') AND embedding IS NOT NULL
                  ORDER BY d, doc_id LIMIT 100)
    SELECT doc_id, round(1 / (1 + d), 5) AS score FROM near WHERE 1 / (1 + d) >= 0.29
    ORDER BY 1 / (1 + d) DESC, doc_id LIMIT 20
    """,
)
def hybrid_knn(spark, sf_dir):
    body = {
        "knn": {
            "field": "embedding", "query_vector": QUERY, "k": 20, "num_candidates": 100,
            "filter": {"terms": {"lang": ["en", "fr"]}}, "similarity": 0.29,
        },
        "size": 20,
    }
    return _run(spark, sf_dir, body)


_HIT = "(atf0 > 0 OR atf1 > 0 OR atf2 > 0) AND lang IN ('en', 'fr', 'de') AND NOT coalesce(toxic >= 1, false)"


@query(
    "hybrid_search",
    f"""
    WITH {counts(_SOURCE, 'doc_id', {'a': (words('text'), ['which', 'avec', 'nicht'])}, _KEEP)},
    scored AS (SELECT doc_id, embedding, {_HIT} AS hit,
                      0.7 * (0.5 * {bm25('a', 0)} + 1.5 * {bm25('a', 1)} + {bm25('a', 2)}) AS s FROM cnt, stat),
    near AS (SELECT doc_id, 1 / (1 + {_D}) AS v FROM scored WHERE hit AND embedding IS NOT NULL
             ORDER BY {_D}, doc_id LIMIT 50),
    fused AS (SELECT doc_id, s + coalesce(v, 0) AS total FROM scored LEFT JOIN near USING (doc_id) WHERE hit)
    SELECT doc_id, round(total, 5) AS score FROM fused ORDER BY total DESC, doc_id LIMIT 60 OFFSET 3
    """,
)
def hybrid_search_query(spark, sf_dir):
    request = {
        "bool": {
            "must": [{"query_string": {"fields": ["text"], "query": "(which)^0.5 (avec)^1.5 nicht"}}],
            "filter": [
                {"terms": {"lang": ["en", "fr", "de"]}},
                {"bool": {"must_not": [{"range": {"toxic": {"gte": 1}}}]}},
            ],
            "boost": 0.7,
        }
    }
    body = {
        "query": request,
        "knn": {"field": "embedding", "query_vector": QUERY, "k": 50, "num_candidates": 200, "filter": request},
        "from": 3,
        "size": 60,
    }
    return _run(spark, sf_dir, body)


@query(
    "hybrid_union",
    f"""
    WITH {counts(_SOURCE, 'doc_id', {'a': (words('text'), ['nicht'])}, _KEEP)},
    txt AS (SELECT doc_id, {bm25('a', 0)} AS s FROM cnt, stat WHERE atf0 > 0),
    near AS (SELECT doc_id, 1 / (1 + {_D}) AS v FROM cnt WHERE embedding IS NOT NULL ORDER BY {_D}, doc_id LIMIT 50),
    fused AS (SELECT coalesce(t.doc_id, k.doc_id) AS doc_id, coalesce(s, 0) + coalesce(v, 0) AS total
              FROM txt t FULL JOIN near k ON t.doc_id = k.doc_id)
    SELECT doc_id, round(total, 5) AS score FROM fused ORDER BY total DESC, doc_id LIMIT 150
    """,
)
def hybrid_union(spark, sf_dir):
    body = {
        "query": {"query_string": {"fields": ["text"], "query": "nicht"}},
        "knn": {"field": "embedding", "query_vector": QUERY, "k": 50},
        "size": 150,
    }
    return _run(spark, sf_dir, body)


def _run_indexed(spark, sf_dir, body, carry):
    """The request with an index of the vectors; ``num_candidates`` of all rows makes it probe every list."""
    source = rows(spark, sf_dir)
    index = ivf.build(source, "embedding", "doc_id", scratch_path(spark, "ivf-hybrid"), "flat", nlist=16, carry=carry)
    body = {**body, "knn": {**body["knn"], "num_candidates": index.n_rows}}
    found = hybrid_search(source, body, "doc_id", PARSERS, columns=["doc_id"], vector_indexes={"embedding": index})
    return found.withColumn("score", F.round("score", 5))


@query("hybrid_knn_index", ORACLES["hybrid_knn"].replace("LIMIT 100", "LIMIT 20"))
def hybrid_knn_index(spark, sf_dir):
    """The filter of the vector part is pushed into the lists, which carry its column."""
    body = {
        "knn": {
            "field": "embedding", "query_vector": QUERY, "k": 20, "filter": {"terms": {"lang": ["en", "fr"]}}, "similarity": 0.29,
        },
        "size": 20,
    }
    return _run_indexed(spark, sf_dir, body, ["lang"])


@query("hybrid_union_index", ORACLES["hybrid_union"])
def hybrid_union_index(spark, sf_dir):
    body = {
        "query": {"query_string": {"fields": ["text"], "query": "nicht"}},
        "knn": {"field": "embedding", "query_vector": QUERY, "k": 50},
        "size": 150,
    }
    return _run_indexed(spark, sf_dir, body, [])

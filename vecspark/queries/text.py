"""Full-text search over ``documents``, ``conversations`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.functions import text as tx
from vecspark.operators import fts
from vecspark.queries.bm25sql import bm25, counts, words
from vecspark.queries.registry import query, table
from vecspark.session import scratch_path

_STOP = "[" + ", ".join(f"'{w}'" for w in tx.STOP_WORDS) + "]"
_ENGLISH = f"list_filter({words('text')}, lambda x: NOT list_contains({_STOP}, x))"


def _grams_sql(text: str, n: int) -> str:
    short = "[]::VARCHAR[]"
    return (
        f"flatten(list_transform({words(text)}, lambda r: CASE WHEN length(r) < {n} THEN [r] ELSE "
        f"list_transform(range(1, length(r) - {n} + 2), lambda i: substring(r, i, {n})) END))"
        if n
        else short
    )


def _tokens_sql(tokens: str) -> str:
    return f"""
    SELECT doc_id, len(t)::INTEGER AS n_tokens, len(list_distinct(t))::INTEGER AS n_distinct,
           list_min(t) AS first_token, list_max(t) AS last_token
    FROM (SELECT doc_id, {tokens} AS t FROM documents)
    """


def _token_summary(spark, sf_dir, parser):
    t = table(spark, sf_dir, "documents").select("doc_id", tx.tokens("text", parser).alias("t"))
    return t.select(
        "doc_id", F.size("t").alias("n_tokens"), F.size(F.array_distinct("t")).alias("n_distinct"),
        F.array_min("t").alias("first_token"), F.array_max("t").alias("last_token"),
    )


@query("fts_tokens_space", _tokens_sql(words("text")))
def fts_tokens_space(spark, sf_dir):
    return _token_summary(spark, sf_dir, "space")


@query("fts_tokens_english", _tokens_sql(_ENGLISH))
def fts_tokens_english(spark, sf_dir):
    return _token_summary(spark, sf_dir, "beng")


@query("fts_tokens_ngram", _tokens_sql(_grams_sql("text", 2)))
def fts_tokens_ngram(spark, sf_dir):
    return _token_summary(spark, sf_dir, "ngram")


@query(
    "fts_postings",
    f"""
    SELECT term, doc_id, count(*)::BIGINT AS tf, doc_len FROM (
        SELECT doc_id, unnest(t) AS term, len(t)::INTEGER AS doc_len
        FROM (SELECT doc_id, {words('text')} AS t FROM documents))
    GROUP BY term, doc_id, doc_len
    """,
)
def fts_postings(spark, sf_dir):
    return fts.postings(table(spark, sf_dir, "documents"), "text", "doc_id")


@query(
    "fts_doc_freq",
    f"""
    SELECT term, count(DISTINCT doc_id)::BIGINT AS doc_freq, count(*)::BIGINT AS term_count
    FROM (SELECT doc_id, unnest({words('text')}) AS term FROM documents) GROUP BY term
    """,
)
def fts_doc_freq(spark, sf_dir):
    return fts.document_frequency(fts.postings(table(spark, sf_dir, "documents"), "text", "doc_id"))


@query(
    "fts_match_filter",
    f"SELECT doc_id, lang FROM documents WHERE list_has_any({words('text')}, ['avec', 'nicht', 'para'])",
)
def fts_match_filter(spark, sf_dir):
    return fts.match_filter(table(spark, sf_dir, "documents"), "Avec NICHT para", "text").select("doc_id", "lang")


@query(
    "fts_match_multi_column",
    f"""
    SELECT conv_id, turn FROM conversations
    WHERE list_has_any({words('role')}, ['assistant', 'which']) OR list_has_any({words('text')}, ['assistant', 'which'])
    """,
)
def fts_match_multi_column(spark, sf_dir):
    return fts.match_filter(table(spark, sf_dir, "conversations"), "assistant which", "role", "text").select(
        "conv_id", "turn"
    )


@query(
    "fts_match_and_pred",
    f"""
    SELECT doc_id, n_chars FROM documents
    WHERE list_has_any({words('text')}, ['which', 'from']) AND n_chars > 2000 AND lang = 'en'
    ORDER BY doc_id LIMIT 20
    """,
)
def fts_match_and_pred(spark, sf_dir):
    found = fts.match_filter(
        table(spark, sf_dir, "documents"), "which from", "text", where=["n_chars > 2000", F.col("lang") == "en"]
    )
    return found.select("doc_id", "n_chars").orderBy("doc_id").limit(20)


_GRAM_WORDS = [["tr", "ra", "ac", "ck"], ["ar", "rt", "ti", "ic", "cl", "le"]]
_GRAM_TEST = " OR ".join(f"list_has_all(g, {w})" for w in _GRAM_WORDS)


@query(
    "fts_two_parsers",
    f"""
    SELECT page_id, list_has_any(u, ['page', 'fr']) AS url_hit, ({_GRAM_TEST}) AS html_hit
    FROM (SELECT page_id, {words('url')} AS u, {_grams_sql('html', 2)} AS g FROM pages)
    WHERE list_has_any(u, ['page', 'fr']) OR {_GRAM_TEST}
    """,
)
def fts_two_parsers(spark, sf_dir):
    hits = table(spark, sf_dir, "pages").select(
        "page_id", tx.match_any("page fr", "url", parser="space").alias("url_hit"),
        tx.match_any("track article", "html", parser="ngram").alias("html_hit"),
    )
    return hits.where("url_hit OR html_hit")


_TERMS = ["which", "avec", "from", "nicht"]
_BM25_SQL = f"""
    WITH {counts('documents', 'doc_id', {'a': (words('text'), _TERMS)})},
    scored AS (SELECT doc_id, {' + '.join(bm25('a', i) for i in range(4))} AS s FROM cnt, stat
               WHERE {' OR '.join(f'atf{i} > 0' for i in range(4))})
    SELECT doc_id, round(s, 5) AS score FROM scored ORDER BY s DESC, doc_id LIMIT 25
"""


@query("fts_bm25_topk", _BM25_SQL)
def fts_bm25_topk(spark, sf_dir):
    best = fts.bm25_topk(table(spark, sf_dir, "documents"), "which avec from nicht", "text", "doc_id", 25)
    return best.withColumn("score", F.round("score", 5))


@query("fts_index_bm25_topk", _BM25_SQL)
def fts_index_bm25_topk(spark, sf_dir):
    """The same ranking from postings on disk."""
    docs = table(spark, sf_dir, "documents")
    index = fts.TextIndex.build(docs, "text", "doc_id", scratch_path(spark, "fts"))
    best = fts.bm25_topk(docs, "which avec from nicht", "text", "doc_id", 25, index=index)
    return best.withColumn("score", F.round("score", 5))


@query("fts_index_topk", _BM25_SQL.replace("LIMIT 25", "LIMIT 3"))
def fts_index_topk(spark, sf_dir):
    """The three best rows over two stored segments, by the tiers that can hold one of them."""
    docs = table(spark, sf_dir, "documents")
    index = fts.TextIndex.build(docs.where("n_chars < 1500"), "text", "doc_id", scratch_path(spark, "fts-topk"))
    index = index.append(docs.where("n_chars >= 1500 OR n_chars IS NULL"))
    return index.topk("which avec from nicht", 3).withColumn("score", F.round("score", 5))


def _bm25_of(source: str) -> str:
    return _BM25_SQL.replace(" FROM documents)", f" FROM {source})")


def _indexed_topk(index, docs):
    best = fts.bm25_topk(docs, "which avec from nicht", "text", "doc_id", 25, index=index)
    return best.withColumn("score", F.round("score", 5))


@query("fts_index_after_insert", _BM25_SQL)
def fts_index_after_insert(spark, sf_dir):
    """An index of some rows takes the others as further segments."""
    docs = table(spark, sf_dir, "documents")
    index = fts.TextIndex.build(docs.where("lang = 'en'"), "text", "doc_id", scratch_path(spark, "fts-insert"))
    index = index.append(docs.where("lang <> 'en' AND n_chars < 1000")).append(docs.where("lang <> 'en' AND n_chars >= 1000"))
    return _indexed_topk(fts.TextIndex.load(spark, index.path), docs)


@query(
    "fts_index_after_delete",
    _bm25_of("(SELECT doc_id, lang, CASE WHEN lang = 'fr' THEN concat('nicht ', text) ELSE text END AS text FROM documents WHERE lang <> 'de')"),
)
def fts_index_after_delete(spark, sf_dir):
    """Rows of one language go, those of another change; the segments stay, and what is gone is left out."""
    docs = table(spark, sf_dir, "documents")
    index = fts.TextIndex.build(docs, "text", "doc_id", scratch_path(spark, "fts-delete"))
    index = index.remove(docs.where("lang = 'de'").select("doc_id"))
    changed = F.when(F.col("lang") == "fr", F.concat(F.lit("nicht "), "text")).otherwise(F.col("text"))
    docs = docs.where("lang <> 'de'").withColumn("text", changed)
    return _indexed_topk(index.refresh(docs), docs)

"""The registered queries of this subpackage and their SQL.

Each applies one operator to a whole table and derives the contract's columns from it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vecspark.llm import (
    bpe, ctw, decontaminate, forest, licenses, negatives, prefixtrie, quality, quotes, secrets, simhash, topk, toxicity,
)
from vecspark.llm.common import fold, small_batches
from vecspark.queries import registry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return registry.table(small_batches(spark), sf_dir, name)


def vocabulary() -> bpe.Vocabulary:
    import public_tokenizers

    return bpe.Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op1_license_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = licenses.scan(docs, licenses.train(docs))
    confirmed = F.filter("paragraphs", lambda p: p["confirmed"])
    return found.select(
        "doc_id", F.array_join(F.array_sort(F.array_distinct(F.transform(confirmed, lambda p: p["family"]))), ",").alias("families"),
        F.size("paragraphs").cast("long").alias("n_predicted"), F.size(confirmed).cast("long").alias("n_confirmed"),
        F.array_max(F.transform("paragraphs", lambda p: p["probability"])).alias("probability"), "paragraphs",
    )


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    scored = docs.select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), model.column("text", "n_chars").alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    voc = vocabulary()
    out = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), voc), voc)
    return out.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")  # noqa: E731
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


@query(
    "op5_quotation_linking",
    r"""
    WITH RECURSIVE m AS (
      SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
    l AS (
      SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM m
      WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
    n AS (
      SELECT conv_id, turn, length(x) - length(replace(x, '>', '')) AS level, trim(regexp_replace(translate(
               line[length(x) + 1 :], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS p
      FROM (SELECT *, regexp_extract(line, '^(?:\x20?>)+\x20?') AS x FROM l)),
    o AS (SELECT conv_id, p, min(turn) AS target FROM n WHERE level = 0 AND p <> '' GROUP BY ALL),
    f AS (
      SELECT n.conv_id, n.turn, n.level, CASE WHEN target < n.turn THEN target END AS target, count(*) AS times
      FROM n LEFT JOIN o USING (conv_id, p) WHERE level > 0 AND p <> '' GROUP BY ALL),
    r AS (
      SELECT conv_id, turn, CAST(sum(times) AS BIGINT) AS n_quoted,
             CAST(coalesce(sum(times) FILTER (target IS NOT NULL), 0) AS BIGINT) AS n_linked,
             (list(target ORDER BY level, times DESC, target DESC) FILTER (target IS NOT NULL))[1] AS parent
      FROM f GROUP BY ALL),
    t(conv_id, turn, root, depth) AS (
      SELECT conv_id, turn, parent, CAST(1 AS BIGINT) FROM r WHERE parent IS NOT NULL
      UNION ALL
      SELECT t.conv_id, t.turn, r.parent, depth + 1 FROM t JOIN r ON r.conv_id = t.conv_id AND r.turn = t.root
      WHERE r.parent IS NOT NULL),
    d AS (SELECT conv_id, turn, min(root) AS root, max(depth) AS depth FROM t GROUP BY ALL)
    SELECT m.conv_id, m.turn, role, coalesce(root, m.turn) AS thread, parent, coalesce(depth, 0) AS depth,
           coalesce(n_quoted, 0) AS n_quoted, coalesce(n_linked, 0) AS n_linked,
           CASE WHEN len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^(?:\x20?>)+'))) = 0 THEN text
             ELSE regexp_replace(array_to_string(list_filter(string_split(text, chr(10)),
               lambda x: NOT regexp_matches(x, '^(?:\x20?>)+') AND NOT regexp_matches(x, '^On .{1,200} wrote:\s*$')), chr(10)),
               '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') END AS body
    FROM m LEFT JOIN r USING (conv_id, turn) LEFT JOIN d USING (conv_id, turn)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", "role")


@query("op6_context_tree_weighting")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ctw.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return scored.select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
        (-F.col("bits") * math.log10(2)).alias("score"),
    )


@query(
    "op7_exact_topk",
    """
    WITH e AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.topk(table(spark, sf_dir, "embeddings"), lambda key: key % 100 == 0)


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.group(table(spark, sf_dir, "documents"))
    return grouped.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query(
    "op9_benchmark_decontamination",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
    b AS (
      SELECT item_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
    win AS (
      SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g
      FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
            FROM b WHERE len(w) > 0)),
    pos AS (
      SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
    hit AS (SELECT r, i, pos.n AS n, item_id FROM pos JOIN win ON pos.g = win.g AND pos.n = win.n),
    covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
    items AS (
      SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.ToxicityModel:
    return toxicity.train(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2
    )


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = toxicity_model(spark, sf_dir)
    scored = table(spark, sf_dir, "documents").select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), model.column("text").alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op11_projection_forest")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.search(table(spark, sf_dir, "embeddings"), lambda key: key % 100 == 0)


@query(
    "op12_prefix_trie",
    r"""
    WITH m AS (
      SELECT conv_id AS c, turn, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS t FROM conversations WHERE conv_id IS NOT NULL),
    own AS (
      SELECT c, list(t ORDER BY turn NULLS FIRST, sha256(length(t.r) || ':' || t.r || t.t)) AS l FROM m GROUP BY c),
    bits AS (
      SELECT c, l, CAST(c AS VARCHAR) AS s FROM own),
    h AS (
      SELECT c, l, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                 list_transform(range(1, len(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))),
               lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                 lambda x, y: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)))), CAST(4294967295 AS BIGINT)) % 4 AS BIGINT) AS h
      FROM bits),
    g AS (
      SELECT h.c, list_concat(coalesce(b.l[1 : h.h], []), h.l[h.h + 1 :]) AS l
      FROM h LEFT JOIN own b ON b.c = h.c - h.c % 20),
    p AS (SELECT c, len(l) AS n, unnest(range(0, len(l) + 1)) AS d, l FROM g),
    n AS (
      SELECT d, l[1 : d] AS x, min(c) AS conv_id, count(*) AS n_convs,
             list(c ORDER BY c) FILTER (n = d) AS e
      FROM p GROUP BY ALL),
    k AS (
      SELECT n.*, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(list_filter(regexp_split_to_array(x[d].t, '[ 	-]+'), lambda w: w <> '')) END AS saving,
             (SELECT count(*) FROM n c WHERE c.d = n.d + 1 AND c.x[1 : n.d] = n.x) AS n_children
      FROM n),
    s AS (
      SELECT a.d, a.x, sum(CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(k.saving) AS saved
      FROM (SELECT *, unnest(range(0, d + 1)) AS u FROM k) k JOIN n a ON a.d = k.u AND a.x = k.x[1 : k.u] GROUP BY a.d, a.x)
    SELECT k.conv_id, CAST(k.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, k.n_convs, k.n_children,
           CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
           sha256(coalesce(array_to_string(k.e, ','), '')) AS ends_sha256
    FROM k JOIN s ON s.d = k.d AND s.x = k.x LEFT JOIN n q ON q.d = k.d - 1 AND q.x = k.x[1 : k.d - 1]
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.crc32(F.col("c").cast("string")) % 4
    return prefixtrie.trie(
        table(spark, sf_dir, "conversations"), base=F.col("c") - F.col("c") % 20, head=head, most=3
    )


@query(
    "op13_hard_negatives",
    """
    WITH u AS (
      SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS y,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.y = c.y AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
      FROM u a JOIN u c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
    p AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score
      FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= 5),
    n AS (
      SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
        AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.mine(rows, lambda key: key % 50 == 0)

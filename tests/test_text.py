import itertools
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from vecspark.functions import text as tx
from vecspark.operators import fts
from vecspark.plans.hybrid import hybrid_search, minimum_matches
from vecspark.session import scratch_path
from vecspark.sources.tables import ConcurrentChange

GARDEN = [
    (1, "The Heron stands in the reeds", 1), (2, "a heron and a quiet pond", 1), (3, "moss on old stones", 2),
    (4, "frogs jump high, frogs jump far", 1), (5, "moles jump seldom", 1), (6, "hares jump at dawn", 2),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(GARDEN, "id int, doc string, category int")


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("parser", ["ngram", "space", "beng", "ik", "jieba", "ngram2"])
def test_match_with_predicates(docs, parser):
    found = fts.match_filter(docs, "jump", "doc", parser=parser, where="id > 4").orderBy("id").limit(1)
    assert [tuple(r)[:2] for r in found.collect()] == [(5, "moles jump seldom")]
    assert ids(fts.match_filter(docs, "jump", "doc", parser=parser, where="category = 1")) == [4, 5]


def test_case_is_ignored(spark):
    df = spark.createDataFrame([(1, "mOss"), (2, "Moss"), (3, "MOSS")], "id int, doc string")
    assert ids(fts.match_filter(df, "moss", "doc")) == [1, 2, 3]


def test_chinese(spark):
    df = spark.createDataFrame(
        [(1, "分布式数据库系统", "a database"), (2, "天气很好", "nothing"), (3, "数据", "databases")],
        "id int, title string, content string",
    )
    for parser in ("ik", "jieba", "ngram"):
        assert ids(fts.match_filter(df, "数据库", "title", parser=parser)) == [1]
    both = df.where(tx.match_any("数据库", "title", parser="ik") & tx.match_any("database", "content", parser="ngram"))
    assert ids(both) == [1]


def test_stop_words_and_empty_queries(docs):
    assert ids(fts.match_filter(docs, "the in", "doc", parser="beng")) == []
    assert ids(fts.match_filter(docs, "the", "doc")) == [1]
    assert ids(fts.match_filter(docs, "  ", "doc")) == []
    with pytest.raises(ValueError):
        fts.match_filter(docs, "x")


def test_tokens(spark):
    df = spark.createDataFrame([("The ABC-de f",)], "t string")
    def run(p):
        return df.select(tx.tokens("t", p)).first()[0]
    assert run("space") == ["the", "abc", "de", "f"]
    assert run("beng") == ["abc", "de", "f"]
    assert run("ngram") == ["th", "he", "ab", "bc", "de", "f"]
    assert run("ngram2") == ["th", "he", "the", "ab", "bc", "abc", "de", "f"]
    assert run("something") == run("space")


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("aAbB ß-数据库1", max_size=12), min_size=1, max_size=8),
    st.text("ab ß数据库1", min_size=1, max_size=5),
    st.sampled_from(["space", "beng", "ngram", "ngram2", "ik"]),
)
def test_match_equals_token_definition(spark, texts, query, parser):
    """The pattern and substring forms keep exactly the rows the tokens define."""
    df = spark.createDataFrame(list(enumerate(texts)), "id int, doc string").coalesce(1)
    words = tx.query_words(query, parser)
    rows = df.select("id", tx.tokens("doc", parser).alias("t"), tx.match_any(query, "doc", parser=parser).alias("m"))
    for r in rows.collect():
        assert r["m"] == any(all(t in r["t"] for t in word) for word in words)


def test_postings_and_index(spark, docs):
    rows = {(r["term"], r["id"]): (r["tf"], r["doc_len"]) for r in fts.postings(docs, "doc", "id").collect()}
    assert rows[("jump", 4)] == (2, 6) and rows[("frogs", 4)] == (2, 6) and rows[("reeds", 1)] == (1, 6)
    assert len(rows) == 5 + 5 + 4 + 4 + 3 + 4
    for parser in ("space", "beng", "ngram"):
        index = fts.TextIndex.build(docs, "doc", "id", scratch_path(spark, "fts"), parser)
        for query in ("jump far", "heron", "mo"):
            assert ids(index.matching_keys(query)) == ids(fts.match_filter(docs, query, "doc", parser=parser))
            a = [(r["id"], round(r["score"], 9)) for r in fts.bm25_topk(docs, query, "doc", "id", 5, parser).collect()]
            b = [(r["id"], round(r["score"], 9)) for r in fts.bm25_topk(docs, query, "doc", "id", 5, index=index).collect()]
            assert a == b
        assert fts.TextIndex.load(spark, index.path).n_docs == 6


def test_segments_follow_the_table(spark):
    """After each change the index answers as one that is built anew."""
    text = lambda i: " ".join(w for n, w in enumerate(("moss", "pond", "reed", "frog", "lily")) if (i >> n) & 1) * (1 + i % 3)
    frame = lambda rows: spark.createDataFrame(rows, "id int, doc string")
    rows = {i: text(i) for i in range(1, 40)}
    index = fts.TextIndex.build(frame(list(rows.items())), "doc", "id", scratch_path(spark, "segments"))

    def same(index):
        df = frame(list(rows.items()))
        fresh = fts.TextIndex.build(df, "doc", "id", scratch_path(spark, "anew"))
        assert (index.n_docs, index.n_tokens) == (fresh.n_docs, fresh.n_tokens)
        for query in ("moss frog", "lily", "pond reed moss"):
            best = lambda i: [(r["id"], round(r["score"], 9)) for r in fts.bm25_topk(df, query, "doc", "id", 9, index=i).collect()]
            assert best(index) == best(fresh)
            assert sorted(ids(index.matching_keys(query))) == sorted(ids(fts.match_filter(df, query, "doc")))

    more = {i: text(i) for i in range(40, 50)} | {50: None, 51: ""}
    rows |= more
    index = index.append(frame(list(more.items())))
    same(index)
    for i in (3, 41, 50):
        del rows[i]
    index = index.remove(frame([(3, ""), (41, ""), (50, ""), (999, "")]))
    same(index)
    rows |= {3: "frog frog", 7: "reed", 8: None}  # one comes back, two change
    index = index.refresh(frame(list(rows.items())))
    assert len(index.segments) == 3 and index.n_gone == 5
    same(index)
    stale = fts.TextIndex.load(spark, index.path)
    assert stale == index
    index = index.fold(force=True)
    assert len(index.segments) == 1 and index.n_gone == 0
    same(index)
    with pytest.raises(ConcurrentChange):
        stale.remove(frame([(7, "")]))
    assert index.refresh(frame(list(rows.items()))) == index  # nothing to do
    same(fts.TextIndex.load(spark, index.path))


def test_empty_and_null_documents(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "word")], "id int, doc string")
    assert [(r["term"], r["id"]) for r in fts.postings(df, "doc", "id").collect()] == [("word", 3)]
    assert [r["id"] for r in fts.bm25_topk(df, "word", "doc", "id").collect()] == [3]


def test_query_clauses():
    text = '((花园)^0.4 (pond)^2 ("pond 花园"~3)^1.25)'
    clauses = tx.query_clauses(text, "ik")
    assert [(c.terms, c.weight, c.slop) for c in clauses] == [
        (("花园",), 0.4, None), (("pond",), 2.0, None), (("pond", "花园"), 1.25, 3),
    ]
    assert [(c.terms, c.weight) for c in tx.query_clauses("one two^3 (three)")] == [
        (("one",), 1.0), (("two",), 3.0), (("three",), 1.0)
    ]


def test_phrase_slop(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "c x b y a"), (3, "a b x x x c"), (4, "a b")], "id int, t string")
    def run(slop):
        return ids(df.where(tx.phrase_match(tx.tokens("t"), tx.Clause(("a", "b", "c"), 1.0, slop))))
    # Reversed words are as many moves away as their shifts differ: 5, 2 and -1.
    assert run(0) == [1] and run(2) == [1] and run(3) == [1, 3] and run(5) == [1, 3] and run(6) == [1, 2, 3]


def test_phrase_order_and_repeats(spark):
    texts = ["bora island", "bora bora island", "island bora bora", "bora x island bora", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")

    def brute(text, terms, slop):
        words, found = text.split(), False
        for at in itertools.permutations(range(len(words)), len(terms)):
            shifts = [p - i for i, p in enumerate(at)]
            found |= [words[p] for p in at] == list(terms) and max(shifts) - min(shifts) <= slop
        return found

    for terms in (("bora", "bora", "island"), ("bora", "island"), ("island", "bora"), ("x",)):
        for slop in range(5):
            got = ids(df.where(tx.phrase_match(tx.tokens("t"), tx.Clause(terms, 1.0, slop))))
            assert got == [i for i, t in enumerate(texts) if brute(t, terms, slop)], (terms, slop)


def test_minimum_matches():
    assert [minimum_matches(x, 4) for x in (None, "30%", "75%", "100%", 2, "3")] == [1, 1, 3, 4, 2, 3]


HYBRID = [
    (1, "north", 3, [0.0, 4.0], "Birds of the marsh", "Herons and reeds through the year."),
    (2, "south", 5, [2.0, 1.0], "Ponds for small gardens", "How a pond is dug, lined and planted."),
    (3, "south", 4, [5.0, 5.0], "Stone walls", "Dry walls, steps and a pond edge."),
    (4, "attic", 9, [2.0, 1.5], "Marsh and pond", "Notes from a pond without a garden."),
    (5, "south", 0, [2.0, 1.0], "Pond garden pond", "Withdrawn."),
]


def request(k=50):
    query = {
        "bool": {
            "must": [{"query_string": {
                "fields": ["title^4", "body"], "type": "best_fields",
                "query": '((pond)^1.5 (garden)^0.5 (walls)^0.75 ("pond edge"~1)^2)', "minimum_should_match": "25%"}}],
            "filter": [{"terms": {"shelf": ["south", "attic"]}}, {"bool": {"must_not": [{"range": {"copies": {"lt": 1}}}]}}],
            "boost": 0.9,
        }
    }
    knn = {"field": "place", "k": k, "num_candidates": 200, "query_vector": [2, 1], "filter": query, "similarity": 0.1}
    return {"query": query, "knn": knn, "from": 0, "size": 20}


@pytest.fixture(scope="module")
def hybrid_rows(spark):
    return spark.createDataFrame(
        HYBRID, "id int, shelf string, copies int, place array<float>, title string, body string"
    )


def test_hybrid_request(spark, hybrid_rows):
    found = hybrid_search(hybrid_rows, request()).collect()
    scores = [r["score"] for r in found]
    assert sorted(r["id"] for r in found) == [2, 3, 4] and scores == sorted(scores, reverse=True)
    assert all(r["title"] == HYBRID[r["id"] - 1][4] for r in found)
    indexes = {c: fts.TextIndex.build(hybrid_rows, c, "id", scratch_path(spark, "h"), "ik") for c in ("title", "body")}
    again = hybrid_search(hybrid_rows, request(), indexes=indexes).collect()
    assert [(r["id"], round(r["score"], 9)) for r in again] == [(r["id"], round(r["score"], 9)) for r in found]
    one = hybrid_search(hybrid_rows, request(), indexes={"title": indexes["title"]}).collect()
    assert [(r["id"], round(r["score"], 9)) for r in one] == [(r["id"], round(r["score"], 9)) for r in found]


def test_hybrid_pages_cut_one_ranking(hybrid_rows):
    body = {
        "query": {"query_string": {"fields": ["body"], "query": "pond"}},
        "knn": {"field": "place", "query_vector": [5, 4], "k": 5},
    }
    everything = [tuple(r) for r in hybrid_search(hybrid_rows, {**body, "size": 20}, columns=["id"]).collect()]
    assert len(everything) == 5
    paged = []
    for start in range(0, 6, 2):
        page = hybrid_search(hybrid_rows, {**body, "from": start, "size": 2}, columns=["id"])
        paged += [tuple(r) for r in page.collect()]
    assert paged == everything


def test_hybrid_without_hits(hybrid_rows):
    body = {"query": {"query_string": {"fields": ["title"], "query": "absent"}}}
    assert hybrid_search(hybrid_rows, body).collect() == []


def test_hybrid_rejects_unknown_parts(hybrid_rows):
    with pytest.raises(ValueError):
        hybrid_search(hybrid_rows, {"query": {"fuzzy": {}}})
    with pytest.raises(ValueError):
        hybrid_search(hybrid_rows, {})
    with pytest.raises(ValueError):
        hybrid_search(hybrid_rows, {"query": {"query_string": {"fields": ["title"], "query": "a", "type": "phrase"}}})


def test_postings_count_runs_of_tokens(spark):
    texts = ["a aa a aaa aa a", "b", None, "", "  .. ", "1 11 1 é É é \U00010400 \U00010428 x_x x", "中文 中文 文 " + "w " * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for parser in ("space", "ngram", "ik"):
        tokens = {r["id"]: r["t"] or [] for r in docs.select("id", tx.tokens("text", parser).alias("t")).collect()}
        want = sorted((t, i, n, len(own)) for i, own in tokens.items() for t, n in Counter(own).items())
        found = fts.postings(docs, "text", "id", parser)
        assert found.dtypes == [("term", "string"), ("id", "int"), ("tf", "bigint"), ("doc_len", "int")]
        assert sorted(map(tuple, found.collect())) == want
        steps = found._jdf.queryExecution().optimizedPlan().toString()
        assert "element_at" not in steps  # no lambda that looks at each token again

import pytest
from pyspark.sql import functions as F, types as T

from vecspark.operators.partition import MAXVALUE, KeyPartition, Layout, ListPartition, RangePartition
from vecspark.session import scratch_path
from vecspark.sources import schema as sc
from vecspark.workspace import Workspace

#: Places on a line, a step apart; every third has company at the same place.
LINE = [(7 * i + 1, [0.5 * (i // 3), -1.0, 2.0]) for i in range(18)]
END = [0.5 * 5, -1.0, 2.0]


@pytest.fixture()
def ws(spark):
    return Workspace(spark, scratch_path(spark, "workspace"))


def ids(df, key="id"):
    return [r[key] for r in df.collect()]


def vectors(layout=None):
    return sc.TableSpec(
        [sc.field("id", "int"), sc.vector_field("embedding", 3), sc.json_field("meta", True)], ("id",), layout=layout
    )


def data():
    return [{"id": i, "embedding": v} for i, v in LINE]


def test_indexed_search_follows_the_table(ws):
    layout = Layout(RangePartition("id", [("west", 60), ("east", MAXVALUE)]))
    ws.create_table("t", vectors(layout), {"v": {"column": "embedding", "kind": "hnsw"}})
    ws.create_table("t", vectors())  # exists: nothing happens
    ws.insert("t", data())
    ws.insert("t", [])
    assert ws.stats("t") == {"row_count": 18} and ws.table_names() == ["t"]
    near = lambda **more: ids(ws.ann_search("t", END, "embedding", topk=5, index="v", **more))
    want = [106, 113, 120, 85, 92]  # those at the end, then the next place
    assert near() == want  # not built yet: exact
    ws.refresh_index("t", "v")
    assert ws._current("t", "vector", "embedding", "v") is not None
    assert near(nprobe=99) == want and near(nprobe=99, where="id < 100") == [85, 92, 99, 64, 71]
    found = ws.ann_search("t", END, "embedding", topk=2, index="v", nprobe=99, where="id < 100", names=["id"], with_distance=True)
    assert [tuple(r) for r in found.collect()] == [(85, 0.5), (92, 0.5)]
    assert ids(ws.search("t", END, "embedding", limit=3, partitions=["west"])) == [43, 50, 57]
    ws.delete("t", [106, 120], partition="east")
    assert near() == [113, 85, 92, 99, 64]
    ws.rebuild_index("t", "v", 0.01)
    assert near(nprobe=99) == [113, 85, 92, 99, 64]
    ws.drop_index("t", "v")
    ws.drop_table("t")
    assert not ws.has_table("t")


def test_filter_columns_of_an_index(ws):
    spec = sc.TableSpec([sc.field("id", "int"), sc.vector_field("embedding", 3), sc.field("kind", "int")], ("id",))
    ws.create_table("t", spec)
    ws.insert("t", [{"id": i, "embedding": v, "kind": i % 2} for i, v in LINE])
    ws.create_vector_index("t", "v", "embedding", nlist=3, filter_columns=["kind"])
    find = lambda: ids(ws.ann_search("t", END, "embedding", topk=3, index="v", nprobe=1, where="kind = 1"))
    assert find() == [113, 85, 99]
    body = {"knn": {"field": "embedding", "query_vector": END, "k": 3, "num_candidates": 18, "filter": {"terms": {"kind": [1]}}}}
    assert ids(ws.hybrid_search("t", body)) == [113, 85, 99]
    ws.update("t", {"kind": "1"}, "id = 106")  # the vector stays, what is carried changes
    ws.refresh_index("t", "v", 0)
    assert ws._current("t", "vector", "embedding", "v") is not None
    assert find() == [106, 113, 85] and ids(ws.hybrid_search("t", body)) == [106, 113, 85]


def test_rows(ws):
    ws.create_table("t", vectors())
    ws.insert("t", data())
    with pytest.raises(ValueError, match="duplicate"):
        ws.insert("t", {"id": 8, "embedding": END})
    with pytest.raises(ValueError, match="dim"):
        ws.insert("t", {"id": 30, "embedding": [1, 2]})
    with pytest.raises(ValueError, match="not in the schema"):
        ws.insert("t", {"id": 30, "colour": "red"})
    ws.upsert("t", [{"id": 8, "embedding": [1, 1, 1], "meta": "{}"}, {"id": 8, "embedding": [2, 2, 2]}])
    assert tuple(ws.get("t", 8).first()) == (8, [2.0, 2.0, 2.0], None)
    ws.update("t", {"meta": "concat('{\"id\": ', id, '}')"}, "id < 20")
    assert ws.query("t", "get_json_object(meta, '$.id') > 7", ["id"]).count() == 2
    ws.delete("t", where="id >= 20")
    assert sorted(ids(ws.get("t", [1, 22]))) == [1]
    ws.add_columns("t", [sc.field("tag", "int", True)])
    assert ws.sql("SELECT count(*) AS n, count(tag) AS m FROM t WHERE l2_distance(embedding, array(2, 2, 2)) < 1").first() == (1, 0)
    ws.drop_columns("t", ["tag"])
    assert ws.read("t").columns == ["id", "embedding", "meta"]


def test_partition_scope(ws):
    layout = Layout(RangePartition("id", [("west", 60), ("east", MAXVALUE)]))
    ws.create_table("t", vectors(layout))
    with pytest.raises(ValueError, match="does not belong"):
        ws.insert("t", {"id": 61, "embedding": END}, partition="west")
    ws.insert("t", {"id": 44, "embedding": END}, partition="west")
    ws.upsert("t", [{"id": 44, "embedding": [1, 1, 1]}, {"id": 45, "embedding": END}], partition="west")
    ws.insert("t", {"id": 77, "embedding": END})
    ws.update("t", {"meta": "'{}'"}, partition="west")
    assert sorted((r["id"], r["meta"]) for r in ws.read("t").collect()) == [(44, "{}"), (45, "{}"), (77, None)]


def test_collections_and_automatic_keys(ws):
    ws.create_collection("c", 2, auto_id=True)
    ws.insert("c", [{"vector": [1, 2]}, {"vector": [3, 4]}])
    ws.insert("c", {"vector": [5, 6]})
    assert sorted(ids(ws.read("c"))) == [1, 2, 3]
    with pytest.raises(ValueError):
        ws.create_collection("d")


def test_text_and_hybrid(ws):
    spec = sc.TableSpec(
        [sc.field("id", "int"), sc.text_field("title"), sc.text_field("body"), sc.vector_field("v", 2)], ("id",)
    )
    ws.create_table("d", spec, text_indexes={"a": {"columns": "title"}, "b": {"columns": "body", "parser": "ngram"}})
    ws.insert("d", [
        {"id": 1, "title": "red apple", "body": "databases", "v": [1, 0]},
        {"id": 2, "title": "green apple", "body": "nothing", "v": [0, 1]},
        {"id": 3, "title": "stone", "body": "a database", "v": [1, 1]},
    ])
    body = {"query": {"query_string": {"fields": ["title^2", "body"], "query": "apple database"}},
            "knn": {"field": "v", "query_vector": [1, 1], "k": 1}}
    first = [tuple(r) for r in ws.hybrid_search("d", body, columns=["id"]).collect()]
    for name in ("a", "b"):
        ws.refresh_index("d", name)
    assert sorted(ids(ws.match("d", "apple", "title"))) == [1, 2]
    assert sorted(ids(ws.match("d", "database", "body"))) == [1, 3]
    again = [tuple(r) for r in ws.hybrid_search("d", body, columns=["id"]).collect()]
    assert [(i, round(s, 9)) for i, s in first] == [(i, round(s, 9)) for i, s in again] and len(first) == 3


def test_sparse(ws):
    spec = sc.TableSpec([sc.field("id", "int"), sc.sparse_field("s"), sc.field("c", "int", True)], ("id",))
    ws.create_table("s", spec)
    ws.insert("s", [{"id": 1, "s": {1: 0.5, 9: 1}}, {"id": 2, "s": {5: 1}}, {"id": 3, "s": {1: 2}}])
    before = ids(ws.sparse_search("s", {1: 1.0}, "s", 3))
    ws.create_vector_index("s", "i", "s", "daat", "inner_product")
    assert ids(ws.sparse_search("s", {1: 1.0}, "s", 3)) == before == [3, 1, 2]
    with pytest.raises(ValueError):
        ws.create_vector_index("s", "j", "s", "daat", "l2")
    with pytest.raises(TypeError):
        ws.insert("s", {"id": 9, "s": [1.0]})


def test_update_keeps_the_rules_and_sql_the_views(ws, spark):
    spec = sc.TableSpec([sc.field("id", "int"), sc.field("name", "string", True, max_length=3)], ("id",))
    ws.create_table("people", spec)
    ws.insert("people", [{"id": 1, "name": "ann"}, {"id": 2, "name": "bo"}])
    with pytest.raises(ValueError, match="max_length|type"):
        ws.update("people", {"name": "repeat(name, 4)"}, "id = 1")
    with pytest.raises(ValueError):
        ws.update("people", {"id": "7"})
    with pytest.raises(ValueError):
        ws.update("people", {"id": "2"}, "id = 1")
    ws.update("people", {"name": "upper(name)"}, "id = 2")
    spark.range(3).createOrReplaceTempView("people")
    assert ws.sql("SELECT name FROM people WHERE id = 2").first()["name"] == "BO"
    assert spark.table("people").count() == 3
    spark.catalog.dropTempView("people")


def test_index_serves_after_inserts_updates_and_deletes(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path / "alive"))
    spec = sc.TableSpec([sc.field("id", "bigint"), sc.vector_field("v", 2)], ("id",))
    ws.create_table("t", spec, data=spark.createDataFrame([(i, [float(i), 1.0]) for i in range(40)], "id long, v array<float>"))
    ws.create_vector_index("t", "i", "v", nlist=4)
    found = lambda **o: ids(ws.ann_search("t", [0.0, 1.0], "v", topk=3, index="i", nprobe=4, names=["id"], **o))
    plans = lambda: ws.ann_search("t", [0.0, 1.0], "v", topk=3, index="i")._jdf.queryExecution().toString()
    assert found() == [0, 1, 2]
    ws.insert("t", [{"id": 100, "v": [0.5, 1.0]}])
    assert found() == [0, 100, 1] and found(where="id > 0") == [100, 1, 2]
    assert "list_id" in plans()  # the index still serves
    ws.refresh_index("t", "i")  # too few rows to fold in
    assert found() == [0, 100, 1]
    ws.delete("t", [0])
    ws.update("t", {"v": "array(0.25F, 1.0F)"}, "id = 30")
    assert found() == [30, 100, 1] and "list_id" not in plans()
    ws.refresh_index("t", "i")
    assert found() == [30, 100, 1] and "list_id" in plans()
    ws.insert("t", [{"id": 0, "v": [0.0, 1.0]}])  # a row that the index has seen before
    assert found() == [0, 30, 100]
    ws.refresh_index("t", "i", 0)
    assert found() == [0, 30, 100]


def last_part(ws, name):
    table = ws._table(name)
    return table._commit_at(table._current())["parts"][-1]


def test_changes_rewrite_only_partitions_with_touched_rows(ws):
    layout = Layout(KeyPartition(["id"], 8))
    ws.create_table("t", sc.TableSpec([sc.field("id", "bigint"), sc.field("v", "string", True)], ("id",), layout=layout))
    ws.insert("t", [{"id": i, "v": f"v{i}"} for i in range(40)])
    home = {r["id"]: r["_p0"] for r in ws._table("t").read(with_partitions=True).collect()}
    assert len(set(home.values())) > 3
    ws.update("t", {"v": "'new'"}, "id IN (3, 4)")
    assert last_part(ws, "t")["only"] == sorted({home[3], home[4]})
    ws.delete("t", [5])
    assert last_part(ws, "t")["only"] == [home[5]]
    ws.upsert("t", [{"id": 6, "v": "six"}])
    assert last_part(ws, "t")["only"] == [home[6]]
    state = ws._table("t").state
    ws.delete("t", [5, 500])  # no such rows: nothing is written
    ws.update("t", {"v": "'x'"}, "id > 999")
    assert ws._table("t").state == state
    with pytest.raises(ValueError, match="duplicate key"):
        ws.insert("t", [{"id": 7, "v": "again"}])
    want = {i: f"v{i}" for i in range(40) if i != 5} | {3: "new", 4: "new", 6: "six"}
    assert {r["id"]: r["v"] for r in ws.read("t").collect()} == want
    ws.delete("t")
    assert ws.read("t").count() == 0


def test_rows_that_move_between_partitions(ws):
    layout = Layout(ListPartition("kind", [("low", ["a", "b"]), ("mid", ["c"]), ("high", ["d", "e"])]))
    ws.create_table("t", sc.TableSpec([sc.field("id", "bigint"), sc.field("kind", "string")], ("id",), layout=layout))
    ws.insert("t", [{"id": i, "kind": "abcde"[i % 5]} for i in range(20)])
    ws.update("t", {"kind": "'e'"}, "id = 0")  # from low to high
    assert last_part(ws, "t")["only"] == ["high", "low"]
    ws.upsert("t", [{"id": 2, "kind": "a"}])  # the old row is in mid
    assert last_part(ws, "t")["only"] == ["low", "mid"]
    want = {i: "abcde"[i % 5] for i in range(20)} | {0: "e", 2: "a"}
    assert {r["id"]: r["kind"] for r in ws.read("t").collect()} == want
    assert {r["id"] for r in ws.read("t", ["mid"]).collect()} == {7, 12, 17}

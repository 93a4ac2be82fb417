"""Two writers, jobs that die half-way, and what one commit holds."""

import pytest
from pyspark.sql import functions as F

from vecspark.operators import jsontable as jt, mutate
from vecspark.operators.partition import Layout, ListPartition
from vecspark.session import scratch_path
from vecspark.sources import schema as sc, tables
from vecspark.sources.tables import ConcurrentChange, VersionedTable
from vecspark.workspace import Workspace

SPEC = sc.TableSpec([sc.field("id", "bigint"), sc.field("v", "string", True)], ("id",))


@pytest.fixture()
def root(spark):
    path = scratch_path(spark, "commits")
    VersionedTable(spark, path).create(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), SPEC)
    return path


def rows(table):
    return sorted(tuple(r) for r in table.read().collect())


def folders(spark, path):
    return {n for n in tables._Files(spark, path).names(path) if n.startswith("_part=")}


def test_the_second_of_two_writers_is_refused(spark, root):
    one, two = VersionedTable(spark, root), VersionedTable(spark, root)
    a, b = one.read(), two.read()
    one.replace(mutate.update(a, {"v": "'x'"}, "id = 1"))
    before = folders(spark, root)
    with pytest.raises(ConcurrentChange):
        two.replace(mutate.update(b, {"v": "'y'"}, "id = 2"))
    assert rows(VersionedTable(spark, root)) == [(1, "x"), (2, "b")] and folders(spark, root) == before
    two.replace(mutate.update(two.read(), {"v": "'y'"}, "id = 2"))  # read again, nothing is lost
    assert rows(one) == [(1, "x"), (2, "y")]


def test_statements_of_a_workspace_see_one_state(spark):
    ws, other = (Workspace(spark, root) for root in [scratch_path(spark, "ws")] * 2)
    ws.create_table("t", SPEC)
    ws.insert("t", [{"id": 1, "v": "a"}])
    table = ws._table("t")
    base = table.read()
    other.insert("t", [{"id": 2, "v": "b"}])
    with pytest.raises(ConcurrentChange):
        ws._store(table, None, mutate.delete(base, [1]))
    ws.delete("t", [1])
    assert sorted(r["id"] for r in ws.read("t").collect()) == [2]


def test_additions_that_read_nothing_follow_each_other(spark, root):
    one, two = VersionedTable(spark, root), VersionedTable(spark, root)
    latest = one._latest
    one._latest = lambda seen=[1]: seen.pop() if seen else latest()  # what it saw before the other writer came
    two.append(spark.createDataFrame([(3, "c")], "id long, v string"))
    one.append(spark.createDataFrame([(4, "d")], "id long, v string"))
    assert rows(VersionedTable(spark, root)) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


@pytest.mark.parametrize("change", ["replace", "append", "add", "drop"])
def test_a_job_that_dies_before_its_commit_changes_nothing(spark, root, change, monkeypatch):
    table = VersionedTable(spark, root)
    state = table.state

    def die(self, path, text):
        raise OSError("lost")

    monkeypatch.setattr(tables._Files, "publish", die)
    with pytest.raises(OSError):
        if change == "replace":
            table.replace(table.read().where("id = 1"))
        elif change == "append":
            table.append(spark.createDataFrame([(3, "c")], "id long, v string"))
        elif change == "add":
            table.add_columns([sc.field("w", "int", True)])
        else:
            table.drop_columns(["v"])
    monkeypatch.undo()
    after = VersionedTable(spark, root)
    assert after.state == state and rows(after) == [(1, "a"), (2, "b")]
    after.replace(after.read())
    assert after.vacuum() >= 1 and rows(VersionedTable(spark, root)) == [(1, "a"), (2, "b")]
    assert len(folders(spark, root)) == 1


def test_partitions_over_several_parts(spark):
    layout = Layout(ListPartition("v", [("ab", ["a", "b"]), ("c", ["c"])]))
    table = VersionedTable(spark, scratch_path(spark, "parts"))
    frame = lambda *r: spark.createDataFrame(list(r), "id long, v string")
    table.create(frame((1, "a"), (2, "c")), sc.TableSpec(SPEC.fields, ("id",), layout=layout))
    table.append(frame((3, "b"), (4, "c")))
    state = table.state
    table.append(frame((5, "a")))
    assert [len(table.parts_since(s)) for s in (state, table.state)] == [1, 0]
    assert [r["id"] for r in table.read(parts=table.parts_since(state)).collect()] == [5]
    before = folders(spark, table.root)
    table.replace_partition("ab", mutate.delete(table.read(["ab"]), [1]))
    assert table.parts_since(state) is None
    assert rows(table) == [(2, "c"), (3, "b"), (4, "c"), (5, "a")]
    assert before < folders(spark, table.root) and table.read(["ab"]).count() == 2
    table.replace_partition("ab", mutate.update(table.read(["ab"]), {"v": "'b'"}))
    table.replace_partition("c", table.read(["c"]).where("id = 4"))
    assert rows(table) == [(3, "b"), (4, "c"), (5, "b")]
    assert len(table._commit_at(int(table.state))["parts"]) == 2  # parts without rows are no longer named
    table.vacuum()
    assert rows(table) == [(3, "b"), (4, "c"), (5, "b")] and len(folders(spark, table.root)) == 2


def test_a_dropped_column_does_not_come_back(spark, root):
    table = VersionedTable(spark, root)
    count = len(folders(spark, root))
    table.drop_columns(["v"])
    assert table.read().columns == ["id"] and len(folders(spark, root)) == count  # nothing is rewritten
    table.add_columns([sc.field("w", "int", True)])
    table.add_columns([sc.field("v", "string", True)])
    assert rows(table) == [(1, None, None), (2, None, None)] and table.read().columns == ["id", "w", "v"]


def test_rows_and_columns_of_a_json_table_change_together(spark, monkeypatch):
    root = scratch_path(spark, "json")
    store = jt.JsonTables(spark, root, "u")
    store.create("t", [jt.JsonColumn.of("a", "INT"), jt.JsonColumn.of("b", "VARCHAR(9)")])
    store.insert("t", [[1, "'x'"], [2, "'y'"]])
    commits = lambda: sum(
        VersionedTable(spark, f"{root}/{p}")._latest() for p in ("meta", *[f"data/{n}" for n in tables._Files(spark, root).names(f"{root}/data")])
    )
    before = commits()
    publish = tables._Files.publish
    monkeypatch.setattr(tables._Files, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.alter("t", jt.ChangeColumn("a", "n", "VARCHAR(5)"), jt.DropColumn("b"))
    monkeypatch.setattr(tables._Files, "publish", publish)
    assert sorted(tuple(r) for r in store.read("t").collect()) == [(1, "x"), (2, "y")] and commits() == before
    store.alter("t", jt.ChangeColumn("a", "n", "VARCHAR(5)"), jt.DropColumn("b"), jt.AddColumn(jt.JsonColumn.of("c", "INT", default="7")))
    assert commits() == before + 1 and store.read("t").columns == ["n", "c"]
    store.rename("t", "s")
    assert sorted(tuple(r) for r in store.read("s").collect()) == [("1", 7), ("2", 7)]
    stale, _ = store._lookup("s")
    base = stale.read()
    store.insert("s", [["'3'", 8]])
    with pytest.raises(ConcurrentChange):
        stale.replace(base)
    assert store.read("s").count() == 3

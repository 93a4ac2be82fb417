from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from vecspark.operators import mutate, read
from vecspark.operators.partition import (
    DEFAULT, MAXVALUE, HashPartition, KeyPartition, Layout, ListPartition, RangePartition,
)
from vecspark.session import scratch_path
from vecspark.sources import schema as sc
from vecspark.sources.tables import VersionedTable, row_count


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# --- schema ------------------------------------------------------------------------------


def test_quick_collection():
    spec = sc.quick_collection(37)
    assert spec.primary_key == ("id",) and spec.fields[1].metadata == {"dim": 37}
    named = sc.quick_collection(8, "key", T.StringType(), "v", max_length=64)
    assert named.fields[0].metadata == {"max_length": 64} and named.names == ["key", "v"]
    assert sc.quick_collection(8, id_type=T.IntegerType()).fields[0].dataType == T.IntegerType()


@pytest.mark.parametrize(
    "bad",
    [
        lambda: sc.text_field("id"), lambda: sc.json_field("id"), lambda: sc.vector_field("id", 3),
        lambda: sc.field("id", "double"), lambda: sc.field("id", "float"), lambda: sc.sparse_field("id"),
        lambda: sc.array_field("id", "int"),
    ],
)
def test_types_that_cannot_be_keys(bad):
    with pytest.raises(ValueError):
        sc.TableSpec([bad()], ("id",))


def test_field_parameters():
    with pytest.raises(ValueError):
        sc.vector_field("v", 0)
    with pytest.raises(ValueError):
        sc.varchar_field("v", None)
    with pytest.raises(ValueError):
        sc.array_field("a", "int", 7)
    with pytest.raises(ValueError):
        sc.collection_array_field("a", "string")
    assert sc.collection_array_field("a", "int").dataType == T.ArrayType(T.IntegerType())


def test_violations_and_conform(spark):
    spec = sc.TableSpec(
        [sc.field("id", "bigint"), sc.varchar_field("name", 3, True), sc.vector_field("v", 2, True), sc.field("n", "int", True)],
        ("id",), {"n": "7"},
    )
    df = spark.createDataFrame(
        [(1, "abc", [1.0, 2.0]), (1, "abcd", [1.0]), (None, None, None)], "id int, name string, v array<double>"
    )
    found = {(r["field"], r["rule"]): r["bad_rows"] for r in sc.violations(df, spec).collect()}
    assert found == {("id", "not_null"): 1, ("name", "max_length"): 1, ("v", "dim"): 1, ("id", "unique"): 1}
    with pytest.raises(ValueError, match="break the schema"):
        sc.require_valid(df, spec)
    good = sc.require_valid(df.limit(1), spec)
    assert good.collect()[0].asDict() == {"id": 1, "name": "abc", "v": [1.0, 2.0], "n": 7}
    assert [f.dataType.simpleString() for f in good.schema.fields] == ["bigint", "string", "array<float>", "int"]
    with pytest.raises(ValueError, match="not in the schema"):
        sc.conform(df.withColumn("other", F.lit(1)), spec)


# --- partitions ----------------------------------------------------------------------------


def placed(spark, layout, values, schema):
    df = layout.assign(spark.createDataFrame(values, schema))
    return [tuple(r)[-len(layout.columns):] for r in df.collect()]


def test_range_partitions(spark):
    by_id = Layout(RangePartition("id", [("few", -4), ("some", 25), ("rest", MAXVALUE)]))
    assert placed(spark, by_id, [(-5,), (-4,), (24,), (25,), (None,)], "id int") == [("few",), ("some",), ("some",), ("rest",), ("few",)]
    bounded = Layout(RangePartition("id", [("few", 25)]))
    with pytest.raises(Exception, match="no range partition"):
        placed(spark, bounded, [(25,)], "id int")
    dates = Layout(RangePartition(["d"], [("old", date(1999, 5, 17)), ("new", MAXVALUE)]))
    assert placed(spark, dates, [(date(1999, 5, 16),), (date(1999, 5, 17),)], "d date") == [("old",), ("new",)]
    assert by_id.first.overlapping(low=25) == ["rest"] and by_id.first.overlapping(high=-5) == ["few"]
    assert by_id.first.overlapping(5, 200) == ["some", "rest"]


def test_list_partitions(spark):
    layout = Layout(ListPartition("c", [("p0", [1, 2]), ("p1", DEFAULT)]))
    assert placed(spark, layout, [(1,), (5,), (None,)], "c int") == [("p0",), ("p1",), ("p1",)]
    names = Layout(ListPartition(["a", "b"], [("p0", [("x", 1), ("y", 2)])]))
    assert placed(spark, names, [("y", 2)], "a string, b int") == [("p0",)]
    with pytest.raises(Exception, match="no list partition"):
        placed(spark, names, [("y", 1)], "a string, b int")
    assert layout.first.holding(2) == ["p0"] and layout.first.holding(9) == ["p1"]


def test_hash_and_key_partitions(spark):
    assert placed(spark, Layout(HashPartition("c", 11)), [(24,), (-1,), (None,)], "c int") == [("p2",), ("p10",), ("p0",)]
    named = HashPartition("c", part_names=["a", "b", "c"])
    assert placed(spark, Layout(named), [(4,)], "c int") == [("b",)]
    assert HashPartition("c", 2, ["a", "b", "c"]).names == ["p0", "p1"]
    df = Layout(KeyPartition(["id", "s"], 10)).assign(spark.range(5000).withColumn("s", F.col("id").cast("string")))
    counts = {r["_p0"]: r["count"] for r in df.groupBy("_p0").count().collect()}
    assert set(counts) == {f"p{i}" for i in range(10)} and sum(counts.values()) == 5000
    assert max(counts.values()) < 1.3 * min(counts.values())


def test_two_levels(spark):
    layout = Layout(
        ListPartition(["col1"], [("p0", [1, 2]), ("p1", [3])]),
        RangePartition(["col2"], [("s0", 100), ("s1", MAXVALUE)]),
    )
    assert placed(spark, layout, [(1, 50), (3, 100)], "col1 long, col2 long") == [("p0", "s0"), ("p1", "s1")]
    with pytest.raises(ValueError):
        Layout(layout)


def test_layout_survives_json():
    layout = Layout(
        RangePartition(["d"], [("a", date(2007, 1, 1)), ("b", datetime(2008, 1, 1)), ("c", MAXVALUE)]),
        ListPartition("x", [("l", ["u", "v"]), ("m", DEFAULT)]),
    )
    spec = sc.TableSpec([sc.field("d", "date"), sc.field("x", "string")], ("d",), layout=layout)
    back = sc.TableSpec.from_json(spec.to_json()).layout
    assert back.first.names == ["a", "b", "c"] and back.first.bounds[2][1] is MAXVALUE
    assert back.first.bounds[0][1] == date(2007, 1, 1) and back.second.items[1][1] is DEFAULT


# --- stored tables ---------------------------------------------------------------------------


@pytest.fixture()
def stored(spark):
    """Rows 12, 90 in p0 and 112, 190 in p1."""
    df = spark.createDataFrame([(12, 32), (90, 1), (112, 19), (190, 22)], "id long, tag int")
    layout = Layout(RangePartition("id", [("p0", 100), ("p1", 200), ("p2", 300)]))
    table = VersionedTable(spark, scratch_path(spark, "stored"))
    table.create(df, sc.TableSpec(df.schema.fields, ("id",), layout=layout))
    return table


def test_mutation_in_partitions(stored):
    data = stored.read(["p0"], with_partitions=True)
    stored.replace_partition("p0", mutate.delete(data, [12, 112], partition="p0").drop("_p0"))
    assert rows(stored.read(), "id") == [(90, 1), (112, 19), (190, 22)]
    stored.replace(mutate.delete(stored.read(), where="tag % 2 = 0"))
    assert rows(stored.read(), "id") == [(90, 1), (112, 19)]
    stored.replace(mutate.delete(stored.read(), [90, 112], "tag = 19"))
    assert rows(stored.read(), "id") == [(90, 1)]
    assert stored.read(["p1"]).count() == 0


def test_partition_may_become_empty(stored):
    stored.replace_partition("p1", mutate.delete(stored.read(["p1"])))
    assert rows(stored.read(), "id") == [(12, 32), (90, 1)]
    with pytest.raises(Exception, match="left its partition"):
        stored.replace_partition("p0", mutate.update(stored.read(["p0"]), {"id": "id + 100"}))
    assert rows(stored.read(), "id") == [(12, 32), (90, 1)]


def test_sub_partitions_that_lose_their_rows_go(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "id long, tag int")
    layout = Layout(RangePartition("id", [("p0", 15), ("p1", MAXVALUE)]), HashPartition("tag", 3))
    table = VersionedTable(spark, scratch_path(spark, "sub"))
    table.create(df, sc.TableSpec(df.schema.fields, ("id",), layout=layout))
    table.replace_partition("p0", mutate.delete(table.read(["p0"]), where="tag = 1"))
    assert {r["id"] for r in table.read().collect()} == {i for i in range(30) if i >= 15 or i % 3 != 1}
    assert {r["id"] for r in table.read(["p1sp2"]).collect()} == {i for i in range(15, 30) if i % 3 == 2}


def test_partition_reads_prune(stored):
    plan = stored.read(["p1"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_p0" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_versions_and_unfinished_writes(spark, stored):
    before = stored.version
    stored.replace(stored.read().where("id < 100"))
    assert stored.version == before + 1 and row_count(stored.read()).first()["row_count"] == 2
    spark.range(3).write.parquet(stored.path(before + 2))  # a job that never committed
    assert stored.version == before + 1
    stored.replace(stored.read())
    assert stored.version == before + 3
    stored.create(spark.range(1).withColumn("tag", F.lit(1)), stored.spec)  # exists: nothing happens
    assert stored.read().count() == 2


def test_schema_evolution(spark):
    df = spark.range(3)
    table = VersionedTable(spark, scratch_path(spark, "evolve"))
    table.create(df, sc.TableSpec(df.schema.fields, ("id",)))
    table.add_columns([sc.field("name", "string", True), sc.field("age", "int", True)])
    assert table.read().columns == ["id", "name", "age"] and table.read().where("name is null").count() == 3
    table.append(spark.createDataFrame([(9, "x", 4)], "id long, name string, age int"))
    table.drop_columns(["age"])
    assert rows(table.read(), "id")[-1] == (9, "x")
    with pytest.raises(ValueError):
        table.drop_columns(["id"])


# --- reads and mutations -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [("abc", 1), ("bcd", 2), ("cde", 3), ("def", 4)], "id string, page int"
    ).withColumn("meta", F.to_json(F.struct("page"))).drop("page")


def test_get_after_delete(people):
    left = mutate.delete(people, ["bcd", "def"])
    page = read.json_number("meta", "$.page")
    found = read.get_rows(left, ["abc", "bcd", "cde", "def"], page > 1, ["id"])
    assert rows(found, "id") == [("cde",)]


def test_long_id_lists(spark):
    df = spark.range(5000)
    assert read.get_rows(df, list(range(0, 4000, 2))).count() == 2000
    assert read.with_ids(df, list(range(0, 4000, 2)), "id", keep=False).count() == 3000
    assert read.get_rows(df, 7).collect() == [(7,)]
    with pytest.raises(ValueError):
        read.get_rows(df, 7, primary_key=("id", "other"))


def test_arrays(spark):
    df = spark.createDataFrame(
        [("Alice", ["tag1", "tag2"]), ("Bob", ["tag2", "tag3"]), ("Charlie", ["tag1"])], "name string, arr array<string>"
    )
    assert rows(read.query_rows(df, "array_contains(arr, 'tag1')", ["name"]), "name") == [("Alice",), ("Charlie",)]


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, None, 3.0)], "id long, s string, d double")


def test_insert(spark, base):
    new = spark.createDataFrame([(4, "d")], "id long, s string")
    assert rows(mutate.insert(base, new, "id"), "id")[-1] == (4, "d", None)
    with pytest.raises(ValueError, match="duplicate"):
        mutate.insert(base, spark.createDataFrame([(3, "d")], "id long, s string"), "id")
    with pytest.raises(ValueError, match="duplicate"):
        mutate.insert(base, spark.createDataFrame([(5, "d"), (5, "e")], "id long, s string"), "id")
    none = spark.createDataFrame([], base.schema)
    assert rows(mutate.insert(base, none, "id"), "id") == rows(base, "id")


def test_upsert(spark, base):
    new = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (9, "z", 1)], "id long, s string, at int")
    once = mutate.upsert(base, new, "id", "at", {"d": "0.5D"})
    assert rows(once, "id") == [(1, "a", 1.0), (2, "y", 0.5), (3, None, 3.0), (9, "z", 0.5)]
    twice = mutate.upsert(once, new, "id", "at", {"d": "0.5D"})
    assert rows(twice, "id") == rows(once, "id")
    composite = mutate.upsert(base, spark.createDataFrame([(1, "a", 8.0), (1, "q", 9.0)], base.schema), ("id", "s"))
    assert rows(composite, "id", "s")[:2] == [(1, "a", 8.0), (1, "q", 9.0)]


def test_update_and_delete_with_nulls(base):
    changed = mutate.update(base, {"s": "upper(s)", "d": F.col("id") * 2}, "d > 0 OR s = 'zz'")
    assert rows(changed, "id") == [(1, "A", 2.0), (2, "b", None), (3, None, 6.0)]
    swapped = mutate.update(base, {"id": "id + 1", "d": "CAST(id AS DOUBLE)"})
    assert rows(swapped, "id") == [(2, "a", 1.0), (3, "b", 2.0), (4, None, 3.0)]
    assert [r[0] for r in rows(mutate.delete(base, where="d > 0"), "id")] == [2]
    assert mutate.delete(base).count() == 0
    assert [r[0] for r in rows(mutate.delete(base, [1, 3], "d = 3"), "id")] == [1, 2]
    with pytest.raises(ValueError):
        mutate.delete(base, [1], primary_key=("id", "s"))


def test_delete_undoes_insert(spark, base):
    new = spark.createDataFrame([(7, "n", 0.0), (8, "m", 1.0)], base.schema)
    back = mutate.delete(mutate.insert(base, new, "id"), new)
    assert rows(back, "id") == rows(base, "id")
    part = mutate.delete(mutate.insert(base, new, "id"), new, where="d > 0.5")
    assert rows(part, "id") == rows(base, "id") + [(7, "n", 0.0)]

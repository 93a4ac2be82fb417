"""Which partition each row falls into."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from vecspark.operators.partition import (
    DEFAULT,
    MAXVALUE,
    HashPartition,
    KeyPartition,
    Layout,
    ListPartition,
    RangePartition,
)
from vecspark.queries.registry import query, table


@query(
    "part_range",
    """
    SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 250000 THEN 'middle' ELSE 'large' END AS _p0
    FROM orders
    """,
)
def part_range(spark, sf_dir):
    layout = Layout(RangePartition("o_totalprice", [("small", 50000), ("middle", 250000), ("large", MAXVALUE)]))
    return layout.assign(table(spark, sf_dir, "orders")).select("o_orderkey", "_p0")


@query(
    "part_range_columns",
    """
    SELECT o_orderkey, CASE
        WHEN o_orderdate < TIMESTAMP '1996-06-01' THEN 'p0'
        WHEN o_orderdate = TIMESTAMP '1996-06-01' AND o_custkey < 500 THEN 'p0'
        WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'p1'
        WHEN o_orderdate = TIMESTAMP '1999-01-01' THEN 'p1'
        ELSE 'p2' END AS _p0
    FROM orders
    """,
)
def part_range_columns(spark, sf_dir):
    bounds = [
        ("p0", (datetime(1996, 6, 1), 500)), ("p1", (datetime(1999, 1, 1), MAXVALUE)), ("p2", (MAXVALUE, MAXVALUE))
    ]
    layout = Layout(RangePartition(["o_orderdate", "o_custkey"], bounds))
    return layout.assign(table(spark, sf_dir, "orders")).select("o_orderkey", "_p0")


@query(
    "part_list",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'a' WHEN c_mktsegment = 'FURNITURE' THEN 'b' ELSE 'other' END AS _p0
    FROM customer
    """,
)
def part_list(spark, sf_dir):
    items = [("a", ["BUILDING", "MACHINERY"]), ("b", ["FURNITURE"]), ("other", DEFAULT)]
    layout = Layout(ListPartition("c_mktsegment", items))
    return layout.assign(table(spark, sf_dir, "customer")).select("c_custkey", "_p0")


@query(
    "part_hash",
    """
    SELECT concat('p', (l_orderkey + l_linenumber) % 60) AS _p0, count(*)::BIGINT AS n, sum(l_partkey)::BIGINT AS keys
    FROM lineitem GROUP BY 1
    """,
)
def part_hash(spark, sf_dir):
    placed = Layout(HashPartition("l_orderkey + l_linenumber", 60)).assign(table(spark, sf_dir, "lineitem"))
    return placed.groupBy("_p0").agg(F.count("*").alias("n"), F.sum("l_partkey").alias("keys"))


@query("part_key")
def part_key(spark, sf_dir):
    placed = Layout(KeyPartition(["l_orderkey", "l_linenumber"], 10)).assign(table(spark, sf_dir, "lineitem"))
    return placed.groupBy("_p0").agg(F.count("*").alias("n"), F.sum("l_partkey").alias("keys"))


@query(
    "part_two_level",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'old' ELSE 'new' END AS _p0,
           concat('p', o_custkey % 3) AS _p1
    FROM orders
    """,
)
def part_two_level(spark, sf_dir):
    layout = Layout(
        RangePartition(["o_orderdate"], [("old", datetime(1998, 1, 1)), ("new", MAXVALUE)]),
        HashPartition("o_custkey", 3),
    )
    return layout.assign(table(spark, sf_dir, "orders")).select("o_orderkey", "_p0", "_p1")


@query(
    "part_key_properties",
    """
    SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys, 10::BIGINT AS n_parts,
           1::BIGINT AS most_parts_of_a_key, true AS balanced
    FROM lineitem
    """,
)
def part_key_properties(spark, sf_dir):
    """Key partitions are complete, disjoint, stable under another order of the rows, and balanced."""
    keys = ["l_orderkey", "l_linenumber"]
    layout, rows = Layout(KeyPartition(keys, 10)), table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    placed = layout.assign(rows).withColumn("again", F.lit(0))
    placed = placed.unionByName(layout.assign(rows.repartition(7, "l_linenumber")).withColumn("again", F.lit(1)))
    by_key = placed.groupBy(*keys).agg(
        F.count_if(F.col("again") == 0).alias("n"), F.min("_p0").alias("part"), F.size(F.collect_set("_p0")).cast("long").alias("parts")
    )
    by_part = by_key.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("keys"), F.max("parts").alias("parts"))
    return by_part.agg(
        F.sum("n").alias("n_rows"), F.sum("keys").alias("n_keys"), F.count("*").alias("n_parts"),
        F.max("parts").alias("most_parts_of_a_key"), (F.max("n") <= 1.2 * F.avg("n")).alias("balanced"),
    )

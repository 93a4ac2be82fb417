"""Insert, upsert, update and delete on ``customer``, with batches from other tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.operators import mutate
from vecspark.operators.partition import KeyPartition, Layout, ListPartition
from vecspark.queries.registry import query, table
from vecspark.session import scratch_path
from vecspark.sources.schema import TableSpec
from vecspark.sources.tables import ConcurrentChange, VersionedTable
from vecspark.workspace import Workspace


@query(
    "dml_insert",
    """
    SELECT * FROM customer
    UNION ALL SELECT 1000000000 + s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier
    """,
)
def dml_insert(spark, sf_dir):
    new = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1000000000).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
    )
    return mutate.insert(table(spark, sf_dir, "customer"), new, "c_custkey")


@query(
    "dml_upsert",
    """
    WITH batch AS (
        SELECT o_custkey, o_totalprice, o_orderkey,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
        FROM orders WHERE o_orderstatus = 'F'),
    latest AS (SELECT * FROM batch WHERE rn = 1)
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM latest)
    UNION ALL SELECT o_custkey, concat('Order ', o_orderkey), NULL, o_totalprice, 'NEW' FROM latest
    """,
)
def dml_upsert(spark, sf_dir):
    """The batch holds many rows per key: the last order of a customer wins."""
    batch = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("c_custkey"), F.concat(F.lit("Order "), "o_orderkey").alias("c_name"),
        F.col("o_totalprice").alias("c_acctbal"), "o_orderkey",
    )
    return mutate.upsert(
        table(spark, sf_dir, "customer"), batch, "c_custkey", "o_orderkey", {"c_mktsegment": "'NEW'"}
    )


@query(
    "dml_update",
    """
    SELECT c_custkey, CASE WHEN hit THEN upper(c_name) ELSE c_name END AS c_name, c_nationkey,
           round(CASE WHEN hit THEN c_acctbal * 1.1 + c_nationkey ELSE c_acctbal END, 4) AS c_acctbal, c_mktsegment
    FROM (SELECT *, c_mktsegment = 'BUILDING' AND c_acctbal > 0 AS hit FROM customer)
    """,
)
def dml_update(spark, sf_dir):
    changed = mutate.update(
        table(spark, sf_dir, "customer"),
        {"c_name": F.upper("c_name"), "c_acctbal": "c_acctbal * 1.1D + c_nationkey"},
        ["c_mktsegment = 'BUILDING'", F.col("c_acctbal") > 0],
    )
    return changed.withColumn("c_acctbal", F.round("c_acctbal", 4))


@query(
    "dml_delete_ids",
    "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)",
)
def dml_delete_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return mutate.delete(table(spark, sf_dir, "customer"), ids, primary_key="c_custkey")


@query("dml_delete_pred", "SELECT * FROM customer WHERE NOT (c_acctbal < 0 OR c_nationkey = 7)")
def dml_delete_pred(spark, sf_dir):
    return mutate.delete(table(spark, sf_dir, "customer"), where="c_acctbal < 0 OR c_nationkey = 7")


SEGMENT_LAYOUT = Layout(
    ListPartition(
        "c_mktsegment",
        [("homes", ["HOUSEHOLD", "FURNITURE"]), ("works", ["MACHINERY", "AUTOMOBILE", "BUILDING"])],
    )
)


@query(
    "dml_delete_in_partition",
    """
    SELECT * FROM customer WHERE NOT (c_nationkey < 12 AND c_mktsegment IN ('HOUSEHOLD', 'FURNITURE'))
    """,
)
def dml_delete_in_partition(spark, sf_dir):
    """Only the files of one partition are rewritten."""
    customer = table(spark, sf_dir, "customer")
    stored = VersionedTable(spark, scratch_path(spark, "customer-by-segment"))
    stored.create(customer, TableSpec(customer.schema.fields, ("c_custkey",), layout=SEGMENT_LAYOUT))
    stored.replace_partition("homes", mutate.delete(stored.read(["homes"]), where="c_nationkey < 12"))
    return stored.read()


@query(
    "dml_two_writers",
    """
    SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey < 5 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
    FROM customer WHERE c_nationkey < 20
    """,
)
def dml_two_writers(spark, sf_dir):
    """Two writers change the same state: the second is refused, reads again and loses nothing."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    path = scratch_path(spark, "customer-writers")
    VersionedTable(spark, path).create(customer, TableSpec(customer.schema.fields, ("c_custkey",)))
    first, second = VersionedTable(spark, path).pin(), VersionedTable(spark, path).pin()
    late = mutate.delete(second.read(), where="c_nationkey >= 20")
    first.replace(mutate.update(first.read(), {"c_acctbal": "c_acctbal + 1"}, "c_nationkey < 5"))
    try:
        second.replace(late)
    except ConcurrentChange:
        second.pin().replace(mutate.delete(second.read(), where="c_nationkey >= 20"))
    return second.read()


@query(
    "dml_by_key_partitions",
    """
    WITH batch AS (
        SELECT o_custkey AS c_custkey, count(*)::DOUBLE AS n FROM orders WHERE o_totalprice > 400000 GROUP BY o_custkey),
    upserted AS (
        SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)
        UNION ALL SELECT c_custkey, 'large', NULL, n, 'NEW' FROM batch)
    SELECT c_custkey, CASE WHEN c_nationkey = 7 THEN lower(c_name) ELSE c_name END AS c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM upserted WHERE c_custkey NOT IN (SELECT s_suppkey * 3 FROM supplier)
    """,
)
def dml_by_key_partitions(spark, sf_dir):
    """Upsert, update and delete on a table in folders by key: each rewrites the folders that hold a touched row."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    ws = Workspace(spark, scratch_path(spark, "by-key"))
    spec = TableSpec(customer.schema.fields, ("c_custkey",), layout=Layout(KeyPartition(["c_custkey"], 16)))
    ws.create_table("customers", spec)
    ws.insert("customers", customer)
    batch = orders.where("o_totalprice > 400000").groupBy(F.col("o_custkey").alias("c_custkey"))
    batch = batch.agg(F.count("*").cast("double").alias("c_acctbal"))
    ws.upsert("customers", batch.select(
        "c_custkey", F.lit("large").alias("c_name"), F.lit(None).cast(customer.schema["c_nationkey"].dataType).alias("c_nationkey"),
        "c_acctbal", F.lit("NEW").alias("c_mktsegment"),
    ))
    ws.update("customers", {"c_name": "lower(c_name)"}, "c_nationkey = 7")
    ws.delete("customers", table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 3).alias("c_custkey")))
    return ws.read("customers").select(*customer.columns)

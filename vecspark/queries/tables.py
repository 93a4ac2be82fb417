"""Table layout, schema checks and text ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from vecspark.queries.reads import YEAR_LAYOUT
from vecspark.queries.registry import query, table
from vecspark.session import scratch_path
from vecspark.sources import ingest
from vecspark.sources.schema import TableSpec, field, varchar_field, vector_field, violations
from vecspark.sources.tables import VersionedTable, row_count


@query(
    "write_partitioned",
    """
    SELECT *, CASE WHEN year(o_orderdate) < 1996 THEN 'y95' WHEN year(o_orderdate) < 1998 THEN 'y97' ELSE 'rest' END AS _p0
    FROM orders
    """,
)
def write_partitioned(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    stored = VersionedTable(spark, scratch_path(spark, "orders-written"))
    stored.create(orders, TableSpec(orders.schema.fields, ("o_orderkey",), layout=YEAR_LAYOUT))
    return stored.read(with_partitions=True)


@query(
    "conform_violations",
    """
    WITH keys AS (SELECT count(*) - 1 AS extra FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1),
    found AS (
        SELECT 'lineitem' AS tbl, 'l_orderkey,l_linenumber' AS field, 'unique' AS rule, sum(extra)::BIGINT AS bad_rows FROM keys
        UNION ALL SELECT 'customer', 'c_mktsegment', 'max_length', count(*) FILTER (length(c_mktsegment) > 9) FROM customer
        UNION ALL SELECT 'orders', 'o_orderpriority', 'type', count(*) FILTER (TRY_CAST(o_orderpriority AS INTEGER) IS NULL) FROM orders
        UNION ALL SELECT 'embeddings', 'embedding', 'dim', count(*) FILTER (len(embedding) <> 32) FROM embeddings)
    SELECT tbl, field, rule, bad_rows FROM found WHERE bad_rows > 0
    """,
)
def conform_violations(spark, sf_dir):
    specs = {
        "lineitem": TableSpec(
            [field("l_orderkey", "bigint"), field("l_linenumber", "int"), field("l_quantity", "double")],
            ("l_orderkey", "l_linenumber"),
        ),
        "customer": TableSpec([field("c_custkey", "bigint"), varchar_field("c_mktsegment", 9)], ("c_custkey",)),
        "orders": TableSpec([field("o_orderkey", "bigint"), field("o_orderpriority", "int", True)], ("o_orderkey",)),
        "embeddings": TableSpec([field("vec_id", "bigint"), vector_field("embedding", 32)], ("vec_id",)),
    }
    result = None
    for name, spec in specs.items():
        rows = table(spark, sf_dir, name).select(spec.names)
        found = violations(rows, spec).select(F.lit(name).alias("tbl"), "field", "rule", "bad_rows")
        result = found if result is None else result.unionByName(found)
    return result


def _stored_customer(spark, sf_dir, label):
    customer = table(spark, sf_dir, "customer")
    stored = VersionedTable(spark, scratch_path(spark, label))
    stored.create(customer, TableSpec(customer.schema.fields, ("c_custkey",)))
    return stored


@query("ddl_add_columns", "SELECT *, NULL::VARCHAR AS note, NULL::INTEGER AS age FROM customer")
def ddl_add_columns(spark, sf_dir):
    stored = _stored_customer(spark, sf_dir, "customer-add")
    stored.add_columns([field("note", "string", True), field("age", "int", True)])
    return stored.read()


@query("ddl_drop_columns", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def ddl_drop_columns(spark, sf_dir):
    stored = _stored_customer(spark, sf_dir, "customer-drop")
    stored.drop_columns(["c_nationkey", "c_mktsegment"])
    return stored.read()


@query("collection_stats", "SELECT count(*)::BIGINT AS row_count FROM embeddings")
def collection_stats(spark, sf_dir):
    return row_count(table(spark, sf_dir, "embeddings"))


@query(
    "ingest_vector_text",
    """
    SELECT vec_id, len(embedding)::INTEGER AS dim, round(list_sum(embedding::DOUBLE[]), 4) AS total,
           round(embedding[1]::DOUBLE, 5) AS head
    FROM embeddings
    """,
)
def ingest_vector_text(spark, sf_dir):
    texts = table(spark, sf_dir, "embeddings").select("vec_id", ingest.vector_to_text("embedding").alias("t"))
    parsed = texts.select("vec_id", ingest.vector_from_text("t", 64).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return parsed.select(
        "vec_id", F.size("v").alias("dim"), F.round(total, 4).alias("total"),
        F.round(F.col("v")[0].cast("double"), 5).alias("head"),
    )


@query(
    "ingest_sparse_text",
    """
    WITH t AS (SELECT vec_id, unnest(list_zip(embedding, range(0, len(embedding)))) AS z FROM embeddings)
    SELECT vec_id, count(*)::INTEGER AS terms, min(z[2])::INTEGER AS first_term, round(sum(z[1]::DOUBLE), 4) AS total
    FROM t WHERE abs(z[1]::DOUBLE) > 0.15 GROUP BY vec_id
    """,
)
def ingest_sparse_text(spark, sf_dir):
    sparse = ingest.sparse_from_dense("embedding", 0.15)
    texts = table(spark, sf_dir, "embeddings").select("vec_id", ingest.sparse_to_text(sparse).alias("t"))
    parsed = texts.select("vec_id", ingest.sparse_from_text("t").alias("m")).where(F.size("m") > 0)
    total = F.aggregate(F.map_values("m"), F.lit(0.0), lambda s, x: s + x.cast("double"))
    return parsed.select(
        "vec_id", F.size("m").alias("terms"), F.array_min(F.map_keys("m")).alias("first_term"),
        F.round(total, 4).alias("total"),
    )


@query(
    "ingest_nested_array",
    """
    SELECT o_orderkey, o_custkey AS inner_value, 2::INTEGER AS outer_size, 1::INTEGER AS last_size FROM orders
    """,
)
def ingest_nested_array(spark, sf_dir):
    text = F.format_string("[[%d,%d],[%d]]", "o_orderkey", "o_custkey", "o_orderkey")
    parsed = table(spark, sf_dir, "orders").select(
        "o_orderkey", ingest.array_from_text(text, T.LongType(), 2).alias("a")
    )
    return parsed.select(
        "o_orderkey", F.col("a")[0][1].alias("inner_value"), F.size("a").alias("outer_size"),
        F.size(F.col("a")[1]).alias("last_size"),
    )

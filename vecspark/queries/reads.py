"""Point reads, filters, projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.operators import read
from vecspark.operators.partition import MAXVALUE, Layout, RangePartition
from vecspark.queries.registry import query, table
from vecspark.session import scratch_path
from vecspark.sources.schema import TableSpec
from vecspark.sources.tables import VersionedTable

ORDER_NAMES = ["o_orderkey", "o_custkey", "o_totalprice"]


@query(
    "get_by_ids",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)
    """,
)
def get_by_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return read.get_rows(table(spark, sf_dir, "orders"), ids, names=ORDER_NAMES, primary_key="o_orderkey")


@query(
    "get_ids_and_pred",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderkey IN (3, 14, 159, 265, 358, 979, 1323) AND o_totalprice > 50000
    """,
)
def get_ids_and_pred(spark, sf_dir):
    return read.get_rows(
        table(spark, sf_dir, "orders"), [3, 14, 159, 265, 358, 979, 1323], F.col("o_totalprice") > 50000,
        ORDER_NAMES, "o_orderkey",
    )


@query(
    "query_filter",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE c_acctbal > 1000 AND c_mktsegment = 'BUILDING' AND c_nationkey < 10
    """,
)
def query_filter(spark, sf_dir):
    return read.query_rows(
        table(spark, sf_dir, "customer"),
        ["c_acctbal > 1000", F.col("c_mktsegment") == "BUILDING", "c_nationkey < 10"],
        ["c_custkey", "c_name"],
    )


@query(
    "project_exprs",
    """
    SELECT p_partkey, p_partkey + 1000 AS key_plus_1000, concat(p_name, ' (', p_size, ')') AS name_size,
           upper(p_brand) AS brand, p_type FROM part
    """,
)
def project_exprs(spark, sf_dir):
    return read.get_rows(
        table(spark, sf_dir, "part"),
        names=["p_name"],
        columns=[
            F.col("p_partkey"),
            (F.col("p_partkey") + 1000).alias("key_plus_1000"),
            "concat(p_name, ' (', p_size, ')') AS name_size",
            F.upper("p_brand").alias("brand"),
        ],
        extra=["p_type"],
    )


@query(
    "json_path_filter",
    """
    SELECT event_id, json_extract_string(props, '$.k')::DOUBLE AS k FROM events
    WHERE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) > 50
    """,
)
def json_path_filter(spark, sf_dir):
    k = read.json_number("props", "$.k")
    return read.query_rows(table(spark, sf_dir, "events"), k > 50, columns=["event_id", k.alias("k")])


@query(
    "array_contains_filter",
    """
    SELECT o_orderkey FROM orders WHERE list_contains([o_orderstatus, o_orderpriority], '1-URGENT')
    """,
)
def array_contains_filter(spark, sf_dir):
    tagged = table(spark, sf_dir, "orders").withColumn("tags", F.array("o_orderstatus", "o_orderpriority"))
    return read.query_rows(tagged, F.array_contains("tags", "1-URGENT"), ["o_orderkey"])


@query(
    "get_limit",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def get_limit(spark, sf_dir):
    return read.get_rows(
        table(spark, sf_dir, "orders"), where="o_orderstatus = 'F'", names=["o_orderkey", "o_totalprice"],
        limit=25, order_by=[F.desc("o_totalprice"), "o_orderkey"],
    )


YEAR_LAYOUT = Layout(RangePartition("year(o_orderdate)", [("y95", 1996), ("y97", 1998), ("rest", MAXVALUE)]))


@query(
    "partition_scoped_read",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE year(o_orderdate) >= 1996 AND year(o_orderdate) < 1998 AND o_totalprice > 100000
    """,
)
def partition_scoped_read(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    stored = VersionedTable(spark, scratch_path(spark, "orders-by-year"))
    stored.create(orders, TableSpec(orders.schema.fields, ("o_orderkey",), layout=YEAR_LAYOUT))
    scoped = stored.read(["y97"], with_partitions=True)
    return read.query_rows(scoped, "o_totalprice > 100000", ["o_orderkey", "o_totalprice"], ["y97"])


# --- functions that reach the engine inside SQL text ------------------------------------


@query(
    "scalar_string",
    """
    SELECT p_partkey, length(p_name)::INTEGER AS name_length, upper(p_name) AS name_upper,
           concat(p_brand, '/', p_type) AS brand_type
    FROM part WHERE p_name LIKE '%ring%'
    """,
)
def scalar_string(spark, sf_dir):
    return read.query_rows(
        table(spark, sf_dir, "part"), "p_name LIKE '%ring%'",
        columns=[
            "p_partkey", "CHAR_LENGTH(p_name) AS name_length", "UPPER(p_name) AS name_upper",
            "CONCAT(p_brand, '/', p_type) AS brand_type",
        ],
    )


@query(
    "scalar_date",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
           strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month
    FROM orders WHERE o_orderdate::DATE >= CAST('1999-03-01' AS DATE) - INTERVAL 1 DAY
    """,
)
def scalar_date(spark, sf_dir):
    return read.query_rows(
        table(spark, sf_dir, "orders"),
        "DATE(o_orderdate) >= CAST('1999-03-01' AS DATE) - INTERVAL '1' DAY",
        columns=[
            "o_orderkey", "CAST(DATE(o_orderdate) AS STRING) AS day",
            "CAST(DATE(o_orderdate + INTERVAL '1' MONTH) AS STRING) AS next_month",
        ],
    )


@query(
    "scalar_math",
    """
    SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS n, sum(l_linenumber * 10 + 1)::BIGINT AS weighted,
           round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
    FROM lineitem WHERE l_linenumber % 2 = 0 OR l_discount IS NULL
    GROUP BY l_returnflag, l_linestatus
    """,
)
def scalar_math(spark, sf_dir):
    rows = read.query_rows(
        table(spark, sf_dir, "lineitem"), "l_linenumber % 2 = 0 OR l_discount IS NULL",
        columns=[
            "l_returnflag", "l_linestatus", "l_linenumber * 10 + 1 AS w", "l_extendedprice * (1 - l_discount) AS r"
        ],
    )
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum("w").cast("bigint").alias("weighted"), F.round(F.sum("r"), 2).alias("revenue")
    )


@query(
    "scalar_coercion",
    """
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) > TRY_CAST('2' AS DOUBLE)
       OR TRY_CAST(o_orderstatus AS DOUBLE) > 0
    """,
)
def scalar_coercion(spark, sf_dir):
    level = F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).try_cast("double")
    return read.query_rows(
        table(spark, sf_dir, "orders"),
        (level > F.lit("2").try_cast("double")) | (F.col("o_orderstatus").try_cast("double") > 0),
        ["o_orderkey", "o_orderpriority"],
    )

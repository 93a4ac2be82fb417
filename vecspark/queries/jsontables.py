"""JSON tables whose documents come from ``orders`` and ``events``.

Each order is one row of a JSON table ``t``; its status is the tenant.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.functions import jsonrules, rules
from vecspark.operators import jsontable as jt
from vecspark.queries.registry import query, table
from vecspark.session import materialise, scratch_path

COLUMNS = [
    jt.JsonColumn.of("c1", "INT"),
    jt.JsonColumn.of("c2", "VARCHAR(30)", default="'ca'"),
    jt.JsonColumn.of("c3", "DECIMAL(10,2)"),
    jt.JsonColumn.of("c4", "TIMESTAMP"),
]

_T = """(SELECT o_orderkey AS jdata_id, o_orderstatus AS user_id, o_custkey AS c1, o_orderpriority AS c2,
        o_totalprice::DECIMAL(10,2) AS c3, o_orderdate AS c4 FROM orders) AS t"""


def store_rows(spark, sf_dir):
    values = {
        "c1": F.col("o_custkey"), "c2": F.col("o_orderpriority"),
        "c3": F.col("o_totalprice").cast("decimal(10,2)"), "c4": F.col("o_orderdate"),
    }
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("user_id"), F.lit("0").alias("admin_id"),
        F.col("o_orderkey").alias("jdata_id"), jt.document(values).alias("jdata"),
    )
    # Stored, as a JSON table is; otherwise Spark would cancel writing against parsing.
    return materialise(rows, "documents")


def _typed(data, columns, with_id=True):
    return jt.typed_rows(data, columns, with_id)


def _sql(spark, view, text):
    view.createOrReplaceTempView("t")
    try:
        return spark.sql(text)
    finally:
        spark.catalog.dropTempView("t")


@query("json_select", f"SELECT c1, c2, c3, c4 FROM {_T} WHERE c3 > 200000 AND c2 LIKE '%URGENT%'")
def json_select(spark, sf_dir):
    view = _typed(store_rows(spark, sf_dir), COLUMNS, False)
    return _sql(spark, view, "SELECT * FROM t WHERE t.c3 > 200000 AND c2 LIKE '%URGENT%'")


@query(
    "json_select_agg",
    f"SELECT c2, count(*)::BIGINT AS n, sum(c3)::DOUBLE AS total, max(c4) AS latest FROM {_T} WHERE length(c2) > 5 GROUP BY c2",
)
def json_select_agg(spark, sf_dir):
    view = _typed(store_rows(spark, sf_dir), COLUMNS, False)
    text = """SELECT c2, COUNT(*) AS n, CAST(SUM(c3) AS DOUBLE) AS total, MAX(c4) AS latest
              FROM t WHERE CHAR_LENGTH(c2) > 5 GROUP BY c2"""
    return _sql(spark, view, text)


@query(
    "json_select_alias_order",
    f"SELECT jdata_id AS row_id, c3 AS amount FROM {_T} WHERE c1 IS NOT NULL OR c2 IS NULL ORDER BY amount DESC, row_id LIMIT 30",
)
def json_select_alias_order(spark, sf_dir):
    view = _typed(store_rows(spark, sf_dir), COLUMNS)
    text = "SELECT jdata_id AS row_id, c3 AS amount FROM t WHERE c1 IS NOT NULL OR c2 IS NULL ORDER BY amount DESC, row_id LIMIT 30"
    return _sql(spark, view, text)


@query("json_select_with_id", f"SELECT jdata_id, c1, c2, c3, c4 FROM {_T} WHERE c4 >= DATE '2000-01-01'")
def json_select_with_id(spark, sf_dir):
    view = _typed(store_rows(spark, sf_dir), COLUMNS)
    return _sql(spark, view, "SELECT * FROM t WHERE c4 >= CAST('2000-01-01' AS DATE)")


@query("json_tenant_scope", f"SELECT jdata_id, c1, c3 FROM {_T} WHERE user_id = 'F' AND c3 < 300000")
def json_tenant_scope(spark, sf_dir):
    view = _typed(jt.scoped(store_rows(spark, sf_dir), "F", "0"), COLUMNS)
    return _sql(spark, view, "SELECT jdata_id, c1, c3 FROM t WHERE c3 < 300000")


@query("json_admin_distinct", "SELECT DISTINCT '0' AS admin_id FROM orders WHERE o_orderstatus = 'O'")
def json_admin_distinct(spark, sf_dir):
    return jt.admin_ids(store_rows(spark, sf_dir), "O")


@query("json_add_column", f"SELECT jdata_id, c1, c2, c3, c4, 'x@y' AS c5, NULL::BIGINT AS c6 FROM {_T}")
def json_add_column(spark, sf_dir):
    actions = [
        jt.AddColumn(jt.JsonColumn.of("c5", "VARCHAR(100)", default="concat('x@', 'y')")),
        jt.AddColumn(jt.JsonColumn.of("c6", "INT")),
    ]
    columns, data = jt.alter_rows(store_rows(spark, sf_dir), COLUMNS, actions)
    return _typed(data, columns)


@query("json_drop_column", f"SELECT jdata_id, c1, c3, c4, NULL::VARCHAR AS gone FROM {_T}")
def json_drop_column(spark, sf_dir):
    columns, data = jt.alter_rows(store_rows(spark, sf_dir), COLUMNS, [jt.DropColumn("c2")])
    gone = F.get_json_object("jdata", "$.c2").alias("gone")
    return data.select("jdata_id", gone).join(_typed(data, columns), "jdata_id")


@query(
    "json_modify_column",
    f"SELECT jdata_id, c1, coalesce(TRY_CAST(split_part(c2, '-', 3) AS BIGINT), 7) AS c2, round(c3, 0)::BIGINT AS c3, c4 FROM {_T}",
)
def json_modify_column(spark, sf_dir):
    actions = [
        jt.ModifyColumn(jt.JsonColumn.of("c3", "INT", default="10")),
        jt.ModifyColumn(jt.JsonColumn.of("c2", "INT", False, default="7")),
    ]
    columns, data = jt.alter_rows(store_rows(spark, sf_dir), COLUMNS, actions)
    return _typed(data, columns)


@query("json_change_column", f"SELECT jdata_id, c1::DECIMAL(10,2) AS owner, c2, c3, c4 FROM {_T}")
def json_change_column(spark, sf_dir):
    columns, data = jt.alter_rows(
        store_rows(spark, sf_dir), COLUMNS, [jt.ChangeColumn("c1", "owner", "DECIMAL(10,2)")]
    )
    return _typed(data, columns)


def _truncated_sql(x: str, scale: int) -> str:
    m = f"{float(10 ** scale)!r}::DOUBLE"
    a = f"abs({x})"
    p = f"({a} * {m})"
    c = f"(134217729.0::DOUBLE * {a})"
    hi = f"({c} - ({c} - {a}))"
    err = f"(({hi} * {m} - {p}) + ({a} - {hi}) * {m})"
    whole = f"(floor({p}) - CASE WHEN floor({p}) = {p} AND {err} < 0 THEN 1 ELSE 0 END)"
    return f"(CASE WHEN {x} < 0 THEN -{whole} / {m} ELSE {whole} / {m} END)"


@query(
    "json_insert",
    f"""
    SELECT c1, c2, c3, c4, 'old' AS origin FROM {_T}
    UNION ALL
    SELECT c_custkey + 1, 'ca', {_truncated_sql('(c_acctbal * 1.1::DOUBLE)', 2)}::DECIMAL(10,2), TIMESTAMP '2024-12-30 03:35:30', 'new'
    FROM customer
    """,
)
def json_insert(spark, sf_dir):
    """Customers inserted into the table of orders: expressions, defaults, truncated decimals."""
    columns = COLUMNS[:3] + [jt.JsonColumn.of("c4", "TIMESTAMP", default="'2024-12-30T03:35:30'")]
    new = table(spark, sf_dir, "customer").selectExpr("c_custkey + 1 AS c1", "c_acctbal * 1.1D AS c3")
    documents = new.select(F.lit("N").alias("user_id"), jt.new_documents(new, columns).alias("jdata"))
    both = store_rows(spark, sf_dir).select("user_id", "jdata").unionByName(documents)
    rows = both.select("user_id", F.from_json("jdata", jt.document_type(columns), {"timestampNTZFormat": jsonrules.TIMESTAMP_FORMAT}).alias("d"))
    origin = F.when(F.col("user_id") == "N", "new").otherwise("old").alias("origin")
    return rows.select("d.*", origin)


@query(
    "json_update",
    f"""
    SELECT jdata_id, CASE WHEN hit THEN c1 * 10 ELSE c1 END AS c1, CASE WHEN hit THEN concat(lower(c2), '!') ELSE c2 END AS c2, c3, c4
    FROM (SELECT *, user_id = 'F' AND c3 > 100000 AND c2 LIKE '%LOW%' AS hit FROM {_T})
    """,
)
def json_update(spark, sf_dir):
    data = jt.update_rows(
        store_rows(spark, sf_dir), COLUMNS, {"c1": "c1 * 10", "c2": "CONCAT(LOWER(c2), '!')"},
        ["c3 > 100000", F.col("c2").like("%LOW%")], user_id="F",
    )
    return _typed(data, COLUMNS)


@query("json_delete", f"SELECT jdata_id, c1, c2, c3, c4 FROM {_T} WHERE NOT (user_id = 'P' AND c1 < 1000)")
def json_delete(spark, sf_dir):
    return _typed(jt.delete_rows(store_rows(spark, sf_dir), COLUMNS, "c1 < 1000", user_id="P"), COLUMNS)


def _order_store(spark, sf_dir):
    """The orders as a stored JSON table of three tenants in eight folders."""
    tables = jt.JsonTables(spark, scratch_path(spark, "tenants"), partitions=8)
    tables.create("orders_of", [
        jt.JsonColumn.of("k", "INT"), jt.JsonColumn.of("cust", "INT"), jt.JsonColumn.of("priority", "VARCHAR(30)"),
    ])
    orders = table(spark, sf_dir, "orders")
    for tenant in ("F", "O", "P"):
        rows = orders.where(F.col("o_orderstatus") == tenant)
        tables.insert("orders_of", rows.select(
            F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("cust"), F.col("o_orderpriority").alias("priority"),
        ), user_id=tenant)
    return tables


_ORDERS_OF = "SELECT o_orderkey::BIGINT AS k, o_custkey::BIGINT AS cust, o_orderpriority AS priority, o_orderstatus AS tenant FROM orders"


@query("json_store_tenant", f"SELECT k, cust, priority FROM ({_ORDERS_OF}) WHERE tenant = 'P'")
def json_store_tenant(spark, sf_dir):
    """One tenant of a stored table: only its folder is read."""
    return _order_store(spark, sf_dir).read("orders_of", "P").withColumns({c: F.col(c).cast("long") for c in ("k", "cust")})


@query(
    "json_store_changes",
    f"""
    SELECT k, CASE WHEN tenant = 'P' AND priority LIKE '%LOW%' THEN cust + 7 ELSE cust END AS cust,
           CASE WHEN cust % 5 = 0 THEN 'fifth' ELSE priority END AS priority
    FROM ({_ORDERS_OF}) WHERE NOT (tenant = 'F' AND priority LIKE '%URGENT%')
    """,
)
def json_store_changes(spark, sf_dir):
    """A change of all tenants, then an update and a delete that rewrite the folder of one tenant each."""
    tables = _order_store(spark, sf_dir)
    tables.update("orders_of", {"priority": "'fifth'"}, "cust % 5 = 0 AND priority NOT LIKE '%URGENT%' AND priority NOT LIKE '%LOW%'")
    tables.update("orders_of", {"cust": "cust + 7", "priority": "CASE WHEN cust % 5 = 0 THEN 'fifth' ELSE priority END"},
                  "priority LIKE '%LOW%'", user_id="P")
    tables.delete("orders_of", "priority LIKE '%URGENT%'", user_id="F")
    tables.update("orders_of", {"priority": "'fifth'"}, "priority <> 'fifth' AND k >= 0 AND cust % 5 = 0", user_id="O")
    tables.update("orders_of", {"priority": "'fifth'"}, "cust % 5 = 0 AND priority LIKE '%LOW%'", user_id="F")
    tables.update("orders_of", {"priority": "'fifth'"}, "cust % 5 = 0 AND priority LIKE '%URGENT%'", user_id="P")
    return tables.read("orders_of").withColumns({c: F.col(c).cast("long") for c in ("k", "cust")})


@query(
    "json_value_rules",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, {_truncated_sql('(l_extendedprice * l_discount)', 2)} AS cut2,
           {_truncated_sql('(0.0 - l_extendedprice * l_tax)', 1)} AS cut1,
           l_returnflag || l_linestatus AS short_text
    FROM lineitem
    """,
)
def json_value_rules(spark, sf_dir):
    two = rules.decimal_value(F.col("l_extendedprice") * F.col("l_discount"), 12, 2)
    one = rules.decimal_value(F.lit(0.0) - F.col("l_extendedprice") * F.col("l_tax"), 12, 1)
    text = rules.varchar_value(F.concat("l_returnflag", "l_linestatus"), 2)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", two.cast("double").alias("cut2"), one.cast("double").alias("cut1"),
        text.alias("short_text"),
    )


@query(
    "json_typed_extract",
    """
    SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS as_int,
           TRY_CAST(json_extract_string(props, '$.k') AS DECIMAL(10,2)) AS as_decimal,
           substring(json_extract_string(props, '$.k'), 1, 1) AS as_text, NULL::INTEGER AS absent
    FROM events
    """,
)
def json_typed_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        jsonrules.json_value("props", "$.k", "INT").alias("as_int"),
        jsonrules.json_value("props", "$.k", "DECIMAL(10,2)").alias("as_decimal"),
        jsonrules.json_value("props", "$.k", "VARCHAR(1)").alias("as_text"),
        jsonrules.json_value("props", "$.missing", "TINYINT").alias("absent"),
    )


@query(
    "json_store_statements",
    """
    SELECT c_mktsegment AS segment, count(*)::BIGINT AS n, sum((c_nationkey + 1)::BIGINT)::BIGINT AS total
    FROM customer WHERE c_nationkey <> 3 GROUP BY c_mktsegment
    """,
)
def json_store_statements(spark, sf_dir):
    """A stored table end to end: create, insert, alter, update, delete, select."""
    store = jt.JsonTables(spark, scratch_path(spark, "json"), user_id="u1")
    store.create("accounts", [jt.JsonColumn.of("segment", "VARCHAR(20)"), jt.JsonColumn.of("nation", "INT")])
    customer = table(spark, sf_dir, "customer")
    store.insert("accounts", customer.selectExpr("c_mktsegment AS segment", "c_nationkey AS nation"))
    store.alter("accounts", jt.ChangeColumn("nation", "place", "INT"))
    store.delete("accounts", "place = 3")
    store.update("accounts", {"place": "place + 1"})
    return store.sql("SELECT segment, COUNT(*) AS n, SUM(place) AS total FROM accounts GROUP BY segment")


def _stored_table(spark, sf_dir, name):
    """The orders as a stored JSON table, inserted as one tenant."""
    store = jt.JsonTables(spark, scratch_path(spark, "json-store"), "u")
    store.create(name, COLUMNS)
    orders = table(spark, sf_dir, "orders")
    store.insert(name, orders.select(
        F.col("o_custkey").alias("c1"), F.col("o_orderpriority").alias("c2"), F.col("o_totalprice").cast("decimal(10,2)").alias("c3"), F.col("o_orderdate").alias("c4"),
    ))
    return store


@query("json_rename", f"SELECT c2, count(*)::BIGINT AS n, sum(c1)::BIGINT AS total FROM {_T} GROUP BY c2")
def json_rename(spark, sf_dir):
    """Rows follow a table that gets another name; the former name is free again."""
    store = _stored_table(spark, sf_dir, "t")
    store.rename("t", "renamed")
    store.create("t", COLUMNS[:1])
    found = store.sql("SELECT c2, count(*) AS n, sum(c1) AS total FROM renamed GROUP BY c2")
    return found.unionByName(store.sql("SELECT CAST(c1 AS STRING) AS c2, 0L AS n, 0L AS total FROM t"))


@query(
    "json_alter_several",
    f"""SELECT price, kind, count(*)::BIGINT AS n, max(c1) AS c1 FROM (
          SELECT round(c3, 0)::BIGINT AS price, 'k-1' AS kind, c1 FROM {_T}) GROUP BY ALL""",
)
def json_alter_several(spark, sf_dir):
    """Four actions, one commit: a column goes, one comes with a default, one gets another name and type."""
    store = _stored_table(spark, sf_dir, "t")
    store.alter(
        "t", jt.DropColumn("c2"), jt.AddColumn(jt.JsonColumn.of("kind", "VARCHAR(9)", default="concat('k-', '1')")),
        jt.ChangeColumn("c3", "price", "INT"), jt.DropColumn("c4"),
    )
    return store.sql("SELECT price, kind, count(*) AS n, max(c1) AS c1 FROM t GROUP BY price, kind")

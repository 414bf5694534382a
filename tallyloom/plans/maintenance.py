"""Table maintenance."""

from pyspark.sql import functions as F

from tallyloom.operators import keyed_table, tables
from tallyloom.plans.registry import Tables, query
from tallyloom.session import scratch_path

_BOOKS = "id bigint not null, title string not null, rating double"


def _book_rows(t: Tables):
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), F.col("c_acctbal").alias("rating")
    )


@query(
    "tbl_create",
    """SELECT 'id' AS "column", 'bigint' AS dtype, 0 AS rows_before, count(*) AS rows_after FROM customer
       UNION ALL SELECT 'title', 'string', 0, count(*) FROM customer
       UNION ALL SELECT 'rating', 'double', 0, count(*) FROM customer""",
)
def created(t: Tables):
    path = scratch_path(t.spark, "books")
    empty = tables.create(t.spark, path, _BOOKS)
    before = empty.agg(F.count("*").cast("int").alias("rows_before"))
    types = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(d).alias("dtype")) for n, d in empty.dtypes])
    rows_before = before.first()[0]
    tables.insert(path, _book_rows(t), _BOOKS)
    filled = t.spark.read.schema(_BOOKS).parquet(path)
    after = filled.agg(F.count("*").alias("rows_after"))
    return after.select(F.inline(types), F.lit(rows_before).alias("rows_before"), "rows_after")


@query(
    "tbl_insert",
    "SELECT c_custkey AS id, c_name AS title, c_acctbal AS rating FROM customer UNION ALL SELECT 1000000000 + s_suppkey, s_name, s_acctbal FROM supplier",
)
def inserted(t: Tables):
    path = scratch_path(t.spark, "books")
    tables.create(t.spark, path, _BOOKS)
    tables.insert(path, _book_rows(t), _BOOKS)
    more = t.supplier.select(
        (1000000000 + F.col("s_suppkey")).alias("id"), F.col("s_name").alias("title"), F.col("s_acctbal").alias("rating")
    )
    tables.insert(path, more, _BOOKS)
    return t.spark.read.schema(_BOOKS).parquet(path)


@query("tbl_select", "SELECT c_custkey, c_name FROM customer WHERE c_nationkey = 3 ORDER BY c_name")
def selected(t: Tables):
    return t.customer.filter("c_nationkey = 3").select("c_custkey", "c_name").orderBy("c_name")


@query("tbl_point", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey = 42")
def by_primary_key(t: Tables):
    return tables.by_key(t.customer.select("c_custkey", "c_name", "c_acctbal"), "c_custkey", 42)


@query(
    "tbl_update",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN 'X' ELSE o_orderstatus END AS o_orderstatus
       FROM orders""",
)
def updated(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    low = t.orders.filter("o_orderpriority = '5-LOW' AND o_orderstatus = 'O'")
    changes = low.select("o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"))
    unknown = changes.withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return tables.update(orders, changes.union(unknown), ["o_orderkey"])


@query("tbl_delete", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 50000")
def deleted(t: Tables):
    small = t.orders.filter("o_totalprice < 50000").select("o_orderkey")
    return tables.delete(t.orders.select("o_orderkey", "o_totalprice"), small, ["o_orderkey"])


@query(
    "tbl_constraints",
    """SELECT 'repeated line' AS rule, count(*) AS broken FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
       UNION ALL SELECT 'repeated name', count(*) FROM (SELECT 1 FROM customer GROUP BY c_name HAVING count(*) > 1)
       UNION ALL SELECT 'order without customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
       UNION ALL SELECT 'customer without urgent order', count(*) FROM customer
                 WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def broken_rules(t: Tables):
    customer_keys = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    found = {
        "repeated line": tables.unique_violations(t.lineitem, ["l_orderkey", "l_linenumber"]),
        "repeated name": tables.unique_violations(t.customer, ["c_name"]),
        "order without customer": tables.orphans(t.orders.select("o_custkey"), customer_keys, ["o_custkey"]),
        "customer without urgent order": tables.orphans(customer_keys, urgent, ["o_custkey"]),
    }
    out = None
    for rule, rows in found.items():
        counted = rows.agg(F.count("*").alias("broken")).select(F.lit(rule).alias("rule"), "broken")
        out = counted if out is None else out.unionByName(counted)
    return out


@query(
    "tbl_constraints_insert",
    # every supplier comes twice, so the new rows repeat their own keys too
    """SELECT c_name AS name, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_name, min(s_acctbal) FROM supplier WHERE s_name NOT IN (SELECT c_name FROM customer) GROUP BY s_name""",
)
def inserted_if_free(t: Tables):
    taken = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    suppliers = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    again = suppliers.withColumn("balance", F.col("balance") + 1)
    return tables.insert_new(taken, suppliers.unionByName(again).unionByName(taken), ["name"])


@query(
    "tbl_insert_checked",
    """SELECT o_orderkey AS id, o_custkey AS customer FROM orders
       UNION ALL SELECT -1 - c_custkey, c_custkey FROM customer""",
)
def inserted_with_keys(t: Tables):
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"))
    more = t.customer.select((-1 - F.col("c_custkey")).alias("id"), F.col("c_custkey").alias("customer"))
    customers = t.customer.select(F.col("c_custkey").alias("customer"))
    return tables.insert_checked(orders, more, ["id"], customers, ["customer"])


def _orders(t: Tables) -> keyed_table.KeyedTable:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return keyed_table.create(orders, scratch_path(t.spark, "orders"), ["o_orderkey"], buckets=16)


@query(
    "tbl_update_buckets",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 = 7 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
       FROM orders""",
)
def updated_in_buckets(t: Tables):
    table = _orders(t)
    changes = table.read().filter("o_orderkey % 1000 = 7").withColumn("o_orderstatus", F.lit("X"))
    table.update(changes.unionByName(changes.withColumn("o_orderkey", -1 - F.col("o_orderkey"))))
    return table.read()


@query("tbl_delete_buckets", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice >= 50000")
def deleted_in_buckets(t: Tables):
    table = _orders(t)
    table.delete(table.read().filter("o_totalprice < 50000").select("o_orderkey"))
    return table.read()


@query(
    "tbl_insert_buckets",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
       UNION ALL SELECT -1 - l_orderkey, min(l_suppkey), 'L', round(min(l_quantity), 2) FROM lineitem WHERE l_linenumber <= 2 GROUP BY l_orderkey""",
)
def inserted_in_buckets(t: Tables):
    table = _orders(t)
    lines = t.lineitem.filter("l_linenumber <= 2").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("s"), F.min("l_quantity").alias("q"))
    new = lines.select(
        (-1 - F.col("l_orderkey")).alias("o_orderkey"), F.col("s").alias("o_custkey"), F.lit("L").alias("o_orderstatus"), F.round("q", 2).alias("o_totalprice")
    )
    taken = table.read().withColumn("o_orderstatus", F.lit("T"))
    table.insert_new(new.unionByName(taken))
    return table.read()

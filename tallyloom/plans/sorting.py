"""Sorts, limits and top-k."""

from pyspark.sql import functions as F

from tallyloom.functions.randomness import keyed_order
from tallyloom.operators.ordering import row_index
from tallyloom.plans.registry import Tables, query


@query(
    "srt_order",
    """SELECT o_orderkey, s AS status, o_totalprice
       FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS s, o_totalprice FROM orders)
       ORDER BY s ASC NULLS LAST, o_totalprice DESC NULLS LAST""",
)
def ordered(t: Tables):
    rows = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_totalprice")
    return rows.orderBy(F.asc_nulls_last("status"), F.desc_nulls_last("o_totalprice"))


@query(
    "srt_key",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderkey DESC",
)
def ordered_by_key(t: Tables):
    return t.orders.select("o_custkey", "o_orderkey", "o_totalprice").orderBy(F.asc("o_custkey"), F.desc("o_orderkey"))


@query(
    "srt_top_k",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
       ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 10""",
)
def top_ten(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return rows.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").limit(10)


@query(
    "srt_shuffle",
    """SELECT c_custkey, row_number() OVER (ORDER BY md5('3|' || c_custkey), c_custkey) - 1 AS position FROM customer""",
)
def shuffled(t: Tables):
    return row_index(t.customer.select("c_custkey"), [keyed_order(F.col("c_custkey"), 3), F.asc("c_custkey")])


@query(
    "srt_array",
    """SELECT vec_id, i - 1 AS place, list_sort(embedding)[i] AS value FROM embeddings, range(1, 65) AS r(i)""",
)
def sorted_arrays(t: Tables):
    rows = t.embeddings.select("vec_id", F.posexplode(F.sort_array("embedding")).alias("place", "value"))
    return rows.withColumn("place", F.col("place").cast("bigint"))

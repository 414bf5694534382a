"""Filters and predicates."""

import datetime as dt

from pyspark.sql import functions as F

from tallyloom.operators import filters
from tallyloom.plans.registry import Tables, query


@query("flt_eq", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def equal(t: Tables):
    return t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_custkey")


@query(
    "flt_cmp",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice >= 50000 AND l_quantity < 40",
)
def compare(t: Tables):
    rows = t.lineitem.filter((F.col("l_extendedprice") >= 50000) & (F.col("l_quantity") < 40))
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "flt_bool",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
       WHERE (o_orderstatus = 'F' AND o_totalprice > 200000) OR o_orderpriority = '2-HIGH'""",
)
def both_or_either(t: Tables):
    keep = ((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 200000)) | (
        F.col("o_orderpriority") == "2-HIGH"
    )
    return t.orders.filter(keep).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("flt_between", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20")
def between(t: Tables):
    return t.part.filter(F.col("p_size").between(10, 20)).select("p_partkey", "p_size")


@query(
    "flt_expr",
    "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_discount = 0 AND l_tax <> 0",
)
def expression(t: Tables):
    return t.lineitem.filter("l_discount = 0 AND l_tax <> 0").select("l_orderkey", "l_partkey")


@query(
    "flt_isin",
    """SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem
       WHERE l_returnflag IN ('A', 'N') AND l_quantity IN (SELECT CAST(i AS DOUBLE) FROM range(20, 35) r(i))""",
)
def member(t: Tables):
    keep = F.col("l_returnflag").isin("A", "N") & filters.in_integer_range(F.col("l_quantity"), 20, 35)
    return t.lineitem.filter(keep).select("l_orderkey", "l_quantity", "l_returnflag")


@query(
    "flt_date_in",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
       WHERE month(o_orderdate) = 3 AND day(o_orderdate) = 17 AND year(o_orderdate) BETWEEN 1989 AND 2027""",
)
def on_birthdays(t: Tables):
    days = filters.on_calendar(t.orders, "o_orderdate", dt.date(1989, 3, 17), dt.date(2027, 3, 17), "1 year")
    return days.select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@query(
    "flt_date_cmp",
    """SELECT o_orderkey, coalesce(d >= DATE '1999-01-01', false) AS recent
       FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS d FROM orders)""",
)
def since_and_rest(t: Tables):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("d"))
    since = F.col("d") >= F.lit("1999-01-01").cast("timestamp_ntz")
    recent = rows.filter(since).select("o_orderkey", F.lit(True).alias("recent"))
    rest = rows.filter(filters.complement(since)).select("o_orderkey", F.lit(False).alias("recent"))
    return recent.unionByName(rest)


@query(
    "flt_key",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_orderkey = 77 AND l_linenumber <= 4",
)
def by_key(t: Tables):
    rows = t.lineitem.filter((F.col("l_orderkey") == 77) & (F.col("l_linenumber") <= 4))
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "flt_key_range",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       WHERE (o_custkey > 200 OR (o_custkey = 200 AND o_orderkey >= 5000))
         AND (o_custkey < 600 OR (o_custkey = 600 AND o_orderkey <= 9000))""",
)
def key_range(t: Tables):
    keep = filters.key_between(["o_custkey", "o_orderkey"], (200, 5000), (600, 9000))
    return t.orders.filter(keep).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "flt_key_range_open",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2000-03-04' AND o_orderdate <= TIMESTAMP '2000-12-31'",
)
def date_range(t: Tables):
    day = F.col("o_orderdate")
    keep = day.between(F.lit("2000-03-04").cast("timestamp_ntz"), F.lit("2000-12-31").cast("timestamp_ntz"))
    return t.orders.filter(keep).select("o_orderkey", "o_totalprice")


@query(
    "flt_position",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 300",
)
def positions(t: Tables):
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return filters.rows_at(t.orders.select("o_orderkey", "o_totalprice"), order, 300, 320)


@query("flt_drop_labels", "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey NOT IN (2, 3)")
def drop_labels(t: Tables):
    return t.nation.filter(~F.col("n_nationkey").isin(2, 3)).select("n_nationkey", "n_name")


@query(
    "flt_col_col",
    "SELECT l_orderkey, l_linenumber, l_tax, l_discount FROM lineitem WHERE l_tax > l_discount",
)
def column_against_column(t: Tables):
    return t.lineitem.filter("l_tax > l_discount").select("l_orderkey", "l_linenumber", "l_tax", "l_discount")


@query("flt_col_col_share", "SELECT round(avg(CAST(l_tax > l_discount AS INTEGER)), 8) AS share FROM lineitem")
def share_kept(t: Tables):
    return t.lineitem.agg(F.round(F.avg((F.col("l_tax") > F.col("l_discount")).cast("int")), 8).alias("share"))


@query(
    "flt_flag",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
       WHERE CAST(o_orderdate AS DATE) = date_trunc('quarter', o_orderdate)""",
)
def quarter_starts(t: Tables):
    days = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return days.filter(F.col("day") == F.trunc("day", "quarter"))


@query(
    "flt_bbox",
    """SELECT event_id, value FROM events
       WHERE value BETWEEN 44.5 AND 54.5 AND CAST(json_extract_string(props, '$.k') AS DOUBLE) BETWEEN 45 AND 55""",
)
def bounding_box(t: Tables):
    k = F.get_json_object("props", "$.k").cast("double")
    return t.events.filter(filters.near(F.col("value"), k, (49.5, 50.0), 5)).select("event_id", "value")


@query(
    "flt_collection",
    """SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x > 0.1)) AS INTEGER) AS high,
              CAST(len(list_filter(embedding, lambda x: x < 0)) AS INTEGER) AS negative FROM embeddings""",
)
def inside_collections(t: Tables):
    e = F.col("embedding")
    return t.embeddings.select(
        "vec_id",
        F.size(F.filter(e, lambda x: x > F.lit(0.1).cast("float"))).alias("high"),
        F.size(F.filter(e, lambda x: x < 0)).alias("negative"),
    )

"""Reshape."""

from pyspark.sql import functions as F

from tallyloom.functions import arrays
from tallyloom.operators import reshape
from tallyloom.plans.registry import Tables, query

_KINDS = ["click", "error", "purchase", "signup", "view"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _daily(t: Tables):
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    return t.events.groupBy(day, "event_type").agg(F.count("*").alias("n"))


@query(
    "rsh_pivot",
    "SELECT strftime(ts, '%Y-%m-%d') AS day, "
    + ", ".join(f"nullif(count(*) FILTER (event_type = '{k}'), 0) AS {k}" for k in _KINDS)
    + " FROM events GROUP BY 1",
)
def pivoted(t: Tables):
    return reshape.pivot_unique(_daily(t), ["day"], "event_type", _KINDS, "n")


@query("rsh_pivot_table", "SELECT c_mktsegment, round(avg(c_acctbal), 6) AS c_acctbal FROM customer GROUP BY 1")
def pivot_mean(t: Tables):
    means = reshape.pivot_table(t.customer, ["c_mktsegment"], "c_acctbal")
    return means.select("c_mktsegment", F.round("c_acctbal", 6).alias("c_acctbal"))


_HEADERS = [f"{flag}_{status}" for flag in "ANR" for status in "FO"]


@query(
    "rsh_pivot_table_cols",
    "SELECT l_suppkey, l_linenumber, "
    + ", ".join(
        f"max(l_extendedprice) FILTER (l_returnflag = '{h[0]}' AND l_linestatus = '{h[2]}') AS \"{h}\"" for h in _HEADERS
    )
    + " FROM lineitem GROUP BY 1, 2",
)
def pivot_two_levels(t: Tables):
    return reshape.pivot_table(
        t.lineitem, ["l_suppkey", "l_linenumber"], "l_extendedprice", F.max, ["l_returnflag", "l_linestatus"], _HEADERS
    )


@query(
    "rsh_melt",
    """UNPIVOT (SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, l_discount FROM lineitem)
       ON l_quantity, l_extendedprice, l_discount INTO NAME measure VALUE amount""",
)
def melted(t: Tables):
    wide = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    return reshape.melt(
        wide, ["l_orderkey", "l_partkey"], ["l_quantity", "l_extendedprice", "l_discount"], "measure", "amount"
    )


@query(
    "rsh_stack",
    """SELECT p_partkey, 'p_size' AS field, CAST(p_size AS DOUBLE) AS value FROM part WHERE p_size >= 25
       UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part WHERE p_retailprice < 1000""",
)
def stacked(t: Tables):
    gaps = t.part.select(
        "p_partkey",
        F.when(F.col("p_size") >= 25, F.col("p_size").cast("double")).alias("p_size"),
        F.when(F.col("p_retailprice") < 1000, F.col("p_retailprice")).alias("p_retailprice"),
    )
    return reshape.stack(gaps, ["p_partkey"], ["p_size", "p_retailprice"], "field", "value")


@query(
    "rsh_unstack",
    "SELECT c_nationkey, "
    + ", ".join(f"round(sum(c_acctbal) FILTER (c_mktsegment = '{s}'), 2) AS {s}" for s in _SEGMENTS)
    + " FROM customer GROUP BY 1",
)
def unstacked(t: Tables):
    long = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.round(F.sum("c_acctbal"), 2).alias("balance"))
    return reshape.unstack(long, ["c_mktsegment"], _SEGMENTS, "balance")


@query(
    "rsh_transpose",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", "
        + ", ".join(f"{f} FILTER (o_orderpriority = '{p}') AS \"{p}\"" for p in _PRIORITIES)
        + " FROM orders"
        for name, f in (
            ("n", "count(*)"),
            ("lowest", "min(o_totalprice)"),
            ("highest", "max(o_totalprice)"),
        )
    ),
)
def transposed(t: Tables):
    by_priority = t.orders.groupBy("o_orderpriority").agg(
        F.count("*").cast("double").alias("n"),
        F.min("o_totalprice").alias("lowest"),
        F.max("o_totalprice").alias("highest"),
    )
    return reshape.transpose(by_priority, "o_orderpriority", _PRIORITIES, ["n", "lowest", "highest"])


@query(
    "rsh_split_explode",
    "SELECT part, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS part FROM part) GROUP BY part",
)
def split_and_count(t: Tables):
    return reshape.split_counts(t.part, "p_name", " ")


@query(
    "rsh_flatten",
    """SELECT vec_id, i - 1 AS place, embedding[i] AS value FROM embeddings, range(1, 65) AS r(i)""",
)
def flattened(t: Tables):
    nested = reshape.cube(F.col("embedding"), 4, 4, 4)
    flat = t.embeddings.select("vec_id", F.posexplode(reshape.flatten_levels(nested, 2)).alias("place", "value"))
    return flat.withColumn("place", F.col("place").cast("bigint"))


@query(
    "rsh_reshape",
    """SELECT vec_id, r AS row, round(list_sum(list_transform(embedding[r * 8 + 1 : r * 8 + 8], lambda x: CAST(x AS DOUBLE))), 8)
         AS row_sum FROM embeddings, range(0, 8) AS t(r)""",
)
def reshaped(t: Tables):
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    rows = t.embeddings.select("vec_id", F.posexplode(arrays.reshape(doubles, 8, 8)).alias("row", "_v"))
    row_sum = F.aggregate("_v", F.lit(0.0), lambda a, x: a + x)
    return rows.select("vec_id", F.col("row").cast("bigint").alias("row"), F.round(row_sum, 8).alias("row_sum"))


_LABELS = (["north", "east", "south", "west"], ["q1", "q2", "q3", "q4"], ["a", "b", "c", "d"])


@query(
    "rsh_cube_rows",
    f"""SELECT vec_id, {list(_LABELS[0])}[i + 1] AS first, {list(_LABELS[1])}[j + 1] AS second,
               {list(_LABELS[2])}[k + 1] AS third, embedding[i * 16 + j * 4 + k + 1] AS value
        FROM embeddings, range(0, 4) AS x(i), range(0, 4) AS y(j), range(0, 4) AS z(k)""",
)
def labelled_cube(t: Tables):
    return reshape.cube_rows(t.embeddings, ["vec_id"], reshape.cube(F.col("embedding"), 4, 4, 4), _LABELS)


@query(
    "rsh_record_kv",
    """SELECT s_suppkey, 's_name' AS header, s_name AS value FROM supplier
       UNION ALL SELECT s_suppkey, 's_nationkey', CAST(s_nationkey AS VARCHAR) FROM supplier""",
)
def header_value_pairs(t: Tables):
    return reshape.record_pairs(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), "s_suppkey")

"""Aggregations."""

from pyspark.sql import functions as F

from tallyloom.operators import aggregates as agg
from tallyloom.operators.ordering import seconds_between
from tallyloom.operators.quantiles import box_stats
from tallyloom.plans.registry import Tables, query


@query(
    "agg_global",
    """SELECT round(avg(l_extendedprice), 6) AS mean, round(sum(l_extendedprice), 2) AS total,
              max(l_extendedprice) AS high, min(l_extendedprice) AS low FROM lineitem""",
)
def overall(t: Tables):
    price = "l_extendedprice"
    return t.lineitem.agg(
        F.round(F.avg(price), 6).alias("mean"),
        F.round(F.sum(price), 2).alias("total"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
    )


@query(
    "agg_group",
    """SELECT l_shipdate, round(coalesce(sum(l_extendedprice), 0), 2) AS revenue FROM lineitem
       GROUP BY l_shipdate ORDER BY l_shipdate""",
)
def per_group(t: Tables):
    sums = agg.keyed(t.lineitem, ["l_shipdate"]).groupBy("l_shipdate")
    return sums.agg(F.round(agg.total("l_extendedprice"), 2).alias("revenue")).orderBy("l_shipdate")


@query(
    "agg_group_all_count",
    """SELECT o_orderpriority, count(o_orderkey) AS o_orderkey, count(nullif(o_orderstatus, 'P')) AS status,
              count(CASE WHEN o_totalprice > 100000 THEN o_totalprice END) AS price
       FROM orders GROUP BY o_orderpriority""",
)
def counts_per_group(t: Tables):
    gaps = t.orders.select(
        "o_orderpriority",
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price"),
    )
    return agg.count_others(gaps, ["o_orderpriority"])


@query(
    "agg_size",
    """SELECT o_custkey, count(*) AS n, (SELECT count(DISTINCT o_custkey) FROM orders) AS n_groups
       FROM orders GROUP BY o_custkey""",
)
def group_sizes(t: Tables):
    return agg.sizes(t.orders, ["o_custkey"])


@query(
    "agg_multi_key",
    """SELECT l_returnflag, l_linestatus, l_linenumber, sum(l_quantity) AS quantity, count(*) AS n
       FROM lineitem GROUP BY ALL""",
)
def several_keys(t: Tables):
    groups = t.lineitem.groupBy("l_returnflag", "l_linestatus", "l_linenumber")
    return groups.agg(F.sum("l_quantity").alias("quantity"), F.count("*").alias("n"))


@query(
    "agg_dict",
    """SELECT l_suppkey, round(sum(l_extendedprice), 2) AS revenue, max(l_discount) AS discount,
              min(l_shipdate) AS first_shipped, count(*) AS n FROM lineitem GROUP BY l_suppkey""",
)
def one_each(t: Tables):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
        F.max("l_discount").alias("discount"),
        F.min("l_shipdate").alias("first_shipped"),
        F.count("*").alias("n"),
    )


@query(
    "agg_multi_col",
    """SELECT c_mktsegment, round(avg(c_custkey), 6) AS c_custkey, round(avg(c_nationkey), 6) AS c_nationkey,
              round(avg(c_acctbal), 6) AS c_acctbal FROM customer GROUP BY 1""",
)
def numeric_means(t: Tables):
    means = agg.numeric_means(t.customer, ["c_mktsegment"])
    return means.select("c_mktsegment", *[F.round(c, 6).alias(c) for c in means.columns if c != "c_mktsegment"])


@query(
    "agg_value_counts",
    """SELECT s AS status, count(*) AS n, round(count(*) * 100.0 / (SELECT count(nullif(o_orderstatus, 'P')) FROM orders), 8)
         AS percent FROM (SELECT nullif(o_orderstatus, 'P') AS s FROM orders) WHERE s IS NOT NULL GROUP BY s""",
)
def frequencies(t: Tables):
    counts = agg.value_counts(t.orders.select(F.nullif("o_orderstatus", F.lit("P")).alias("status")), "status")
    return counts.select("status", "n", F.round("percent", 8).alias("percent"))


@query(
    "agg_first_last",
    """SELECT user_id, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value,
              arg_min(event_type, (ts, event_id)) FILTER (event_type <> 'view') AS first_kind,
              arg_max(event_type, (ts, event_id)) FILTER (event_type <> 'view') AS last_kind
       FROM events GROUP BY user_id""",
)
def first_and_last(t: Tables):
    events = t.events.select("user_id", "ts", "event_id", "value", F.nullif("event_type", F.lit("view")).alias("kind"))
    return agg.first_last(events, ["user_id"], F.struct("ts", "event_id"), ["value", "kind"])


@query("agg_get_group", "SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey = 7")
def one_group(t: Tables):
    return t.supplier.filter("s_nationkey = 7").select("s_suppkey", "s_name")


@query(
    "agg_arg",
    """SELECT 'max' AS which, o_orderkey, o_totalprice FROM (FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1)
       UNION ALL
       SELECT 'min', o_orderkey, o_totalprice FROM (FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1)""",
)
def extreme_rows(t: Tables):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    most = agg.row_of_max(orders, "o_totalprice", F.asc("o_orderkey"))
    least = agg.row_of_min(orders, "o_totalprice", F.asc("o_orderkey"))
    return most.select(F.lit("max").alias("which"), "*").union(least.select(F.lit("min"), "*"))


@query(
    "agg_count_if",
    """SELECT count(*) FILTER (p_type = 'SMALL') AS small, count(*) FILTER (p_size >= 25) AS large,
              count(*) FILTER (length(p_name) > 8) AS long_name FROM part""",
)
def counted(t: Tables):
    return t.part.agg(
        F.count_if(F.col("p_type") == "SMALL").alias("small"),
        F.count_if(F.col("p_size") >= 25).alias("large"),
        F.count_if(F.length("p_name") > 8).alias("long_name"),
    )


@query(
    "agg_share",
    """SELECT p_brand, round(sum(p_retailprice), 2) AS p_retailprice,
              round(sum(p_retailprice) / (SELECT sum(p_retailprice) FROM part), 8) AS share FROM part GROUP BY 1""",
)
def shares(t: Tables):
    s = agg.share_of_total(t.part, "p_brand", "p_retailprice")
    return s.select("p_brand", F.round("p_retailprice", 2).alias("p_retailprice"), F.round("share", 8).alias("share"))


@query("agg_repeats", "SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def repeats(t: Tables):
    return agg.repeated_values(t.documents, "text")


@query(
    "agg_max_ties",
    "SELECT p_partkey, p_size FROM part WHERE p_size = (SELECT max(p_size) FROM part)",
)
def shared_maximum(t: Tables):
    return agg.rows_with_max(t.part.select("p_partkey", "p_size"), "p_size")


@query(
    "agg_dedupe",
    """SELECT DISTINCT ON (o_custkey, o_orderpriority) o_custkey, o_orderpriority, o_orderkey, o_totalprice
       FROM orders ORDER BY o_custkey, o_orderpriority, o_orderdate, o_orderkey""",
)
def deduplicated(t: Tables):
    firsts = agg.keep_first(t.orders, ["o_custkey", "o_orderpriority"], [F.asc("o_orderdate"), F.asc("o_orderkey")])
    return firsts.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")


@query(
    "agg_histogram",
    """WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
            c AS (SELECT CAST(least(floor((o_totalprice - lo) * 10 / (hi - lo)) + 1, 10) AS INTEGER) AS bin, count(*) AS n
                  FROM orders, b GROUP BY 1)
       SELECT CAST(i AS INTEGER) AS bin, round(lo + (i - 1) * (hi - lo) / 10, 4) AS from_value,
              round(lo + i * (hi - lo) / 10, 4) AS to_value, coalesce(n, 0) AS n
       FROM range(1, 11) AS r(i) CROSS JOIN b LEFT JOIN c ON c.bin = i""",
)
def price_histogram(t: Tables):
    h = agg.histogram(t.orders, "o_totalprice")
    return h.select("bin", "n", *[F.round(c, 4).alias(c) for c in ("from_value", "to_value")])


@query(
    "agg_box",
    """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
                         quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3
                  FROM lineitem GROUP BY 1),
            f AS (SELECT l.l_returnflag, q1, median, q3, l_extendedprice AS v,
                         l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
                  FROM lineitem l JOIN q ON l.l_returnflag = q.l_returnflag)
       SELECT l_returnflag, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
              round(any_value(q3), 6) AS q3, min(v) FILTER (inside) AS whisker_low,
              max(v) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
       FROM f GROUP BY l_returnflag""",
)
def box_plot(t: Tables):
    return _rounded_box(box_stats(t.lineitem.select("l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice"))


def _rounded_box(b):
    return b.select(
        "l_returnflag",
        *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")],
        "whisker_low",
        "whisker_high",
        "outliers",
    )


@query(
    "agg_box_spread",
    """WITH v AS (SELECT l_returnflag, CASE WHEN l_linenumber <> 2 THEN l_extendedprice END AS v FROM lineitem),
            q AS (SELECT l_returnflag, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                         quantile_cont(v, 0.75) AS q3 FROM v GROUP BY 1),
            f AS (SELECT v.l_returnflag, q1, median, q3, v, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
                  FROM v JOIN q ON v.l_returnflag = q.l_returnflag WHERE v IS NOT NULL)
       SELECT l_returnflag, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
              round(any_value(q3), 6) AS q3, min(v) FILTER (inside) AS whisker_low,
              max(v) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
       FROM f GROUP BY l_returnflag""",
)
def box_plot_spread(t: Tables):
    # with gaps, and with groups far larger than one buffer is given
    value = F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice")).alias("v")
    return _rounded_box(box_stats(t.lineitem.select("l_returnflag", value), ["l_returnflag"], "v", window_rows=500))


@query(
    "agg_ols",
    """SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
              round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
              round(regr_r2(l_extendedprice, l_quantity), 8) AS r2,
              round((regr_slope(l_extendedprice, l_quantity) * 50000
                     + regr_intercept(l_extendedprice, l_quantity)) / 1000000) * 1000000 AS predicted
       FROM lineitem GROUP BY 1""",
)
def fitted_lines(t: Tables):
    fit = agg.linear_fit(t.lineitem, ["l_returnflag"], "l_quantity", "l_extendedprice", 50000)
    return fit.select(
        "l_returnflag",
        F.round("slope", 4).alias("slope"),
        F.round("intercept", 4).alias("intercept"),
        F.round("r2", 8).alias("r2"),
        "predicted",
    )


@query(
    "agg_interval",
    """SELECT max(s) AS longest, min(s) AS shortest, round(avg(s), 2) AS mean FROM
         (SELECT CAST(epoch(l_shipdate - o_orderdate) AS DOUBLE) AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
)
def delivery_times(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderdate")
    taken = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        seconds_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("s")
    )
    return taken.agg(
        F.max("s").alias("longest"), F.min("s").alias("shortest"), F.round(F.avg("s"), 2).alias("mean")
    )


@query(
    "agg_axis",
    """SELECT sum(l_quantity) AS l_quantity, round(sum(l_discount), 2) AS l_discount, round(sum(l_tax), 2) AS l_tax
       FROM lineitem""",
)
def down_columns(t: Tables):
    return t.lineitem.agg(*[F.round(F.sum(c), 2).alias(c) for c in ("l_quantity", "l_discount", "l_tax")])


@query(
    "agg_axis_rows",
    "SELECT l_orderkey, l_linenumber, round(l_quantity + l_discount + l_tax, 4) AS row_total FROM lineitem",
)
def across_rows(t: Tables):
    across = agg.sum_across(["l_quantity", "l_discount", "l_tax"])
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(across, 4).alias("row_total"))


@query(
    "udaf",
    """SELECT p_type, count(p_name) AS apps, round(avg(p_retailprice), 6) AS rating FROM part GROUP BY p_type""",
)
def named_aggregates(t: Tables):
    chosen = {"apps": (F.count, "p_name"), "rating": (F.avg, "p_retailprice")}
    out = t.part.groupBy("p_type").agg(*[f(c).alias(name) for name, (f, c) in chosen.items()])
    return out.withColumn("rating", F.round("rating", 6))

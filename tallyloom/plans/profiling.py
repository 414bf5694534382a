"""Inspection and profiling."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators import profile, sketches
from tallyloom.operators.quantiles import describe
from tallyloom.plans.registry import Tables, query
from tallyloom.session import scratch_path


@query(
    "prf_shape",
    """SELECT count(*) AS n_rows, 6 AS n_columns,
              'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns,
              'bigint,bigint,string,double,timestamp_ntz,string' AS dtypes FROM orders""",
)
def shape(t: Tables):
    return profile.shape(t.orders)


@query(
    "prf_head_tail",
    """SELECT 'head' AS part, o_orderkey, o_totalprice FROM (FROM orders ORDER BY o_orderkey LIMIT 5)
       UNION ALL
       SELECT 'tail', o_orderkey, o_totalprice FROM (FROM orders ORDER BY o_orderkey DESC LIMIT 5)""",
)
def head_tail(t: Tables):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    first = profile.head(rows, [F.asc("o_orderkey")], 5)
    final = profile.head(rows, [F.desc("o_orderkey")], 5)
    return first.select(F.lit("head").alias("part"), "*").union(final.select(F.lit("tail"), "*"))


_DESCRIBED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "prf_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
            round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
            max({c}) AS max FROM lineitem"""
        for c in _DESCRIBED
    ),
)
def described(t: Tables):
    return _rounded(describe(t.lineitem, _DESCRIBED))


def _rounded(d):
    rounded = [F.round(c, 6).alias(c) for c in ("mean", "std", "q25", "q50", "q75")]
    return d.select("column", "count", "min", "max", *rounded)


@query(
    "prf_describe_spread",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(v) AS "count", round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min,
            round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75,
            max(v) AS max FROM (SELECT CASE WHEN l_linenumber <> 2 THEN {c} END AS v FROM lineitem)"""
        for c in _DESCRIBED
    ),
)
def described_spread(t: Tables):
    # with gaps, and with a table far longer than one buffer is given
    gaps = t.lineitem.select(*[F.when(F.col("l_linenumber") != 2, F.col(c)).alias(c) for c in _DESCRIBED])
    return _rounded(describe(gaps, _DESCRIBED, window_rows=500))


def _orders_with_gaps(t: Tables):
    return t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )


_GAPS = """(SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
                   nullif(o_orderpriority, '5-LOW') AS priority FROM orders)"""


@query(
    "prf_info",
    f"""SELECT 'o_orderkey' AS "column", 'bigint' AS dtype, count(o_orderkey) AS non_null FROM {_GAPS}
        UNION ALL SELECT 'status', 'string', count(status) FROM {_GAPS}
        UNION ALL SELECT 'priority', 'string', count(priority) FROM {_GAPS}""",
)
def info(t: Tables):
    return profile.info(_orders_with_gaps(t))


@query(
    "prf_nulls",
    f"""SELECT 'o_orderkey' AS "column", count(*) - count(o_orderkey) AS nulls, true AS any_null_in_table FROM {_GAPS}
        UNION ALL SELECT 'status', count(*) - count(status), true FROM {_GAPS}
        UNION ALL SELECT 'priority', count(*) - count(priority), true FROM {_GAPS}""",
)
def nulls(t: Tables):
    return profile.null_counts(_orders_with_gaps(t))


@query(
    "prf_duplicates",
    """SELECT doc_id, source FROM (
         SELECT doc_id, source, min(doc_id) OVER (PARTITION BY text, lang) AS first_id FROM documents)
       WHERE doc_id > first_id""",
)
def duplicated_documents(t: Tables):
    return profile.repeated_rows(t.documents, "doc_id", ["text", "lang"]).select("doc_id", "source")


@query(
    "prf_duplicates_count",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def duplicate_lines(t: Tables):
    return profile.duplicate_count(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "prf_nunique",
    """SELECT count(DISTINCT l_partkey) AS l_partkey, count(DISTINCT l_suppkey) AS l_suppkey,
              count(DISTINCT l_shipdate) AS l_shipdate,
              count(DISTINCT nullif(l_returnflag, 'R')) AS l_returnflag FROM lineitem""",
)
def distinct_counts(t: Tables):
    flag = F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag")
    return profile.distinct_counts(t.lineitem.select("l_partkey", "l_suppkey", "l_shipdate", flag))


@query("prf_unique", "SELECT DISTINCT nullif(l_returnflag, 'R') AS l_returnflag FROM lineitem")
def unique(t: Tables):
    return t.lineitem.select(F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag")).distinct()


@query(
    "prf_count",
    f"SELECT count(o_orderkey) AS o_orderkey, count(status) AS status, count(priority) AS priority FROM {_GAPS}",
)
def counts(t: Tables):
    return profile.non_null_counts(_orders_with_gaps(t))


@query("prf_select_dtypes", "SELECT p_partkey, p_size, p_retailprice FROM part")
def numeric_columns(t: Tables):
    return profile.by_type(t.part, include=(T.NumericType,))


@query("prf_select_dtypes_excluded", "SELECT p_name, p_brand, p_type FROM part")
def other_columns(t: Tables):
    return profile.by_type(t.part, exclude=(T.NumericType,))


@query(
    "prf_sample",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('11|' || o_orderkey), o_orderkey LIMIT 50",
)
def sample(t: Tables):
    return profile.sample_rows(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 50, seed=11)


@query(
    "prf_nunique_sketch",
    """SELECT 'user_id' AS "column", count(DISTINCT user_id) AS exact, true AS within_bound FROM events
       UNION ALL SELECT 'event_id', count(DISTINCT event_id), true FROM events
       UNION ALL SELECT 'event_type', count(DISTINCT event_type), true FROM events""",
)
def sketched_counts(t: Tables):
    """Estimates from the days' sketches against the exact counts; the bound is four standard errors."""
    columns, path = ["user_id", "event_id", "event_type"], scratch_path(t.spark, "day-sketches")
    sketches.keep_days(t.events, F.col("ts"), columns, path)
    estimates = sketches.distinct_estimates(t.spark, path, columns).select(*[F.col(c).alias(f"about_{c}") for c in columns])
    both = profile.distinct_counts(t.events.select(*columns)).join(estimates)
    near = [F.abs(F.col(f"about_{c}") - F.col(c)) <= F.greatest(F.lit(1.0), 4 * sketches.standard_error() * F.col(c)) for c in columns]
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("exact"), ok.alias("within_bound")) for c, ok in zip(columns, near, strict=True)]
    return both.select(F.inline(F.array(*rows)))

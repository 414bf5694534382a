"""Window functions."""

from pyspark.sql import functions as F

from tallyloom.operators import ordering
from tallyloom.plans.registry import Tables, query


@query(
    "win_rolling",
    """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
            k AS (SELECT DISTINCT event_type FROM events),
            n AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2),
            g AS (SELECT d.day, k.event_type, coalesce(n.n, 0) AS posts
                  FROM d CROSS JOIN k LEFT JOIN n ON n.day = d.day AND n.event_type = k.event_type)
       SELECT day, event_type, posts, round(CASE WHEN count(*) OVER w = 6 THEN avg(posts) OVER w END, 8) AS smooth
       FROM g WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
)
def rolling(t: Tables):
    daily = t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    # the grid of a pivot filled with 0: every tag on every day that occurs, from
    # the calendar between the first and the last one
    first, last = daily.agg(F.min("day")).scalar(), daily.agg(F.max("day")).scalar()
    calendar = daily.select("event_type").distinct().select("event_type", F.explode(F.sequence(first, last)).alias("day"))
    grid = calendar.join(daily.select("day").distinct(), "day", "left_semi")
    posts = grid.join(daily, ["event_type", "day"], "left").select(
        "day", "event_type", F.coalesce("n", F.lit(0)).alias("posts")
    )
    smooth = ordering.rolling_mean(posts, ["event_type"], [F.asc("day")], "posts", 6, "smooth")
    return smooth.select("day", "event_type", "posts", F.round("smooth", 8).alias("smooth"))


@query(
    "win_top_n",
    """SELECT c_mktsegment, c_custkey, c_acctbal FROM customer
       QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) <= 2""",
)
def two_largest(t: Tables):
    rows = t.customer.select("c_mktsegment", "c_custkey", "c_acctbal")
    return ordering.top_per_group(rows, ["c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")], 2)


@query(
    "win_rank_all",
    """SELECT o_orderkey, row_number() OVER (ORDER BY rating DESC NULLS LAST, o_orderkey) AS ranking
       FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS rating FROM orders)""",
)
def ranking(t: Tables):
    rated = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("rating")
    )
    ranked = ordering.row_index(rated, [F.desc_nulls_last("rating"), F.asc("o_orderkey")], "ranking")
    return ranked.select("o_orderkey", (F.col("ranking") + 1).alias("ranking"))


@query(
    "win_change",
    """WITH c AS (SELECT event_type, CAST(ts AS DATE) AS day, avg(value) AS close FROM events GROUP BY 1, 2),
            p AS (SELECT *, lag(close) OVER (PARTITION BY event_type ORDER BY day) AS previous FROM c)
       SELECT event_type, day, round(abs(close - previous), 6) AS difference,
              round(abs(close - previous) / close * 100, 6) AS percent
       FROM p WHERE abs(close - previous) / close * 100 > 1""",
)
def changes(t: Tables):
    close = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg("value").alias("close"))
    moves = ordering.change_from_previous(close, ["event_type"], [F.asc("day")], "close").filter("percent > 1")
    return moves.select(
        "event_type", "day", F.round("difference", 6).alias("difference"), F.round("percent", 6).alias("percent")
    )


@query(
    "win_lap",
    """SELECT event_id, round(epoch(ts - coalesce(lag(ts) OVER w, ts)), 2) AS lap_seconds,
              round(epoch(ts - min(ts) OVER (PARTITION BY user_id)), 2) AS total_seconds
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def laps(t: Tables):
    timed = ordering.lap_times(t.events.select("user_id", "ts", "event_id"), ["user_id"], "ts", "event_id")
    return timed.select("event_id", "lap_seconds", "total_seconds")


# The same answers with groups far larger than a task is given, and with nulls among the values.
_FEW = 500


@query(
    "win_rank_spread",
    """SELECT o_orderkey, row_number() OVER (ORDER BY rating DESC NULLS LAST, o_orderkey) AS ranking
       FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS rating FROM orders)""",
)
def ranking_spread(t: Tables):
    rated = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("rating")
    )
    order = [F.desc_nulls_last("rating"), F.asc("o_orderkey")]
    ranked = ordering.row_index(rated, order, "ranking", window_rows=_FEW)
    return ranked.select("o_orderkey", (F.col("ranking") + 1).alias("ranking"))


@query(
    "win_total_spread",
    """SELECT event_id, round(sum(CASE WHEN event_id % 3 <> 0 THEN value END) OVER (PARTITION BY event_type ORDER BY event_id), 6) AS total
       FROM events""",
)
def totals_spread(t: Tables):
    rows = t.events.select("event_type", "event_id", "value")
    value = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    summed = ordering.running_total(rows, ["event_type"], [F.asc("event_id")], value, "total", _FEW)
    return summed.select("event_id", F.round("total", 6).alias("total"))


@query(
    "win_lap_spread",
    """SELECT event_id, round(epoch(ts - coalesce(lag(ts) OVER w, ts)), 2) AS lap_seconds,
              round(epoch(ts - min(ts) OVER (PARTITION BY event_type)), 2) AS total_seconds
       FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""",
)
def laps_spread(t: Tables):
    rows = t.events.select("event_type", "ts", "event_id")
    timed = ordering.lap_times(rows, ["event_type"], "ts", "event_id", _FEW)
    return timed.select("event_id", "lap_seconds", "total_seconds")


@query(
    "win_batches",
    "SELECT event_id, ntile(4) OVER (ORDER BY ts, event_id) AS batch FROM events",
)
def batches(t: Tables):
    split = ordering.equal_batches(t.events.select("event_id", "ts"), [F.asc("ts"), F.asc("event_id")], 4)
    return split.select("event_id", "batch")

"""Dates and times."""

from pyspark.sql import functions as F

from tallyloom.functions import dates
from tallyloom.operators.ordering import seconds_between
from tallyloom.plans.registry import Tables, query


@query(
    "dat_parse",
    """SELECT o_orderkey, o_orderdate AS worded, o_orderdate AS iso,
              TIMESTAMP '1900-01-01' + to_minutes(o_orderkey % 1440) AS clock FROM orders""",
)
def parsed(t: Tables):
    minutes = F.col("o_orderkey") % 1440
    clock = F.format_string("%02d:%02d", F.floor(minutes / 60), minutes % 60)
    return t.orders.select(
        "o_orderkey",
        dates.parse(F.date_format("o_orderdate", "MMMM dd, yyyy"), "MMMM dd, yyyy").alias("worded"),
        dates.parse(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("iso"),
        dates.parse_time_of_day(clock, "HH:mm").alias("clock"),
    )


@query(
    "dat_format",
    """SELECT event_id, strftime(ts, '%A, %B %d, %Y %I:%M %p') AS long, strftime(ts, '%m/%d/%y') AS short,
              strftime(ts, '%H:%M:%S') AS clock FROM events""",
)
def formatted(t: Tables):
    return t.events.select(
        "event_id",
        F.date_format("ts", "EEEE, MMMM dd, yyyy hh:mm a").alias("long"),
        F.date_format("ts", "MM/dd/yy").alias("short"),
        F.date_format("ts", "HH:mm:ss").alias("clock"),
    )


_PARTS = ("year", "month", "day", "hour", "minute", "second")


@query(
    "dat_parts",
    "SELECT event_id, "
    + ", ".join(f"CAST({p}(ts) AS INTEGER) AS {p}" for p in _PARTS)
    + ", CAST(dayofyear(ts) AS INTEGER) AS day_of_year FROM events",
)
def parts(t: Tables):
    columns = [getattr(F, p)("ts").alias(p) for p in _PARTS]
    return t.events.select("event_id", *columns, F.dayofyear("ts").alias("day_of_year"))


@query(
    "dat_flags",
    """SELECT o_orderkey, dayname(d) AS weekday, d = last_day(d) AS month_end, day(d) = 1 AS month_start,
              d = date_trunc('quarter', d) AS quarter_start
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def flags(t: Tables):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "EEEE").alias("weekday"),
        dates.is_month_end(d).alias("month_end"),
        (F.day(d) == 1).alias("month_start"),
        dates.is_quarter_start(d).alias("quarter_start"),
    )


@query(
    "dat_shift",
    """SELECT event_id, ts + INTERVAL 9 DAY AS later, ts - INTERVAL 40 DAY AS earlier, ts + INTERVAL 7 MONTH AS months_on,
              ts - INTERVAL 2 YEAR AS years_ago,
              ts + INTERVAL 47 MONTH + INTERVAL 8 DAY + INTERVAL 5 HOUR + INTERVAL 41 MINUTE + INTERVAL 6 SECOND AS mixed
       FROM events""",
)
def shifted(t: Tables):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        dates.shift(ts, days=9).alias("later"),
        dates.shift(ts, days=-40).alias("earlier"),
        dates.shift(ts, months=7).alias("months_on"),
        dates.shift(ts, years=-2).alias("years_ago"),
        dates.shift(ts, years=3, months=11, days=8, hours=5, minutes=41, seconds=6).alias("mixed"),
    )


@query(
    "dat_anchor",
    """SELECT o_orderkey, last_day(d + 1) AS month_end_after, last_day(CAST(d - INTERVAL 1 MONTH AS DATE)) AS month_end_before,
              last_day(CAST(date_trunc('quarter', d + 1) + INTERVAL 2 MONTH AS DATE)) AS quarter_end_after,
              last_day(CAST(date_trunc('month', d + 1) + to_months(CAST((13 - month(d + 1)) % 3 AS INTEGER)) AS DATE)) AS quarter_end_jan,
              CAST(date_trunc('year', d) AS DATE) - 1 AS year_end_before,
              CAST(date_trunc('year', d - 1) AS DATE) AS year_begin_before
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def anchors(t: Tables):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        dates.month_end_after(d).alias("month_end_after"),
        dates.month_end_before(d).alias("month_end_before"),
        dates.quarter_end_after(d).alias("quarter_end_after"),
        dates.quarter_end_after(d, 1).alias("quarter_end_jan"),
        dates.year_end_before(d).alias("year_end_before"),
        dates.year_begin_before(d).alias("year_begin_before"),
    )


@query(
    "dat_diff",
    """SELECT event_id, round(epoch(ts - TIMESTAMP '2024-01-15 06:07:21'), 6) AS seconds,
              ts - TIMESTAMP '2024-01-15 06:07:21' > INTERVAL 11 DAY + INTERVAL 7 HOUR + INTERVAL 40 MINUTE AS much_later
       FROM events""",
)
def differences(t: Tables):
    moment = F.lit("2024-01-15 06:07:21").cast("timestamp_ntz")
    long = F.make_dt_interval(F.lit(11), F.lit(7), F.lit(40), F.lit(0))
    return t.events.select(
        "event_id",
        F.round(seconds_between(moment, F.col("ts")), 6).alias("seconds"),
        (F.col("ts") - moment > long).alias("much_later"),
    )


@query(
    "dat_range",
    """WITH s AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1),
            d AS (SELECT o_custkey, a, b, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d FROM s)
       SELECT o_custkey, CAST(count(*) AS INTEGER) AS days,
              CAST(count(*) FILTER (CAST(d AS DATE) - a = (CAST(d AS DATE) - a) // 2 * 2) AS INTEGER) AS every_second,
              CAST(count(*) FILTER (isodow(d) < 6) AS INTEGER) AS business, CAST(count(*) FILTER (isodow(d) = 7) AS INTEGER) AS sundays,
              CAST(count(*) FILTER (isodow(d) = 5) AS INTEGER) AS fridays,
              CAST(count(*) FILTER (CAST(d AS DATE) = last_day(d)) AS INTEGER) AS month_ends,
              CAST(count(*) FILTER (day(d) = 1) AS INTEGER) AS month_starts,
              CAST(count(*) FILTER (day(d) = 31 AND month(d) = 12) AS INTEGER) AS year_ends,
              max(CAST(d AS DATE)) FILTER (isodow(d) < 6) AS last_business
       FROM d GROUP BY o_custkey""",
)
def ranges(t: Tables):
    spans = t.orders.groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")
    )
    a, b = F.col("a"), F.col("b")
    frequencies = {
        "days": "D", "every_second": "2D", "business": "B", "sundays": "W", "fridays": "W-FRI",
        "month_ends": "M", "month_starts": "MS", "year_ends": "A",
    }
    counted = spans.select("o_custkey", *[dates.date_range(a, b, freq).alias(n) for n, freq in frequencies.items()])
    return counted.select(
        "o_custkey", *[F.size(n).alias(n) for n in frequencies], F.array_max("business").alias("last_business")
    )


_ROW_FREQUENCIES = {
    "W-THU": "isodow(d) = 4", "M": "d = last_day(d)", "MS": "day(d) = 1", "A": "month(d) = 12 AND day(d) = 31",
    "AS": "month(d) = 1 AND day(d) = 1", "2D": "(d - a) % 2 = 0 AND d < a + 15", "B": "isodow(d) < 6 AND d < a + 15",
}


@query(
    "dat_range_rows",
    """WITH s AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1),
            e AS (SELECT o_custkey, a, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM s)
       """
    + " UNION ALL ".join(
        f"SELECT o_custkey, '{f}' AS frequency, d AS day FROM e WHERE {holds}" for f, holds in _ROW_FREQUENCIES.items()
    ),
)
def range_rows(t: Tables):
    spans = t.orders.groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")
    )
    soon = F.least("b", F.date_add("a", 14))
    listed = [
        F.struct(F.lit(f).alias("frequency"), dates.date_range(F.col("a"), soon if f in ("2D", "B") else F.col("b"), f).alias("days"))
        for f in _ROW_FREQUENCIES
    ]
    each = spans.select("o_custkey", F.inline(F.array(*listed)))
    return each.select("o_custkey", "frequency", F.explode("days").alias("day"))


@query(
    "dat_periods",
    """SELECT o_orderkey, 'on' AS direction, CAST(d + CAST(i AS INTEGER) AS DATE) AS day
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders), range(0, 4) AS r(i)
       UNION ALL SELECT o_orderkey, 'back', CAST(d - CAST(i AS INTEGER) AS DATE)
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders), range(0, 3) AS r(i)""",
)
def periods(t: Tables):
    d = F.to_date("o_orderdate")
    listed = F.array(
        F.struct(F.lit("on").alias("direction"), dates.date_periods(d, 4).alias("days")),
        F.struct(F.lit("back").alias("direction"), dates.date_periods(d, 3, True).alias("days")),
    )
    each = t.orders.select("o_orderkey", F.inline(listed))
    return each.select("o_orderkey", "direction", F.explode("days").alias("day"))


@query(
    "dat_range_hours",
    """WITH s AS (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1)
       SELECT user_id, CAST(len(generate_series(a, b, INTERVAL 1 HOUR)) AS INTEGER) AS hourly,
              CAST(len(generate_series(a, b, INTERVAL 6 HOUR)) AS INTEGER) AS six_hourly,
              CAST(len(generate_series(a, b, INTERVAL 75 HOUR)) AS INTEGER) AS mixed FROM s""",
)
def hour_ranges(t: Tables):
    spans = t.events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    a, b = F.col("a"), F.col("b")
    frequencies = {"hourly": "H", "six_hourly": "6H", "mixed": "3D 3H"}
    return spans.select("user_id", *[F.size(dates.date_range(a, b, f)).alias(n) for n, f in frequencies.items()])


@query(
    "dat_zone",
    "SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS local FROM events",
)
def zoned(t: Tables):
    return t.events.select(
        "event_id", F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.col("ts")).alias("local")
    )


@query(
    "dat_days_in_month",
    """SELECT o_orderkey, CAST(day(last_day(make_date(1896 + o_orderkey % 210, 1 + o_orderkey % 12, 1))) AS INTEGER) AS days
       FROM orders""",
)
def month_lengths(t: Tables):
    key = F.col("o_orderkey")
    year, month = (1896 + key % 210).cast("int"), (1 + key % 12).cast("int")
    return t.orders.select("o_orderkey", dates.days_in_month(year, month).alias("days"))


@query("dat_truncate", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def truncated(t: Tables):
    return t.events.select("event_id", F.to_date("ts").alias("day"))


@query(
    "dat_calendar",
    """WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
            w AS (SELECT month, CAST(i AS INTEGER) AS week, month - CAST(dayofweek(month) AS INTEGER) + CAST(i * 7 AS INTEGER) AS s
                  FROM m, range(0, 6) AS r(i))
       SELECT month, week, """
    + ", ".join(
        f"CAST(day(s + {i}) AS INTEGER) AS {n}" for i, n in enumerate(("sun", "mon", "tue", "wed", "thu", "fri", "sat"))
    )
    + " FROM w WHERE s <= last_day(month)",
)
def month_pages(t: Tables):
    months = t.orders.select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")).distinct()
    return dates.month_grid(months, "month")


@query(
    "dat_construct",
    """SELECT o_orderkey, make_date(CAST(year(o_orderdate) + 1 AS INTEGER), 2, CAST(1 + o_orderkey % 28 AS INTEGER)) AS day,
              make_timestamp(year(o_orderdate), month(o_orderdate), day(o_orderdate), o_orderkey % 24, 41, 52.0) AS moment FROM orders""",
)
def constructed(t: Tables):
    d, key = F.col("o_orderdate"), F.col("o_orderkey")
    moment = F.make_timestamp_ntz(
        F.year(d), F.month(d), F.day(d), (key % 24).cast("int"), F.lit(41), F.lit(52).cast("decimal(16,6)")
    )
    return t.orders.select(
        "o_orderkey",
        F.make_date(F.year(d) + 1, F.lit(2), (1 + key % 28).cast("int")).alias("day"),
        moment.alias("moment"),
    )

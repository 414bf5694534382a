"""Calendar expressions against pandas."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import dates

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(0, 800, 3)] + [dt.date(2024, 2, 29), dt.date(2023, 12, 31)]


@pytest.fixture(scope="module")
def days(spark):
    return spark.createDataFrame([(d,) for d in DAYS], "d date")


@pytest.mark.parametrize(
    "column,offset",
    [
        (dates.month_end_after, lambda t: t + pd.offsets.MonthEnd()),
        (dates.month_end_before, lambda t: t - pd.offsets.MonthEnd()),
        (dates.quarter_end_after, lambda t: t + pd.offsets.QuarterEnd()),
        (lambda d: dates.quarter_end_after(d, 1), lambda t: t + pd.offsets.QuarterEnd(startingMonth=1)),
        (dates.year_end_before, lambda t: t - pd.offsets.YearEnd()),
        (dates.year_begin_before, lambda t: t - pd.offsets.YearBegin()),
    ],
)
def test_anchors(days, column, offset):
    for r in days.select("d", column(F.col("d")).alias("a")).collect():
        assert pd.Timestamp(r["a"]) == offset(pd.Timestamp(r["d"])), r["d"]


@pytest.mark.parametrize(
    "start,stop,freq,pandas_freq",
    [
        ("1996-02-29", "2032-02-28", "A", "YE"), ("1999-12-31", "2004-01-01", "AS", "YS"),
        ("2024-02-27", "2024-03-02", "D", "D"), ("2023-02-26", "2023-03-03", "2D", "2D"),
        ("2021-05-08", "2021-05-17", "B", "B"), ("2021-05-09", "2021-05-09", "W", "W"),
        ("2022-07-02", "2022-08-13", "W-FRI", "W-FRI"), ("2022-07-07", "2022-07-07", "W-THU", "W-THU"),
        ("2023-11-30", "2024-03-31", "M", "ME"), ("2024-02-29", "2024-06-29", "M", "ME"),
        ("2019-10-01", "2020-04-01", "MS", "MS"),
    ],
)
def test_date_ranges(spark, start, stop, freq, pandas_freq):
    a, b = F.lit(start).cast("date"), F.lit(stop).cast("date")
    got = spark.range(1).select(dates.date_range(a, b, freq)).first()[0]
    assert got == [t.date() for t in pd.date_range(start, stop, freq=pandas_freq)]


@pytest.mark.parametrize(
    "start,stop,freq,pandas_freq",
    [("2024-02-28", "2024-03-01", "H", "h"), ("2018-12-30", "2019-01-02", "6H", "6h"),
     ("2015-06-11", "2016-03-01", "24D 3H", "24D3h")],
)
def test_timestamp_ranges(spark, start, stop, freq, pandas_freq):
    a, b = F.lit(start).cast("timestamp_ntz"), F.lit(stop).cast("timestamp_ntz")
    got = spark.range(1).select(dates.date_range(a, b, freq)).first()[0]
    assert got == list(pd.date_range(start, stop, freq=pandas_freq).to_pydatetime())


def test_periods(spark):
    row = spark.range(1).select(
        dates.date_periods(F.lit(dt.date(2020, 2, 22)), 9), dates.date_periods(F.lit(dt.date(2021, 3, 4)), 11, True)
    ).first()
    assert row[0] == [t.date() for t in pd.date_range(start="2020-02-22", freq="D", periods=9)]
    assert row[1] == [t.date() for t in pd.date_range(end="2021-03-04", freq="D", periods=11)]


def test_shift_clamps_to_the_month(spark):
    ts = F.lit("2024-01-31 10:00:00").cast("timestamp_ntz")
    assert spark.range(1).select(dates.shift(ts, months=1)).first()[0] == dt.datetime(2024, 2, 29, 10)


def test_days_in_month(spark):
    import calendar

    cases = [(y, m) for y in (1900, 2000, 2023, 2024) for m in range(1, 13)]
    df = spark.createDataFrame(cases, "y int, m int").select("y", "m", dates.days_in_month(F.col("y"), F.col("m")).alias("n"))
    assert all(r["n"] == calendar.monthrange(r["y"], r["m"])[1] for r in df.collect())


def test_month_grid(spark):
    import calendar

    firsts = [dt.date(2024, m, 1) for m in range(1, 13)] + [dt.date(2026, 2, 1)]
    df = dates.month_grid(spark.createDataFrame([(d,) for d in firsts], "m date"), "m")
    got = {(r["m"], r["week"]): list(r)[2:] for r in df.collect()}
    sunday_first = calendar.Calendar(firstweekday=6)
    want = {
        (d, i): [x.day for x in week]
        for d in firsts
        for i, week in enumerate(sunday_first.monthdatescalendar(d.year, d.month))
    }
    assert got == want


def test_bad_dates_are_an_error(spark):
    df = spark.createDataFrame([("August 32, 2020",)], "t string")
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        df.select(dates.parse(F.col("t"), "MMMM dd, yyyy")).collect()


def test_time_of_day_lands_on_1900(spark):
    got = spark.range(1).select(dates.parse_time_of_day(F.lit("13:05"), "HH:mm")).first()[0]
    assert got == dt.datetime(1900, 1, 1, 13, 5)

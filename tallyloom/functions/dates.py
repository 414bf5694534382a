"""Calendar expressions: anchors, ranges, flags and month grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The day each weekly frequency names; that of plain W is Sunday.
_WEEK_DAYS = {"W": "SUN", **{f"W-{d}": d for d in ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")}}


def parse(text: Column, pattern: str | None = None) -> Column:
    """Text to timestamp without zone; unparsable text is an error."""
    return F.to_timestamp_ntz(text) if pattern is None else F.to_timestamp_ntz(text, F.lit(pattern))


def parse_time_of_day(text: Column, pattern: str) -> Column:
    """A bare time, on the day such scripts assume: 1 January 1900."""
    return parse(F.concat(F.lit("1900-01-01 "), text), f"yyyy-MM-dd {pattern}")


def month_end_after(d: Column) -> Column:
    """The month end strictly after ``d``."""
    return F.last_day(F.date_add(d, 1))


def month_end_before(d: Column) -> Column:
    return F.last_day(F.add_months(d, -1))


def quarter_end_after(d: Column, starting_month: int = 3) -> Column:
    """The quarter end strictly after ``d``; ``starting_month`` is one month that ends a quarter."""
    nxt = F.date_add(d, 1)
    to_go = F.pmod(F.lit(starting_month) - F.month(nxt), F.lit(3))
    return F.last_day(F.add_months(F.trunc(nxt, "month"), to_go))


def year_end_before(d: Column) -> Column:
    return F.date_sub(F.trunc(d, "year"), 1)


def year_begin_before(d: Column) -> Column:
    """The first of January strictly before ``d``."""
    return F.trunc(F.date_sub(d, 1), "year")


def is_month_end(d: Column) -> Column:
    return d == F.last_day(d)


def is_quarter_start(d: Column) -> Column:
    return d == F.trunc(d, "quarter")


def shift(ts: Column, years=0, months=0, weeks=0, days=0, hours=0, minutes=0, seconds=0) -> Column:
    """Add calendar and clock amounts; a day past the month's end becomes its last day."""
    parts = [F.lit(x) for x in (years, months, weeks, days, hours, minutes, seconds)]
    return ts + F.make_interval(*parts)


def days_in_month(year: Column, month: Column) -> Column:
    return F.day(F.last_day(F.make_date(year, month, F.lit(1))))


def date_range(start: Column, stop: Column, freq: str) -> Column:
    """An array of the dates of a frequency, both ends included.

    ``D``, ``2D`` and the like, ``B`` (Monday to Friday), ``W`` and ``W-FRI``,
    ``M`` and ``A`` (month and year ends), ``MS`` and ``AS`` (their starts).
    Hour steps and mixtures such as ``24D 3H`` work on timestamps.
    """
    if freq == "B":
        return F.filter(F.sequence(start, stop), lambda d: F.weekday(d) < 5)
    if freq in _WEEK_DAYS:
        return _steps(F.next_day(F.date_sub(start, 1), _WEEK_DAYS[freq]), stop, "7 day")
    if freq in ("M", "MS", "A", "AS"):
        unit, months = ("month", 1) if freq[0] == "M" else ("year", 12)
        if freq.endswith("S"):
            this = F.trunc(start, unit)
            return _steps(F.when(this == start, this).otherwise(F.add_months(this, months)), stop, f"{months} month")
        # the period of the last day wanted is over when the day after ``stop`` opens a new one
        final = F.add_months(F.trunc(F.date_add(stop, 1), unit), -months)
        opened = _steps(F.trunc(start, unit), final, f"{months} month")
        return F.transform(opened, lambda d: F.date_sub(F.add_months(d, months), 1))
    return _steps(start, stop, _step(freq))


def _steps(start: Column, stop: Column, step: str) -> Column:
    """A rising sequence, empty when it would start after its end."""
    rising = F.sequence(start, stop, F.expr(f"interval {step}"))
    return F.when(start <= stop, rising).when(start > stop, F.slice(F.array(start), 1, 0))


def date_periods(first: Column, periods: int, backward: bool = False) -> Column:
    """``periods`` consecutive days from ``first`` on, or up to it."""
    other = F.date_sub(first, periods - 1) if backward else F.date_add(first, periods - 1)
    return F.sequence(other, first) if backward else F.sequence(first, other)


def _step(freq: str) -> str:
    units = {"D": "day", "H": "hour"}
    parts = []
    for piece in freq.split():
        number, unit = piece[:-1] or "1", units[piece[-1]]
        parts.append(f"{number} {unit}")
    return " ".join(parts)


def month_grid(months: DataFrame, first_day: str) -> DataFrame:
    """One row per week of each month, weeks from Sunday, with the spill-over days."""
    first = F.col(first_day)
    sunday = F.date_sub(first, F.dayofweek(first) - 1)
    weeks = F.sequence(sunday, F.last_day(first), F.expr("interval 7 day"))
    rows = months.select(first_day, F.posexplode(weeks).alias("week", "_from"))
    names = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")
    return rows.select(first_day, "week", *[F.day(F.date_add("_from", i)).alias(n) for i, n in enumerate(names)])

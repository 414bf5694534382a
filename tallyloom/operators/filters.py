"""Row filters whose meaning needs more than one comparison."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordering import row_index

# Up to this position the leading rows are kept in a heap per task.
HEAD_ROWS = 100_000

# A calendar longer than this is left to Catalyst to join as it sees fit.
BROADCAST_DAYS = 200_000


def in_integer_range(c: Column, start: int, stop: int) -> Column:
    """Member of ``range(start, stop)``: whole numbers only, the end excluded."""
    return (c >= start) & (c < stop) & (c == F.floor(c))


def key_between(columns: Sequence[str], low: Sequence | None, high: Sequence | None) -> Column:
    """Compound key in an inclusive lexicographic range; either end may be open.

    The bound on the first column alone is stated too, because only that one
    reaches the Parquet row groups.
    """

    def beyond(bound, up: bool) -> Column:
        holds = F.lit(True)
        for name, b in reversed(list(zip(columns, bound))):
            c = F.col(name)
            holds = ((c > b) if up else (c < b)) | ((c == b) & holds)
        first = F.col(columns[0])
        return holds & (first >= bound[0] if up else first <= bound[0])

    keep = F.lit(True)
    if low is not None:
        keep = keep & beyond(low, True)
    if high is not None:
        keep = keep & beyond(high, False)
    return keep


def complement(condition: Column) -> Column:
    """The rows a condition does not keep, those where it is null included."""
    return ~F.coalesce(condition, F.lit(False))


def rows_at(
    df: DataFrame, order: Sequence[Column], start: int, stop: int, head_rows: int = HEAD_ROWS
) -> DataFrame:
    """Rows by position in ``order``, the end excluded."""
    if stop <= head_rows:
        return df.orderBy(*order).offset(start).limit(stop - start)
    indexed = row_index(df, order, "_position")
    return indexed.filter(F.col("_position").between(start, stop - 1)).drop("_position")


def calendar(df: DataFrame, start: dt.date, stop: dt.date, step: str, name: str) -> DataFrame:
    """The dates from ``start`` to ``stop`` by an interval such as ``1 year``."""
    dates = F.sequence(F.lit(start), F.lit(stop), F.expr(f"interval {step}"))
    return df.sparkSession.range(1).select(F.explode(dates).alias(name))


def on_calendar(df: DataFrame, column: str, start: dt.date, stop: dt.date, step: str) -> DataFrame:
    """Keep rows whose date is one of a generated calendar.

    The calendar's ends are stated as a range too, because only that reaches the
    Parquet row groups.
    """
    days = calendar(df, start, stop, step, "_day")
    if (stop - start).days <= BROADCAST_DAYS:
        days = F.broadcast(days)
    end = stop + dt.timedelta(days=1)
    kind = df.schema[column].dataType
    ends = F.col(column).between(F.lit(start).cast(kind), F.lit(end).cast(kind))
    return df.filter(ends).join(days, F.to_date(column) == F.col("_day"), "left_semi")


def near(x: Column, y: Column, centre: tuple[float, float], reach: float) -> Column:
    """Within ``reach`` of a centre on both axes, the edges included."""
    cx, cy = centre
    return x.between(cx - reach, cx + reach) & y.between(cy - reach, cy + reach)

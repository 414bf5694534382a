"""Column cleaning, casting, banding and positional assignment."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordering import WINDOW_ROWS, row_index

# First year, last year (None is open) and name, tested in this order.
# 1925-1927 belong to no generation; 2010 belongs to the first that names it.
GENERATIONS = (
    (1901, 1924, "Greatest Generation (GI)"),
    (1928, 1945, "Silent Generation"),
    (1946, 1964, "Baby Boomer Generation"),
    (1965, 1980, "Generation X"),
    (1981, 1996, "Millennial"),
    (1997, 2010, "Generation Z"),
    (2010, None, "Generation Alpha"),
)
NO_GENERATION = "not recognized"

# Ticket prices by age, and the surcharge for a photo.
MINIMUM_HEIGHT, CHILD_PRICE, YOUTH_PRICE, ADULT_PRICE, PHOTO_PRICE = 60, 5, 7, 12, 3


def money(text: Column) -> Column:
    """``$1,234.50`` as a number; null stays null and other text is an error."""
    return F.regexp_replace(text, "[,$]", "").cast("double")


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def keep_cells(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Blank the cells whose condition does not hold; every row stays."""
    return df.withColumns({c: F.when(cond, F.col(c)) for c, cond in conditions.items()})


def band(value: Column, bands: Sequence[tuple], default: str) -> Column:
    """Name of the first (low, high, name) band holding ``value``, both ends included."""
    chosen = F
    for low, high, name in bands:
        inside = value >= low if high is None else value.between(low, high)
        chosen = chosen.when(inside, F.lit(name))
    return chosen.otherwise(F.lit(default))


def generation(year: Column) -> Column:
    return band(year, GENERATIONS, NO_GENERATION)


def ride_price(height: Column, age: Column, photo: Column) -> Column:
    """Ticket price; null for riders who are too small."""
    ticket = F.when(age < 12, CHILD_PRICE).when(age <= 18, YOUTH_PRICE).otherwise(ADULT_PRICE)
    return F.when(height >= MINIMUM_HEIGHT, ticket + F.when(photo == "Y", PHOTO_PRICE).otherwise(0))


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def column_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Columns from one name to another, both included."""
    at = df.columns
    return df.select(*at[at.index(first) : at.index(last) + 1])


def column_slice(df: DataFrame, start: int, stop: int) -> DataFrame:
    """Columns by position, the end excluded."""
    return df.select(*df.columns[start:stop])


def insert_column(df: DataFrame, at: int, name: str, value: Column) -> DataFrame:
    names = [c for c in df.columns if c != name]
    return df.withColumn(name, value).select(*names[:at], name, *names[at:])


def assign_by_position(
    df: DataFrame,
    order: Sequence[Column],
    values: DataFrame,
    values_order: Sequence[Column],
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add the columns of ``values`` by row position; positions without a partner get null."""
    left = row_index(df, order, "_position", (), window_rows)
    right = row_index(values, values_order, "_position", (), window_rows)
    return left.join(right, "_position", "left").drop("_position")


def columns_by_row(df: DataFrame, row: Column, columns: Sequence[str]) -> DataFrame:
    """Order ``columns`` by their values in the one row picked by ``row``; nulls go last."""
    picked = df.filter(row).select(*columns).first()
    if picked is None:
        raise LookupError("no such row")
    ordered = sorted(columns, key=lambda c: (picked[c] is None, picked[c] if picked[c] is not None else 0))
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, *ordered)


def apply_columns(df: DataFrame, columns: Sequence[str], f: Callable[..., Column], *args, **kwargs) -> DataFrame:
    """``f(column, *args, **kwargs)`` on each of ``columns``, the others kept."""
    return df.withColumns({c: f(F.col(c), *args, **kwargs) for c in columns})

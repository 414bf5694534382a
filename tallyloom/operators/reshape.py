"""Long to wide, wide to long, and nested to flat.

Wide shapes take an explicit list of column values: finding it out would cost a
job of its own and make the schema depend on the data. A value outside the list
is an error, never a lost cell; ``headers`` finds the list out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.arrays import reshape


# The most columns that ``headers`` makes of a table's values.
MOST_HEADERS = 1_000


def headers(df: DataFrame, column: str | Column, most: int = MOST_HEADERS) -> list:
    """The distinct values of a column in order, at most ``most``; more are an error."""
    found = df.select(F.col(column).alias("h") if isinstance(column, str) else column.alias("h")).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} different headers")
    return sorted((r["h"] for r in found if r["h"] is not None), key=lambda h: (str(type(h)), h))


def _only(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """``df``; reading it fails at a header that is not in ``values``. Null is no header."""
    c = F.col(column)
    unknown = F.raise_error(F.concat(F.lit("a header outside the list: "), c.cast("string"))).cast("boolean")
    return df.filter(F.when(c.isNull() | c.isin(*values), F.lit(True)).otherwise(unknown))


def pivot_unique(df: DataFrame, index: Sequence[str], column: str, values: Sequence, value: str) -> DataFrame:
    """One row per index, one column per value; two rows for one cell are an error."""
    repeated = F.raise_error(F.lit(f"several rows for one ({', '.join(index)}, {column})"))
    cell = F.when(F.count(F.lit(1)) > 1, repeated).otherwise(F.first(value))
    return _only(df, column, values).groupBy(*index).pivot(column, list(values)).agg(cell)


def pivot_table(
    df: DataFrame,
    index: Sequence[str],
    value: str,
    f: Callable[[str], Column] = F.avg,
    columns: Sequence[str] = (),
    values: Sequence[str] = (),
) -> DataFrame:
    """Aggregating pivot, the mean by default.

    Several column keys become one flattened header such as ``A_O``, and
    ``values`` names all headers. Rows with a null key count under no header.
    """
    if not columns:
        return df.groupBy(*index).agg(f(value).alias(value))
    # a null key is no header; concat_ws alone would make it an empty one
    header = F.when(F.concat(*[F.col(c).cast("string") for c in columns]).isNotNull(), F.concat_ws("_", *columns))
    headed = _only(df.withColumn("_header", header), "_header", values)
    return headed.groupBy(*index).pivot("_header", list(values)).agg(f(value))


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


def stack(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Like ``melt``, but empty cells leave no row."""
    return melt(df, ids, columns, name, value).filter(F.col(value).isNotNull())


def unstack(df: DataFrame, levels: Sequence[str], values: Sequence[str], value: str) -> DataFrame:
    """Turn one or more row keys into columns; the other columns stay the key."""
    rest = [c for c in df.columns if c not in levels and c != value]
    header = F.concat_ws("_", *levels)
    return pivot_unique(df.withColumn("_header", header), rest, "_header", values, value)


def transpose(df: DataFrame, label: str, labels: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Columns to rows and the rows named by ``labels`` to columns.

    ``labels`` bounds the slice: a table with a column per row must be narrow.
    """
    chosen = df.filter(F.col(label).isin(*labels)).select(label, *columns)
    return pivot_unique(melt(chosen, [label], columns, "column", "value"), ["column"], label, labels, "value")


def split_counts(df: DataFrame, column: str, separator: str) -> DataFrame:
    """Frequency of the parts of a delimited text."""
    parts = df.select(F.explode(F.split(column, separator)).alias("part"))
    return parts.groupBy("part").agg(F.count("*").alias("n"))


def flatten_levels(a: Column, levels: int) -> Column:
    """Remove ``levels`` levels of nesting."""
    for _ in range(levels):
        a = F.flatten(a)
    return a


def cube(a: Column, pages: int, rows: int, columns: int) -> Column:
    """A flat array as pages of rows of columns."""
    sheets = reshape(a, pages, rows * columns)
    return F.transform(sheets, lambda p: reshape(p, rows, columns))


def cube_rows(df: DataFrame, keys: Sequence[str], nested: Column, labels: Sequence[Sequence[str]]) -> DataFrame:
    """A three-level array as labelled long rows, every level named from its own list."""
    names = ("first", "second", "third")
    out = df.select(*keys, nested.alias("_v"))
    seen: list[str] = []
    for name, options in zip(names, labels):
        label = F.get(F.array(*[F.lit(x) for x in options]), F.col("_i"))
        out = out.select(*keys, *seen, F.posexplode("_v").alias("_i", "_w"))
        out = out.select(*keys, *seen, label.alias(name), F.col("_w").alias("_v"))
        seen.append(name)
    return out.withColumnRenamed("_v", "value")


def record_pairs(df: DataFrame, key: str) -> DataFrame:
    """Every record as (header, text) pairs."""
    texts = [F.col(c).cast("string").alias(c) for c in df.columns if c != key]
    wide = df.select(key, *texts)
    return wide.unpivot([key], [c for c in df.columns if c != key], "header", "value")

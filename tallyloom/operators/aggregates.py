"""Aggregates with the null, tie and share rules of everyday table work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.ordering import top_per_group


def total(c: str | Column) -> Column:
    """Sum in which a group of nulls is 0, not null."""
    return F.coalesce(F.sum(c), F.lit(0))


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose grouping keys are all present: null never forms a group."""
    return df.na.drop(how="any", subset=list(keys))


def count_others(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null count of every other column per group."""
    return keyed(df, keys).groupBy(*keys).agg(*[F.count(c).alias(c) for c in df.columns if c not in keys])


def numeric_means(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean of every numeric column per group."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in keys]
    return keyed(df, keys).groupBy(*keys).agg(*[F.avg(c).alias(c) for c in numeric])


def sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per group and the number of groups."""
    groups = keyed(df, keys).groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.withColumn("n_groups", groups.agg(F.count("*")).scalar())


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-null value, and its percentage of the non-null rows."""
    counts = keyed(df, [column]).groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", F.col("n") / counts.agg(F.sum("n")).scalar() * 100)


def share_of_total(df: DataFrame, key: str, value: str) -> DataFrame:
    """Each group's part of the whole."""
    sums = keyed(df, [key]).groupBy(key).agg(F.sum(value).alias(value))
    return sums.withColumn("share", F.col(value) / sums.agg(F.sum(value)).scalar())


def first_last(df: DataFrame, keys: Sequence[str], order: Column, columns: Sequence[str]) -> DataFrame:
    """First and last non-null value of each column, so they may come from different rows."""
    out = []
    for c in columns:
        # a null ordering value is ignored by min_by, which skips the null cells
        present = F.when(F.col(c).isNotNull(), order)
        out += [F.min_by(c, present).alias(f"first_{c}"), F.max_by(c, present).alias(f"last_{c}")]
    return keyed(df, keys).groupBy(*keys).agg(*out)


def row_of_max(df: DataFrame, value: str, order: Column) -> DataFrame:
    """The row with the largest value, the first in ``order`` on ties."""
    return df.filter(F.col(value).isNotNull()).orderBy(F.desc(value), order).limit(1)


def row_of_min(df: DataFrame, value: str, order: Column) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).orderBy(F.asc(value), order).limit(1)


def rows_with_max(df: DataFrame, value: str) -> DataFrame:
    """All rows that share the largest value."""
    return df.filter(F.col(value) == df.agg(F.max(value)).scalar())


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    return keyed(df, [column]).groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")


def keep_first(df: DataFrame, subset: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, where dropDuplicates would take any."""
    return top_per_group(df, subset, order, 1)


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Equal-width bins from the smallest to the largest value, the last one closed.

    Empty bins are listed with 0. A column with one value has its range widened
    by a half on both sides.
    """
    v = F.col(value).cast("double")
    present = df.select(v.alias("_v")).filter(F.col("_v").isNotNull())
    lowest, highest = present.agg(F.min("_v")).scalar(), present.agg(F.max("_v")).scalar()
    margin = F.when(lowest == highest, 0.5).otherwise(0.0)
    low, high = lowest - margin, highest + margin
    placed = F.least(F.coalesce(F.width_bucket("_v", low, high, F.lit(bins)), F.lit(bins)), F.lit(bins))
    counts = present.groupBy(placed.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / bins
    return every.join(counts, "bin", "left").select(
        "bin",
        (low + (F.col("bin") - 1) * width).alias("from_value"),
        (low + F.col("bin") * width).alias("to_value"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def linear_fit(df: DataFrame, keys: Sequence[str], x: str, y: str, predict_at: float) -> DataFrame:
    """Least-squares line per group, with a prediction rounded to whole millions."""
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    fit = pairs.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )
    return fit.withColumn("predicted", F.bround(F.col("slope") * predict_at + F.col("intercept"), -6))


def sum_across(columns: Sequence[str]) -> Column:
    """Sum along a row; a null adds nothing."""
    out = F.lit(0)
    for c in columns:
        out = out + F.coalesce(F.col(c), F.lit(0))
    return out

"""Inspection operators; each is one aggregate job and returns a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.randomness import keyed_order


def shape(df: DataFrame) -> DataFrame:
    """Row and column count, names and types, as one row."""
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.lit(",".join(t for _, t in df.dtypes)).alias("dtypes"),
    )


def info(df: DataFrame) -> DataFrame:
    """Type and non-null count per column."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    counts = non_null_counts(df).unpivot([], df.columns, "column", "non_null")
    return counts.select("column", F.element_at(types, F.col("column")).alias("dtype"), "non_null")


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, and whether the table has any at all; one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    anywhere = F.exists(F.array(*df.columns), lambda n: n > 0)
    long = wide.withColumn("any_null_in_table", anywhere).unpivot(["any_null_in_table"], df.columns, "column", "nulls")
    return long.select("column", "nulls", "any_null_in_table")


def non_null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count(c).alias(c) for c in df.columns])


def distinct_counts(df: DataFrame) -> DataFrame:
    """Distinct non-null values of every column."""
    return df.agg(*[F.count_distinct(c).alias(c) for c in df.columns])


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier one, as one number."""
    keys = list(subset or df.columns)
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def repeated_rows(df: DataFrame, row_id: str, subset: Sequence[str]) -> DataFrame:
    """The rows whose ``subset`` already occurred under a smaller ``row_id``.

    First occurrences come from a map-side combined minimum; the rest are found
    with an anti join on the unique id, so a value shared by a third of the
    table never meets in one task. Only a 256-bit digest of the values is grouped
    and shuffled, however long they are.
    """
    values = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in subset]), {"ignoreNullFields": "false"})
    firsts = df.groupBy(F.sha2(values, 256)).agg(F.min(row_id).alias(row_id)).select(row_id)
    return df.join(firsts, row_id, "left_anti")


def by_type(df: DataFrame, include: tuple[type, ...] = (), exclude: tuple[type, ...] = ()) -> DataFrame:
    """Keep or drop columns by Spark type class."""
    keep = [
        f.name
        for f in df.schema.fields
        if (not include or isinstance(f.dataType, include)) and not (exclude and isinstance(f.dataType, exclude))
    ]
    return df.select(*keep)


def head(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows, each set equally likely; the same ones for the same seed."""
    return df.orderBy(keyed_order(F.col(key), seed), key).limit(n)

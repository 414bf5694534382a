"""Bag difference and equality of whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# Rows of two tables that one task compares, on average.
ROWS_PER_TASK = 500_000


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` minus ``right``, each row of ``right`` taking away one copy."""
    return left.exceptAll(right.select(*left.columns))


def fingerprint(df: DataFrame) -> Row:
    """The number of rows and two sums of row hashes: the same for the same rows in any order, one pass, no shuffle.

    Sums in wide decimals neither overflow nor lose repeated rows, as a bitwise fold would.
    """
    # a null leaves a hash as it was, so each value comes with a mark
    marked = [x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), *marked).cast("decimal(20,0)")), F.lit(0)).alias(f"h{seed}") for seed in (1, 2)]
    return df.agg(F.count("*").alias("rows"), *sums).first()


def _dealt(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Rows by the hash of ``keys`` in as many parts as their counted number asks for, so that a task's
    hash table does not grow with the input, whatever ``spark.sql.shuffle.partitions`` is."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    return df.repartition(parts, *[F.col(f"`{c}`") for c in keys])


def _copies(left: DataFrame, right: DataFrame, rows: int) -> DataFrame:
    """Each different row once, with the number of its copies on either side: ``_left`` and ``_right``."""
    keys = left.columns
    both = left.withColumns({"_left": F.lit(1), "_right": F.lit(0)}).unionByName(right.withColumns({"_left": F.lit(0), "_right": F.lit(1)}))
    return _dealt(both, keys, rows).groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.sum("_left").alias("_left"), F.sum("_right").alias("_right"))


def _like(left: DataFrame, right: DataFrame) -> DataFrame:
    return right.select(*[F.col(f"`{c}`").cast(left.schema[c].dataType) for c in left.columns])


def compare(left: DataFrame, right: DataFrame) -> Row:
    """``same_set``, ``same_rows`` and ``no_repeats`` (of ``left``) in one pass over the rows of both tables."""
    copies = _copies(left, _like(left, right), left.count() + right.count())
    only = (F.col("_left") > 0) != (F.col("_right") > 0)
    return copies.agg(
        (F.count_if(only) == 0).alias("same_set"),
        (F.count_if(F.col("_left") != F.col("_right")) == 0).alias("same_rows"),
        (F.count_if(F.col("_left") > 1) == 0).alias("no_repeats"),
    ).first()


def same_bag(left: DataFrame, right: DataFrame) -> bool:
    """Both tables hold the same rows, as often. Rows are shuffled and compared only where the fingerprints agree."""
    right = _like(left, right)
    mine = fingerprint(left)
    if mine != fingerprint(right):
        return False
    return _copies(left, right, 2 * mine["rows"]).filter("_left <> _right").agg(F.count("*")).first()[0] == 0


def same_set(left: DataFrame, right: DataFrame) -> bool:
    """Both tables hold the same different rows."""
    copies = _copies(left, _like(left, right), left.count() + right.count())
    return copies.filter("(_left > 0) <> (_right > 0)").agg(F.count("*")).first()[0] == 0


def no_repeats(df: DataFrame) -> bool:
    counts = _dealt(df, df.columns, df.count()).groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_n"))
    return counts.filter("_n > 1").agg(F.count("*")).first()[0] == 0

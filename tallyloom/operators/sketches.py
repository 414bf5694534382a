"""Distinct counts from sketches that are kept by day and united on demand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# 2^12 registers: a standard error of 1.6 percent, in some kilobytes for each day and column.
LOG_REGISTERS = 12


def standard_error(log_registers: int = LOG_REGISTERS) -> float:
    return 1.04 / (2**log_registers) ** 0.5


def keep_days(df: DataFrame, day: Column, columns: Sequence[str], path: str, log_registers: int = LOG_REGISTERS) -> None:
    """Write the sketches of the days in ``df``; those of other days are left alone, those of the same days replaced.

    A row per day, sketches folded in the map tasks, so a new day costs a scan of its own rows.
    """
    sketches = [F.hll_sketch_agg(F.col(c), log_registers).alias(c) for c in columns]
    by_day = df.select(day.cast("date").alias("day"), *columns).filter("day IS NOT NULL").groupBy("day").agg(*sketches)
    by_day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def distinct_estimates(
    spark: SparkSession, path: str, columns: Sequence[str], first: str | None = None, last: str | None = None
) -> DataFrame:
    """One row: about how many different values each column has from ``first`` to ``last``, both included."""
    schema = ", ".join([*[f"`{c}` binary" for c in columns], "day date"])
    kept = spark.read.schema(schema).parquet(path)
    if first is not None:
        kept = kept.filter(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        kept = kept.filter(F.col("day") <= F.lit(last).cast("date"))
    return kept.agg(*[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c) for c in columns])

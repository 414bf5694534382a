"""Keyed table maintenance in batches.

Spark files are immutable, so each change yields a new table built from the old
one and a set of changed rows; nothing is rewritten in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.joins import keep_missing


def create(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """An empty typed table; columns marked NOT NULL refuse nulls on insert."""
    full = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    spark.createDataFrame([], full).write.parquet(path)
    return spark.read.schema(full).parquet(path)


def insert(path: str, rows: DataFrame, schema: T.StructType | str) -> None:
    """Append rows after checking names, types and NOT NULL columns."""
    full = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    checked = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in full.fields])
    for f in full.fields:
        if not f.nullable:
            missing = F.raise_error(F.lit(f"{f.name} is null")).cast(f.dataType)
            checked = checked.withColumn(f.name, F.coalesce(f.name, missing))
    checked.write.mode("append").parquet(path)


def by_key(df: DataFrame, key: str, value) -> DataFrame:
    """The row with a key; absence is an error when the result is read."""
    found = df.filter(F.col(key) == value)
    absent = F.raise_error(F.lit(f"no row with {key} = {value}"))
    refusal = found.agg(F.count("*").alias("n")).filter("n = 0")
    return found.union(refusal.select(*[absent.cast(f.dataType).alias(f.name) for f in df.schema.fields]))


def update(df: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Replace the rows whose key is in ``changes``; unknown keys change nothing.

    One left join on the key; two changes for one key are an error.
    """
    twice = F.raise_error(F.lit("several changes for one key"))
    row = F.struct(*df.columns)
    single = changes.groupBy(*key).agg(F.when(F.count("*") > 1, twice).otherwise(F.first(row)).alias("_new"))
    joined = df.join(single, list(key), "left")
    changed = F.col("_new").isNotNull()
    return joined.select(*[F.when(changed, F.col("_new")[c]).otherwise(F.col(c)).alias(c) for c in df.columns])


def delete(df: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    return keep_missing(df, keys, key)


def insert_new(df: DataFrame, rows: DataFrame, unique: Sequence[str]) -> DataFrame:
    """Add the rows whose unique columns are not taken yet; of new rows with one key, the smallest row."""
    row = F.struct(*[F.col(c) for c in df.columns])
    single = rows.groupBy(*unique).agg(F.min(row).alias("_row")).select("_row.*")
    return df.unionByName(keep_missing(single, df, unique))


def insert_checked(
    df: DataFrame, rows: DataFrame, unique: Sequence[str], parents: DataFrame | None = None, on: Sequence[str] = ()
) -> DataFrame:
    """``df`` and all of ``rows``; reading it fails if a unique key is taken or repeats, or a parent is missing.

    Keys that hold a null are not compared, as in SQL.
    """
    names = ", ".join(unique)
    known = df.select(*unique).dropna().withColumn("_old", F.lit(1))
    counts = known.unionByName(rows.select(*unique).dropna().withColumn("_old", F.lit(0)))
    taken = counts.groupBy(*unique).agg(F.count("*").alias("n"), F.min("_old").alias("new")).filter("n > 1 AND new = 0")
    problems = taken.agg(F.count("*")).scalar()
    allowed = F.when(problems > 0, F.raise_error(F.lit(f"a row with this {names} is there already")).cast("boolean"))
    if parents is not None:
        lost = orphans(rows.select(*on).dropna(), parents, on).agg(F.count("*")).scalar()
        allowed = allowed.when(lost > 0, F.raise_error(F.lit(f"no parent with this {', '.join(on)}")).cast("boolean"))
    return df.unionByName(rows.filter(allowed.otherwise(F.lit(True))))


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(children: DataFrame, parents: DataFrame, on: Sequence[str]) -> DataFrame:
    """Children whose parent does not exist."""
    return keep_missing(children, parents, on)

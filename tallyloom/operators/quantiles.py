"""Exact quantiles, also for groups too large for one aggregation buffer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordering import group_extent, running_total
from tallyloom.session import materialize

# The most values of one group that one aggregation buffer is given.
BUFFER_ROWS = 1_000_000

# One over the rank error of the sketches, as a part of the group.
ACCURACY = 10_000

# Up to this many groups, one row per group is sent to every task.
BROADCAST_GROUPS = 100_000


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    names: Sequence[str],
    window_rows: int = BUFFER_ROWS,
    broadcast_groups: int = BROADCAST_GROUPS,
    extent: tuple[int, int] | None = None,
) -> DataFrame:
    """One row per group with linearly interpolated quantiles of the non-null values.

    The built-in ``percentile`` keeps every distinct value of a group in one
    buffer, so it serves small groups only. Big groups, if they are few, are
    narrowed down: a sketch brackets each quantile, and only the values between
    the brackets are shuffled and ranked. Many groups of which some are big are
    ranked as a whole. All three give the same, exact answer. ``extent`` (rows of
    the biggest group, number of groups) is measured if it is not known yet.
    """
    keys = list(keys)
    present = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    biggest, groups = extent or group_extent(present, keys)
    if biggest <= window_rows:
        found = present.groupBy(*keys).agg(
            F.percentile("_v", F.array(*[F.lit(float(p)) for p in probabilities])).alias("_q")
        )
        return found.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    if groups <= broadcast_groups:
        ranked, sizes = _bracketed(present, keys, probabilities, window_rows)
    else:
        tallies = present.groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
        ranked = running_total(tallies, keys, [F.col("_v").asc()], F.col("_n"), "_upto", window_rows)
        # every probability looks at every value
        ranked = ranked.withColumn("_for", F.lit(None).cast("int"))
        sizes = ranked.groupBy(*keys).agg(F.max("_upto").alias("_size"))
    return _pick(_with_group(ranked, sizes, keys), keys, probabilities, names)


def _bracketed(
    present: DataFrame, keys: list[str], probabilities: Sequence[float], window_rows: int
) -> tuple[DataFrame, DataFrame]:
    """The values near each quantile with their ranks, and the size of each group."""
    bounds = []
    for p in probabilities:
        # the sketch is off by at most one ACCURACY-th of the rows on either side
        bounds += [max(p - 3 / ACCURACY, 0.0), min(p + 3 / ACCURACY, 1.0)]
    sketch = present.groupBy(*keys).agg(
        F.percentile_approx("_v", F.array(*[F.lit(float(b)) for b in bounds]), ACCURACY).alias("_b"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.count("*").alias("_size"),
    )
    # of a short group the sketch's error is less than a row, so all of it is kept
    short = F.col("_size") < 2 * ACCURACY
    lows, highs = [], []
    for i in range(len(probabilities)):
        all_below, all_above = short | F.lit(bounds[2 * i] == 0.0), short | F.lit(bounds[2 * i + 1] == 1.0)
        lows.append(F.when(all_below, F.col("_min")).otherwise(F.col("_b")[2 * i]))
        highs.append(F.when(all_above, F.col("_max")).otherwise(F.col("_b")[2 * i + 1]))
    brackets = materialize(
        sketch.select(*keys, "_size", F.array(*lows).alias("_low"), F.array(*highs).alias("_high")), "brackets"
    )
    placed = _with_group(present, F.broadcast(brackets), keys)
    spots = range(len(probabilities))
    below = placed.groupBy(*keys).agg(
        F.array(*[F.count_if(F.col("_v") < F.col("_low")[i]) for i in spots]).alias("_below")
    )
    inside = [F.when(F.col("_v").between(F.col("_low")[i], F.col("_high")[i]), F.lit(i)) for i in spots]
    near = placed.select(*keys, "_v", F.explode(F.array_compact(F.array(*inside))).alias("_for"))
    tallies = materialize(near.groupBy(*keys, "_for", "_v").agg(F.count("*").alias("_n")), "near-quantiles")
    ranked = running_total(tallies, [*keys, "_for"], [F.col("_v").asc()], F.col("_n"), "_upto", window_rows)
    ranked = _with_group(ranked, F.broadcast(below), keys)
    ranked = ranked.withColumn("_upto", F.col("_upto") + F.get("_below", F.col("_for"))).drop("_below")
    return ranked, F.broadcast(brackets.select(*keys, "_size"))


def _pick(
    ranked: DataFrame, keys: list[str], probabilities: Sequence[float], names: Sequence[str]
) -> DataFrame:
    missed = F.raise_error(F.lit("a sketch missed its quantile")).cast("double")

    def at(i: int, rank: Column) -> Column:
        # values ascend with _upto, so the value at a rank is the first one past it
        mine = F.coalesce(F.col("_for") == i, F.lit(True))
        found = F.min(F.when(mine & (F.col("_upto") > rank), F.col("_v")))
        first_rank = F.min(F.when(mine, F.col("_upto") - F.col("_n")))
        return F.when((first_rank > F.max(rank)) | found.isNull(), missed).otherwise(found)

    places = [(F.col("_size") - 1) * F.lit(float(p)) for p in probabilities]
    picked = ranked.groupBy(*keys).agg(
        F.max("_size").alias("_size"),
        *[at(i, F.floor(h)).alias(f"_lo{i}") for i, h in enumerate(places)],
        *[at(i, F.ceil(h)).alias(f"_hi{i}") for i, h in enumerate(places)],
    )
    result = []
    for i, (h, name) in enumerate(zip(places, names)):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        mixed = (F.ceil(h) - h) * lo + (h - F.floor(h)) * hi
        result.append(F.when(lo == hi, lo).otherwise(mixed).alias(name))
    return picked.select(*keys, *result)


def _with_group(rows: DataFrame, per_group: DataFrame, keys: list[str]) -> DataFrame:
    """Add the columns of a table with one row per group; null keys match each other."""
    if not keys:
        return rows.withColumn("_k", F.lit(0)).join(per_group.withColumn("_k", F.lit(0)), "_k").drop("_k")
    renamed, same = per_group, F.lit(True)
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_k_{k}")
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(renamed, same, "inner").drop(*[f"_k_{k}" for k in keys])


def describe(df: DataFrame, columns: Sequence[str], window_rows: int = BUFFER_ROWS) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max, one row per numeric column.

    One wide aggregate over the table; quartiles of a long table, which need
    more than one buffer, are worked out apart.
    """
    wide = df.select([F.col(c).cast("double").alias(c) for c in columns])
    names = ("count", "mean", "std", "min", "max")
    measures = (F.count, F.avg, F.stddev_samp, F.min, F.max)
    short = df.count() <= window_rows  # from the files' footers alone
    quartiles = F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)])
    every = wide.agg(
        *[
            F.struct(
                *[f(c).alias(n) for f, n in zip(measures, names, strict=True)],
                *([F.percentile(c, quartiles).alias("q")] if short else []),
            ).alias(c)
            for c in columns
        ]
    )
    stats = every.unpivot([], list(columns), "column", "s").select("column", "s.*")
    if short:
        found = stats.select("*", *[F.col("q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))])
    else:
        long = wide.unpivot([], list(columns), "column", "value")
        apart = quantiles(long, ["column"], "value", [0.25, 0.5, 0.75], ["q25", "q50", "q75"], window_rows)
        found = stats.join(apart, "column", "left")
    return found.select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def box_stats(
    df: DataFrame, keys: Sequence[str], value: str, window_rows: int = BUFFER_ROWS
) -> DataFrame:
    """Quartiles, whiskers inside 1.5 IQR and the number of outliers per group."""
    keys = list(keys)
    present = df.select(*keys, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    extent = group_extent(present, keys)
    quartiles = quantiles(present, keys, "_v", [0.25, 0.5, 0.75], ["q1", "median", "q3"], window_rows, extent=extent)
    if extent[1] <= BROADCAST_GROUPS:
        rows, n = present.join(F.broadcast(quartiles), keys), F.lit(1)
    else:
        # fold repeated values before the shuffle of the join
        tallies = present.groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
        rows, n = tallies.join(quartiles, keys), F.col("_n")
    fence = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("_v").between(F.col("q1") - fence, F.col("q3") + fence)
    return rows.groupBy(*keys).agg(
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(n)).cast("long").alias("outliers"),
    )

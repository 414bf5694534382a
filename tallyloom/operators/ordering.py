"""Order-dependent operators that hold when one group, or the whole table, is huge.

Spark runs a window over one group in one task. ``largest_group`` measures
whether that is safe; beyond ``WINDOW_ROWS`` the operators range-partition the
rows on (group, order), so that a hot group is spread over many tasks, and
carry small per-partition totals from one range to the next.

Every ``order`` must be unique inside its group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import materialize

# The most rows of one group that a single window task is given.
WINDOW_ROWS = 4_000_000

_PARTITION_SHIFT = 33  # monotonically_increasing_id keeps the partition above this bit


def group_extent(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows in the biggest group and the number of groups; one pass over the keys alone."""
    if not keys:
        return df.count(), 1
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    biggest, groups = counts.agg(F.max("n"), F.count("*")).first()
    return biggest or 0, groups


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    return group_extent(df, keys)[0]


def running_total(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    value: Column,
    out: str,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over this row and the earlier ones of its group."""
    if largest_group(df, partition) <= window_rows:
        w = Window.partitionBy(*partition).orderBy(*order)
        return df.withColumn(out, F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)))

    keys = [F.col(c).asc() for c in partition]
    ranged = df.withColumn("_amount", value).orderBy(*keys, *order)
    ranged = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    ranged = ranged.withColumn("_range", F.shiftright("_at", _PARTITION_SHIFT))

    within = [*partition, "_range"]
    so_far = Window.partitionBy(*within).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    # at most one row per (group, range): a hot group has no more rows than there are ranges
    earlier = Window.partitionBy(*partition).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranged.groupBy(*within)
        .agg(F.sum("_amount").alias("_total"))
        .withColumn("_carried", F.sum("_total").over(earlier))
        .drop("_total")
    )
    for c in partition:
        carried = carried.withColumnRenamed(c, f"_k_{c}")
    carried = carried.withColumnRenamed("_range", "_k_range")
    same = ranged["_range"] == carried["_k_range"]
    for c in partition:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return (
        ranged.withColumn(out, F.sum("_amount").over(so_far))
        .join(carried, same, "left")
        # either is null while no value has been seen, and then the other one counts alone
        .withColumn(out, F.coalesce(F.col(out) + F.col("_carried"), out, "_carried"))
        .select(*df.columns, out)
    )


def row_index(
    df: DataFrame,
    order: Sequence[Column],
    out: str = "position",
    partition: Sequence[str] = (),
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add the 0-based position of each row in ``order``, per group if one is given."""
    counted = running_total(df, list(partition), order, F.lit(1).cast("long"), out, window_rows)
    return counted.withColumn(out, F.col(out) - 1)


def with_predecessors(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    before: int,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Cut every group into chunks that one task can hold.

    Adds ``_chunk`` and ``_copy``: a window over (group, ``_chunk``) sees each
    row's ``before`` predecessors, because the last rows of a chunk are also
    sent, marked ``_copy``, to the next one. Drop the copies after the window.
    """
    if before >= window_rows:
        raise ValueError("a chunk must be longer than the frame")
    if largest_group(df, partition) <= window_rows:
        return df.withColumn("_chunk", F.lit(0).cast("long")).withColumn("_copy", F.lit(False))
    return _cut(df, partition, order, before, window_rows)


def _cut(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column], before: int, window_rows: int
) -> DataFrame:
    indexed = row_index(df, order, "_index", partition, window_rows)
    chunk = F.floor(F.col("_index") / window_rows)
    own = F.struct(chunk.alias("chunk"), F.lit(False).alias("copy"))
    nxt = F.struct((chunk + 1).alias("chunk"), F.lit(True).alias("copy"))
    near_end = F.col("_index") % window_rows >= window_rows - before
    return (
        indexed.withColumn("_to", F.explode(F.when(near_end, F.array(own, nxt)).otherwise(F.array(own))))
        .withColumn("_chunk", F.col("_to.chunk"))
        .withColumn("_copy", F.col("_to.copy"))
        .drop("_index", "_to")
    )


def rolling_mean(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    value: str,
    size: int,
    out: str,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Mean of the last ``size`` values; null until ``size`` of them exist."""
    chunks = with_predecessors(df, partition, order, size - 1, window_rows)
    frame = Window.partitionBy(*partition, "_chunk").orderBy(*order).rowsBetween(1 - size, 0)
    full = F.count(value).over(frame) == size
    return (
        chunks.withColumn(out, F.when(full, F.avg(value).over(frame)))
        .filter(~F.col("_copy"))
        .drop("_chunk", "_copy")
    )


def change_from_previous(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    value: str,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Absolute change against the previous row, and as percent of the newer value.

    The first row of a group has no predecessor and is left out. Next to a null
    value the change is null.
    """
    chunks = with_predecessors(df, partition, order, 1, window_rows)
    w = Window.partitionBy(*partition, "_chunk").orderBy(*order)
    return (
        chunks.withColumn("previous", F.lag(value).over(w))
        .withColumn("_follows", F.lag(F.lit(True)).over(w))
        .filter(~F.col("_copy") & F.col("_follows"))
        .withColumn("difference", F.abs(F.col(value) - F.col("previous")))
        .withColumn("percent", F.try_divide("difference", F.col(value)) * 100)
        .drop("_chunk", "_copy", "_follows")
    )


def lap_times(
    df: DataFrame,
    partition: Sequence[str],
    ts: str,
    tie_break: str,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Seconds since the previous event and since the first one of the group.

    Rows without a key belong to no group and are left out.
    """
    df = df.na.drop(how="any", subset=list(partition))
    order = [F.col(ts).asc(), F.col(tie_break).asc()]
    if largest_group(df, partition) <= window_rows:
        w = Window.partitionBy(*partition).orderBy(*order)
        timed = df.withColumn("_previous", F.lag(ts).over(w)).withColumn("_start", F.min(ts).over(w))
    else:
        chunks = _cut(df, partition, order, 1, window_rows)
        # one row per chunk, so the starting time spreads without joining on a hot group
        starts = (
            chunks.groupBy(*partition, "_chunk")
            .agg(F.min(ts).alias("_start"))
            .withColumn("_start", F.min("_start").over(Window.partitionBy(*partition)))
        )
        w = Window.partitionBy(*partition, "_chunk").orderBy(*order)
        timed = (
            chunks.withColumn("_previous", F.lag(ts).over(w))
            .filter(~F.col("_copy"))
            .join(starts, [*partition, "_chunk"], "inner")
            .drop("_chunk", "_copy")
        )
    since_last = seconds_between(F.coalesce("_previous", ts), F.col(ts))
    since_start = seconds_between(F.col("_start"), F.col(ts))
    return (
        timed.withColumn("lap_seconds", F.round(since_last, 2))
        .withColumn("total_seconds", F.round(since_start, 2))
        .select(*df.columns, "lap_seconds", "total_seconds")
    )


def seconds_between(earlier: Column, later: Column) -> Column:
    """Signed seconds, from the interval that timestamp subtraction gives."""
    return (later - earlier).cast("interval second").cast("decimal(20,6)").cast("double")


def top_per_group(df: DataFrame, partition: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group.

    The rank filter becomes a WindowGroupLimit, which trims every group to ``n``
    rows in each map task before the shuffle, so hot groups stay small.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def equal_batches(
    df: DataFrame, order: Sequence[Column], batches: int, out: str = "batch", window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Split an ordered table into ``batches`` equal runs; uneven lengths raise."""
    indexed = row_index(df, order, "_index", (), window_rows)
    total = df.agg(F.count("*")).scalar()
    size = (total / batches).cast("long")
    uneven = F.raise_error(F.lit("the rows do not divide into equal batches"))
    batch = F.when(total % batches != 0, uneven.cast("long")).otherwise(F.floor(F.col("_index") / size) + 1)
    return indexed.withColumn(out, batch).drop("_index")

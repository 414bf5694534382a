"""Values to the bands of a table: the first band with ``lo <= x <= hi``, without pairs of values and bands.

The bounds of all bands, in order, are the steps of a line. Of the bands over a
step, or over the gap above it, only the first counts; it is found by nodes of
a binary tree over the steps. A band lies on two nodes of a level at most, and
what the nodes know is handed down to the steps piece by piece of the tree, so
the work follows the number of bands and not how many of them overlap. A value then needs its step alone: steps of a
counted size go to every task, and the values stay where they are.

More steps than that are joined by equal cells. A stretch between two steps is
laid on a grid whose cells are as wide as itself or up to twice that, so it
covers two cells at most, however wide the others are. The widths are powers of
two; a value looks into one cell of each width that some stretch has.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import ordering
from tallyloom.session import materialize

# Steps up to this many rows and bytes are sent to every task.
BROADCAST_ROWS = 1_500_000
BROADCAST_BYTES = 100_000_000

# Leaves of the tree, as a power of two, that one task settles at once.
_PIECE = 14

# Widths below 2^-40 share one grid: cells so narrow that no more than a few values are in one.
_NARROWEST = -40
_LOW, _HIGH = -1.7e308, 1.7e308


def _cell(x: Column, level: Column) -> Column:
    return F.floor(x / F.pow(F.lit(2.0), level)).cast("decimal(38,0)")


def bands_on_grid(bands: DataFrame, lo: str, hi: str, least: float, most: float) -> DataFrame:
    """``bands`` with ``_level`` and, a row per cell, ``_cell``. Null bounds are open and end where the values end."""
    low, high = F.coalesce(F.col(lo), F.lit(_LOW)).cast("double"), F.coalesce(F.col(hi), F.lit(_HIGH)).cast("double")
    reach = bands.withColumns({"_lo": F.greatest(low, F.lit(least)), "_hi": F.least(high, F.lit(most))}).filter(
        # a band past all values, or upside down, holds none
        (low <= high) & (F.col("_lo") <= F.col("_hi"))
    )
    width = F.col("_hi") - F.col("_lo")
    level = F.when(width > 0, F.greatest(F.ceil(F.log2(F.when(width > 0, width))).cast("int"), F.lit(_NARROWEST))).otherwise(_NARROWEST)
    placed = reach.withColumn("_level", level)
    ends = F.array_distinct(F.array(_cell(F.col("_lo"), F.col("_level")), _cell(F.col("_hi"), F.col("_level"))))
    return placed.withColumn("_cell", F.explode(ends))


def _nodes(first: Column, last: Column, levels: int) -> Column:
    """The fewest nodes of a binary tree that together cover the leaves ``first`` to ``last``, as (level, node)."""

    def on(level: Column) -> Column:
        low = F.call_function("shiftright", first + F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1, level)
        high = F.call_function("shiftright", last + 1, level)
        left = F.when((low < high) & (low % 2 == 1), F.struct(level.alias("level"), low.alias("node")))
        right = F.when((low < high) & (high % 2 == 1), F.struct(level.alias("level"), (high - 1).alias("node")))
        return F.array(left, right)

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), on)))


def first_on_steps(bands: DataFrame, lo: str, hi: str, order: str, name: str) -> DataFrame:
    """A row per bound of a band: its place ``step`` and number ``rank``, and the name of the first band that
    holds the place itself (``at``) and the gap up to the next one (``above``); null if there is none."""
    infinity = F.lit(float("inf"))
    low, high = F.coalesce(F.col(lo).cast("double"), -infinity), F.coalesce(F.col(hi).cast("double"), infinity)
    # not a number is past all values, so as an upper bound it is open
    ends = bands.select(low.alias("lo"), F.when(F.isnan(high), infinity).otherwise(high).alias("hi"), F.struct(F.col(order).alias("order"), F.col(name).alias("name")).alias("band"))
    right_way = ends.filter((F.col("lo") <= F.col("hi")) & F.col("band.order").isNotNull())
    different = right_way.groupBy("lo", "hi").agg(F.min_by("band", "band.order").alias("band"))
    # the first band has the least number
    kept = materialize(ordering.row_index(different, [F.col("band.order"), F.col("lo"), F.col("hi")], "number"), "bands")
    bounds = kept.select(F.col("lo").alias("step")).union(kept.select("hi")).distinct()
    steps = materialize(ordering.row_index(bounds, [F.col("step")], "rank"), "steps")
    # a step is an odd leaf and the gap above it the even one after it
    levels = (2 * steps.count() + 2).bit_length()
    placed = kept.join(steps.select(F.col("step").alias("lo"), (2 * F.col("rank") + 1).alias("first")), "lo").join(
        steps.select(F.col("step").alias("hi"), (2 * F.col("rank") + 1).alias("last")), "hi"
    )
    on_nodes = placed.select("number", F.explode(_nodes(F.col("first"), F.col("last"), levels)).alias("on")).select("on.*", "number")
    nodes = on_nodes.groupBy("level", "node").agg(F.min("number").alias("number"))
    best = nodes.select(F.explode(_pieces(F.col("level"), F.col("node"))).alias("piece"), "level", "node", "number").groupBy("piece").applyInArrow(
        _least_on_leaves(_PIECE), "leaf long, number long"
    )
    number = F.col("number")
    here = best.groupBy(F.floor((F.col("leaf") - 1) / 2).alias("rank")).agg(
        F.max(F.when(F.col("leaf") % 2 == 1, number)).alias("_at"), F.max(F.when(F.col("leaf") % 2 == 0, number)).alias("_above")
    )
    names = kept.select("number", "band.name")
    found = steps.join(here, "rank", "left")
    for c in ("at", "above"):
        found = found.join(names.select(number.alias(f"_{c}"), F.col("name").alias(c)), f"_{c}", "left")
    return found.select("step", "rank", "at", "above")


def _pieces(level: Column, node: Column) -> Column:
    """The pieces of the tree, of 2^``_PIECE`` leaves each, that a node lies in or covers. Nodes above the pieces are few."""
    start = F.call_function("shiftleft", node, level - _PIECE)
    end = F.call_function("shiftleft", node + 1, level - _PIECE) - 1
    return F.when(level > _PIECE, F.sequence(start, end)).otherwise(F.array(F.call_function("shiftright", node, _PIECE - level)))


def _least_on_leaves(bits: int) -> Callable[[tuple[pa.Scalar, ...], pa.Table], pa.Table]:
    """A function giving the least number of the nodes over each leaf of a piece of 2^``bits``, for leaves that have one."""

    def least_in(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        piece, none = key[0].as_py(), np.iinfo(np.int64).max
        level, node, number = (rows[c].to_numpy() for c in ("level", "node", "number"))
        least = np.array([min(number[level >= bits], default=none)], dtype=np.int64)
        for k in range(bits - 1, -1, -1):
            least = np.repeat(least, 2)
            here = level == k
            at = node[here] - (piece << (bits - k))
            least[at] = np.minimum(least[at], number[here])
        leaves = np.flatnonzero(least < none)
        return pa.table({"leaf": leaves + (piece << bits), "number": least[leaves]})

    return least_in


def _stretches(steps: DataFrame, least: float, most: float) -> tuple[DataFrame, list[int]]:
    """The steps and the gaps above them that a band holds, on a grid, and the levels of that grid."""
    following = steps.select((F.col("rank") - 1).alias("rank"), F.col("step").alias("next"))
    places = steps.select(F.col("step").alias("from"), F.col("step").alias("to"), F.lit(False).alias("open"), F.col("at").alias("name"))
    gaps = steps.join(following, "rank").select(F.col("step").alias("from"), F.col("next").alias("to"), F.lit(True).alias("open"), F.col("above").alias("name"))
    grid = materialize(bands_on_grid(places.unionByName(gaps).filter(F.col("name").isNotNull()), "from", "to", least, most), "bands")
    return grid, sorted(r["_level"] for r in grid.select("_level").distinct().collect())  # a few exponents of two


def _by_grid(df: DataFrame, value: str, steps: DataFrame, out: str) -> DataFrame:
    none = df.withColumn(out, F.lit(None).cast(steps.schema["at"].dataType))
    seen = materialize(df.select(F.col(value).cast("double").alias("_x")).filter("_x IS NOT NULL AND NOT isnan(_x)").distinct(), "values")
    infinite = F.abs("_x") == float("inf")
    least, most = seen.filter(~infinite).agg(F.min("_x"), F.max("_x")).first()
    # infinite values are on steps or nowhere
    found = seen.filter(infinite).join(steps.select(F.col("step").alias("_x"), F.col("at").alias(out)), "_x")
    grid, levels = (None, []) if least is None else _stretches(steps, least, most)
    if levels:
        probes = seen.filter(~infinite).withColumn("_level", F.explode(F.array(*[F.lit(k) for k in levels]))).withColumn("_cell", _cell(F.col("_x"), F.col("_level")))
        within = (F.col("_x") > F.col("from")) & (F.col("_x") < F.col("to"))
        inside = probes.join(grid, ["_level", "_cell"]).filter(F.when(F.col("open"), within).otherwise(F.col("_x") == F.col("from")))
        found = found.unionByName(inside.select("_x", F.col("name").alias(out)))
    elif least is None and not seen.head(1):
        return none
    return df.join(found, F.col(value).cast("double") == F.col("_x"), "left").drop("_x")


def first_bands(
    df: DataFrame, value: str, bands: DataFrame, lo: str, hi: str, order: str, name: str, out: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``df`` with ``out``: ``name`` of the first band, by ``order``, with ``lo <= value <= hi``; null if there is none.

    Bands may overlap, lie in each other, share bounds and be open (a null bound). Values and bands make no
    pairs. Where there are more than ``broadcast_rows`` steps, each different value is looked up once and then
    joined to its rows, so a value that very many rows share costs no more than others.
    """
    steps = materialize(first_on_steps(bands, lo, hi, order, name), "first-bands")
    size = F.sum(8 + 2 * F.octet_length(F.coalesce(F.greatest(F.col("at").cast("string"), F.col("above").cast("string")), F.lit(""))))
    rows, held = steps.agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    if rows > broadcast_rows or held > BROADCAST_BYTES:
        return _by_grid(df, value, steps, out)
    table = steps.select("step", "at", "above").orderBy("step").toArrow()  # bounded by the counted size
    sent = df.sparkSession.sparkContext.broadcast((table["step"].to_numpy(), pa.chunked_array([*table["at"].chunks, *table["above"].chunks], table["at"].type).combine_chunks()))

    @F.arrow_udf(steps.schema["at"].dataType)
    def first(x: pa.Array) -> pa.Array:
        places, names = sent.value
        numbers = x.to_numpy(zero_copy_only=False)
        at = np.searchsorted(places, numbers, "right") - 1
        held = (at >= 0) & ~np.isnan(numbers)
        gap = held & (places[at] != numbers) if len(places) else held
        return names.take(pa.array(np.where(gap, at + len(places), at), mask=~held))

    return df.withColumn(out, first(F.col(value).cast("double")))

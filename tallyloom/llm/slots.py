"""Placing items of few distinct lengths into bins without looking at single items.

What fits where depends on the lengths alone, and there are at most ``capacity``
of them. So a plan is made from the number of items of each length (a table
bounded by the capacity, however large the corpus) as groups of equal bins, and
the n-th item of a length is then looked up in the plan by every task alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass
class BinGroup:
    """``bins`` bins of equal content; content is (length, number of such items) in placing order."""

    bins: int
    content: list[tuple[int, int]] = field(default_factory=list)

    def split(self, bins: int) -> BinGroup:
        """Take ``bins`` bins out of this group."""
        self.bins -= bins
        return BinGroup(bins, list(self.content))


def slot_table(spark: SparkSession, groups: list[BinGroup], capacity: int) -> DataFrame:
    """Rows (length, first, last, sequence, offset, per_bin): items first..last of a length go to
    sequences from ``sequence`` on, ``per_bin`` to each, from ``offset`` on.

    The number of rows depends on the capacity, not on the number of items.
    """
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for g in groups:
        offset = 0
        for length, per_bin in g.content:
            first = used.get(length, 0)
            used[length] = first + per_bin * g.bins
            rows.append((length, first, used[length] - 1, sequence, offset, per_bin))
            offset += length * per_bin
        if offset > capacity:
            raise AssertionError("a bin holds more than its capacity")
        sequence += g.bins
    schema = "slot_length int, first long, last long, sequence long, slot_offset long, per_bin long"
    return spark.createDataFrame(rows, schema)


def assign(pieces: DataFrame, groups: list[BinGroup], capacity: int) -> DataFrame:
    """``pieces`` (length, item_no: its number among the items of that length) with sequence_id and offset."""
    slots = F.broadcast(slot_table(pieces.sparkSession, groups, capacity))
    within = F.col("item_no") - F.col("first")
    return (
        pieces.join(
            slots, (F.col("length") == F.col("slot_length")) & F.col("item_no").between(F.col("first"), F.col("last"))
        )
        .withColumn("sequence_id", F.col("sequence") + F.floor(within / F.col("per_bin")))
        .withColumn("offset", F.col("slot_offset") + F.col("length") * (within % F.col("per_bin")))
        .drop(*slots.columns)
    )


def number_items(pieces: DataFrame) -> DataFrame:
    """Add ``item_no``, 0, 1, 2... among the pieces of a length, from each part's own numbering.

    ``pieces`` is a written table with ``part`` (the task that wrote the row) and
    ``no_in_part`` (the row's number among the rows of its length in that part).
    Only a count per part and length is shuffled.
    """
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy("part", "length")
        .agg(F.count("*").alias("n"))
        .select(
            F.col("part").alias("_part"),
            F.col("length").alias("_length"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"),
        )
    )
    same = (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length"))
    return pieces.join(starts, same).withColumn("item_no", F.col("_start") + F.col("no_in_part")).drop(*starts.columns)


def length_counts(pieces: DataFrame) -> dict[int, int]:
    """Items of each length; no more entries than the capacity."""
    return {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}

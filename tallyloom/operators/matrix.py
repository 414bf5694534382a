"""Matrices as (i, j, v) cells, and as dense tiles of many cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyloom.operators.ordering import row_index
from tallyloom.session import materialize

# A right-hand matrix of up to this many cells, some 60 MB, is sent to every task.
BROADCAST_CELLS = 2_000_000


def matrix_cells(df: DataFrame, row: str, values: str) -> DataFrame:
    """An array per row as (i, j, v) cells."""
    return df.select(F.col(row).alias("i"), F.posexplode(values).alias("j", "v"))


def matrix_product(left: DataFrame, right: DataFrame, broadcast_cells: int = BROADCAST_CELLS) -> DataFrame:
    """Product of two matrices given as cells.

    A tall matrix times a small one has few inner indices, each with very many
    cells, so a small right side is sent to the tasks instead of shuffling the
    left one by that index. It is written first, to be counted without being
    computed twice. Products are summed in the map tasks before the (i, j)
    shuffle.
    """
    right = materialize(right.select("i", "j", "v"), "matrix")
    b = right.select(F.col("i").alias("k"), "j", F.col("v").alias("b"))
    if right.count() <= broadcast_cells:
        b = F.broadcast(b)
    a = left.select("i", F.col("j").alias("k"), F.col("v").alias("a"))
    return a.join(b, "k").groupBy("i", "j").agg(F.sum(F.col("a") * F.col("b")).alias("v"))


# Rows and columns of a dense tile.
TILE_ROWS, TILE_COLUMNS = 512, 64


def row_tiles(df: DataFrame, row: str, values: str, height: int = TILE_ROWS, width: int = TILE_COLUMNS) -> DataFrame:
    """An array per row as dense tiles: ``block`` (of rows), ``ids`` (its rows), ``k`` (of columns) and ``tile``.

    Rows are stacked where they are read, so nothing is shuffled. Arrays of one matrix have one length; a null
    array, or a null in one, is an error.
    """
    ids = T.ArrayType(df.schema[row].dataType)
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", ids), T.StructField("k", T.IntegerType()), T.StructField("tile", T.BinaryType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def stack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, height):
                some = batch.slice(at, height)
                dense = np.stack([np.asarray(v, dtype=np.float64) for v in some.column(1).to_pylist()])
                parts = [np.ascontiguousarray(dense[:, c : c + width]).tobytes() for c in range(0, dense.shape[1], width)]
                n = len(parts)
                columns = ([block] * n, [some.column(0).to_pylist()] * n, range(n), parts)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
                block += 1

    return df.select(row, F.col(values).cast("array<double>").alias("v")).mapInArrow(stack, schema)


def cell_tiles(cells: DataFrame, height: int = TILE_COLUMNS, width: int = TILE_COLUMNS) -> DataFrame:
    """Cells (i, j, v) as dense tiles: ``k`` (i // height), ``across`` (a block of columns), ``names`` (their j) and ``tile``."""
    columns = materialize(row_index(cells.select("j").distinct(), [F.col("j").asc()], "_column"), "columns")
    across = F.floor(F.col("_column") / width).cast("int").alias("across")
    placed = cells.join(columns, "j").select(
        F.floor(F.col("i") / height).cast("int").alias("k"), across,
        (F.col("i") % height).cast("int").alias("r"), (F.col("_column") % width).cast("int").alias("c"), "v",
    )
    in_order = F.array_sort(F.collect_list(F.struct("_column", "j")))
    named = columns.groupBy(across).agg(F.transform(in_order, lambda x: x["j"]).alias("names"))  # ``width`` names at most

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        dense = np.zeros((height, width))
        dense[group["r"].to_numpy(), group["c"].to_numpy()] = group["v"].to_numpy()
        first = group.iloc[0]
        return pd.DataFrame({"k": [int(first["k"])], "across": [int(first["across"])], "tile": [dense.tobytes()]})

    return placed.groupBy("k", "across").applyInPandas(fill, "k int, across int, tile binary").join(named, "across")


def tile_product(left: DataFrame, right: DataFrame, width: int = TILE_COLUMNS, broadcast_cells: int = BROADCAST_CELLS) -> DataFrame:
    """Cells (i, j, v) of the product of ``row_tiles`` and ``cell_tiles`` made with the same ``width`` and height.

    Tiles meet by their inner block and are multiplied whole; what is shuffled is a row per tile, not per number.
    A right side of few numbers is sent to the tasks, so the left one's tiles stay where they are.
    """
    right = materialize(right, "right-tiles")
    small = right.count() * width * width <= broadcast_cells
    pairs = left.join(F.broadcast(right.withColumnRenamed("tile", "_right")) if small else right.withColumnRenamed("tile", "_right"), "k")
    ids, names = left.schema["ids"], right.schema["names"]
    made = T.StructType([left.schema["block"], right.schema["across"], ids, names, T.StructField("tile", T.BinaryType())])

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for a, b, n in zip(batch["tile"], batch["_right"], batch["ids"], strict=True):
                x = np.frombuffer(a).reshape(len(n), -1)
                y = np.frombuffer(b).reshape(-1, width)[: x.shape[1]]  # the last inner block may be narrower
                out.append((x @ y).tobytes())
            yield batch[["block", "across", "ids", "names"]].assign(tile=out)

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return group.head(1).assign(tile=[np.sum([np.frombuffer(t) for t in group["tile"]], axis=0).tobytes()])

    cells = T.StructType([T.StructField("i", ids.dataType.elementType), T.StructField("j", names.dataType.elementType), T.StructField("v", T.DoubleType())])

    def spell_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n, named, tile in zip(batch["ids"], batch["names"], batch["tile"], strict=True):
                values = np.frombuffer(tile).reshape(len(n), width)[:, : len(named)]
                yield pd.DataFrame({"i": np.repeat(np.asarray(n), len(named)), "j": np.tile(np.asarray(named), len(n)), "v": values.ravel()})

    products = pairs.select("block", "across", "ids", "names", "tile", "_right").mapInPandas(multiply, made)
    return products.groupBy("block", "across").applyInPandas(add, made).mapInPandas(spell_out, cells)

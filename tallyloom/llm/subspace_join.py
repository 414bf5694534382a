"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors whose cosine is c are sqrt(2 - 2c) apart, in any rotation. Cut the
rotated coordinates into blocks and give each block its share of the squared
distance, in proportion to its dimensions: a pair within the whole budget is
within the budget of one block at least.

1. Vectors that are equal (and carry the same label) are one node with a count.
2. Each block is range-joined on its own: nodes meet if the block's squared
   distance is within the block's budget. Where a label has many nodes, a grid
   over the block's first coordinates deals them to cells two radii wide; a node
   is at home in one cell and a guest in those that its ball touches. A cell
   with more rows than a tile is dealt to pairs of slices of its home rows and of
   all its rows, so a task holds two slices at most and no pair is left out.
3. A pair is looked at in the first block whose budget it meets and nowhere
   else, so the union over the blocks counts no pair twice. There its cosine is
   worked out on the original vectors in double precision.
4. A task hands on, for each home node, the number of vectors linked with it,
   and a star of links per local component; pairs never leave it.

Within a block and tile all pairs are compared in low dimensions, and of a group
of near copies each link is verified, so work inside a hot cell is quadratic in
its different vectors; memory, rows handed on and shuffled copies are not.

Output: ``vec_id``, ``n_links`` (other rows whose vectors link with the row's),
``component_id`` (the smallest id reachable by links, itself included), ``kept``
(vec_id = component_id).

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, link with nothing and are their own
component; vectors of different lengths never link; a row with a null id takes
no part and has a null component and ``kept`` true; repeated rows, and rows that
share an id, are rows like any others and link by their own vectors; an empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import materialize
from tallyloom.llm.groups import connected, per_group

#: Different vectors of a label up to which no grid is laid, and rows of a slice of a cell.
CELL_ROWS, TILE_ROWS = 8_192, 2_048
BLOCKS = 8
_SEED = 20_241
#: Rotated coordinates are kept in single precision; budgets are wider by more than that loses.
_SLACK = 1e-5
_PAIRS_AT_ONCE = 100_000


@lru_cache(maxsize=4)
def rotation(dimensions: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(_SEED).normal(size=(dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def block_bounds(dimensions: int, blocks: int = BLOCKS) -> np.ndarray:
    count = min(blocks, dimensions)
    return np.array([dimensions * b // count for b in range(count + 1)])


def budgets(dimensions: int, least: float, blocks: int = BLOCKS) -> np.ndarray:
    """The squared distance that each block may use: its share of the whole, by its dimensions."""
    return (2 - 2 * least) * np.diff(block_bounds(dimensions, blocks)) / dimensions + _SLACK


def grid_depth(rows: int, dimensions: int, cell_rows: int) -> int:
    """Coordinates of a block that are laid on a grid so that cells have about ``cell_rows`` rows; at most four."""
    depth = 0
    while depth < min(4, dimensions) and rows > cell_rows * 3**depth:
        depth += 1
    return depth


def cells(coordinates: np.ndarray, radius: float) -> Iterator[tuple[tuple[int, ...], bool]]:
    """The cell that a point is at home in (True), and those that its ball touches (False)."""
    home = np.floor(coordinates / (2 * radius)).astype(int)
    low = np.floor((coordinates - radius) / (2 * radius)).astype(int)
    high = np.floor((coordinates + radius) / (2 * radius)).astype(int)
    for cell in product(*(range(a, b + 1) for a, b in zip(low, high, strict=True))):
        yield cell, cell == tuple(home)


def _nodes(vectors: DataFrame, id_column: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Usable rows (id, label, h, g) and different vectors (node, label, h, g, vec, first, rows), both written."""
    v = F.col(f"`{vector}`")
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").alias("label"), v.cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.filter("id IS NOT NULL AND label IS NOT NULL AND size(vec) > 0").filter(fine & F.exists("vec", lambda x: x != 0))
    # 128 bits tell different vectors apart; minus zero is zero
    zeroed = F.transform("vec", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    hashed = usable.withColumn("h", F.xxhash64(zeroed)).withColumn("g", F.xxhash64(F.lit(_SEED), zeroed))
    nodes = (
        hashed.groupBy("label", "h", "g")
        .agg(F.any_value("vec").alias("vec"), F.min("id").alias("first"), F.count("*").alias("rows"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    return hashed.select("id", "label", "h", "g"), materialize(nodes, "vector-nodes")


def _placed(nodes: DataFrame, least: float, cell_rows: int) -> DataFrame:
    """Rows (cell, block, home, node, rows, vec, turned): each node in its cells of each block.

    Where there is no grid all blocks share one cell, and ``block`` is -1.
    """
    sized = nodes.withColumn("d", F.size("vec"))
    counts = materialize(sized.groupBy("label", "d").agg(F.count("*").alias("n")), "label-counts")
    source = sized.join(counts, ["label", "d"]).select(F.col("label").cast("string").alias("label"), "node", "rows", "n", "vec")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for row in batch.itertuples(index=False):
                vec = np.asarray(row.vec, dtype=np.float64)
                vec = np.ldexp(vec, -np.frexp(np.abs(vec).max())[1])  # exact, and no square overflows or vanishes
                d = len(vec)
                turned = ((vec / np.sqrt(vec @ vec)) @ rotation(d)).astype("<f4")
                kept = (row.node, row.rows, vec.astype("<f8").tobytes(), turned.tobytes())
                bounds, spare = block_bounds(d), budgets(d, least)
                if row.n <= cell_rows:
                    made.append((f"{row.label}/{d}", -1, True, *kept))
                    continue
                for b, (begin, end) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    depth = grid_depth(row.n, end - begin, cell_rows)
                    for cell, home in cells(turned[begin : begin + depth].astype(np.float64), float(np.sqrt(spare[b]))):
                        made.append((f"{row.label}/{d}/{b}/{','.join(map(str, cell))}", b, home, *kept))
            yield pd.DataFrame(made, columns=["cell", "block", "home", "node", "rows", "vec", "turned"])

    schema = "cell string, block int, home boolean, node long, rows long, vec binary, turned binary"
    return source.mapInPandas(place, schema)


def _tiled(placed: DataFrame, tile_rows: int) -> DataFrame:
    """``placed`` with ``tile``, ``asks`` (compared as a home row) and ``answers`` (compared as any row of the cell)."""
    placed = materialize(placed, "cells")
    counted = placed.groupBy("cell").agg(F.count_if("home").alias("homes"), F.count("*").alias("all"))
    counted = materialize(counted.filter("homes > 0 AND `all` > 1"), "cell-counts")
    home_slices, all_slices = (F.ceil(F.col(c) / tile_rows).cast("int") for c in ("homes", "all"))
    own_home = F.pmod(F.xxhash64("node"), home_slices).cast("int")
    own = F.pmod(F.xxhash64(F.lit(1), "node"), all_slices).cast("int")

    def copy(i, j, asks: bool, answers: bool):
        return F.struct(i.alias("i"), j.alias("j"), F.lit(asks).alias("asks"), F.lit(answers).alias("answers"))

    asking = F.transform(F.sequence(F.lit(0), all_slices - 1), lambda j: copy(own_home, j, True, False))
    answering = F.transform(F.sequence(F.lit(0), home_slices - 1), lambda i: copy(i, own, False, True))
    copies = (
        F.when((F.col("all") <= tile_rows) & F.col("home"), F.array(copy(F.lit(0), F.lit(0), True, True)))
        .when(F.col("home"), F.concat(asking, answering))
        .otherwise(answering)
    )
    dealt = placed.join(counted, "cell").withColumn("p", F.explode(copies))
    return dealt.select(F.concat_ws("/", "cell", "p.i", "p.j").alias("tile"), "block", "node", "rows", "vec", "turned", "p.asks", "p.answers")


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Let ``root``, the smallest known member of each one's component, take in the links (a, b)."""
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(nearer := root[root], root):
            root[:] = nearer


def _compare(least: float):
    def compare(group: pd.DataFrame) -> pd.DataFrame | None:
        group = group.sort_values("node", kind="stable")
        node, rows = group["node"].to_numpy(), group["rows"].to_numpy()
        vec = np.frombuffer(b"".join(group["vec"]), dtype="<f8").reshape(len(group), -1)
        turned = np.frombuffer(b"".join(group["turned"]), dtype="<f4").reshape(len(group), -1).astype(np.float64)
        bounds, spare = block_bounds(vec.shape[1]), budgets(vec.shape[1], least)
        square = (vec * vec).sum(axis=1)
        asks, answers = np.flatnonzero(group["asks"]), np.flatnonzero(group["answers"])
        # a node that is here twice, once in each part, is one in its component
        unique, own = np.unique(node, return_inverse=True)
        root, links = np.arange(len(unique)), np.zeros(len(group), dtype=np.int64)
        only = int(group["block"].iloc[0])
        for b in range(len(spare)) if only < 0 else [only]:
            part = slice(bounds[b], bounds[b + 1])
            x, y = turned[asks, part], turned[answers, part]
            apart = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
            near, far = np.nonzero(apart <= spare[b] + _SLACK)  # rounding differs between tiles; decided below
            for at in range(0, len(near), _PAIRS_AT_ONCE):
                i, j = asks[near[at : at + _PAIRS_AT_ONCE]], answers[far[at : at + _PAIRS_AT_ONCE]]
                other = node[i] != node[j]
                i, j = i[other], j[other]
                gaps = turned[i, : bounds[b + 1]] - turned[j, : bounds[b + 1]]
                within = np.add.reduceat(gaps * gaps, bounds[: b + 1], axis=1) <= spare[: b + 1]
                first = within[:, b] & ~within[:, :b].any(axis=1)
                i, j = i[first], j[first]
                cosine = (vec[i] * vec[j]).sum(axis=1) / np.sqrt(square[i] * square[j])
                i, j = i[cosine >= least], j[cosine >= least]
                np.add.at(links, i, rows[j])
                _merge(root, own[i], own[j])
        star = unique[root[own]]
        told = (links > 0) | (star != node)
        return pd.DataFrame({"node": node[told], "links": links[told], "root": star[told]}) if told.any() else None

    return compare


def near_duplicates(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.98,
    cell_rows: int = CELL_ROWS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for each row of ``vectors``."""
    if not 0 < least <= 1:
        raise ValueError("least is a cosine above 0 and up to 1")
    rows, nodes = _nodes(vectors, id_column, vector, label)
    tiles = _tiled(_placed(nodes, least, cell_rows), tile_rows)
    found = materialize(per_group(tiles, "tile", _compare(least), "node long, links long, root long"), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = nodes.select("node", "label", "h", "g", "first", "rows").join(links, "node", "left")
    known = known.join(labels.withColumnRenamed("label", "top"), "node", "left").withColumn("top", F.coalesce("top", "node"))
    known = materialize(known, "vector-classes")
    firsts = materialize(known.groupBy("top").agg(F.min("first").alias("component")), "vector-components")
    told = materialize(
        known.join(firsts, "top").select("label", "h", "g", "component", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n")), "vector-results"
    )
    linked = rows.join(told, ["label", "h", "g"]).select("id", "n", "component")
    ids = F.col(f"`{id_column}`").cast("long")
    v = F.col(f"`{vector}`").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    took_part = F.coalesce(ids.isNotNull() & F.col(f"`{label}`").isNotNull() & (F.size(v) > 0) & fine, F.lit(False))
    alone = vectors.filter(~took_part).select(ids.alias("id"), F.lit(0).cast("long").alias("n"), ids.alias("component"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_column), F.col("n").alias("n_links"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )

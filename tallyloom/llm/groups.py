"""Connected classes over links, and groups of rows streamed through a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import materialize


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected with, for every node of ``links`` (a, b).

    Each round takes the smallest label among a node and its neighbours and then
    the label of that label, so labels travel ever further; every round is a
    written table, and the rounds end when no label changes.
    """
    both = links.filter("a <> b").select("a", "b").unionByName(links.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.distinct(), "edges")
    labels = materialize(
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels"
    )
    while True:
        seen = edges.join(labels.select(F.col("node").alias("b"), F.col("label").alias("l")), "b").groupBy(F.col("a").alias("node")).agg(F.min("l").alias("l"))
        nearer = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        nearer = materialize(nearer, "labels")
        of_label = nearer.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = materialize(
            nearer.join(of_label, "label", "left").select("node", "old", F.coalesce("next", "label").alias("label")), "labels"
        )
        if jumped.filter("label <> old").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")


def in_blocks(df: DataFrame, size: str, limit: int, spread: str) -> DataFrame:
    """Rows of large groups dealt to pairs of blocks, so that any two rows of a group meet in one.

    Adds ``lo``, ``hi`` (the pair) and ``block`` (the row's own). A group of up to
    ``limit`` rows is one block; a row of a larger one goes to each pair its own
    block is in.
    """
    blocks = F.ceil(F.col(size) / limit).cast("int")
    own = F.pmod(F.xxhash64(spread), blocks).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("lo"), F.greatest(o, F.col("block")).alias("hi"))
    )
    return df.withColumn("block", own).withColumn("p", F.explode(pair)).select(*df.columns, "block", "p.lo", "p.hi")


def per_group(df: DataFrame, key: str, work: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str) -> DataFrame:
    """``work`` on the rows of each ``key``, many groups to a Python call; a group must fit into a task."""

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        names = [c.split()[0] for c in schema.split(", ")]

        def done(parts: list[pd.DataFrame]) -> list[pd.DataFrame]:
            whole = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0].reset_index(drop=True)
            keys = whole[key].to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
            found = [work(whole.iloc[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            return [f for f in found if f is not None and len(f)]

        for batch in batches:
            if batch.empty:
                continue
            keys = batch[key].to_numpy()
            last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
            if last:  # groups that end in this batch
                out = done([*held, batch.iloc[:last]])
                held = [batch.iloc[last:]]
                if out:
                    yield pd.concat(out, ignore_index=True)[names]
            elif held and held[-1][key].iloc[0] != keys[0]:
                out, held = done(held), [batch]
                if out:
                    yield pd.concat(out, ignore_index=True)[names]
            else:
                held.append(batch)
        if held:
            out = done(held)
            if out:
                yield pd.concat(out, ignore_index=True)[names]

    return df.repartition(F.col(key)).sortWithinPartitions(key).mapInPandas(stream, schema)


def components(neighbours: Callable[[int, np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """The smallest member of each row's component; ``neighbours(i, others)`` tells which of ``others`` row i links to."""
    root = np.arange(n)
    join_rows(neighbours, root, np.arange(n))
    return root


def join_rows(neighbours: Callable[[int, np.ndarray], np.ndarray], root: np.ndarray, rows: np.ndarray) -> list[tuple[int, int]]:
    """Let ``root`` (the smallest member of each one's component) take in the links among ``rows``.

    What belongs together already is not compared again. Returns the pairs of roots that were joined.
    """
    made: list[tuple[int, int]] = []
    free = rows
    while len(free):
        own = root[free] == root[free[0]]
        queue, free = free[own].tolist(), free[~own]
        while queue and len(free):
            i = queue.pop()
            linked = np.unique(root[free[neighbours(i, free)]])
            for r in linked.tolist():
                a, b = sorted((int(root[i]), r))
                made.append((a, b))
                root[root == b] = a
            if len(linked):
                joined = root[free] == root[i]
                queue += free[joined].tolist()
                free = free[~joined]
    return made

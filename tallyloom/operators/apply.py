"""Python functions over groups, for logic that no expression covers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.ordering import group_extent
from tallyloom.session import materialize

PandasFunction = Callable[[pd.DataFrame], pd.DataFrame]


StateFunction = Callable[[pd.DataFrame], pd.DataFrame]


# The most rows of a group that are handed to a function at once.
GROUP_ROWS = 2_000_000


def apply_groups(
    df: DataFrame, keys: Sequence[str], f: PandasFunction, schema: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """``f``, which may be any function, once on all rows of each group.

    A group must fit into a task, so one of more than ``group_rows`` rows is an
    error; see ``reduce_groups`` for functions that can be fed their own answers.
    """

    def on_group(rows: pd.DataFrame) -> pd.DataFrame:
        return f(rows)

    extent, _ = group_extent(df, keys)
    if extent > group_rows:
        raise ValueError(f"a group has {extent} rows, more than the {group_rows} a function is given at once")
    return df.groupBy(*keys).applyInPandas(on_group, schema)


def reduce_groups(
    df: DataFrame, keys: Sequence[str], f: PandasFunction, schema: str, pieces: int = 64
) -> DataFrame:
    """``f`` on the rows of each group, in three rounds that shrink it.

    ``f`` must give the same answer when fed its own answers for parts of the
    group, as picking the largest rows does. It runs on each Arrow batch in the
    map tasks, then on ``pieces`` parts per group, then on the group, so no
    task ever holds a whole group of the input. ``schema`` must keep the
    columns that ``f`` reads.
    """
    names = list(keys)

    def on_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(names, sort=False, dropna=False):
                yield f(part)

    def on_piece(part: pd.DataFrame) -> pd.DataFrame:
        return f(part.drop(columns="_piece"))

    trimmed = df.mapInPandas(on_batches, schema)
    piece = F.pmod(F.xxhash64(*trimmed.columns), F.lit(pieces))
    smaller = trimmed.withColumn("_piece", piece).groupBy(*names, "_piece").applyInPandas(on_piece, schema)
    return smaller.groupBy(*names).applyInPandas(f, schema)


def apply_with_state(
    df: DataFrame,
    keys: Sequence[str],
    partial: StateFunction,
    merge: StateFunction,
    state: str,
    finish: PandasFunction,
    schema: str,
    pieces: int = 64,
) -> DataFrame:
    """A function of each row and of its group's statistics, for groups of any size.

    ``partial`` makes the state (a row of the columns ``state``) of some rows of a group, ``merge`` one state of
    several, and ``finish`` the results of some rows, which come with the columns of their group's state. States
    are made in the map tasks from each Arrow batch, merged in ``pieces`` parts per group and then per group, and
    joined back to the rows; no task holds a group, and a group that holds most rows is split by AQE.
    """
    names = list(keys)
    held = T.StructType([*[df.schema[k] for k in names], *T.StructType.fromDDL(state).fields])
    own = [f.name for f in held.fields[len(names) :]]

    def keyed(rows: pd.DataFrame, f: StateFunction) -> pd.DataFrame:
        parts = []
        for _, part in rows.groupby(names, sort=False, dropna=False):
            made = f(part)
            parts.append(pd.concat([part[names].iloc[[0]].reset_index(drop=True), made[own].reset_index(drop=True)], axis=1))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=held.names)

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield keyed(batch, partial)

    def on_states(states: pd.DataFrame) -> pd.DataFrame:
        return keyed(states[held.names], merge)

    made = df.mapInPandas(make, held)
    piece = F.pmod(F.monotonically_increasing_id(), F.lit(pieces))
    fewer = made.withColumn("_piece", piece).groupBy(*names, "_piece").applyInPandas(on_states, held)
    states = materialize(fewer.groupBy(*names).applyInPandas(on_states, held), "group-states")
    renamed = states.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(names)], *own)
    same = F.lit(True)
    for i, k in enumerate(names):
        same = same & df[k].eqNullSafe(renamed[f"_k{i}"])
    together = df.join(renamed, same).drop(*[f"_k{i}" for i in range(len(names))])

    def end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield finish(batch)

    return together.mapInPandas(end, schema)

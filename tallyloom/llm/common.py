"""Helpers that several operators of this package share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyloom.session import materialize, read_table

#: A word, and the white space between words, as the contracts define them.
WORD = r"[^\x20\x09-\x0D]+"
NOT_WORD = r"[\x20\x09-\x0D]+"

#: Rows whose results a task holds besides the batch that it reads.
SLICE = 256

__all__ = [
    "NOT_WORD", "SLICE", "WORD", "add_columns", "let_go", "materialize", "read_table", "shared_bytes", "text_or_empty", "words_of",
]


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def shared_bytes(spark: SparkSession, path: str):
    """A vocabulary file (a few megabytes) as a broadcast, so that executors need no file of their own."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def let_go(*clear: Callable[[], None]) -> None:
    """Empty caches and give memory back; workers live on after a task, beside those of other stages."""
    for c in clear:
        c()
    gc.collect()
    pa.default_memory_pool().release_unused()


def add_columns(
    df: DataFrame,
    inputs: list[str],
    outputs: dict[str, T.DataType],
    start: Callable[[], tuple[Callable[..., tuple], Callable[[], None]]],
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` with the columns ``outputs``, made row by row from ``inputs``; columns of these names are replaced.

    ``start`` runs once in a task and returns what makes a row's values and what
    empties its caches. Rows pass in slices, so little is held besides the batch.
    """
    others = [c for c in df.columns if c not in outputs and c not in drop]
    source = df.select(*[F.col(f"`{c}`") for c in others], *[F.col(f"`{c}`").alias(f"_in_{k}") for k, c in enumerate(inputs)])
    kinds = [to_arrow_type(t) for t in outputs.values()]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, clear = start()
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    some = batch.slice(at, SLICE)
                    given = zip(*some.columns[len(others) :], strict=True)
                    made = zip(*[make(*(v.as_py() for v in row)) for row in given], strict=True)
                    new = [pa.array(c, kind) for c, kind in zip(made, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*some.columns[: len(others)], *new], names=[*others, *outputs])
        finally:
            let_go(clear)

    schema = T.StructType([*source.schema.fields[: len(others)], *(T.StructField(c, t) for c, t in outputs.items())])
    return source.mapInArrow(add, schema)

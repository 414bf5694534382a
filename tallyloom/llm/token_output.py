"""Packed token ids: best-fit-decreasing over a segment tree of capacities.

The pieces of all documents (only those longer than a sequence are cut, so
nothing is lost) are placed longest first, each into the fullest sequence that
still has room. Sequences are kept by the room they have left; a segment tree
over the rooms 0..capacity answers "the smallest room of at least n" in
logarithmic time. Equal sequences are one entry with a count.

A task packs blocks of ``block_pieces`` pieces as they come, so its memory is
bounded and nothing is shuffled; a block of thousands of sequences ends with a
few that are not full.

The output has a row per sequence: the ids as one row of a matrix (little-endian
unsigned 32-bit, padded to the capacity), the cumulative segment lengths from 0
to the number of tokens, and the places where positions begin at 0 again;
``position_ids`` spells the positions out.

Defined results: a null or empty text is the end token alone; repeated rows are
packed one by one; an empty table gives an empty one; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.byte_level import pack_ids
from tallyloom.llm.common import let_go, shared_bytes, text_or_empty
from tallyloom.llm.pieces import cut_points, id_encoder
from tallyloom.llm.slots import BinGroup


class RoomTree:
    """A segment tree over rooms 0..capacity that knows which of them have open sequences."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.open = [False] * (2 * self.leaves)

    def mark(self, room: int, is_open: bool) -> None:
        node = self.leaves + room
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def smallest(self, least: int) -> int | None:
        """The smallest open room of at least ``least``."""
        node = self.leaves + least
        while not self.open[node]:
            while node & 1:  # a right child: go on with what lies right of its parent
                node //= 2
            if node == 0:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[BinGroup]:
    """Groups of equal sequences that hold ``counts[length]`` pieces of each length."""
    tree = RoomTree(capacity)
    by_room: dict[int, list[BinGroup]] = {}
    closed: list[BinGroup] = []

    def put_back(group: BinGroup, room: int) -> None:
        by_room.setdefault(room, []).append(group)
        tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = tree.smallest(length)
            if room is None:
                per_bin = capacity // length
                group, room = BinGroup(max(1, left // per_bin)), capacity
            else:
                group = by_room[room].pop()
                tree.mark(room, bool(by_room[room]))
            per_bin = room // length
            filled = min(group.bins, left // per_bin)
            if filled:
                part = group.split(filled)
                part.content.append((length, per_bin))
                left -= filled * per_bin
                rest = room - per_bin * length
                closed.append(part) if not rest else put_back(part, rest)
            elif left:
                part = group.split(1)
                part.content.append((length, left))
                put_back(part, room - left * length)
                left = 0
            if group.bins:
                put_back(group, room)
    return closed + [g for groups in by_room.values() for g in groups if g.bins]


_FIELDS = {
    "sequence_id": ("long", pa.int64()), "n_tokens": ("int", pa.int32()), "doc_ids": ("array<long>", pa.list_(pa.int64())),
    "pieces": ("array<int>", pa.list_(pa.int32())), "cu_seqlens": ("array<int>", pa.list_(pa.int32())),
    "position_resets": ("array<int>", pa.list_(pa.int32())), "input_ids": ("binary", pa.binary()),
}
_SCHEMA = ", ".join(f"{c} {kind}" for c, (kind, _) in _FIELDS.items())
_ARROW = pa.schema([(c, kind) for c, (_, kind) in _FIELDS.items()])
#: A task's sequences are numbered from its own number times this on.
_TASK_SHIFT = 33
#: Sequences handed on together.
_ROWS_AT_ONCE = 128


def packed_sequences(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    pad_id: int = 0,
    capacity: int = 1024,
    block_pieces: int = 16_384,
) -> DataFrame:
    """A row per sequence: sequence_id, n_tokens, doc_ids, pieces, cu_seqlens, position_resets, input_ids."""
    content = shared_bytes(docs.sparkSession, tokenizer_path)
    end, pad = pack_ids([end_id]), pack_ids([pad_id])

    def sequences(pieces: list[tuple[int, int, bytes]]) -> Iterator[list[tuple[int, int, bytes]]]:
        """The pieces (document, number, ids) of each sequence, in order."""
        by_length: dict[int, list] = {}
        for p in pieces:
            by_length.setdefault(len(p[2]) // 4, []).append(p)
        for group in best_fit_decreasing({n: len(ps) for n, ps in by_length.items()}, capacity):
            for _ in range(group.bins):
                yield [by_length[length].pop() for length, per_bin in group.content for _ in range(per_bin)]

    def row(number: int, members: list[tuple[int, int, bytes]]) -> tuple:
        lengths = [len(ids) // 4 for _, _, ids in members]
        bounds = np.cumsum([0, *lengths], dtype=np.int32)
        ids = b"".join(ids for _, _, ids in members)
        return (
            number, int(bounds[-1]), [d for d, _, _ in members], [k for _, k, _ in members],
            bounds, bounds[:-1], ids + pad * (capacity - int(bounds[-1])),
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number, pieces = id_encoder(content.value, pattern), TaskContext.get().partitionId() << _TASK_SHIFT, []

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = []
            for members in sequences(pieces):
                rows.append(row(number, members))
                number += 1
                if len(rows) == _ROWS_AT_ONCE:
                    yield _record_batch(rows)
                    rows.clear()
            if rows:
                yield _record_batch(rows)
            pieces.clear()

        for batch in batches:
            for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = own(whole.as_py()) + end
                starts = [*cut_points(len(ids) // 4, capacity), len(ids) // 4]
                for k, (a, b) in enumerate(zip(starts, starts[1:], strict=False)):
                    pieces.append((doc, k, ids[4 * a : 4 * b]))
                    if len(pieces) == block_pieces:
                        yield from close()
        yield from close()
        let_go()

    source = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return source.mapInArrow(pack, _SCHEMA)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def position_ids(cu_seqlens: Column) -> Column:
    """0, 1, 2... for each segment."""
    lengths = F.transform(
        F.slice(cu_seqlens, 2, F.size(cu_seqlens) - 1), lambda end, k: end - F.get(cu_seqlens, k)
    )
    return F.flatten(F.transform(lengths, lambda n: F.sequence(F.lit(0), n - 1)))


def write_packed(sequences: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Write the matrices: fixed-width id rows, cumulative lengths and position resets, side by side."""
    sequences.write.option("maxRecordsPerFile", rows_per_file).parquet(path)

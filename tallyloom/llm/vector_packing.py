"""Packing by vector best-fit: tokens, documents and attention cost limit every bin.

An item of n tokens takes n tokens, one document and n squared of attention
cost, so items of one length are alike in every respect and are placed
together. Longest first; an item goes to the bin that suits it best among those
with room in every respect:

* ``norm``: the bin whose rest would be smallest, as a weighted norm of the
  rests, each as a share of its capacity;
* ``dot``: the bin whose rest points most the way of the item, as a weighted
  dot product of both, each as a share of its capacity.

Where none has room, a new bin is opened. Equal bins are kept as one group with
a count, so the work depends on the capacity and not on the number of items.

Defined results: a null or empty text is a piece of the end token alone; only
documents longer than a sequence are cut (full pieces after a first one with
the rest); repeated rows are packed one by one; an empty table gives an empty
one; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyloom.llm.pieces import token_pieces
from tallyloom.llm.slots import BinGroup, assign, length_counts, number_items


@dataclass(frozen=True)
class Capacities:
    """What one sequence may hold; None sets no limit beyond the tokens' own."""

    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None

    def vector(self) -> tuple[int, int, int]:
        return self.tokens, self.documents or self.tokens, self.attention or self.tokens**2


def need(length: int) -> tuple[int, int, int]:
    return length, 1, length * length


def vector_best_fit(
    counts: dict[int, int],
    capacities: Capacities,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    score: str = "norm",
) -> list[BinGroup]:
    """Groups of equal bins that hold ``counts[length]`` items of each length."""
    if score not in ("norm", "dot"):
        raise ValueError("score is norm or dot")
    full = capacities.vector()
    groups: list[tuple[BinGroup, tuple[int, int, int]]] = []  # with what is left in each bin
    for length in sorted(counts, reverse=True):
        item, left = need(length), counts[length]
        if any(x > c for x, c in zip(item, full, strict=True)):
            raise ValueError(f"an item of {length} tokens exceeds an empty bin")

        def rank(rest: tuple[int, int, int], item=item) -> float:
            if score == "norm":
                return sum(w * ((r - x) / c) ** 2 for w, r, x, c in zip(weights, rest, item, full, strict=True))
            return -sum(w * r * x / c / c for w, r, x, c in zip(weights, rest, item, full, strict=True))

        fitting = sorted(
            (k for k, (_, rest) in enumerate(groups) if all(r >= x for r, x in zip(rest, item, strict=True))),
            key=lambda k: rank(groups[k][1]),
        )
        for k in fitting:
            if not left:
                break
            group, rest = groups[k]
            groups[k] = (group, rest)
            left = _fill(groups, k, item, length, left)
        while left:
            per_bin = min(c // x for c, x in zip(full, item, strict=True))
            groups.append((BinGroup(max(1, left // per_bin)), full))
            left = _fill(groups, len(groups) - 1, item, length, left)
    return [g for g, _ in groups if g.bins]


def _fill(groups: list, k: int, item: tuple[int, int, int], length: int, left: int) -> int:
    """Put items into the bins of group ``k``, one bin after the other; the items that remain.

    A bin stays the best one while it still has room: each item makes its rest smaller.
    """
    group, rest = groups[k]
    per_bin = min(r // x for r, x in zip(rest, item, strict=True))
    filled, some = min(group.bins, left // per_bin), left % per_bin if left // per_bin < group.bins else 0
    for bins, put in ((filled, per_bin), (1, some)):
        if bins and put:
            part = group.split(bins)
            part.content.append((length, put))
            groups.append((part, tuple(r - put * x for r, x in zip(rest, item, strict=True))))
    if not group.bins:
        groups[k] = (group, (-1, -1, -1))  # nothing is left of it, so nothing fits
    return left - filled * per_bin - some


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    capacities: Capacities = Capacities(),  # noqa: B008
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    score: str = "norm",
) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = token_pieces(docs, id_column, text, tokenizer_path, pattern, end_id, capacities.tokens)
    groups = vector_best_fit(length_counts(pieces), capacities, weights, score)
    placed = assign(number_items(pieces), groups, capacities.tokens)
    return placed.select("doc_id", "piece", "start", placed["length"].cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")

"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation is repaired by edits of its rows in order: keep (K, 0), give the
role that is due (R, 2), delete (D, 3), and insert an empty row of the role that
is due (I, 2) anywhere, until its roles read ``(s?(ua)+)?``. Blank rows and
repeated ones must go; a truncated row that stays adds 1.

An item says that the first i rows have been repaired and what may follow:
nothing has been written yet (0), a system row (1), a user row (2), an assistant
row (3). Each edit is a deduction from one item to another; its weight function
adds a cost and appends a letter to the audit. Values (cost, audit) are compared
in this order. No deduction makes a value smaller, and audits of one item that
cost the same never begin one another, so the order of two is kept by whatever
follows: the functions are superior and monotone, and the agenda's least item is
final when it is popped. The goal is popped when all rows are read and the state
is 0 or 3.

Conversations of up to ``chunk_rows`` rows are repaired in one task each, very
many to a task. A longer one is sorted by ranges and cut into chunks of rows.
For a chunk the agenda is run from each of the four states, which gives the
lightest derivation from every state to every state; these are combined, first
among the chunks of a range, then along the conversation, by deductions with two
premises. So the agenda's work is spread, whatever share of the rows one
conversation holds. The audit is a letter per row and the digest a hash of the
whole conversation: its rows stream through one task, which holds the audit but
no more than a batch of them.

Rows are taken by turn (nulls first), then role, then text; equal rows follow
each other. Output per conversation: ``gaps`` (maxTurn - minTurn + 1 -
distinctTurns without nulls; 0 if all are null), ``blank``, ``duplicate``,
``truncated`` (rows by their first fault), ``illegal`` (neighbours whose role
initials are not su, ua or au), ``cost``, ``audit`` and ``repaired_sha256``.

Defined results: null roles and texts count as one space; rows with a null
conversation are one conversation; an empty role has no initial and fits
nowhere; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyloom.llm.common import materialize

#: Rows of a conversation that one agenda reads.
CHUNK_ROWS = 1_024
STATES = range(4)
#: The role that is due in each state, and the state after it.
DUE = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
_ENDS = (0, 3)
_LEGAL = frozenset(("su", "ua", "au"))
_BATCH = 2_000

Value = tuple[int, str]


def last_ink(text: str) -> str:
    """The last character that is no white space, or nothing."""
    kept = text.rstrip(" \t\n\x0b\x0c\r")
    return kept[-1:]


def kept_state(state: int, initial: str) -> int | None:
    """The state after a row of this role initial is kept, if it may be."""
    if initial == "s":
        return 1 if state == 0 else None
    return AFTER[state] if initial and initial == DUE[state][0] else None


def lightest(rows: list[tuple[str, str, int]], start: int, ends: tuple[int, ...] | None) -> dict[int, Value]:
    """The least (cost, audit) from ``start`` over all rows to each state, or to the lightest of ``ends`` alone.

    A row is (initial, fault, copies): fault is b (blank), d (duplicate), t (truncated) or nothing;
    copies of a row follow it and must be deleted.
    """
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: set[tuple[int, int]] = set()
    goals: dict[int, Value] = {}
    while agenda:
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == len(rows):
            if ends is None:
                goals[state] = (cost, audit)
                if len(goals) == len(STATES):
                    break
            elif state in ends:
                return {state: (cost, audit)}
        else:
            initial, fault, copies = rows[i]
            more, gone = "D" * (copies - 1), 3 * (copies - 1)
            if fault not in ("b", "d"):
                stays = cost + gone + (fault == "t")
                kept = kept_state(state, initial)
                if kept is not None:
                    heapq.heappush(agenda, (stays, audit + "K" + more, i + 1, kept))
                heapq.heappush(agenda, (stays + 2, audit + "R" + more, i + 1, AFTER[state]))
            heapq.heappush(agenda, (cost + gone + 3, audit + "D" + more, i + 1, state))
        if (i, AFTER[state]) not in final:
            heapq.heappush(agenda, (cost + 2, audit + "I", i, AFTER[state]))
    return goals


def joined(first: dict[tuple[int, int], Value], second: dict[tuple[int, int], Value]) -> dict[tuple[int, int], Value]:
    """Lightest derivations over two neighbouring stretches, by (state before, state after)."""
    out: dict[tuple[int, int], Value] = {}
    for (p, q), (cost, audit) in first.items():
        for (r, s), (more, follows) in second.items():
            if q == r and ((p, s) not in out or cost + more <= out[p, s][0]):
                value = (cost + more, audit + follows)
                out[p, s] = min(out.get((p, s), value), value)
    return out


class Repaired:
    """The repaired rows' digest, fed with the audit and the rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0
        self.digest, self.empty = hashlib.sha256(), True

    def _write(self, role: str, text: str) -> None:
        self.digest.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False

    def _insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._write(DUE[self.state], "")
            self.state, self.at = AFTER[self.state], self.at + 1

    def row(self, role: str, text: str, copies: int = 1) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += copies  # further copies are deleted
        if edit == "R":
            self._write(DUE[self.state], text)
            self.state = AFTER[self.state]
        elif edit == "K":
            self._write(role, text)
            self.state = kept_state(self.state, role[:1])

    def hexdigest(self) -> str:
        self._insert()
        return self.digest.hexdigest()


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _repair_whole(rows: list[tuple[int | None, str, str]]) -> tuple:
    """The result of a conversation that is at hand as a whole: (turn, role, text) in order."""
    seen, faults, marked = set(), {"b": 0, "d": 0, "t": 0, "": 0}, []
    for _, role, text in rows:
        last = last_ink(text)
        fault = "b" if not last else "d" if (role, text) in seen else "t" if last not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        marked.append((role[:1], fault, 1))
    illegal = sum(a[0] + b[0] not in _LEGAL for a, b in zip(marked, marked[1:], strict=False))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    ((cost, audit),) = lightest(marked, 0, _ENDS).values()
    repaired = Repaired(audit)
    for _, role, text in rows:
        repaired.row(role, text)
    return gaps, faults["b"], faults["d"], faults["t"], illegal, cost, audit, repaired.hexdigest()


def _by_group(batches: Iterator[pa.RecordBatch], keys: int, out: pa.Schema, start: Callable) -> Iterator[pa.RecordBatch]:
    """Rows in order, group by group (the first ``keys`` columns): ``start(key)`` gives what takes a row and
    what gives the group's results."""
    key, take, finish, rows = None, None, None, []

    def emit() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)
        rows.clear()
        return batch

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if take is None or row[:keys] != key:
                if finish is not None:
                    rows += finish()
                    if len(rows) >= _BATCH:
                        yield emit()
                key = row[:keys]
                take, finish = start(key)
            take(row[keys:])
    if finish is not None:
        rows += finish()
    if rows:
        yield emit()


def _grouped(df: DataFrame, keys: int, schema: T.StructType, start: Callable) -> DataFrame:
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])
    return df.mapInArrow(lambda batches: _by_group(batches, keys, arrow, start), schema)


def _result_schema(conv: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv", conv), *T.StructType.fromDDL(_RESULT).fields])


def _short(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text) repaired; a conversation must fit into a task."""

    def start(key):
        held: list[tuple] = []
        return held.append, lambda: [(*key, *_repair_whole(held))]

    dealt = rows.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    return _grouped(dealt, 1, _result_schema(rows.schema["conv"].dataType), start)


_PAIRS = [(p, q) for p in STATES for q in STATES]


def _long(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """``rows`` of conversations too long for one agenda, repaired chunk by chunk."""
    conv = rows.schema["conv"]
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    copies = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    names = ["conv", "turn", "role", "text", "copies"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, chunk, held, last = TaskContext.get().partitionId(), 0, 0, 0, None
        for batch in batches:
            chunks = np.empty(batch.num_rows, dtype=np.int64)
            for i, own in enumerate(batch.column(0).to_pylist()):
                if at + i and (own != last or held == chunk_rows):
                    chunk, held = chunk + 1, 0
                held, last = held + 1, own
                chunks[i] = chunk
            numbers = np.arange(at, at + batch.num_rows, dtype=np.int64) + (part << 40)
            at += batch.num_rows
            added = [pa.array(np.full(batch.num_rows, part, dtype=np.int32)), pa.array(chunks), pa.array(numbers)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*names, "part", "chunk", "at"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    added = T.StructType.fromDDL("part int, chunk long, at long").fields
    ranged = copies.select(*names).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = materialize(ranged.mapInArrow(number, T.StructType([*copies.select(*names).schema.fields, *added])), "long-conversations")
    # the first of the rows with one role and text, wherever it stands
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = materialize(placed.groupBy("conv", same.alias("same")).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first")), "first-rows")
    ink = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    marked = placed.join(firsts, "at", "left").select(
        "conv", "part", "chunk", "at", F.substring("role", 1, 1).alias("initial"), "copies",
        F.when(ink == "", "b").when(F.col("first").isNull(), "d").when(~ink.isin(".", "!", "?"), "t").otherwise("").alias("fault"),
    )
    folded = T.StructType([
        conv, *T.StructType.fromDDL("part int, chunk long, head string, tail string, blank long, duplicate long, truncated long, illegal long").fields,
        T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType())),
    ])

    def from_rows(key):
        held: list[tuple[str, str, int]] = []
        counts = {"b": 0, "d": 0, "t": 0, "": 0}

        def take(row):
            _, initial, many, fault = row
            held.append((initial, fault, many))
            counts[fault] += 1
            counts["b" if fault == "b" else "d"] += many - 1

        def finish():
            # copies of a row follow it and never go with it
            illegal = sum(h[2] - 1 for h in held) + sum(a[0] + b[0] not in _LEGAL for a, b in zip(held, held[1:], strict=False))
            found = {(p, q): v for p in STATES for q, v in lightest(held, p, None).items()}
            values = [found.get(pq) for pq in _PAIRS]
            return [(
                *key, held[0][0], held[-1][0], counts["b"], counts["d"], counts["t"], illegal,
                [None if v is None else v[0] for v in values], [None if v is None else v[1] for v in values],
            )]

        return take, finish

    def combine(key):
        whole: list = []

        def take(row):
            chunk, head, tail, blank, duplicate, truncated, illegal, costs, audits = row[-9:]
            own = {pq: (c, a) for pq, c, a in zip(_PAIRS, costs, audits, strict=True) if c is not None}
            if not whole:
                whole.extend([chunk, head, tail, blank, duplicate, truncated, illegal, own])
                return
            for k, n in enumerate((blank, duplicate, truncated, illegal + (whole[2] + head not in _LEGAL)), 3):
                whole[k] += n
            whole[2], whole[7] = tail, joined(whole[7], own)

        return take, whole

    def of_part(key):
        take, whole = combine(key)

        def finish():
            values = [whole[7].get(pq) for pq in _PAIRS]
            return [(*key, *whole[:7], [None if v is None else v[0] for v in values], [None if v is None else v[1] for v in values])]

        return take, finish

    goal = T.StructType([conv, *T.StructType.fromDDL("blank long, duplicate long, truncated long, illegal long, cost long, audit string").fields])

    def of_conversation(key):
        take, whole = combine(key)

        def take_from_start(row):
            take(row)
            whole[7] = {pq: v for pq, v in whole[7].items() if pq[0] == 0}

        def finish():
            return [(*key, *whole[3:7], *min(v for (_, q), v in whole[7].items() if q in _ENDS))]

        return take_from_start, finish

    chunked = _grouped(marked.repartition("conv", "part", "chunk").sortWithinPartitions("conv", "part", "chunk", "at"), 3, folded, from_rows)
    chunked = materialize(chunked, "chunk-derivations")
    of_parts = _grouped(chunked.repartition("conv", "part").sortWithinPartitions("conv", "part", "chunk"), 2, folded, of_part)
    audits = _grouped(of_parts.repartition("conv").sortWithinPartitions("conv", "part"), 1, goal, of_conversation)
    audits = materialize(audits, "audits")
    # each conversation's audit, then its rows in order
    fed = audits.select("conv", F.lit(-1).cast("long").alias("at"), "audit", F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).cast("long").alias("copies"))
    fed = fed.unionByName(placed.select("conv", "at", F.lit("").alias("audit"), "role", "text", "copies"))
    hashed = T.StructType([conv, T.StructField("repaired_sha256", T.StringType())])

    def digest(key):
        held: list[Repaired] = []

        def take(row):
            at, audit, role, text, many = row
            held.append(Repaired(audit)) if at < 0 else held[0].row(role, text, many)

        return take, lambda: [(*key, held[0].hexdigest())]

    digests = _grouped(fed.repartition("conv").sortWithinPartitions("conv", "at"), 1, hashed, digest)
    digests = digests.select(F.col("conv").alias("c"), "repaired_sha256")
    spans = placed.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    spans = spans.select(F.col("conv").alias("k"), F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"))
    whole = audits.join(digests, F.col("conv").eqNullSafe(F.col("c"))).join(spans, F.col("conv").eqNullSafe(F.col("k")))
    return whole.select("conv", *[c.split()[0] for c in _RESULT.split(", ")])


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """A row per conversation of ``rows``, as the module's docstring says, under the name of ``conv``."""

    def given(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`"), F.lit(" "))

    plain = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), given(role).alias("role"), given(text).alias("text"))
    counts = plain.groupBy("conv").agg(F.count("*").alias("n")).filter(F.col("n") > chunk_rows)
    long = materialize(counts.select(F.col("conv").alias("c")), "long-conversations")
    same = F.col("conv").eqNullSafe(F.col("c"))
    if long.isEmpty():
        return _short(plain).withColumnRenamed("conv", conv)
    short = _short(plain.join(long, same, "left_anti"))
    return short.unionByName(_long(plain.join(long, same, "left_semi"), chunk_rows)).withColumnRenamed("conv", conv)


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with planted faults, by the crc32 of ``conv_id:turn`` modulo 20:
    0 drops a row, 1 empties its text, 2 takes its ``[.!?]``, 3 repeats it, 4 makes it the user's."""
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    h = (F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"]).cast("binary")) % 20).alias("h")
    hashed = rows.select("conv_id", "turn", filled["role"].alias("role"), filled["text"].alias("text"), h).filter("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    return hashed.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("again")).drop("again")

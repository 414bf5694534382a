"""Repeated runs of lines, found by a suffix array over line ids.

The lines of every document are a sequence of line ids; the suffixes of all
sequences are sorted by prefix doubling. Ranks by the first line come first;
ranks by the first 2k lines are those of the pairs (rank at i, rank at i + k).
Each round sorts the distinct pairs by range over all tasks and writes their
numbers, which keep the order. Suffixes that no other one equals so far are
dropped, for no longer prefix can be shared.

The doubling ends at ``min_lines`` lines: suffixes of equal rank then form the
intervals of the suffix array whose longest common prefix is at least
``min_lines``, and longer prefixes change none of the lines that are deleted.
In each interval the first suffix, by document and line, is the original; the
first ``min_lines`` lines of every other one are a later copy. Copies that
follow each other line by line make up one maximal repeated run. The last of
the rounds may overlap (three lines are lines 1-2 and 2-3).

A repeated run of fewer lines is a copy too if it has ``min_words`` words. The doubling then steps through every depth up to ``min_lines``; each depth's
later copies with enough words are taken from its ranks and united with the others.

Only lines with a word are compared, by 128 bits of hash; a blank line goes with
the line before it, and blank lines at the start stay. A document that loses
nothing keeps its text as it is.

Defined results: a null text stays null and has no lines; null ids come last;
rows with the same id and the same text are one document and have the same
outcome; documents of one id and different texts are ordered by a hash of the
text; an empty table gives an empty one; extra columns are kept, and those
named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import materialize, words_of

_DOC = ["_id", "_digest"]
#: A line break with the blank lines that follow it.
_BREAK = r"\n(?:[\x20\x09-\x0D]*\n)?"


def _keys(id_column: str, text: str) -> list[Column]:
    last = F.lit(2**63 - 1)
    return [
        F.coalesce(F.col(id_column).cast("long"), last).alias("_id"),
        F.xxhash64(text).alias("_digest"),
    ]


def line_ids(docs: DataFrame, id_column: str, text: str, words: bool = False) -> DataFrame:
    """A row per line with a word: document, number of the line, its id in two halves and, if asked for, its words."""
    lines = docs.select(*_keys(id_column, text), F.posexplode(F.split(F.col(text), _BREAK, -1)).alias("at", "line"))
    return lines.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select(
        *_DOC, "at", F.xxhash64("line").alias("a"), F.xxhash64(F.lit("2"), F.col("line")).alias("b"),
        *([F.size(words_of(F.col("line"))).alias("words")] if words else []),
    )


def _ranked(pairs: DataFrame) -> DataFrame:
    """Rows with ``rank``, the order of their pair among those that occur more than once; the others go."""
    # a pair's copies are counted in the map tasks, so a very common line is no hot key
    repeated = pairs.groupBy("a", "b").agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    ranks = materialize(
        repeated.orderBy("a", "b").select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.monotonically_increasing_id().alias("rank")),
        "ranks",
    )
    same = (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))
    return pairs.join(ranks, same).select(*_DOC, "at", "rank", *[c for c in pairs.columns if c == "words"])


def _pairs(ranked: DataFrame, shift: int) -> DataFrame:
    later = ranked.select(*_DOC, (F.col("at") - shift).alias("at"), F.col("rank").alias("b"))
    return ranked.withColumnRenamed("rank", "a").join(later, [*_DOC, "at"])


def suffix_ranks(lines: DataFrame, depth: int) -> DataFrame:
    """Suffixes that share their first ``depth`` lines with another one, with equal ranks, in order of these lines."""
    ranked = materialize(_ranked(lines).dropDuplicates([*_DOC, "at"]), "suffixes")  # rows that are one document
    known = 1
    while known < depth:
        shift = min(known, depth - known)
        ranked = materialize(_ranked(_pairs(ranked, shift)), "suffixes")
        known += shift
    return ranked


def ranks_by_depth(lines: DataFrame, depth: int) -> Iterator[tuple[int, DataFrame]]:
    """The ranks of every depth from 1 to ``depth``, with the words of the run that begins at each place."""
    ranked = materialize(_ranked(lines).dropDuplicates([*_DOC, "at"]), "suffixes")  # rows that are one document
    own = ranked.select(*_DOC, "at", "words")
    yield 1, ranked
    for d in range(2, depth + 1):
        last = own.select(*_DOC, (F.col("at") - (d - 1)).alias("at"), F.col("words").alias("_last"))
        pairs = _pairs(ranked.drop("words"), 1).join(ranked.select(*_DOC, "at", "words"), [*_DOC, "at"])
        pairs = pairs.join(last, [*_DOC, "at"]).withColumn("words", F.col("words") + F.col("_last")).drop("_last")
        ranked = materialize(_ranked(pairs), "suffixes")
        yield d, ranked


def copies_of(ranked: DataFrame, depth: int) -> DataFrame:
    """Document and line where each later copy of a run of ``depth`` lines begins, and where it ends."""
    place = F.struct(*_DOC, "at")
    # written, so that the join reads it by an exchange of its own and AQE can split the rank of a very common run
    first = materialize(ranked.groupBy(F.col("rank").alias("_rank")).agg(F.min(place).alias("_first")), "first-suffixes")
    copies = ranked.join(first, F.col("rank") == F.col("_rank")).filter(place > F.col("_first"))
    return copies.select(*_DOC, "at", (F.col("at") + depth - 1).alias("end"))


def removed_lines(copies: DataFrame) -> DataFrame:
    """The numbers of all lines of each document that a copy covers."""
    return copies.groupBy(*_DOC).agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.sequence("at", "end"))))).alias("_removed")
    )


def later_copies(ranked: DataFrame, depth: int) -> DataFrame:
    """The numbers of all lines of each document that a run of ``depth`` lines or more repeats from before."""
    return removed_lines(copies_of(ranked, depth))


def later_copies_by_words(lines: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """The same for runs of ``min_lines`` lines or of ``min_words`` words, whichever is reached first."""
    found = [
        copies_of(ranked if depth == min_lines else ranked.filter(F.col("words") >= min_words), depth)
        for depth, ranked in ranks_by_depth(lines, min_lines)
    ]
    return removed_lines(reduce(DataFrame.unionByName, found))


def drop_repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_lines: int = 3, min_words: int | None = 10
) -> DataFrame:
    """``docs`` without the later copies of runs of ``min_lines`` lines or more, or of ``min_words`` words or
    more however few their lines (None: by lines alone), and with n_lines, n_removed (lines with a word) and n_runs
    (maximal runs deleted)."""
    if min_lines < 1:
        raise ValueError("a run has at least one line")
    if min_words is None:
        removed = later_copies(suffix_ranks(line_ids(docs, id_column, text), min_lines), min_lines)
    else:
        removed = later_copies_by_words(line_ids(docs, id_column, text, words=True), min_lines, min_words)
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed", "n_runs")]
    keyed = docs.select(*[F.col(f"`{c}`") for c in others], *_keys(id_column, text))
    marked = keyed.join(removed, _DOC, "left")
    lines, gone = F.split(F.col(text), _BREAK, -1), F.col("_removed")
    parts = F.struct(
        lines.alias("lines"), F.regexp_extract_all(F.col(text), F.lit(_BREAK), F.lit(0)).alias("breaks"), gone.alias("gone")
    )

    def rebuilt(p: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(p["lines"]) - 1), p["gone"])
        joined = F.transform(
            kept, lambda i, k: F.concat(F.get(p["lines"], i), F.when(k < F.size(p["lines"]) - F.size(p["gone"]) - 1, F.get(p["breaks"], i)).otherwise(""))
        )
        return F.array_join(joined, "")

    # bound as a variable: a column that is used inside a lambda would be worked out for every line
    left = F.when(gone.isNotNull(), F.get(F.transform(F.array(parts), rebuilt), F.lit(0)))
    cut = marked
    worded = F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    starts = F.filter(gone, lambda p, k: (k == 0) | (F.get(gone, k - 1) != p - 1))
    return cut.select(
        *[F.coalesce(left, F.col(text)).alias(c) if c == text else F.col(f"`{c}`") for c in others],
        F.greatest(F.lit(0), F.coalesce(F.size(worded), F.lit(0))).cast("long").alias("n_lines"),
        F.coalesce(F.when(gone.isNotNull(), F.size(gone)), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.when(gone.isNotNull(), F.size(starts)), F.lit(0)).cast("long").alias("n_runs"),
    )

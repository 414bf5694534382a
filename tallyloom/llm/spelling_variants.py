"""Spelling variants: words one letter apart, grouped under the most frequent form.

Two words are near if one inserted, deleted or replaced code point makes one the
other. Then one half of a word stands unchanged at that end of the other, so

1. the vocabulary is sorted twice, by its words and by its words read backwards,
   and cut into shards of consecutive words with a bounded number of letters;
2. a word is sent to the shards whose range holds its first half (of the word
   as it is sorted there); only the ranges' ends are known to all;
3. a shard is a bidirectional FM-index over its delimited words. The half is
   matched exactly, letter by letter to the left, and the match extended to the
   right over the other half with one error, all words of a batch together;
4. what leaves a task is, for each word and shard, the number of near words and
   the best of them, never pairs. A near word that shares both halves is
   counted in the first order only.

A beginning that very many words share is many shards, so no task holds more
than a shard, and searching words pass it in batches.

``form`` is the near word of largest count (ties: the smallest in code-point
order) if its count is ``ratio`` times the word's own or more, else null;
``root`` is what following the forms ends at. Counts at least double with each
form, so no chain is longer than the logarithm of the largest count; pointers
jump to the pointers' pointers, so the rounds are a logarithm of that.

Defined results: rows with a null word, an empty one or a null count are left
out; of repeated words the counts are added; an empty table gives an empty one;
columns besides the two are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import let_go, materialize, text_or_empty
from tallyloom.llm.fm_index import FmIndex

#: Letters of a shard; a longer word is a shard of its own.
SHARD_LETTERS = 500_000
#: Words, and letters of them, that a task searches for at a time.
_AT_ONCE, _LETTERS_AT_ONCE = 8_192, 1_000_000
_RUN = "[A-Za-z\\u00C0-\\u00FF]+"
_LAST = "\U0010ffff"


def damaged_words(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = 5) -> DataFrame:
    """A row per run of letters with ``least`` code points or more: ``word``, lower-cased (A-Z only).

    Where 97 divides h, the crc32 of ``<id>:<run>``, its code point h modulo its
    length is left out. A null text has no runs, a null id is written as nothing.
    """
    runs = docs.select(
        F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text_or_empty(f"`{text}`"), F.lit(_RUN), F.lit(0))).alias("run"),
    ).filter(F.length("run") >= least)
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    lowered = runs.select("id", F.translate("run", upper, upper.lower()).alias("run"))
    hashed = lowered.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return hashed.select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= least)


def _sorted_twice(words: DataFrame) -> DataFrame:
    """A written table (side, shard, key, n): the words (side 0) and their reversals (side 1), in shards by order."""
    both = words.select(F.lit(0).alias("side"), F.col("word").alias("key"), "n").unionByName(
        words.select(F.lit(1).alias("side"), F.reverse("word").alias("key"), "n")
    )
    letters = words.agg(F.coalesce(F.sum(F.length("word").cast("long")), F.lit(0))).first()[0]
    parts = max(2, -(-2 * letters // SHARD_LETTERS))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, last = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            shards = np.empty(batch.num_rows, dtype=np.int64)
            for i, (side, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if last is not None and (side != last or held + len(key) > SHARD_LETTERS):
                    shard, held = shard + 1, 0
                held, last = held + len(key), side
                shards[i] = shard
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards)], names=["side", "key", "n", "shard"])

    dealt = both.repartitionByRange(int(parts), "side", "key").sortWithinPartitions("side", "key")
    return materialize(dealt.mapInArrow(number, "side int, key string, n long, shard long"), "vocabulary-shards")


def _asked(shards: DataFrame) -> DataFrame:
    """A row (shard, key, exact) for each word and each shard whose range holds its first ``exact`` letters."""
    ends = shards.groupBy("side", "shard").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    # two words for every SHARD_LETTERS letters of the vocabulary
    ranges = {s: sorted((r["first"], r["last"], r["shard"]) for r in ends.filter(F.col("side") == s).collect()) for s in (0, 1)}
    known = shards.sparkSession.sparkContext.broadcast({s: tuple(map(list, zip(*r, strict=True))) for s, r in ranges.items() if r})

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, str, int]] = []
            for side, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                first, last, shard = known.value[side]
                exact = len(key) // 2 if side == 0 else len(key) - len(key) // 2
                half = key[:exact]
                rows += [(shard[k], key, exact) for k in range(bisect_left(last, half), bisect_right(first, half + _LAST))]
            kinds = (pa.int64(), pa.string(), pa.int32())
            columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "key", "exact"])

    return shards.select("side", "key").mapInArrow(route, "shard long, key string, exact int")


def _found(words: list[str], counts: np.ndarray, index: FmIndex, side: int, asked: list[tuple[str, int]]) -> pa.RecordBatch:
    """For each word asked for that has near ones in the shard: their number, and the best with its count."""
    pattern, at = index.one_error([k for k, _ in asked], np.array([e for _, e in asked], dtype=np.int64))
    rows: dict[int, tuple[int, int, str]] = {}
    for p, w in zip(pattern.tolist(), at.tolist(), strict=True):
        key, word = asked[p][0], words[w]
        if side:
            key, word = key[::-1], word[::-1]
            if word.startswith(key[: len(key) // 2]):
                continue  # counted among the words sorted forwards
        n, best = int(counts[w]), rows.get(p)
        if best is None:
            rows[p] = (1, -n, word)
        else:
            rows[p] = (best[0] + 1, *min(best[1:], (-n, word)))
    made = [(asked[p][0][::-1] if side else asked[p][0], many, word, -less) for p, (many, less, word) in rows.items()]
    kinds = {"word": pa.string(), "n_near": pa.int64(), "near": pa.string(), "near_n": pa.int64()}
    columns = [pa.array([m[c] for m in made], kind) for c, kind in enumerate(kinds.values())]
    return pa.RecordBatch.from_arrays(columns, names=list(kinds))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, asked, side, key, n, exact) in this order: a shard's words, then the words that ask it."""
    shard, words, counts, side, index = None, [], [], 0, None
    asked, letters = [], 0

    def answer():
        nonlocal asked, letters, index
        if asked and words:
            if index is None:
                index = FmIndex(words)
            yield _found(words, np.array(counts), index, side, asked)
        asked, letters = [], 0

    for batch in batches:
        for own_shard, asks, own_side, key, n, exact in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own_shard != shard:
                yield from answer()
                shard, words, counts, side, index = own_shard, [], [], own_side, None
            if asks:
                asked.append((key, exact))
                letters += len(key)
                if len(asked) == _AT_ONCE or letters >= _LETTERS_AT_ONCE:
                    yield from answer()
            else:
                words.append(key)
                counts.append(n)
    yield from answer()
    let_go()


def near_words(counts: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and the best near word (``near``, ``near_n``) for each of ``counts`` (word, n) that has one."""
    shards = _sorted_twice(counts)
    spark = counts.sparkSession
    size = shards.agg(F.count_distinct("shard")).first()[0]
    if not size:
        return counts.select("word", F.lit(0).cast("long").alias("n_near"), F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    rows = shards.select("shard", F.lit(False).alias("asks"), "side", "key", "n", F.lit(0).alias("exact")).unionByName(
        _asked(shards).select("shard", F.lit(True).alias("asks"), F.lit(0).alias("side"), "key", F.lit(0).cast("long").alias("n"), "exact")
    )
    # a shard is much work for few rows: AQE is not to merge them
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(min(size, parts), "shard").sortWithinPartitions("shard", "asks")
    found = materialize(dealt.mapInArrow(_search, "word string, n_near long, near string, near_n long"), "near-words")
    best = F.min_by(F.struct("near", "near_n"), F.struct((-F.col("near_n")).alias("less"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", "b.near", "b.near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, where following (word, form) ends; written."""
    pointers = materialize(forms.select("word", F.col("form").alias("to")), "forms")
    while True:
        ahead = pointers.select(F.col("word").alias("to"), F.col("to").alias("next"))
        jumped = materialize(pointers.join(ahead, "to", "left").select("word", "to", "next"), "jumped")
        if jumped.filter("next IS NOT NULL").isEmpty():
            return jumped.select("word", F.col("to").alias("root"))
        pointers = jumped.select("word", F.coalesce("next", "to").alias("to"))


def group_variants(counts: DataFrame, word: str = "word", n: str = "n", ratio: int = 2) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` for each different word of ``counts``."""
    own: Column = F.col(f"`{n}`").cast("long")
    usable = counts.select(F.col(f"`{word}`").alias("word"), own.alias("n")).filter("word <> '' AND n IS NOT NULL")
    words = materialize(usable.groupBy("word").agg(F.sum("n").alias("n")), "words")
    near = words.join(near_words(words), "word", "left")
    chosen = F.col("near_n") >= ratio * F.col("n")
    formed = materialize(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(chosen, F.col("near")).alias("form"), F.when(chosen, F.col("near_n")).alias("form_n"),
        ),
        "formed",
    )
    roots = _roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Repeated passages, removed after their first document, by suffix automata.

A word goes if it lies in a window of ``window`` consecutive words that also
starts in a document with a smaller id. Reading every document against automata
of the whole corpus would cost the square of it, so documents are first brought
together with the parts of the corpus that they can share a window with:

1. Each window picks its anchor, the ``anchor`` words in it with the smallest
   hash. Equal windows pick equal anchors, whatever surrounds them. Windows that
   follow each other with one anchor are one stretch of text.
2. Stretches with an anchor that another document has too are kept, and equal
   stretches counted as one with its smallest id (in the map tasks first, so a
   passage in a third of all documents is no hot key).
3. The distinct stretches of some anchors are a reference shard, with a bounded
   number of words. Its generalised suffix automaton is built in one task, where
   every state learns the smallest document that holds its words, and the
   stretches of these anchors are read through it. At each word the state of the
   last ``window`` words tells in which document they occur first. An anchor
   with more stretches than a shard holds has them dealt to several automata,
   and its stretches are read through each of them.
4. Documents get the spans found in their stretches, and lose those whose first
   document has a smaller id.

Only small rows (anchor, stretch, place) are shuffled for steps 1 and 2; texts
are shuffled twice, by document, to cut out the distinct stretches and to apply
the spans. The automata compare words themselves, so a hash collision of an
anchor can bring stretches together but never removes a word; equal stretches
are told by 128 bits.

Defined results: a null text has no words and stays null; rows with a null id
keep their text whole and are no reference; rows of one id are equal in order,
so none removes from another; texts shorter than a window stay; an empty table
gives an empty one; columns named like an output are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import SLICE, add_columns, let_go, materialize

#: Words of the stretches in one reference shard, on the average and at most.
SHARD_WORDS = 60_000
#: Multipliers of the two polynomial hashes modulo 2^64; odd, so that they have inverses.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Words whose hash a worker keeps.
_KEPT_WORDS = 200_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def split_words(text: str) -> list[bytes]:
    """The words between ASCII blanks, tabs, line breaks and feeds."""
    return text.encode().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_word_hashes().__getitem__, words), dtype=np.uint64, count=len(words))


class _Powers:
    """Powers of a base and of its inverse modulo 2^64, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            far = len(self.up)
            more = [np.uint64(pow(b, far, 2**64)) for b in (self.base, self.inverse)]
            self.up = np.concatenate([self.up, self.up * more[0]])
            self.down = np.concatenate([self.down, self.down * more[1]])
        return self.up[:n], self.down[:n]


@lru_cache(maxsize=2)
def _powers(base: int) -> _Powers:
    return _Powers(base)


def range_hashes(words: np.ndarray, base: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The polynomial hash of words[begin:end] for each pair."""
    up, down = _powers(base).upto(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[:-1], out=sums[1:])
    return (sums[end] - sums[begin]) * down[begin]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def stretches(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, two stretch hashes, first word and number of words of each stretch of a text."""
    n = len(hashes)
    grams = np.arange(n - anchor + 1)
    keys = _mix(range_hashes(hashes, _BASES[0], grams, grams + anchor))
    span = window - anchor + 1
    least = np.lib.stride_tricks.sliding_window_view(keys, span).min(axis=1)
    # windows that follow each other with one anchor are a stretch; where a text repeats itself the anchor
    # comes again and again, and the stretch is cut when the first of them has left the window
    at = np.arange(len(least))
    changed = np.r_[True, least[1:] != least[:-1]]
    begun = np.maximum.accumulate(np.where(changed, at, 0))
    first = np.flatnonzero((at - begun) % span == 0)
    last = np.r_[first[1:], len(least)] - 1
    end = last + window
    return least[first], *(_mix(range_hashes(hashes, b, first, end)) for b in _BASES), first, end - first


class SuffixAutomaton:
    """The suffix automaton of several word sequences; each state knows its smallest document."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.least: list[int | None] = [None]

    def _state(self, length: int, link: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.least.append(None)
        return len(self.next) - 1

    def _split(self, p: int, word, q: int) -> int:
        """The state of the longest string of ``q`` that ``p`` and ``word`` make."""
        length, link, nxt = self.length, self.link, self.next
        if length[p] + 1 == length[q]:
            return q
        clone = self._state(length[p] + 1, link[q], dict(nxt[q]))
        link[q] = clone
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = clone
            p = link[p]
        return clone

    def add(self, words: list, document: int) -> None:
        length, link, nxt, least = self.length, self.link, self.next, self.least
        last = 0
        for word in words:
            known = nxt[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
            else:
                new = self._state(length[last] + 1, 0, {})
                p = last
                while p >= 0 and word not in nxt[p]:
                    nxt[p][word] = new
                    p = link[p]
                if p >= 0:
                    link[new] = self._split(p, word, nxt[p][word])
                last = new
            if least[last] is None or document < least[last]:
                least[last] = document

    def finish(self) -> None:
        """Let every state know the documents of all longer strings that end in its own."""
        least, link = self.least, self.link
        for state in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            up = link[state]
            if up > 0 and (least[up] is None or least[state] < least[up]):
                least[up] = least[state]

    def first_documents(self, words: list, window: int) -> list[int | None]:
        """For each window of ``words`` the smallest document that holds it, None if there is none."""
        nxt, link, length = self.next, self.link, self.length
        state, matched, found = 0, 0, []
        for k, word in enumerate(words):
            while state and word not in nxt[state]:
                state = link[state]
                matched = length[state]
            if word in nxt[state]:
                state, matched = nxt[state][word], matched + 1
            while state and length[link[state]] >= window:
                state = link[state]
                matched = min(matched, length[state])
            if k >= window - 1:
                found.append(self.least[state] if matched >= window else None)
        return found


def _places(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """A row per stretch: anchor, both hashes of the stretch, document, place."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for at in range(0, batch.num_rows, SLICE):
            some = batch.slice(at, SLICE)
            out = []
            for doc, digest, text in zip(*(c for c in some.columns), strict=True):
                doc, digest, words = doc.as_py(), digest.as_py(), split_words(text.as_py())
                if len(words) < window:
                    continue
                h, c, c2, first, n = stretches(word_hashes(words), window, anchor)
                out.append((h, c, c2, np.full(len(h), doc), np.full(len(h), digest), first, n))
            if out:
                h, c, c2, doc, digest, first, n = (np.concatenate(x) for x in zip(*out, strict=True))
                columns = [h.view("int64"), c.view("int64"), c2.view("int64"), doc, digest, first.astype("int32"), n.astype("int32")]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["h", "c", "c2", "doc", "digest", "first", "n"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from rows(batch)
        let_go(_word_hashes().clear)

    return docs.mapInArrow(cut, "h long, c long, c2 long, doc long, digest long, first int, n int")


def _distinct(shared: DataFrame) -> DataFrame:
    """Each distinct stretch of a shared anchor: smallest document, and one place where its words stand."""
    place = F.struct("doc", "digest", "first")
    return shared.groupBy("h", "c", "c2").agg(F.min(place).alias("at"), F.first("n").alias("n"))


def _words_of_stretches(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with the words of its stretches, joined by blanks."""
    lists = wanted.groupBy(F.col("at.doc").alias("doc"), F.col("at.digest").alias("digest")).agg(
        F.collect_list(F.struct("h", "c", "c2", F.col("at.first").alias("first"), "n", "parts")).alias("s")
    )  # no longer than the document

    def start():
        def cut(text, found):
            words = split_words(text)
            return ([b" ".join(words[s["first"] : s["first"] + s["n"]]).decode() for s in found],)

        return cut, lambda: None

    joined = docs.join(lists, ["doc", "digest"]).select("doc", "text", "s")
    texts = add_columns(joined, ["text", "s"], {"pieces": T.ArrayType(T.StringType())}, start, drop=("text",))
    return texts.select("doc", F.inline(F.arrays_zip("s", "pieces"))).select("s.h", "s.c", "s.c2", "doc", "s.parts", F.col("pieces").alias("words"))


def _read_shards(pieces: DataFrame, shards: int, window: int) -> DataFrame:
    """Runs of windows with their first document for each stretch, from the automata of its anchor."""
    own = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("c"), F.col("parts"))).otherwise(0)
    dealt = (
        pieces.withColumn("own", own)
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("reference", F.col("own") == F.col("part"))
        # the anchors of a shard are told by their hash; the parts of a large anchor are shards of their own
        .withColumn("shard", F.when(F.col("parts") > 1, F.col("h")).otherwise(F.pmod(F.xxhash64("h"), F.lit(shards))))
    )

    def read(shard: pd.DataFrame) -> pd.DataFrame:
        ids: dict[str, int] = {}
        words = [[ids.setdefault(w, len(ids)) for w in text.split(" ")] for text in shard["words"]]
        automaton = SuffixAutomaton()
        for sequence, doc, reference in zip(words, shard["doc"], shard["reference"], strict=True):
            if reference:
                automaton.add(sequence, doc)
        automaton.finish()
        rows = []
        for h, c, c2, doc, sequence in zip(shard["h"], shard["c"], shard["c2"], shard["doc"], words, strict=True):
            found = [doc if f is None else f for f in automaton.first_documents(sequence, window)]
            starts = [k for k in range(len(found)) if not k or found[k] != found[k - 1]]
            lengths = [b - a for a, b in zip(starts, [*starts[1:], len(found)], strict=True)]
            rows.append((h, c, c2, [found[k] for k in starts], lengths))
        return pd.DataFrame(rows, columns=["h", "c", "c2", "firsts", "lengths"])

    schema = "h long, c long, c2 long, firsts array<long>, lengths array<int>"
    return dealt.groupBy("shard", "part").applyInPandas(read, schema)


def repeated_spans(docs: DataFrame, window: int, anchor: int, shard_words: int) -> DataFrame:
    """Per document (doc, digest) the spans (first, n) that are windows of a smaller document."""
    places = materialize(_places(docs, window, anchor), "places")
    # written, so that the join below reads both sides from their own exchange and can split a hot anchor
    common = materialize(
        places.groupBy("h").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter(F.col("lo") < F.col("hi")).select("h"),
        "anchors",
    )
    shared = materialize(places.join(common, "h", "left_semi"), "shared")
    distinct = materialize(_distinct(shared), "stretches")
    per_anchor = distinct.groupBy("h").agg(F.count("*").alias("k"), F.sum("n").alias("w"))
    several = per_anchor.filter(F.col("k") > 1).select("h", F.ceil(F.col("w") / shard_words).cast("int").alias("parts"))
    wanted = materialize(distinct.join(several, "h"), "wanted")
    words = wanted.agg(F.sum("n")).first()[0] or 0
    pieces = _words_of_stretches(docs, wanted)
    read = _read_shards(pieces, max(1, -(-words // shard_words)), window)
    # a stretch read through several automata has a run list from each
    several_runs = read.select("h", "c", "c2", F.arrays_zip("firsts", "lengths").alias("runs"))
    single = (
        distinct.join(several, "h", "left_anti")
        .select("h", "c", "c2", F.array(F.struct(F.col("at.doc").alias("firsts"), (F.col("n") - window + 1).alias("lengths"))).alias("runs"))
    )
    runs = several_runs.unionByName(single)
    earlier = F.expr(
        """filter(transform(runs, (r, k) -> struct(
             first + aggregate(slice(runs, 1, k), 0, (s, x) -> s + x.lengths) AS first,
             r.lengths + {w} - 1 AS n, r.firsts AS source)), x -> x.source < doc)""".format(w=window)
    )
    found = shared.join(runs, ["h", "c", "c2"]).select("doc", "digest", F.explode(earlier).alias("s"))
    return found.groupBy("doc", "digest").agg(F.collect_list(F.struct("s.first", "s.n")).alias("spans"))


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    window: int = 50,
    anchor: int = 16,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` without the words that repeat a smaller document, with n_words, n_removed and kept_sha256.

    A text that loses words is its kept words joined by blanks; others stay as they are.
    """
    if not 0 < anchor <= window:
        raise ValueError("an anchor must fit into a window")
    outputs = ("n_words", "n_removed", "kept_sha256")
    others = [c for c in docs.columns if c not in outputs]
    keyed = docs.select(
        *[F.col(f"`{c}`") for c in others], F.col(id_column).cast("long").alias("_doc"), F.xxhash64(text).alias("_digest")
    )
    source = docs.filter(F.col(id_column).isNotNull() & F.col(text).isNotNull()).select(
        F.col(id_column).cast("long").alias("doc"), F.xxhash64(text).alias("digest"), F.col(text).alias("text")
    )
    spans = repeated_spans(source, window, anchor, shard_words)
    spans = spans.select(F.col("doc").alias("_doc"), F.col("digest").alias("_digest"), "spans")

    def start():
        def apply(whole, spans_here):
            words = split_words(whole) if whole is not None else []
            kept = words
            if spans_here is not None:
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for s in spans_here:
                    gone[s["first"]] += 1
                    gone[s["first"] + s["n"]] -= 1
                stays = (np.cumsum(gone[:-1]) == 0).tolist()
                kept = [w for w, k in zip(words, stays, strict=True) if k]
            joined = b" ".join(kept)
            new = whole if len(kept) == len(words) else joined.decode()
            return new, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest()

        return apply, lambda: None

    marked = keyed.join(spans, ["_doc", "_digest"], "left").withColumnRenamed("spans", "_spans")
    kinds = {text: T.StringType(), "n_words": T.LongType(), "n_removed": T.LongType(), "kept_sha256": T.StringType()}
    applied = add_columns(marked, [text, "_spans"], kinds, start, drop=("_doc", "_digest", "_spans"))
    return applied.select(*[F.col(f"`{c}`") for c in others], *outputs)

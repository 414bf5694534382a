"""Token counts of whole texts; huge texts are counted in overlapping chunks.

A text of up to ``chunk_chars`` characters is encoded at once. A longer one is
cut into chunks that overlap the next one, the chunks are spread over tasks and
encoded with offsets, and neighbours are spliced where both begin a pre-token
at the same character.

Why such a place is safe: the pre-tokens after a place where one begins depend
only on the text from there on (the pattern never looks back, and added tokens
are found left to right). The first chunk is right from its start, so by
induction each chunk is right from its splice on. Near a chunk's right end the
missing text could change the cut, so the last characters (the longest added
token and the pattern's two characters of look-ahead) offer no splice.

Where two chunks share no such place, the text is taken again with chunks and
overlaps twice as long, at the latest until one chunk holds it all.

Defined results: null and empty texts have no tokens; repeated rows and null
ids are kept; a column named as the output is replaced; an empty table gives an
empty one.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm.common import materialize, shared_bytes, text_or_empty

#: Characters after a pre-token that can decide where it ends.
_LOOK_AHEAD = 2
#: Texts encoded by one call, which bounds the encodings held at a time.
_AT_ONCE = 16


@lru_cache(maxsize=2)
def tokenizer(content: bytes) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism; each thread would keep memory of its own
    return Tokenizer.from_str(content.decode())


def _check_splicing(content: bytes) -> int:
    """The characters at a chunk's right end that prove nothing; raises where splices can't be proven."""
    spec = json.loads(content)
    cut = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or cut["add_prefix_space"]:
        raise ValueError("splicing is proven for byte-level tokenizers without normalizer or added blank only")
    added = spec.get("added_tokens") or []
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
        raise ValueError("splicing is not proven for added tokens that depend on their surroundings")
    return max([len(a["content"]) for a in added], default=0) + _LOOK_AHEAD


def count_tokens(
    docs: DataFrame,
    text: str,
    tokenizer_path: str,
    out: str = "n_tokens",
    chunk_chars: int = 65_536,
    overlap_chars: int = 1_024,
) -> DataFrame:
    """``docs`` with the number of tokens of the whole ``text``."""
    if not 0 < overlap_chars <= chunk_chars:
        raise ValueError("an overlap must be positive and no longer than a chunk")
    spark = docs.sparkSession
    content = shared_bytes(spark, tokenizer_path)
    margin = _check_splicing(content.value)

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = tokenizer(content.value)
        for texts in batches:
            counts = []
            for at in range(0, len(texts), _AT_ONCE):
                some = texts.iloc[at : at + _AT_ONCE].tolist()
                counts.extend(len(e) for e in own.encode_batch_fast(some, add_special_tokens=False))
            yield pd.Series(counts, dtype="int64")

    whole = text_or_empty(text)
    long = F.char_length(whole) > chunk_chars
    huge = docs.filter(long).select(F.sha2(whole, 256).alias("key"), whole.alias("text"))
    spliced = _count_huge(huge, content, margin, chunk_chars, overlap_chars)
    others = [c for c in docs.columns if c != out]
    short = docs.filter(~long).select(*[F.col(f"`{c}`") for c in others], count(whole).alias(out))
    if spliced is None:
        return short
    keyed = docs.filter(long).select(*[F.col(f"`{c}`") for c in others], F.sha2(whole, 256).alias("_key"))
    counted = keyed.join(spliced.withColumnRenamed("key", "_key"), "_key", "left")
    return short.unionByName(counted.select(*[F.col(f"`{c}`") for c in others], F.col("n").alias(out)))


def _count_huge(huge: DataFrame, content, margin: int, chunk: int, overlap: int) -> DataFrame | None:
    """Key and count of each distinct huge text; one written table for each width that was needed."""
    done, open_keys = None, None
    while True:
        source = huge if open_keys is None else huge.join(open_keys, "key", "left_semi")
        counted = materialize(_splice(_encode(_chunks(source, chunk, overlap), content, margin, chunk, overlap)), "spliced")
        settled = counted.filter(F.col("n").isNotNull())
        done = settled if done is None else done.unionByName(settled)
        open_keys = counted.filter(F.col("n").isNull()).select("key")
        if open_keys.isEmpty():
            return done
        chunk, overlap = 2 * chunk, 2 * overlap


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """A row per chunk; a chunk also holds the overlap with the next one."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"], strict=True):
                starts = range(0, max(1, len(text) - overlap), chunk)
                for at in range(0, len(starts), 64):
                    some = starts[at : at + 64]
                    yield pd.DataFrame(
                        {
                            "key": key,
                            "i": range(at, at + len(some)),
                            "last": [s + chunk + overlap >= len(text) for s in some],
                            "piece": [text[s : s + chunk + overlap] for s in some],
                        }
                    )

    cut_up = texts.mapInPandas(cut, "key string, i long, last boolean, piece string")
    return cut_up.repartition("key", "i")


def _encode(chunks: DataFrame, content, margin: int, chunk: int, overlap: int) -> DataFrame:
    """For each chunk its tokens in all, and the pre-token starts in both overlaps.

    A start is (character of the chunk, tokens of the chunk before it).
    """

    def starts_of(encoding) -> list[tuple[int, int]]:
        found, before = [], object()
        for n, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets, strict=True)):
            if word is None or word != before:
                found.append((start, n))
            before = word
        return found

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = tokenizer(content.value)
        for batch in batches:
            rows = []
            for key, i, last, piece in batch.itertuples(index=False):
                encoding = own.encode(piece, add_special_tokens=False)
                starts = starts_of(encoding)
                left = [s for s in starts if s[0] < overlap] if i else [(0, 0)]
                right = [] if last else [(c - chunk, n) for c, n in starts if chunk <= c <= len(piece) - margin]
                rows.append((key, i, last, len(encoding), *([x[k] for x in side] for side in (left, right) for k in (0, 1))))
            yield pd.DataFrame(rows, columns=["key", "i", "last", "n", "left_at", "left_n", "right_at", "right_n"])

    schema = "key string, i long, last boolean, n long, left_at array<long>, left_n array<long>, right_at array<long>, right_n array<long>"
    return chunks.mapInPandas(encode, schema)


def _splice(encoded: DataFrame) -> DataFrame:
    """The count of each text, or null where two neighbours share no pre-token start.

    A group holds one text's overlaps, so it is no larger than the text.
    """

    def splice(chunks: pd.DataFrame) -> pd.DataFrame:
        rows = chunks.drop_duplicates("i").sort_values("i").to_dict("records")  # copies of a text have the same chunks
        total, begun = 0, 0
        for this, following in zip(rows, rows[1:], strict=False):
            ends = dict(zip(this["right_at"], this["right_n"], strict=True))
            common = next(((a, n) for a, n in zip(following["left_at"], following["left_n"], strict=True) if a in ends), None)
            if common is None:
                return pd.DataFrame({"key": [rows[0]["key"]], "n": pd.array([None], dtype="Int64")})
            total, begun = total + ends[common[0]] - begun, common[1]
        return pd.DataFrame({"key": [rows[0]["key"]], "n": pd.array([total + rows[-1]["n"] - begun], dtype="Int64")})

    return encoded.groupBy("key").applyInPandas(splice, "key string, n long")

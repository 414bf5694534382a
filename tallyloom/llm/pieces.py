"""Documents as token-id pieces of at most one sequence's length."""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm.byte_level import BYTE_ALPHABET, ByteLevelEncoder, pack_ids, to_byte_alphabet
from tallyloom.llm.common import let_go, materialize, shared_bytes, text_or_empty

#: Rows of ids that a task holds before it hands them on.
_ROWS_AT_ONCE = 512

_SCHEMA = (
    "doc_id long, piece int, start long, length int, ids_crc32 long, part int, no_in_part long"
)


def merge_ranks(model: dict) -> dict[bytes, int] | None:
    """The bytes of each token and its id, if ids follow the order of the merges and so can rank them."""
    back = {c: b for b, c in BYTE_ALPHABET.items()}
    merged = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    single = [model["vocab"].get(c) for c in back]
    if None in merged or None in single or any(a >= b for a, b in zip([max(single), *merged], merged, strict=False)):
        return None
    if len(model["vocab"]) != len(merged) + len(single) or model.get("ignore_merges") or model.get("dropout"):
        return None
    return {bytes(back[c] for c in token): i for token, i in model["vocab"].items()}


class IdEncoder:
    """Packed ids of whole texts as the tokenizer's own ``encode`` gives them.

    Where its ids rank its merges, a stretch of text is encoded by these ranks in
    one call; else its BPE model is asked for each pre-token. Texts with an added
    token in them go to the tokenizer as they are.
    """

    def __init__(self, content: bytes, pattern: str):
        self.whole = Tokenizer.from_str(content.decode())
        spec = json.loads(content)
        cut = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut.get("use_regex", True):
            raise ValueError("only byte-level tokenizers without normalizer or added blank are handled")
        self.added = [a["content"] for a in spec["added_tokens"]]
        model, ranks = self.whole.model, merge_ranks(spec["model"])
        in_one_call = None
        if ranks is not None:
            ranked = tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

            def in_one_call(text: str) -> bytes:
                return pack_ids(ranked(text))

        def encode(pre_token: str) -> bytes:
            return pack_ids(t.id for t in model.tokenize(to_byte_alphabet(pre_token.encode())))

        self.plain = ByteLevelEncoder(pattern, encode, in_one_call)

    def __call__(self, text: str) -> bytes:
        if any(a in text for a in self.added):
            return pack_ids(self.whole.encode(text, add_special_tokens=False).ids)
        return self.plain(text)


@lru_cache(maxsize=2)
def id_encoder(content: bytes, pattern: str) -> IdEncoder:
    return IdEncoder(content, pattern)


def cut_points(n: int, capacity: int) -> list[int]:
    """Where the pieces of ``n`` tokens begin: full ones, after a first one that holds the rest."""
    first = n % capacity or min(n, capacity)
    return [0, *range(first, n, capacity)]


def token_pieces(
    docs: DataFrame, id_column: str, text: str, tokenizer_path: str, pattern: str, end_id: int, capacity: int
) -> DataFrame:
    """A written table with a row per piece; ``ids_crc32`` is that of its packed ids.

    A null text is empty and so has the end token alone.
    """
    content = shared_bytes(docs.sparkSession, tokenizer_path)
    end = pack_ids([end_id])
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
    arrow = pa.schema(list(zip(names, kinds, strict=True)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seen, rows = id_encoder(content.value, pattern), TaskContext.get().partitionId(), Counter(), []
        for batch in batches:
            for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = own(whole.as_py()) + end
                n = len(ids) // 4
                starts = cut_points(n, capacity)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                    own_ids = ids[4 * a : 4 * b]
                    rows.append((doc, k, a, b - a, zlib.crc32(own_ids), part, seen[b - a]))
                    seen[b - a] += 1
                if len(rows) >= _ROWS_AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], schema=arrow)
                    rows = []
        let_go()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], schema=arrow)

    source = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return materialize(source.mapInArrow(cut, _SCHEMA), "pieces")

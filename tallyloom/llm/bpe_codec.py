"""Byte-level BPE by a sentencepiece model written straight from a rank file.

Every byte string of the vocabulary becomes a piece of printable characters,
one per byte, whose score is its negative rank; nothing is normalised. The BPE
of sentencepiece then merges the pair of lowest rank first, the leftmost among
equals, as the rank file demands. Pre-tokens are encoded one by one; decoding
maps each id's piece back to its bytes.

Nulls are empty texts: no ids, no bytes. Texts of any length are encoded whole;
a worker holds one batch of texts and a bounded cache of pre-tokens.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType

from tallyloom.llm.byte_level import BYTE_ALPHABET, ByteLevelEncoder, pack_ids, to_byte_alphabet
from tallyloom.llm.common import add_columns, shared_bytes

# Field numbers and enum values of sentencepiece's model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_NORMAL, _UNKNOWN, _UNUSED = 1, 2, 5
_MODEL_TYPE, _VOCAB_SIZE, _BPE = 3, 4, 2
_UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID = 40, 41, 42, 43
_NAME, _ADD_DUMMY_PREFIX, _REMOVE_EXTRA_WHITESPACES, _ESCAPE_WHITESPACES = 1, 3, 4, 5



def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model whose ids are the ranks; the unknown piece comes last.

    Raises if a single byte is missing, because then some text could not be encoded.
    """
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary lacks the bytes {missing}")
    by_rank = {rank: token for token, rank in ranks.items()}
    if len(by_rank) != len(ranks):
        raise ValueError("two tokens share a rank")
    size = max(by_rank) + 1
    pieces = []
    for rank in range(size):
        token = by_rank.get(rank)
        name = f"<unused {rank}>" if token is None else to_byte_alphabet(token)
        kind = _UNUSED if token is None else _NORMAL
        pieces.append(_block(_PIECE, name.encode()) + _float(_SCORE, -float(rank)) + _number(_TYPE, kind))
    pieces.append(_block(_PIECE, b"<unk>") + _float(_SCORE, 0.0) + _number(_TYPE, _UNKNOWN))
    trainer = (
        _number(_MODEL_TYPE, _BPE) + _number(_VOCAB_SIZE, size + 1) + _number(_UNK_ID, size)
        + _number(_BOS_ID, -1) + _number(_EOS_ID, -1) + _number(_PAD_ID, -1)
    )
    normalizer = (
        _block(_NAME, b"identity") + _number(_ADD_DUMMY_PREFIX, 0)
        + _number(_REMOVE_EXTRA_WHITESPACES, 0) + _number(_ESCAPE_WHITESPACES, 0)
    )
    return b"".join(_block(_PIECES, p) for p in pieces) + _block(_TRAINER, trainer) + _block(_NORMALIZER, normalizer)


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, rank_file: bytes, pattern: str):
        ranks = read_ranks(rank_file)
        model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        back = {ord(c): b for b, c in BYTE_ALPHABET.items()}
        pieces = (model.id_to_piece(i) for i in range(max(ranks.values()) + 1))
        self.bytes_of = [p.translate(back).encode("latin-1") if not p.startswith("<unused ") else b"" for p in pieces]

        def encode(pre_token: str) -> bytes:
            raw = pre_token.encode()
            rank = ranks.get(raw)  # a pre-token of the vocabulary is one token, whether merges reach it or not
            return pack_ids([rank] if rank is not None else model.encode(to_byte_alphabet(raw), out_type=int))

        self.encode = ByteLevelEncoder(pattern, encode)

        #: What makes the named columns of a value.
        self.table = {
            ("ids",): lambda text: (self.encode(text or ""),),
            ("decoded",): lambda packed: (self.decode(packed or b""),),
            ("ids", "decoded"): lambda text: (ids := self.encode(text or ""), self.decode(ids)),
        }

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(packed).cast("I")))


@lru_cache(maxsize=2)
def codec(rank_file: bytes, pattern: str) -> Codec:
    return Codec(rank_file, pattern)


def _add(df: DataFrame, column: str, outputs: tuple[str, ...], rank_path: str, pattern: str) -> DataFrame:
    """``df`` with binary columns ``outputs`` made of ``column``."""
    content = shared_bytes(df.sparkSession, rank_path)

    def start():
        own = codec(content.value, pattern)
        return own.table[outputs], lambda: None  # the cache is bounded and serves the next task

    return add_columns(df, [column], dict.fromkeys(outputs, BinaryType()), start)


def encode(df: DataFrame, text: str, rank_path: str, pattern: str) -> DataFrame:
    """``df`` with ``ids``: those of each text as packed little-endian unsigned 32-bit integers."""
    return _add(df, text, ("ids",), rank_path, pattern)


def decode(df: DataFrame, ids: str, rank_path: str, pattern: str) -> DataFrame:
    """``df`` with ``decoded``: the bytes that packed ids stand for; null ids give none, unknown ones raise."""
    return _add(df, ids, ("decoded",), rank_path, pattern)


def round_trip(df: DataFrame, text: str, rank_path: str, pattern: str) -> DataFrame:
    """``df`` with ``ids`` and, decoded from them in the same pass, ``decoded``."""
    return _add(df, text, ("ids", "decoded"), rank_path, pattern)

"""Byte-level pre-tokens with cached ids, for encoders that treat each pre-token separately."""

from __future__ import annotations

from array import array
from collections.abc import Callable

import regex

#: Entries a worker keeps in each cache; about 70 MB together. The first ones seen stay, frequent words among them.
CACHE_ENTRIES = 200_000
#: Longer pre-tokens are encoded but not kept.
LONGEST_KEPT = 64


def byte_alphabet() -> dict[int, str]:
    """A printable character for each byte: itself where it has one, else the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    alphabet = {b: chr(b) for b in own}
    rest = (b for b in range(256) if b not in alphabet)
    alphabet.update({b: chr(0x100 + i) for i, b in enumerate(rest)})
    return alphabet


BYTE_ALPHABET = byte_alphabet()


def to_byte_alphabet(raw: bytes) -> str:
    return raw.decode("latin-1").translate(BYTE_ALPHABET)


def pack_ids(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    packed = array("I", ids)
    if packed.itemsize != 4:
        raise RuntimeError("this platform has no 32-bit unsigned array")
    return packed.tobytes()


class _NotSeparable(Exception):
    """A blank stands where a split at it could cut a pre-token."""


class _Kept(dict):
    def keep(self, key: str, value: bytes) -> bytes:
        if len(key) <= LONGEST_KEPT and len(self) < CACHE_ENTRIES:
            self[key] = value
        return value


class _PreTokens(_Kept):
    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode

    def __missing__(self, pre_token: str) -> bytes:
        return self.keep(pre_token, self.encode(pre_token))


class _Chunks(_Kept):
    """Ids of the stretch from one blank or line break to the next.

    A blank or line break followed by something else than white space always
    begins a pre-token, whatever stands before it; only such stretches are kept.
    """

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        body = chunk[1:] if chunk[:1] == "\n" else chunk
        if not body or body[0].isspace():
            raise _NotSeparable
        return self.keep(chunk, self.encode(chunk if chunk[0] == "\n" else " " + chunk))


class ByteLevelEncoder:
    """Packed ids of whole texts: pre-tokens by ``pattern``, each encoded by ``encode`` and cached.

    ``encode_text``, if given, encodes any text at once and is used for stretches that are not cached yet.
    """

    def __init__(self, pattern: str, encode: Callable[[str], bytes], encode_text: Callable[[str], bytes] | None = None):
        self.find = regex.compile(pattern).findall
        self.pre_tokens = _PreTokens(encode)
        self.encode_text = encode_text or self._by_pre_tokens
        self.chunks = _Chunks(self.encode_text)

    def _by_pre_tokens(self, text: str) -> bytes:
        return b"".join(map(self.pre_tokens.__getitem__, self.find(text)))

    def __call__(self, text: str) -> bytes:
        first, *rest = text.replace("\n", " \n").split(" ")
        try:
            tail = b"".join(map(self.chunks.__getitem__, rest))
        except _NotSeparable:
            return self.encode_text(text)
        return self.encode_text(first) + tail

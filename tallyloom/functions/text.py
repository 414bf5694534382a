"""String expressions over whole texts."""

from __future__ import annotations

import html
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# (?U) gives \w, \d and \s their Unicode meaning, as analysts' scripts expect.
EMAIL = r"(?U)^[\w.\-]+@[\w.\-]+\.\w+$"

# Twelve characters shaped ddd-ddd?dddd: the eighth may be anything. The
# look-ahead consumes nothing, so overlapping numbers are all found.
PHONE = r"(?Us)(?=(\d{3}-\d{3}.\d{4}))"

# The letters of the two words that make up the score.
SCORE_WORDS = ("true", "love")


def title_case(text: Column) -> Column:
    """Capital after every non-letter, small letters elsewhere."""

    def capital(run: Column) -> Column:
        # one small letter may have two capitals, of which only the first stays
        first = F.upper(F.substring(run, 1, 1))
        return F.concat(F.substring(first, 1, 1), F.lower(F.substr(first, F.lit(2))), F.lower(F.substr(run, F.lit(2))))

    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, capital), "")


def words(text: Column) -> Column:
    """Parts between runs of white space; none are empty."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def single_spaced(text: Column) -> Column:
    """Every run of white space as one blank."""
    return F.regexp_replace(text, r"(?U)\s+", " ")


def from_end(text: Column, start: int, stop: int) -> Column:
    """Characters from ``start`` to ``stop`` counted backwards, clipped on short texts."""
    n = F.length(text)
    first, after = F.greatest(n - start, F.lit(0)), F.greatest(n - stop, F.lit(0))
    return F.substr(text, first + 1, after - first)


def letter_count(text: Column, letters: str) -> Column:
    """How often the letters of a word occur, a letter counted once per place in the word."""
    n = F.lit(0)
    for ch in letters:
        n = n + F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit("")))
    return n


def pair_score(name: Column, other: Column) -> Column:
    """Two letter counts written next to each other and read as one number."""
    couple = F.lower(F.concat(name, other))
    return F.concat(*[letter_count(couple, w).cast("string") for w in SCORE_WORDS]).cast("bigint")


def acronym(text: Column) -> Column:
    return F.array_join(F.transform(words(text), lambda w: F.upper(F.substring(w, 1, 1))), "")


def matches_start(text: Column, pattern: str) -> Column:
    """The pattern holds from the first character on."""
    return F.regexp(text, F.lit(rf"\A(?:{pattern})"))


def matches_whole(text: Column, pattern: str) -> Column:
    return F.regexp(text, F.lit(rf"\A(?:{pattern})\z"))


def is_email(text: Column) -> Column:
    return F.regexp(text, F.lit(EMAIL))


def phone_numbers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PHONE), F.lit(1))


def contains_any(text: Column, accepted: Column) -> Column:
    """Any accepted word occurs in the text, whatever the case."""
    return F.exists(accepted, lambda w: F.contains(F.lower(text), F.lower(w)))


def accepted_words(key: Column, table: Mapping[str, Sequence[str]]) -> Column:
    """The accept list of a key from a hand-written table; none for other keys."""
    pairs = [x for k, ws in table.items() for x in (F.lit(k), F.array(*[F.lit(w) for w in ws]))]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), F.array().cast("array<string>"))


@F.pandas_udf(T.StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """HTML entities to characters; over two thousand names, so not an expression."""
    return texts.map(html.unescape, na_action="ignore")

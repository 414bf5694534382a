"""Joins that stay balanced when one key holds much of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The code word of each letter.
PHONETIC_ALPHABET = {
    "A": "Alfa", "B": "Bravo", "C": "Charlie", "D": "Delta", "E": "Echo", "F": "Foxtrot", "G": "Golf",
    "H": "Hotel", "I": "India", "J": "Juliet", "K": "Kilo", "L": "Lima", "M": "Mike", "N": "November",
    "O": "Oscar", "P": "Papa", "Q": "Quebec", "R": "Romeo", "S": "Sierra", "T": "Tango", "U": "Uniform",
    "V": "Victor", "W": "Whiskey", "X": "X-ray", "Y": "Yankee", "Z": "Zulu",
}


def keep_present(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``.

    The keys of ``other`` are made distinct in its map tasks first: a key it
    repeats endlessly is then shuffled once per task.
    """
    return df.join(other.select(*on).distinct(), list(on), "left_semi")


def keep_missing(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``."""
    return df.join(other.select(*on).distinct(), list(on), "left_anti")


def with_children(parents: DataFrame, children: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every parent with its children; parents without any get one row of nulls.

    An outer join cannot split a hot key on its optional side, an inner join can
    split either, so the childless parents are added separately.
    """
    matched = parents.join(children, list(on), "inner")
    return matched.unionByName(keep_missing(parents, children, on), allowMissingColumns=True)


def aligned(left: DataFrame, right: DataFrame, label: str, how: str = "full_outer") -> DataFrame:
    """Columns side by side, matched on a unique row label.

    ``full_outer`` is column-wise concatenation, ``left`` assignment to an
    existing table.
    """
    return left.join(right, label, how)


def lookup_letters(text: Column, codes: Mapping[str, str]) -> Column:
    """The code of each character in order, or null when any has none."""
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    letters = F.filter(F.split(F.upper(text), ""), lambda c: c != "")
    found = F.transform(letters, lambda c: F.element_at(table, c))
    return F.when(~F.exists(found, lambda c: c.isNull()), found)


def band_of(value: Column, bands: Sequence[tuple]) -> Column:
    """Non-equi lookup in a hand-written (low, high, name) table; the first match wins.

    The bands are part of the expression, so no row is paired with all of them.
    """
    table = F.array(
        *[F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), F.lit(name).alias("name")) for lo, hi, name in bands]
    )
    return F.get(F.filter(table, lambda b: value.between(b["lo"], b["hi"])), F.lit(0))["name"]


def with_each(df: DataFrame, values: Sequence, name: str) -> DataFrame:
    """Every row once per member of a hand-written list, made in place without a join."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def last_on_day(df: DataFrame, date: str, month: int, day: int, order: Column) -> DataFrame:
    """Of the rows falling on a month and day of any year, the last in ``order``."""
    hits = df.filter((F.month(date) == month) & (F.day(date) == day))
    return hits.agg(F.max_by(F.struct(*df.columns), order).alias("r")).filter("r is not null").select("r.*")


def fill_templates(df: DataFrame, name: str, templates: Sequence[str], placeholder: str) -> DataFrame:
    """Each template filled in for each recipient: columns ``name``, ``template``, ``letter``."""
    letters = df.select(name, F.posexplode(F.array(*[F.lit(x) for x in templates])).alias("template", "_text"))
    return letters.select(
        name, "template", F.replace("_text", F.lit(placeholder), F.trim(F.col(name))).alias("letter")
    )

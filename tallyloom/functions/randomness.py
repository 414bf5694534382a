"""Seeded pseudo-random values that depend on a row's key alone.

``rand(seed)`` follows the partition layout, so a task that is run again after
other input arrived may draw other numbers. A keyed hash always repeats.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 13  # hex digits: 52 bits, which a double holds exactly
_SPAN = float(16**_DIGITS)


def keyed_order(key: Column, seed: int) -> Column:
    """A sort key that puts rows in a seeded random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")).cast("binary"))


def uniform(key: Column, seed: int, low: float = 0.0, high: float = 1.0) -> Column:
    """A double in [low, high)."""
    draw = F.conv(F.substring(keyed_order(key, seed), 1, _DIGITS), 16, 10).cast("double") / _SPAN
    return F.lit(float(low)) + draw * (float(high) - float(low))


def uniform_int(key: Column, seed: int, low: int, high: int) -> Column:
    """A whole number in [low, high)."""
    return F.floor(uniform(key, seed, low, high)).cast("int")


def choice(values: Sequence, key: Column, seed: int) -> Column:
    """One of ``values``, each equally likely, with replacement."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, uniform_int(key, seed, 0, len(values)) + 1)


def choices_without_replacement(values: Sequence, key: Column, seed: int, k: int) -> Column:
    """``k`` different members of ``values`` in random order."""
    keyed = F.array(
        *[F.struct(keyed_order(F.concat_ws("|", key, F.lit(str(i))), seed).alias("o"), F.lit(v).alias("v"))
          for i, v in enumerate(values)]
    )
    return F.transform(F.slice(F.sort_array(keyed), 1, k), lambda s: s["v"])

"""Writing delimited, JSON and text output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# values are written as they are, blanks at their ends and quotes included
_AS_THEY_ARE = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, sep: str = ",", mode: str = "error"
) -> None:
    out = df if columns is None else df.select(*columns)
    out.write.mode(mode).options(**_AS_THEY_ARE).csv(path, header=True, sep=sep)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """One object per line, so that the file can be split; not one object per column."""
    df.write.mode(mode).json(path)


def write_by_group(df: DataFrame, path: str, group: str, mode: str = "error") -> None:
    """One ``group=<value>`` folder per value.

    The rebalance hint gathers small groups into few files and splits big ones.
    """
    df.hint("rebalance", F.col(group)).write.mode(mode).partitionBy(group).options(**_AS_THEY_ARE).csv(
        path, header=True
    )


def write_text(lines: DataFrame, path: str, mode: str = "error") -> None:
    lines.write.mode(mode).option("lineSep", "\n").text(path)


def write_per_recipient(df: DataFrame, path: str, recipient: str, text: Column, mode: str = "error") -> None:
    """A text folder per recipient; a recipient with many lines gets several files."""
    letters = df.select(recipient, text.alias("value"))
    letters.hint("rebalance", F.col(recipient)).write.mode(mode).partitionBy(recipient).text(path)

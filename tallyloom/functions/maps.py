"""Map and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merged(base: Column, changes: Column) -> Column:
    """Entries of both maps; on a common key the later one wins."""
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(changes, k))
    return F.map_concat(kept, changes)


def value_or(m: Column, key: Column, default: Column) -> Column:
    return F.coalesce(F.try_element_at(m, key), default)


def json_record(text: Column, schema: str) -> Column:
    """JSON text as a typed record; fields that are missing are null."""
    return F.from_json(text, schema)


def json_items(text: Column) -> Column:
    """The members of a mixed JSON array, each as text."""
    return F.from_json(text, "array<string>")


def json_text(record: Column, pretty: bool = False) -> Column:
    return F.to_json(record, {"pretty": "true"} if pretty else {})


def json_value(text: Column) -> Column:
    """JSON text as a VARIANT, which keeps the type of every member; null for text that is no JSON."""
    return F.try_parse_json(text)


def json_at(value: Column, path: str, kind: str) -> Column:
    """The member at ``path`` (``$.a[0]``) as ``kind``; null where it is missing or of another kind."""
    return F.try_variant_get(value, path, kind)


def json_kind(value: Column, path: str = "$") -> Column:
    """What stands at ``path``: text, whole, number, boolean, list, record or null; null where nothing does."""
    at = F.try_variant_get(value, path, "variant")
    kind = F.schema_of_variant(at)
    return (
        F.when(F.is_variant_null(at), "null")
        .when(kind == "STRING", "text")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "BIGINT", "whole")
        .when(kind.startswith("ARRAY"), "list")
        .when(kind.startswith("OBJECT"), "record")
        .when(kind.isNotNull(), "number")
    )


def json_members(df: DataFrame, value: str) -> DataFrame:
    """A row per member of each record or list in the VARIANT column ``value``: ``pos``, ``key`` (null in a list), ``value``.

    The other columns of ``df`` must not have these names.
    """
    others = [c for c in df.columns if c != value]
    named = df.withColumnRenamed(value, "_variant")
    return named.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_variant").outer())).select(*others, "pos", "key", "value")

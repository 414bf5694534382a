"""Where each runnable query is named, next to the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyloom.session import read_table

Builder = Callable[["Tables"], DataFrame]


@dataclass(frozen=True)
class Tables:
    """The given tables of one data folder."""

    spark: SparkSession
    root: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.root, name)


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None

    def run(self, spark: SparkSession, root: str) -> DataFrame:
        return self.build(Tables(spark, root))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def keep(build: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return keep

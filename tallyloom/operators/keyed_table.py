"""A table on shared storage whose rows lie in buckets by the hash of their key.

Each bucket is a folder of its own (``bucket=7/``), so a change set reads and
rewrites only the buckets its keys fall into; the other files are not touched.
A change set of a bounded, counted size is sent to the tasks that read those
buckets, so the table's rows are not shuffled at all; a larger one is joined by
shuffling the touched buckets.

Beside the rows, each bucket has a filter of its keys: bits that every key of
the bucket sets. A new key that finds one of its bits unset is certainly new;
only the others are compared with the table's keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.joins import keep_missing
from tallyloom.session import materialize

#: Changes up to this many rows and bytes are sent to every task.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 100_000_000
#: Bits of a page of a filter, as the built-in bitmap functions have them, and bits for each key.
_PAGE_BITS = 32_768
_BITS_PER_KEY = 16


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    path: str
    key: tuple[str, ...]
    buckets: int
    pages: int
    schema: T.StructType

    @property
    def _rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def _filters(self) -> str:
        return f"{self.path}/filters"

    def _bucket(self) -> Column:
        # by its text, so that keys of one value fall into one bucket whatever their type
        return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in self.key]), self.buckets).cast("int")

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        """The table's columns that ``rows`` has, in the table's types, and ``bucket``; a null in the key is an error."""
        known = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema if f.name in rows.columns])
        has_null = F.lit(False)
        for c in self.key:
            has_null = has_null | F.col(c).isNull()
        absent = F.raise_error(F.lit(f"{', '.join(self.key)} has a null")).cast("int")
        return known.withColumn("bucket", F.when(has_null, absent).otherwise(self._bucket()))

    def _stored(self, buckets: Sequence[int] | None = None) -> DataFrame:
        stored = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(self._rows)
        return stored if buckets is None else stored.filter(F.col("bucket").isin(list(buckets)))

    def read(self) -> DataFrame:
        return self._stored().drop("bucket")

    def get(self, *value) -> DataFrame:
        """The row with this key, if there is one; reads one bucket."""
        bucket = F.pmod(F.xxhash64(*[F.lit(v).cast(self.schema[c].dataType).cast("string") for c, v in zip(self.key, value, strict=True)]), self.buckets)
        found = self._stored().filter(F.col("bucket") == bucket.cast("int"))
        for c, v in zip(self.key, value, strict=True):
            found = found.filter(F.col(c) == F.lit(v))
        return found.drop("bucket")

    def _replace(self, rows: DataFrame, path: str) -> None:
        """Write ``rows`` in place of the buckets that they are in."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)

    def _touched(self, changes: DataFrame) -> tuple[DataFrame, list[int]]:
        """The changes, written once and fit to be joined, and the buckets they fall into."""
        changes = materialize(changes, "changes")
        buckets = [r["bucket"] for r in changes.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        written = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*changes.columns)))), F.lit(0))
        rows, size = changes.agg(F.count("*"), written).first()
        return (F.broadcast(changes) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else changes), sorted(buckets)

    def _keep(self, rows: DataFrame, buckets: Sequence[int]) -> None:
        """Replace ``buckets`` by ``rows``. They are written aside first: a bucket must not be read while it is replaced,
        and one that loses all its rows must be emptied too."""
        rows = materialize(rows, "rewritten")
        left = {r["bucket"] for r in rows.select("bucket").distinct().collect()}
        self._replace(rows, self._rows)
        emptied = [b for b in buckets if b not in left]
        if emptied:
            self._drop(emptied)

    def _drop(self, buckets: Sequence[int]) -> None:
        jvm = self.spark.sparkContext._jvm
        fs = jvm.org.apache.hadoop.fs.Path(self._rows).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for b in buckets:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self._rows}/bucket={b}"), True)

    def plan_update(self, changes: DataFrame) -> tuple[DataFrame, list[int]]:
        """The rows of the buckets that ``changes`` falls into, changed, and these buckets."""
        twice = F.raise_error(F.lit("several changes for one key"))
        new = F.first(F.struct(*self.schema.names))
        single = self._bucketed(changes).groupBy("bucket", *self.key).agg(F.when(F.count("*") > 1, twice).otherwise(new).alias("_new"))
        known, buckets = self._touched(single)
        joined = self._stored(buckets).join(known, ["bucket", *self.key], "left")
        changed = [F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c) for c in self.schema.names]
        return joined.select(*changed, "bucket"), buckets

    def update(self, changes: DataFrame) -> None:
        """Replace the rows whose key is in ``changes``; unknown keys change nothing, two changes for one key are an error."""
        rows, buckets = self.plan_update(changes)
        if buckets:
            self._keep(rows, buckets)

    def delete(self, keys: DataFrame) -> None:
        known, buckets = self._touched(self._bucketed(keys.select(*self.key).distinct()))
        if buckets:
            self._keep(self._stored(buckets).join(known, ["bucket", *self.key], "left_anti").select(*self.schema.names, "bucket"), buckets)

    def _bits(self, rows: DataFrame) -> DataFrame:
        """``page``, and two bits in it, of each row's key."""
        h = F.xxhash64(F.lit(1), *[F.col(c).cast("string") for c in self.key])
        other = F.xxhash64(F.lit(2), *[F.col(c).cast("string") for c in self.key])
        return rows.withColumns({
            "page": F.pmod(F.shiftrightunsigned(h, 32), self.pages).cast("int"),
            "bit_1": F.pmod(h, _PAGE_BITS), "bit_2": F.pmod(other, _PAGE_BITS),
        })

    def _filter_pages(self, rows: DataFrame) -> DataFrame:
        bits = self._bits(rows).select("bucket", "page", F.explode(F.array("bit_1", "bit_2")).alias("bit"))
        return bits.groupBy("bucket", "page").agg(F.bitmap_construct_agg("bit").alias("bits"))

    def maybe_known(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``bucket``) and ``maybe``: false if their key is certainly not in the table."""

        def is_set(bit: str) -> Column:
            byte = F.conv(F.hex(F.substring("bits", F.floor(F.col(bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.floor(byte / F.pow(F.lit(2), F.col(bit) % 8)) % 2 == 1

        pages = self.spark.read.schema("page int, bits binary, bucket int").parquet(self._filters)
        probed = self._bits(rows).join(pages, ["bucket", "page"], "left")
        return probed.select(*rows.columns, F.coalesce(is_set("bit_1") & is_set("bit_2"), F.lit(False)).alias("maybe"))

    def insert_new(self, rows: DataFrame) -> DataFrame:
        """Add the rows whose key is not taken; of new rows with one key, the smallest.

        Gives one row: ``rows`` (different new keys), ``compared`` (those that the filters did not settle, so that
        they were joined with the table's keys) and ``added``.
        """
        on = ["bucket", *self.key]
        row = F.struct(*self.schema.names)
        single = self._bucketed(rows).groupBy(*on).agg(F.min(row).alias("_row")).select("_row.*", "bucket")
        probed = materialize(self.maybe_known(single), "probed")
        unsure = probed.filter("maybe").drop("maybe")
        asked, buckets = self._touched(unsure.select(*on))
        # of the table's keys only those asked for are shuffled
        taken = self._stored(buckets).select(*on).join(asked, on, "left_semi")
        fresh = materialize(probed.filter("NOT maybe").drop("maybe").unionByName(keep_missing(unsure, taken, on)), "fresh")
        changed = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        if changed:
            fresh.write.mode("append").partitionBy("bucket").parquet(self._rows)
            self._replace(materialize(self._merged_filters(fresh, changed), "filter-pages"), self._filters)
        added = fresh.agg(F.count("*").alias("added"))
        return probed.agg(F.count("*").alias("rows"), F.count_if("maybe").alias("compared")).join(added)

    def _merged_filters(self, fresh: DataFrame, buckets: Sequence[int]) -> DataFrame:
        old = self.spark.read.schema("page int, bits binary, bucket int").parquet(self._filters).filter(F.col("bucket").isin(list(buckets)))
        both = old.select("bucket", "page", "bits").unionByName(self._filter_pages(fresh))
        return both.groupBy("bucket", "page").agg(F.bitmap_or_agg("bits").alias("bits"))


def create(rows: DataFrame, path: str, key: Sequence[str], buckets: int) -> KeyedTable:
    """Write ``rows``, whose keys must differ, as a keyed table; room is left in the filters for as many again."""
    schema = rows.schema
    count = rows.count()
    pages = max(1, -(-2 * count * _BITS_PER_KEY // (_PAGE_BITS * buckets)))
    table = KeyedTable(rows.sparkSession, path, tuple(key), buckets, pages, schema)
    dealt = table._bucketed(rows).repartition(buckets, "bucket")
    dealt.write.partitionBy("bucket").parquet(table._rows)
    table._filter_pages(table._stored()).write.partitionBy("bucket").parquet(table._filters)
    return table

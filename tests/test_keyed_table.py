"""The bucketed table: results, files left alone, plans without a shuffle of the table, and the filters' work."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import keyed_table
from tallyloom.session import scratch_path


def files(table):
    root = table._rows.removeprefix("file:")
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")
    }


@pytest.fixture
def table(spark):
    rows = spark.range(2_000).select("id", F.concat(F.lit("n"), "id").alias("name"), (F.col("id") % 7).cast("int").alias("v"))
    return keyed_table.create(rows, scratch_path(spark, "keyed"), ["id"], buckets=8)


def contents(table):
    return {r["id"]: (r["name"], r["v"]) for r in table.read().collect()}


def test_update_touches_its_buckets_only(spark, table):
    before, names = contents(table), files(table)
    changes = spark.createDataFrame([(5, "five", None), (6, None, 60), (99_999, "unknown", 1)], "id long, name string, v int")
    plan, buckets = table.plan_update(changes.filter("id = 5"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text and len(buckets) == 1
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", text)
    table.update(changes)
    assert contents(table) == before | {5: ("five", None), 6: (None, 60)}
    touched = {r["b"] for r in changes.select(F.pmod(F.xxhash64(F.col("id").cast("string")), 8).alias("b")).collect()}
    same = [f for f in names if int(f.split("bucket=")[1].split("/")[0]) not in touched]
    assert len(touched) < 8 and same and all(files(table).get(f) == names[f] for f in same)
    assert not any(files(table).get(f) for f in set(names) - set(same))


def test_large_changes_are_joined_by_a_shuffle(spark, table, monkeypatch):
    monkeypatch.setattr(keyed_table, "BROADCAST_ROWS", 0)
    before = contents(table)
    changes = table.read().filter("id % 2 = 0").withColumn("v", F.lit(-1))
    table.update(changes)
    assert contents(table) == {k: (n, v if k % 2 else -1) for k, (n, v) in before.items()}
    table.delete(spark.range(0, 2_000, 3))
    assert set(contents(table)) == {k for k in before if k % 3}


def test_delete_to_the_last_row(spark, table):
    table.delete(spark.range(100).unionByName(spark.range(100)))
    assert set(contents(table)) == set(range(100, 2_000))
    table.delete(spark.range(5_000))
    assert contents(table) == {}
    table.insert_new(spark.createDataFrame([(1, "one", 1)], "id long, name string, v int"))
    assert contents(table) == {1: ("one", 1)}


def test_errors(spark, table):
    with pytest.raises(Exception, match="several changes"):
        table.update(spark.createDataFrame([(5, "a", 1), (5, "b", 1)], "id long, name string, v int"))
    with pytest.raises(Exception, match="has a null"):
        table.delete(spark.createDataFrame([(None,)], "id long"))
    assert len(contents(table)) == 2_000
    table.update(spark.createDataFrame([], "id long, name string, v int"))
    table.delete(spark.createDataFrame([], "id long"))
    assert len(contents(table)) == 2_000


def test_filters_settle_most_new_keys(spark, table):
    new = spark.range(10_000, 12_000).select("id", F.lit("new").alias("name"), F.lit(1).alias("v"))
    taken = spark.range(50).select("id", F.lit("taken").alias("name"), F.lit(2).alias("v"))
    counts = table.insert_new(new.unionByName(new.withColumn("v", F.lit(0))).unionByName(taken)).first()
    assert (counts["rows"], counts["added"]) == (2_050, 2_000)
    assert 50 <= counts["compared"] < 50 + 0.05 * 2_000  # the taken ones, and few others
    got = contents(table)
    assert len(got) == 4_000 and got[10_000] == ("new", 0) and got[3] == ("n3", 3)
    again = table.insert_new(new).first()  # what was added is in the filters now
    assert (again["rows"], again["compared"], again["added"]) == (2_000, 2_000, 0)
    assert [tuple(r) for r in table.get(10_001).collect()] == [(10_001, "new", 0)]
    assert table.get(77_777).count() == 0

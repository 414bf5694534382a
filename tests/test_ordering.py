"""The spread-out forms of the ordered operators equal the single-window forms.

Half of the rows share one key, and the chunk size is far below its size.
"""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import ordering, quantiles

SMALL = 37


@pytest.fixture(scope="module")
def skewed(spark):
    df = spark.range(1000).select(
        F.col("id"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"),
        ((F.col("id") * 7919) % 1000).alias("ord"),
        ((F.col("id") * 31) % 97).cast("double").alias("v"),
        F.timestamp_micros((F.col("id") * 7919 % 1000) * 1_234_567).cast("timestamp_ntz").alias("ts"),
    )
    return df.repartition(5).withColumn("key", F.nullif("key", F.lit("k3")))


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_running_total(skewed, keys):
    args = (skewed, keys, [F.asc("ord")], F.col("v"), "t")
    assert as_rows(ordering.running_total(*args, window_rows=SMALL)) == as_rows(ordering.running_total(*args))


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_row_index(skewed, keys):
    order = [F.desc("ord")]
    spread = ordering.row_index(skewed, order, "p", keys, SMALL)
    assert as_rows(spread) == as_rows(ordering.row_index(skewed, order, "p", keys))
    if not keys:
        assert sorted(r["p"] for r in spread.collect()) == list(range(1000))


def test_rolling_mean_against_pandas(skewed):
    rows = skewed.filter("key is not null")
    got = ordering.rolling_mean(rows, ["key"], [F.asc("ord")], "v", 6, "m", SMALL).select("id", "m").toPandas()
    pdf = rows.toPandas().sort_values(["key", "ord"])
    pdf["m"] = pdf.groupby("key")["v"].rolling(6).mean().reset_index(level=0, drop=True)
    both = got.merge(pdf[["id", "m"]], on="id", suffixes=("", "_want"))
    assert len(both) == len(pdf)
    assert both["m"].isna().equals(both["m_want"].isna())
    assert (both["m"] - both["m_want"]).abs().max() < 1e-9


def test_change(skewed):
    args = (skewed, ["key"], [F.asc("ord")], "v")
    assert as_rows(ordering.change_from_previous(*args, window_rows=SMALL)) == as_rows(
        ordering.change_from_previous(*args)
    )


def test_change_divides_by_the_newer_value(spark):
    df = spark.createDataFrame([("a", 1, 100.0), ("a", 2, 80.0)], "k string, o int, v double")
    row = ordering.change_from_previous(df, ["k"], [F.asc("o")], "v").first()
    assert (row["difference"], row["percent"]) == (20.0, 25.0)


def test_laps(skewed):
    rows = skewed.filter("key is not null")
    spread = ordering.lap_times(rows, ["key"], "ts", "id", SMALL)
    assert as_rows(spread) == as_rows(ordering.lap_times(rows, ["key"], "ts", "id"))
    assert spread.count() == rows.count()


def test_equal_batches(skewed):
    for rows in (SMALL, 10_000):
        sizes = ordering.equal_batches(skewed, [F.asc("ord")], 4, window_rows=rows).groupBy("batch").count().collect()
        assert {(r["batch"], r["count"]) for r in sizes} == {(i, 250) for i in (1, 2, 3, 4)}


def test_unequal_batches_are_an_error(skewed):
    with pytest.raises(Exception, match="equal batches"):
        ordering.equal_batches(skewed, [F.asc("ord")], 3).collect()


PATHS = [(10_000, 100), (SMALL, 100), (SMALL, 0)]  # built-in, bracketed, ranked as a whole


@pytest.mark.parametrize("window_rows,groups", PATHS)
def test_quantiles_against_pandas(skewed, window_rows, groups):
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.quantiles(skewed, ["key"], "v", probabilities, list("abcde"), window_rows, groups).toPandas()
    want = skewed.toPandas().fillna({"key": "none"}).groupby("key")["v"].quantile(probabilities).unstack()
    got = got.fillna({"key": "none"}).set_index("key").loc[want.index]
    assert len(got) == len(want) and (abs(got.to_numpy() - want.to_numpy()) < 1e-9).all()


@pytest.mark.parametrize("window_rows,groups", PATHS)
def test_quantile_without_key(skewed, window_rows, groups):
    got = quantiles.quantiles(skewed, [], "v", [0.5], ["m"], window_rows, groups).collect()
    assert [r["m"] for r in got] == [skewed.toPandas()["v"].median()]


@pytest.mark.parametrize("groups", [0, 100])
def test_quantiles_where_one_value_fills_half_the_group(spark, groups):
    df = spark.range(60_000).select(
        F.lit("k").alias("key"),
        F.when(F.col("id") % 2 == 0, 7.0).otherwise((F.col("id") * 7919 % 60_000).cast("double")).alias("v"),
    )
    probabilities = [0.0001, 0.1, 0.3, 0.5, 0.77, 0.99999]
    got = quantiles.quantiles(df, ["key"], "v", probabilities, list("abcdef"), 1000, groups).first()[1:]
    want = df.toPandas()["v"].quantile(probabilities).to_list()
    assert got == pytest.approx(want)


@pytest.mark.parametrize("window_rows", [SMALL, 10_000])
def test_describe_against_pandas(skewed, window_rows):
    got = quantiles.describe(skewed, ["v", "ord"], window_rows).toPandas().set_index("column")
    want = skewed.toPandas()[["v", "ord"]].describe().T
    assert (abs(got.loc[["v", "ord"]].to_numpy().astype(float) - want.to_numpy()) < 1e-6).all()


@pytest.mark.parametrize("window_rows", [3, 10_000])
def test_box(spark, window_rows):
    values = [1, 2, 2, 3, 4, 5, 6, 7, 40, None]
    df = spark.createDataFrame([("a", v) for v in values], "k string, v int")
    row = quantiles.box_stats(df, ["k"], "v", window_rows).first()
    assert tuple(row) == ("a", 2.0, 4.0, 6.0, 1, 7, 1)


def test_top_per_group_trims_before_the_shuffle(skewed):
    top = ordering.top_per_group(skewed, ["key"], [F.desc("v"), F.asc("id")], 2)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_rows_at_past_the_head(skewed):
    from tallyloom.operators.filters import rows_at

    a = rows_at(skewed, [F.asc("ord")], 10, 20).collect()
    b = rows_at(skewed, [F.asc("ord")], 10, 20, head_rows=5).collect()
    assert {r["ord"] for r in a} == {r["ord"] for r in b} == set(range(10, 20))


def test_rolling_frame_must_fit_a_chunk(skewed):
    with pytest.raises(ValueError):
        ordering.rolling_mean(skewed, ["key"], [F.asc("ord")], "v", 10, "m", 5)


def test_positions_are_those_of_pandas(skewed):
    got = ordering.row_index(skewed, [F.asc("v"), F.asc("id")], "p", (), SMALL).toPandas().sort_values("p")
    want = skewed.toPandas().sort_values(["v", "id"])
    pd.testing.assert_series_equal(got["id"].reset_index(drop=True), want["id"].reset_index(drop=True))


@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_nulls_in_running_totals(spark, limit):
    rows = [(g, i, None if i % 3 == 0 or i < 4 else i) for g in ("a", "b") for i in range(24)]
    df = spark.createDataFrame(rows, "g string, i int, v int").repartition(4)
    got = ordering.running_total(df, ["g"], [F.asc("i")], F.col("v"), "total", limit).collect()
    for g in ("a", "b"):
        seen, want = [], {}
        for _, i, v in sorted(r for r in [(r[0], r[1], r[2]) for r in rows] if r[0] == g):
            seen += [v] if v is not None else []
            want[i] = sum(seen) if seen else None
        assert {r["i"]: r["total"] for r in got if r["g"] == g} == want


@pytest.mark.parametrize("limit", [1_000_000, 4])
def test_change_keeps_the_row_after_a_null(spark, limit):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, None, 3.0, 6.0, None, None, 2.0, 4.0])], "i int, v double")
    got = ordering.change_from_previous(df.withColumn("g", F.lit("x")), ["g"], [F.asc("i")], "v", limit).collect()
    want = {1: None, 2: None, 3: 3.0, 4: None, 5: None, 6: None, 7: 2.0}
    assert {r["i"]: r["difference"] for r in got} == want

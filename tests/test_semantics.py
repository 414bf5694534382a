"""Null, tie, order and rounding rules on tables small enough to read."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import arrays, maps, randomness, text
from tallyloom.operators import aggregates, apply, clean, filters, joins, matrix, profile, reshape
from tallyloom.operators.sets import bag_difference
from tallyloom.sources import readers


def one(df):
    return df.first()[0]


def lit(spark, c):
    return spark.range(1).select(c).first()[0]


@pytest.fixture(scope="module")
def gaps(spark):
    rows = [("a", 1.0, 1), ("a", None, 2), ("b", None, 3), (None, 4.0, 4), ("a", 3.0, 5)]
    return spark.createDataFrame(rows, "k string, v double, o int")


def test_null_keys_form_no_group(gaps):
    got = aggregates.keyed(gaps, ["k"]).groupBy("k").agg(aggregates.total("v").alias("t")).collect()
    assert {(r["k"], r["t"]) for r in got} == {("a", 4.0), ("b", 0.0)}


def test_value_counts_leave_null_out(gaps):
    got = aggregates.value_counts(gaps, "k").collect()
    assert {(r["k"], r["n"], r["percent"]) for r in got} == {("a", 3, 75.0), ("b", 1, 25.0)}


def test_first_and_last_skip_nulls_per_column(spark):
    rows = [("a", None, "x", 1), ("a", 2, None, 2), ("a", 3, "z", 3), ("a", None, "w", 4)]
    df = spark.createDataFrame(rows, "k string, n int, s string, o int")
    row = aggregates.first_last(df, ["k"], F.col("o"), ["n", "s"]).first()
    assert (row["first_n"], row["last_n"], row["first_s"], row["last_s"]) == (2, 3, "x", "w")


def test_ties_go_to_the_first_in_order(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 9)], "id int, v int")
    assert aggregates.row_of_max(df, "v", F.asc("id")).first()["id"] == 2
    assert {r["id"] for r in aggregates.rows_with_max(df, "v").collect()} == {2, 3}


def test_keep_first_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, o int")
    assert {r["o"] for r in aggregates.keep_first(df, ["k"], [F.asc("o")]).collect()} == {1, 3}


def test_histogram_closes_the_last_bin_and_lists_empty_ones(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 9, 10, 10)], "v double")
    got = {r["bin"]: r["n"] for r in aggregates.histogram(df, "v").collect()}
    assert len(got) == 10 and got[1] == 1 and got[2] == 1 and got[10] == 3 and got[5] == 0


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    got = {r["bin"]: r for r in aggregates.histogram(df, "v").collect()}
    assert got[6]["n"] == 2 and sum(r["n"] for r in got.values()) == 2
    assert (got[1]["from_value"], got[10]["to_value"]) == (1.5, 2.5)


def test_linear_fit_drops_pairs_with_a_null(spark):
    rows = [("a", 1.0, 2e6), ("a", 2.0, 4e6), ("a", None, 9e6), ("a", 3.0, None)]
    row = aggregates.linear_fit(spark.createDataFrame(rows, "k string, x double, y double"), ["k"], "x", "y", 1.7).first()
    assert row["slope"] == pytest.approx(2e6) and row["r2"] == pytest.approx(1.0) and row["predicted"] == 3e6


def test_repeated_rows_are_all_but_the_first(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, "x"), (5, None), (6, None)], "id int, t string")
    assert {r["id"] for r in profile.repeated_rows(df, "id", ["t"]).collect()} == {2, 4, 6}
    assert one(profile.duplicate_count(df, ["t"])) == 3


def test_profiles(gaps):
    assert tuple(profile.shape(gaps).first()) == (5, 3, "k,v,o", "string,double,int")
    assert {tuple(r) for r in profile.info(gaps).collect()} == {("k", "string", 4), ("v", "double", 3), ("o", "int", 5)}
    assert {tuple(r) for r in profile.null_counts(gaps).collect()} == {("k", 1, True), ("v", 2, True), ("o", 0, True)}
    assert tuple(profile.distinct_counts(gaps).first()) == (2, 3, 5)


def test_sample_repeats_with_its_seed(spark):
    df = spark.range(1000)
    a = [r[0] for r in profile.sample_rows(df, "id", 20, 1).collect()]
    assert a == [r[0] for r in profile.sample_rows(df.repartition(7), "id", 20, 1).collect()]
    assert a != [r[0] for r in profile.sample_rows(df, "id", 20, 2).collect()] and len(set(a)) == 20


def test_money_keeps_null_and_refuses_text(spark):
    df = spark.createDataFrame([("$1,234.50",), (None,)], "m string")
    assert [r[0] for r in df.select(clean.money(F.col("m"))).collect()] == [1234.5, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("free",)], "m string").select(clean.money(F.col("m"))).collect()


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert [r[0] for r in df.select(clean.nan_to_null(F.col("v"))).collect()] == [None, 1.0]


@pytest.mark.parametrize(
    "year,name",
    [(1900, "not recognized"), (1924, "Greatest Generation (GI)"), (1926, "not recognized"), (1996, "Millennial"),
     (2010, "Generation Z"), (2011, "Generation Alpha")],
)
def test_generations(spark, year, name):
    assert lit(spark, clean.generation(F.lit(year))) == name


def test_ride_prices(spark):
    price = clean.ride_price
    assert lit(spark, price(F.lit(60), F.lit(11), F.lit("Y"))) == 8
    assert lit(spark, price(F.lit(60), F.lit(18), F.lit("N"))) == 7
    assert lit(spark, price(F.lit(59), F.lit(40), F.lit("N"))) is None


def test_masked_cells_keep_their_rows(gaps):
    got = clean.keep_cells(gaps, {"v": F.col("v").isNull()}).collect()
    assert len(got) == 5 and all(r["v"] is None for r in got)


def test_values_assigned_by_position(spark):
    left = spark.createDataFrame([(10,), (20,), (30,)], "id int")
    right = spark.createDataFrame([("b", 2), ("a", 1)], "x string, o int")
    for window_rows in (1, 100):
        got = clean.assign_by_position(left, [F.asc("id")], right, [F.asc("o")], window_rows)
        assert {(r["id"], r["x"]) for r in got.collect()} == {(10, "a"), (20, "b"), (30, None)}


def test_columns_ordered_by_a_row(spark):
    df = spark.createDataFrame([(1, 5, 3, 9), (2, 1, 8, 4)], "id int, a int, b int, c int")
    assert clean.columns_by_row(df, F.col("id") == 2, ["a", "b", "c"]).columns == ["id", "a", "c", "b"]


def test_integer_range_excludes_its_end_and_fractions(spark):
    df = spark.createDataFrame([(199.0,), (200.0,), (200.5,), (349.0,), (350.0,)], "v double")
    assert [r[0] for r in df.filter(filters.in_integer_range(F.col("v"), 200, 350)).collect()] == [200.0, 349.0]


def test_complement_keeps_null(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "v int")
    assert {r[0] for r in df.filter(filters.complement(F.col("v") >= 3)).collect()} == {1, None}


def test_compound_key_range_is_lexicographic(spark):
    rows = [(a, b) for a in range(5) for b in "wxyz"]
    df = spark.createDataFrame(rows, "a int, b string")
    for low, high in [((1, "y"), (3, "w")), (None, (3, "w")), ((1, "y"), None), ((2, "x"), (2, "y"))]:
        got = {tuple(r) for r in df.filter(filters.key_between(["a", "b"], low, high)).collect()}
        assert got == {r for r in rows if (low is None or r >= low) and (high is None or r <= high)}


def test_children_of_a_parent_without_any(spark):
    parents = spark.createDataFrame([(1, "p"), (2, "q")], "id int, name string")
    children = spark.createDataFrame([(1, "c"), (1, "d"), (9, "e")], "id int, text string")
    got = {tuple(r) for r in joins.with_children(parents, children, ["id"]).collect()}
    assert got == {(1, "p", "c"), (1, "p", "d"), (2, "q", None)}


def test_lookup_fails_on_unknown_letters(spark):
    codes = joins.PHONETIC_ALPHABET
    assert lit(spark, joins.lookup_letters(F.lit("Ab"), codes)) == ["Alfa", "Bravo"]
    assert lit(spark, joins.lookup_letters(F.lit("a1"), codes)) is None


def test_first_band_wins(spark):
    bands = [(0, 10, "low"), (10, 20, "high")]
    assert lit(spark, joins.band_of(F.lit(10), bands)) == "low"
    assert lit(spark, joins.band_of(F.lit(21), bands)) is None


def test_last_on_day(spark):
    df = spark.sql(
        "select * from values (1, date'1999-08-25'), (2, date'2001-08-25'), (3, date'2001-08-26') as t(id, d)"
    )
    assert [r["id"] for r in joins.last_on_day(df, "d", 8, 25, F.col("id")).collect()] == [2]
    assert joins.last_on_day(df, "d", 1, 1, F.col("id")).count() == 0


def test_pivot_refuses_two_rows_for_a_cell(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 6)], "i int, c string, v int")
    with pytest.raises(Exception, match="several rows"):
        reshape.pivot_unique(df, ["i"], "c", ["a"], "v").collect()


def test_pivot_leaves_empty_cells_null(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "i int, c string, v int")
    got = {tuple(r) for r in reshape.pivot_unique(df, ["i"], "c", ["a", "b"], "v").collect()}
    assert got == {(1, 5, None), (2, None, 6)}


def test_transpose(spark):
    df = spark.createDataFrame([("x", 1, 2), ("y", 3, 4)], "label string, a int, b int")
    got = {tuple(r) for r in reshape.transpose(df, "label", ["x", "y"], ["a", "b"]).collect()}
    assert got == {("a", 1, 3), ("b", 2, 4)}


def test_stack_drops_empty_cells(gaps):
    assert reshape.stack(gaps, ["o"], ["v"], "n", "value").count() == 3


def test_reshape_and_zip_refuse_wrong_lengths(spark):
    three = F.array(F.lit(1), F.lit(2), F.lit(3))
    with pytest.raises(Exception, match="fill the shape"):
        lit(spark, arrays.reshape(three, 2, 2))
    with pytest.raises(Exception, match="different length"):
        lit(spark, arrays.zip_rows(three, F.array(F.lit(1))))


def test_array_goldens(spark):
    a = F.array(F.lit(1), F.lit(2), F.lit(3))
    assert lit(spark, arrays.with_scalar(a, lambda x, s: x + s, 1)) == [2, 3, 4]
    assert lit(spark, arrays.pairwise(a, a, lambda x, y: x * y)) == [1, 4, 9]
    assert lit(spark, arrays.every_nth(a, 2)) == [1, 3]
    assert lit(spark, arrays.last(a, 5)) == [1, 2, 3]
    assert lit(spark, arrays.linspace(F.lit(0.0), F.lit(1.0), 5)) == [0.0, 0.25, 0.5, 0.75, 1.0]


def test_revenue_golden(spark):
    prices, amounts = (19.99, 5.49, 12.79, 7.99, 3.99), (10, 30, 5, 20, 19)
    pairs = spark.createDataFrame([(list(prices), list(amounts))], "p array<double>, q array<int>")
    got = one(pairs.select(F.aggregate(arrays.pairwise(F.col("p"), F.col("q"), lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)))
    assert got == pytest.approx(sum(p * q for p, q in zip(prices, amounts)))


def test_matrix_product(spark):
    import numpy as np

    a, b = np.arange(8.0).reshape(4, 2), np.arange(6.0).reshape(2, 3)

    def cells(m):
        return spark.createDataFrame([(i, j, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])], "i int, j int, v double")

    for limit in (0, 100):
        got = {(r["i"], r["j"]): r["v"] for r in matrix.matrix_product(cells(a), cells(b), limit).collect()}
        assert got == {(i, j): (a @ b)[i, j] for i in range(4) for j in range(3)}


def test_map_merge_and_default(spark):
    base = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    later = F.create_map(F.lit("b"), F.lit(9))
    assert lit(spark, maps.merged(base, later)) == {"a": 1, "b": 9}
    assert lit(spark, maps.value_or(base, F.lit("z"), F.lit(0))) == 0


def test_mixed_json_array_and_pretty_text(spark):
    assert lit(spark, maps.json_items(F.lit('[1, "abc", true]'))) == ["1", "abc", "true"]
    assert "\n" in lit(spark, maps.json_text(F.struct(F.lit(1).alias("a")), pretty=True))


def test_half_even_rounding(spark):
    assert [lit(spark, F.bround(F.lit(v), 0)) for v in (0.5, 1.5, 2.5)] == [0.0, 2.0, 2.0]


@pytest.mark.parametrize("s", ["they're bill's friends", "x-ray ßtraße", "ÉCOLE élan", "a1b2", ""])
def test_title_case_is_that_of_python(spark, s):
    assert lit(spark, text.title_case(F.lit(s))) == s.title()


@pytest.mark.parametrize("s", ["12 Main St, CA 90210", "CA 90210", "90210", "a", ""])
def test_slices_from_the_end(spark, s):
    assert lit(spark, text.from_end(F.lit(s), 8, 6)) == s[-8:-6]


@pytest.mark.parametrize("s", ["zb@aol.com", "zbaol.com", "zb@aolcom", "çé@école.fr", "a.b-c@d-e.f_g", "a@b.c d"])
def test_emails(spark, s):
    import re

    want = bool(re.fullmatch(r"[\w.\-]+@[\w.\-]+\.\w+", s))
    assert lit(spark, text.is_email(F.lit(s))) == want


def test_phone_numbers(spark):
    def numbers(s):
        return lit(spark, text.phone_numbers(F.lit(s)))

    assert numbers("Call me at 415-555-1011 tomorrow.") == ["415-555-1011"]
    assert numbers("415-555x4242 Moshi moshi") == ["415-555x4242"]
    windows = "111-222-333-444-5555"
    want = [windows[i : i + 12] for i in range(len(windows) - 11) if _is_phone(windows[i : i + 12])]
    assert numbers(windows) == want
    assert numbers("415-555\n4242") == ["415-555\n4242"]


def _is_phone(w):
    return w[:3].isdecimal() and w[3] == "-" and w[4:7].isdecimal() and w[8:].isdecimal()


def test_scores_acronyms_and_unescape(spark):
    assert lit(spark, text.pair_score(F.lit("Truelove"), F.lit("True"))) == 96
    assert lit(spark, text.acronym(F.lit("  random  access memory "))) == "RAM"
    got = spark.createDataFrame([("a &amp; b &lt;c&gt; &eacute;",), (None,)], "t string").select(text.unescape("t"))
    assert [r[0] for r in got.collect()] == ["a & b <c> é", None]


def test_random_values_stay_in_range(spark):
    rows = spark.range(2000).select(
        randomness.uniform(F.col("id"), 1, 10, 50).alias("u"),
        randomness.uniform_int(F.col("id"), 2, 10, 20).alias("i"),
        randomness.choices_without_replacement([1, 2, 3, 4], F.col("id"), 3, 3).alias("c"),
    )
    pdf = rows.toPandas()
    assert pdf["u"].between(10, 50, inclusive="left").all() and abs(pdf["u"].mean() - 30) < 1
    assert set(pdf["i"]) == set(range(10, 20))
    assert all(len(set(c)) == 3 for c in pdf["c"])


def test_groups_applied_in_rounds(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")).repartition(6)

    def top(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.nlargest(2, "v")

    got = apply.reduce_groups(df, ["k"], top, "k bigint, v bigint").collect()
    assert {tuple(r) for r in got} == {(0, 4998), (0, 4995), (1, 4999), (1, 4996), (2, 4997), (2, 4994)}


def test_bag_difference_takes_one_copy_each(spark):
    left = spark.createDataFrame([("a",)] * 25 + [("b",)] * 2 + [(None,)] * 3, "c string")
    right = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("b",), (None,), ("z",)], "c string")
    got = sorted((r["c"] for r in bag_difference(left, right).collect()), key=repr)
    assert got == ["a"] * 23 + [None] * 2


def test_any_function_over_whole_groups(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")).repartition(6)

    def share(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": [rows["k"].iloc[0]], "n": [len(rows)]})

    got = apply.apply_groups(df, ["k"], share, "k bigint, n bigint").collect()
    assert {tuple(r) for r in got} == {(0, 10_000), (1, 10_000), (2, 10_000)}
    with pytest.raises(ValueError, match="10000 rows"):
        apply.apply_groups(df, ["k"], share, "k bigint, n bigint", group_rows=9_999)


def test_a_header_outside_the_list_is_an_error(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "zz", 3), (2, None, 4)], "i int, h string, v int")
    assert reshape.headers(df, "h") == ["a", "zz"]
    with pytest.raises(ValueError, match="more than 1"):
        reshape.headers(df, "h", most=1)
    with pytest.raises(Exception, match="header outside the list: zz"):
        reshape.pivot_table(df, ["i"], "v", F.sum, ["h"], ["a"]).collect()
    with pytest.raises(Exception, match="header outside the list: zz"):
        reshape.pivot_unique(df, ["i"], "h", ["a"], "v").collect()
    full = reshape.pivot_unique(df, ["i"], "h", reshape.headers(df, "h"), "v")
    assert {tuple(r) for r in full.collect()} == {(1, 2, 3), (2, None, None)}


def test_csv_gives_back_what_it_was_given(spark):
    from tallyloom.session import scratch_path
    from tallyloom.sources import sinks

    values = ["  lead", "trail  ", "a\nb", 'say "x"', "a,b", "c\r\nd", "\ttab", "plain"]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v string").repartition(3)
    path = scratch_path(spark, "csv-test")
    sinks.write_csv(df, path)
    back = readers.read_csv(spark, path, "k int, v string", multi_line=True)
    assert {r["k"]: r["v"] for r in back.collect()} == dict(enumerate(values))


def test_records_and_categories(spark):
    df = readers.records_to_table(spark, [{"a": 1, "b": "x"}, {"a": None}], "a int, b string")
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (None, None)]
    got = [lit(spark, readers.file_category(F.lit(e))) for e in ("jpg", "gz", "mp3", "xyz")]
    assert got == ["images", "archives", "audio", "others"]

"""Interval joins, day sketches, fingerprints, two-phase group functions, VARIANT members and spelling's work."""

import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import maps
from tallyloom.operators import corpus, intervals, sets, sketches
from tallyloom.operators.apply import apply_with_state
from tallyloom.session import scratch_path


def test_first_bands_against_brute_force(spark):
    rnd = random.Random(9)
    values = [float(rnd.choice([rnd.uniform(-100, 100), rnd.randint(-5, 5), 0.0, 64.0])) for _ in range(400)] + [None, float("nan"), 1e12, -1e-12, 7.0]
    bands = []
    for i in range(120):
        lo = rnd.choice([None, rnd.uniform(-100, 100), float(rnd.randint(-5, 5)), -1e300])
        width = rnd.choice([0, 1e-9, 0.5, 3, 40, 1e6, -1])
        bands.append((i, lo, None if rnd.random() < 0.1 else (0.0 if lo is None else lo) + width, f"b{i}"))
    bands = [b for b in bands if not (b[1] in (None, -1e300) and rnd.random() < 0.8)]
    random.Random(1).shuffle(bands)

    def first(x):
        if x is None or x != x:
            return None
        fits = [b for b in bands if (b[1] is None or x >= b[1]) and (b[2] is None or x <= b[2])]
        return min(fits)[3] if fits else None

    rows = spark.createDataFrame([(k, x) for k, x in enumerate(values)], "k int, x double")
    table = spark.createDataFrame(bands, "i int, lo double, hi double, name string")
    got = intervals.first_bands(rows, "x", table, "lo", "hi", "i", "name", "band")
    assert {r["k"]: r["band"] for r in got.collect()} == {k: first(x) for k, x in enumerate(values)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert intervals.first_bands(rows.limit(0), "x", table, "lo", "hi", "i", "name", "band").count() == 0
    none = intervals.first_bands(rows, "x", table.limit(0), "lo", "hi", "i", "name", "band")
    assert none.filter("band IS NOT NULL").count() == 0 and none.count() == len(values)


def test_disjoint_bands_make_few_pairs(spark):
    bands = spark.range(5_000).select("id", F.col("id").cast("double").alias("lo"), (F.col("id") + 0.5).alias("hi"))
    grid = intervals.bands_on_grid(bands, "lo", "hi", 0.0, 5_000.0)
    assert grid.count() <= 2 * 5_000
    assert grid.groupBy("_level", "_cell").count().agg(F.max("count")).first()[0] <= 2


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_bands_that_all_overlap_make_no_pairs(spark, broadcast_rows, monkeypatch):
    monkeypatch.setattr(intervals, "_PIECE", intervals._PIECE if broadcast_rows else 3)
    # every band holds the middle, so pairs would be values times bands
    rnd = random.Random(4)
    inf = float("inf")
    values = [rnd.uniform(-60, 60) for _ in range(300)] + [0.0, 5.0, -5.0, inf, -inf, None, float("nan")]
    bands = [(rnd.choice([None, i]), rnd.choice([None, -rnd.uniform(0, 50), -5.0]), rnd.choice([None, rnd.uniform(0, 50), 5.0]), f"b{i}") for i in range(500, 0, -1)]
    bands = [b for b in bands if b[0] is None or b[0] > 490 or None not in b] + [(600, -inf, -58.0, "low"), (601, 58.0, inf, "high"), (0, float("nan"), None, "no"), (602, 57.0, float("nan"), None)]

    def first(x):
        if x is None or x != x:
            return None
        fits = [b for b in bands if b[0] is not None and (b[1] is None or x >= b[1]) and (b[2] is None or b[2] != b[2] or x <= b[2])]
        return min(fits, key=lambda b: b[0])[3] if fits else None

    rows = spark.createDataFrame([(k, x) for k, x in enumerate(values)], "k int, x double")
    table = spark.createDataFrame(bands, "i int, lo double, hi double, name string")
    got = intervals.first_bands(rows, "x", table, "lo", "hi", "i", "name", "band", broadcast_rows)
    assert {r["k"]: r["band"] for r in got.collect()} == {k: first(x) for k, x in enumerate(values)}
    steps = intervals.first_on_steps(table, "lo", "hi", "i", "name")
    assert steps.count() <= 2 * len(bands) and steps.filter("at IS NOT NULL").count() > 0
    levels = (2 * steps.count() + 2).bit_length()
    nodes = spark.range(1).select(intervals._nodes(F.lit(3), F.lit(2**40), 42).alias("n")).first()["n"]
    assert len(nodes) <= 2 * 42 and sum(2 ** n["level"] for n in nodes) == 2**40 - 2 and levels < 13


def test_sketches_by_day(spark):
    path = scratch_path(spark, "sketches")
    rows = spark.range(60_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("day"),
        (F.col("id") % 20_000).alias("user"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("some"),
    )
    sketches.keep_days(rows.filter("day < '2024-01-03'"), F.col("day"), ["user", "some"], path)

    def near(estimate, exact):
        return abs(estimate - exact) <= 4 * sketches.standard_error() * exact

    def exact(where):
        return rows.filter(where).agg(F.count_distinct("user"), F.count_distinct("some")).first()

    first = sketches.distinct_estimates(spark, path, ["user", "some"]).first()
    assert all(near(a, b) for a, b in zip(first, exact("day < '2024-01-03'"), strict=True))
    before = {f.path: f.modificationTime for f in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "modificationTime").collect()}
    sketches.keep_days(rows.filter("day = '2024-01-03'"), F.col("day"), ["user", "some"], path)
    after = {f.path: f.modificationTime for f in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "modificationTime").collect()}
    assert before.items() <= after.items() and len(after) > len(before)  # a new day leaves the others' files alone
    assert all(near(a, b) for a, b in zip(sketches.distinct_estimates(spark, path, ["user", "some"]).first(), exact("true"), strict=True))
    day = sketches.distinct_estimates(spark, path, ["user"], "2024-01-02", "2024-01-02").first()[0]
    assert near(day, rows.filter("day = '2024-01-02'").select("user").distinct().count())
    assert sketches.distinct_estimates(spark, path, ["user"], "2030-01-01").first()[0] == 0


def test_fingerprints_tell_one_row(spark):
    rows = spark.range(500).select((F.col("id") % 90).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("b"))
    same = rows.repartition(7, "b").orderBy(F.desc("a"))
    assert sets.fingerprint(rows) == sets.fingerprint(same) and sets.same_bag(rows, same) and sets.same_set(rows, same)
    twice = rows.unionByName(rows.limit(1))
    missing = rows.filter("b <> '3' OR b IS NULL")
    assert not sets.same_bag(rows, twice) and sets.same_set(rows, twice)
    assert not sets.same_bag(rows, missing) and not sets.same_set(rows, missing)
    # as many rows, one of them repeated in place of another
    swapped = missing.unionByName(missing.limit(1))
    assert swapped.count() == 500 and not sets.same_bag(rows, swapped)
    null_first = spark.createDataFrame([(None, 1)], "a int, b int")
    assert sets.fingerprint(null_first) != sets.fingerprint(spark.createDataFrame([(1, None)], "a int, b int"))
    assert sets.same_bag(rows.limit(0), rows.limit(0)) and not sets.same_bag(rows.limit(0), rows)
    assert not sets.no_repeats(twice) and sets.no_repeats(rows.distinct())


def test_tables_are_compared_in_parts_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(sets, "ROWS_PER_TASK", 100)
    rows = spark.range(6_000).select((F.col("id") % 5_000).alias("a"), F.when(F.col("id") % 7 > 0, (F.col("id") % 5_000).cast("string")).alias("b c"))
    copies = sets._copies(rows, rows.repartition(3, "a"), 12_000)
    plan = copies._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan
    sizes = [r["count"] for r in copies.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 100 and max(sizes) <= 150  # 5,858 different rows or fewer, in 120 parts
    bags = {
        "same": ([1, 2, 2, None], [2, None, 1, 2]), "copies": ([1, 2, 2, None], [1, 1, 2, None]), "fewer": ([1, 2], [1, 2, 2]),
        "null": ([1, None], [1]), "other": ([1, 3], [1, 2]), "none": ([], []), "left": ([1], []), "right": ([], [1]),
    }
    for name, (a, b) in bags.items():
        left, right = (spark.createDataFrame([(x,) for x in side], "x int") for side in (a, b))
        want = (set(a) == set(b), sorted(map(str, a)) == sorted(map(str, b)), len(set(a)) == len(a))
        assert tuple(sets.compare(left, right)) == want, name
        assert (sets.same_set(left, right), sets.same_bag(left, right), sets.no_repeats(left)) == want, name


@pytest.mark.parametrize("pieces", [1, 5])
def test_rows_with_their_groups_state(spark, pieces):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, "a", "b", "hot", "hot", "hot"]), k, rnd.randint(-9, 9)) for k in range(3_000)]

    def partial(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [len(part)], "total": [int(part["v"].sum())], "top": [int(part["v"].max())]})

    def merge(states: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [states["n"].sum()], "total": [states["total"].sum()], "top": [states["top"].max()]})

    def finish(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": part["k"], "below": part["top"] - part["v"], "share": part["total"] / part["n"]})

    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(6)
    got = apply_with_state(df, ["g"], partial, merge, "n long, total long, top long", finish, "k int, below long, share double", pieces)
    by_group = {g: [v for h, _, v in rows if h == g] for g in {r[0] for r in rows}}
    want = {k: (max(by_group[g]) - v, sum(by_group[g]) / len(by_group[g])) for g, k, v in rows}
    assert {r["k"]: (r["below"], r["share"]) for r in got.collect()} == want
    nothing = apply_with_state(df.limit(0), ["g"], partial, merge, "n long, total long, top long", finish, "k int, below long, share double")
    assert nothing.count() == 0


def test_variant_members_keep_their_types(spark):
    rows = [(1, '{"a": 1, "b": [true, "x", null, 2.5, {"c": []}]}'), (2, "[1, 2]"), (3, "no json"), (4, None), (5, "{}"), (6, '"text"')]
    v = F.col("v")
    df = spark.createDataFrame(rows, "id int, t string").select("id", maps.json_value(F.col("t")).alias("v"))
    paths = ["$.a", "$.b", "$.b[0]", "$.b[1]", "$.b[2]", "$.b[3]", "$.b[4]", "$.b[4].c", "$.none"]
    first = df.filter("id = 1").select(*[maps.json_kind(v, p).alias(p) for p in paths]).first()
    assert list(first) == ["whole", "list", "boolean", "text", "null", "number", "record", "list", None]
    assert [r[0] for r in df.orderBy("id").select(maps.json_kind(v)).collect()] == ["record", "list", None, None, "record", "text"]
    assert [r[0] for r in df.orderBy("id").select(maps.json_at(v, "$.a", "string")).collect()][:1] == ["1"]
    members = maps.json_members(df, "v").select("id", "pos", "key", maps.json_at(F.col("value"), "$", "bigint").alias("n"))
    got = sorted((tuple(r) for r in members.collect()), key=str)
    assert got == [(1, 0, "a", 1), (1, 1, "b", None), (2, 0, None, 1), (2, 1, None, 2)]


def test_spelling_looks_at_few_pairs(spark):
    """Candidates per unknown word follow its true neighbours, not the number of words."""
    rnd = random.Random(6)
    parts = ["en", "er", "ch", "de", "un", "ge", "re", "tion", "le", "be", "st", "an", "ou", "ver"]
    words = sorted({"".join(rnd.choice(parts) for _ in range(rnd.randint(4, 9))) for _ in range(30_000)})
    unknown = [w[:3] + "q" + w[4:7] + "zz" + w[8:] for w in words[::100]]
    known = spark.createDataFrame([(w, 1) for w in words], "candidate string, n long")
    asked = spark.createDataFrame([(w,) for w in unknown], "word string")
    pairs = corpus.spelling_candidates(asked, known, 2).distinct().count()
    assert pairs < 20 * len(unknown) < len(words) * len(unknown) / 500
    keys = np.array(sorted(r["key"] for r in corpus.with_deletion_keys(asked.limit(1), "word", 1, corpus.segment_probes).collect()))
    word = asked.limit(1).first()["word"]
    assert len(keys) == len(word) + 1 and len(set(keys)) == len({word[:i] + word[i + 1 :] for i in range(len(word))}) + 1


def test_spelling_of_long_words(spark):
    long = "abcdefghij" * 4
    known = spark.createDataFrame([(long, 5), ("x" * 33, 2), ("ab", 9)], "word string, n long")
    asked = [long[:5] + long[6:20] + "z" + long[20:], long[:1] + long[2] + long[1] + long[3:], "x" * 31, "x" * 30, "y" * 5000, "ba", ""]
    got = {r["word"]: r["correction"] for r in corpus.correct_words(spark.createDataFrame([(w,) for w in asked], "word string"), known).collect()}
    assert got == {asked[0]: long, asked[1]: long, "x" * 31: "x" * 33, "x" * 30: "x" * 30, "y" * 5000: "y" * 5000, "ba": "ab", "": "ab"}


@pytest.mark.parametrize("limit", [10**9, 0])
def test_tiles_multiply_as_numpy_does(spark, limit):
    from tallyloom.operators import matrix

    rnd = np.random.default_rng(8)
    a, b = rnd.normal(size=(70, 23)), rnd.normal(size=(23, 11))
    b[5:9, 3] = 0.0  # absent cells are zero
    rows = spark.createDataFrame([(f"r{i}", [float(x) for x in a[i]]) for i in range(70)], "id string, v array<double>").repartition(3)
    cells = spark.createDataFrame([(i, f"c{j}", float(b[i, j])) for i in range(23) for j in range(11) if b[i, j]], "i int, j string, v double")
    left = matrix.row_tiles(rows, "id", "v", height=16, width=8)
    got = matrix.tile_product(left, matrix.cell_tiles(cells, 8, 8), 8, limit)
    want = a @ b
    found = {(r["i"], r["j"]): r["v"] for r in got.collect()}
    assert len(found) == 70 * 11 and all(abs(found[f"r{i}", f"c{j}"] - want[i, j]) < 1e-9 for i in range(70) for j in range(11))
    assert left.count() <= 3 * 3 * -(-70 // 16) < 70 * 23 / 20  # far fewer rows than numbers


def test_language_folds_windows_where_texts_are_read(spark, monkeypatch):
    # small parts, so that texts are cut; letters of one to four bytes, words of one letter, texts without any
    monkeypatch.setattr(corpus, "_LETTERS", 50)
    texts = ["the cat, the dog; x", "Né à ÇA où", "漢字 仮名 交じり文", "𐐨𐐩𐐪 𐐨 a𐐫b", "", None, "12 !?", "a " * 90, "lorem" * 40 + " é"]

    def windows(text):
        framed = f" {' '.join(re.findall(r'[^\W\d_]+', (text or '').lower()))} "
        return [framed[k : k + 3] for k in range(len(framed) - 2) if framed[k + 1] != " "]

    got = [[] for _ in texts]
    for rows, numbers, codes in corpus._windows(pa.array([t if t is None else f" {' '.join(re.findall(r'[^\W\d_]+', t.lower()))} " for t in texts])):
        for row, number in zip(rows, numbers, strict=True):
            got[row].append("".join(map(chr, codes[number])))
    assert got == [windows(t) for t in texts]
    table = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    assert {r["k"]: r["g"] for r in table.select("k", F.coalesce(corpus.trigrams(F.col("t")), F.array()).alias("g")).collect()} == dict(enumerate(got))

    docs = spark.createDataFrame([(k, t, [None, "en", "fr"][k % 3]) for k, t in enumerate(texts * 3)], "id long, t string, lang string").coalesce(1)
    languages, model = corpus.language_model(docs, "t", "lang")
    assert languages == ["en", "fr"] and {r["gram"] for r in model.collect()} == {g for k, t in enumerate(texts * 3) if k % 3 for g in windows(t)}
    shares = ["share_0", "share_1"]
    scored, joined = ({r["id"]: tuple(round(r[s], 9) for s in shares) for r in f(docs, "id", "t", model, shares).collect()} for f in (corpus._scored_sums, corpus._joined_sums))
    assert scored == joined and 1 in scored and not {0, 4, 5} & scored.keys()
    # what leaves the tasks that read texts is folded: windows are no rows
    hot = spark.createDataFrame([(k, "the cat and the dog " * 50, "en") for k in range(200)], "id long, t string, lang string").coalesce(1)
    monkeypatch.undo()
    one = list(corpus._count_windows(iter(hot.select("lang", corpus._framed(F.col("t")).alias("t")).toArrow().to_batches())))
    assert sum(b.num_rows for b in one) < 100 and sum(b.column(2).to_pylist()[0] for b in one) > 0
    assert "Generate" not in corpus.guess_language(hot, "id", "t", "lang")._jdf.queryExecution().executedPlan().toString()

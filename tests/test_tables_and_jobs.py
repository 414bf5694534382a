"""Table maintenance, files, streaming and the corpus jobs."""

import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import corpus, markup, tables
from tallyloom.plans import load_all
from tallyloom.session import scratch_path
from tallyloom.sources import readers, sinks
from tallyloom.streaming import alerts


def new_path(spark, label):
    return scratch_path(spark, f"test-{label}")


@pytest.fixture(scope="module")
def books(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "id long, title string, rating double")


def ids(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def test_update_delete_insert(spark, books):
    changes = spark.createDataFrame([(2, "b", None), (9, "x", 9.0)], "id long, title string, rating double")
    assert ids(tables.update(books, changes, ["id"]), "id", "rating") == [(1, 1.0), (2, None), (3, 3.0)]
    assert ids(tables.delete(books, changes, ["id"]), "id") == [(1,), (3,)]
    assert ids(tables.insert_new(books, changes, ["title"]), "id") == [(1,), (2,), (3,), (9,)]


def test_two_changes_for_one_key_are_an_error(spark, books):
    twice = books.filter("id = 1").unionByName(books.filter("id = 1"))
    with pytest.raises(Exception, match="several changes"):
        tables.update(books, twice, ["id"]).collect()


def test_point_read(books):
    assert ids(tables.by_key(books, "id", 2), "title") == [("b",)]
    with pytest.raises(Exception, match="no row with id = 7"):
        tables.by_key(books, "id", 7).collect()


def test_create_and_insert(spark, books):
    path, schema = new_path(spark, "books"), "id bigint not null, title string not null, rating double"
    assert tables.create(spark, path, schema).count() == 0
    tables.insert(path, books, schema)
    assert ids(spark.read.parquet(path), "id") == [(1,), (2,), (3,)]
    with pytest.raises(Exception, match="title is null"):
        tables.insert(path, books.withColumn("title", F.lit(None).cast("string")), schema)


def test_constraints(spark, books):
    assert tables.unique_violations(books.unionByName(books.filter("id = 1")), ["title"]).first()["n"] == 2
    children = spark.createDataFrame([(1,), (8,)], "id long")
    assert ids(tables.orphans(children, books, ["id"])) == [(8,)]


def test_csv_inference_and_renaming(spark, books):
    path = new_path(spark, "csv")
    sinks.write_csv(books.withColumn("title", F.concat("title", F.lit(' "q", x'))), path, ["id", "title"], sep=";")
    df = readers.read_csv(spark, path, sep=";", names=["key", "name"])
    assert dict(df.dtypes)["key"] in ("int", "bigint")
    assert ids(df)[0] == (1, 'a "q", x')


def test_chosen_sheets_are_pruned(spark, books):
    path = new_path(spark, "sheets")
    sinks.write_by_group(books.withColumnRenamed("title", "sheet"), path, "sheet")
    df = readers.read_sheets(spark, path, "id bigint, rating double", ["b"])
    assert re.search(r"PartitionFilters: \[[^\]]*sheet", df._jdf.queryExecution().executedPlan().toString())
    assert ids(df, "id", "sheet") == [(2, "b")]


def test_whole_files(spark):
    path = new_path(spark, "text")
    sinks.write_text(spark.createDataFrame([("one",), ("two",)], "value string").coalesce(1), path)
    assert readers.read_whole_files(spark, path).first()[0] == "one\ntwo\n"


def test_json_records(spark):
    df = spark.createDataFrame([('{"2024-01-02": {"4. close": "10.5"}, "2024-01-01": {"4. close": "9"}}',)], "j string")
    rows = readers.explode_dated_records(df, "j")
    assert sorted((r["day"], r["record"]["4. close"]) for r in rows.collect()) == [("2024-01-01", "9"), ("2024-01-02", "10.5")]


def test_stream_equals_batch_and_resumes(spark):
    root = "/root/testdata/sf0.001"
    from tallyloom.plans.streams import filtered

    events = spark.read.parquet(f"{root}/events.parquet")
    folder, out, log = (new_path(spark, x) for x in ("in", "out", "log"))
    first, second = events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")
    first.write.parquet(folder)
    for part in (None, second):
        if part is not None:
            part.write.mode("append").parquet(folder)
        stream = alerts.open_stream(spark, folder, events.schema)
        alerts.start_alerts(filtered(stream), out, log, once=True).awaitTermination()
    assert ids(spark.read.parquet(out)) == ids(filtered(events))


def _plain(a, b):
    """Levenshtein distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        nxt = [i]
        for j, y in enumerate(b, 1):
            nxt.append(min(row[j] + 1, nxt[-1] + 1, row[j - 1] + (x != y)))
        row = nxt
    return row[-1]


def _swaps(a):
    return {a[:i] + a[i + 1] + a[i] + a[i + 2 :] for i in range(len(a) - 1)}


def _edits(a, b):
    """Insertions, deletions, changes and swaps of neighbours from ``a`` to ``b``; 3 stands for more than two."""
    plain = _plain(a, b)
    if plain <= 1:
        return plain
    if b in _swaps(a):
        return 1
    if plain == 2:
        return 2
    near = plain <= 4 and (
        any(_plain(s, b) <= 1 or b in _swaps(s) for s in _swaps(a)) or any(_plain(s, a) <= 1 for s in _swaps(b))
    )
    return 2 if near else 3


@pytest.mark.parametrize("limit", [corpus.BROADCAST_ROWS, 0])
def test_spelling_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(corpus, "BROADCAST_ROWS", limit)
    rnd = random.Random(5)
    known = {"".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 14))): rnd.randint(1, 9) for _ in range(120)}
    words = {"".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 14))) for _ in range(150)}
    known |= {"hello": 3, "abcd": 1}
    words |= {"hlelox", "bxadc", "badc"}
    for w in list(known)[:60]:  # words near a known one
        at = rnd.randrange(len(w))
        words |= {w[:at] + w[at + 1 :] or "z", w[:at] + "zz" + w[at:], w[:at] + w[at + 1 : at + 2] + w[at : at + 1] + w[at + 2 :]}

    def corrected(w):
        if w in known:
            return w
        near = sorted((e, -n, c) for c, n in known.items() if (e := _edits(w, c)) <= 2)
        return near[0][2] if near else w

    got = corpus.correct_words(
        spark.createDataFrame([(w,) for w in words], "word string"),
        spark.createDataFrame(list(known.items()), "word string, n int"),
    )
    assert {r["word"]: r["correction"] for r in got.collect()} == {w: corrected(w) for w in words}


def test_trigrams(spark):
    got = spark.range(1).select(corpus.trigrams(F.lit("Né à, Zo9x"))).first()[0]
    assert got == [" né", "né ", " à ", " zo", "zo ", " x "]
    assert spark.range(1).select(corpus.trigrams(F.lit("123 !"))).first()[0] == []


def test_language_of_clear_texts(spark):
    rows = [(1, "the cat and the dog and the bird", "en"), (2, "le chat et le chien et la poule", "fr"),
            (3, "the bird and the cat", None), (4, "la poule et le chat", None), (5, "1234", None)]
    got = corpus.guess_language(spark.createDataFrame(rows, "id int, t string, lang string"), "id", "t", "lang")
    assert {r["id"]: r["guess"] for r in got.collect()} == {1: "en", 2: "fr", 3: "en", 4: "fr", 5: None}


def test_links_of_any_form(spark):
    html = """<div class='other'><li><a href="/zero">0</a></li></div><div class="x main-list">
    <ul><li class="i"><a class="k" href="/x">X <b>bold</b></a></li><li> <a href='/y'
    id="1">Y &amp; Z</a></li><li><a>none</a></li><li><a data-href="/no">no</a></li></ul></div><a href="/no">no</a>"""
    pages = spark.createDataFrame([(1, html), (2, None), (3, "")], "id int, html string")
    got = [tuple(r)[2:] for r in markup.list_links(pages, "id", "html").collect()]
    assert got == [("/zero", "0"), ("/x", "X bold"), ("/y", "Y &amp; Z")]
    scoped = [tuple(r) for r in markup.list_links(pages, "id", "html", container="main-list").collect()]
    assert scoped == [(1, 0, "/x", "X bold"), (1, 1, "/y", "Y &amp; Z")]


@pytest.mark.parametrize("files", [1, 3])
def test_alerts_over_one_file_or_many(spark, files):
    from tallyloom.plans import streams
    from tallyloom.plans.registry import Tables
    from tallyloom.session import scratch_path

    root = scratch_path(spark, "alert-test")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(files).write.parquet(f"{root}/events.parquet")
    assert streams.poll_alerts(Tables(spark, root)).count() == streams.filtered(events).count() > 0
    with pytest.raises(FileNotFoundError):
        alerts.open_stream(spark, f"{root}/nothing.parquet", events.schema)


def test_keys_hold_on_insert(spark):
    old = spark.createDataFrame([(1, 10), (2, 20)], "id int, parent int")
    parents = spark.createDataFrame([(10,), (20,)], "parent int")

    def inserted(rows):
        new = spark.createDataFrame(rows, "id int, parent int")
        return sorted(tuple(r) for r in tables.insert_checked(old, new, ["id"], parents, ["parent"]).collect())

    assert inserted([(3, 10), (4, 20)]) == [(1, 10), (2, 20), (3, 10), (4, 20)]
    for rows, message in (([(2, 10)], "there already"), ([(3, 10), (3, 20)], "there already"), ([(3, 30)], "no parent")):
        with pytest.raises(Exception, match=message):
            inserted(rows)
    twice = spark.createDataFrame([(3, 20), (3, 10), (1, 20)], "id int, parent int")
    got = sorted(tuple(r) for r in tables.insert_new(old, twice, ["id"]).collect())
    assert got == [(1, 10), (2, 20), (3, 10)]


def test_scratch_is_shared_or_local(spark):
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert path.startswith(shared) if shared else tempfile.gettempdir() in path


def test_language_accuracy_on_the_tables(spark):
    rows = load_all()["txt_language_accuracy"].run(spark, "/root/testdata/sf0.001").collect()
    right = sum(r["accuracy"] * r["texts"] for r in rows) / sum(r["texts"] for r in rows)
    assert right > 0.8

"""Defined results at the edges: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import itertools
import random

import numpy as np
import public_tokenizers as vocabularies
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm import bpe_codec, graph_search, host_rules, line_dedup, ngram_join, substring_dedup, token_counts
from tallyloom.llm import token_output, url_templates, vector_packing
from tests.llm import brute

JSON, PATTERN = vocabularies.path("byte_bpe_50k.json"), vocabularies.PATTERN
RANKS = vocabularies.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string"


def prose(seed, n, vocabulary=4000):
    own = random.Random(seed)
    return " ".join(f"w{own.randrange(vocabulary)}" for _ in range(n))


BASE = prose(1, 300)
EDGES = [
    (0, BASE), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, BASE), (6, BASE + " end"), (7, "x " + BASE[: len(BASE) // 2]),
    (8, "a\u00a0b  c\x85d \n\n e<|endoftext|>f'll ''s 12\u0663\U0001f600 \x1c"), (9, prose(2, 30_000)), (10, "z" * 3000), (11, "the cat " * 400),
    (12, " ".join(BASE.split()[100:200]) + " " + prose(3, 60)),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def library_ids(text):
    return Tokenizer.from_file(JSON).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("chunk", "overlap"), [(65_536, 1_024), (200, 40), (64, 64)])
def test_counts_are_the_librarys_whatever_the_chunks(edges, chunk, overlap):
    clash = edges.withColumn("n_tokens", F.lit("old")).withColumn("key", F.lit(1))
    out = token_counts.count_tokens(clash, "text", JSON, chunk_chars=chunk, overlap_chars=overlap)
    assert set(out.columns) == {"doc_id", "text", "key", "n_tokens"}
    assert {r["doc_id"]: r["n_tokens"] for r in out.collect()} == {d: len(library_ids(t)) for d, t in EDGES}


def test_counts_of_repeated_huge_rows_and_of_none(spark, nothing):
    twice = spark.createDataFrame([(1, "ab " * 500), (1, "ab " * 500), (None, "ab " * 500)], SCHEMA)
    out = token_counts.count_tokens(twice, "text", JSON, chunk_chars=100, overlap_chars=20).collect()
    assert [r["n_tokens"] for r in out] == [len(library_ids("ab " * 500))] * 3
    assert token_counts.count_tokens(nothing, "text", JSON).count() == 0


def test_splices_are_refused_where_they_are_not_proven(edges):
    with pytest.raises(ValueError, match="proven"):
        token_counts.count_tokens(edges, "text", vocabularies.path("word_bpe_49k.json"))


def test_codec_round_trip(edges, nothing):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    clash = edges.withColumn("ids", F.lit(3))
    encoded = bpe_codec.encode(clash, "text", RANKS, PATTERN)
    for r in bpe_codec.decode(encoded, "ids", RANKS, PATTERN).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == own.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    assert bpe_codec.round_trip(nothing, "text", RANKS, PATTERN).count() == 0


def test_pre_token_caches_agree_with_the_pattern():
    own = bpe_codec.Codec(open(RANKS, "rb").read(), PATTERN)
    blanks = [" ", "\n", "\t", "\u00a0", "a", "'", "s", "1", "!"]
    for size in range(1, 6):
        for some in itertools.product(blanks, repeat=size):
            text = "".join(some)
            plain = b"".join(map(own.encode.pre_tokens.__getitem__, own.encode.find(text)))
            assert own.encode(text) == plain, repr(text)


def test_packing_limits():
    counts = {900: 3, 500: 7, 100: 40, 10: 1000, 1: 5}
    for capacities in (
        vector_packing.Capacities(1024),
        vector_packing.Capacities(1024, documents=8),
        vector_packing.Capacities(1024, attention=900**2 + 200),
    ):
        for score in ("norm", "dot"):
            groups = vector_packing.vector_best_fit(counts, capacities, score=score)
            placed = dict.fromkeys(counts, 0)
            for g in groups:
                for length, n in g.content:
                    placed[length] += n * g.bins
                held = [sum(n * x[k] for length, n in g.content for x in [vector_packing.need(length)]) for k in range(3)]
                assert all(h <= c for h, c in zip(held, capacities.vector(), strict=True))
            assert placed == counts


def test_best_fit_decreasing_is_that_of_single_items():
    own = random.Random(5)
    lengths = [own.randint(1, 64) for _ in range(500)]
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(64 - n)
    groups = token_output.best_fit_decreasing({n: lengths.count(n) for n in set(lengths)}, 64)
    assert sum(g.bins for g in groups) == len(rooms)
    assert sorted(64 - sum(a * b for a, b in g.content) for g in groups for _ in range(g.bins)) == sorted(rooms)


def test_packing_of_edges(edges, nothing):
    from tests.llm.test_queries import check_packing

    rows = vector_packing.pack_documents(edges.withColumn("part", F.lit("x")), JSON, PATTERN).collect()
    check_packing(rows, {d: library_ids(t) for d, t in EDGES})
    assert vector_packing.pack_documents(nothing, JSON, PATTERN).count() == 0
    packed = token_output.packed_sequences(edges, JSON, PATTERN, pad_id=7, capacity=16, block_pieces=50).collect()
    assert len({r["sequence_id"] for r in packed}) == len(packed)
    assert sum(r["n_tokens"] for r in packed) == sum(len(library_ids(t)) + 1 for _, t in EDGES)
    assert all(np.frombuffer(r["input_ids"], "<u4")[r["n_tokens"] :].tolist() == [7] * (16 - r["n_tokens"]) for r in packed)
    assert token_output.packed_sequences(nothing, JSON, PATTERN).count() == 0


def test_url_edges(spark):
    urls = [None, "", "no-scheme/x", "http://", "HTTP://A.Example.ORG/es/1?q#f", "x://org", "x://org/", "x://badorg/",
            "http://h.com/de/", "http://h.com/fr/2/3/4/5/6/7", "http://h.net/a//b#c", "http://h.net?x=/de/"]
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    out = {r["page_id"]: r for r in url_templates.judge_urls(pages).collect()}
    assert len(out) == len(urls)
    got = [(out[i]["host"], out[i]["path"], out[i]["rule"], out[i]["verdict"]) for i in range(len(urls))]
    assert got == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("org", "", None, "allow"), ("org", "/", "org/", "allow"),
        ("badorg", "/", None, "allow"), ("h.com", "/de/", "com/de/", "block"), ("h.com", "/fr/2/3/4/5/6/7", "com/fr/", "allow"),
        ("h.net", "/a//b", None, "allow"), ("h.net", "", None, "allow"),
    ]
    assert url_templates.judge_urls(pages.limit(0)).count() == 0


def test_impure_templates_are_rejected(spark):
    """/spam/<name>/ is labelled bad for most names, so the unlabelled ones go too; /news/<n> stays."""
    rules = (url_templates.UrlRule("block", "h.net", "/spam/a"), url_templates.UrlRule("allow", "h.net", "/news/1"))
    urls = [f"http://h.net/spam/{c}{i:x}zq/" for c in "ab" for i in range(100 if c == "a" else 9)]
    urls += [f"http://h.net/news/{i}" for i in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = {r["url"]: r["verdict"] for r in url_templates.judge_urls(pages, rules=rules).collect()}
    assert {v for u, v in out.items() if "/spam/" in u} == {"block"}
    assert {v for u, v in out.items() if "/news/" in u} == {"allow"}


def test_hosts_are_judged_by_shrunk_rates(spark):
    good, bad = prose(4, 80), "too short"
    rows = [(i, good, "good") for i in range(100)] + [(100 + i, bad if i < 99 else good, "bad") for i in range(100)]
    rows += [(300, bad, "tiny"), (301, good, None), (302, None, None), (303, good, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_words", F.lit("old"))
    out = {r["doc_id"]: r for r in host_rules.judge_documents(docs).collect()}
    assert out[199]["base_failed"] is False and out[199]["kept"] is False  # a good text on a bad host
    assert out[0]["kept"] and out[301]["kept"] and out[303]["kept"] and not out[302]["kept"]
    assert out[302]["n_words"] == 0
    assert host_rules.judge_documents(docs.limit(0)).count() == 0


def test_counts_of_words_and_lines(spark):
    texts = ["a b c a b c", "a b c", None, "", "x\nx\n \n\nx", "# a$%|", "\u00e4\u00f6\u00a0\u00fc\n\x0b\x0cq"]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    out = {r["doc_id"]: tuple(r[c] for c in host_rules.COUNTS) for r in host_rules.with_counts(docs).collect()}
    assert out == {0: (6, 6, 0, 0, 6), 1: (3, 3, 0, 0, 0), 2: (0, 0, 0, 0, 0), 3: (0, 0, 0, 0, 0), 4: (3, 3, 0, 2, 0),
                   5: (2, 5, 4, 0, 0), 6: (2, 5, 0, 0, 0)}


def test_line_runs(spark, nothing):
    run = "l1\nl2\n\n \nl3"
    rows = [(3, f"own\n{run}\nend"), (1, f"\n\n{run}\n"), (2, run), (4, "l1\nl2"), (5, None), (6, ""), (7, "a\na\na\na\na"), (8, "l2\nl3\nl1")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("_keep", F.lit(1)).withColumn("n_runs", F.lit("old"))
    out = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert {d: (r["n_removed"], r["text"]) for d, r in out.items()} == {d: (g, t) for d, g, t in brute.line_runs(rows)}
    assert out[3]["text"] == "own\nend" and out[2]["text"] == "" and out[7]["text"] == "a" and out[1]["text"] == f"\n\n{run}\n"
    assert out[3]["n_runs"] == 1 and out[5]["n_lines"] == 0
    for depth in (1, 2, 5):
        got = line_dedup.drop_repeated_lines(docs.select("doc_id", "text"), min_lines=depth).collect()
        assert {r["doc_id"]: r["text"] for r in got} == {d: t for d, _, t in brute.line_runs(rows, depth)}
    assert line_dedup.drop_repeated_lines(nothing).count() == 0
    same = spark.createDataFrame([(1, run), (1, run), (None, run)], SCHEMA)
    assert sorted(str(r["text"]) for r in line_dedup.drop_repeated_lines(same).collect()) == sorted(["", run, run])


def test_similar_edges(edges, spark, nothing):
    out = ngram_join.join_similar(edges.withColumn("node", F.lit("x"))).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in out} == brute.similar(EDGES)
    assert ngram_join.join_similar(nothing).count() == 0
    rows = [(1, BASE), (1, BASE), (2, BASE), (None, BASE), (None, None), (3, ""), (3, "")]
    kept = ngram_join.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == [(False, 1), (False, 3), (True, 0), (True, 0)]


def test_hot_class_is_dealt_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "NODE_ROWS", 20)
    monkeypatch.setattr(ngram_join, "CLASS_ROWS", 16)
    words = prose(6, 120).split()
    rows = []
    for i in range(90):
        own, w = random.Random(i), list(words)
        for _ in range(i % 4):
            w[own.randrange(len(w))] = f"v{own.randrange(50)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, prose(50 + i, 60)) for i in range(20)]
    out = ngram_join.join_similar(spark.createDataFrame(rows, SCHEMA)).collect()
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in out}
    want = brute.similar(rows)
    assert got == want


def test_prefixes_are_shortened_to_the_recall():
    depth = ngram_join.prefix_depth(0.8, 20, 0.9995)
    assert ngram_join.recall_at(0.8, depth, 20) >= 0.9995 > ngram_join.recall_at(0.8, depth + 1, 20)
    with pytest.raises(ValueError, match="trees"):
        ngram_join.prefix_depth(0.5, 2, 0.99)


def test_passages(edges, spark, nothing):
    out = substring_dedup.remove_repeats(edges.withColumn("digest", F.lit(1))).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out)
    assert got == sorted((d, n, g, brute.sha(k)) for d, n, g, k in brute.passages(EDGES))
    assert {r["doc_id"]: r["text"] for r in out}[8] == EDGES[8][1]
    assert substring_dedup.remove_repeats(nothing).count() == 0
    same = spark.createDataFrame([(1, BASE), (1, BASE), (None, BASE), (2, BASE), (1, BASE + " x")], SCHEMA)
    lost = sorted((r["doc_id"] or 0, r["n_removed"]) for r in substring_dedup.remove_repeats(same).collect())
    assert lost == [(0, 0), (1, 0), (1, 0), (1, 0), (2, 300)]


def test_passages_of_texts_that_repeat_themselves(spark):
    rows = [(i, " ".join(["lorem"] * (40 + 37 * i))) for i in range(5)]
    rows += [(10 + i, prose(i, 20) + " " + "a b c " * (30 + 11 * i) + prose(20 + i, 20)) for i in range(5)]
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out)
    assert got == sorted((d, n, g, brute.sha(k)) for d, n, g, k in brute.passages(rows))


@pytest.mark.parametrize("shard_words", [60_000, 150])
def test_passages_with_many_contexts_of_one_anchor(spark, shard_words):
    own, passage = random.Random(9), prose(7, 70).split()
    rows = []
    for i in range(60):
        cut = passage[own.randrange(15) : 70 - own.randrange(15)]
        rows.append((i, " ".join([*prose(100 + i, 40, 9).split(), *cut, *prose(200 + i, 40, 9).split()])))
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), shard_words=shard_words).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out)
    assert got == sorted((d, n, g, brute.sha(k)) for d, n, g, k in brute.passages(rows))


def test_automaton_knows_first_documents():
    own = random.Random(3)
    sequences = [[own.randrange(3) for _ in range(own.randint(1, 30))] for _ in range(40)]
    automaton = substring_dedup.SuffixAutomaton()
    for d, s in enumerate(sequences):
        automaton.add(s, d)
    automaton.finish()
    for s in [*sequences, [0, 1, 2, 7, 0, 1, 2, 0]]:
        for n in (1, 3, 6):
            want = [
                min((d for d, t in enumerate(sequences) if any(t[j : j + n] == s[i : i + n] for j in range(len(t) - n + 1))), default=None)
                for i in range(len(s) - n + 1)
            ]
            assert automaton.first_documents(s, n) == want


def test_neighbours_at_the_edges(spark):
    own = np.random.default_rng(1)
    rows = [(i, own.normal(size=8).tolist()) for i in range(300)]
    same = own.normal(size=8).tolist()
    rows += [(400 + i, same) for i in range(30)] + [(500, None), (501, []), (502, [0.0] * 8), (503, [None] + [1.0] * 7)]
    rows += [(504, [float("nan")] + [1.0] * 7), (505, [float("inf")] * 8), (506, [1.0, 2.0]), (0, rows[0][1]), (None, same)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    asked = frame.filter("vec_id % 10 = 0 or vec_id > 500")
    out = graph_search.nearest(frame, asked, "vec_id", "embedding", k=5, shard_rows=64).collect()
    plain = [(i, v) for i, v in rows if i is not None]
    want = brute.nearest(plain, sorted({i for i, _ in plain if i % 10 == 0 or i > 500}), 5)
    got = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert {q: [i for _, i in w] for q, w in want.items() if w} == got
    assert graph_search.nearest(frame.limit(0), asked, "vec_id", "embedding").count() == 0


def test_recall_against_brute_force(spark):
    own = np.random.default_rng(2)
    centres = own.normal(size=(20, 32))
    rows = [(i, (centres[i % 20] + 0.7 * own.normal(size=32)).tolist()) for i in range(3000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute.nearest(rows, range(0, 3000, 50), 5)
    got = {}
    for r in graph_search.nearest(frame, frame.filter("vec_id % 50 = 0"), "vec_id", "embedding", k=5, shard_rows=1500).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = sum(len(got[q] & {i for _, i in w}) for q, w in want.items())
    assert hits >= 0.9 * 5 * len(want)

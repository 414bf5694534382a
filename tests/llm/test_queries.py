"""Every query of the package on the smallest tables, against SQL, brute force or the library itself."""

import base64
import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from pyspark.sql import functions as F
from tallyloom.llm import token_output
from tallyloom.llm.queries import QUERIES, SQL
from tests.llm import brute
from tests.oracle import compare, connect

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


@pytest.fixture(scope="module")
def ids(docs):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {d: own.encode(t or "", add_special_tokens=False).ids for d, t in docs}


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, name):
    assert compare(QUERIES[name](spark, ROOT), connect(ROOT), SQL[name]) == ""


def test_all_thirteen_are_there():
    import __spark_entry__

    found = {int(q[2:].split("_")[0]) for q in __spark_entry__.queries() if q.startswith("op")}
    assert found == set(range(1, 14)) and "pipeline" in __spark_entry__.queries()


def test_token_counts(spark, docs, ids):
    rows = QUERIES["op1_token_counts"](spark, ROOT).collect()
    assert len(rows) == len(docs)
    texts = dict(docs)
    for r in rows:
        assert r["n_tokens"] == len(ids[r["doc_id"]])
        assert r["over_limit"] == (r["n_tokens"] > 1024)
        assert r["n_bytes"] == len((texts[r["doc_id"]] or "").encode())


def test_codec(spark, docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(docs)
    for r in QUERIES["op4_byte_bpe_codec"](spark, ROOT).collect():
        want = own.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_ngram_join(spark, docs):
    rows = QUERIES["op5_ngram_join"](spark, ROOT).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in rows} == brute.similar(docs)


def test_substring_dedup(spark, docs):
    rows = QUERIES["op6_substring_dedup"](spark, ROOT).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows)
    assert got == sorted((d, n, gone, brute.sha(kept)) for d, n, gone, kept in brute.passages(docs))


def test_packed_ids(spark, docs, ids):
    got, pieces = collections.defaultdict(dict), 0
    packed = QUERIES["op8_packed_ids"](spark, ROOT).withColumn("position_ids", token_output.position_ids(F.col("cu_seqlens")))
    for r in packed.collect():
        row, bounds = np.frombuffer(r["input_ids"], "<u4"), r["cu_seqlens"]
        assert len(row) == 1024 and bounds[0] == 0 and bounds[-1] == r["n_tokens"]
        assert r["position_resets"] == bounds[:-1]
        assert r["position_ids"] == [k for a, b in zip(bounds, bounds[1:]) for k in range(b - a)]
        for d, p, a, b in zip(r["doc_ids"], r["pieces"], bounds, bounds[1:], strict=False):
            got[d][p] = row[a:b].tolist()
            pieces += 1
    assert pieces == sum(-(-(len(ids[d]) + 1) // 1024) for d, _ in docs)
    for d, _ in docs:
        assert sum((got[d][p] for p in sorted(got[d])), []) == ids[d] + [2]


def check_packing(rows, ids, capacity=1024):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        whole, at = ids[d] + [2], 0
        for k, p in enumerate(sorted(pieces, key=lambda p: p["piece"])):
            assert (p["piece"], p["start"]) == (k, at)
            assert k == 0 or p["length"] == capacity
            assert p["ids_crc32"] == zlib.crc32(np.array(whole[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(whole) and len(pieces) == -(-len(whole) // capacity)
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(len(i) + 1 for i in ids.values())
    assert len(by_sequence) <= 1.01 * -(-total // capacity) + 1


def test_vector_best_fit(spark, ids):
    check_packing(QUERIES["op9_vector_best_fit"](spark, ROOT).collect(), ids)


def test_graph_search(spark):
    rows = spark.read.parquet(f"{ROOT}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = brute.nearest([(r[0], r[1]) for r in rows], [r[0] for r in rows if r[0] % 50 == 0], 5)
    got = collections.defaultdict(list)
    for r in sorted(QUERIES["op10_graph_search"](spark, ROOT).collect(), key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    assert set(got) == set(want)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q in want:
        known = {i: s for s, i in want[q]}
        assert all(abs(known[i] - s) < 1e-12 for s, i in got[q] if i in known)


def test_pipeline(spark, docs):
    rows = spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text", "source").collect()
    left = [(r["doc_id"], r["text"]) for r in rows if not brute.base_failed(r["text"])]
    left = [(d, new) for d, gone, new in brute.line_runs(left, min_words=10) if not gone or brute.words(new)]
    classes = brute.similar(left)
    left = [(d, t) for d, t in left if classes[d][0] == d]
    texts = dict(left)
    cut = brute.passages(left)
    left = [(d, texts[d] if not gone else b" ".join(kept).decode()) for d, _, gone, kept in cut if not gone or kept]
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: own.encode(t or "", add_special_tokens=False).ids for d, t in left}
    check_packing(corpus_pipeline.run(spark, ROOT).collect(), ids)


def test_stages_return_documents(spark):
    out = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns = out.dtypes
    for _, stage in corpus_pipeline.STAGES[:2]:
        out = stage(spark, out, ROOT)
        assert out.dtypes == columns
    assert out.filter("n_chars <> char_length(text)").count() == 0

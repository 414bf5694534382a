"""The runnable queries of this package: (spark, folder) to their whole result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe_codec, conversation_repair, graph_search, host_rules, line_dedup, ngram_join, spelling_variants, sql, subspace_join, substring_dedup, token_counts, token_output, url_templates, vector_packing
from tallyloom.llm.common import materialize, read_table, text_or_empty

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

JSON_TOKENIZER = "byte_bpe_50k.json"
RANK_FILE = "byte_bpe_multi_50k.tiktoken"
END_ID = 2


def query(name: str, sql: str | None = None):
    def keep(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return keep


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, "text", public_tokenizers.path(JSON_TOKENIZER))
    return counted.select(
        "doc_id",
        F.octet_length(text_or_empty("text")).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 1024).alias("over_limit"),
    )


@query("op2_url_templates", sql.url_sql())
def op2_url_templates(spark: SparkSession, root: str) -> DataFrame:
    pages = read_table(spark, root, "pages").select("page_id", "url")
    return url_templates.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


@query("op3_host_rules", sql.quality_sql())
def op3_host_rules(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text", "source")
    # counted once and written without texts: hosts are summed from it, and verdicts joined to it
    counted = materialize(host_rules.with_counts(docs).drop("text"), "counts")
    rules = host_rules.production_rules()
    rates = host_rules.host_rates(counted, "source", rules)
    rejected = materialize(host_rules.rejected_hosts(rates, rules), "rejected-hosts")
    judged = host_rules.judge(counted, "source", rejected)
    return judged.select("doc_id", *host_rules.COUNTS, "base_failed", "kept")


@query("op4_byte_bpe_codec")
def op4_byte_bpe_codec(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    path, pattern = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    return bpe_codec.round_trip(docs, "text", path, pattern).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op5_ngram_join")
def op5_ngram_join(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    return ngram_join.join_similar(docs).select("doc_id", "class_id", "n_links", "n_copies")


@query("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).drop("text")


@query("op7_line_dedup", sql.line_dedup_words_sql())
def op7_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    cut = line_dedup.drop_repeated_lines(docs)
    return cut.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


@query("op8_packed_ids")
def op8_packed_ids(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents")
    return token_output.packed_sequences(
        docs, public_tokenizers.path(JSON_TOKENIZER), public_tokenizers.PATTERN, end_id=END_ID
    )


@query("op9_vector_best_fit")
def op9_vector_best_fit(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents")
    return vector_packing.pack_documents(
        docs, public_tokenizers.path(JSON_TOKENIZER), public_tokenizers.PATTERN, end_id=END_ID
    )


@query("op10_graph_search")
def op10_graph_search(spark: SparkSession, root: str) -> DataFrame:
    vectors = read_table(spark, root, "embeddings").select("vec_id", "embedding")
    asked = vectors.filter(F.col("vec_id") % 50 == 0)
    return graph_search.nearest(vectors, asked, "vec_id", "embedding", k=5)


@query("op11_spelling_variants", sql.variants_sql())
def op11_spelling_variants(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    counts = spelling_variants.damaged_words(docs).groupBy("word").agg(F.count("*").alias("n")).filter("n >= 3")
    return spelling_variants.group_variants(counts)


@query("op12_conversation_repair", sql.repair_sql())
def op12_conversation_repair(spark: SparkSession, root: str) -> DataFrame:
    rows = read_table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    repaired = conversation_repair.repair(conversation_repair.damaged(rows)).withColumnRenamed("conv_id", "c")
    every = rows.select("conv_id").distinct()
    counted = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(repaired, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counted],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query("op13_subspace_join", sql.vectors_sql())
def op13_subspace_join(spark: SparkSession, root: str) -> DataFrame:
    return subspace_join.near_duplicates(read_table(spark, root, "embeddings"))

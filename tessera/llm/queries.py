"""The registered queries: each operator on its whole table, reduced to the columns of its contract."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_tree, minmax_hash, prefix_trie, quality_rules, substrings, topk, vector_cells
from .common import table


def tokenizer_path() -> str:
    """Place of the multilingual rank file (a parameter of the operators)."""
    return importlib.import_module("public_tokenizers").path("byte_bpe_multi_50k.tiktoken")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .wrappers import extract

    return extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import quantised, top_k

    vectors = quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 1024)
    return top_k(vectors.where("id % 100 = 0"), vectors, k=10).select("query_id", "rank", "vec_id", "score")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import scan, train

    docs = table(spark, sf_dir, "documents")
    return scan(docs, train(docs)).select(
        F.col("doc_id").cast("long"), "n_assign", "n_access", "n_hex", "base_sha256", "spans"
    )


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_tree import PROBE_SCHEMA, PROBE_TURNS, pack, read_back

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE_TURNS, PROBE_SCHEMA)
    return read_back(*pack(turns.unionByName(probe)))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), n=13)


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minmax_hash import components

    return components(table(spark, sf_dir, "documents"), n=4, percent=80)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.line_clean(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").cast("long"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_knn import held_out, score, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select(
        F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_cells.near_duplicates(table(spark, sf_dir, "embeddings"))


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_html, op2_topk, op3_secrets, op4_chat, op5_substrings,
        op6_mix, op7_minmax, op8_bpe, op9_rules, op10_quality,
        op11_whiten, op12_trie, op13_cells,
    )
}

LLM_ORACLE = {"op2_topk": topk.ORACLE, "op4_chat": chat_tree.ORACLE, "op5_substrings": substrings.ORACLE, "op7_minmax": minmax_hash.ORACLE, "op9_rules": quality_rules.ORACLE, "op12_trie": prefix_trie.ORACLE, "op13_cells": vector_cells.ORACLE}

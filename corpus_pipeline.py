"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

1. quality classifier -- documents predicted to be of low quality go
2. MinHash near-dedup -- one document of each group of near copies stays
3. secret scan        -- found secrets are replaced in the text
4. mixing             -- documents are taken zero, one or two times to meet source targets
5. byte-level BPE     -- token ids of every text, checked by decoding

Null texts are judged as empty ones and stay null up to stage 5, which encodes them as
empty. More columns than those of ``documents`` pass through. Empty tables stay empty.

Stages 1 to 4 return the columns of ``documents``; stage 5 returns doc_id,
n_tokens, ids, ids_sha256, decoded_sha256.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import cut, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the classifier predicts to be label 1; it learns from labelled rows of ``docs``."""
    from tessera.llm.quality_knn import score, train

    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model, added=("_quality_score", "_quality_predicted"))
    return scored.where("_quality_predicted = 1").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of near copies: that of the smallest id, then text hash, then place.

    Five-word shingles and a similarity of 0.8, as for all stages on word shingles. Rows are compared by
    their texts alone, so repeated rows of one doc_id go as well, while unlike texts under one doc_id stay.
    A row without doc_id comes after all that have one, and goes if its group holds another. Of rows without
    words, those that agree in doc_id are one document; without doc_id nothing says so, and they stay.
    """
    from tessera.llm.minmax_hash import components

    row = "_row"
    while row in docs.columns:
        row += "_"
    rows = cut(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = components(rows.select(F.col(row).alias("doc_id"), "text"), n=5, percent=80)
    found = found.select(F.col("doc_id").alias(row), "n_shingles", "component_id")
    wordless = F.col("n_shingles") == 0
    group = [
        F.when(~wordless, F.col("component_id")).alias("component"),
        F.when(wordless, F.col("doc_id")).alias("id"),
        F.when(wordless & F.col("doc_id").isNull(), F.col(row)).alias("own"),
    ]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "hash", row)).alias("first")
    hashed = rows.select(row, "doc_id", F.xxhash64("text").alias("hash"))
    kept = hashed.join(found, row).groupBy(*group).agg(first).select(F.col(f"first.{row}").alias("kept"))
    gone = rows.select(row).join(kept, F.col(row) == F.col("kept"), "left_anti")
    return rows.join(gone, row, "left_anti").select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every found secret; no document is dropped, null text stays null."""
    from tessera.llm.secrets import redact, train

    return redact(docs, train(docs)).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0, 1 or 2 rows); one without words as often as
    its source is taken whole."""
    from tessera.llm.mixing import take

    return take(docs).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tessera.llm.bpe import round_trip
    from tessera.llm.queries import tokenizer_path

    return round_trip(docs, tokenizer_path(), ids=True)


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_dedup),
    ("secret scan", secrets),
    ("mixing", mixing),
    ("bpe", encode),
]

#: A trained model and token merges are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs

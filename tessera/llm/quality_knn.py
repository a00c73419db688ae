"""Quality classifier: similarity-weighted votes of the nearest labelled documents.

A document is a vector of hashed character trigrams (square roots of their
shares) and of a few repetition terms, weighted by inverse document frequency
and projected on the leading singular vectors of the labelled sample (latent
semantic analysis). The sample's vectors (``SAMPLE`` rows of ``RANK`` floats:
a proven bound) travel to every task; each document gets its exact cosine to
all of them, a block of documents at a time, and the ``NEIGHBOURS`` nearest
vote with their labels, weighted by similarity.

Labels are learned only from rows with crc32(doc_id) mod 4 other than 2. A
document's label, language, source and id never enter its score.

Map-only over whole texts. Null text counts as empty: the score of a document
without terms is the sample's share of label 1. Rows of ``labels`` without
quality or without a document teach nothing; a document labelled twice teaches
its larger label. Without any labelled row every score is 0.5.

Repeated rows are scored separately (and equally). An empty table gives an empty result. Texts may be of any length;
other columns are kept or ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tidy, workers
from .wordhash import mix, window_hashes, word_hashes

# Fixed values of the task.
HELD_OUT = 2  # of crc32(doc_id) mod 4
CUT = 0.7

# Parameters.
SAMPLE = 4_000  # bound of the labelled documents that teach
DIMS = 2_048  # hashed trigrams
RANK = 48
NEIGHBOURS = 25
SHARPNESS = 4  # power of the similarity in a vote
REPEAT_WEIGHT = 2.0
N_REPEAT = 4
BLOCK = 256  # documents whose cosines are computed at once
BLOCK_CHARS = 1 << 20


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == HELD_OUT


def _repetition(words: np.ndarray, lines: list[str]) -> list[float]:
    """Shares of words equal to the one before, of words seen before, of repeated windows, of repeated lines."""
    n = max(1, len(words))
    windows = window_hashes(words, 4)
    return [
        float((words[1:] == words[:-1]).sum()) / n,
        max(0.0, 1 - len(np.unique(words)) / n - 0.5) if n >= 20 else 0.0,
        1 - len(np.unique(windows)) / len(windows) if len(windows) else 0.0,
        1 - len(set(lines)) / len(lines) if len(lines) > 2 else 0.0,
    ]


def features(texts: list[str]) -> np.ndarray:
    """One row of term weights per text, before idf; sums run over the whole text."""
    out = np.zeros((len(texts), DIMS + N_REPEAT), np.float32)
    for i, (t, words) in enumerate(zip(texts, word_hashes(texts), strict=True)):
        grams = np.zeros(DIMS, np.int64)
        step = BLOCK_CHARS
        for a in range(0, len(t), step):  # overlapping slices, so no trigram is lost
            c = np.frombuffer(t[a : a + step + 2].encode("utf-32-le"), "<u4").astype(np.uint64)
            if len(c) > 2:
                h = (c[:-2] * np.uint64(0x1F0A5) + c[1:-1]) * np.uint64(0x1F0A5) + c[2:]
                grams += np.bincount(mix(h) % np.uint64(DIMS), minlength=DIMS)
        total = grams.sum()
        if total:
            out[i, :DIMS] = np.sqrt(grams / total)
        lines = [x for x in t.split("\n") if x.strip()] if "\n" in t else []
        out[i, DIMS:] = np.sqrt(_repetition(words, lines))
        out[i, DIMS:] *= REPEAT_WEIGHT
    return out


def embed(x: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Unit vectors in the latent space (zero for a document without terms)."""
    v = (x * idf) @ basis
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return (v / np.maximum(norm, 1e-12)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """The latent space and the labelled vectors, from at most ``SAMPLE`` labelled documents."""
    workers(docs.sparkSession)
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    # the smallest hashes of the ids that have a label: a sample that does not depend on row order
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * SAMPLE)
    taught = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")

    def run(batches):
        import pandas as pd

        for b in batches:
            for a in range(0, len(b), BLOCK):
                p = b.iloc[a : a + BLOCK]
                x = features(list(p["text"]))
                yield pd.DataFrame({"doc_id": p["doc_id"].to_numpy(), "quality": p["quality"].to_numpy(), "x": [r.tobytes() for r in x.astype(np.float16)]})  # half the bytes to the driver

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        taught.select("doc_id", "quality", "text")
        .mapInPandas(tidy(run), f"doc_id {kind}, quality int, x binary")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "x")
        .limit(SAMPLE)
        .collect()
    )
    if not rows:
        return {"prior": 0.5, "vectors": None}
    x = np.stack([np.frombuffer(r.x, np.float16) for r in rows]).astype(np.float32)
    y = np.array([1 if r.quality == 1 else 0 for r in rows], np.float32)
    del rows
    df = (x > 0).sum(0)
    idf = np.log((1 + len(x)) / (1 + df)).astype(np.float32) + 1
    rank = min(RANK, *x.shape)
    r = np.random.default_rng(3)
    w = x * idf
    q = np.linalg.qr(w.T @ (w @ r.normal(size=(w.shape[1], rank + 10)).astype(np.float32)))[0]
    for _ in range(4):
        q = np.linalg.qr(w.T @ (w @ q))[0]
    _, _, vt = np.linalg.svd(w @ q, full_matrices=False)
    basis = np.ascontiguousarray(q @ vt.T[:, :rank], dtype=np.float32)
    return {"prior": float(y.mean()), "idf": idf, "basis": basis, "vectors": embed(x, idf, basis), "labels": y}


def votes(x: np.ndarray, model: dict) -> np.ndarray:
    """Score of each row of features: similarity-weighted share of label 1 among the nearest."""
    if model["vectors"] is None:
        return np.full(len(x), model["prior"])
    known, y = model["vectors"], model["labels"]
    sims = embed(x, model["idf"], model["basis"]) @ known.T
    k = min(NEIGHBOURS, len(known))
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    s = np.maximum(np.take_along_axis(sims, near, 1), 0).astype(float) ** SHARPNESS
    weight = s.sum(1)
    score = np.where(weight > 0, (s * y[near]).sum(1) / np.maximum(weight, 1e-12), model["prior"])
    score[~x.any(axis=1)] = model["prior"]
    return np.clip(score, 0.0, 1.0)


def score(docs: DataFrame, model: dict, cut: float = CUT, added: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` (all its columns) with the score and the prediction, named ``added``; columns of
    those names are replaced."""
    spark = docs.sparkSession
    workers(spark)
    names = [c for c in docs.columns if c not in added]
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            found = [np.zeros(0)]
            a = 0
            while a < len(texts):
                e, size = a, 0
                while e < len(texts) and e - a < BLOCK and (e == a or size + len(texts[e]) <= BLOCK_CHARS):
                    size += len(texts[e])
                    e += 1
                found.append(votes(features(texts[a:e]), shared.value))
                a = e
            s = np.concatenate(found)
            cols = [*b.columns, pa.array(s, pa.float64()), pa.array((s >= cut).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, *added])

    schema = docs.select(names).schema.add(added[0], "double").add(added[1], "integer")
    return docs.select(names).mapInArrow(tidy(run), schema)

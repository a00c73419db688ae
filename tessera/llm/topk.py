"""Exact top-k search by distributed histogram selection.

Queries come in pages of bounded size. For a page, every candidate is scored
against every query of it in blocks (a matrix product in the tasks; candidates
are never shuffled). A pass counts scores in ``BINS`` equal bins between two
bounds per query; the bin that holds the k-th best becomes the next pass's
bounds, until it is one integer wide. The last pass keeps what scores above
the k-th value, and of the candidates that tie with it the smallest ids.

Only the bins down to a task's own k-th score can matter, so a task sends at
most k counts a query, and at most k candidates a query, however many tie.

Vectors that are null or hold a null or non-finite component take no part, nor
do null ids. Vectors of unlike length have no score. A query excludes every
row of its own id; of several query rows with one id the least vector counts.
Scores are exact integers; beyond 64 bits they saturate.

Repeated candidate rows are candidates each. Without queries, candidates or any rows
the result is empty; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

from .common import cut, workers

# Parameters.
PAGE = 2_048  # queries scored in one set of passes: bounds what is sent to the tasks
BINS = 2_048
BLOCK = 512  # candidates scored at once
LIMIT = (1 << 63) - 2


def quantised(vectors: DataFrame, key: str, column: str, scale: int) -> DataFrame:
    """id, q: each component x as floor(scale * x)."""
    x = F.transform(F.col(f"`{column}`"), lambda v: v.cast("double"))
    return (
        vectors.select(F.col(f"`{key}`").cast("long").alias("id"), x.alias("x"))
        .where("id IS NOT NULL AND x IS NOT NULL")
        .where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
        .select("id", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("q"))
    )


def _blocks(batch):
    """(ids, matrix) of the rows of each length, ``BLOCK`` rows at a time."""
    import pyarrow.compute as pc

    lengths = pc.list_value_length(batch.column("q")).to_numpy(zero_copy_only=False)
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    flat = batch.column("q").flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        for a in range(0, len(rows), BLOCK):
            r = rows[a : a + BLOCK]
            at = (ends[r] - d)[:, None] + np.arange(d)
            yield ids[r], flat[at].reshape(len(r), int(d))


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products, queries by candidates."""
    top = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(c.astype(float)).max(initial=0)) * max(1, q.shape[1])
    if top < 2**53:
        return (q.astype(float) @ c.astype(float).T).astype(np.int64)
    if top < 2**63:
        return q @ c.T
    exact = q.astype(object) @ c.T.astype(object)
    return np.clip(exact, -LIMIT, LIMIT).astype(np.int64) if exact.size else np.zeros(exact.shape, np.int64)


def _scores(page: dict, batches):
    """(indices of queries, candidate ids, scores, mask of pairs that count)."""
    order = np.argsort(page["ids"])
    by_id = page["ids"][order]
    for b in batches:
        for ids, c in _blocks(b):
            own = page["by_dim"].get(c.shape[1])
            if own is None:
                continue
            which, q = own
            s = _products(q, c)
            ok = np.ones(s.shape, bool)
            at = np.searchsorted(by_id, ids)
            at[at == len(by_id)] = 0
            same = np.flatnonzero(by_id[at] == ids)
            place = np.full(len(page["ids"]), -1)
            place[which] = np.arange(len(which))
            row = place[order[at[same]]]
            ok[row[row >= 0], same[row >= 0]] = False
            yield which, ids, s, ok


def _histogram(shared, k: int):
    """Counts (query, bin, n) of the scores within the query's bounds; bin 0 is the highest."""

    def run(batches):
        import pyarrow as pa

        page = shared.value
        low, high, width, above = page["low"], page["high"], page["width"], page["above"]
        counts = np.zeros((len(low), BINS), np.int64)
        for which, _, s, ok in _scores(page, batches):
            lo, hi, w = low[which][:, None], high[which][:, None], width[which][:, None]
            ok &= (s >= lo) & (s <= hi)
            r, c = np.nonzero(ok)
            # the difference of two 64-bit integers fits unsigned
            below = high[which][r].astype(np.uint64) - s[r, c].astype(np.uint64)
            bins = (below // width[which][r].astype(np.uint64)).astype(np.int64)
            counts += np.bincount(which[r] * BINS + bins, minlength=counts.size).reshape(counts.shape)
        # bins below the one where this task alone has enough can't hold the k-th
        before = np.cumsum(counts, 1) - counts
        q, b = np.nonzero((counts > 0) & (before < (k - above)[:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(q, pa.int32()), pa.array(b, pa.int32()), pa.array(counts[q, b], pa.int64())], names=["query", "bin", "n"]
        )

    return run


def _select(shared, k: int):
    """The candidates above a query's k-th score, and the smallest ids among those equal to it."""

    def run(batches):
        import pyarrow as pa

        page = shared.value
        found = [(np.zeros(0, np.int64),) * 3]

        def trimmed():
            q, i, s = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((i, -s, q))
            q, i, s = q[order], i[order], s[order]
            first = np.searchsorted(q, q)
            keep = np.arange(len(q)) - first < k
            return q[keep], i[keep], s[keep]

        held = 0
        for which, ids, s, ok in _scores(page, batches):
            ok &= s >= page["low"][which][:, None]
            r, c = np.nonzero(ok)
            found.append((which[r], ids[c], s[r, c]))
            held += len(r)
            if held > 1 << 20:
                found = [trimmed()]
                held = len(found[0][0])
        q, i, s = trimmed()
        yield pa.RecordBatch.from_arrays(
            [pa.array(page["ids"][q.astype(int)], pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.int64())],
            names=["query_id", "vec_id", "score"],
        )

    return run


def _page_top(rows, vectors: DataFrame, longest: float, k: int, path: str) -> None:
    """Append the best of a page of queries to the table at ``path``; what was sent to the tasks is released."""
    spark = vectors.sparkSession
    ids = np.array([r.id for r in rows], np.int64)
    dims: dict[int, list[int]] = {}
    for i, r in enumerate(rows):
        dims.setdefault(len(r.q), []).append(i)
    by_dim = {d: (np.array(w), np.array([rows[i].q for i in w], np.int64).reshape(len(w), d)) for d, w in dims.items()}
    # Cauchy-Schwarz bounds every score
    bound = [min(LIMIT, math.isqrt(sum(x * x for x in r.q)) * (math.isqrt(int(longest)) + 1) + math.isqrt(int(longest)) + 2) for r in rows]
    high = np.array(bound, np.int64)
    low, above = -high, np.zeros(len(ids), np.int64)
    page = {"ids": ids, "by_dim": by_dim}
    open_ = np.ones(len(ids), bool)
    while open_.any():
        # spans can exceed 63 bits, so the widths are made of Python integers
        width = np.array([-(-(int(h) - int(lo) + 1) // BINS) for h, lo in zip(high, low, strict=True)], np.int64)
        shared = spark.sparkContext.broadcast(page | {"low": low, "high": high, "width": width, "above": above})
        counts = vectors.mapInArrow(_histogram(shared, k), "query int, bin int, n bigint").groupBy("query", "bin").agg(F.sum("n").alias("n"))
        # the first bin where the count reaches what is needed; none if there are fewer candidates
        need = spark.createDataFrame([(i, int(k - a)) for i, a in enumerate(above) if open_[i]], "query int, need bigint")
        upto = F.sum("n").over(Window.partitionBy("query").orderBy("bin"))
        hits = (
            counts.join(F.broadcast(need), "query")
            .withColumn("upto", upto)
            .where("upto >= need")
            .groupBy("query")
            .agg(F.min(F.struct("bin", "upto", "n")).alias("b"))
            .select("query", "b.*")
        )
        open_[:] = False
        for r in hits.collect():  # one row a query of the page
            i, top = r.query, int(high[r.query]) - r.bin * int(width[r.query])
            above[i] += r.upto - r.n
            high[i], low[i] = top, max(int(low[i]), top - int(width[i]) + 1)
            open_[i] = high[i] > low[i]
        shared.unpersist()
    shared = spark.sparkContext.broadcast(page | {"low": low})
    best = vectors.mapInArrow(_select(shared, k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ranked.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
    shared.unpersist()


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """``queries(id, q)``, ``vectors(id, q)`` -> query_id, rank, vec_id, score.

    ``vectors`` are written once; each page of queries reads them a few times, and the pages' results are one table.
    """
    spark = vectors.sparkSession
    workers(spark)
    asked = cut(queries.groupBy("id").agg(F.min("q").alias("q")), "queries")
    vectors = cut(vectors.select("id", "q"), "vectors")
    square = F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    longest = min(vectors.agg(F.max(square)).first()[0] or 0.0, float(LIMIT) ** 2)
    path, last = scratch_path(spark, "top"), None
    while True:
        rest = asked if last is None else asked.where(F.col("id") > last)
        rows = rest.orderBy("id").limit(PAGE).collect()
        if not rows:
            break
        last = rows[-1].id
        _page_top(rows, vectors, longest * (1 + 1e-9), k, path)
        if len(rows) < PAGE:
            break
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    return spark.read.schema(schema).parquet(path) if last is not None else spark.createDataFrame([], schema)


# DuckDB SQL of the digest columns.
ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10"""

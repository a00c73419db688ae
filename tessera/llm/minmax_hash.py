"""Near-duplicate components by min-max hashing, links confirmed on full shingle sets.

Every permutation gives two signature values, the least and the largest image
of the document's shingles, so ``PERMS`` hash evaluations per shingle make
``2 * PERMS`` values; each agrees with probability J, and for a set of many
shingles the two are nearly independent (an unbiased estimate of lower
variance for the same work). ``ROWS`` consecutive values form a band; equal
bands make a bucket. With 32 bands of 4 a pair at J = 0.8 misses all buckets
with probability 5e-8.

Flow; copies and members of one component cost no pairs, but a bucket of n unlike components has its members sent to
some n / ``BLOCK`` blocks and its pairs of signatures compared there:

1. One scan gives each document its set size, a 128-bit digest of the set and
   the signature. Equal sets collapse to one representative before anything
   else, so groups of copies cost one row.
2. *Stars*: in every bucket each member is compared with the smallest member.
   Confirmed links are contracted to components.
3. *Completion*: where a bucket still holds members of different components,
   the members outside its largest component are compared with the others, in
   blocks of bounded size: first on signatures, then, for the rows that may
   link, on full sets. A pair is compared in its first common bucket only; a
   member that has reached a component need not meet the rest of it. Pairs are
   left out that can't be links by the triangle inequality over the bucket's
   smallest member, and those whose estimate is more than ``SLACK`` below the
   limit (7 standard deviations: a pair at exactly the limit falls below it with probability 1e-10, far less than that
   of missing all buckets, and is then lost unless other links join its components).
4. Components by repeated contraction to the least neighbour; each round is
   two aggregations and a join, cut at the shared checkpoint folder.

Null or empty text: an empty set, linked with nothing. Repeated rows have equal
sets. Rows that share a doc_id are one node. A null doc_id takes the component
of its class (null if none has an id).

Texts may be of any length. An empty table gives an empty result; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut, tidy, workers
from .wordhash import window_hashes, word_hashes

# Parameters.
PERMS = 64
ROWS = 4  # signature values (16 bits each) of a band
BANDS = 2 * PERMS // ROWS
BLOCK = 512  # representatives on either side of a block
BLOCK_SHINGLES = 1 << 20  # shingles on either side of a block (8 bytes each)
SLACK = 0.25
BROADCAST_IDS = 500_000  # ids (8 bytes each) sent to all tasks instead of shuffling texts; beyond: a join

_R = np.random.default_rng(40)
_A = _R.integers(1, 1 << 63, (PERMS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _R.integers(0, 1 << 63, (PERMS, 1), dtype=np.uint64)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; a shorter text is one shingle."""
    return np.unique(window_hashes(words, min(n, len(words)) or 1))


def signature(s: np.ndarray) -> bytes:
    """Minima, then maxima, of all permutations, 16 bits each."""
    low = np.full(PERMS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMS, np.uint64)
    for a in range(0, len(s), 4096):
        y = s[None, a : a + 4096] * _A + _B
        low = np.minimum(low, y.min(1))
        high = np.maximum(high, y.max(1))
    v = np.concatenate([low, high]) * np.uint64(0x9E3779B97F4A7C15)
    return (v >> np.uint64(48)).astype("<u2").tobytes()


def _sketch(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, d1, d2 (digest of the set), sig."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            size, d1, d2, sig = [], [], [], []
            for words in word_hashes(b.column("text").to_pylist(), lower=True):
                s = shingle_set(words, n)
                size.append(len(s))
                d = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8")
                d1.append(int(d[0]))
                d2.append(int(d[1]))
                sig.append(signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(size, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sig, pa.binary())],
                names=["doc_id", "n_shingles", "d1", "d2", "sig"],
            )

    return docs.mapInArrow(tidy(run), "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, sig binary")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, set (sorted 64-bit hashes)."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            sets = [shingle_set(w, n).tobytes() for w in word_hashes(b.column("text").to_pylist(), lower=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sets, pa.binary())], names=["doc_id", "set"])

    return docs.mapInArrow(tidy(run), "doc_id bigint, set binary")


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of the intersection and of the union of their sets."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            both, either = [], []
            for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both.append(int((y[at] == x).sum()))
                either.append(len(x) + len(y) - both[-1])
            cols = [b.column("a"), b.column("b"), pa.array(both, pa.int64()), pa.array(either, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["a", "b", "both", "either"])

    of = lambda name: sets.select(F.col("doc_id").alias(name), F.col("set").alias("s" + name))
    joined = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "sa", "sb")
    return joined.mapInArrow(tidy(run), "a bigint, b bigint, both bigint, either bigint")


def connected(links: DataFrame) -> DataFrame:
    """Links (a, b) -> node, label: the least node reachable, for every node that has a link.

    Every node hands its least neighbour to all its neighbours; connectivity
    stays and paths shorten until each component is a star around its least node.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).where("v > m").distinct(), "edges")
    while True:
        # converged: every child has one parent and no parent is a child
        n, kids = edges.agg(F.count("v"), F.countDistinct("v")).first()
        if n == kids and edges.join(edges.select(F.col("v").alias("m")), "m", "left_semi").isEmpty():
            return edges.select(F.col("v").alias("node"), F.col("m").alias("label")).union(
                edges.select(F.col("m").alias("node"), F.col("m").alias("label")).distinct()
            )
        both = edges.select(F.col("v").alias("u"), F.col("m").alias("w")).union(edges.select(F.col("m").alias("u"), F.col("v").alias("w")))
        least = both.groupBy("u").agg(F.min("w").alias("w")).select("u", F.least("u", "w").alias("m"))
        around = both.join(least, "u").select(F.col("w").alias("v"), "m")
        own = least.select(F.col("u").alias("v"), "m")
        new = cut(around.union(own).where("v > m").distinct(), "edges")
        drop_cut(edges)
        edges = new


def _candidates(pdf, floor: float, apart: float):
    """For each pivot row of a block: the rows that may link to it, best estimate first.

    A pair counts in its first common bucket only. Jaccard distance is a metric
    and every member's exact distance to the bucket's smallest member is known,
    so a pair whose distances differ by more than ``apart`` can't be within it.
    """
    sigs = np.frombuffer(b"".join(pdf["sig"]), "<u2").reshape(len(pdf), -1)
    reps, labels, far = pdf["rep"].to_numpy(), pdf["label"].to_numpy(), pdf["distance"].to_numpy()
    pivot = pdf["pivot"].to_numpy()
    band = int(pdf["band"].iloc[0])
    members = np.flatnonzero(~pivot)
    ms, ml, mf = sigs[members], labels[members], far[members]
    for i in np.flatnonzero(pivot):
        other = np.flatnonzero((ml != labels[i]) & (np.abs(mf - far[i]) <= apart + 1e-9))
        same = ms[other] == sigs[i]
        est = same.mean(1)
        first = same.reshape(len(other), BANDS, ROWS).all(2).argmax(1)
        good = np.flatnonzero((first == band) & (est >= floor))
        if len(good):
            found = members[other[good]]
            yield i, found[np.lexsort((reps[found], -est[good]))]


def _asked(floor: float, apart: float):
    """Of a block, the rows that take part in any comparison."""

    def run(pdf):
        keep = np.zeros(len(pdf), bool)
        for i, found in _candidates(pdf, floor, apart):
            keep[i] = True
            keep[found] = True
        return pdf[keep]

    return run


def _linked(floor: float, apart: float, percent: int):
    """Confirmed links of a block: for each pivot, one to every other component it reaches."""

    def run(pdf):
        import pandas as pd

        reps, labels = pdf["rep"].to_numpy(), pdf["label"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in pdf["set"]]
        out = []
        for i, found in _candidates(pdf, floor, apart):
            own, met = sets[i], set()
            while len(found):
                some, found = found[:32], found[32:]
                sizes = np.array([len(sets[j]) for j in some])
                flat = np.concatenate([sets[j] for j in some])
                at = np.searchsorted(own, flat)
                at[at == len(own)] = 0
                both = np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
                for j in some[100 * both >= percent * (sizes + len(own) - both)]:
                    if labels[j] not in met:
                        met.add(labels[j])
                        out.append((min(reps[i], reps[j]), max(reps[i], reps[j])))
                if met and len(found):
                    found = found[~np.isin(labels[found], list(met))]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _completion(buckets: DataFrame, labels: DataFrame, sigs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between unlike components that share a bucket, from blocks of bounded size."""
    # a node without any confirmed link is its own component
    named = buckets.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    named = cut(named, "named")
    per_label = named.groupBy("band", "key", "label").agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum("n").alias("w")).alias("c"))
    per_bucket = (
        per_label.groupBy("band", "key")
        .agg(
            F.count(F.lit(1)).alias("n_labels"), F.sum("c.n").alias("n"), F.sum("c.w").alias("w"),
            F.max(F.struct("c", "label")).alias("top"),
        )
        .where("n_labels > 1")
    )
    # chunks of either side, by members and by shingles
    chunks = lambda n, w: F.greatest(F.ceil(n / BLOCK), F.ceil(w / BLOCK_SHINGLES)).cast("int")
    per_bucket = per_bucket.select(
        "band", "key", F.col("top.label").alias("major"), chunks(F.col("n"), F.col("w")).alias("mn"),
        chunks(F.col("n") - F.col("top.c.n"), F.col("w") - F.col("top.c.w")).alias("pn"),
    )
    rows = named.join(per_bucket, ["band", "key"]).join(sigs, "rep")
    own = lambda n, seed: F.pmod(F.xxhash64("rep", F.lit(seed)), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys, cols = ["band", "key", "pc", "mc"], ["rep", "label", "sig", "distance"]
    as_member = rows.select("band", "key", all_of("pn").alias("pc"), own("mn", 1).alias("mc"), *cols, F.lit(False).alias("pivot"))
    as_pivot = rows.where("label <> major").select("band", "key", own("pn", 2).alias("pc"), all_of("mn").alias("mc"), *cols, F.lit(True).alias("pivot"))
    # blocks are bounded by their comparisons, not by bytes: dealt by number, so that no reader merges them by size
    parts = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = as_member.union(as_pivot).repartition(parts, *keys)
    limits = (percent / 100 - SLACK, 1 - percent / 100)
    asked = cut(blocks.groupBy(*keys).applyInPandas(_asked(*limits), blocks.schema), "asked")
    full = asked.join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    return full.groupBy(*keys).applyInPandas(_linked(*limits, percent), "a bigint, b bigint")


def components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    workers(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sketch = cut(_sketch(docs, n), "sketch")

    # classes of equal sets; copies cost one row from here on
    classes = cut(
        sketch.where("n_shingles > 0")
        .groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n")),
        "classes",
    )
    reps = classes.where("rep is not null").select("rep", "sig", "n")
    bands = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(F.substr(F.col("sig"), b * (2 * ROWS) + 1, F.lit(2 * ROWS)))))
    every = reps.select("rep", "n", bands.alias("band", "key"))
    shared = every.groupBy("band", "key").agg(F.min("rep").alias("centre"), F.max("rep").alias("last")).where("centre < last")
    buckets = cut(every.join(shared.select("band", "key", "centre"), ["band", "key"]), "buckets")

    # full sets of the representatives that share a bucket with another
    ids = cut(buckets.select(F.col("rep").alias("doc_id")).distinct(), "ids")
    few = ids.count() <= BROADCAST_IDS
    sets = cut(_sets(docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi"), n), "sets")

    enough = F.col("both") * 100 >= F.col("either") * percent
    # the smallest member of a bucket meets all others
    stars = buckets.where("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    met = cut(similarities(stars, sets), "pairs")
    labels = cut(connected(met.where(enough)), "labels")

    distance = met.select(F.col("a").alias("centre"), F.col("b").alias("rep"), (1 - F.col("both") / F.col("either")).alias("distance"))
    rest = cut(buckets.join(distance, ["centre", "rep"]).select("band", "key", "rep", "n", "distance"), "rest")
    sigs = reps.join(ids.select(F.col("doc_id").alias("rep")), "rep", "left_semi").select("rep", "sig").dropDuplicates(["rep"])
    more = _completion(rest, labels, sigs, sets, percent)
    known = labels.where("node <> label").select(F.col("label").alias("a"), F.col("node").alias("b"))
    labels = cut(connected(more.union(known)), "labels")

    named = classes.select("d1", "d2", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("d1", "d2", F.coalesce("label", "rep").alias("component_id"))
    out = sketch.select("doc_id", "n_shingles", "d1", "d2").join(named, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


# DuckDB SQL of ``components(documents, n=4, percent=80)``: all pairs that share a shingle.
ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS a FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(a[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, a, unnest(range(1, greatest(len(a) - 2, 2))) AS i FROM w WHERE len(a) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS p, y.doc_id AS q, count(*) AS c FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (
  SELECT p, q FROM shared JOIN n a ON a.doc_id = p JOIN n b ON b.doc_id = q WHERE 100 * c >= 80 * (a.n + b.n - c)),
edge AS (SELECT p, q FROM link UNION ALL SELECT q, p FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, edge.q FROM reach JOIN edge ON edge.p = reach.r),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""

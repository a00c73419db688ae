"""Mixing sources to target weights by subset-sum budget fitting.

Sources share ``SHARE`` of all words by weight; a source that would get more
than ``MOST`` times its own words stops there and the excess is shared again.
A source takes every document as often as fits whole; the words still missing
are a budget, fitted on the histogram of exact document lengths:

* each length gives its proportional part of the budget (rounded down),
* large lengths fill what is left down to a small rest, and
* a bounded knapsack (reachable sums, each length at most as often as it is
  left) picks the lengths that meet the rest exactly or come nearest.

How many documents of each length to take is then turned into a cut in seeded
hash order. Counts per hash range find the range that holds the cut, and only
that range is ordered, so a length shared by a third of all documents is
neither sorted nor gathered.

A histogram has one row per source and length; one source's lengths (at most
its longest document's many) go to one task. Null text has size 0 and takes
nothing; a null source is a source of its own, last in order. Rows that agree
in doc_id and text share their verdict.

An empty table gives an empty result. Texts may be of any length; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, workers

# Fixed values of the task.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2

# Parameters.
SEED = 17
REST = 1 << 15  # words left to the knapsack


def targets(sizes: np.ndarray, weights: np.ndarray, total: float, most: float = MOST) -> np.ndarray:
    """``total`` shared by weight, none above ``most`` times its size (water filling)."""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    out = np.zeros(len(sizes))
    free = np.ones(len(sizes), bool)
    left = float(total)
    while free.any():
        level = left / weights[free].sum()
        over = free & (weights * level > most * sizes)
        if not over.any():
            out[free] = weights[free] * level
            break
        out[over] = most * sizes[over]
        left -= out[over].sum()
        free &= ~over
    return out


def knapsack(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How often to take each length so that the sum comes nearest ``budget`` (the lower of two as near)."""
    taken = [0] * len(lengths)
    if budget <= 0:
        return taken
    # a sum of 2 * budget is as far off as nothing, so larger ones don't matter
    top = budget + min(budget, max((x for x, c in zip(lengths, counts, strict=True) if c), default=0))
    by = np.full(top + 1, -1, np.int32)  # the length that first reached each sum
    reached = np.zeros(top + 1, bool)
    reached[0] = True
    for i, (size, count) in enumerate(zip(lengths, counts, strict=True)):
        if not 0 < size <= top or reached[budget]:
            continue
        front = reached
        for _ in range(min(count, top // size)):
            new = np.zeros(top + 1, bool)
            new[size:] = front[:-size]
            new &= ~reached
            if not new.any():
                break
            by[new] = i
            reached = reached | new
            front = new
    sums = np.flatnonzero(reached)
    s = int(sums[np.argmin(np.abs(sums - budget))])
    while s:
        taken[by[s]] += 1
        s -= lengths[by[s]]
    return taken


def plan(lengths: np.ndarray, counts: np.ndarray, target: float) -> tuple[int, list[int]]:
    """Whole copies of every document, and how many documents of each length to take once more."""
    size = [int(x) for x in lengths]
    n = [int(x) for x in counts]
    total = sum(a * b for a, b in zip(size, n, strict=True))
    if total == 0:
        return 0, [0] * len(size)
    full = min(MOST, int(target // total))
    budget = 0 if full == MOST else int(round(target - full * total))
    extra = [b * budget // total for b in n]
    rest = budget - sum(a * b for a, b in zip(size, extra, strict=True))
    order = sorted(range(len(size)), key=lambda i: -size[i])
    for i in order:
        if size[i] and rest > REST:
            more = min(n[i] - extra[i], max(0, rest - REST) // size[i])
            extra[i] += more
            rest -= more * size[i]
    more = knapsack([size[i] for i in order], [n[i] - extra[i] for i in order], rest)
    for i, k in zip(order, more, strict=True):
        extra[i] += k
    return full, extra


def _sized(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with its size and place in seeded order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns(
        {
            "_size": F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long"),
            "_mark": F.struct(
                F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 31)).alias("h"),
                F.col("doc_id").cast("long").alias("doc_id"),
                F.xxhash64(text).alias("t"),
            ),
        }
    )


def _bucket(n: Column) -> Column:
    """Range of the seeded order a row falls in; a group of n rows has about sqrt(n) ranges."""
    return F.floor(F.col("_mark.h") * F.ceil(F.sqrt(n)) / F.lit(1 << 31))


def decide(sized: DataFrame) -> DataFrame:
    """k (source, null last), source, size -> source_size, target, full copies, and which
    documents to take once more: all, or those up to ``cut`` in seeded order (before ``below``)."""
    spark = sized.sparkSession
    workers(spark)
    rows = sized.select("source", F.col("_size").alias("size"), "_mark")
    hist = cut(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    sources = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))

    def share(pdf):
        w = np.array(WEIGHTS)[np.arange(len(pdf)) % len(WEIGHTS)]
        pdf = pdf.sort_values("k")
        pdf = pdf.drop(columns="all")
        return pdf.assign(target=targets(pdf["source_size"], w, SHARE * float(pdf["source_size"].sum())))

    ranked = sources.withColumn("k", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    one = ranked.withColumn("all", F.lit(0)).groupBy("all")  # one row a source
    shared = one.applyInPandas(share, "source string, source_size long, k int, target double")
    shared = cut(shared, "targets")

    def fit(pdf):
        pdf = pdf.sort_values("size")
        full, extra = plan(pdf["size"].to_numpy(), pdf["n"].to_numpy(), float(pdf["target"].iloc[0]))
        return pdf.assign(full=full, extra=extra)

    planned = cut(
        hist.join(shared.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .select("k", "source", "size", "n", "source_size", "target")
        .groupBy("k")
        .applyInPandas(fit, "k int, source string, size long, n long, source_size long, target double, full int, extra long"),
        "plan",
    )
    partial = planned.where("extra > 0 AND extra < n").select(F.col("source").alias("s"), F.col("size").alias("z"), "k", "n", "extra")
    part = (
        rows.join(partial, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
        .select("k", "size", "n", "extra", "_mark")
        .withColumn("bucket", _bucket(F.col("n")))
    )
    group = Window.partitionBy("k", "size")
    upto = part.groupBy("k", "size", "extra", "n", "bucket").agg(F.count(F.lit(1)).alias("c")).withColumn("upto", F.sum("c").over(group.orderBy("bucket")))
    # the range that holds the last document to take, and how many to take of it
    edge = upto.where((F.col("upto") >= F.col("extra")) & (F.col("upto") - F.col("c") < F.col("extra"))).select(
        F.col("k").alias("ek"), F.col("size").alias("ez"), F.col("bucket").alias("eb"), (F.col("extra") - F.col("upto") + F.col("c")).alias("need")
    )
    inside = part.join(edge, (F.col("k") == F.col("ek")) & (F.col("size") == F.col("ez")) & (F.col("bucket") == F.col("eb")))
    last = (
        inside.withColumn("at", F.count(F.lit(1)).over(group.orderBy("_mark")))  # equal marks count together
        .groupBy("k", "size", "eb")
        .agg(F.max(F.when(F.col("at") <= F.col("need"), F.col("_mark"))).alias("cut"))
    )
    return cut(planned.join(last, ["k", "size"], "left").withColumnRenamed("eb", "below"), "decisions")


def _taken(sized: DataFrame, decisions: DataFrame) -> DataFrame:
    """``sized`` with the decision of its source and size (columns ``_d_...``), and ``_times``."""
    d = decisions.select([F.col(c).alias(f"_d_{c}") for c in decisions.columns])
    joined = sized.join(d, F.col("source").eqNullSafe(F.col("_d_source")) & (F.col("_size") == F.col("_d_size")))
    once_more = (
        F.when(F.col("_d_extra") == 0, False)
        .when(F.col("_d_extra") == F.col("_d_n"), True)
        .otherwise((_bucket(F.col("_d_n")) < F.col("_d_below")) | F.coalesce(F.col("_mark") <= F.col("_d_cut"), F.lit(False)))
    )
    return joined.withColumn("_times", F.col("_d_full") + F.coalesce(once_more, F.lit(False)).cast("int"))


def mix(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, source)`` -> doc_id, source, size, source_size, target, taken (words)."""
    sized = cut(_sized(docs.select("doc_id", "text", "source")).select("doc_id", "source", "_size", "_mark"), "sized")
    return _taken(sized, decide(sized)).select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", F.col("_size").alias("size"),
        F.col("_d_source_size").alias("source_size"), F.col("_d_target").alias("target"),
        (F.col("_size") * F.col("_times")).alias("taken"),
    )


def take(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the columns of ``docs``.

    Documents without words fill no budget; they stay as often as their source is taken whole.
    """
    sized = _sized(docs)
    decisions = decide(cut(sized.select("source", "_size", "_mark"), "sized"))
    rows = _taken(sized, decisions).where("_times > 0")
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy")).drop("_copy")

r"""Prefix trie of rebuilt conversations by whole-sequence collapse.

1. Turns are numbered by a range sort over (conversation, turn, role, text); what a conversation
   has in earlier partitions is added to the place in its own. From here on a turn is its
   place, two hashes (halves of its role and text's SHA-256) and the bytes of its text.
2. Conversations are rebuilt: a donor's first turns, then their own after those.
3. Collapse: a sequence is named by its length and the exclusive or of 128-bit hashes of (place, role, text). Equal
   sequences become one with a weight (how many), a representative (the smallest conversation) and an end list (all of them,
   kept as its digest).
4. The turns of the representatives alone give prefixes, by running exclusive ors within blocks of
   ``RUN`` turns that start from what all earlier blocks add up to.
5. Sequences that are proper prefixes of another go by an anti join; the rest are the leaves.
6. Weighted prefixes are summed to nodes. A node's smallest member owns it, and what a sequence owns is a tail of it;
   so the text bytes below a node, each node once, are sums over its sequences of least(bytes from the node on, bytes owned),
   and no node is joined with its ancestors.

No group is gathered: sums, minima and exclusive ors combine before the shuffle, a conversation or an end list of any length
spans partitions, and an end list is digested as a stream of sorted pieces of ``PIECE`` ids.

Rows come in order of turn (null first), then role, then text, so ties and repeated rows have a defined order and all count as
turns. Null role or text is empty. Rows without conv_id belong to no conversation and are left out. An empty table has no nodes, not
even a root. Ids below zero: c - c % 5 with the remainder's sign that of c. Texts may be of any length; other columns are ignored,
whatever their names. Equality is decided by 128 bits of hashes, of texts by 128 bits of SHA-256.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, workers

# Parameters.
FAMILY = 5  # conversations that share a donor
SHARES = 9  # a conversation takes crc32(id) % SHARES turns of its donor
RUN = 4_096  # turns of a conversation scanned in one group
PIECE = 4_096  # ids of an end list in one row
SORT_CHARS = 64  # of a text that decide its range partition

ID = ["depth", "p1", "p2"]


def numbered(turns: DataFrame) -> DataFrame:
    """c, pos, a, b, bytes of every turn; pos from 0."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text")
    )
    placed = rows.repartitionByRange("c", "turn", "role", F.substr("text", F.lit(1), F.lit(SORT_CHARS))).sortWithinPartitions("c", "turn", "role", "text")
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    half = lambda at: F.conv(F.substr("digest", F.lit(at), F.lit(16)), 16, -10).cast("long")
    placed = placed.select("c", F.octet_length("text").cast("long").alias("bytes"), digest.alias("digest"), F.monotonically_increasing_id().alias("at"))
    placed = placed.select("c", F.shiftright("at", 33).alias("part"), "at", half(1).alias("a"), half(17).alias("b"), "bytes")
    placed = cut(placed, "turns")
    pieces = placed.groupBy("c", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select("c", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("move"))
    return placed.join(pieces, ["c", "part"]).select("c", (F.col("at") + F.col("move")).alias("pos"), "a", "b", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (c), and their rebuilt turns (c, pos, t1, t2, bytes): t1, t2 hash the place and the turn."""
    turns = cut(numbered(turns), "numbered")
    sizes = turns.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    donor = F.col("c") - F.col("c") % FAMILY
    convs = sizes.select("c", donor.alias("donor"), (F.crc32(F.col("c").cast("string")) % SHARES).alias("h"))
    given = sizes.select(F.col("c").alias("donor"), F.col("n").alias("given"))
    convs = cut(convs.join(given, "donor", "left").withColumn("given", F.least("h", F.coalesce("given", F.lit(0)))), "convs")
    heads = turns.where(F.col("pos") < SHARES - 1).withColumnRenamed("c", "donor")
    borrowed = convs.where("h > 0").join(heads, "donor").where("pos < h").select("c", "pos", "a", "b", "bytes")
    own = turns.join(convs, "c").where("pos >= h").select("c", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "a", "b", "bytes")
    term = lambda k: F.xxhash64(F.lit(k), "pos", "a", "b")
    out = borrowed.union(own).select("c", "pos", term(1).alias("t1"), term(2).alias("t2"), "bytes")
    return convs.select("c"), cut(out, "rebuilt")


def _pieces(batches):
    """Sorted ids of a partition as comma-joined pieces: depth, p1, p2, first id, text."""
    import pyarrow as pa

    key, ids = None, []

    def piece(key, ids):
        cols = [pa.array([k], pa.int64()) for k in (*key, ids[0])]
        return pa.RecordBatch.from_arrays([*cols, pa.array([",".join(map(str, ids))], pa.string())], names=[*ID, "first", "ids"])

    for b in batches:
        for *k, c in zip(*(b.column(name).to_pylist() for name in (*ID, "c")), strict=True):
            if ids and (k != key or len(ids) == PIECE):
                yield piece(key, ids)
                ids = []
            key = k
            ids.append(c)
    if ids:
        yield piece(key, ids)


def _digests(batches):
    """Sorted pieces, all of a key in one partition: one digest a key, kept as a running state."""
    import pyarrow as pa

    def row(key, state):
        cols = [pa.array([k], pa.int64()) for k in key]
        return pa.RecordBatch.from_arrays([*cols, pa.array([state.hexdigest()], pa.string())], names=[*ID, "ends"])

    key, state = None, None
    for b in batches:
        for *k, text in zip(*(b.column(name).to_pylist() for name in (*ID, "ids")), strict=True):
            if k != key:
                if state is not None:
                    yield row(key, state)
                key, state = k, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if state is not None:
        yield row(key, state)


def _ends(members: DataFrame) -> DataFrame:
    """``members(depth, p1, p2, c)`` -> the digest of each sequence's ids."""
    order = [*ID, "c"]
    types = "depth bigint, p1 bigint, p2 bigint"
    pieces = cut(members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces, f"{types}, first bigint, ids string"), "pieces")
    return pieces.repartition(*ID).sortWithinPartitions(*ID, "first").mapInArrow(_digests, f"{types}, ends string")


def _xor(name: str):
    return F.bit_xor(name)


def trie(turns: DataFrame) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` -> one row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    workers(turns.sparkSession)
    convs, steps = rebuilt(turns)

    # whole sequences; a conversation left without turns is the empty one
    whole = steps.groupBy("c").agg(F.count(F.lit(1)).alias("depth"), _xor("t1").alias("p1"), _xor("t2").alias("p2"), F.sum("bytes").alias("all"))
    zero = F.lit(0).cast("long")
    members = convs.join(whole, "c", "left").select("c", *[F.coalesce(x, zero).alias(x) for x in (*ID, "all")])
    members = cut(members, "members")
    sequences = cut(members.groupBy(*ID).agg(F.count(F.lit(1)).alias("weight"), F.min("c").alias("c"), F.max("all").alias("all")), "sequences")
    ends = _ends(members)

    # prefixes of the representatives
    kept = steps.join(sequences.select("c", "weight", "all", F.col("depth").alias("whole")), "c").withColumn("block", F.expr(f"pos div {RUN}"))
    blocks = kept.groupBy("c", "block").agg(_xor("t1").alias("x1"), _xor("t2").alias("x2"), F.sum("bytes").alias("sum"))
    earlier = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("c", "block", *[F.coalesce(f(x).over(earlier), zero).alias(x) for f, x in ((_xor, "x1"), (_xor, "x2"), (F.sum, "sum"))])
    upto = Window.partitionBy("c", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    p1, p2 = (F.col(f"x{i}").bitwiseXOR(_xor(f"t{i}").over(upto)) for i in (1, 2))
    prefixes = kept.join(blocks, ["c", "block"]).select(
        "c", "weight", "all", "whole", "bytes", (F.col("pos") + 1).alias("depth"), p1.alias("p1"), p2.alias("p2"), "t1", "t2",
        (F.col("sum") + F.sum("bytes").over(upto) - F.col("bytes")).alias("before"),
    )
    parents = [F.col(f"p{i}").bitwiseXOR(F.col(f"t{i}")).alias(f"q{i}") for i in (1, 2)]
    prefixes = prefixes.select("c", "weight", "all", "whole", "bytes", *ID, *parents, "before")
    root = sequences.select("c", "weight", "all", F.col("depth").alias("whole"), *[zero.alias(x) for x in ("bytes", *ID, "q1", "q2", "before")])
    prefixes = cut(prefixes.union(root), "prefixes")

    # leaves: sequences that are no proper prefix
    inner = prefixes.where("depth < whole").select(*ID).distinct()
    leaves = sequences.join(inner, ID, "left_anti").select("c", F.lit(1).cast("long").alias("leaf"))

    below = F.col("all") - F.col("before")  # bytes of a sequence from the node on
    nodes = prefixes.groupBy(*ID).agg(
        F.min("c").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.col("weight") * below).alias("gross"),
        F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.max("bytes").alias("bytes"),
    )
    nodes = cut(nodes, "nodes")
    owned = nodes.groupBy(F.col("conv_id").alias("c")).agg(F.sum("bytes").alias("owned"))
    facts = sequences.select("c").join(leaves, "c", "left").join(owned, "c", "left")
    facts = facts.select("c", F.coalesce("leaf", zero).alias("leaf"), F.coalesce("owned", zero).alias("owned"))

    # all that is summed by node, in one shuffle
    empty = F.lit(None).cast("string")
    by_sequence = prefixes.join(facts, "c").select(*ID, "leaf", F.least(below, "owned").alias("net"), zero.alias("child"), empty.alias("ends"))
    by_child = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), "q1", "q2", zero, zero, F.lit(1).cast("long"), empty)
    by_end = ends.select(*ID, zero, zero, zero, "ends")
    sums = by_sequence.union(by_child).union(by_end).groupBy(*ID).agg(
        F.sum("leaf").alias("n_leaves"), F.sum("net").alias("net"), F.sum("child").alias("n_children"), F.max("ends").alias("ends")
    )
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    # the root's own parent hashes are zero, but no node lies at depth -1
    out = nodes.join(sums, ID).join(above, ["depth", "q1", "q2"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("gross") - F.col("net")).alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


# DuckDB SQL of ``trie(conversations)``: sequences as lists, members of each distinct prefix.
ORACLE = r"""
WITH t AS (
  SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
k AS (
  SELECT c, turns, CAST(xor(list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda s, x: list_reduce(list_concat([xor(s, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda v, i: xor(v // 2, 3988292384 * (v % 2)))), 4294967295) % 9 AS BIGINT) AS h
  FROM t),
r AS (
  SELECT k.c, list_concat(coalesce(d.turns, [])[1:k.h], k.turns[k.h + 1:]) AS s
  FROM k LEFT JOIN t d ON d.c = k.c - k.c % 5),
p AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS depth FROM r),
n AS (
  SELECT depth, s[1:depth] AS node, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CASE WHEN len(s) = depth THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '') AS ends
  FROM p GROUP BY ALL),
v AS (
  SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(node[depth].text) END AS saved,
    NOT EXISTS (SELECT 1 FROM n m WHERE m.depth = n.depth + 1 AND m.node[1:n.depth] = n.node) AS leaf
  FROM n),
u AS (SELECT node, saved, leaf, depth AS own, unnest(range(0, depth + 1)) AS d FROM v),
b AS (
  SELECT d AS depth, node[1:d] AS node, sum(saved) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves,
    count(*) FILTER (own = d + 1) AS n_children
  FROM u GROUP BY ALL)
SELECT v.conv_id, v.depth, a.conv_id AS parent_conv_id, v.n_convs, b.n_children, b.n_leaves,
  CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM v JOIN b ON b.depth = v.depth AND b.node = v.node LEFT JOIN v a ON a.depth = v.depth - 1 AND a.node = v.node[1:a.depth]"""

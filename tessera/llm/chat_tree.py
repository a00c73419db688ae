r"""Chat formatting as prefix trees.

A turn is written ``### role: text</turn>`` and a newline. Inside role and text
a backslash precedes every backslash and every control string (``### ``,
``</turn>``; in a role also ``:``), which is undone by dropping each escaping
backslash. Tokens are code points of that text.

Conversations that share their first turns share the tokens: a node is a turn
together with all turns before it (its id is a chained 128-bit hash), and is
emitted once, depth-first. Sorting the distinct conversations by their chains
of ids *is* the depth-first order: each adds the turns beyond what it shares
with the one before. So the sort is a range exchange, one pass over each
partition gives positions relative to it, and what a partition shares with
the last conversation of the one before is settled from one row a partition.

Output of ``pack``:

* nodes: tree, node, parent, depth, start (first token in its tree's packed
  sequence), length, position (position id of its first token: tokens of its
  ancestors), role, segment (its tokens), loss_from, loss_to (tokens of the
  segment under the loss: an assistant's text), ancestors (intervals of the
  packed sequence that its tokens attend to, besides the node itself up to
  each token; adjacent ones merged).
* paths: leaf, nodes (the chain of ids of each distinct conversation).
* members: conv_id, leaf.

Nothing is gathered by first turn or by conversation text: equal conversations
collapse in an aggregation, and a tree may span any number of partitions.

Rows come in order of turn (null first), then role, then text, so ties and
repeated rows have a defined order and all count as turns. Null role or text is
empty. Rows without conv_id belong to no conversation and are left out.

An empty table gives no nodes, paths or members. Other columns are ignored, whatever their
names. Texts may be of any length, but one conversation's turns and segments pass through a task as one
row (see the README's limits).
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, workers

HEAD, SEP, TAIL = "### ", ": ", "</turn>\n"
_CONTROL = re.compile(r"\\|### |</turn>")
_ROLE = re.compile(r"\\|### |</turn>|:")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.DOTALL)
ID = 16  # bytes of a node id

PROBE_SCHEMA = "conv_id bigint, turn bigint, role string, text string"
PROBE_TURNS = [(-7, t, r, r"\### Assistant: </turn> ok") for t, r in enumerate(("user", "assistant"))]


def escape(text: str, role: bool = False) -> str:
    return (_ROLE if role else _CONTROL).sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """Tokens of a turn, and where its text begins and ends in them."""
    head = HEAD + escape(role, role=True) + SEP
    body = escape(text)
    return head + body + TAIL, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn; fails on anything but turns."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        out.append((unescape(m.group(1)), unescape(m.group(2))))
        at = m.end()
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return out


def _chain(turns) -> list[bytes]:
    ids, last = [], b""
    for t in turns:
        role, text = t["role"].encode(), t["text"].encode()
        last = hashlib.blake2b(last + len(role).to_bytes(8, "little") + role + text, digest_size=ID).digest()
        ids.append(last)
    return ids


def _chains(batches):
    import pyarrow as pa

    for b in batches:
        chains = [_chain(t) for t in b.column("turns").to_pylist()]
        cols = [b.column("conv_id"), b.column("turns"), pa.array([b"".join(c) for c in chains], pa.binary()), pa.array([c[-1] for c in chains], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["conv_id", "turns", "path", "leaf"])


def _shared(a: bytes, b: bytes) -> int:
    """Leading ids that two paths have in common."""
    n = min(len(a), len(b)) // ID
    k = 0
    while k < n and a[k * ID : k * ID + ID] == b[k * ID : k * ID + ID]:
        k += 1
    return k


_PLACED = (
    "pid int, nth bigint, path binary, turns array<struct<turn: bigint, role: string, text: string>>, "
    "lens array<bigint>, starts array<bigint>, fresh int, as_first int, total bigint"
)


def _place(batches):
    """Sorted paths of one partition: starts relative to the partition, as if it shared nothing with the one before."""
    import pyarrow as pa
    from pyspark import TaskContext

    pid = TaskContext.get().partitionId()
    last, starts, lens, as_first, total, nth = b"", [], [], 0, 0, 0
    for b in batches:
        out: dict[str, list] = {k: [] for k in ("nth", "lens", "starts", "fresh", "as_first", "total")}
        for path, turns in zip(b.column("path").to_pylist(), b.column("turns").to_pylist(), strict=True):
            k = _shared(last, path) if nth else 0
            as_first = min(as_first, k) if nth else len(turns)
            lens, starts = lens[:k], starts[:k]
            for t in turns[k:]:
                lens.append(len(segment(t["role"], t["text"])[0]))
                starts.append(total)
                total += lens[-1]
            for name, v in zip(out, (nth, list(lens), list(starts), k, as_first, total), strict=True):
                out[name].append(v)
            last = path
            nth += 1
        n = b.num_rows
        long, longs = pa.int64(), pa.list_(pa.int64())
        cols = [
            pa.array([pid] * n, pa.int32()), pa.array(out["nth"], long), b.column("path"), b.column("turns"),
            pa.array(out["lens"], longs), pa.array(out["starts"], longs), pa.array(out["fresh"], pa.int32()),
            pa.array(out["as_first"], pa.int32()), pa.array(out["total"], long),
        ]
        yield pa.RecordBatch.from_arrays(cols, names=["pid", "nth", "path", "turns", "lens", "starts", "fresh", "as_first", "total"])


def _settle(pdf):
    """One row a partition, in order: what it shares with the one before, and where its own tokens begin."""
    import pandas as pd

    out, last, true, end = [], b"", [], 0
    for r in pdf.sort_values("pid").itertuples():
        k = _shared(last, r.first_path)
        carry = list(true[:k])
        shift = end - sum(list(r.first_lens)[:k])
        end = shift + int(r.total)
        own = min(k, int(r.last_as_first))
        true = carry[:own] + [int(s) + shift for s in list(r.last_starts)[own:]]
        last = r.last_path
        out.append((int(r.pid), k, carry, shift))
    return pd.DataFrame(out, columns=["pid", "k", "carry", "shift"])


def _emit(batches):
    """New nodes of each path, with final positions."""
    import pyarrow as pa

    kinds = [
        ("tree", pa.binary()), ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("start", pa.int64()),
        ("length", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("segment", pa.string()),
        ("loss_from", pa.int64()), ("loss_to", pa.int64()),
        ("ancestors", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
    for b in batches:
        rows = []
        for r in b.to_pylist():
            same = min(r["k"], r["as_first"])  # nodes that an earlier partition emitted
            starts = r["carry"][:same] + [s + r["shift"] for s in r["starts"][same:]]
            new = max(r["fresh"], r["k"]) if r["nth"] == 0 else r["fresh"]
            root = starts[0]
            spans: list[list[int]] = []
            position = 0
            for depth, (turn, n, start) in enumerate(zip(r["turns"], r["lens"], starts, strict=True)):
                at = start - root
                ids = r["path"][depth * ID : depth * ID + ID]
                if depth >= new:
                    seg, a, e = segment(turn["role"], turn["text"])
                    if turn["role"] != "assistant":
                        a = e = 0
                    parent = r["path"][(depth - 1) * ID : depth * ID] if depth else None
                    rows.append((r["path"][:ID], ids, parent, depth, at, n, position, turn["role"], seg, a, e, [{"start": x, "end": y} for x, y in spans]))
                if spans and spans[-1][1] == at:
                    spans[-1][1] = at + n
                else:
                    spans.append([at, at + n])
                position += n
        cols = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(cols, kinds, strict=True)], names=[k for k, _ in kinds])


_NODES = (
    "tree binary, node binary, parent binary, depth int, start bigint, length bigint, position bigint, role string, segment string, "
    "loss_from bigint, loss_to bigint, ancestors array<struct<start: bigint, end: bigint>>"
)


def pack(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``turns(conv_id, turn, role, text)`` -> nodes, paths, members."""
    spark = turns.sparkSession
    workers(spark)
    row = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = turns.where("conv_id IS NOT NULL").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    turn_type = "array<struct<turn: bigint, role: string, text: string>>"
    convs = cut(convs.mapInArrow(_chains, f"conv_id bigint, turns {turn_type}, path binary, leaf binary"), "conversations")
    owners = convs.groupBy("leaf").agg(F.min("conv_id").alias("conv_id"))
    distinct = convs.join(owners, ["conv_id", "leaf"])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(
        distinct.select("path", "turns").repartitionByRange(parts, "path").sortWithinPartitions("path").mapInArrow(_place, _PLACED), "placed"
    )
    ends = placed.groupBy("pid").agg(
        F.min_by(F.struct("path", "lens"), "nth").alias("f"), F.max_by(F.struct("path", "starts", "as_first", "total"), "nth").alias("l")
    )
    ends = ends.select(
        F.lit(0).alias("all"), "pid", F.col("f.path").alias("first_path"), F.col("f.lens").alias("first_lens"), F.col("l.path").alias("last_path"),
        F.col("l.starts").alias("last_starts"), F.col("l.as_first").alias("last_as_first"), F.col("l.total").alias("total"),
    )
    settled = ends.groupBy("all").applyInPandas(_settle, "pid int, k int, carry array<bigint>, shift bigint")  # one row a partition
    nodes = cut(placed.join(F.broadcast(cut(settled, "settled")), "pid").mapInArrow(_emit, _NODES), "nodes")
    last = F.length("path") - ID + 1
    chain = F.transform(F.sequence(F.lit(0), (F.length("path") / ID).cast("int") - 1), lambda i: F.substr(F.col("path"), (i * ID + 1).cast("int"), F.lit(ID)))
    paths = placed.select(F.substr(F.col("path"), last, F.lit(ID)).alias("leaf"), chain.alias("nodes"))
    return nodes, paths, convs.select("conv_id", "leaf")


def _digests(batches):
    import pyarrow as pa

    for b in batches:
        n, sha, loss, loss_sha, chars = [], [], [], [], []
        for parts in b.column("parts").to_pylist():
            formatted = "".join(p["segment"] for p in parts)
            turns = parse(formatted)
            n.append(len(turns))
            sha.append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
            under = "".join(unescape(p["segment"][p["loss_from"] : p["loss_to"]]) for p in parts)
            loss.append(len(under))
            loss_sha.append(hashlib.sha256(under.encode()).hexdigest())
            chars.append(len(formatted))
        long = pa.int64()
        yield pa.RecordBatch.from_arrays(
            [b.column("leaf"), pa.array(n, long), pa.array(sha, pa.string()), pa.array(loss, long), pa.array(loss_sha, pa.string()), pa.array(chars, long)],
            names=["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )


def read_back(nodes: DataFrame, paths: DataFrame, members: DataFrame) -> DataFrame:
    """Every conversation put together again from its nodes, parsed, and digested."""
    steps = paths.select("leaf", F.posexplode("nodes").alias("depth", "node"))
    parts = steps.join(nodes.select("node", "segment", "loss_from", "loss_to"), "node")
    whole = parts.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("depth", "segment", "loss_from", "loss_to"))).alias("parts"))
    schema = "leaf binary, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return members.join(whole.mapInArrow(_digests, schema), "leaf").select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )


# DuckDB SQL of the digest columns, straight from the turns.
ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
    sum(4 + length(regexp_replace(role, '(\\|### |</turn>|:)', '\\\1', 'g')) + 2
        + length(regexp_replace(text, '(\\|### |</turn>)', '\\\1', 'g')) + 8) AS chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(chars AS BIGINT) AS formatted_chars
FROM c"""

"""Substring dedup: repeated windows of ``n`` words are found by Rabin-Karp hashes and removed.

A word goes if some ``n``-word window that covers it also starts in a document
with a smaller doc_id. Three steps:

1. Each task hashes every window of its texts and, batch by batch, keeps one
   row per distinct window: the smallest document of the batch that holds it,
   and where. Windows of the batch's other documents are already known to
   repeat; their runs are sent on as they are. So a window that a third of all
   documents share costs one row a batch.
2. The remaining windows are dealt by hash and counted: every one whose smallest
   document is smaller than the batch's own is a repeat. Hashes travel packed
   (sorted, differences in byte planes, zstd), several thousand windows a row,
   in a number of groups that follows the amount of text.
3. The starts of repeated windows go back packed, are gathered by document and
   become maximal removal intervals (union of [start, start + n)); the words
   outside are kept.

Equal windows mean equal hashes of 64 bits, and of 96 where the text is so
large (``WIDE_CHARS``) that 64 would make chance matches likely.

Null text has no words. Texts shorter than ``n`` words lose nothing. Rows that
share a doc_id are judged separately and don't make each other repeat; a null
doc_id is never the smaller one, and its rows lose nothing.

Empty texts have no words; texts may be of any length (a batch is cut by characters). An empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import workers
from .wordhash import window_hashes, word_hashes

# Parameters.
GROUP_CHARS = 1 << 23  # characters of text whose windows make one group
WIDE_CHARS = 1 << 33  # from here on 32 bits of a second hash tell windows apart as well
BATCH_CHARS = 1 << 22  # characters hashed before their windows are sent


def pack(a: np.ndarray) -> bytes:
    """An integer array as zstd of its byte planes: small values cost their low bytes only."""
    import zstandard

    width = a.dtype.itemsize
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def _runs(positions: np.ndarray) -> bytes:
    """Sorted window starts as (first, length) of consecutive ones."""
    cutoff = np.flatnonzero(np.diff(positions) > 1) + 1
    first = positions[np.append(0, cutoff)]
    length = np.diff(np.append(np.append(0, cutoff), len(positions)))
    return np.stack([first, length], 1).astype("<u4").tobytes()


def _first_equal(*keys: np.ndarray) -> np.ndarray:
    """For sorted keys: index of the first row of each row's run of equals."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)[np.cumsum(new) - 1]


def _batch_windows(ids: np.ndarray, rows: np.ndarray, texts: list[str], n: int, groups: int, wide: bool):
    """Rows (grp, doc, row, kind, a, b, c) of one batch, its texts sorted by id; kind 0: packed windows
    of a group, kind 1: repeated starts of one document."""
    docs, places, h1, h2 = [], [], [], []
    for i, words in enumerate(word_hashes(texts)):
        w = window_hashes(words, n)
        docs.append(np.full(len(w), i, np.uint32))
        places.append(np.arange(len(w), dtype=np.uint32))
        h1.append(w)
        h2.append((window_hashes(words, n, 1) >> np.uint64(32)).astype("<u4") if wide else np.zeros(len(w), "<u4"))
    doc, place, h1, h2 = map(np.concatenate, (docs, places, h1, h2))
    if not len(doc):
        return
    order = np.lexsort((h2, h1)) if wide else np.argsort(h1, kind="stable")  # stable: by id, then place
    doc, place, h1, h2 = doc[order], place[order], h1[order], h2[order]
    known = ids[doc] > ids[doc[_first_equal(h1, h2)]]
    at = np.flatnonzero(known)
    at = at[np.lexsort((place[at], doc[at]))]
    for part in np.split(at, np.flatnonzero(np.diff(doc[at].astype(np.int64))) + 1):
        if len(part):
            d = doc[part[0]]
            yield int(rows[d]) % groups, int(ids[d]), int(rows[d]), 1, _runs(place[part].astype(np.int64)), None, None
    # what may repeat elsewhere: windows of the smallest document (all their places)
    rest = np.flatnonzero(~known)
    doc, place, h1, h2 = doc[rest], place[rest], h1[rest], h2[rest]
    group = ((h1 >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)  # ranges of hashes
    for part in np.split(np.arange(len(group)), np.flatnonzero(np.diff(group)) + 1):
        used, local = np.unique(doc[part], return_inverse=True)
        heads = np.stack([ids[used], rows[used]]).astype("<i8")
        where = np.stack([local.astype("<u4"), place[part].astype("<u4"), *([h2[part]] if wide else [])])
        yield int(group[part[0]]), 0, 0, 0, pack(np.diff(h1[part], prepend=np.uint64(0))), pack(heads.ravel()), pack(where.ravel())


_SENT = "grp bigint, doc bigint, row bigint, kind int, a binary, b binary, c binary"


def _windows(n: int, groups: int, wide: bool):
    def run(batches):
        import pandas as pd

        for b in batches:
            b = b.sort_values("doc_id", kind="stable")
            ids, rows = b["doc_id"].to_numpy(np.int64), b["row"].to_numpy(np.int64)
            texts = b["text"].tolist()
            a = 0
            while a < len(texts):
                e, size = a, 0
                while e < len(texts) and (e == a or size + len(texts[e]) <= BATCH_CHARS):
                    size += len(texts[e])
                    e += 1
                out = list(_batch_windows(ids[a:e], rows[a:e], texts[a:e], n, groups, wide))
                if out:
                    yield pd.DataFrame(out, columns=["grp", "doc", "row", "kind", "a", "b", "c"])
                a = e

    return run


def _replies(ids, rows, first, length, groups: int):
    """(to, a, b): runs of repeated starts of many documents, packed by the group their document is dealt to."""
    to = (rows % groups).astype(np.int64)
    order = np.lexsort((first, rows, ids, to))
    ids, rows, first, length, to = ids[order], rows[order], first[order], length[order], to[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1])
    for part in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(to)) + 1):
        if len(part):
            head = part[new[part]]
            count = np.diff(np.append(np.flatnonzero(new[part]), len(part)))
            heads = np.stack([ids[head], rows[head], count]).astype("<i8")
            yield int(to[part[0]]), pack(heads.ravel()), pack(np.stack([first[part], length[part]]).astype("<u4").ravel())


def _repeats(groups: int):
    """One group of windows: those whose smallest document is smaller than their own."""

    def run(pdf):
        import pandas as pd

        ids, rows, place, h1, h2 = [], [], [], [], []
        found = []  # (ids, rows, first, length)
        for d, r, k, a, b, c in zip(pdf["doc"], pdf["row"], pdf["kind"], pdf["a"], pdf["b"], pdf["c"], strict=True):
            if k == 1:
                x = np.frombuffer(a, "<u4").astype(np.int64).reshape(-1, 2)
                found.append((np.full(len(x), d), np.full(len(x), r), x[:, 0], x[:, 1]))
                continue
            h = np.cumsum(unpack(a, "<u8"), dtype=np.uint64)
            heads = unpack(b, "<i8").reshape(2, -1)
            where = unpack(c, "<u4").reshape(-1, len(h))
            h1.append(h)
            ids.append(heads[0][where[0]])
            rows.append(heads[1][where[0]])
            place.append(where[1])
            h2.append(where[2] if len(where) > 2 else np.zeros(len(h), np.uint32))
        if h1:
            ids, rows, place, h1, h2 = map(np.concatenate, (ids, rows, place, h1, h2))
            order = np.lexsort((ids, h2, h1))
            ids, rows, place, h1, h2 = ids[order], rows[order], place[order], h1[order], h2[order]
            hit = np.flatnonzero(ids > ids[_first_equal(h1, h2)])
            found.append((ids[hit], rows[hit], place[hit].astype(np.int64), np.ones(len(hit), np.int64)))
        out = list(_replies(*map(np.concatenate, zip(*found, strict=True)), groups)) if found else []
        return pd.DataFrame(out, columns=["to", "a", "b"])

    return run


def _gather(pdf):
    """Replies to one group of documents: one row for each document that loses words."""
    import pandas as pd

    parts = []
    for a, b in zip(pdf["a"], pdf["b"], strict=True):
        heads = unpack(a, "<i8").reshape(3, -1)
        first, length = unpack(b, "<u4").reshape(2, -1).astype(np.int64)
        parts.append((np.repeat(heads[0], heads[2]), np.repeat(heads[1], heads[2]), first, length))
    ids, rows, first, length = map(np.concatenate, zip(*parts, strict=True))
    order = np.lexsort((first, rows, ids))
    ids, rows, first, length = ids[order], rows[order], first[order], length[order]
    split = np.flatnonzero((np.diff(ids) != 0) | (np.diff(rows) != 0)) + 1
    out = []
    for part in np.split(np.arange(len(ids)), split):
        # consecutive runs as one
        f, e = first[part], first[part] + length[part]
        new = np.append(True, f[1:] > np.maximum.accumulate(e)[:-1])
        end = np.maximum.reduceat(e, np.flatnonzero(new))
        out.append((int(ids[part[0]]), int(rows[part[0]]), np.stack([f[new], end - f[new]], 1).astype("<u4").tobytes()))
    return pd.DataFrame(out, columns=["doc_id", "row", "runs"])


def intervals(runs: bytes | None, n: int) -> list[tuple[int, int]]:
    """Maximal [start, end) in words of everything the repeated windows cover."""
    if not runs:
        return []
    r = np.frombuffer(runs, "<u4").astype(np.int64).reshape(-1, 2)
    a, e = r[:, 0], r[:, 0] + r[:, 1] + n - 1
    order = np.argsort(a, kind="stable")
    a, e = a[order], np.maximum.accumulate(e[order])
    first = np.append(True, a[1:] > e[:-1])
    last = np.append(first[1:], True)
    return list(zip(a[first].tolist(), e[last].tolist(), strict=True))


def _compressed(batches):
    """Texts as zstd for the way to their removal intervals."""
    import pyarrow as pa
    import zstandard

    for b in batches:
        press = zstandard.ZstdCompressor(level=1)
        data = [press.compress(t.encode()) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(data, pa.binary())], names=["doc_id", "row", "data"])


def _finish(n: int, with_text: bool):
    def run(batches):
        import pyarrow as pa
        import zstandard

        for b in batches:
            total, gone, sha, kept_text, spans = [], [], [], [], []
            plain = zstandard.ZstdDecompressor()
            for text, runs in zip(b.column("data").to_pylist(), b.column("runs").to_pylist(), strict=True):
                words = plain.decompress(text).split()
                cuts = intervals(runs, n)
                kept, at = [], 0
                for x, y in cuts:
                    kept += words[at:x]
                    at = y
                kept += words[at:]
                data = b" ".join(kept)
                total.append(len(words))
                gone.append(len(words) - len(kept))
                sha.append(hashlib.sha256(data).hexdigest())
                if with_text:
                    kept_text.append(data.decode())
                    spans.append([{"start": x, "end": y} for x, y in cuts])
            cols = [b.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                cols += [pa.array(kept_text, pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
                names += ["kept_text", "removed"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def remove_repeats(docs: DataFrame, n: int = 13, with_text: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_words, n_removed, kept_sha256; ``with_text``: also the
    kept text and the removed word intervals."""
    workers(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # tells rows with one doc_id apart; equal rows share their verdict
    docs = docs.withColumn("row", F.xxhash64("text").bitwiseAND(F.lit((1 << 63) - 1)))
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // GROUP_CHARS))
    sent = docs.where("doc_id IS NOT NULL").mapInPandas(_windows(n, groups, chars >= WIDE_CHARS), _SENT)
    replies = sent.groupBy("grp").applyInPandas(_repeats(groups), "to bigint, a binary, b binary")
    hits = replies.groupBy("to").applyInPandas(_gather, "doc_id bigint, row bigint, runs binary")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    schema += ", kept_text string, removed array<struct<start: bigint, end: bigint>>" * with_text
    whole = docs.mapInArrow(_compressed, "doc_id bigint, row bigint, data binary")
    return whole.join(hits, ["doc_id", "row"], "left").select("doc_id", "data", "runs").mapInArrow(_finish(n, with_text), schema)


# DuckDB SQL of ``remove_repeats(documents, 13)``.
ORACLE = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS a FROM documents),
win AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) < doc_id AS hit FROM (
    SELECT doc_id, i, array_to_string(a[i:i + 12], ' ') AS g
    FROM (SELECT doc_id, a, unnest(range(1, len(a) - 11)) AS i FROM w))),
word AS (SELECT doc_id, unnest(range(1, len(a) + 1)) AS i, unnest(a) AS word FROM w),
cover AS (
  SELECT word.doc_id, word.i, word.word,
    coalesce(max(CASE WHEN win.hit THEN 1 ELSE 0 END) OVER (
      PARTITION BY word.doc_id ORDER BY word.i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM word LEFT JOIN win ON win.doc_id = word.doc_id AND win.i = word.i),
o AS (
  SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed,
    coalesce(string_agg(CASE WHEN gone = 0 THEN word END, ' ' ORDER BY i), '') AS kept FROM cover GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN o USING (doc_id)"""

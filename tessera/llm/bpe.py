"""Byte-level BPE: pre-tokenisation by array scans, cached pair merging, decoding.

Texts are split without a regular expression. Every code point is mapped to a
class, and a small automaton reads the classes: the state after a code point
is a *function* of the state before it, and such functions compose
associatively, so a batch of texts is cut into equal blocks whose functions
are computed side by side (one numpy step per column for all blocks and all
start states), the block functions are chained, and one more sweep fills in
the states. Boundaries are then array comparisons. The automaton is only
needed for contractions (``'s 't 're 've 'm 'll 'd``); runs of letters,
numbers, other marks and white space follow from neighbouring classes.

The slices between boundaries feed a bounded cache of merged pieces; the misses of
a batch are merged together by rank, lowest first: one numpy round makes one merge in
each of them. Piece offsets, in code points and in ids, are kept
beside the ids: any range of the text is decoded from its own pieces alone
(``decode_span``), and the round trip checks each piece's offset against the
bytes that its ids stand for.

The rank file is sent to the executors with ``addFile``; its path need not exist there.

One map-only pass; a text is never split between tasks and a batch is cut by
characters, not rows, so very long texts bound memory by themselves. Null text
counts as empty: no ids, decoded to the empty string.

Repeated rows are encoded separately. An empty table gives an empty result; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEPT, tidy, workers

# Classes of code points; letters that occur in contractions have their own.
END, SPACE, WHITE, NUMBER, MARK, QUOTE, LETTER = range(7)
L_S, L_T, L_R, L_E, L_V, L_M, L_L, L_D = range(7, 15)
N_CLASSES = 15

# States: what the last code point was part of.
FREE, IN_LETTERS, IN_NUMBER, IN_MARKS, AT_SPACE, AT_WHITE, AT_QUOTE, Q_R, Q_V, Q_L, DONE = range(11)
N_STATES = 11

# Fixed value: what the pattern's \s matches.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Letters and numbers of Unicode 16, for Pythons whose tables are older (first, last).
LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
]
NUMBERS_16 = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]

CACHE_PIECES = 150_000  # entries of each of a worker's two generations
NO_RANK = 1 << 40
NO_PAIR = (1 << 31) - 1  # no rank either, where a place of 32 bits follows
CACHE_LONGEST = 64  # longer pieces are merged each time
PACK_PIECES = 1 << 17  # pieces looked up at once; a generation of the cache holds them
BATCH_CHARS = 1 << 20
DECODE_PIECES = 1 << 14  # pieces decoded at once


def class_table() -> np.ndarray:
    """Class of every code point, from the Unicode categories L* and N*."""
    t = np.full(0x110000, MARK, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            t[c] = LETTER
        elif k == "N":
            t[c] = NUMBER
    for ranges, k in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
        for a, b in ranges:
            t[a : b + 1] = k
    t[WHITE_SPACE] = WHITE
    t[0x20] = SPACE
    t[ord("'")] = QUOTE
    for c, k in zip("strevmld", (L_S, L_T, L_R, L_E, L_V, L_M, L_L, L_D), strict=True):
        t[ord(c)] = k
    return t


def transition_table() -> np.ndarray:
    """``[class, state] -> state``."""
    t = np.empty((N_CLASSES, N_STATES), np.uint8)
    t[END] = FREE
    t[SPACE] = AT_SPACE
    t[WHITE] = AT_WHITE
    t[NUMBER] = IN_NUMBER
    t[MARK] = IN_MARKS
    # a quote opens a contraction unless it continues marks or follows a space
    t[QUOTE] = AT_QUOTE
    t[QUOTE, [IN_MARKS, AT_QUOTE, AT_SPACE]] = IN_MARKS
    t[LETTER:] = IN_LETTERS
    t[[L_S, L_T, L_M, L_D], AT_QUOTE] = DONE
    t[L_R, AT_QUOTE], t[L_V, AT_QUOTE], t[L_L, AT_QUOTE] = Q_R, Q_V, Q_L
    t[L_E, Q_R] = t[L_E, Q_V] = t[L_L, Q_L] = DONE
    return t


def scan_states(classes: np.ndarray, table: np.ndarray, block: int = 256) -> np.ndarray:
    """State after each code point, starting FREE, by a blocked associative scan."""
    n = len(classes)
    rows = -(-n // block)
    grid = np.zeros(rows * block, np.uint8)
    grid[:n] = classes
    grid = grid.reshape(rows, block).T.copy()  # one column of all blocks is contiguous
    # each block as a function of its start state
    flat = table.ravel()
    fn = np.broadcast_to(np.arange(N_STATES, dtype=np.uint8), (rows, N_STATES)).copy()
    # a class that maps every state to one makes the function constant: start from the last such
    constant = (table == table[:, :1]).all(1)
    last = block - 1 - constant[grid[::-1]].argmax(0)
    known = constant[grid[last, np.arange(rows)]]
    for j in range(int(last.min()) if rows else 0, block):
        step = table[grid[j]]
        fn = np.take_along_axis(step, fn, 1)
    fn[~known] = _whole_blocks(grid[:, ~known], table)
    # chain the block functions
    start = np.empty(rows, np.uint8)
    s = FREE
    for r in range(rows):
        start[r] = s
        s = fn[r, s]
    out = np.empty_like(grid)
    state = start
    for j in range(block):
        state = flat[grid[j].astype(np.intp) * N_STATES + state]
        out[j] = state
    return out.T.ravel()[:n]


def _whole_blocks(grid: np.ndarray, table: np.ndarray) -> np.ndarray:
    fn = np.broadcast_to(np.arange(N_STATES, dtype=np.uint8), (grid.shape[1], N_STATES)).copy()
    for j in range(grid.shape[0]):
        fn = np.take_along_axis(table[grid[j]], fn, 1)
    return fn


_CLASS: np.ndarray | None = None
_TRANS = transition_table()


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Boolean: a piece starts at this code point. Texts are separated by code point 0x110000
    (not a character), which is a piece of its own."""
    global _CLASS
    if _CLASS is None:
        _CLASS = np.append(class_table(), np.uint8(END))
    c = _CLASS[points]
    s = scan_states(c, _TRANS)
    group = np.array([0, 1, 1, 2, 3, 3, *[4] * (N_CLASSES - 6)], np.uint8)[c]
    n = len(c)
    start = np.ones(n, bool)
    if n > 1:
        new = group[1:] != group[:-1]
        after_space = c[:-1] == SPACE
        solid = group[1:] > 1
        start[1:] = np.where(solid & after_space, False, new)
        start[1:] |= c[1:] == END
        # the last of several white-space characters before something solid stands alone or joins it
        white = group == 1
        last_white = white[:-1] & (group[1:] > 1)
        start[:-1] |= last_white
        # a contraction: its letters belong to the quote, and a new piece follows
        done = np.flatnonzero(s == DONE)
        if len(done):
            two = np.isin(s[done - 1], (Q_R, Q_V, Q_L))
            start[done] = False
            start[done[two] - 1] = False
            after = done[done + 1 < n] + 1
            start[after] = start[after] | (group[after] > 1) & (c[after] != SPACE)
    return start


class PieceCache(dict):
    """Packed ids by piece, two generations: a piece not used while a whole
    generation filled up is forgotten, so memory is bounded and frequent pieces stay."""

    def __init__(self, merge):
        self.merge, self.old = merge, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.merge(piece.encode())
        if len(piece) <= CACHE_LONGEST:
            if len(self) >= CACHE_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def fill(self, missing: set[str], merge_many) -> None:
        """Hold these pieces, which this generation lacks: from the one before, or merged together."""
        short = [p for p in missing if len(p) <= CACHE_LONGEST]
        found = {p: self.old[p] for p in short if p in self.old}
        new = [p for p in short if p not in found]
        if len(self) + len(short) > CACHE_PIECES:
            self.old = dict(self)
            self.clear()
        self.update(found)
        self.update(zip(new, merge_many([p.encode() for p in new]), strict=True))


class Merger:
    """Merges the bytes of one piece by rank; results are cached as packed ids."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.vocabulary = [b""] * (max(self.ranks.values()) + 1)
        for b, i in self.ranks.items():
            self.vocabulary[i] = b
        self.cache = PieceCache(self.merge)
        ranks = self.ranks
        self.byte_ids = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        # what two neighbours merge to, by (left id, right id) as one sorted key
        made = {
            left * len(self.vocabulary) + right: i
            for b, i in ranks.items()
            for k in range(1, len(b))
            if (left := ranks.get(b[:k])) is not None and (right := ranks.get(b[k:])) is not None
        }
        keys = np.fromiter(made, np.int64, len(made))
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.int64(1) << 62)
        self.pair_ranks = np.append(np.fromiter(made.values(), np.int64, len(made))[order], NO_PAIR)
        # the same for two bytes
        self.byte_pairs = np.array([ranks.get(bytes([i >> 8, i & 255]), NO_PAIR) for i in range(1 << 16)], np.int64)

    def merge(self, piece: bytes) -> bytes:
        ranks = self.ranks
        if piece in ranks:
            return ranks[piece].to_bytes(4, "little")
        if len(piece) > 256:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(a + b, NO_RANK) for a, b in zip(parts, parts[1:])]  # noqa: B905
        while pairs and (best := min(pairs)) != NO_RANK:
            at = pairs.index(best)
            new = parts[at] + parts[at + 1]
            parts[at : at + 2] = [new]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = ranks.get(new + parts[at + 1], NO_RANK)
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + new, NO_RANK)
        return b"".join([ranks[p].to_bytes(4, "little") for p in parts])

    def _merge_long(self, piece: bytes) -> bytes:
        """The same order of merges (lowest rank, then leftmost) with a heap: n log n."""
        import heapq

        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # part at i is piece[i:end[i]]
        before = list(range(-1, n - 1))
        alive = [True] * n

        def rank(i: int) -> int | None:
            j = end[i]
            return None if j >= n else ranks.get(piece[i : end[j]])

        heap = [(r, i) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or rank(i) != r:
                continue
            j = end[i]
            end[i] = end[j]
            alive[j] = False
            if end[i] < n:
                before[end[i]] = i
            for k in (before[i], i):
                if k >= 0 and (q := rank(k)) is not None:
                    heapq.heappush(heap, (q, k))
        return b"".join(ranks[piece[i : end[i]]].to_bytes(4, "little") for i in range(n) if alive[i])

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """``merge`` of each piece. All pieces lie in one array; a round makes the lowest, then leftmost merge of each."""
        out = [self.ranks[p].to_bytes(4, "little") if p in self.ranks else b"" for p in pieces]
        word = np.array([i for i, ids in enumerate(out) if not ids and pieces[i]], np.int64)  # those still merged
        if not len(word):
            return out
        size = np.array([len(pieces[i]) for i in word.tolist()], np.int64)
        data = np.frombuffer(b"".join([pieces[i] for i in word.tolist()]), np.uint8).astype(np.int64)
        ids = self.byte_ids[data]
        if ids.min() < 0:  # bytes without a rank of their own
            return [self.merge(p) for p in pieces]
        rank = np.append(self.byte_pairs[data[:-1] << 8 | data[1:]], NO_PAIR)  # of the merge with the next id
        rank[np.cumsum(size) - 1] = NO_PAIR
        while len(word):
            end = np.cumsum(size)
            start = end - size
            best = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), start)
            live = best >> 32 != NO_PAIR
            packed = ids.astype("<u4").tobytes()
            for i, a, b in zip(word[~live].tolist(), (4 * start[~live]).tolist(), (4 * end[~live]).tolist(), strict=True):
                out[i] = packed[a:b]
            best, first, last = best[live], start[live], end[live]
            at = best & 0xFFFFFFFF
            ids[at] = best >> 32
            right, left = at[at + 2 < last], at[at > first]
            rank[at] = NO_PAIR
            near = self._pair_rank(ids[np.concatenate([right, left - 1])], ids[np.concatenate([right + 2, left])])
            rank[right], rank[left - 1] = near[: len(right)], near[len(right) :]
            keep = np.repeat(live, size)
            keep[at + 1] = False
            ids, rank, word, size = ids[keep], rank[keep], word[live], size[live] - 1
        return out

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * len(self.vocabulary) + right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_PAIR)

    def pack(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of each piece."""
        cache, out = self.cache, []
        for i in range(0, len(pieces), PACK_PIECES):
            some = pieces[i : i + PACK_PIECES]
            got = list(map(cache.get, some))
            lost = [j for j, ids in enumerate(got) if ids is None]
            cache.fill({some[j] for j in lost}, self.merge_many)
            for j in lost:
                got[j] = cache[some[j]]
            out += got
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_MERGERS: dict[str, Merger] = {}
_SENT: set[tuple[str, str]] = set()


def merger(path: str) -> Merger:
    """One per worker and vocabulary."""
    if path not in _MERGERS:
        _MERGERS[path] = Merger(path)
    return _MERGERS[path]


def send(spark: SparkSession, path: str) -> str:
    """Send the rank file to all executors, once an application; the name that they find it by."""
    sc = spark.sparkContext
    if (sc.applicationId, path) not in _SENT:
        sc.addFile(path)
        _SENT.add((sc.applicationId, path))
    return path.rstrip("/").rsplit("/", 1)[-1]


def sent_merger(name: str) -> Merger:
    KEPT["bpe"] = _MERGERS.clear
    return merger(SparkFiles.get(name))


def encode_texts(texts: list[str], m: Merger) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Packed ids of each text, and the start of each piece in code points and in ids."""
    joined = "".join(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    points = np.full(int(ends[-1]) if len(texts) else 0, 0x110000, np.uint32)
    inside = np.ones(len(points), bool)
    inside[ends - 1] = False
    points[inside] = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    starts = np.flatnonzero(piece_starts(points))
    at = np.searchsorted(starts, ends - 1)  # index of each text's separator
    first, owns, pieces = 0, [], []
    for text, size, end, stop in zip(texts, sizes.tolist(), ends.tolist(), at.tolist(), strict=True):
        own = starts[first:stop] - (end - 1 - size)
        first = stop + 1
        cuts = own.tolist()
        cuts.append(size)
        pieces += [text[a:b] for a, b in zip(cuts, cuts[1:])]  # noqa: B905
        owns.append(own.astype(np.int64))
    packed = m.pack(pieces)
    first = 0
    for own in owns:
        ids = packed[first : first + len(own)]
        first += len(own)
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        yield b"".join(ids), own, np.cumsum(counts) - counts


def decode_span(packed: bytes, starts: np.ndarray, id_starts: np.ndarray, a: int, b: int, m: Merger) -> str:
    """Code points [a, b) of the text, from the ids of the pieces that hold them alone; b: its length at most."""
    if a >= b or not len(starts):
        return ""
    i, j = int(np.searchsorted(starts, a, "right")) - 1, int(np.searchsorted(starts, b, "left"))
    to = 4 * int(id_starts[j]) if j < len(starts) else len(packed)
    first = int(starts[i])
    return m.decode(packed[4 * int(id_starts[i]) : to]).decode()[a - first : b - first]


def decode_pieces(packed: bytes, starts: np.ndarray, id_starts: np.ndarray, m: Merger) -> Iterator[bytes]:
    """The bytes of a text, ``DECODE_PIECES`` pieces at a time; fails where the offsets disagree with the ids."""
    for i in range(0, len(starts), DECODE_PIECES):
        j = i + DECODE_PIECES
        data = m.decode(packed[4 * int(id_starts[i]) : 4 * int(id_starts[j]) if j < len(starts) else len(packed)])
        if j < len(starts) and len(data.decode()) != starts[j] - starts[i]:
            raise ValueError("piece offsets disagree with the ids")
        yield data


def _batches(texts: Iterable[str]) -> Iterator[list[str]]:
    """Groups of texts of about BATCH_CHARS; a longer text is a group of its own."""
    out: list[str] = []
    n = 0
    for t in texts:
        if out and n + len(t) > BATCH_CHARS:
            yield out
            out, n = [], 0
        out.append(t)
        n += len(t)
    if out:
        yield out


def encode(docs: DataFrame, path: str, key: str = "doc_id", offsets: bool = True) -> DataFrame:
    """``docs(key, text)`` -> key, ids (packed little-endian unsigned 32-bit); ``offsets``: also the start of each
    piece in code points (piece_starts) and in ids (piece_ids)."""
    workers(docs.sparkSession)
    name = send(docs.sparkSession, path)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        m = sent_merger(name)
        for b in batches:
            texts = b.column("text").to_pylist()
            ids, starts, firsts = [], [], []
            for group in _batches(texts):
                for packed, own, first in encode_texts(group, m):
                    ids.append(packed)
                    starts.append(own)
                    firsts.append(first)
            cols = [b.column(key), pa.array(ids, pa.binary())]
            names = [key, "ids"]
            if offsets:
                cols += [pa.array(starts, pa.list_(pa.int64())), pa.array(firsts, pa.list_(pa.int64()))]
                names += ["piece_starts", "piece_ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"`{key}` {kind}, ids binary" + ", piece_starts array<bigint>, piece_ids array<bigint>" * offsets
    return docs.select(key, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(tidy(run, "bpe"), schema)


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``encoded(key, ids)`` -> key, data (the bytes the ids stand for)."""
    workers(encoded.sparkSession)
    name = send(encoded.sparkSession, path)
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        m = sent_merger(name)
        for b in batches:
            data = [m.decode(x or b"") for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(data, pa.binary())], names=[key, "data"])

    return encoded.select(key, "ids").mapInArrow(tidy(run, "bpe"), f"`{key}` {kind}, data binary")


def round_trip(docs: DataFrame, path: str, ids: bool = False) -> DataFrame:
    """Encode every text, decode the ids again by the offsets, and give the digests of both (one pass, no join);
    ``ids``: the packed ids as well."""
    workers(docs.sparkSession)
    name = send(docs.sparkSession, path)

    def run(batches):
        import pyarrow as pa

        m = sent_merger(name)
        for b in batches:
            n, ids_sha, text_sha, kept = [], [], [], []
            for group in _batches(b.column("text").to_pylist()):
                for packed, starts, firsts in encode_texts(group, m):
                    n.append(len(packed) // 4)
                    ids_sha.append(hashlib.sha256(packed).hexdigest())
                    text = hashlib.sha256()
                    for data in decode_pieces(packed, starts, firsts, m):
                        text.update(data)
                    text_sha.append(text.hexdigest())
                    if ids:
                        kept.append(packed)
            cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                cols.append(pa.array(kept, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * ids
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(tidy(run, "bpe"), schema)

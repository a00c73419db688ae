r"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within them, one representative a group.

1. Equal vectors collapse to one class with a weight; only classes are compared.
2. Spherical k-means is fitted on a bounded sample: the ``SAMPLE`` classes with the least hashes, fewer where they exceed
   ``SAMPLE_BYTES``. There is a cell for ``CELL`` classes, at most ``MAX_CELLS``.
3. Every class goes home to the cell of its nearest centre. Where it lies so near the border of a lower-numbered cell that a
   vector across it could still be within the angle, it also visits that cell. Two unit vectors within the angle t on two sides of
   the hyperplane between centres u and v are both within sin(t) of it, so a visit where y(v - u) <= sin(t) |v - u| loses no link.
   ``border`` replaces sin(t) by a smaller number to trade links for time; the registered query keeps the exact one.
4. Classes are sorted by cell (in a cell, by its leaves: the nearest of a few more centres) and packed into pages of
   ``PAGE_BYTES`` at most, each class in one page. Pairs of pages are read from the packed table as they are multiplied: no
   vector is copied for a visit, and disk holds each class a fixed number of times, whatever it is near to.
5. A page is made of blocks of up to ``BLOCK`` classes of one leaf. Each pair of blocks (home with home, home with visitors) is
   sorted along the line between the two means: unit vectors of the least cosine c are at most sqrt(2 - 2c) apart, on that line
   too, so only the corner of the two blocks that is so near is multiplied, in pieces of ``PIECE``: first along a few principal axes
   of the sample, where the rest of two vectors adds no more than the product of its lengths, then whole in single precision;
   what may reach the limit is settled by products in double precision. A task returns weights of linked classes and a
   spanning forest of its links, never the pairs.
6. Components by contraction; a class's smallest id stands for it.

Where the vectors have no structure (cosines near zero everywhere) borders are near, most cells are visited and every pair of
blocks is looked at; what is multiplied of them gets less the more leaves there are.

Rows find their class by 128 bits of hashes (two of 64); that two unlike vectors agree in them is not provided for.

Null vectors, vectors holding null or non-finite components and zero vectors link with nothing: n_links 0, component_id their
own id. So do rows without vec_id (component_id null, kept true). Vectors of unlike length don't link; only those of the most
frequent length get cells, others are compared length by length. Lengths count, not directions, in the collapse: 2x and x are two classes, which
link. Rows that repeat a vec_id are vectors of their own: equal vectors are linked copies, unlike ones need not be. An
empty table gives an empty result. Components are scaled before squaring, so that large and tiny ones keep their direction.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import cut, drop_cut, give_back, tidy, workers
from .minmax_hash import connected

# Parameters.
CELL = 4_096  # classes a cell is to have
MAX_CELLS = 256
SAMPLE = 16_384  # classes that the centres are fitted on
SAMPLE_BYTES = 32 << 20
ROUNDS = 12
BLOCK = 2_048  # classes on a side of a block pair
PAGE_BYTES = 6 << 20
TASKS = 96  # of pairs of pages, at least
TASK_PAIRS = 1 << 36  # pairs of classes that are looked at in a task, about
PAGES = 24  # as many at least, where they have a block each, so that all cores get pairs
PIECE = 1_024  # classes multiplied at once
SLACK = 1e-9  # of the border test, for rounding
OPEN = 1e-5  # share of unlinked pairs that narrowed vectors may leave in doubt
FOUND = 1 << 20  # linked classes that a task holds before it joins them


def _units(batch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and unit vectors of the rows of one length at a time."""
    import pyarrow.compute as pc

    lengths = pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        x = flat[(ends[rows] - d)[:, None] + np.arange(d)].reshape(len(rows), int(d)).astype(float)
        yield rows, normal(x)


def normal(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled by their largest component first, so that squares neither overflow nor vanish."""
    y = x / np.abs(x).max(1, keepdims=True)
    return y / np.linalg.norm(y, axis=1, keepdims=True)


# --- cells


def centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centres of spherical k-means, started at spread-out rows of the sample (each the farthest of a few from those taken)."""
    rng = np.random.default_rng(13)
    cells = min(cells, len(sample))
    taken = [int(rng.integers(len(sample)))]
    near = sample @ sample[taken[0]]
    while len(taken) < cells:
        tries = rng.integers(0, len(sample), 16)
        taken.append(int(tries[np.argmin(near[tries])]))
        near = np.maximum(near, sample @ sample[taken[-1]])
    c = sample[taken]
    for _ in range(ROUNDS):
        home = np.argmax(sample @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        new = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), c)  # an empty cell keeps its centre
        if np.abs(new - c).max() < 1e-9:
            break
        c = new
    return c


def visits(y: np.ndarray, home: np.ndarray, c: np.ndarray, border: float, slack: float = SLACK) -> np.ndarray:
    """Of unit vectors and all cells: is it a lower-numbered cell than home, and the border to it near?"""
    s = y @ c.T
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * (c @ c.T)))
    near = s[np.arange(len(y)), home][:, None] - s <= border * apart[home] + slack
    return near & (np.arange(len(c))[None, :] < home[:, None])


def places(y: np.ndarray, c: np.ndarray, border: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home or visit) of unit vectors: all cells that a row has to be compared in."""
    home = np.argmax(y @ c.T, axis=1)
    r, j = np.nonzero(visits(y, home, c, border))
    return np.concatenate([np.arange(len(y)), r]), np.concatenate([home, j]), np.concatenate([np.ones(len(y), bool), np.zeros(len(r), bool)])


def leaves(sample: np.ndarray, c: np.ndarray, classes: int) -> list[np.ndarray]:
    """For each cell the centres of its leaves: one for ``BLOCK`` classes, as the sample has them."""
    home = np.argmax(sample @ c.T, axis=1)
    out = []
    for k in range(len(c)):
        own = sample[home == k]
        wanted = min(len(own), math.ceil(len(own) * classes / len(sample) / BLOCK))
        out.append(centres(own, wanted) if wanted > 1 else c[k : k + 1])
    return out


def narrowing(sample: np.ndarray, cosine: float) -> np.ndarray | None:
    """Some directions, d x k, that tell most unlinked pairs apart: x y <= (x D)(y D) + |rest of x| |rest of y|. The first of the
    sample's principal axes, as many as leave fewer than ``OPEN`` of its unlinked pairs in doubt; None where that takes most."""
    d = sample.shape[1]
    axes = np.linalg.svd(sample, full_matrices=False)[2].T
    half = min(len(sample) // 2, PIECE)
    x, y = sample[:half] @ axes, sample[-half:] @ axes
    unlinked = x @ y.T < cosine
    step = max(1, d // 16)
    known, restx, resty = np.zeros((half, half)), np.ones(half), np.ones(half)
    for k in range(step, min(3 * d // 4, axes.shape[1] + 1), step):
        a, b = x[:, k - step : k], y[:, k - step : k]
        known += a @ b.T
        restx, resty = restx - (a * a).sum(1), resty - (b * b).sum(1)
        if ((known + np.sqrt(np.outer(np.maximum(restx, 0), np.maximum(resty, 0))) >= cosine) & unlinked).sum() <= OPEN * half * half:
            return axes[:, :k]
    return None


def _assign(table: np.ndarray | None, parts: list[np.ndarray]):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            cell, leaf = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, np.int32)
            for rows, y in _units(b, "x"):
                if table is None or table.shape[1] != y.shape[1]:
                    continue
                cell[rows] = np.argmax(y @ table.T, axis=1)
                for k in np.unique(cell[rows]):
                    if len(parts[k]) > 1:
                        own = cell[rows] == k
                        leaf[rows[own]] = np.argmax(y[own] @ parts[k].T, axis=1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("class", "n", "d", "x")), pa.array(cell), pa.array(leaf)], names=["class", "n", "d", "x", "cell", "leaf"])

    return run


PAGE = "page bigint, d int, cells array<int>, reach array<int>, starts array<int>, homes array<int>, class binary, n binary, x binary"


def _pack(table: np.ndarray | None, border: float, kind: str):
    """Rows sorted by length, cell and leaf -> pages. starts and homes: first row and cell of each block, reach: cells its classes
    are at home in or visit."""

    def page(number, d, rows):
        import pyarrow as pa

        ids, n, cell, leaf, x = (np.concatenate(v) for v in zip(*rows, strict=True))
        starts = []
        new = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (leaf[1:] != leaf[:-1])]))
        for lo, hi in zip(new, [*new[1:], len(cell)], strict=True):
            starts += range(lo, hi, math.ceil((hi - lo) / math.ceil((hi - lo) / BLOCK)))
        cells = np.unique(cell)
        reach = np.isin(np.arange(cells[-1] + 1), cells)
        if table is not None and table.shape[1] == d:
            for k in range(0, len(x), BLOCK):
                reach |= visits(normal(x[k : k + BLOCK].astype(float)), cell[k : k + BLOCK], table, border, _slack(d)).any(0)[: len(reach)]
        row = [number, d, cells.tolist(), np.flatnonzero(reach).tolist(), starts, cell[starts].tolist(), ids.tobytes(), n.tobytes(), x.tobytes()]
        kinds = [pa.int64(), pa.int32(), *[pa.list_(pa.int32())] * 4, *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=[c.split()[0] for c in PAGE.split(", ")])

    def run(batches):
        import pyarrow.compute as pc
        from pyspark import TaskContext

        number, d, rows, room = TaskContext.get().partitionId() << 32, None, [], 0
        for b in batches:
            lengths = b.column("d").to_numpy()
            ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            flat = pc.list_flatten(b.column("x")).to_numpy(zero_copy_only=False).astype(kind, copy=False)
            ids, n, cell, leaf = (b.column(c).to_numpy() for c in ("class", "n", "cell", "leaf"))
            new = np.flatnonzero(np.concatenate([[True], lengths[1:] != lengths[:-1]])) if len(lengths) else []
            for lo, hi in zip(new, [*new[1:], len(lengths)], strict=True):
                while lo < hi:
                    if rows and (lengths[lo] != d or not room):
                        yield page(number, d, rows)
                        number, rows = number + 1, []
                    if not rows:
                        d = int(lengths[lo])
                        room = max(1, PAGE_BYTES // (flat.itemsize * d + 16))
                    to = min(hi, lo + room)
                    rows.append((ids[lo:to], n[lo:to], cell[lo:to], leaf[lo:to], flat[ends[lo] : ends[to]].reshape(to - lo, d)))
                    lo, room = to, room - (to - lo)
        if rows:
            yield page(number, d, rows)

    return run


def _slack(d: int) -> float:
    """More than rounding does to a product of unit vectors in single precision."""
    return 1e-6 * (d + 8)


# --- block pairs


class Forest:
    """Labels of nodes, joined by arrays of links."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        lab = self.label
        while True:
            x, y = lab[a], lab[b]
            low = np.minimum(x, y)
            if np.array_equal(x, y):
                return
            # roots of both ends point to the lower one, then every node to its root
            np.minimum.at(lab, x, low)
            np.minimum.at(lab, y, low)
            while True:
                up = lab[lab]
                if np.array_equal(up, lab):
                    break
                lab[:] = up


class Page:
    """A page in a worker: unit vectors in single precision, its blocks and their means."""

    def __init__(self, number: int, d: int, starts: np.ndarray, homes: np.ndarray, ids: bytes, n: bytes, x: bytes, kind: str, axes: np.ndarray | None):
        self.number, self.starts, self.homes = number, starts, homes
        self.ids, self.n = np.frombuffer(ids, np.int64), np.frombuffer(n, np.int64)
        self.x = np.frombuffer(x, kind).reshape(len(self.ids), d)
        self.single = np.concatenate([self.units(slice(k, k + BLOCK)).astype(np.float32) for k in range(0, len(self.x), BLOCK)])
        self.ends = np.append(starts[1:], len(self.x))
        self.means = np.add.reduceat(self.single, starts, axis=0) / (self.ends - starts)[:, None].astype(np.float32)
        self.narrow = None
        if axes is not None and len(axes) == d:
            known = self.single @ axes.astype(np.float32)
            rest = np.sqrt(np.maximum(0.0, 1 - (known * known).sum(1)) + _slack(d))
            self.narrow = np.concatenate([known, rest[:, None]], axis=1)
        self.own = np.concatenate([self.single[lo:hi] @ m for lo, hi, m in zip(starts, self.ends, self.means, strict=True)])

    def units(self, rows) -> np.ndarray:
        return normal(self.x[rows].astype(float))


def _near(p: Page, q: Page, a: np.ndarray, b: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and of b that are linked, by narrowed vectors, then in single precision and in double where that leaves it open."""
    least = cosine - _slack(p.x.shape[1])
    r = c = None
    if p.narrow is not None:
        hit = np.flatnonzero(p.narrow.take(a, 0) @ q.narrow.take(b, 0).T >= least)
        if 64 * len(hit) <= len(a) * len(b):
            r, c = np.divmod(hit, len(b))
            ok = np.einsum("ij,ij->i", p.single.take(a[r], 0), q.single.take(b[c], 0)) >= least
            r, c = r[ok], c[ok]
    if r is None:
        r, c = np.divmod(np.flatnonzero(p.single.take(a, 0) @ q.single.take(b, 0).T >= least), len(b))
    if a is b:
        r, c = r[r < c], c[r < c]
    if not len(r):
        return r, c
    if 8 * len(r) > len(a) * len(b):  # dense: one product in double precision
        ok = (p.units(a) @ q.units(b).T)[r, c] >= cosine
    else:
        ok = np.concatenate([np.einsum("ij,ij->i", p.units(a[r[k : k + 65536]]), q.units(b[c[k : k + 65536]])) for k in range(0, len(r), 65536)]) >= cosine
    return a[r[ok]], b[c[ok]]


def _within(p: Page, lo: int, hi: int, cosine: float, piece: int):
    """Links within a block, in pieces."""
    pieces = [np.arange(k, min(k + piece, hi)) for k in range(lo, hi, piece)]
    for i, a in enumerate(pieces):
        for b in pieces[i:]:
            yield _near(p, p, a, b, cosine)


def _between(p: Page, q: Page, table: np.ndarray | None, border: float, cosine: float, piece: int):
    """Links between two blocks of unlike pages, or between two unlike ones of a page, in pieces."""
    d = p.x.shape[1]
    slack = _slack(d)
    fitted = table is not None and table.shape[1] == d
    far, near = p.single @ q.means.T, q.single @ p.means.T  # of each row along the means of the other page's blocks
    most = [math.sqrt(2 - 2 * cosine) * np.linalg.norm(m.astype(float) - q.means, axis=1) + 4 * slack for m in p.means]
    strip = max(1, piece // 8)
    for i, (lo, hi) in enumerate(zip(p.starts, p.ends, strict=True)):
        for j in range(i + 1 if p is q else 0, len(q.starts)):
            a, b = np.arange(lo, hi), np.arange(q.starts[j], q.ends[j])
            low, high = p.homes[i], q.homes[j]
            if low != high:
                if not fitted:
                    continue
                own = b if high > low else a
                seen = visits_one((q if high > low else p).single[own], table[max(low, high)], table[min(low, high)], border, slack)
                a, b = (a, b[seen]) if high > low else (a[seen], b)
                if not len(own[seen]):
                    continue
            # along the line between the means: a's rows lie low, b's high
            u, v = far[a, j] - p.own[a], q.own[b] - near[b, i]
            keep, kept = u >= v.min() - most[i][j], v <= u.max() + most[i][j]
            a, u, b, v = a[keep], u[keep], b[kept], v[kept]
            if not (len(a) and len(b)):
                continue
            by, to = np.argsort(-u), np.argsort(v)
            a, u, b, v = a[by], u[by], b[to], v[to]
            for k in range(0, len(a), strip):
                end = np.searchsorted(v, u[k] + most[i][j], "right")
                for m in range(0, end, piece):
                    yield _near(p, q, a[k : k + strip], b[m : min(m + piece, end)], cosine)


def visits_one(y: np.ndarray, home: np.ndarray, other: np.ndarray, border: float, slack: float) -> np.ndarray:
    """As ``visits``, of vectors of one home and for one lower-numbered cell."""
    return y @ (home - other).astype(y.dtype) <= border * math.sqrt(max(0.0, 2 - 2 * (home @ other))) + slack


def _linked(p: Page, q: Page, table: np.ndarray | None, border: float, cosine: float, piece: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a pair of pages: classes that are linked, the weight of what each is linked with, the root of each."""
    shift = 0 if p is q else len(p.ids)
    ids, n = (p.ids, p.n) if p is q else (np.concatenate([p.ids, q.ids]), np.concatenate([p.n, q.n]))
    weight, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
    links = [_between(p, q, table, border, cosine, piece)]
    if p is q:
        links += [_within(p, lo, hi, cosine, piece) for lo, hi in zip(p.starts, p.ends, strict=True)]
    held, many = [], 0
    for a, b in (x for found in links for x in found):
        if len(a):
            b = b + shift
            np.add.at(weight, a, n[b])
            np.add.at(weight, b, n[a])
            held.append((a, b))
            many += len(a)
            if many >= FOUND:
                forest.join(*map(np.concatenate, zip(*held, strict=True)))
                held, many = [], 0
    if held:
        forest.join(*map(np.concatenate, zip(*held, strict=True)))
    some = np.flatnonzero(weight)
    return ids[some], weight[some], ids[forest.label[some]]


def _merged(found: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Results of several pairs of pages as one: a row for each class."""
    ids, weight, root = map(np.concatenate, zip(*found, strict=True))
    nodes, at = np.unique(ids, return_inverse=True)
    whole, forest = np.zeros(len(nodes), np.int64), Forest(len(nodes))
    np.add.at(whole, at, weight)
    forest.join(at, np.searchsorted(nodes, root))
    return nodes, whole, nodes[forest.label]


def _products(table: np.ndarray | None, axes: np.ndarray | None, border: float, cosine: float, kind: str):
    """Pairs of pages -> class, weight, root: for each class of a task that is linked there, the weight it is linked with, and a
    spanning forest of the links."""

    def run(batches):
        import pyarrow as pa

        held: dict[int, Page] = {}
        found, many = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                pages = []
                for side in ("a", "b"):
                    of = lambda c, side=side, i=i, batch=batch: batch.column(f"{side}_{c}")[i]
                    number = of("page").as_py()
                    if number not in held:
                        while len(held) > 1 and sum(x.single.nbytes + x.x.nbytes for x in held.values()) > 12 * PAGE_BYTES:
                            held.pop(next(k for k in held if k not in [x.number for x in pages]))
                            give_back()
                        starts, homes = (of(c).values.to_numpy() for c in ("starts", "homes"))
                        held[number] = Page(number, of("d").as_py(), starts, homes, *(of(c).as_py() for c in ("class", "n", "x")), kind, axes)
                    held[number] = held.pop(number)  # the latest stands last
                    pages.append(held[number])
                found.append(_linked(*pages, table, border, cosine, PIECE))
                many += len(found[-1][0])
                if many >= FOUND:
                    found = [_merged(found)]
                    many = 0
        if found:
            ids, weight, root = _merged(found)
            for k in range(0, len(ids), 65536):
                yield pa.RecordBatch.from_arrays([pa.array(v[k : k + 65536]) for v in (ids, weight, root)], names=["class", "weight", "root"])

    return run


def _pairs(pages: DataFrame, classes: int, size: int) -> DataFrame:
    """Every pair of pages of a length that cells or visits bring together, once, and every page with itself. The pages are read
    as they are paired, so nothing is dealt out or stored for it: a task holds some pages of b, and those of a pass by."""
    some = max(6, math.ceil(size / (4 * PAGE_BYTES)))
    parts = {"a": math.ceil(max(TASKS, classes**2 / TASK_PAIRS) / some), "b": some}
    a, b = (pages.select(*(F.col(c).alias(f"{side}_{c}") for c in pages.columns)).coalesce(parts[side]) for side in "ab")
    met = F.arrays_overlap("a_cells", "b_reach") | F.arrays_overlap("b_cells", "a_reach")
    # half of the pairs are in the order of their numbers, the others not: else half of the tasks would have none
    odd = F.pmod(F.xxhash64(F.least("a_page", "b_page"), F.greatest("a_page", "b_page")), F.lit(2)) == 1
    once = F.when(odd, F.col("a_page") <= F.col("b_page")).otherwise(F.col("a_page") >= F.col("b_page"))
    columns = [f"{side}_{c}" for side in "ab" for c in ("page", "d", "starts", "homes", "class", "n", "x")]
    return a.hint("shuffle_replicate_nl").join(b, (F.col("a_d") == F.col("b_d")) & once & met).select(*columns)


# --- the operator


def near_duplicates(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", cosine: float = 0.95, border: float | None = None) -> DataFrame:
    """``vectors`` -> vec_id, n_links, component_id, kept; one row each. ``cosine`` above 0."""
    spark = vectors.sparkSession
    workers(spark)
    if not 0 < cosine <= 1:
        raise ValueError(f"cosine must be in (0, 1], got {cosine}")
    border = math.sqrt(1 - cosine * cosine) if border is None else border
    x = F.col(f"`{column}`")
    single = isinstance(vectors.select(x).schema[0].dataType.elementType, FloatType)
    kind = "float32" if single else "float64"  # single-precision input stays so until it is multiplied
    x = x if single else F.transform(x, lambda v: v.cast("double"))
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    takes = F.coalesce(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite, F.lit(False))
    idle = rows.where(~takes).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    rows = rows.where(takes).withColumns({"h": F.xxhash64("x"), "g": F.xxhash64(F.lit(13), "x")})

    classes = rows.groupBy("h", "g", "x").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = cut(classes.withColumns({"d": F.size("x"), "class": F.monotonically_increasing_id()}), "classes")

    size = classes.groupBy("d").count().agg(F.max(F.struct("count", "d")).alias("top"), F.sum("count").alias("count"), F.sum(F.col("count") * (F.col("d") * np.dtype(kind).itemsize + 16)).alias("bytes")).first()
    dims, table, parts, axes = size.top, None, [], None
    if dims and dims["count"] > CELL:
        wanted = min(MAX_CELLS, math.ceil(dims["count"] / CELL))
        most = max(wanted, min(SAMPLE, SAMPLE_BYTES // (8 * dims.d)))
        # hashes spread evenly: the least ones lie below this, so that not every task sends as many
        below = min(2**63 - 1, int(-(2**63) + 2**64 * min(1.0, (1.2 * most + 200) / dims["count"])))
        sample = classes.where((F.col("d") == dims.d) & (F.col("h") <= below)).select("x", "h").orderBy("h").limit(most).select("x")
        sample = normal(sample.toArrow().column("x").combine_chunks().flatten().to_numpy().reshape(-1, dims.d).astype(float))
        table = centres(sample, wanted)
        parts = leaves(sample, table, dims["count"])
        axes = narrowing(sample, cosine)

    homes = classes.select("class", "n", "d", "x").mapInArrow(tidy(_assign(table, parts)), "class bigint, n bigint, d int, x array<{}>, cell int, leaf int".format("float" if single else "double"))
    spread = max(math.ceil((size["bytes"] or 0) * 4 / 3 / PAGE_BYTES), min(PAGES, math.ceil((size["count"] or 0) / BLOCK)), 1)
    order = ["d", "cell", "leaf"]
    homes = homes.repartitionByRange(spread, *order, F.xxhash64("class")).sortWithinPartitions(*order)
    pages = cut(homes.mapInArrow(tidy(_pack(table, border, kind)), PAGE), "pages")
    found = cut(_pairs(pages, size["count"] or 0, size["bytes"] or 0).mapInArrow(tidy(_products(table, axes, border, cosine, kind)), "class bigint, weight bigint, root bigint"), "found")
    drop_cut(pages)
    labels = connected(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    weights = found.groupBy("class").agg(F.sum("weight").alias("weight"))

    named = classes.select("class", "h", "g", "n", "least").join(weights, "class", "left").join(labels.select(F.col("node").alias("class"), "label"), "class", "left")
    named = cut(named.withColumn("label", F.coalesce("label", "class")), "named")
    drop_cut(classes)
    drop_cut(found)
    firsts = named.groupBy("label").agg(F.min("least").alias("component_id"))
    links = F.col("n") - 1 + F.coalesce("weight", F.lit(0))
    facts = named.join(firsts, "label").select("h", "g", links.alias("n_links"), "component_id")
    out = rows.join(facts, ["h", "g"]).select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return out.union(idle)


# DuckDB SQL of ``near_duplicates(embeddings)``: all pairs.
ORACLE = """
WITH RECURSIVE e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings),
g AS (
  SELECT vec_id, x, sqrt(list_sum(list_transform(x, lambda v: v * v))) AS norm FROM e
  WHERE vec_id IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0
    AND len(list_filter(x, lambda v: v <> 0)) > 0),
link AS (
  SELECT a.vec_id AS p, b.vec_id AS q FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_inner_product(a.x, b.x) >= 0.95 * a.norm * b.norm),
reach AS (SELECT vec_id, vec_id AS r FROM e UNION SELECT reach.vec_id, link.q FROM reach JOIN link ON link.p = reach.r),
c AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT p, count(*) AS n FROM link GROUP BY p)
SELECT c.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM c LEFT JOIN n ON n.p = c.vec_id"""

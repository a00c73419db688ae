r"""Embedding whitening by a bidiagonal qd solver.

1. Each component c becomes the integer x = floor(64 c) + 1,000,000. The fit list
   is each distinct x vector once; its size n and sums S are exact integers.
2. Blockwise QR: each task folds its centred rows into one triangular factor; the
   factors are folded in groups of ``FAN`` until a few are left. No row reaches the driver.
3. Householder reflections turn the last factor R into an upper bidiagonal B.
4. dqds finds the squared singular values of B. Every shift is a Newton bound from
   below (the inverse of the trace of the inverse), so no transform fails but by rounding.
5. The right singular vector of each of the largest values comes from a twisted
   factorisation of B'B - value: stationary from the top, progressive from the bottom, joined where
   the twist is least. Values that lie close together get their vectors made orthogonal.
6. One more pass over the fit list measures the covariance of the whitened rows.

Vectors that are null or hold null or non-finite entries are left out, also from the
result. Vectors of another length than the most frequent one (of equally frequent ones the longest)
are left out too. Entries beyond 2^60 in size are cut to it. ``deviation`` beyond 64 bits is
2^63 - 1. Components whose singular value is zero to working accuracy have no whitened value and
get no rows, so fewer than ``k`` come out where the fit list has a lower rank, and none if it has
one vector or there are no rows. Repeated rows and null ids each get their rows. Other columns are
ignored, whatever their names. The driver and each task hold a few d x d matrices for d dimensions.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, workers

# Parameters.
SCALE, OFFSET = 64, 1_000_000
FAN = 16  # triangular factors or moments that one task folds
BLOCK = 2_048  # rows reduced at once
EPS = float(np.finfo(float).eps)
ENTRY_LIMIT = float(1 << 60)
CLOSE = 1e-3  # relative gap below which vectors are made orthogonal to one another
LONG = (1 << 63) - 1


# --- rows


def quantised(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """vec_id, x: the rows that take part, as integer vectors of one length."""
    c = F.transform(F.col(f"`{column}`"), lambda v: v.cast("double"))
    rows = (
        vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), c.alias("c"))
        .where("c IS NOT NULL")
        .where(F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    )
    inside = lambda v: F.greatest(F.least(v * SCALE, F.lit(ENTRY_LIMIT)), F.lit(-ENTRY_LIMIT))
    rows = rows.select("vec_id", F.transform("c", lambda v: F.floor(inside(v)).cast("long") + OFFSET).alias("x"))
    most = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (most.d if most else 0))


def _matrix(batch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _sums(batches):
    """Exact sums per dimension: halves of 32 bits can't overflow, and Python integers join them."""
    import pyarrow as pa

    total: list[int] = []
    for b in batches:
        x = _matrix(b)
        high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
        here = [(int(h) << 32) + int(w) for h, w in zip(high, low, strict=True)]
        total = [a + h for a, h in zip(total, here, strict=True)] if total else here
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(len(total)), pa.int32()), pa.array([str(t) for t in total], pa.string())], names=["dim", "s"]
    )


class Centre:
    """n and S, as the nearest integers to the means and what is left of each: n x - S = n (x - whole) - rest."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n x - S)^2, exact; beyond 64 bits 2^63 - 1."""
        y = x - self.whole
        top = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if top * top * max(1, x.shape[1]) <= LONG:
            return ((self.n * y - self.rest) ** 2).sum(1)
        exact = self.n * y.astype(object) - self.rest.astype(object)
        return np.array([min(LONG, v) for v in (exact * exact).sum(1)], np.int64)


# --- folding over tasks


def _fold(parts: DataFrame, merge) -> list[bytes]:
    """``parts(part, data)`` merged in groups of ``FAN`` until at most ``FAN`` are left, which the driver takes."""

    def run(pdf):
        import pandas as pd

        out = None
        for d in pdf.sort_values("part")["data"]:
            out = d if out is None else merge(out, d)
        return pd.DataFrame({"part": [int(pdf["part"].min()) // FAN], "data": [out]})

    parts = cut(parts, "parts")
    most = parts.agg(F.max("part")).first()[0] or 0
    while most >= FAN:
        parts = cut(parts.groupBy(F.expr(f"part div {FAN}").alias("g")).applyInPandas(run, "part int, data binary"), "parts")
        most //= FAN
    return [bytes(r.data) for r in parts.orderBy("part").collect()]


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of the rows' QR factors, square."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))]) if len(r) < rows.shape[1] else r


def _reduce(centre: Centre):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        r = None
        for b in batches:
            x = centre.centred(_matrix(b))
            for a in range(0, len(x), BLOCK):
                rows = x[a : a + BLOCK]
                r = _triangle(rows if r is None else np.vstack([r, rows]))
        if r is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([r.tobytes()], pa.binary())], names=["part", "data"])

    return run


def _join_triangles(d: int):
    def merge(a: bytes, b: bytes) -> bytes:
        return _triangle(np.frombuffer(a + b).reshape(-1, d)).tobytes()

    return merge


def _join_moments(a: bytes, b: bytes) -> bytes:
    """Counts, means and centred squares (one row: n, k means, k x k products) of two parts together."""
    x, y = np.frombuffer(a), np.frombuffer(b)
    k = int((math.isqrt(4 * len(x) - 3) - 1) // 2)
    n, delta = x[0] + y[0], y[1 : k + 1] - x[1 : k + 1]
    mean = x[1 : k + 1] + delta * (y[0] / n)
    m2 = x[k + 1 :] + y[k + 1 :] + np.outer(delta, delta).ravel() * (x[0] * y[0] / n)
    return np.concatenate([[n], mean, m2]).tobytes()


def _moments(centre: Centre, w: np.ndarray):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        out = None
        for b in batches:
            v = centre.centred(_matrix(b)) @ w
            mean = v.mean(0)
            one = np.concatenate([[len(v)], mean, ((v - mean).T @ (v - mean)).ravel()]).tobytes()
            out = one if out is None else _join_moments(out, one)
        if out is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([out], pa.binary())], names=["part", "data"])

    return run


# --- the solver


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v, beta with (I - beta v v') x = (-+|x|, 0, ...)."""
    v, norm = x.copy(), float(np.linalg.norm(x))
    if norm == 0 or not np.any(x[1:]):
        return v, 0.0
    v[0] += math.copysign(norm, x[0])
    return v, 2.0 / float(v @ v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a and superdiagonal b of U'RP, and P."""
    a, d = r.astype(float).copy(), r.shape[0]
    p = np.eye(d)
    for k in range(d):
        v, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v, beta = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
            p[:, k + 1 :] -= beta * np.outer(p[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def _transform(q: list[float], e: list[float], shift: float):
    """One dqds step: (q, e) of the next factors, and the d's; None if one of them is negative."""
    d = q[0] - shift
    nq, ne, ds = [], [], [d]
    for i in range(len(e)):
        if d < 0:
            return None
        s = d + e[i]
        t = q[i + 1] / s if s > 0 else 0.0
        nq.append(s)
        ne.append(e[i] * t)
        d = d * t - shift
        ds.append(d)
    if d < 0:
        return None
    nq.append(d)
    return nq, ne, ds


def dqds(q, e) -> list[float]:
    """Eigenvalues of the product of bidiagonal factors with the qd array (q, e), largest first."""
    out: list[float] = []
    tol = (10 * EPS) ** 2
    todo = [(list(map(float, q)), list(map(float, e)), 0.0, 0.0)]
    while todo:
        q, e, moved, lost = todo.pop()  # moved + lost: the shifts so far, as a compensated sum
        while q:
            if len(q) == 1 or e[-1] <= tol * (moved + q[-1]):
                out.append(moved + (lost + q.pop()))
                if e:
                    e.pop()
                continue
            at = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= tol * q[i]), None)
            if at is not None:
                todo.append((q[: at + 1], e[:at], moved, lost))
                q, e = q[at + 1 :], e[at + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:  # graded the other way
                q, e = q[::-1], e[::-1]
            plain = _transform(q, e, 0.0)
            least = min(plain[2])
            # the d's of the plain step are the inverse's diagonal, inverted: their harmonic sum bounds all values from below
            shift = (1 - 8 * EPS * len(q)) / sum(1 / x for x in plain[2]) if least > 0 else 0.0
            step = _transform(q, e, shift) if shift > 0 else plain
            while step is None:  # by rounding only
                shift *= 0.5
                step = _transform(q, e, shift) if shift > EPS * least else plain
                shift = 0.0 if step is plain else shift
            q, e = step[0], step[1]
            new = moved + shift
            lost += shift - (new - moved)
            moved = new
    return sorted(out, reverse=True)


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """Unit right singular vector of the bidiagonal (a, b) for a squared singular value, and the value corrected by its residual."""
    m = len(a)
    tiny = EPS * EPS * float(max(np.max(a * a), np.max(b * b, initial=0.0)))
    d, low = a * a, (b / a[:-1] if m > 1 else np.zeros(0))
    whole = d * 1.0  # D of L D L'
    for _ in range(2):
        up, s = np.zeros(m - 1), np.zeros(m)  # stationary: L+ D+ L+', from the top
        s[0] = -value
        for i in range(m - 1):
            plus = whole[i] + s[i]
            plus = plus if abs(plus) > tiny else math.copysign(tiny, plus or 1.0)
            up[i] = whole[i] * low[i] / plus
            s[i + 1] = up[i] * low[i] * s[i] - value
        down, p = np.zeros(m - 1), np.zeros(m)  # progressive: U- D- U-', from the bottom
        p[m - 1] = whole[m - 1] - value
        for i in range(m - 2, -1, -1):
            minus = whole[i] * low[i] * low[i] + p[i + 1]
            minus = minus if abs(minus) > tiny else math.copysign(tiny, minus or 1.0)
            t = whole[i] / minus
            down[i] = low[i] * t
            p[i] = p[i + 1] * t - value
        gamma = s + p + value
        k = int(np.argmin(np.abs(gamma)))
        z = np.zeros(m)
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -up[i] * z[i + 1]
        for i in range(k, m - 1):
            z[i + 1] = -down[i] * z[i]
        square = float(z @ z)
        correction = gamma[k] / square
        if not abs(correction) > EPS * value:
            break
        value += correction
    return z / math.sqrt(square), value


def directions(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The k largest squared singular values of R (fewer if its rank is lower), their right singular vectors as
    columns, and the sum of all squares."""
    a, b, p = bidiagonal(r)
    d, size = len(a), float(max(np.max(np.abs(a), initial=0.0), np.max(np.abs(b), initial=0.0)))
    if size == 0:
        return np.zeros(0), np.zeros((d, 0)), 0.0
    a = np.where(np.abs(a) < EPS * size, np.copysign(EPS * size, a), a)  # within the rounding of the reduction
    ends = [0, *(np.flatnonzero(np.abs(b) <= EPS * EPS * size) + 1).tolist(), d]  # where B falls apart
    values = []
    for lo, hi in zip(ends, ends[1:], strict=False):
        values += [(v, lo, hi) for v in dqds(a[lo:hi] ** 2, b[lo : hi - 1] ** 2)]
    values.sort(key=lambda x: -x[0])
    whole = math.fsum(v for v, _, _ in values)
    floor = (d * EPS * math.sqrt(values[0][0])) ** 2
    found, columns = [], []
    for v, lo, hi in values[:k]:
        if v <= floor:
            break
        z = np.zeros(d)
        z[lo:hi], v = _twisted(a[lo:hi], b[lo : hi - 1], v)
        for _ in range(2):
            for other, y in zip(found, columns, strict=True):
                if abs(other - v) <= CLOSE * v:
                    z = z - (y @ z) * y
            z = z / np.linalg.norm(z)
        found.append(v)
        columns.append(z)
    return np.array(found), p @ np.array(columns).T.reshape(d, len(columns)), whole


# --- the operator


_OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _project(centre: Centre, w: np.ndarray, explained: np.ndarray, error: float):
    def run(batches):
        import pyarrow as pa

        k = w.shape[1]
        for b in batches:
            x = _matrix(b)
            rows, long = len(x), pa.int64()
            ids = b.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()), pa.array(np.full(rows * k, centre.n), long),
                    pa.array(np.repeat(centre.deviations(x), k), long), pa.array((centre.centred(x) @ w).ravel(), pa.float64()),
                    pa.array(np.tile(explained, rows), pa.float64()), pa.array(np.full(rows * k, error), pa.float64()),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = 16) -> DataFrame:
    """Rows of ``vectors`` times up to ``k`` components: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    workers(spark)
    rows = quantised(vectors, key, column)
    fit = cut(rows.select("x").distinct(), "fit")
    n = fit.count()
    sums = fit.mapInArrow(_sums, "dim int, s string").groupBy("dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums = [int(r.s) for r in sums.orderBy("dim").collect()]  # one row a dimension
    if not sums:
        return spark.createDataFrame([], _OUT)
    d, centre = len(sums), Centre(n, sums)
    left = _fold(fit.mapInArrow(_reduce(centre), "part int, data binary"), _join_triangles(d))
    values, vectors_, whole = directions(_triangle(np.vstack([np.frombuffer(x).reshape(-1, d) for x in left])), k)
    if not len(values):
        return spark.createDataFrame([], _OUT)
    w = vectors_ * np.sqrt(n / values)
    parts = _fold(fit.mapInArrow(_moments(centre, w), "part int, data binary"), _join_moments)
    total = parts[0]
    for x in parts[1:]:
        total = _join_moments(total, x)
    m2 = np.frombuffer(total)[1 + len(values) :].reshape(len(values), -1)
    error = float(np.abs(m2 / n - np.eye(len(values))).max())
    return rows.mapInArrow(_project(centre, w, values / whole, error), _OUT)

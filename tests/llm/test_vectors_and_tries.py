"""Embedding whitening, conversation prefix trie, embedding near-dedup: against plain versions."""

import hashlib
import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import prefix_trie, vector_cells, whitening
from tessera.llm.queries import LLM_QUERIES
from tessera.session import scratch_path

from ..conftest import SF_SMALL

VECTOR = "vec_id bigint, embedding array<double>, x string, n int, d int, class string, label string, y int, home string, cell int, component int, part int, data string"
CLASH = ("x", 1, 2, "c", "l", 3, "h", 4, 5, 6, "d")


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, *CLASH) for i, v in rows], VECTOR)


# --- whitening


def plain_whitening(rows, k=16):
    """{(vec_id, component): ...} by an eigensolver, and n."""
    ok = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in ok})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    centred = lambda x: np.array([(n * a - b) / n for a, b in zip(x, s, strict=True)])
    c = np.array([centred(x) for x in fit])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in ok:
        dev = sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))
        w = centred(x) @ vectors
        out += [(i, j + 1, n, dev, abs(w[j]) / math.sqrt(values[j]), values[j] / values.sum()) for j in range(min(k, d)) if values[j] > 1e-9 * values[0]]
    return sorted(out, key=repr)


def _whitened(df, k=16):
    rows = whitening.whiten(df, k=k).collect()
    assert all(r.identity_error < 1e-9 for r in rows) and len({r.identity_error for r in rows}) <= 1
    return rows, sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in rows), key=repr)


def _close(got, want):
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-8, atol=1e-8)


def test_whitening_odd_rows(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(v) for v in r.normal(size=9) * np.arange(1, 10)]) for i in range(60)]
    odd = [(100, None), (101, [1.0, None] * 4 + [1.0]), (102, [math.nan] * 9), (103, [math.inf] * 9)]
    copies = [(200 + i, rows[0][1]) for i in range(40)] + [(7, rows[1][1]), (None, rows[2][1])]
    df = _vectors(spark, rows + odd + copies)
    short = _vectors(spark, [(300 + i, [0.5 * i] * 4) for i in range(5)])  # another length, fewer rows
    raw, got = _whitened(df.union(short).repartition(5))
    _close(got, plain_whitening(rows + copies))
    # one sign for all rows: equal vectors have equal projections
    assert len({(x.component, x.whitened) for x in raw if x.vec_id is not None and x.vec_id >= 200}) == 9


def test_whitening_folds_many_parts(spark, monkeypatch):
    r = np.random.default_rng(3)
    rows = [(i, [float(v) for v in r.normal(size=20)]) for i in range(300)]
    monkeypatch.setattr(whitening, "FAN", 2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        _, got = _whitened(_vectors(spark, rows).repartition(11))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    _close(got, plain_whitening(rows))


def test_whitening_ranks_ties_and_sizes(spark):
    # rank 2 of 5 dimensions
    rows = [(i, [float(i), 2.0 * i, float(i * i), 0.0, 1.0]) for i in range(12)]
    _, got = _whitened(_vectors(spark, rows))
    assert {g[1] for g in got} == {1, 2} and len(got) == 24
    # entries whose squared deviations exceed 64 bits, and ones beyond the limit
    huge = [(0, [1e16, 0.0]), (1, [-1e16, 1.0]), (2, [3e15, 5.0]), (3, [1e300, 2.0]), (4, [-1e300, 2.0])]
    rows = whitening.whiten(_vectors(spark, huge)).collect()
    assert {r.vec_id for r in rows} == {0, 1, 2, 3, 4} and max(r.deviation for r in rows) == 2**63 - 1
    assert len(whitening.whiten(_vectors(spark, [(0, [1.0]), (1, [2.0]), (1, [2.0])])).collect()) == 3


def test_whitening_without_components(spark):
    assert whitening.whiten(_vectors(spark, [])).collect() == []
    assert whitening.whiten(_vectors(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])).collect() == []
    assert whitening.whiten(_vectors(spark, [(1, []), (2, None)])).collect() == []


@pytest.mark.parametrize("case", ["random", "graded", "equal", "diagonal", "rank", "one column"])
def test_solver_against_lapack(case):
    r = np.random.default_rng(5)
    x = {
        "random": r.normal(size=(200, 40)), "graded": r.normal(size=(60, 12)) * 10.0 ** -np.arange(12), "equal": np.eye(9) * 3,
        "diagonal": np.diag([1.0, 1, 1, 4, 4, 9]), "rank": r.normal(size=(50, 3)) @ r.normal(size=(3, 10)), "one column": r.normal(size=(5, 1)),
    }[case]
    want = np.linalg.svd(x, compute_uv=False)
    values, v, whole = whitening.directions(whitening._triangle(x), 16)
    k = len(values)
    assert np.allclose(np.sqrt(values), want[:k], rtol=1e-8) and np.allclose(v.T @ v, np.eye(k), atol=1e-12)
    assert np.abs(x.T @ (x @ v) - v * values).max() < 1e-13 * want[0] ** 2 * len(want) and math.isclose(whole, (want**2).sum(), rel_tol=1e-12)
    assert k == (3 if case == "rank" else min(16, len(want)))


def test_dqds_small_values_accurate():
    """Small singular values of a bidiagonal to full relative accuracy, against exact rational bisection."""
    from fractions import Fraction

    a, b = [1.0, 1e-3, 1e-6, 1e-9], [1.0, 1e-3, 1e-6]
    found = whitening.dqds([v * v for v in a], [v * v for v in b])

    def below(shift):  # eigenvalues of B'B under the shift, by Sturm counts in exact arithmetic
        n, d = 0, None
        for i in range(4):
            diag = Fraction(a[i]) ** 2 + (Fraction(b[i - 1]) ** 2 if i else 0) - shift
            d = diag if d is None else diag - (Fraction(a[i - 1]) * Fraction(b[i - 1])) ** 2 / d
            n += d < 0
        return n

    for i, v in enumerate(found):  # the (4 - i)-th smallest
        assert below(Fraction(v) * (1 - Fraction(1, 10**13))) <= 3 - i < below(Fraction(v) * (1 + Fraction(1, 10**13)))


# --- prefix trie

TURN = "conv_id bigint, turn bigint, role string, text string, c int, pos int, depth int, p1 int, bytes int, weight int, part string, block int, at int"
EXTRA = (1, 2, 3, 4, 5, 6, "p", 7, 8)


def plain_trie(rows):
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    members = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        full = tuple(turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:])
        for d in range(len(full) + 1):
            members.setdefault(full[:d], []).append((c, len(full) == d))
    saved = {s: (len(m) - 1) * len(s[-1][1].encode()) if s else 0 for s, m in members.items()}
    parents = {s[:-1] for s in members if s}
    out = []
    for s, m in members.items():
        below = [u for u in members if u[: len(s)] == s]
        ends = ",".join(map(str, sorted(c for c, end in m if end)))
        out.append((
            min(c for c, _ in m), len(s), min(c for c, _ in members[s[:-1]]) if s else None, len(m), sum(len(u) == len(s) + 1 for u in below),
            sum(u not in parents for u in below), sum(saved[u] for u in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _trie(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], TURN)
    return sorted((tuple(r) for r in prefix_trie.trie(df.repartition(parts)).select(COLUMNS).collect()), key=repr)


def _turns(r, convs, longest=11):
    texts = ["a", "b", "é", "", "long " * 20]
    return [(c, t, r.choice(["user", "assistant"]), r.choice(texts)) for c in convs for t in range(r.randint(1, longest))]


def test_trie_odd_rows(spark):
    r = random.Random(8)
    rows = _turns(r, [*range(-7, 30), 41, 43, 10**12 + 3])
    rows += [(50, None, None, None), (50, None, None, None), (50, 1, "", ""), (51, 3, "user", "x" * 200_000), (None, 0, "user", "a")]
    rows += [(55, 0, "user", "tie b"), (55, 0, "user", "tie a"), (55, 0, "assistant", "z"), (55, 0, "user", "tie a")]
    rows += [(c, t, "user", "same") for c in range(100, 160) for t in range(12)]  # one large group of equal ones
    rows += [(c, t, "user", "same") for c in range(160, 170) for t in range(c - 150)]  # proper prefixes and extensions of them
    got = _trie(spark, rows)
    assert got == plain_trie(rows)
    assert any(g[1] == 0 and g[2] is None for g in got)


def test_trie_long_conversation_and_end_lists_span_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 4)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    r = random.Random(9)
    rows = [(5, t, "user", r.choice("ab")) for t in range(300)] + [(6, t, "user", "a") for t in range(200)]
    rows += [(c, t, "u", "x") for c in range(1000, 1100) for t in range(2)]  # no more turns than they skip: all but turnless
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _trie(spark, rows, parts=7) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_trie_empty_and_turnless(spark):
    assert _trie(spark, []) == []
    assert _trie(spark, [(None, 1, "a", "b")]) == []
    alone = [(c, 0, "user", "x") for c in range(1, 5)]  # their donor is absent
    assert _trie(spark, alone) == plain_trie(alone)


def test_trie_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = LLM_QUERIES["op12_trie"](spark, SF_SMALL).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == plain_trie(rows)


# --- near-duplicate vectors


def plain_near(rows, cosine=0.95):
    unit = {}
    for k, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v):
            x = np.array(v) / max(abs(c) for c in v)
            unit[k] = x / np.linalg.norm(x)
    linked = {k: [j for j in unit if j != k and len(unit[j]) == len(unit[k]) and unit[k] @ unit[j] >= cosine] for k in unit}
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            new = [j for j in linked.get(todo.pop(), []) if j not in seen]
            seen.update(new)
            todo += new
        first = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((i, len(linked.get(k, [])), first, i == first))
    return sorted(out, key=repr)


def _near(df, **how):
    got = vector_cells.near_duplicates(df, **how).select("vec_id", "n_links", "component_id", "kept").collect()
    return sorted(map(tuple, got), key=repr)


def _groups(r, n, d, copies):
    rows = [(i, [float(v) for v in r.normal(size=d)]) for i in range(n)]
    for base, many, noise in copies:
        x = np.array(rows[base][1])
        x = x / np.linalg.norm(x)
        for _ in range(many):
            rows.append((len(rows), [float(v) for v in x + noise * r.normal(size=d) / math.sqrt(d)]))
    return rows


def test_near_odd_rows(spark):
    r = np.random.default_rng(4)
    rows = _groups(r, 120, 12, [(0, 30, 0.1), (1, 20, 0.3), (2, 40, 0.22)])
    rows += [(500 + i, rows[3][1]) for i in range(25)]  # exact copies
    rows += [(600, [2 * v for v in rows[4][1]]), (601, [1e200 * v for v in rows[4][1]]), (602, [1e-200 * v for v in rows[4][1]])]
    rows += [(700, None), (701, [1.0, None]), (702, [math.nan] * 12), (703, [math.inf] * 12), (704, [0.0] * 12), (705, [])]
    rows += [(None, rows[0][1]), (None, None), (9, rows[5][1]), (9, rows[6][1])]  # no id, one id twice
    rows += [(800, [1.0, 0.0]), (801, [1.0, 0.01]), (802, [-1.0, 0.0]), (803, [-0.0, 5.0])]  # another length
    assert _near(_vectors(spark, rows).repartition(4)) == plain_near(rows)


def test_near_cells_and_blocks_lose_nothing(spark, monkeypatch):
    for name, v in {"CELL": 40, "BLOCK": 16, "PIECE": 5, "SAMPLE": 200}.items():
        monkeypatch.setattr(vector_cells, name, v)
    r = np.random.default_rng(6)
    rows = _groups(r, 500, 8, [(k, 12, 0.25) for k in range(20)] + [(30, 150, 0.2)])
    r.shuffle(rows)
    want = plain_near(rows)
    assert sum(w[1] for w in want) > 5000
    assert _near(_vectors(spark, rows).repartition(6)) == want
    # without visits links across borders are lost, none is made up
    home = _near(_vectors(spark, rows), border=-1.0)
    assert all(h[1] <= w[1] for h, w in zip(home, want, strict=True))


def _stored(spark):
    """Bytes of shuffles and of tables in the scratch folder."""
    dirs = [*spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    dirs.append(os.path.dirname(scratch_path(spark, "x")))
    return sum(os.path.getsize(os.path.join(d, f)) for top in dirs for d, _, files in os.walk(top) for f in files if not f.startswith("broadcast"))


def test_near_disk_follows_the_input(spark, monkeypatch, tmp_dir):
    """Without structure nearly all cells are visited: their visits take no disk, and the links are all found."""
    for name, v in {"CELL": 150, "BLOCK": 64, "SAMPLE": 1000}.items():
        monkeypatch.setattr(vector_cells, name, v)
    r = np.random.default_rng(9)
    x = r.normal(size=(6000, 32)).astype(np.float32)
    x[5000:] = x[:1000] + 0.1 * r.normal(size=(1000, 32))
    spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>").repartition(4).write.parquet(f"{tmp_dir}/in")
    given = sum(os.path.getsize(f"{tmp_dir}/in/{f}") for f in os.listdir(f"{tmp_dir}/in"))
    most, before, cut = 0, _stored(spark), vector_cells.cut

    def measured(*a, **b):
        nonlocal most
        out = cut(*a, **b)
        most = max(most, _stored(spark) - before)
        return out

    monkeypatch.setattr(vector_cells, "cut", measured)
    got = sorted(_near(spark.read.parquet(f"{tmp_dir}/in")))
    y = vector_cells.normal(x.astype(float))
    linked = y @ y.T >= 0.95
    assert [g[1] for g in got] == (linked.sum(1) - 1).tolist() and linked.sum() > 6500
    # a table of classes, one of pages, a shuffle for each of them, and a few columns besides
    print(f"{most} bytes for {given}")
    assert most < 4 * given, f"{most} bytes for {given}"


def test_near_floats_as_doubles(spark, monkeypatch):
    for name, v in {"CELL": 60, "BLOCK": 16, "PIECE": 24, "SAMPLE": 150, "PAGE_BYTES": 3000}.items():
        monkeypatch.setattr(vector_cells, name, v)
    r = np.random.default_rng(10)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in _groups(r, 250, 24, [(k, 9, 0.2) for k in range(10)] + [(40, 60, 0.15)])]
    rows += [(600 + i, rows[3][1]) for i in range(5)] + [(700, rows[4][1][:5]), (701, [2 * c for c in rows[4][1][:5]]), (702, [0.0, -0.0]), (703, None)]
    for cosine in (0.95, 0.3):
        want = plain_near(rows, cosine)
        for kind in ("float", "double"):
            df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").repartition(3)
            assert _near(df, cosine=cosine) == want


def test_narrowed_vectors_bound_products():
    """The few axes and the rest's lengths never fall short of a product; a sample that fills all of them gets none."""
    r = np.random.default_rng(11)
    x = vector_cells.normal(r.normal(size=(3000, 64)) / np.arange(1, 65) ** 0.3)
    axes = vector_cells.narrowing(x, 0.95)
    assert axes.shape[1] < 48 and np.allclose(axes.T @ axes, np.eye(axes.shape[1]))
    assert vector_cells.narrowing(vector_cells.normal(r.normal(size=(500, 2))), 0.95) is None
    rows = x[:300].astype(np.float32)
    page = vector_cells.Page(0, 64, np.array([0, 200]), np.array([0, 1]), np.arange(300).tobytes(), np.ones(300, int).tobytes(), rows.tobytes(), "float32", axes)
    assert (page.narrow @ page.narrow.T >= page.units(slice(None)) @ page.units(slice(None)).T).all()


def test_border_recall_on_random_pairs():
    """A border of four standard deviations of a random direction keeps nearly all links; the exact one keeps all."""
    r = np.random.default_rng(7)
    x = vector_cells.normal(r.normal(size=(4000, 64)))
    y = vector_cells.normal(0.955 * x + math.sqrt(1 - 0.955**2) * vector_cells.normal(r.normal(size=x.shape)))
    ok = np.einsum("ij,ij->i", x, y) >= 0.95
    c = vector_cells.centres(x, 20)

    def recall(border):
        cells = [{}, {}]
        for seen, v in zip(cells, (x, y), strict=True):
            for row, cell, home in zip(*vector_cells.places(v, c, border), strict=True):
                seen.setdefault(row, {})[cell] = home
        both = [any((h or cells[1][i].get(k)) and k in cells[1][i] for k, h in cells[0][i].items()) for i in np.flatnonzero(ok)]
        return np.mean(both)

    exact = math.sqrt(1 - 0.95**2)
    assert recall(exact) == 1.0
    assert recall(exact / 2) > 0.999
    assert recall(-1.0) < 0.9


def test_near_exact_limit(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.8, 0.6]), (3, [0.0, 1.0]), (4, [0.6, 0.8])]
    assert _near(_vectors(spark, rows), cosine=0.96) == plain_near(rows, 0.96)
    with pytest.raises(ValueError):
        vector_cells.near_duplicates(_vectors(spark, rows), cosine=0.0)


def test_near_empty(spark):
    assert _near(_vectors(spark, [])) == []
    assert _near(_vectors(spark, [(1, None)])) == [(1, 0, 1, True)]


def test_queries_return_whole_tables(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    assert LLM_QUERIES["op13_cells"](spark, SF_SMALL).count() == table.count()
    got = LLM_QUERIES["op11_whiten"](spark, SF_SMALL)
    assert got.count() == 16 * table.count()
    want = plain_whitening([tuple(r) for r in table.select("vec_id", F.col("embedding").cast("array<double>")).collect()])
    _close(sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got.collect()), key=repr), want)

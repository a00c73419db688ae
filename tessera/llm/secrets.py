"""Secret scan: base patterns plus a character convolutional network over candidates.

Base findings (three patterns) always stay. Candidates are

* every other token of ``LONG`` characters or more, and shorter ones of
  ``CANDIDATE_MIN`` or more whose characters change between small letters,
  capitals and digits ``MIN_CHANGES`` times or more;
* every token around an access or hex finding that goes on beyond it (a key
  of which the pattern sees one run only).

A small network in numpy reads the characters of a candidate and those around
it, through windows that slide over long ones and overlap by half, and adds
the candidates of which some window's calibrated probability reaches the
threshold.

The network is trained here on labelled findings: what the base patterns find
(positive) and the candidates they don't (negative) in all documents, each
different window once, plus seeded made-up findings of kinds the corpus may lack.
Half of them train, half calibrate: Platt scaling, then the highest threshold that
keeps ``MIN_RECALL`` of the calibration positives. Training goes by rounds: each
partition goes over its findings from the round's network, and the partitions'
networks are averaged, weighed by their findings. Calibration reads the counts of
all held-out findings by score, in steps of ``1 / BINS``.

One map-only pass over whole texts, after one that labels them. Null text
counts as empty: zero counts, the digest of the empty string, no spans.
Repeated rows are scanned separately. With no documents at all the network is
trained on the made-up findings alone.

Texts and tokens may be of any length; every character of a candidate is read. An empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy, workers

# Fixed values of the task: kinds in order, their patterns and least lengths.
KINDS = ["assign", "access", "hex", "cnn"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is maximal, so the shorter ones need not be matched and dropped
MIN_ASSIGN, MIN_ACCESS = 6, 20

# Parameters.
ROUNDS, ROUND_RATE = 6, 1e-3  # over all findings
PART_FINDINGS, MOST_PARTS = 4_000, 256  # findings a partition of a round has at least, and most networks to average
BINS, FAR = 256, 64  # steps a unit of the logit, beyond FAR one step
MADE_UP = 3_000
CANDIDATE_MIN, LONG, MIN_CHANGES = 12, 16, 3
LEFT, BODY, RIGHT = 20, 48, 8  # characters of a window: before, of and after the candidate
STEP = BODY // 2  # of the windows over a candidate longer than BODY
MIN_RECALL = 0.99
MIN_PROBABILITY = 0.5
MASK = "[SECRET]"

TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{%d,}" % CANDIDATE_MIN)
KEY_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+_-")
CHANGE = re.compile(r"[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])")


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end, kind, start of the secret itself), by start, then kind."""
    out = [(m.start(), m.end(), 0, m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    out += [(m.start(), m.end(), 1, m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), m.end(), 2, m.start()) for m in HEX.finditer(text)]
    out.sort()
    return out


def _trimmed(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """[the token without marks at its ends], or [] if it is no candidate."""
    while a < b and text[a] in ".-=_":
        a += 1
    while a < b and text[b - 1] in ".-_/+":
        b -= 1
    if b - a >= LONG or b - a >= CANDIDATE_MIN and len(CHANGE.findall(text, a, b)) >= MIN_CHANGES:
        return [(a, b)]
    return []


def candidates(text: str, base: list[tuple[int, int, int, int]]) -> list[tuple[int, int, bool]]:
    """(start, end, whether it goes around a base finding) of each candidate, from left to right."""
    out: list[tuple[int, int, bool]] = []
    at = 0
    for m in TOKEN.finditer(text):
        a, b = m.span()
        while at < len(base) and base[at][1] <= a:
            at += 1
        if at == len(base) or base[at][0] >= b:
            out += [(x, y, False) for x, y in _trimmed(text, a, b)]
            continue
        # parts of the token that base findings hold, with what goes on beyond them
        parts: list[list[int]] = []
        k = at
        while k < len(base) and base[k][0] < b:
            s, e, kind, _ = base[k]
            k += 1
            if e <= a or parts and e <= parts[-1][1]:
                continue
            x, y = max(a, s), min(b, e)
            if kind:
                low = parts[-1][1] if parts else a
                while x > low and text[x - 1] in KEY_CHARS:
                    x -= 1
                while y < b and text[y] in KEY_CHARS:
                    y += 1
            wider = bool(kind) and (x, y) != (s, e)
            if parts and x <= parts[-1][1]:
                parts[-1][1] = max(y, parts[-1][1])
                parts[-1][2] |= wider
            else:
                parts.append([x, y, wider])
        for x, y, wider in parts:
            out += [(p, q, False) for p, q in _trimmed(text, a, x)]
            if wider:
                out.append((x, y, True))
            a = y
        out += [(p, q, False) for p, q in _trimmed(text, a, b)]
    return out


# --- the network -------------------------------------------------------------------------

# Character classes: each letter, digit and common sign its own, 0 padding, 1 anything else.
_CODE = np.ones(0x180, np.uint8)
for _i, _c in enumerate("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \t\n\"'`:=+-_/.,;()[]{}<>@#$%&*|!?"):
    _CODE[ord(_c)] = _i + 2
N_CODES = int(_CODE.max()) + 1
WIDTH = LEFT + BODY + RIGHT
EMBED, FILTERS, KERNEL, HIDDEN = 8, 24, 5, 16


def windows(text: str, a: int, b: int) -> np.ndarray:
    """Codes of a candidate and its surroundings, a row a window; a candidate shorter than a window is padded."""
    before, after = text[max(0, a - LEFT) : a].rjust(LEFT, "\0"), text[b : b + RIGHT].ljust(RIGHT, "\0")
    points = np.frombuffer((before + text[a:b].ljust(BODY, "\0") + after).encode("utf-32-le"), "<u4")
    codes = _CODE[np.minimum(points, 0x17F)]
    codes[points == 0] = 0
    over = max(0, b - a - BODY)
    return np.lib.stride_tricks.sliding_window_view(codes, WIDTH)[[*range(0, over, STEP), over]]


def _forward(p: dict, x: np.ndarray) -> tuple:
    e = p["embed"][x]  # n, width, embed
    cols = np.lib.stride_tricks.sliding_window_view(e, KERNEL, axis=1)  # n, width', embed, kernel
    cols = cols.reshape(*cols.shape[:2], -1)
    conv = np.maximum(cols @ p["conv"] + p["conv_b"], 0)
    inner = slice(LEFT - KERNEL + 1, LEFT + BODY)
    at_all, at_in = conv.argmax(1), conv[:, inner].argmax(1) + inner.start
    mean = conv[:, inner].mean(1)
    take = lambda at: np.take_along_axis(conv, at[:, None], 1)[:, 0]
    pooled = np.concatenate([take(at_all), take(at_in), mean], 1)
    hidden = np.maximum(pooled @ p["dense"] + p["dense_b"], 0)
    logit = hidden @ p["out"] + p["out_b"]
    return cols, conv, inner, at_all, at_in, pooled, hidden, logit


def logits(p: dict, x: np.ndarray) -> np.ndarray:
    out = [_forward(p, x[i : i + 512])[-1] for i in range(0, len(x), 512)]
    return np.concatenate(out) if out else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7, epochs: int = 12, batch: int = 64, rate: float = 3e-3, start: dict | None = None) -> dict:
    """Adam on the logistic loss, from a network or anew; same data, same network."""
    r = np.random.default_rng(seed)
    p = start or {
        "embed": r.normal(0, 0.3, (N_CODES, EMBED)),
        "conv": r.normal(0, 0.2, (EMBED * KERNEL, FILTERS)),
        "conv_b": np.zeros(FILTERS),
        "dense": r.normal(0, 0.2, (3 * FILTERS, HIDDEN)),
        "dense_b": np.zeros(HIDDEN),
        "out": r.normal(0, 0.2, HIDDEN),
        "out_b": np.zeros(()),
    }
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    t = 0
    for _ in range(epochs):
        order = r.permutation(len(x))
        for i in range(0, len(x), batch):
            rows = order[i : i + batch]
            xb, n = x[rows], len(rows)
            cols, conv, inner, at_all, at_in, pooled, hidden, z = _forward(p, xb)
            dz = (1 / (1 + np.exp(-z)) - y[rows]) / n
            g = {"out": hidden.T @ dz, "out_b": dz.sum()}
            dh = dz[:, None] * p["out"] * (hidden > 0)
            g["dense"], g["dense_b"] = pooled.T @ dh, dh.sum(0)
            dp = dh @ p["dense"].T
            dconv = np.zeros_like(conv)
            k = np.arange(FILTERS)[None]
            rr = np.arange(n)[:, None]
            np.add.at(dconv, (rr, at_all, k), dp[:, :FILTERS])
            np.add.at(dconv, (rr, at_in, k), dp[:, FILTERS : 2 * FILTERS])
            dconv[:, inner] += dp[:, None, 2 * FILTERS :] / (inner.stop - inner.start)
            dconv *= conv > 0
            g["conv"] = np.tensordot(cols, dconv, ((0, 1), (0, 1)))
            g["conv_b"] = dconv.sum((0, 1))
            dcols = (dconv @ p["conv"].T).reshape(*dconv.shape[:2], EMBED, KERNEL)
            de = np.zeros((n, xb.shape[1], EMBED))
            for j in range(KERNEL):
                de[:, j : j + dcols.shape[1]] += dcols[..., j]
            g["embed"] = np.zeros_like(p["embed"])
            np.add.at(g["embed"], xb, de)
            t += 1
            for name, grad in g.items():
                m[name] = 0.9 * m[name] + 0.1 * grad
                v2[name] = 0.999 * v2[name] + 0.001 * grad**2
                p[name] = p[name] - rate * (m[name] / (1 - 0.9**t)) / (np.sqrt(v2[name] / (1 - 0.999**t)) + 1e-8)
    return p


def calibrate(z: np.ndarray, y: np.ndarray, recall: float = MIN_RECALL, n: np.ndarray | None = None, low: np.ndarray | None = None) -> tuple[float, float, float]:
    """Platt scaling (slope, offset) and the highest threshold that keeps ``recall`` of the positives,
    no lower than ``MIN_PROBABILITY`` where the classes are that well apart. An entry may stand for ``n``
    findings around ``z``, from ``low``."""
    n = np.ones(len(z)) if n is None else n
    low = z if low is None else low
    a, b = 1.0, 0.0
    pos, neg = max(1, int((n * y).sum())), max(1, int((n * (1 - y)).sum()))
    soft = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))

    def loss(a: float, b: float) -> float:
        t = a * z + b
        return float((n * (np.logaddexp(0, t) - soft * t)).sum() + 5e-4 * (a - 1) ** 2)

    for _ in range(50):  # Newton steps, halved while they don't lead down
        q = 1 / (1 + np.exp(-(a * z + b)))
        w = n * (q * (1 - q) + 1e-9)
        off = n * (q - soft)
        grad = np.array([(off * z).sum() + 1e-3 * (a - 1), off.sum()])
        hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum()]])
        step = np.linalg.solve(hess + 1e-6 * np.eye(2), grad)
        for _ in range(40):
            if loss(a - step[0], b - step[1]) <= loss(a, b):
                break
            step = step / 2
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    q = 1 / (1 + np.exp(-(a * low[y > 0] + b)))
    order = np.argsort(q, kind="stable")
    upto = np.cumsum(n[y > 0][order])
    lowest = q[order][np.searchsorted(upto, np.floor((1 - recall) * upto[-1]), side="right")] if len(q) else MIN_PROBABILITY
    return float(a), float(b), float(min(lowest, MIN_PROBABILITY))


def made_up_findings(n: int = MADE_UP, seed: int = 11) -> list[tuple[str, int, int, int]]:
    """Seeded (text, start, end, label): keys in usual shapes, and tokens that only look long."""
    r = np.random.default_rng(seed)
    low, up, dig = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    pick = lambda s, k: "".join(s[i] for i in r.integers(0, len(s), k))
    some = lambda xs: xs[int(r.integers(0, len(xs)))]
    spoken = lambda: "".join(some("bcdfghlmnprstvw") + some(["a", "e", "i", "o", "u", "en", "er", "ion"]) for _ in range(int(r.integers(1, 5))))
    word = lambda: spoken() if r.random() < 0.7 else pick(low, int(r.integers(2, 9)))
    number = lambda k: pick(dig, k)
    keys = [
        lambda: pick(low + up + dig, int(r.integers(CANDIDATE_MIN, 64))),
        lambda: pick(low + up, int(r.integers(LONG, 64))),
        lambda: pick(low + up + dig, int(r.integers(64, 200))),
        lambda: pick(low + dig, int(r.integers(LONG, 48))),
        lambda: pick(low + up + dig + "+/", int(r.integers(20, 60))) + some(["", "=", "=="]),
        lambda: some(["sk_live_", "sk_test_", "ghp_", "xoxb-", "pk_", "glpat-", "key-"]) + pick(low + up + dig, int(r.integers(20, 40))),
        lambda: pick(dig + "abcdef", int(r.integers(16, 24))),
        lambda: pick(dig + "ABCDEF", int(r.integers(24, 65))),
        lambda: "eyJ" + pick(low + up + dig, 20) + "." + pick(low + up + dig, 30) + "." + pick(low + up + dig + "-_", 30),
        lambda: pick(up + dig, int(r.integers(16, 40))),
    ]
    plain = [
        lambda: f"{word()}-{word()}-{number(2)}-{word()}",
        lambda: f"{word()}_{word()}_{word()}{number(1)}",
        lambda: f"{word()}/{word()}/{word()}.{some(['html', 'png', 'mp4', 'py'])}{number(1)}",
        lambda: f"{number(4)}-{number(2)}-{number(2)}T{number(2)}",
        lambda: f"www.{word()}{number(1)}.{word()}.example.com",
        lambda: f"{word()}{number(2)}.{word()}.{word()}.org",
        lambda: f"v{number(1)}.{number(2)}.{number(1)}-{word()}-{word()}",
        lambda: f"{number(4)}-{number(4)}-{number(4)}x{number(3)}",
        lambda: word() + word() + word() + number(2),
        lambda: word().title() + word().title() + word().title() + number(1),
        lambda: word() + "".join(spoken().title() for _ in range(int(r.integers(2, 6)))),
        lambda: "".join(spoken() for _ in range(int(r.integers(3, 8)))),
        lambda: "".join(spoken() for _ in range(int(r.integers(3, 8)))).title(),
        lambda: "".join(spoken() for _ in range(int(r.integers(3, 8)))).upper(),
        lambda: some(["_", "-", ".", "/"]).join(spoken() for _ in range(int(r.integers(3, 30)))),
        lambda: "_".join(spoken().upper() for _ in range(int(r.integers(2, 6)))),
        lambda: some(["", "-", "."]).join(number(int(r.integers(2, 5))) for _ in range(int(r.integers(4, 7)))),
    ]
    before = ["key: ", "token = ", "Authorization: Bearer ", "export SECRET_", "credentials ", "auth="]
    out = []
    for i in range(n):
        label = i % 2
        body = ""
        while len(body) < CANDIDATE_MIN:
            body = (some(keys) if label else some(plain))()
        # most surroundings are prose on both sides, so the characters of the token decide
        left = f"{word()} {word()} " + (some(before) if r.random() < (0.5 if label else 0.05) else "")
        left += some(["", "", '"', "'", "("])
        text = f"{left}{body}{some([' ', '. ', ', ', chr(34) + ' ', chr(10)])}{word()} {word()}"
        out.append((text, len(left), len(left) + len(body), label))
    return out


def _labelled(batches):
    import pandas as pd

    for b in batches:
        rows = []
        for text in b["text"]:
            base = base_spans(text)
            spans = [(s, e, 1) for _, e, _, s in base] + [(s, e, 0) for s, e, around in candidates(text, base) if not around]
            rows += [(w.tobytes(), y) for s, e, y in spans for w in windows(text, s, e)]
        yield pd.DataFrame(rows, columns=["codes", "label"])


def _codes(b) -> np.ndarray:
    return np.frombuffer(b"".join(b["codes"]), np.uint8).reshape(-1, WIDTH)


def _round(net: dict, made: tuple[np.ndarray, np.ndarray], seed: int):
    """One pass over a partition's findings, with the made-up ones to each batch: (findings, its network)."""

    def run(batches):
        import pickle

        import pandas as pd

        p, n = net, 0
        for b in batches:
            x, y = np.concatenate([_codes(b), made[0]]), np.concatenate([b["label"].to_numpy(float), made[1]])
            p = fit(x, y, seed=seed, epochs=1, rate=ROUND_RATE, start=p)
            n += len(b)
        if n:
            yield pd.DataFrame({"n": [n], "net": [pickle.dumps(p)]})

    return run


def _scored(net: dict):
    def run(batches):
        import pandas as pd

        for b in batches:
            yield pd.DataFrame({"z": logits(net, _codes(b)), "label": b["label"]})

    return run


def train(docs: DataFrame) -> dict:
    """The network, its calibration and threshold, from the findings of all ``docs``."""
    import pickle

    from ..session import scratch_path

    spark = docs.sparkSession
    workers(spark)
    path = scratch_path(spark, "findings")
    part = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    found = part.mapInPandas(tidy(_labelled), "codes binary, label int").dropDuplicates()
    found.withColumn("held_out", F.xxhash64("codes") % 2 != 0).write.parquet(path)
    rows = spark.read.schema("codes binary, label int, held_out boolean").parquet(path)
    learned, held = rows.where("NOT held_out").drop("held_out"), rows.where("held_out").drop("held_out")

    made = made_up_findings()
    read = [windows(t, a, b) for t, a, b, _ in made]
    x = np.concatenate(read)
    y = np.array([m[3] for m, w in zip(made, read, strict=True) for _ in w], float)
    order = np.random.default_rng(5).permutation(len(x))
    x, y = x[order], y[order]
    half = len(x) // 2
    net = fit(x[:half], y[:half])

    parts = min(MOST_PARTS, max(1, learned.count() // PART_FINDINGS))
    dealt = learned.repartition(parts, "codes", "label").sortWithinPartitions(F.xxhash64("codes", "label"), "codes", "label")
    for k in range(ROUNDS):
        nets = [(r.n, pickle.loads(r.net)) for r in dealt.mapInPandas(tidy(_round(net, (x[:half], y[:half]), k)), "n bigint, net binary").collect()]
        if not nets:
            break
        nets.sort(key=lambda e: (e[0], e[1]["out"].tolist()))  # the same sum, whichever task ends first
        total = sum(n for n, _ in nets)
        net = {name: sum(p[name] * (n / total) for n, p in nets) for name in net}

    step = F.floor(F.greatest(F.least("z", F.lit(float(FAR))), F.lit(-float(FAR))) * BINS)
    z = held.mapInPandas(tidy(_scored(net)), "z double, label int")
    bins = z.groupBy(step.alias("step"), "label").agg(F.count(F.lit(1)).alias("n"), F.avg("z").alias("z"), F.min("z").alias("low")).collect()
    own = logits(net, x[half:])
    also = lambda name, mine: np.concatenate([mine, np.array([r[name] for r in bins], float)])
    a, b, cut = calibrate(also("z", own), also("label", y[half:]), n=also("n", np.ones(len(own))), low=also("low", own))
    return {"net": {k: np.asarray(v, np.float32) for k, v in net.items()}, "slope": a, "offset": b, "threshold": cut}


def probabilities(asked: list[tuple[str, int, int]], model: dict) -> np.ndarray:
    """Calibrated probability of each (text, start, end): that of its highest window."""
    if not asked:
        return np.zeros(0)
    out, group, n = [], [], 0
    for k, (text, a, b) in enumerate(asked):
        group.append(windows(text, a, b))
        n += len(group[-1])
        if n >= 8192 or k == len(asked) - 1:
            z = logits(model["net"], np.concatenate(group))
            out.append(np.maximum.reduceat(z, np.cumsum([0, *map(len, group[:-1])])))
            group, n = [], 0
    return 1 / (1 + np.exp(-(model["slope"] * np.concatenate(out) + model["offset"])))


def find(texts: list[str], model: dict) -> list[list[tuple[int, int, int, int]]]:
    """All spans of each text: base ones, and the candidates the network takes."""
    spans = [base_spans(t) for t in texts]
    asked = [(i, a, b) for i, t in enumerate(texts) for a, b, _ in candidates(t, spans[i])]
    q = probabilities([(texts[i], a, b) for i, a, b in asked], model)
    for (i, a, b), p in zip(asked, q.tolist(), strict=True):
        if p >= model["threshold"]:
            spans[i].append((a, b, 3, a))
    for i in {i for i, _, _ in asked}:
        spans[i].sort()
    return spans


def _said(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k, _ in spans)


def scan(docs: DataFrame, model: dict) -> DataFrame:
    """``docs(doc_id, text)`` -> counts and digest of the base findings, and all spans."""
    workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pandas as pd

        for b in batches:
            rows = []
            for doc_id, own in zip(b["doc_id"], find(list(b["text"]), model), strict=True):
                base = [s for s in own if s[2] < 3]
                n = [sum(s[2] == k for s in base) for k in range(3)]
                rows.append((doc_id, *n, hashlib.sha256(_said(base).encode()).hexdigest(), _said(own)))
            out = pd.DataFrame(rows, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            out["doc_id"] = b["doc_id"].to_numpy()
            yield out

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        tidy(run), f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )


def masked(text: str, spans: list[tuple[int, int, int, int]]) -> str:
    """``text`` with each secret (of an assignment: its value) replaced by ``MASK``."""
    out, at = [], 0
    for a, b in sorted((s[3], s[1]) for s in spans):
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced; all columns and rows stay, null text stays null."""
    workers(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = b.column("text").to_pylist()
            spans = find([t or "" for t in texts], model)
            new = [masked(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
            at = b.schema.get_field_index("text")
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

    return docs.mapInArrow(tidy(run), docs.schema)

"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import math
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def substrings(docs, n=13):
    """(doc_id, n_words, n_removed, kept_sha256) per row; rows without an id lose nothing."""
    least = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            if d is not None:
                least[k] = min(least.get(k, d), d)
    out = []
    for d, t in docs:
        w = words(t)
        gone = set()
        for i in range(len(w) - n + 1):
            if d is not None and least[tuple(w[i : i + n])] < d:
                gone.update(range(i, i + n))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def shingles(text, n):
    w = words(lower(text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def near_components(docs, n=4, percent=80):
    """(doc_id, n_shingles, component_id, kept) per row, ids all given."""
    sets = [(d, shingles(t, n)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for g in s:
            holders[g].append(i)
    pairs = {(i, j) for h in holders.values() for i in h for j in h if i < j}
    for i, j in pairs:
        (d, a), (e, b) = sets[i], sets[j]
        if 100 * len(a & b) >= percent * len(a | b):
            x, y = root(d), root(e)
            parent[max(x, y)] = min(x, y)
    return [(d, len(s), root(d), root(d) == d) for d, s in sets]


ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(out)]


def said(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def top_k(vectors, k=10):
    """(query_id, rank, vec_id, score) over (id, list) pairs with scale 1024."""
    good = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in vectors
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    asked = {}
    for i, v in good:
        if i % 100 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        s = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v))
        out += [(q, r, i, -x) for r, (x, i) in enumerate(s[:k], 1)]
    return sorted(out)


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    covered = {j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    n, r = len(w), len(covered)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n)


def targets(sizes, weights, total, most=2):
    """Share by weight, cap, reshare the excess, until none is above."""
    out = [0.0] * len(sizes)
    free, left = set(range(len(sizes))), float(total)
    while free and left > 0:
        w = sum(weights[i] for i in free)
        level = {i: left * weights[i] / w for i in free}
        over = {i for i in free if level[i] > most * sizes[i]}
        if not over:
            for i in free:
                out[i] = level[i]
            break
        for i in over:
            out[i] = most * sizes[i]
            left -= out[i]
        free -= over
    return out

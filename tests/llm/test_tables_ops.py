"""Operators on embeddings, pages, conversations and labels, and the pipeline."""

import math
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import chat_tree, quality_knn, topk, wrappers
from tessera.llm.queries import LLM_ORACLE, LLM_QUERIES

from ..conftest import SF_MID, SF_SMALL
from . import brute


def _sorted(rows):
    return sorted(map(tuple, rows), key=repr)


# --- top-k

VECTOR = "vec_id bigint, embedding array<double>, score double, rank int, id string, q string"


def _top(df, k=10):
    v = topk.quantised(df, "vec_id", "embedding", 1024)
    return _sorted(topk.top_k(v.where("id % 100 = 0"), v, k).select("query_id", "rank", "vec_id", "score").collect())


def _vectors():
    r = np.random.default_rng(9)
    rows = [(i, [float(x) for x in r.normal(size=6)]) for i in range(230)]
    rows += [(i, [0.5] * 6) for i in range(300, 420)]  # many ties, some of them queries
    rows += [(500, None), (501, [1.0, None] * 3), (502, [math.nan] * 6), (503, [math.inf] * 6), (None, [1.0] * 6)]
    rows += [(600, [0.25] * 4), (601, [0.25] * 4), (700, [1e9] * 6), (701, [-1e9] * 6), (900, []), (901, [])]
    rows += [(42, [0.1] * 6), (43, [0.3] * 6)]  # ids again
    return rows


def test_topk_odd_rows(spark, monkeypatch):
    rows = _vectors()
    df = spark.createDataFrame([(i, v, 0.5, 1, "i", "q") for i, v in rows], VECTOR)
    want = brute.top_k(rows)
    assert _top(df) == _sorted(want)
    monkeypatch.setattr(topk, "PAGE", 2)  # several pages of queries
    monkeypatch.setattr(topk, "BINS", 5)
    monkeypatch.setattr(topk, "BLOCK", 7)
    assert _top(df.repartition(7)) == _sorted(want)


def test_topk_empty(spark):
    assert _top(spark.createDataFrame([], VECTOR)) == []
    assert _top(spark.createDataFrame([(100, [1.0], 0.5, 1, "i", "q")], VECTOR)) == []


def test_topk_saturates(spark):
    df = spark.createDataFrame([(0, [1e200]), (1, [1e200]), (2, [-1e200]), (3, [1.0])], "vec_id bigint, embedding array<double>")
    got = _top(df)
    assert [r[2] for r in got] == [1, 3, 2] and got[0][3] > 0 > got[2][3]


# --- wrappers


def _text(spark, *htmls, urls=None):
    rows = [(i, urls[i] if urls else "http://h.example/x", h, 1, "host", "w", "k") for i, h in enumerate(htmls)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, salt int, host string, wrapper string, kinds string")
    return [r.text for r in wrappers.extract(df).orderBy("page_id").collect()]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy</div>
<div id="cookie-notice">We use</div><article class="post"><header><h2>Title &amp; more</h2><p>by me</p></header>
<p><b>One <span class="ad">buy</span>two<br><p>three &lt;p&gt; &eacute;&#233;\n\t x</p><ul><li>i<li>j</ul><table><tr><td>c<td>d</table>
<section class="comments"><article class="comment"><p>reader</p></article></section></article><aside>side</aside>
<form><p>mail</p><textarea>t</textarea></form><footer>&copy; foot"""


def test_wrapper_page(spark):
    assert _text(spark, PAGE) == ["Title & more\nOne two\nthree <p> éé x\ni\nj\nc\nd"]


def test_wrapper_odd_pages(spark):
    long = "<article>" + "<p>word</p>" * 5000 + "</article>"
    got = _text(
        spark, None, "", "plain text", "<article><p>cut off", "<p", "<article></article>", long, PAGE, PAGE, "a < b & c",
        urls=["http://h/1", None, "", "no url", "http://h/2", "http://h/3", "http://h/4", "HTTP://H/5", "http://h/6", None],
    )
    assert got[:6] == ["", "", "plain text", "cut off", "", ""] and got[6] == "\n".join(["word"] * 5000)
    assert got[7] == got[8] != "" and got[9] == "a < b & c"


def test_wrapper_attributes(spark):
    """Only an element's own class, id, role and hiding count, not what other attributes say."""
    page = (
        "<article><p title='hidden gem' data-role='banner'>a</p><p hidden>b</p><p style='display: none'>c</p><p CLASS=comment>d</p>"
        "<p data-x=\"class='ad'\">e</p><div role=\"search\"><p>f</p></div><p id='menu-1'>g</p><p aria-hidden=\"false\">h</p></article>"
    )
    assert _text(spark, page) == ["a\ne\nh"]


def test_wrapper_without_article(spark):
    """The container of most varying text is the main text; what reads the same on every page is not."""
    pages = [
        f"<body><div class='top'>Our site</div><div class='box'><h2>Head {i}</h2><p>{'word ' * 20}{i}</p><p>more {i}</p></div>"
        f"<div class='links'><a>x{i}</a></div><div class='footer'>f {i}</div></body>"
        for i in range(4)
    ]
    assert _text(spark, *pages)[2] == f"Head 2\n{'word ' * 20}2\nmore 2"


def test_wrapper_keeps_text_in_odd_company(spark):
    """Names that only contain an outside word, words around most of a page's text, and foreign elements lose no text."""
    around = ["layout has-sidebar", "no-sidebar", "header-fixed", "ad-free", "social", "login", "post-header"]
    pages = [f"<body><p>top</p><div class='{c}'><article><h1>T</h1><p>text {c}</p><div class='share'>Share</div></article></div></body>" for c in around]
    assert _text(spark, *pages) == [f"T\ntext {c}" for c in around]
    outside = ["sidebar", "left-sidebar", "site-header", "cookie-notice", "post-comments", "ad-300x250", "footer__links", "nav2"]
    pages = [f"<article><p>some text</p><div class='{c}'><p>x</p></div></article>" for c in outside]
    assert _text(spark, *pages) == ["some text"] * len(outside)
    foreign = ["<svg width='1'/>", "<svg viewBox='0 0 1 1' />", "<math/>", "<svg><path>", "<svg><text>x</text></svg>"]
    assert _text(spark, *[f"<article><p>a {f} b</p><p>{i}</p></article>" for i, f in enumerate(foreign)]) == [f"a b\n{i}" for i in range(len(foreign))]
    heads = ["<header class='entry-header'>", "<header class='header'><div>", "<header id='h'><hgroup>"]
    assert _text(spark, *[f"<article>{h}<h1>T</h1><p>by me</p></header><p>{i}</p></article>" for i, h in enumerate(heads)]) == [f"T\n{i}" for i in range(len(heads))]


def test_wrapper_container_is_a_common_ancestor(spark):
    """Text dealt over several sections of one box is taken whole."""
    pages = [
        f"<body><div class='box'><div class='a'><p>{'one ' * 30}{i}</p></div><div class='b'><p>{'two ' * 20}{i}</p></div></div><div class='links'>x{i}</div></body>"
        for i in range(4)
    ]
    assert _text(spark, *pages)[2] == f"{'one ' * 30}2\n{'two ' * 20}2"


def test_wrapper_template_text_of_an_article(spark):
    """What reads the same on every page of a host is not main text, in an article or the main element either."""
    pages = [f"<{e}><h1>Head {i}</h1><p>text {i}</p><p class='more'>Read more on our site</p></{e}>" for e in ("article", "main") for i in range(3)]
    urls = [f"http://{h}/{i}" for h in ("a", "m") for i in range(3)]
    assert _text(spark, *pages, urls=urls) == [f"Head {i}\ntext {i}" for i in range(3)] * 2
    # so do the headings of near copies, and an article of nothing else
    assert _text(spark, *[f"<article><h1>Head</h1><p>{i}</p></article>" for i in range(4)])[1] == "Head\n1"
    assert _text(spark, *["<article><h1>H</h1><p>same</p></article>"] * 4) == ["H\nsame"] * 4
    # copies of one page among others are no template
    copies = ["<article><p class='lead'>same</p><p>text</p></article>"] * 4 + [f"<article><p>{i}</p></article>" for i in range(3)]
    assert _text(spark, *copies) == ["same\ntext"] * 4 + ["0", "1", "2"]


def test_wrapper_alignment():
    def wrapper(*streams):
        shape = None
        seen = {}
        for s in streams:
            shape = wrappers.learn(shape, seen, [(tuple(s), [(x, x) for x in s])])
        return shape

    symbols, optional, group = wrapper("apppf", "apf", "ahpf")
    assert symbols == ["a", "h", "p", "f"] and optional == [False, True, False, False]
    assert group[2] >= 0 and group[0] == group[3] == -1
    symbols, optional, group = wrapper("adtdtf")  # (dt)+
    assert symbols == ["a", "d", "t", "f"] and group[1] == group[2] >= 0 and not any(optional)
    symbols, optional, group = wrapper("ab", "ba")  # order differs: a repeated group of optional slots
    assert sorted(symbols) == ["a", "b"] and all(g >= 0 for g in group if g != -1)
    for streams in (["apppf", "apf"], ["ab", "ba"], ["abcabd", "axb"]):
        s, _, _ = wrapper(*streams)
        assert len(s) == len(set(s)) and set(s) == set("".join(streams))


def test_wrapper_symbols_do_not_count_pages():
    """Generated ids and classes share a symbol, so a host's wrapper doesn't grow with its pages."""
    seen = {}
    pages = [wrappers.read(f"<div id='post-{i}' class='c{i}x{i * 7919:x} body'><p>t {i}</p></div>") for i in range(1, 50)]
    shape = wrappers.learn(None, seen, pages)
    assert len(shape[0]) == 1 and seen[shape[0][0]][0] == 49


def test_wrapper_size_does_not_grow_with_names(spark, monkeypatch):
    """Names and paths of single pages share symbols; the text stays, also where nothing is broadcast."""
    word = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    page = lambda i: (
        f"<body><div class='top'>Our site</div><div class='box'><div id='post-{word(i)}' class='tag-{word(7 * i)} body'>"
        f"<p>text {i}</p>{'<div>' * (i % 7)}<blockquote class='by-{word(i)}'>said {i}</blockquote></div></div></body>"
    )
    rows = [(i, "http://h/x" if i % 3 else f"http://{i % 4}/x", page(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(8)
    wrapper = wrappers.infer(df.selectExpr("'h' AS host", "html"))[0].collect()
    assert len(wrapper) == 1 and len(wrappers.json.loads(wrapper[0].wrapper)["shape"][0]) < 20
    want = [f"text {i}\nsaid {i}" for i in range(300)]
    assert [r.text for r in wrappers.extract(df).orderBy("page_id").collect()] == want
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(wrappers, "FAN_IN", 2)
    assert [r.text for r in wrappers.extract(df).orderBy("page_id").collect()] == want
    monkeypatch.setattr(wrappers, "MAX_SYMBOLS", 2)  # paths beyond the limit stand under what is known of them
    assert all(f"text {i}\nsaid {i}" in r.text for i, r in enumerate(wrappers.extract(df).orderBy("page_id").collect()))


def test_wrapper_merge_is_order_free():
    r = random.Random(3)
    streams = ["".join(r.choice("nahpf") for _ in range(r.randint(1, 9))) for _ in range(12)]

    def part(some):
        seen = {}
        shape = wrappers.learn(None, seen, [(tuple(s), [(f"html/{x}", x) for x in s]) for s in some])
        return {"shape": shape, "seen": seen}

    whole = wrappers.merge([part(streams)])
    split = wrappers.merge([wrappers.merge([part(streams[6:])]), wrappers.merge([part(streams[:3]), part(streams[3:6])])])
    assert set(whole["shape"][0]) == set(split["shape"][0]) and whole["seen"] == split["seen"]


def test_wrapper_empty(spark):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert wrappers.extract(df).collect() == []


# --- chat trees

TURNS = "conv_id bigint, turn bigint, role string, text string, path string, node string, pid int, all int"


def _conversations():
    first = ("user", "Hello ### there </turn> \\ ok")
    rows = []
    for c in range(40):
        turns = [first, ("assistant", f"a{c % 3}"), ("user", f"b{c % 5}"), ("assistant", "### assistant: x</turn>\n")][: 2 + c % 3]
        rows += [(c, t, r, x) for t, (r, x) in enumerate(turns)]
    rows += [(100, 0, "user", None), (100, 1, None, "x"), (100, None, "system", ""), (101, 0, "user", "é🎉" * 4000), (101, 0, "user", "é🎉" * 4000)]
    rows += [(102, 1, "assistant", "z"), (102, 0, "a: b", "y"), (None, 0, "user", "lost"), (103, 5, "assistant", "<"), (103, 6, "assistant", "### ")]
    return rows


def _chat_brute(rows):
    out, by = [], {}
    for c, t, r, x in rows:
        if c is not None:
            by.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        chars = sum(len(chat_tree.segment(r, x)[0]) for _, r, x in turns)
        out.append((c, len(turns), brute.sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), brute.sha(loss), chars))
    return _sorted(out)


@pytest.mark.parametrize("parts", [1, 8, 40])
def test_chat_odd_rows(spark, parts):
    rows = _conversations()
    df = spark.createDataFrame([(*r, "p", "n", 1, 1) for r in rows], TURNS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        nodes, paths, members = chat_tree.pack(df)
        assert _sorted(chat_tree.read_back(nodes, paths, members).collect()) == _chat_brute(rows)
        _check_packing([n.asDict(recursive=True) for n in nodes.collect()], paths.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _check_packing(nodes, paths):
    """Tokens once, depth-first, positions and intervals by walking up the tree."""
    by = {n["node"]: n for n in nodes}
    assert len(by) == len(nodes)
    assert {x for p in paths for x in p.nodes} == set(by)
    trees = {}
    for n in nodes:
        trees.setdefault(n["tree"], []).append(n)
    for own in trees.values():
        own.sort(key=lambda n: n["start"])
        at, open_ = 0, []
        for n in own:
            assert n["start"] == at and len(n["segment"]) == n["length"]
            at += n["length"]
            while open_ and open_[-1] != n["parent"]:
                open_.pop()
            assert open_ or n["parent"] is None  # depth-first: the parent is still open
            open_.append(n["node"])
            spans, up, position = [], n["parent"], 0
            while up:
                spans.append((by[up]["start"], by[up]["start"] + by[up]["length"]))
                position += by[up]["length"]
                up = by[up]["parent"]
            merged = []
            for a, e in sorted(spans):
                if merged and merged[-1][1] == a:
                    merged[-1][1] = e
                else:
                    merged.append([a, e])
            assert [[x["start"], x["end"]] for x in n["ancestors"]] == merged and n["position"] == position


def test_chat_empty(spark):
    assert chat_tree.read_back(*chat_tree.pack(spark.createDataFrame([], TURNS))).collect() == []


def test_chat_escape():
    r = random.Random(1)
    for _ in range(3000):
        turns = [("".join(r.choice(["user", ":", "\\", "### ", "#", " "]) for _ in range(3)), "".join(r.choice(["\\", "### ", "</turn>", "<", "/turn>", "\n", "x", "#"]) for _ in range(r.randint(0, 8)))) for _ in range(3)]
        whole = "".join(chat_tree.segment(a, b)[0] for a, b in turns)
        assert chat_tree.parse(whole) == turns
    with pytest.raises(ValueError):
        chat_tree.parse("### user: x")


# --- quality classifier


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF_MID}/documents.parquet"), spark.read.parquet(f"{SF_MID}/labels.parquet")
    model = quality_knn.train(docs, labels)
    rows = quality_knn.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").withColumn("held", quality_knn.held_out(F.col("doc_id"))).collect()
    held = [r for r in rows if r.held]
    assert len(held) > 50 and np.mean([r.predicted == r.quality for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_quality_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality_knn.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality_knn.score(docs, quality_knn.train(docs, x)).collect()} for x in (labels, flipped))
    assert a == b


def test_quality_odd_rows(spark, odd, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 1), (14, 0), (9, 1), (9, 0), (None, 1), (3, None), (777, 1), (4, 0)], "doc_id bigint, quality int")
    model = quality_knn.train(odd, labels)
    rows = quality_knn.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows) and rows[0].grp == "g"
    assert quality_knn.score(no_docs, model).collect() == []
    nothing = quality_knn.train(odd, labels.limit(0))
    assert {r.score for r in quality_knn.score(odd, nothing).collect()} == {0.5}


def test_quality_votes_match_all_pairs():
    r = np.random.default_rng(0)
    known = quality_knn.embed(r.random((50, 30)).astype(np.float32), np.ones(30, np.float32), np.eye(30, 12, dtype=np.float32))
    y = r.integers(0, 2, 50).astype(np.float32)
    model = {"vectors": known, "labels": y, "idf": np.ones(30, np.float32), "basis": np.eye(30, 12, dtype=np.float32), "prior": 0.5}
    x = r.random((9, 30)).astype(np.float32)
    for got, row in zip(quality_knn.votes(x, model), x, strict=True):
        v = row[:12] / np.linalg.norm(row[:12])
        sims = sorted(zip(known @ v, y, strict=True), reverse=True)[: quality_knn.NEIGHBOURS]
        w = [s**quality_knn.SHARPNESS for s, _ in sims]
        assert abs(got - sum(a * b for a, (_, b) in zip(w, sims, strict=True)) / sum(w)) < 1e-4


# --- registered queries against their SQL, and the pipeline


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in os.listdir(SF_SMALL):
        if t.endswith(".parquet"):
            con.sql(f"CREATE VIEW {t[:-8]} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}')")
    return con


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = LLM_QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(LLM_ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    assert _sorted(df.select(cols).collect()) == _sorted(rel.select(", ".join(cols)).fetchall())


COLUMNS = {
    "op1_html": "page_id bigint, url string, text string, n_chars bigint",
    "op3_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op6_mix": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op8_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10_quality": "doc_id bigint, held_out boolean, score double, predicted int",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_columns(spark, name):
    df = LLM_QUERIES[name](spark, SF_SMALL)
    assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == COLUMNS[name]
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/{'pages' if name == 'op1_html' else 'documents'}.parquet").count()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        before = corpus_pipeline.cut(stage(spark, before, SF_SMALL), "test-stage")
        out[name] = before
        if name != "bpe":
            assert before.dtypes == docs.dtypes
    rows = {k: v.collect() for k, v in out.items()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = {r.doc_id for r in rows["quality classifier"]}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.98 * len(good)
    first = [(r.doc_id, r.text) for r in rows["quality classifier"]]
    want = {d for d, _, _, k in brute.near_components(first, n=5) if k}
    assert {r.doc_id for r in rows["minhash near-dedup"]} == want
    text = {r.doc_id: r.text for r in rows["minhash near-dedup"]}
    scanned = {r.doc_id: r.text for r in rows["secret scan"]}
    assert set(scanned) == set(text)
    for d, t in text.items():
        assert not brute.base_spans(scanned[d])
        assert scanned[d] == t or "[SECRET]" in scanned[d]
    size, took = {}, {}
    for r in rows["secret scan"]:
        size[r.source] = size.get(r.source, 0) + len(brute.words(r.text))
    for r in rows["mixing"]:
        assert r.text == scanned[r.doc_id]
        took[r.source] = took.get(r.source, 0) + len(brute.words(r.text))
    order = sorted(size)
    for s, t in zip(order, brute.targets([size[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5 * sum(size.values())), strict=True):
        # sources are a few documents here: off by half a document at most
        longest = max(len(brute.words(r.text)) for r in rows["secret scan"] if r.source == s)
        assert abs(took.get(s, 0) - t) <= longest / 2 + 1
    assert len(rows["bpe"]) == len(rows["mixing"])
    assert {(r.doc_id, r.decoded_sha256) for r in rows["bpe"]} == {(r.doc_id, brute.sha(r.text)) for r in rows["mixing"]}


def test_pipeline_runs_on_nothing(spark, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.collect() == []


def test_pipeline_keeps_one_row_of_a_document(spark):
    """Repeated rows of one doc_id go, and copies without doc_id; unlike texts of one doc_id stay, and so do
    rows that have neither doc_id nor words."""
    a, b, c, d = ("".join(f"{x}{i} " for i in range(60)) for x in "abcd")
    rows = [(2, a), (2, a), (1, a + "tail"), (1, a + "tail"), (3, b), (3, b), (3, c), (4, ""), (4, None), (5, None), (None, a), (None, a), (None, None), (None, ""), (None, d), (None, d), (None, d + "tail")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, _row string").repartition(4)
    got = corpus_pipeline.near_dedup(spark, docs, SF_SMALL)
    assert got.columns == docs.columns
    found = sorted([(r.doc_id, r.text or "") for r in got.collect()], key=repr)
    assert len([t for i, t in found if i is None and t in (d, d + "tail")]) == 1
    found = [x for x in found if x[0] is not None or not x[1].startswith("d")]
    assert found == sorted([(1, a + "tail"), (3, b), (3, c), (4, ""), (5, ""), (None, ""), (None, "")], key=repr)


def test_pipeline_on_odd_rows(spark, odd):
    """Nulls, empty and long texts, copies, repeated rows and clashing columns go through every stage."""
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.cut(stage(spark, docs, SF_SMALL), "odd-stage")
        if name != "bpe":
            assert docs.dtypes == before.dtypes
        if name == "minhash near-dedup":
            left = sorted(r.doc_id for r in docs.collect() if r.doc_id is not None)
            assert not {2, 3, 17} & set(left) or 1 not in left  # one of the copies at most
            rows = [(r.doc_id, r.text) for r in before.collect() if r.doc_id is not None]
            assert set(left) == {d for d, _, _, k in brute.near_components(rows, n=5) if k}
            base = next(t for d, t in rows if d == 1)  # a copy without doc_id goes with the others
            assert docs.where("doc_id IS NULL").where(F.col("text") == base).count() == 0
            assert docs.where("doc_id IS NULL AND text IS NULL").count() == before.where("doc_id IS NULL AND text IS NULL").count()
        if name == "secret scan":
            assert docs.count() == before.count()

"""Main text of deeply nested pages, of pages without an article, and of articles that are parts of a main element."""

import random
import time

from tessera.llm import wrappers

from .test_tables_ops import _text


def plain_blocks(html):
    """Open elements (name, attributes) of each block, by a stack that is copied and searched: quadratic, but plain."""
    out, stack, text = [], [], []
    for m in wrappers._TOKEN.finditer(html):
        name = m.group(2) or m.group(5)
        if not name:
            text.append(m.group())
            continue
        words = " ".join("".join(text).split())
        if words:
            out.append((tuple(stack), words))
        text = []
        if m.group(1) or m.group(4):
            if name in stack:
                while stack.pop() != name:
                    pass
            continue
        for names, upto in ([(("p",), ("td", "th", "table", "button", "object"))] + [(wrappers.ENDS.get(name, ()), wrappers.BOUNDARY.get(name, ()))]):
            while True:
                at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i] in names or stack[i] in upto), -1)
                if at < 0 or stack[at] not in names:
                    break
                del stack[at:]
        stack.append(name)
    words = " ".join("".join(text).split())
    return [*out, *([(tuple(stack), words)] if words else [])]


def _path(node):
    return _path(node.parent) + (node.name,) if node else ()


def test_blocks_against_a_plain_stack():
    r = random.Random(11)
    tags = "div p li ul table tr td th section article main dl dt dd tbody h2".split()
    for _ in range(400):
        html = "".join(r.choice([f"<{t}>", f"<{t}>", f"</{t}>", "x ", "some text "]) for t in r.choices(tags, k=r.randint(1, 60)))
        nodes = []
        assert [(_path(n), t) for n, t in wrappers._blocks(html, nodes)] == plain_blocks(html)


def test_deep_nesting_takes_time_in_proportion_and_loses_nothing(spark):
    began = time.time()
    found = wrappers.slots("<div>x" * 100_000)
    assert len(found) == 100_000 and len({s for s, _ in found}) <= wrappers.MAX_DEPTH + 1
    assert len(wrappers.slots("<ul>" + "<div>" * 20_000 + "<li>a</li>" * 20_000)) == 20_000
    assert len(wrappers.slots("<div class='sidebar'>x" * 30_000)) == 30_000
    assert time.time() - began < 30
    deep = "".join(f"<div>block {i} " for i in range(20_000))
    inside = f"<article><p>a</p>{'<div>' * 500}<p>b</p><nav><p>no</p></nav></article>"
    late = f"{'<section>' * 400}<article><h1>T</h1><p>text</p><aside>x</aside></article>"
    assert _text(spark, deep, inside, late, urls=["http://a/1", "http://b/1", "http://c/1"]) == ["\n".join(f"block {i}" for i in range(20_000)), "a\nb", "T\ntext"]


def test_text_outside_the_container_of_most_stays(spark):
    pages = [f"<body><p>Intro of story {i}</p><div class='box'>" + "".join(f"<p>text {i} {k}</p>" for k in range(30)) + "</div></body>" for i in range(3)]
    assert _text(spark, *pages) == ["\n".join([f"Intro of story {i}", *(f"text {i} {k}" for k in range(30))]) for i in range(3)]
    nested = "".join(f"<div>part {k} " for k in range(1000))
    assert _text(spark, nested) == ["\n".join(f"part {k}" for k in range(1000))]


def test_articles_that_are_parts_of_main(spark):
    card = "<main><p>a</p><article class='card'><p>teaser</p></article><p>body</p></main>"
    news = "<main><article><h1>T</h1><p>one</p><p>two</p><p>three</p></article><p>More news</p></main>"
    assert _text(spark, card, news, urls=["http://a/1", "http://b/1"]) == ["a\nteaser\nbody", "T\none\ntwo\nthree"]


def test_comment_sections_by_other_names(spark):
    for attribute in ("class='comment-thread'", "id='respond'", "class='comments-list thread'"):
        assert _text(spark, f"<article><p>text</p><div {attribute}><p>reader</p></div></article>") == ["text"], attribute
    assert _text(spark, "<article><p>text</p><div class='thread'><p>more</p></div></article>") == ["text\nmore"]

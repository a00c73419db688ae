"""Main text of web pages by wrappers inferred from pages of the same host.

A page is read as a stream of text slots, each labelled with its symbol: the
path of block elements around it, with classes and ids. Streams of one host are
aligned one after another into a union-free regular expression over symbols:

* a symbol both have stays, one that only one has becomes *optional*,
* a symbol met again turns everything since its first place into a *repeated
  group* (so every symbol occurs once and a wrapper is bounded by the host's
  distinct symbols),
* a slot whose texts differ is a *text slot*; one that always reads the same is
  template text.

Which slots are the main text is decided by lists and by the wrapper. Lists of
elements, roles, classes and ids leave out menus, headers, footers, asides,
forms, adverts, notices and comments, and prefer the article, else the main
element. The wrapper tells text slots from template text, which is dropped in
an article too, and where there is neither article nor main it names the
container that holds most of the varying prose (prose outside it stays as well). A page whose
main element holds as much prose beside its articles as in them is taken by its main element. Every symbol stands once in a
wrapper, so a slot's place in it is found by its symbol; the order, optional
slots and repeated groups of the expression describe the host's pages and
choose no text. The blocks of the chosen slots are joined.

Symbols hold only names (classes, ids) that recur on one in ``SHARE`` of the
host's pages, others share one name; a path that does not recur so stands under
its nearest ancestor that does. Both are counted before alignment, so a wrapper
has at most some ``MAX_SYMBOLS`` symbols whatever the number of pages and names.

Wrappers merge associatively as far as the chosen slots go: batches of pages are
aligned by themselves (equal streams once), then groups of some ``FAN_IN``
wrappers are merged until a host has one, so a host with a third of all pages
has no larger task than others. What is known of hosts is sent to all tasks when
small (``BROADCAST_BYTES``), otherwise once to each slice of a host's pages.

Pages may be of any length and depth: time and memory grow with the page, and text deeper than
``MAX_DEPTH`` elements is kept, under a symbol of the last of them. An empty table gives an empty result;
other columns are ignored, whatever their names. Null html is an empty text. A null url or one without a host shares the host
"". Repeated rows are extracted separately. Truncated and badly nested pages
follow the usual implied ends (a block ends an open paragraph, an end tag ends
all that is open inside it, the end of the page ends everything).
"""

from __future__ import annotations

import difflib
import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, drop_cut, workers

# Parameters.
SHARE = 100  # a name or path that recurs on one in so many pages of its host is told apart
MAX_SYMBOLS = 1000  # names, and paths, told apart in one host
MAX_SYMBOL_CHARS = 1000
MAX_DEPTH = 128  # elements of a path told apart; text further in stands under the last of them
FAN_IN = 32  # wrappers merged at a time
SLICES = 1000  # beyond BROADCAST_BYTES a host's pages are dealt out in slices of one in so many pages
BROADCAST_BYTES = 16 << 20
TEMPLATE_PAGES = 3  # a slot that reads the same on so many unlike pages is template text
PAGES = ""  # the key that counts all pages of a host

# HTML's element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul noscript select button template object".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes svg math".split())
ENDS = {  # an open element of the second kind ends where the first begins
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "option": ("option",), "body": ("head",),
}
BOUNDARY = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",), "tfoot": ("table",)}
OUTSIDE = frozenset("nav header footer aside form head noscript template select button menu dialog fieldset object".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts sponsor sponsored promo promotion banner nav navbar navigation menu sidebar footer header "
    "masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal overlay comment comments reply "
    "replies respond disqus share sharing social related recommended newsletter subscribe signup login pagination pager widget".split()
)
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus related ad ads advert".split())
# What may stand beside such a word in the name of a class or id ("site-header", "cookie-notice", "left_sidebar"). Any other
# part says something else ("has-sidebar", "ad-free", "header-fixed").
BESIDE = frozenset(
    "area bar block body bottom box btn button buttons col column container content element footer form global google header icon icons "
    "inner item items left link links list main outer page panel post posts articles stories primary right row secondary section site "
    "slot text thread threads title toggle top unit wrap wrapper entry article blog user".split()
)
TITLES = frozenset("post posts article articles entry blog stories content title".split())  # "post-header" holds a title
PROSE = frozenset("p blockquote pre article main section".split())
PROSE_SLOTS = PROSE | {"*"}  # and slots of paths that are not told apart

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?|[^<]+|<""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_HEADING = re.compile(r"h[1-6]\b")
_WORDS = re.compile(r"[a-z]+")
_PARTS = re.compile(r"[^a-z0-9]+")
_NUMBERED = re.compile(r"[a-z]*[0-9][a-z0-9]*")  # counters and generated names: one symbol for all of them


def _words(name: str) -> set[str]:
    """The outside words of a class or id, if all of its parts are such words, their usual company or numbers."""
    parts = [w for x in _PARTS.split(name.partition("--")[0]) for w in _WORDS.findall(x) if len(w) > 1 or not x.strip(w)]
    found = OUTSIDE_WORDS.intersection(parts)
    if not found or not all(w in found or w in BESIDE for w in parts) or (found == {"header"} and not TITLES.isdisjoint(parts)):
        return set()
    return found


def _element(name: str, attributes: str) -> tuple[str, str]:
    """Symbol part of an element (name, role, classes, id; numbered names as 0), and why it is outside the main text:
    ``!`` (what it is, hides or comments on), ``h`` (a header by its element name alone), ``~`` (words of class or id),
    or nothing."""
    mark = "h" if name == "header" else "!" if name in OUTSIDE else ""
    if not attributes or attributes.isspace():
        return name, mark
    said, words = [], set()
    for k, v in _ATTRIBUTE.findall(attributes):
        k, v = k.lower(), v.strip("\"'").lower()
        if k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and "display:none" in v.replace(" ", "")):
            mark = "!"
        elif k == "role":
            said.append("@" + (v if v in OUTSIDE_ROLES or v in ("article", "main") else "0"))
            if v in OUTSIDE_ROLES:
                mark = "!"
        elif k in ("class", "id"):
            words.update(*map(_words, v.split()))
            said.append("." + ".".join(sorted({_NUMBERED.sub("0", x).replace("@", "_") for x in v.split()})))
    if words & COMMENT_WORDS:
        mark = "!"
    elif words and not mark and name not in ("html", "body", "article", "main"):
        mark = "~"
    return name + "".join(sorted(said)).replace("/", "_").replace("!", "_"), mark


class _Node:
    """An open element: what it is, and what holds of it and all around it. Nodes know their parent only, so a page's nodes
    take memory in proportion to its elements however deep they lie."""

    __slots__ = ("name", "part", "mark", "parent", "depth", "main", "gone", "under", "titled", "worded", "prose", "plain", "title")

    def __init__(self, name: str, part: str, mark: str, parent: "_Node | None"):
        self.name, self.part, self.mark, self.parent = name, part, mark, parent
        self.depth = parent.depth + 1 if parent else 1
        self.main = name in ("article", "main") or bool(parent and parent.main)
        self.gone = mark in ("!", "h") or bool(parent and parent.gone)
        # the title of an article stays although its header goes
        self.under = (self.main and mark == "h") or bool(parent and parent.under)
        self.titled = (self.under and bool(_HEADING.fullmatch(name))) or bool(parent and parent.titled)
        self.worded = self if mark == "~" else parent.worded if parent else None  # the innermost with words of class or id
        self.prose = 0  # characters of prose in it, counted for worded ones
        self.plain = self.title = None  # symbols of text in it, and of a title


def _label(node: _Node, titled: bool, total: int) -> tuple[str, bool, bool]:
    """(symbol, inside by name, outside) of a node whose parent has its own. Beyond ``MAX_DEPTH`` a slot stands under its
    ancestor there, of the same kind."""
    above = (node.parent.title if titled else node.parent.plain) if node.parent else ("", False, False)
    inside = above[1] or node.part.startswith(("article", "main"))
    go = node.mark == "!" or (node.mark == "h" and not (titled and inside)) or (node.mark == "~" and 2 * node.prose <= total)
    if node.depth <= MAX_DEPTH:
        part = "!" + node.part if go else node.part
        return f"{above[0]}/{part}" if above[0] else part, inside, above[2] or go
    base = above[0] if node.depth == MAX_DEPTH + 1 else above[0].rpartition("/")[0]
    if node.name in ("article", "main") and not _inside(base, node.name):
        base = f"{base}/{node.name}"
    return base + ("/!*" if above[2] or go else "/*"), inside, above[2] or go


def _symbols(nodes: list[_Node], found: list[tuple[_Node | None, str]]) -> list[tuple[str, str]]:
    """Slots with their symbols. Words don't put an element outside that holds most of the page's prose."""
    total = 0
    for node, text in found:
        if node and not node.gone and (node.main or node.name in PROSE):
            total += len(text)
            if node.worded:
                node.worded.prose += len(text)
    titles = any(node and node.titled for node, _ in found)
    for node in reversed(nodes):  # from inner elements to outer ones
        if node.mark == "~" and node.parent and node.parent.worded:
            node.parent.worded.prose += node.prose
    for node in nodes:  # from outer elements to inner ones
        node.plain = _label(node, False, total)
        if titles:
            node.title = _label(node, True, total)
    return [((node.title if node.titled else node.plain)[0] if node else "/", text) for node, text in found]


def slots(html: str) -> list[tuple[str, str]]:
    """(symbol, text) of every block of text, in page order. Elements outside the main text are marked ``!``."""
    nodes: list[_Node] = []
    return _symbols(nodes, list(_blocks(html, nodes)))


def _blocks(html: str, nodes: list[_Node]) -> Iterator[tuple[_Node | None, str]]:
    """(innermost open element, text) of every block of text; all elements met go to ``nodes``, outer ones first. The time
    grows with the page only, not with the depth: open elements are found by name."""
    stack: list[_Node] = []
    places: dict[str, list[int]] = {}  # of open elements in the stack, by name
    text: list[str] = []
    dropped: list[str] = []  # open inline elements whose text is outside
    pos, n = 0, len(html)

    def flush():
        if text:
            words = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if words:
                yield (stack[-1] if stack else None), words

    def last(names) -> int:
        return max((places[x][-1] for x in names if places.get(x)), default=-1)

    def open_at(names, upto=()) -> int:
        """Index of the innermost open element of these names, -1 if none (not beyond ``upto``)."""
        at = last(names)
        return at if at > last(upto) else -1

    def close(at: int) -> None:
        while len(stack) > at:
            places[stack.pop().name].pop()

    while pos < n:
        m = _TOKEN.match(html, pos)
        pos = m.end()
        name = m.group(2) or m.group(5)
        if not name:
            token = m.group()
            if (token[0] != "<" or token == "<") and not dropped:
                text.append(token)
            continue
        name = name.lower()
        closing = m.group(1) or m.group(4)
        attributes = m.group(3) if m.group(2) else m.group(6)
        if name in RAW and not closing:
            foreign = name in ("svg", "math")
            if foreign and attributes.rstrip().endswith("/"):
                continue
            end = re.compile(f"</{re.escape(name)}", re.IGNORECASE).search(html, pos)
            if end is not None:
                pos = end.start()
            elif not foreign:  # an svg that never ends doesn't take the page with it
                pos = n
            continue
        if name not in BLOCKS:
            if name == "br":
                text.append(" ")
            elif name == "hr":
                yield from flush()
            elif name not in VOID and name not in RAW and not attributes.endswith("/"):
                if closing:
                    if name in dropped:
                        del dropped[len(dropped) - 1 - dropped[::-1].index(name) :]
                elif dropped or _element(name, attributes)[1]:
                    dropped.append(name)
            continue
        yield from flush()
        dropped.clear()
        if closing:
            at = open_at((name,))
            if at >= 0:
                close(at)
            continue
        if name != "option" and (at := open_at(("p",), ("td", "th", "table", "button", "object"))) >= 0:
            close(at)
        if name in ENDS:
            while (at := open_at(ENDS[name], BOUNDARY.get(name, ()))) >= 0:
                close(at)
        nodes.append(_Node(name, *_element(name, attributes), stack[-1] if stack else None))
        places.setdefault(name, []).append(len(stack))
        stack.append(nodes[-1])
    yield from flush()


def is_outside(symbol: str) -> bool:
    return any(p.startswith("!") for p in symbol.split("/"))


# --- bounded symbols -----------------------------------------------------------------------


@lru_cache(1 << 16)
def key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(errors="replace"), digest_size=8).digest(), "little", signed=True)


def _part(part: str) -> tuple[str, list[str], str]:
    """Element, names and role of a symbol's part."""
    part, at, role = part.partition("@")
    name, *names = part.split(".")
    return name, sorted({x for x in names if x}), at + role


def names_of(symbol: str) -> set[str]:
    return {x for p in symbol.split("/") for x in _part(p)[1]}


def renamed(symbol: str, names: frozenset) -> str:
    """The symbol with names that are not known as 0."""
    out = []
    for p in symbol.split("/"):
        name, own, role = _part(p)
        out.append(".".join([name, *sorted({x if key(x) in names else "0" for x in own})]) + role)
    return "/".join(out)


def prefixes(symbol: str) -> Iterator[str]:
    """The symbol and the containers around it, innermost first."""
    while symbol:
        if len(symbol) <= MAX_SYMBOL_CHARS:
            yield symbol
        symbol = symbol.rpartition("/")[0]


def bounded(symbol: str, names: frozenset, paths: frozenset) -> str:
    """The symbol if it is known, else a slot of its innermost container that is; of the same kind as before."""
    symbol = renamed(symbol, names)
    base = next((p for p in prefixes(symbol) if key(p) in paths), "")
    if base == symbol or symbol == "/":
        return symbol
    parts = [base] if base else []
    parts += [e for e in ("article", "main") if _inside(symbol, e) and not _inside(base, e)]
    return "/".join([*parts, "!*" if is_outside(symbol) else "*"])


# --- wrappers ------------------------------------------------------------------------------
# A wrapper: symbols in order; for each optional, group or -1, and what _count keeps of it.


def read(html: str) -> tuple[tuple[str, ...], list[tuple[str, str]]]:
    found = slots(html)
    return tuple(s for s, _ in found), found


def fold(symbols: list[str], optional: list[bool], group: list[int]) -> tuple[list[str], list[bool], list[int]]:
    """Every symbol once: what lies from its first place to its last is one repeated group."""
    first: dict[str, int] = {}
    last: dict[str, int] = {}
    for i, s in enumerate(symbols):
        first.setdefault(s, i)
        last[s] = i
    for g in set(group) - {-1}:  # groups stay together
        at = [i for i, x in enumerate(group) if x == g]
        last[symbols[at[0]]] = max(last[symbols[at[0]]], at[-1])
    out: tuple[list[str], list[bool], list[int]] = ([], [], [])
    i, number = 0, 0
    while i < len(symbols):
        end = last[symbols[i]]
        j = i
        while j <= end:
            end = max(end, last[symbols[j]])
            j += 1
        span = range(i, end + 1)
        repeated = end > i or group[i] >= 0
        times = Counter(symbols[k] for k in span)
        always = {symbols[k] for k in span if not optional[k]}
        most = max(times.values())
        for s in dict.fromkeys(symbols[i : end + 1]):
            out[0].append(s)
            out[1].append(s not in always or times[s] < most)
            out[2].append(number if repeated else -1)
        number += repeated
        i = end + 1
    return out


def align(a: tuple, b: tuple) -> tuple:
    """Two wrappers (symbols, optional, group) as one that accepts what either accepts."""
    if a[0] == b[0]:
        optional = [x or y for x, y in zip(a[1], b[1], strict=True)]
        group = b[2] if sum(g >= 0 for g in b[2]) > sum(g >= 0 for g in a[2]) else a[2]
        return fold(list(a[0]), optional, list(group))
    symbols, optional, group = [], [], []
    shift = max([*a[2], -1]) + 1
    for op, i, j, k, m in difflib.SequenceMatcher(None, a[0], b[0], autojunk=False).get_opcodes():
        if op == "equal":
            for x, y in zip(range(i, j), range(k, m), strict=True):
                symbols.append(a[0][x])
                optional.append(a[1][x] or b[1][y])
                group.append(a[2][x] if a[2][x] >= 0 else b[2][y] + shift if b[2][y] >= 0 else -1)
        else:
            for w, span, add in ((a, range(i, j), 0), (b, range(k, m), shift)):
                for x in span:
                    symbols.append(w[0][x])
                    optional.append(True)
                    group.append(w[2][x] + add if w[2][x] >= 0 else -1)
    return fold(symbols, optional, group)


def _count(seen: dict, symbol: str, new: list) -> None:
    """Pages, characters, hash of the text ("" if it differs), and 64 bits of which each page sets one by its content."""
    if symbol not in seen:
        seen[symbol] = list(new)
        return
    old = seen[symbol]
    old[0] += new[0]
    old[1] += new[1]
    old[2] = old[2] if old[2] == new[2] else ""
    old[3] |= new[3]


def is_template(seen: dict, symbol: str) -> bool:
    """Reads the same on half of the host's pages, and on enough that are not copies of each other."""
    pages, _, said, bits = seen[symbol]
    return said != "" and 2 * pages >= seen[PAGES][0] and bits.bit_count() >= TEMPLATE_PAGES


def learn(shape: tuple | None, seen: dict, pages: list) -> tuple:
    """Align the streams of ``pages`` (each: symbols, slots) to ``shape`` and count their slots in ``seen``.
    A slot is a symbol and its text, or a symbol, a hash of its text and its characters."""
    met = set()
    for stream, found in pages:
        if stream and stream not in met:
            met.add(stream)
            own = fold(list(stream), [False] * len(stream), [-1] * len(stream))
            shape = own if shape is None else align(shape, own)
        texts: dict[str, list[str]] = {}
        chars: Counter = Counter()
        for s, t, *n in found:
            texts.setdefault(s, []).append(t)
            chars[s] += n[0] if n else len(t)
        page = 1 << hashlib.blake2b(json.dumps(found).encode(), digest_size=1).digest()[0] % 64
        if found:
            _count(seen, PAGES, [1, 0, "", page])
        for s, ts in texts.items():
            _count(seen, s, [1, chars[s], hashlib.blake2b("\n".join(ts).encode(), digest_size=8).hexdigest(), page])
    return shape


def merge(parts: list[dict]) -> dict:
    """Wrappers of one host as one."""
    shape, seen = None, {}
    for p in sorted(parts, key=lambda p: json.dumps(p["shape"])):
        own = tuple(map(list, p["shape"]))
        if own[0]:
            shape = own if shape is None else align(shape, own)
        for s, count in p["seen"].items():
            _count(seen, s, count)
    return {"shape": shape or ([], [], []), "seen": seen}


def _inside(symbol: str, name: str) -> bool:
    return any(re.match(rf"{name}\b", p) or p.endswith(f"@{name}") for p in symbol.split("/"))


def levels(wrapper: dict) -> list[list[list[str]]]:
    """Slots of the main text (and what goes with them where a page has any), best kind first: in an article, in the main element, in the container of most
    varying text, or anywhere not outside. Text slots come before template text everywhere: a page has the
    template text of its article only where it has no other. The headings of an article always count as text."""
    seen = wrapper["seen"]
    allowed = [s for s in wrapper["shape"][0] if not is_outside(s)]
    varying = [s for s in allowed if not is_template(seen, s)]
    # the innermost container of nine tenths of the varying prose; prose outside it stays too, and where a host has no
    # prose there is no container
    ends = {s: re.split("[.@]", s.rpartition("/")[2])[0] for s in varying}
    prose = [s for s in varying if ends[s] in PROSE_SLOTS] if PROSE.intersection(ends.values()) else []
    mass: dict[str, int] = {}
    for s in prose:
        at = s.rfind("/")
        while at > 0:
            mass[s[:at]] = mass.get(s[:at], 0) + seen[s][1]
            at = s.rfind("/", 0, at)
    enough = 0.9 * sum(seen[s][1] for s in prose)
    most = max((c for c in mass if mass[c] >= enough), key=lambda c: (c.count("/"), c), default=None)
    kept = set(prose)
    titles = [s for s in allowed if s not in varying and _HEADING.match(s.rpartition("/")[2])]
    of = lambda slots, name: [s for s in slots if _inside(s, name)]
    return [
        [of(varying, "article"), of(titles, "article")],
        [of(allowed, "article")],
        [of(varying, "main"), of(titles, "main")],
        [of(allowed, "main")],
        [[s for s in varying if most is not None and (s in kept or (s.rpartition("/")[0] + "/").startswith(most + "/"))]],
        [varying],
        [allowed],
    ]


ARTICLE_KINDS = 2  # of levels(): they come first


def of_main(symbols: list[str]) -> bool:
    """Whether a page's articles are but parts of its main element: as many blocks of prose stand in main beside them as in them."""
    beside = within = 0
    for s in symbols:
        if not is_outside(s):
            if _inside(s, "article"):
                within += 1
            elif _inside(s, "main") and re.split("[.@]", s.rpartition("/")[2])[0] in PROSE_SLOTS:
                beside += 1
    return 0 < within <= beside


def main_text(found: list[tuple], kinds: list[list[list]]) -> str:
    """The blocks of the first kind of slots that the page has."""
    for wanted, *more in kinds:
        wanted = set(wanted)
        if any(s in wanted for s, _ in found):
            wanted = wanted.union(*more)
            return "\n".join(t for s, t in found if s in wanted)
    return ""


# --- Spark ----------------------------------------------------------------------------------


@lru_cache(256)
def _known(data: str | None) -> tuple[frozenset, frozenset, list]:
    """Known names and paths of a host, and the kinds of slots, all by key."""
    names, paths, kinds = [*json.loads(data or "[]"), [], [], []][:3]
    return frozenset(names), frozenset(paths), kinds


def _streams(batches):
    """host, and each slot's symbol, hash of text and characters."""
    import pyarrow as pa

    for b in batches:
        out = []
        for h in b.column("html").to_pylist():
            at: dict[str, int] = {}
            slot = [(at.setdefault(s, len(at)), key.__wrapped__(t), len(t)) for s, t in slots(h)]
            out.append(json.dumps([list(at), slot]))
        yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(out, pa.string())], names=["host", "stream"])


def _counter(of: Callable) -> Callable:
    """Pages of each host on which each key occurs; key null: all its pages."""

    def run(b, known):
        import pyarrow as pa

        pages: Counter = Counter()
        for host, stream, data in zip(b.column("host").to_pylist(), b.column("stream").to_pylist(), known, strict=True):
            symbols = json.loads(stream)[0]
            if symbols:
                pages[host, None, 0] += 1
                pages.update((host, key(x), x.count("/")) for x in {x for s in symbols for x in of(s, *_known(data)[:2])})
        rows = [(*k, n) for k, n in pages.items()]
        types = {"host": pa.string(), "key": pa.int64(), "depth": pa.int64(), "pages": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types.values())], names=list(types))

    return run


def _recurring(counts: DataFrame) -> DataFrame:
    """host, keys (JSON): those that recur on enough of the host's pages, the most frequent ``MAX_SYMBOLS``
    (outer paths first, so that a known path's containers are known)."""
    counts = cut(counts.groupBy("host", "key").agg(F.sum("pages").alias("pages"), F.min("depth").alias("depth")), "counts")
    total = counts.where("key IS NULL").select("host", F.col("pages").alias("total"))
    least = F.greatest(F.ceil(F.col("total") / SHARE), F.when(F.col("total") > TEMPLATE_PAGES, 2).otherwise(1))
    found = counts.where("key IS NOT NULL").join(total, "host").where(F.col("pages") >= least)
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("pages"), "depth", "key"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= MAX_SYMBOLS)
    found = found.groupBy("host").agg(F.to_json(F.sort_array(F.collect_list("key"))).alias("keys"))
    return total.select("host").join(found, "host", "left").select("host", F.coalesce("keys", F.lit("[]")).alias("keys"))


def with_known(rows: DataFrame, known: DataFrame, f: Callable, schema: str) -> DataFrame:
    """``f(batch, what is known of each row's host)`` over ``rows(host, ...)``; ``known(host, data)``."""
    size = known.agg(F.sum(F.length("host") + F.length("data"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        sent = {r.host: r.data for r in known.collect()}

        def run(batches):
            for b in batches:
                yield f(b, [sent.get(h) for h in b.column("host").to_pylist()])

        return rows.mapInArrow(run, schema)

    # pages meet their host's data in slices of bounded size; only hosts of several slices are broadcast, SLICES at most
    pages = cut(rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "host-pages")
    total = pages.agg(F.sum("pages")).first()[0] or 1
    large = F.broadcast(pages.where(F.col("pages") * SLICES > total).select("host", F.ceil(F.col("pages") * SLICES / total).cast("int").alias("slices")))
    slices = F.coalesce("slices", F.lit(1))
    cols = rows.columns
    dealt = rows.join(large, "host", "left").withColumn("slice", F.pmod(F.xxhash64(*cols), slices).cast("int")).select(*cols, "slice", F.lit(None).cast("string").alias("data"))
    sides = known.join(large, "host", "left").withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1))).select("host", "slice", "data")
    whole = dealt.unionByName(sides, allowMissingColumns=True).repartition("host", "slice").sortWithinPartitions("host", "slice", F.col("data").isNull())

    def stream(batches):
        import pyarrow as pa

        at, data = None, None
        for b in batches:
            own, said = [], []
            for i, (host, new) in enumerate(zip(b.column("host").to_pylist(), b.column("data").to_pylist(), strict=True)):
                if new is not None:
                    at, data = host, new
                else:
                    own.append(i)
                    said.append(data if at == host else None)
            if own:
                yield f(b.take(pa.array(own)), said)

    return whole.mapInArrow(stream, schema)


def _learn(b, known):
    """One wrapper of each host in the batch."""
    import pyarrow as pa

    pages: dict[str, list] = {}
    for host, stream, data in zip(b.column("host").to_pylist(), b.column("stream").to_pylist(), known, strict=True):
        symbols, found = json.loads(stream)
        names, paths, _ = _known(data)
        symbols = [bounded(s, names, paths) for s in symbols]
        found = [(symbols[i], str(h), n) for i, h, n in found]
        pages.setdefault(host, []).append((tuple(s for s, _, _ in found), found))
    rows = []
    for host, own in pages.items():
        seen: dict = {}
        shape = learn(None, seen, own)
        if seen:
            rows.append((host, json.dumps({"shape": shape, "seen": seen})))
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], names=["host", "wrapper"])


def _merge(pdf):
    return pdf.iloc[:1][["host"]].assign(wrapper=json.dumps(merge([json.loads(w) for w in pdf["wrapper"]])))


def _kinds(pdf):
    whole = [json.dumps([[[key(s) for s in some] for some in kind] for kind in levels(json.loads(w))]) for w in pdf["wrapper"]]
    return pdf[["host"]].assign(kinds=whole)


def infer(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pages(host, html)`` -> wrappers (host, wrapper: JSON), and what extraction asks of a host (host, data: JSON)."""
    streams = cut(pages.select("host", "html").mapInArrow(_streams, "host string, stream string"), "streams")
    data = lambda *cols: F.concat(F.lit("["), F.concat_ws(",", *cols), F.lit("]")).alias("data")
    counts, nothing = "host string, key bigint, depth bigint, pages bigint", streams.sparkSession.createDataFrame([], "host string, data string")
    names = cut(_recurring(with_known(streams, nothing, _counter(lambda s, *_: names_of(s)), counts)), "names")
    known = names.select("host", data("keys"))
    paths = _recurring(with_known(streams, known, _counter(lambda s, own, _: prefixes(renamed(s, own))), counts))
    both = cut(names.join(paths.withColumnRenamed("keys", "paths"), "host"), "paths")
    parts = cut(with_known(streams, both.select("host", data("keys", "paths")), _learn, "host string, wrapper string"), "wrappers")
    schema = "host string, wrapper string"
    while (most := parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        # by groups of some FAN_IN, evenly by number of the row
        group = F.lit(0) if most <= FAN_IN else F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-most // FAN_IN)))
        new = cut(parts.withColumn("part", group).groupBy("host", "part").applyInPandas(_merge, schema), "wrappers")
        drop_cut(parts)
        parts = new
    kinds = parts.groupBy("host").applyInPandas(_kinds, "host string, kinds string")
    return parts, both.join(kinds, "host").select("host", data("keys", "paths", "kinds"))


def _extract(b, known):
    import pyarrow as pa

    out = []
    for html, data in zip(b.column("html").to_pylist(), known, strict=True):
        names, paths, kinds = _known(data)
        found = slots(html) if html and kinds else []
        symbols = {s: key(bounded(s, names, paths)) for s in {s for s, _ in found}}
        own = kinds[ARTICLE_KINDS:] if of_main([s for s, _ in found]) else kinds
        out.append(main_text([(symbols[s], t) for s, t in found], own) or main_text([(symbols[s], t) for s, t in found], kinds))
    return pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` -> page_id, url, text."""
    workers(pages.sparkSession)
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    known = cut(infer(own)[1], "known")
    return with_known(own, known, _extract, "page_id bigint, url string, text string")

"""Main text of web pages by wrapper induction.

Pages of one host are aligned with the host's reference page (of a sample the
one of median size) by simple tree matching: the largest order-preserving
matching of two trees with equal tags. Matched nodes with equal texts are
constant, the others vary. The containers that together hold all of a page's
varying text are the page's vote for the content slot. Matched nodes have equal
tag paths, so the pages that hold a text at a tag path are counted over the
whole host; a text on most of at least ``EVIDENCE`` different pages is template
and goes, also inside the content. What holds a page's other text is its
content: all containers with text that varies, whatever their share. Outside of
an article or main, varying text that is all links (menus) opens no container.
Menus, headers, footers, notices, adverts, forms and comments never are content;
in an article or main a name that only contains such a word is no proof.

What travels for the alignment is a page's skeleton (tags, text hashes and
lengths), a fraction of the page; equal ones count once. A host's reference
skeleton and its results are joined with salted copies, so a hot host's pages
spread over ``SALTS`` tasks; counts are partial sums.

Defined cases: null or empty html gives an empty text; pages without
varying prose or with too few pages on their host use the host's commonest slot,
and without one (single pages, equal pages, null urls) their article, main or
body element; repeated rows are treated alike; broken markup is closed
as a browser would close paragraphs, list items and table cells.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetpulse.llm.tables import stored

SALTS = 32
EVIDENCE = 3  # different pages from which on a text held by most of them is template
SAMPLES = 9
FLUSH = 100_000
DEEPEST = 150  # deeper elements (inline ones from half of it on) are siblings of what they hold; skipped ones go whole

# HTML's element kinds and the names that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var img wbr".split())
DROPPED = frozenset("head title script style noscript template nav footer aside form button select option textarea "
                    "iframe object embed svg canvas audio video dialog menu".split())
CONTAINERS = frozenset("article main section div td body".split())
SLOTS = frozenset("article main section div body".split())
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
BLOCK_SCOPE = CONTAINERS | {"li", "blockquote", "td", "th"}
SAME_CLOSES = {tag: frozenset(closed.split()) for tag, closed in {
    "li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}.items()}
SCOPE = {tag: frozenset(around.split()) for tag, around in {
    "li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr", "th": "tr", "option": "select"}.items()}
BOILERPLATE = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion
    banner sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr
    notice notices notification alert newsletter subscribe subscription signup login popup modal share sharing social
    comment comments respond reply replies disqus related recommended widget pagination pager toolbar""".split())
HEADERS = frozenset("header masthead banner".split())
_PART = re.compile(r"[^a-z]+")
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu menubar".split())


class Node:
    __slots__ = ("tag", "mark", "skip", "flat", "children", "constant")

    def __init__(self, tag: str, attrs: list, around: list[Node] = ()):
        self.tag, self.flat, self.children, self.constant = tag, False, [], False
        if not attrs:
            self.mark, self.skip = tag, tag in DROPPED
            return
        got = {k: v or "" for k, v in reversed(attrs)}
        names, ident = got.get("class", ""), got.get("id", "")
        inside = bool(names or ident) and any(n.tag in ("article", "main") for n in around)
        self.mark, self.skip = marked(tag, names, ident, got.get("role", ""), "hidden" in got, inside)


@functools.lru_cache(4096)
def marked(tag: str, names: str, ident: str, role: str, hidden: bool, inside: bool) -> tuple[str, bool]:
    """(mark, whether it is boilerplate by itself) of an element; pages repeat theirs."""
    skip = tag in DROPPED or hidden or role.lower() in ROLES
    if not skip and tag not in ("body", "html", "article", "main"):
        skip = named(f"{names} {ident}".lower(), inside)
    return tag + "".join("." + x for x in names.split()[:2]), skip


def named(names: str, inside: bool) -> bool:
    """Whether class and id name boilerplate: by any part of a name; in an
    article or main only a name all of whose parts do, and that is no header.
    Other names there are left to the count of constant texts."""
    if not inside:
        return bool(BOILERPLATE.intersection(_PART.split(names)))
    parts = ({x for x in _PART.split(name) if x} for name in names.split())
    return any(p and p <= BOILERPLATE and not p & HEADERS for p in parts)


class Tree(HTMLParser):
    """The element tree of a page; texts are strings among the children."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", [])
        self.open = [self.root]
        self.gone: list[str] = []  # open elements from a skipped one on that is too deep to open
        self.gone_of: Counter = Counter()
        self.feed(html)
        self.close()

    def updatepos(self, i, j):  # line numbers are not asked for
        return j

    def _pop(self, tags, scope=()) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in scope:
                return

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if self.gone:
            if tag not in VOID:
                self._lose(tag)
            return
        if tag not in INLINE and tag not in VOID:
            self._pop(CLOSED_BY_BLOCK, BLOCK_SCOPE)
        if tag in SAME_CLOSES:
            self._pop(SAME_CLOSES[tag], SCOPE[tag])
        node = Node(tag, attrs, self.open)
        if tag == "header" and not any(n.tag in ("article", "main") for n in self.open):
            node.skip = True
        self.open[-1].children.append(node)
        if tag in VOID:
            return
        if len(self.open) < (DEEPEST // 2 if tag in INLINE else DEEPEST):
            self.open.append(node)
        elif node.skip:
            self._lose(tag)
        else:
            node.flat = True

    def _lose(self, tag: str) -> None:
        self.gone.append(tag)
        self.gone_of[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.gone:
            if not self.gone_of[tag]:
                if tag in INLINE or not any(n.tag == tag for n in self.open[1:]):
                    return
                self.gone, self.gone_of = [], Counter()  # an element around it ends
            else:
                last = None
                while last != tag:
                    last = self.gone.pop()
                    self.gone_of[last] -= 1
                return
        if self.open[-1].tag == tag and len(self.open) > 1:
            self.open.pop()
            return
        if any(n.tag == tag for n in self.open[1:]) and not (
                tag in INLINE and any(n.tag not in INLINE for n in self._above(tag))):
            self._pop({tag})

    def _above(self, tag):
        last = max(i for i, n in enumerate(self.open) if n.tag == tag)
        return self.open[last + 1:]

    def handle_data(self, data):
        if not self.gone:
            self.open[-1].children.append(data)


def own_text(node: Node, content: bool) -> tuple[str, bool, list[Node], bool]:
    """(own text, whether it is prose, inner elements, in an article or main);
    the text of inline elements belongs to the block around them. Text that is
    all links is no prose, unless it stands in an article or main."""
    texts, inner = [], []
    content = content or node.tag in ("article", "main")
    prose = content

    def own_parts(n: Node, linked: bool) -> None:
        nonlocal prose
        for c in n.children:
            if isinstance(c, str):
                texts.append(c)
                prose = prose or not linked and any(map(str.isalnum, c))
            elif c.tag in INLINE and not c.skip:
                own_parts(c, linked or c.tag == "a")
            else:
                inner.append(c)
    own_parts(node, False)
    own = " ".join(" ".join(texts).split())
    return own, bool(own) and prose, inner, content


def skeleton(node: Node, skip: bool = False, content: bool = False) -> list:
    """[tag, mark, hash of own text, length of own text, skipped, children, prose]"""
    own, prose, inner, content = own_text(node, content)
    skip = skip or node.skip
    return [node.tag, node.mark, text_hash(own) if own else "", len(own), int(skip),
            [skeleton(c, skip, content) for c in inner], int(prose)]


def text_hash(own: str) -> str:
    return hashlib.blake2b(own.encode("utf-8", "surrogatepass"), digest_size=6).hexdigest()


def match(a: list, b: list) -> tuple[int, list]:
    """Simple tree matching of two skeletons with equal tags: (size, pairs of
    nodes). Children match in order; equal ends are matched first, runs of
    leaves of one tag one to one, and what remains by dynamic programming."""
    x, y = a[5], b[5]
    size, pairs = 1, [(a, b)]
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    same = list(zip(x[:head], y[:head])) + list(zip(x[len(x) - tail:], y[len(y) - tail:]))
    x, y = x[head:len(x) - tail], y[head:len(y) - tail]
    if x and y and len({n[0] for n in x} | {n[0] for n in y}) == 1 and not any(n[5] for n in x + y):
        same += list(zip(x, y))
        x = y = []
    for p, q in same:
        s, more = match(p, q) if p[5] or q[5] else (1, [(p, q)])
        size += s
        pairs += more
    if x and y:
        got = {(i, j): match(p, q) for i, p in enumerate(x) for j, q in enumerate(y) if p[0] == q[0]}
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(1, len(x) + 1):
            for j in range(1, len(y) + 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1],
                                 best[i - 1][j - 1] + got.get((i - 1, j - 1), (0,))[0])
        i, j = len(x), len(y)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                pairs += got[i - 1, j - 1][1]
                i, j = i - 1, j - 1
        size += best[len(x)][len(y)]
    return size, pairs


def outermost(paths) -> str:
    """The paths that lie in no other one, one a line."""
    out: list[str] = []
    for p in sorted(set(paths)):
        if not any(p.startswith(q + " ") for q in out):
            out.append(p)
    return "\n".join(out)


def vote(page: list, reference: list) -> str:
    """The page's slot: the paths (marks, outermost first) of the containers that together hold all of its
    varying text; empty when nothing varies."""
    constant = {id(p) for p, q in match(page, reference)[1] if p[2] == q[2]}
    return outermost(at for n, _, at in texts_of(page) if n[6] and id(n) not in constant)


def texts_of(node: list, tags: str = "", path: str = "", at: str = "") -> Iterator[tuple[list, str, str]]:
    """(node, tag path, path of its container) of the nodes with own text outside of boilerplate."""
    if node[4]:
        return
    tags, path = f"{tags} {node[0]}".lstrip(), f"{path} {node[1]}".lstrip()
    at = path if node[0] in SLOTS or not at else at
    if node[3]:
        yield node, tags, at
    for c in node[5]:
        yield from texts_of(c, tags, path, at)


def _at_paths(root: Node, slot: str) -> list[Node]:
    """Nodes at a slot's paths, outermost ones, in page order."""
    paths, out = set(slot.split("\n")), []

    def walk(n: Node, path: str) -> None:
        if path in paths:
            out.append(n)
        elif any(p.startswith(path + " ") for p in paths):
            for c in _elements(n):
                if not c.skip:
                    walk(c, f"{path} {c.mark}")
    walk(root, root.mark)
    return out


def _elements(node: Node) -> list[Node]:
    """Child elements, those of inline children included, as in a skeleton."""
    return [x for c in node.children if not isinstance(c, str)
            for x in (_elements(c) if c.tag in INLINE and not c.skip else [c])]


def _first(node: Node, tag: str) -> list[Node]:
    """Outermost elements with a tag, in page order, outside of boilerplate."""
    if node.tag == tag and not node.flat:
        return [node]
    return [x for c in node.children if not isinstance(c, str) and not c.skip for x in _first(c, tag)]


def _varying(root: Node, constant: frozenset) -> list[Node]:
    """Outermost containers that hold the page's varying prose, in page order;
    nodes whose own text is constant on the host are marked."""
    found: set[int] = set()

    def look(n: Node, tags: str, at: Node | None, content: bool) -> None:
        if n.skip:
            return
        tags = f"{tags} {n.tag}".lstrip()
        at = n if n.tag in SLOTS or at is None else at
        own, prose, inner, content = own_text(n, content)
        if own:
            n.constant = f"{tags} {text_hash(own)}" in constant
            if prose and not n.constant:
                found.add(id(at))
        for c in inner:
            look(c, tags, at, content)

    def outer(n: Node) -> list[Node]:
        return [n] if id(n) in found else [x for c in _elements(n) for x in outer(c)]
    look(root, "", None, False)
    return outer(root) if found else []


def blocks(node: Node) -> list[str]:
    """Texts of the blocks that are neither boilerplate nor constant."""
    out, current = [], []

    def walk(n: Node, constant: bool) -> None:
        for c in n.children:
            if isinstance(c, str):
                if not constant:
                    current.append(c)
            elif c.skip:
                current.append(" " if c.tag not in INLINE else "")
            elif c.tag == "br":
                current.append(" ")
            elif c.tag in INLINE:
                walk(c, constant)
            else:
                flush()
                walk(c, c.constant)
                flush()

    def flush() -> None:
        text = " ".join("".join(current).split())
        current.clear()
        if text:
            out.append(text)
    walk(node, node.constant)
    flush()
    return out


@functools.lru_cache(256)
def _lines(text: str) -> frozenset:
    return frozenset(text.split("\n"))


def main_text(html: str | None, slot: str | None, constant: str | None = None) -> str:
    """``constant``: the host's template texts, one "tags hash" a line; None when
    its pages are too few to tell."""
    if not html:
        return ""
    root = Tree(html).root
    nodes = _varying(root, _lines(constant)) if constant is not None else []
    if not nodes:
        nodes = _at_paths(root, slot) if slot else []
    if not nodes:
        nodes = _first(root, "article") or _first(root, "main") or _first(root, "body") or [root]
    return " ".join(b for n in nodes for b in blocks(n))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def _salt(page_id: Column) -> Column:
    return F.pmod(F.xxhash64(page_id), F.lit(SALTS)).cast("int")


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(host, slot, constant) from all different pages of (page_id, url, html):
    the commonest slot, and the texts that most pages hold at one tag path
    (null for hosts of fewer than ``EVIDENCE`` different pages)."""
    def bones(batches):
        for pdf in batches:
            trees = [json.dumps(skeleton(Tree(h).root), separators=(",", ":")) if h else None for h in pdf["html"]]
            yield pdf[["host"]].assign(bones=trees)
    keyed = pages.select(host_of(F.col("url")).alias("host"), "html").where("host <> ''")
    rows = stored(keyed.mapInPandas(bones, "host string, bones string").where("bones IS NOT NULL").distinct(),
                  "wrapper-bones").withColumn("hash", F.xxhash64("bones")).withColumn(
        "salt", F.pmod("hash", F.lit(SALTS)).cast("int"))
    # One page by hash in each of ``SAMPLES`` parts, of these the one of median size.
    size = F.struct(F.length("bones").alias("n"), "bones")
    reference = rows.groupBy("host", F.pmod(F.shiftright("hash", 8), F.lit(SAMPLES)).alias("part")).agg(
        F.min_by(size, F.struct("hash", "bones")).alias("one")).groupBy("host").agg(
        F.sort_array(F.collect_list("one")).alias("some")).select(
        "host", F.expr("some[cast((size(some) - 1) / 2 AS int)].bones").alias("ref"))

    def count(batches):
        held: Counter = Counter()
        loaded = functools.lru_cache(SAMPLES)(json.loads)  # a host's pages come together

        def out():
            rows = [(*k, n) for k, n in held.items()]
            held.clear()
            return pd.DataFrame(rows, columns=["host", "slot", "at", "n"])
        for pdf in batches:
            for host, b, r in zip(pdf["host"], pdf["bones"], pdf["ref"]):
                page = json.loads(b)
                held[host, vote(page, loaded(r)), None] += 1
                held.update({(host, None, f"{tags} {n[2]}") for n, tags, _ in texts_of(page)})
                if len(held) > FLUSH:
                    yield out()
        yield out()
    counted = stored(rows.join(_salted(reference), ["host", "salt"]).select("host", "bones", "ref").mapInPandas(
        count, "host string, slot string, at string, n long"), "wrapper-counts")
    per_slot = counted.where("slot IS NOT NULL").groupBy("host", "slot").agg(F.sum("n").alias("n"))
    hosts = per_slot.groupBy("host").agg(
        F.max_by("slot", F.when(F.col("slot") != "", F.struct("n", "slot"))).alias("slot"),
        F.sum("n").alias("pages"))
    held = counted.where("at IS NOT NULL").groupBy("host", "at").agg(F.sum("n").alias("n")).where(
        F.col("n") >= EVIDENCE)
    constant = held.join(hosts.select("host", "pages"), "host").where("n * 2 > pages").groupBy("host").agg(
        F.array_join(F.sort_array(F.collect_list("at")), "\n").alias("at"))
    return hosts.join(constant, "host", "left").select("host", "slot", F.when(
        F.col("pages") >= EVIDENCE, F.coalesce("at", F.lit(""))).alias("constant"))


def host_slots(pages: DataFrame) -> DataFrame:
    """(host, slot) of the hosts with a slot."""
    return host_wrappers(pages).where("slot IS NOT NULL").select("host", "slot")


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    wrappers = _salted(stored(host_wrappers(pages), "wrappers"))
    keyed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).withColumn(
        "salt", _salt(F.col("page_id")))
    joined = keyed.join(wrappers.hint("shuffle_hash"), ["host", "salt"], "left").select(
        "page_id", "url", "html", "slot", "constant")

    def run(batches):
        for pdf in batches:
            texts = [main_text(*x) for x in zip(pdf["html"], pdf["slot"], pdf["constant"])]
            yield pdf[["page_id", "url"]].assign(page_id=pdf["page_id"].astype("Int64"), text=texts,
                                                 n_chars=[len(t) for t in texts])
    return joined.mapInPandas(run, "page_id long, url string, text string, n_chars long")

"""Main text of web pages by wrapper induction.

The pages of a host share templates. One page of each layout of a host stands for it (a layout
is the set of its containers), and their trees together, joined where labels agree, are the
tree of the host. The tree of every page is aligned with it by simple tree matching: two nodes
match if their labels do, and their children are matched in order so that most nodes pair up.
Nodes whose text is the same on nearly all pages are template, nodes whose text varies are slots.
The counts behind this are sums over all pages of the host. The slot that holds the main
content is where most varying text lies, apart from parts whose label says what they are
(menus, headers, footers, sidebars, notices, adverts, forms, comments).

Children with equal labels are one node, as the paragraphs of an article are, so that their
number does not matter. Such a node also keeps a digest of each of its blocks: a block that
nearly all pages repeat there is template, though blocks beside it vary.

A page whose own tree has no match for the host's content slot, or whose host has no other
page, is judged by its own tree. Below the content slot labelled parts and template nodes are dropped;
in an ``article`` or ``main`` element only whole blocks of the very text of the template, and only if
the content differs on enough pages of the host.

Defined cases: NULL, empty or text-less html gives an empty text; a NULL url is a host of its
own; NULL page_id and repeated rows are extracted each for itself; an empty table gives no
rows; other columns are ignored. Quotes part attributes only behind an equals sign, and once a
tag has no end outside of its quotes, it and those behind it end at the next bracket.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from html import unescape
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.files import stage, table

#: Elements and words in class, id and role that mark what is not main content.
PARTS = set(
    "nav header footer aside form menu dialog button select option textarea label fieldset".split()
)
NO_TEXT = set("head script style noscript template iframe object svg canvas audio video map datalist".split())
WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored banner promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice notices popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social comment comments disqus reply replies "
    "respond related recommended recommendations widget toolbar pagination pager skip search contentinfo complementary "
    "dialog alert form".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noframes"}
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody "
    "td tfoot th thead title tr ul".split()
)
CONTAINERS = set("html body div section article main table tbody tr td center ul ol dl figure #root".split())
MAIN = {"article", "main"}
#: Elements that no word of class, id or role makes a part.
NEVER = {"html", "body", *MAIN}
BY_WORD = 2
#: A new element of these kinds ends an open one of the kinds beside it.
ENDS_P = BLOCKS - {"br", "option", "legend", "caption", "tbody", "td", "th", "tr", "tfoot", "thead", "title", "body", "html"}
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES = {name: ({"p"} if name in ENDS_P else set()) | ENDS.get(name, set()) for name in ENDS_P | set(ENDS)}
SCOPE = {"ul", "ol", "dl", "table", "select", "div", "section", "article", "main", "body"}

#: The rest of a tag up to its end; nothing is tried twice, so it takes one walk whatever the page holds.
TAG = re.compile(r"""(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+)>""", re.S)
LOOSE_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NUMBER = re.compile(r"\d+")

SAME_SHARE, MOST, EVIDENCE = 0.9, 0.8, 4


class Node:
    __slots__ = ("tag", "label", "part", "heads", "children", "texts", "mark")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children, self.texts, self.mark = tag, [], [], ""
        self.label, self.part, self.heads = (names_of if len(attributes) < 200 else names_of.__wrapped__)(tag, attributes)


@lru_cache(10_000)
def names_of(tag: str, attributes: str) -> tuple[str, bool | int, bool]:
    """The label of an element, whether it is a labelled part, and whether it is called a header."""
    found = {k.lower(): v.strip("\"'") for k, v in reversed(ATTRIBUTE.findall(attributes))} if attributes else {}
    names = " ".join(found.get(k, "") for k in ("class", "id", "role")).lower()
    label = f"{tag}.{NUMBER.sub('#', '.'.join(names.split()))}" if names.strip() else tag
    words = set(re.split(r"[^a-z]+", names)) if names and tag not in NEVER else set()
    unseen = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    # True for what an element or attribute says, BY_WORD for what a word says; the host's counts can lift the latter.
    part = True if tag in PARTS or unseen else BY_WORD if words & WORDS or "header" in words else False
    return label, part, part == BY_WORD and not words & WORDS


class Open:
    """The open elements, and where those of each kind are, so that an end tag finds its element at once."""

    def __init__(self, root: Node):
        self.stack, self.places = [root], defaultdict(list)

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.stack))
        self.stack.append(node)

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.places[self.stack.pop().tag].pop()

    def last(self, tags: set[str]) -> int:
        best, places = 0, self.places
        for tag in tags:
            if tag in places and (at := places[tag]) and at[-1] > best:
                best = at[-1]
        return best


def parse(html: str, texts: bool = True) -> Node:
    """The tree of a page. Any input gives a tree: open elements end where they must. Without ``texts`` only its elements."""
    root = Node("#root")
    found, at, loose = Open(root), 0, False
    text: list[str] = []

    def flush() -> None:
        joined = text[0] if len(text) == 1 else "".join(text)
        text.clear()
        if joined and texts:
            found.stack[-1].children.append(unescape(joined) if "&" in joined else joined)

    while at < len(html):
        start = html.find("<", at)
        if start < 0:
            text.append(html[at:])
            break
        text.append(html[at:start])
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(html)
            flush()
            continue
        if html.startswith(("<!", "<?"), start):
            end = html.find(">", start)
            at = end + 1 if end >= 0 else len(html)
            flush()
            continue
        tag = None if loose else TAG.match(html, start + 1)
        if tag is None and (tag := LOOSE_TAG.match(html, start + 1)):
            loose = True
        if tag is None:
            text.append("<")
            at = start + 1
            continue
        flush()
        at = tag.end()
        name = tag[2].lower()
        if tag[1]:
            if name in found.places and (places := found.places[name]):
                found.cut(places[-1])
            continue
        if name in CLOSES and (depth := found.last(CLOSES[name])) and depth >= found.last(SCOPE):
            found.cut(depth)
        node = Node(name, tag[3] or "")
        if (node.tag == "header" or node.heads) and found.last(MAIN):
            node.part = False  # the head of an article, not of the page
        found.stack[-1].children.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}\b", re.I).search(html, at)
            stop = end.start() if end else len(html)
            if texts and name in ("title", "textarea"):
                node.children.append(unescape(html[at:stop]))
            close = html.find(">", stop)
            at = close + 1 if end and close >= 0 else len(html)
        elif name not in VOID and not (tag[3] or "").rstrip().endswith("/"):
            found.push(node)
    if text:
        flush()
    return root


def mark_blocks(root: Node) -> None:
    """The texts of each node, and a digest of all text below it, empty where there is none."""
    order = [root]
    for node in order:
        order.extend(c for c in node.children if not isinstance(c, str) and c.tag not in NO_TEXT)
    for node in reversed(order):
        parts = []
        for child in node.children:
            if isinstance(child, str):
                if text := " ".join(child.split()):
                    node.texts.append(text)
                    parts.append(text)
            elif child.mark:
                parts.append(f"{child.label}\x00{child.mark}")
        if parts:
            node.mark = blake2b("\x01".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


class Summary:
    """Nodes with one path of labels, their own text, and their children by label in order."""

    __slots__ = ("label", "tag", "part", "texts", "chars", "links", "children", "blocks")

    def __init__(self, label: str, tag: str, part: bool):
        self.label, self.tag, self.part = label, tag, part
        self.texts, self.chars, self.links, self.children, self.blocks = [], 0, 0, {}, []


def summarize(nodes: list[Node]) -> Summary:
    out = Summary(nodes[0].label, nodes[0].tag, nodes[0].part)
    todo = [(out, nodes, False)]
    while todo:
        at, members, linked = todo.pop()
        below: dict[str, list[Node]] = {}
        for member in members:
            if member.texts:
                at.texts += member.texts
                chars = sum(map(len, member.texts))
                at.chars += chars
                at.links += chars * linked
            for child in member.children:
                if not isinstance(child, str) and child.tag not in NO_TEXT and child.tag not in VOID:
                    below.setdefault(child.label, []).append(child)
        for label, kids in below.items():
            at.children[label] = Summary(label, kids[0].tag, kids[0].part)
            if kids[0].tag in BLOCKS:
                at.children[label].blocks = sorted({k.mark for k in kids if k.mark})
            todo.append((at.children[label], kids, linked or kids[0].tag == "a"))
    return out


def skeleton(summary: Summary) -> list:
    """label, tag, part, digest of the text, children, digests of blocks: what a page is aligned with."""
    mark = blake2b("\n".join(summary.texts).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest() if summary.texts else ""
    return [summary.label, summary.tag, summary.part, mark, [skeleton(c) for c in summary.children.values()], summary.blocks]


def absorb(tree: list, other: list) -> None:
    """Add to a tree what another one of the same root has besides, behind the sibling it follows there."""
    at = {c[0]: i for i, c in enumerate(tree[4])}
    behind: dict[int, list] = defaultdict(list)
    place = -1
    for child in other[4]:
        if child[0] in at:
            place = at[child[0]]
            absorb(tree[4][place], child)
        else:
            behind[place].append(child)
    tree[4] = behind[-1] + [c for i, kept in enumerate(tree[4]) for c in (kept, *behind[i])]
    tree[5] = sorted({*tree[5], *other[5]})


def match(a: list, b: list, memo: dict) -> int:
    """The number of pairs in the best alignment of two trees (simple tree matching)."""
    if a[0] != b[0]:
        return 0
    key = (id(a), id(b))
    if key not in memo:
        memo[key] = 1 + sum(match(x, y, memo) for x, y in best_pairs(a, b, memo))
    return memo[key]


def best_pairs(a: list, b: list, memo: dict) -> list[tuple[list, list]]:
    """The children that pair up in the best alignment of two nodes.

    Labels differ among siblings, so each child has one partner at most, and the best
    alignment is the heaviest run of partners in increasing order. Prefix maxima in a binary
    indexed tree find it in k log k steps; where no partners cross, all of them pair up.
    """
    at = {c[0]: j for j, c in enumerate(b[4])}
    found = [(at[c[0]], c) for c in a[4] if c[0] in at]
    if all(x[0] < y[0] for x, y in zip(found, found[1:])):
        return [(c, b[4][j]) for j, c in found]
    top = [(0, -1)] * (len(b[4]) + 1)  # weight of the best run that ends before a place, and its last member
    before = []
    for n, (j, child) in enumerate(found):
        best, i = (0, -1), j
        while i > 0:
            best, i = max(best, top[i], key=lambda t: t[0]), i & (i - 1)
        before.append(best[1])
        weight, i = best[0] + match(child, b[4][j], memo), j + 1
        while i < len(top):
            if weight > top[i][0]:
                top[i] = (weight, n)
            i += i & -i
    best, i = (0, -1), len(b[4])
    while i > 0:
        best, i = max(best, top[i], key=lambda t: t[0]), i & (i - 1)
    run, n = [], best[1]
    while n >= 0:
        j, child = found[n]
        run.append((child, b[4][j]))
        n = before[n]
    return run[::-1]


def align(a: list, b: list) -> list[tuple[str, list, str, list]]:
    """The pairs of the best alignment, as (path, node, path, node)."""
    memo: dict = {}
    pairs, todo = [], [(a[0], a, b[0], b)] if a[0] == b[0] else []
    while todo:
        path_a, x, path_b, y = todo.pop()
        pairs.append((path_a, x, path_b, y))
        todo.extend((f"{path_a}/{p[0]}", p, f"{path_b}/{q[0]}", q) for p, q in best_pairs(x, y, memo))
    return pairs


def total_chars(node: list, path: str, chars: dict[str, float]) -> float:
    if node[2] or node[1] in NO_TEXT:
        return 0.0
    return chars.get(path, 0.0) + sum(total_chars(c, f"{path}/{c[0]}", chars) for c in node[4])


def lifted(tree: list, chars: dict[str, float]) -> list[str]:
    """Labels of nodes that a word makes a part, but that hold most of the varying text of the host."""
    sums: list[tuple[str, float]] = []

    def add(node: list, path: str) -> float:
        if node[2] is True or node[1] in NO_TEXT:
            return 0.0
        held = chars.get(path, 0.0) + sum(add(c, f"{path}/{c[0]}") for c in node[4])
        sums.append((node[0], held))
        return held

    most = MOST * add(tree, tree[0])
    return sorted({label for label, held in sums if held >= most > 0})


def lift(tree: list, labels: set[str]) -> None:
    if tree[2] == BY_WORD and tree[0] in labels:
        tree[2] = False
    for child in tree[4]:
        lift(child, labels)


def whole_blocks(tree: list, equal: set[str]) -> set[str]:
    """The nodes of blocks all of whose text is in equal nodes; words within a sentence stay."""
    out: set[str] = set()

    def walk(node: list, path: str) -> tuple[bool, list[str]]:
        below = [walk(c, f"{path}/{c[0]}") for c in node[4]]
        paths = [path, *(p for _, ps in below for p in ps)]
        all_equal = (not node[3] or path in equal) and all(e for e, _ in below)
        if all_equal and node[1] in BLOCKS:
            out.update(paths)
            paths = []
        return all_equal, paths if all_equal else []

    walk(tree, tree[0])
    return out


def content_path(tree: list, chars: dict[str, float]) -> str:
    """The path below which most of the given characters lie, apart from labelled parts."""

    def total(node: list, path: str) -> float:
        return total_chars(node, path, chars)

    def has_main(node: list, path: str) -> float:
        if node[2]:
            return 0.0
        if node[1] in MAIN:
            return total(node, path)
        return sum(has_main(c, f"{path}/{c[0]}") for c in node[4])

    node, path = tree, tree[0]
    while node[1] not in MAIN:
        below = [(has_main(c, f"{path}/{c[0]}"), total(c, f"{path}/{c[0]}"), c) for c in node[4]]
        best = max(below, key=lambda x: x[:2], default=(0.0, 0.0, None))
        inside = best[0] > 0 or (best[2] is not None and best[2][1] in CONTAINERS and best[1] > 0 and best[1] >= MOST * total(node, path))
        if not inside:
            break
        node, path = best[2], f"{path}/{best[2][0]}"
    return path


def own_chars(summary: Summary, path: str | None = None) -> dict[str, float]:
    path = path or summary.label
    out = {path: float(summary.chars - summary.links)}
    for child in summary.children.values():
        out.update(own_chars(child, f"{path}/{child.label}"))
    return out


def collect(root: Node, content: str, dropped: set[str], constant: dict[str, set[str]] | None = None) -> str:
    """The text below every node of the content path, blocks parted by one space."""
    out: list[str] = []
    constant = constant or {}

    def walk(node: Node, path: str, inside: bool) -> None:
        if node.tag in NO_TEXT or (node.part and path != content) or (path in constant and node.mark in constant[path]):
            return
        inside = inside or path == content
        block = node.tag in BLOCKS
        if inside and block:
            out.append(" ")
        for child in node.children:
            if not isinstance(child, str):
                walk(child, f"{path}/{child.label}", inside)
            elif inside and path not in dropped:
                out.append(child)
        if inside and block:
            out.append(" ")

    walk(root, root.label, False)
    return " ".join("".join(out).split())


def deep(function):
    """Run with room for trees as deep as their input."""

    def run(*args):
        import sys

        if sys.getrecursionlimit() < 20_000:
            sys.setrecursionlimit(20_000)
        return function(*args)

    return run


MAX_DEPTH = 2_000


def tree_of(html: str | None, labels: set[str] = frozenset()) -> tuple[Node, Summary]:
    root = parse(html or "")
    todo = [root] if labels else []
    while todo:
        node = todo.pop()
        if node.part is not True and node.label in labels:
            node.part = False
        todo.extend(c for c in node.children if not isinstance(c, str))
    flatten(root)
    mark_blocks(root)
    return root, summarize([root])


def flatten(root: Node) -> None:
    """Lift what lies deeper than ``MAX_DEPTH`` elements up to that depth; no text is lost."""
    todo = [(root, 0)]
    while todo:
        node, depth = todo.pop()
        if depth >= MAX_DEPTH:
            flat, below = [], node.children[::-1]
            while below:
                child = below.pop()
                if isinstance(child, str):
                    flat.append(child)
                elif child.tag not in NO_TEXT and not child.part:
                    below.extend([" ", *child.children[::-1]] if child.tag in BLOCKS else child.children[::-1])
            node.children = flat
        else:
            todo.extend((c, depth + 1) for c in node.children if not isinstance(c, str))


@deep
def extract(html: str | None, wrapper: dict | None) -> str:
    root, summary = tree_of(html, set(wrapper["lifted"]) if wrapper else set())
    tree = skeleton(summary)
    content, dropped, equal, constant = None, set(), set(), {}
    if wrapper:
        for path, node, of_host, other in align(tree, wrapper["tree"]):
            if of_host == wrapper["content"]:
                content, main = path, node[1] in MAIN
            elif of_host in wrapper["template"]:
                dropped.add(path)
            # In a main element a node is dropped only if it is a block of the very text of the template.
            if of_host in wrapper["template"] and node[3] == other[3]:
                equal.add(path)
            if of_host in wrapper["constant"]:
                constant[path] = wrapper["constant"][of_host]
        if content is not None and main:
            dropped = whole_blocks(tree, equal) if wrapper["varies"] else set()
            constant = {}
        elif not wrapper["varies"]:
            constant = {}
    if content is None:
        content, dropped, constant = content_path(tree, own_chars(summary)), set(), {}
    text = collect(root, content, dropped, constant)
    # Where all text of the page is links, links are its content.
    if not text and content_path(tree, {}) == content:
        return text
    return text or collect(root, content_path(tree, own_chars(summary)), set())


@deep
def counts_of(html: str, tree: list) -> list[tuple[str, str, int, int, int]]:
    """For every node of the host's tree that the page matches: path, '', 1, same text or not, characters;
    for every block that the page repeats there: path, digest, 0, 1, 0."""
    _, summary = tree_of(html)
    chars = own_chars(summary)
    out = []
    for path, node, of_host, other in align(skeleton(summary), tree):
        out.append((of_host, "", 1, int(node[3] == other[3]), int(chars[path])))
        if node[5] and other[5]:
            out.extend((of_host, mark, 0, 1, 0) for mark in set(node[5]).intersection(other[5]))
    return out


def layout_of(html: str) -> bytes:
    """A digest of the containers of a page: their paths, without what a text is made of."""
    paths, todo = [], [("#root", [parse(html, texts=False)], 0)]
    while todo:
        path, nodes, depth = todo.pop()
        paths.append(path)
        below: dict[str, list[Node]] = {}
        for node in nodes if depth < MAX_DEPTH else ():
            for child in node.children:
                if (child.tag in CONTAINERS or child.tag in PARTS) and child.tag not in NO_TEXT:
                    below.setdefault(child.label, []).append(child)
        todo.extend((f"{path}/{label}", kids, depth + 1) for label, kids in below.items())
    return blake2b("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"), digest_size=16).digest()


@deep
def page_tree(html: str) -> list:
    return skeleton(tree_of(html)[1])


@deep
def tree_of_host(trees: Iterator[list]) -> list:
    """The trees of one page of each layout as one."""
    whole = next(trees)
    for tree in trees:
        absorb(whole, tree)
    return whole


@deep
def wrapper_of(tree: str, nodes: list[dict]) -> str:
    """The host's wrapper: its tree, the path of its content slot, the paths and blocks of its template."""
    parsed = json.loads(tree)
    blocks = [n for n in nodes if n["mark"]]
    nodes = [n for n in nodes if not n["mark"]]
    fixed = {n["path"] for n in nodes if n["n"] >= EVIDENCE and n["same"] >= SAME_SHARE * n["n"]}
    seen = {n["path"]: n["n"] for n in nodes}
    constant: dict[str, list[str]] = defaultdict(list)
    for b in sorted(blocks, key=lambda b: (b["path"], b["mark"])):
        if seen[b["path"]] >= EVIDENCE and b["same"] >= SAME_SHARE * seen[b["path"]]:
            constant[b["path"]].append(b["mark"])
    chars = {n["path"]: float(n["chars"]) for n in nodes if n["path"] not in fixed}
    labels = lifted(parsed, chars)
    lift(parsed, set(labels))
    # Where only parts vary, as on copies of one page, each page is judged by its own tree.
    content = content_path(parsed, chars) if total_chars(parsed, parsed[0], chars) else None
    # Few distinct texts, as copies with other menus have, tell nothing about what is template in the content.
    varies = any(n["n"] - n["same"] >= EVIDENCE and f"{n['path']}/".startswith(f"{content}/") for n in nodes)
    bare(parsed)
    return json.dumps({"tree": parsed, "content": content, "template": sorted(fixed), "constant": constant, "varies": varies, "lifted": labels})


def bare(tree: list) -> None:
    """Without the digests of blocks, which the wrapper holds where they are template."""
    todo = [tree]
    while todo:
        node = todo.pop()
        node[5] = []
        todo.extend(node[4])


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))


def induce(pages: DataFrame) -> DataFrame:
    """The wrapper of each host that has several pages, as (host, wrapper)."""
    named = pages.where("page_id is not null and html <> ''")

    def layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([layout_of(h) for h in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], ["host", "page_id", "layout"])

    kinds = named.select("host", "page_id", "html").mapInArrow(layouts, "host string, page_id long, layout binary")
    first = kinds.groupBy("host", "layout").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("page_id"))
    first = stage(first.groupBy("host", "page_id").agg(F.max("n").alias("n")), "host_pages")

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come host by host, the commonest layout first; one tree is held at a time.
        def rows() -> Iterator[tuple[str, str]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        for host, group in groupby(rows(), key=lambda r: r[0]):
            marks: list[str] = []

            def of_pages(group=group, marks=marks) -> Iterator[list]:
                for _, html in group:
                    marks.append(mark_of(html))
                    yield page_tree(html)

            tree = tree_of_host(of_pages())
            yield pa.RecordBatch.from_arrays(
                [pa.array([host]), pa.array([json.dumps(tree)], pa.string()), pa.array([marks], pa.list_(pa.string()))], ["host", "tree", "marks"]
            )

    chosen = named.join(first, ["host", "page_id"]).groupBy("host", "page_id").agg(F.max("n").alias("n"), F.min("html").alias("html"))
    by_host = chosen.repartition("host").sortWithinPartitions("host", F.desc("n"), "page_id").select("host", "html")
    refs = stage(by_host.mapInArrow(trees, "host string, tree string, marks array<string>"), "host_trees")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[list, set[str]]] = {}
        sums: dict[tuple[str, str, str], list[int]] = defaultdict(lambda: [0, 0, 0])
        for batch in batches:
            for host, html, tree, marks in zip(*[c.to_pylist() for c in batch.columns]):
                if host not in known:
                    known = known if len(known) < 1000 else {}
                    known[host] = (json.loads(tree), set(marks))
                if mark_of(html) in known[host][1]:
                    continue  # a copy of a page that the tree was made from tells nothing about what varies
                for path, block, n, same, chars in counts_of(html, known[host][0]):
                    s = sums[host, path, block]
                    s[0] += n
                    s[1] += same
                    s[2] += chars
            if len(sums) > 100_000:
                yield flushed(sums)
                sums.clear()
        if sums:
            yield flushed(sums)

    rows = pages.where("html <> ''").select("host", "html").join(refs, "host")
    nodes = rows.mapInArrow(counts, "host string, path string, mark string, n long, same long, chars long").groupBy("host", "path", "mark").agg(
        F.sum("n").alias("n"), F.sum("same").alias("same"), F.sum("chars").alias("chars")
    )

    def wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [wrapper_of(t, n) for t, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["host", "wrapper"])

    # A host has as many nodes and blocks as its one tree.
    per_host = nodes.groupBy("host").agg(F.collect_list(F.struct("path", "mark", "n", "same", "chars")).alias("nodes"))
    return stage(refs.join(per_host, "host").select("host", "tree", "nodes").mapInArrow(wrappers, "host string, wrapper string"), "wrappers")


def mark_of(html: str) -> str:
    return blake2b(html.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def flushed(sums: dict[tuple[str, str, str], list[int]]) -> pa.RecordBatch:
    rows = [(*key, *s) for key, s in sums.items()]
    return pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], ["host", "path", "mark", "n", "same", "chars"])


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    pages = with_host(pages)
    wrappers = induce(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for html, wrapper in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if wrapper is not None and wrapper not in known:
                    known = known if len(known) < 1000 else {}
                    known[wrapper] = json.loads(wrapper)
                    known[wrapper]["template"] = set(known[wrapper]["template"])
                    known[wrapper]["constant"] = {p: set(m) for p, m in known[wrapper]["constant"].items()}
                texts.append(extract(html, known[wrapper] if wrapper is not None else None))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))

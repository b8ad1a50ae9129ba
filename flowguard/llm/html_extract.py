"""Main text of web pages with a site style tree.

1. Every page is parsed into a DOM. All DOMs of one host are merged: an element is known by its
   path of labels (tag and class), whatever its place among its siblings.
2. Per host and path the pages are counted by presentation style (the sequence of child labels, runs
   taken once) and by content (each text standing directly in the element); these counts are partial
   sums, so a host with a third of all pages is no hot group.
3. Importance: a leaf's is 1 - the mean entropy of its contents over the pages (base: number of
   pages), so what every page repeats has 0 and what one page has alone has 1; an inner element's is
   the entropy of its styles, mixed with its children's importance (weight GAMMA to the number of
   styles). An element that one page alone has is important. Few pages prove little: ``DOUBT`` / pages
   is added, so what a whole host of two pages repeats can go outside the main content, and inside it
   only from eight pages on, without a step at any number.
4. Per page, branches of low importance are removed: outside the main content below ``NEUTRAL``;
   inside it only what practically every page of the host repeats (``INSIDE``), and nothing where that
   would leave less than half of the blocks (pages that are copies of each other). Pages get the
   removable paths of their host, not its tree.

Entropy can't tell an advert drawn from a pool from an article (both differ from page to page), so
the tree is joined by the standard's own roles: navigation, footers, asides, forms, scripts and
elements whose class, id or role names such a part (lists below) have importance 0. Words that also
name ordinary sections (``DOUBTFUL``) only raise the limit inside the main content, to ``DOUBTED``:
such a branch goes when the tree finds it repeated or when it is mostly links. Ids of headings are
made from their text and aren't read. Main content is the outermost ``article`` elements, else
``main``, else the body.

Text: character references decoded, white space inside a block one space, trimmed, blocks joined by
a newline. Cases: null or empty html gives an empty text; broken markup is closed the way browsers
do for these elements, nested to any depth; a page without a host shares the tree of all pages
without one; repeated rows stay rows (and count as pages of the host: copies without a main element
keep what differs, or everything if nothing does); extra columns aren't read.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from flowguard.llm.common import ready, store

GAMMA = 0.9
NEUTRAL, INSIDE, DOUBTED = 0.3, 0.02, 0.6
#: Added to an importance, divided by the pages that have the element.
DOUBT = 0.15
#: Removable paths up to which the table of all hosts is broadcast (16 bytes each).
BROADCAST_NODES = 200_000

# fixed values: element names of the HTML standard by their part in parsing
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body html tbody td tfoot th thead tr option optgroup legend".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"}, "thead": {"tbody", "thead", "tfoot"}, "tfoot": {"tbody", "thead", "tfoot", "tr", "td", "th"}}
SCOPE = frozenset("html body table td th caption button object marquee template ul ol dl select article section main div".split())
P_SCOPE = frozenset("html table td th caption button object marquee template".split())
# fixed values: elements that never hold an article's text
NEVER = frozenset("head script style noscript template nav footer aside form iframe svg math canvas button select textarea input object embed audio video dialog menu noembed noframes datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar status".split())
# fixed values: words of a class or id that name a part beside the article
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promos cookie cookies consent gdpr notice notices notification notifications popup modal newsletter subscribe subscription nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer footers masthead topbar toolbar widget widgets comment comments commentlist disqus share sharing social pagination pager login signup signin searchform copyright disclaimer paywall tagcloud".split()
)
#: Words that name such a part too, but ordinary sections as well.
DOUBTFUL = frozenset("aside foot reply replies respond discussion related recommended recommendations register search legal tags promotion banner banners skip overlay".split())
#: These name a page's head outside the main content only.
HEADS = frozenset("header head heading top".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
HEADING = re.compile("h[1-6]")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Node:
    """An element: tag, attributes of interest, children (elements and strings)."""

    __slots__ = ("tag", "names", "role", "hidden", "kids", "path")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.kids, self.path = tag, [], 0
        self.names, self.role, self.hidden = "", "", False
        if attributes and "=" in attributes or "hidden" in attributes:
            names = []
            for m in ATTRIBUTE.finditer(attributes):
                key = m[1].lower()
                value = m[2] or m[3] or m[4] or ""
                if key == "class" or key == "id" and not HEADING.fullmatch(tag):
                    names.append(re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower())
                elif key == "role":
                    self.role = value.strip().lower()
                elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    self.hidden = True
            self.names = " ".join(names)


def parse(page: str) -> Node:
    """The DOM of a page."""
    root = Node("html")
    stack = [root]
    opened: Counter[str] = Counter()
    at, end = 0, len(page)

    def cut(k: int) -> None:
        opened.subtract(node.tag for node in stack[k:])
        del stack[k:]

    def close(tags, scope) -> None:
        """Close the open elements of these tags up to the scope, and what is open inside them."""
        if not any(opened[t] for t in tags):
            return
        found = 0
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                found = k
            elif stack[k].tag in scope:
                break
        if found:
            cut(found)

    while at < end:
        m = TOKEN.search(page, at)
        upto = m.start() if m else end
        if upto > at:
            stack[-1].kids.append(page[at:upto])
        if not m:
            break
        at = m.end()
        ending, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])  # the latter: a quote or the tag never ends
        if not tag:
            if m[0].startswith("<![CDATA["):
                stack[-1].kids.append(html_lib.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if ending:
            if opened[tag] > 0:
                cut(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            elif tag == "br":
                stack[-1].kids.append(Node("br"))
            continue
        if tag in ("html", "body"):
            if tag == "body":
                close({"head"}, frozenset())
            continue
        if tag in CLOSES_P:
            close({"p"}, P_SCOPE)
        if tag in SELF_CLOSING:
            close(SELF_CLOSING[tag], SCOPE - SELF_CLOSING[tag])
        if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit() and HEADING.fullmatch(stack[-1].tag):
            cut(len(stack) - 1)
        node = Node(tag, attributes)
        stack[-1].kids.append(node)
        if tag in RAW:
            close_at = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            node.kids.append(page[at : close_at.start() if close_at else end])
            at = close_at.end() if close_at else end
        elif tag not in VOID and not (attributes.endswith("/") and tag in ("svg", "path", "use")):
            stack.append(node)
            opened[tag] += 1
    return root


def label(node: Node) -> str:
    return f"{node.tag}.{node.names}" if node.names else node.tag


def named(node: Node, inside: bool) -> bool:
    """Does the element's own markup say that it isn't part of an article."""
    if node.tag in NEVER or node.hidden or node.role in ROLES or node.tag == "header" and not inside:
        return True
    return any(w in NAMES or not inside and (w in DOUBTFUL or w in HEADS) for w in words_of(node))


def words_of(node: Node) -> list[str]:
    if not node.names or node.tag in ("body", "html", "main"):
        return []
    return re.split(r"[\s_\-:]+", node.names)


def doubtful(node: Node) -> bool:
    """May the element's own names say that it isn't part of an article."""
    return any(w in DOUBTFUL for w in words_of(node))


def mostly_links(node: Node) -> bool:
    """Is more than half of the text below in links."""
    linked = total = 0
    todo: list = [(node, False)]
    while todo:
        x, link = todo.pop()
        for kid in x.kids:
            if not isinstance(kid, str):
                todo.append((kid, link or kid.tag == "a"))
            elif not kid.isspace():
                total += len(kid)
                linked += len(kid) * link
    return 2 * linked > total


def text_of(s: str) -> str:
    return " ".join(html_lib.unescape(s).split()) if s else ""


def path_below(parent: int, node: Node) -> int:
    """The path of labels down to an element, as a hash that goes on from its parent's."""
    return xxh64_intdigest(label(node), parent) >> 1


def site_rows(root: Node) -> dict[tuple[int, int, int, int], None]:
    """Style-tree facts of one page: (path, parent path, kind, value). Kind 0: the page has the
    element; 1: with this sequence of child labels; 2: with this text directly inside."""
    out: dict[tuple[int, int, int, int], None] = {}
    todo = [(root, 0)]
    while todo:
        node, parent = todo.pop()
        path = path_below(parent, node)
        out[path, parent, 0, 0] = None
        style, text = [], []
        for kid in node.kids:
            if isinstance(kid, str):
                text.append(kid)
            elif kid.tag not in NEVER or kid.tag in ("nav", "footer", "aside", "form"):
                k = label(kid)
                if not style or style[-1] != k:
                    style.append(k)
                todo.append((kid, path))
        out[path, parent, 1, xxh64_intdigest("\x01".join(style), 0) >> 1] = None
        content = text_of(" ".join(text))
        if content:
            out[path, parent, 2, xxh64_intdigest(content, 0) >> 1] = None
    return out


class Importance:
    """Importance of a host's elements from ``(path, parent, pages, styles, style_entropy,
    contents, content_entropy)``; elements that aren't listed are important."""

    def __init__(self, rows):
        self.rows = {r[0]: r for r in rows}
        self.kids: dict[int, list[int]] = {}
        for r in rows:
            self.kids.setdefault(r[1], []).append(r[0])
        self.known: dict[int, float] = {}

    def of(self, path: int) -> float:
        todo, begun = [path], set()
        while todo:
            at = todo[-1]
            if at not in begun and at in self.rows and at not in self.known:
                begun.add(at)  # children first; one already begun is a circle by hash collision
                todo += [k for k in self.kids.get(at, ()) if k not in begun]
                continue
            todo.pop()
            if at in self.rows and at not in self.known:
                self.known[at] = self.weigh(at)
        return self.known.get(path, 1.0)

    def weigh(self, path: int) -> float:
        _, _, _, styles, style_entropy, contents, content_entropy = self.rows[path]
        kids = [self.known.get(k, 1.0) for k in self.kids.get(path, ())]
        parts = kids + [1.0 - content_entropy] * bool(contents)
        below = sum(parts) / len(parts) if parts else 0.0
        if kids:
            weight = GAMMA**styles
            below = (1 - weight) * style_entropy + weight * below
            below = max(below, max(parts))  # a branch is kept for its most important part
        return below

    def doubted(self, path: int) -> float:
        """Importance, the higher the fewer pages it is known from."""
        return self.of(path) + DOUBT / self.rows[path][2] if path in self.rows else 1.0

    def low(self, path: int, limit: float) -> bool:
        return self.doubted(path) < limit

    def marks(self) -> dict[int, float]:
        """The paths that some limit removes."""
        values = {path: self.doubted(path) for path in self.rows}
        return {path: value for path, value in values.items() if value < max(NEUTRAL, INSIDE, DOUBTED)}


class Marks:
    """``Importance`` of a host as a page needs it: its removable paths alone."""

    def __init__(self, values: dict[int, float]):
        self.values = values

    def low(self, path: int, limit: float) -> bool:
        return self.values.get(path, 1.0) < limit


def find_main(root: Node) -> list[Node]:
    """Outermost articles that no beside-part holds, else main, else the whole page."""
    articles, mains = [], []
    todo = [root]
    while todo:
        node = todo.pop()
        if named(node, False) and node is not root:
            continue
        if node.tag == "article" or node.role == "article":
            articles.append(node)
            continue
        if node.tag == "main" or node.role == "main":
            mains.append(node)
        todo.extend(k for k in reversed(node.kids) if not isinstance(k, str))
    return articles or mains[:1] or [root]


def blocks_of(top: Node, inside: bool, drop) -> list[str]:
    """Texts of the blocks below ``top`` in page order, without what is named or dropped."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = text_of("".join(run))
        run.clear()
        if text:
            blocks.append(text)

    todo: list = [top]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            run.append(x)
        elif x is None:
            flush()
        elif x.tag == "br":
            run.append(" ")
        elif x is not top and (named(x, inside) or drop(x)):
            if x.tag in BLOCKS:
                flush()
        else:
            if x.tag in BLOCKS:
                flush()
                todo.append(None)
            todo.extend(reversed(x.kids))
    flush()
    return blocks


def set_paths(root: Node) -> None:
    todo = [(root, 0)]
    while todo:
        node, parent = todo.pop()
        node.path = path_below(parent, node)
        todo.extend((k, node.path) for k in node.kids if not isinstance(k, str))


def main_text(page: str | None, importance: Importance | Marks) -> str:
    if not page:
        return ""
    root = parse(page)
    set_paths(root)
    out: list[str] = []
    for top in find_main(root):
        inside = top is not root

        def drop(n: Node, inside: bool = inside) -> bool:
            if importance.low(n.path, INSIDE if inside else NEUTRAL):
                return True
            return inside and doubtful(n) and (importance.low(n.path, DOUBTED) or mostly_links(n))

        blocks, whole = blocks_of(top, inside, drop), blocks_of(top, inside, lambda n: False)
        out += blocks if blocks and (not inside or 2 * len(blocks) >= len(whole)) else whole
    return "\n".join(out)


# -------------------------------------------------------------------------------- Spark side


def with_host(pages: DataFrame) -> DataFrame:
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)
    return pages.select("page_id", "url", "html", F.lower(host).alias("host"))


def site_trees(pages: DataFrame) -> DataFrame:
    """``host, nodes``: the merged tree of each host, elements of at least two pages."""
    ready(pages.sparkSession)

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                hosts, rows = [], []
                for host, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if text:
                        found = site_rows(parse(text))
                        rows.extend(found)
                        hosts.extend([host] * len(found))
                if rows:
                    a = np.array(rows, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(hosts), *(pa.array(a[:, k]) for k in range(4))], ["host", "path", "parent", "kind", "value"])

    rows = pages.select("host", "html").mapInArrow(facts, "host string, path long, parent long, kind long, value long")
    n = rows.groupBy("host", "path", "parent", "kind", "value").agg(F.count("*").alias("n"))
    per = n.groupBy("host", "path", "parent").agg(
        F.max(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"),
        F.count_if(F.col("kind") == 1).alias("styles"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.log(F.col("n")))).alias("s"),
        F.count_if(F.col("kind") == 2).alias("contents"),
        # each occurrence of a content of n pages has entropy log n
        (F.sum(F.when(F.col("kind") == 2, F.col("n") * F.log("n"))) / F.sum(F.when(F.col("kind") == 2, F.col("n")))).alias("c"),
    )
    m = F.col("pages")
    style = F.log(m) - F.col("s") / m  # -sum p log p, natural logarithm
    nodes = per.where(m >= 2).select(
        "host",
        F.struct("path", "parent", "pages", "styles", (style / F.log(m)).alias("style_entropy"), "contents", F.coalesce(F.col("c") / F.log(m), F.lit(0.0)).alias("content_entropy")).alias("node"),
    )
    return nodes.groupBy("host").agg(F.array_sort(F.collect_list("node")).alias("nodes"))


def removable(trees: DataFrame) -> DataFrame:
    """``host, paths, limits``: the removable paths of each host, and the limit above which each goes."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, nodes in zip(batch.column("host").to_pylist(), batch.column("nodes"), strict=True):
                marks = Importance([tuple(n.values()) for n in nodes.as_py()]).marks()
                yield pa.RecordBatch.from_pydict({"host": [host], "paths": pa.array([list(marks)], pa.list_(pa.int64())), "limits": pa.array([list(marks.values())], pa.list_(pa.float64()))})

    return trees.mapInArrow(weigh, "host string, paths array<long>, limits array<double>").where(F.size("paths") > 0)


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` for every row of ``pages(page_id, url, html)``."""
    ready(pages.sparkSession)
    known = with_host(pages)
    marked = store(removable(site_trees(known)), "site-marks")
    size = marked.agg(F.coalesce(F.sum(F.size("paths")), F.lit(0))).first()[0]
    joined = known.join(F.broadcast(marked) if size <= BROADCAST_NODES else marked, "host", "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, marks = None, Marks({})
        cache: dict[str, Marks] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                hosts, paths, limits, texts = part.column("host").to_pylist(), part.column("paths"), part.column("limits"), []
                for i, page in enumerate(part.column("html").to_pylist()):
                    if hosts[i] != last:
                        if hosts[i] not in cache:
                            if len(cache) > 64:
                                cache.clear()
                            cache[hosts[i]] = Marks(dict(zip(paths[i].as_py() or (), limits[i].as_py() or (), strict=True)))
                        last, marks = hosts[i], cache[hosts[i]]
                    texts.append(main_text(page, marks))
                yield pa.RecordBatch.from_arrays([part.column("page_id").cast(pa.int64()), part.column("url").cast(pa.string()), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return joined.select("page_id", "url", "host", "html", "paths", "limits").mapInArrow(extract, "page_id long, url string, text string")

"""Main text of HTML pages by composite text density.

Each page becomes a tree of elements (unclosed and stray tags are accepted as
browsers do). Elements that are boilerplate by tag, role or name are cut, by
form or name only where they don't wrap the content, by the name of a list of
links only where links are a good part of the text. For
each remaining element the density is its characters per tag, weighed down by
the share of link characters and link tags. The densities of an element's
children, and of text directly in it, add up to its density sum. The subtree
with the largest sum is the main one. An article element around it is taken
whole, else a main element. The smallest density on the path from it up to the
body is the threshold, and other subtrees as dense as that are taken too.

Edge cases: null or empty html, or a page without text, gives an empty text;
pages and nesting of any size are taken whole; equal rows give equal rows; an
empty table gives an empty result; only the id, url and html are read.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)"
    r"|</?(?P<odd>[A-Za-z][^\s/>]*)[^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEAD = frozenset("title style script meta link base noscript template".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p "
                  "pre section summary table tbody tfoot thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: start tag: open elements that it closes
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "tbody", "thead"}}
#: elements beyond which a start tag closes nothing
FENCE = frozenset("html body table ul ol dl div section article main aside nav header footer form td th blockquote".split())

CUT_TAGS = frozenset("head script style noscript template title nav footer aside button select textarea input "
                     "iframe object embed svg canvas audio video map dialog menu".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar "
                      "toolbar".split())
CUT_NAMES = frozenset("ad ads adsense advert adverts advertisement advertising sponsor sponsored sponsors promo promos "
                      "promotion cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription "
                      "signup login share sharing social menu menus nav navbar navigation breadcrumb breadcrumbs footer "
                      "sidebar widget widgets related recommended recommendations comment comments disqus replies "
                      "respond pagination pager toolbar copyright skip".split())
#: of these, names of lists of links
LINK_NAMES = frozenset("related recommended recommendations share sharing social menu menus nav navbar navigation breadcrumb "
                       "breadcrumbs pagination pager".split())
#: a class that begins so tells what a wrapper has, not what it is
STATES = frozenset("has have no with without show hide is not enable enabled disable disabled".split())
#: cut unless the name also says that it belongs to the article
CUT_NAMES_OUTSIDE = frozenset("header masthead topbar banner notice notices alert announcement disclaimer".split())
ARTICLE_NAMES = frozenset("article post entry story content body main title headline text".split())
KEEP_TAGS = frozenset("html body article main".split())


class Node:
    __slots__ = ("tag", "parent", "items", "attributes", "cut", "chars", "tags", "link_chars", "link_tags", "density",
                 "total")

    def __init__(self, tag, parent, attributes=""):
        self.tag, self.parent, self.items, self.attributes = tag, parent, [], attributes
        self.cut = False
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def parse(text: str) -> list[Node]:
    """All elements in document order; the first is the root."""
    root = Node("html", None)
    nodes, here, at, n = [root], root, 0, len(text)
    while at < n:
        found = TOKEN.search(text, at)
        end = found.start() if found else n
        if end > at:
            here.items.append(entities.unescape(text[at:end]))
        if not found:
            break
        at = found.end()
        tag = found["tag"] or found["odd"]
        if not tag:
            continue
        tag = tag.lower()
        if found["close"] or (found["odd"] and text[found.start() + 1] == "/"):
            node = here
            while node and node.tag != tag:
                node = node.parent
            if node and node.parent:
                here = node.parent
            continue
        if here.tag == "head" and tag not in HEAD:
            here = here.parent
        if tag in ("html", "body") and any(x.tag == tag for x in nodes[1:3]) or tag == "html":
            root.attributes = root.attributes or found["rest"] or ""
            continue
        closes = CLOSES.get(tag, ())
        if tag in BLOCK or closes:
            node = here
            while node.parent and (node.tag not in FENCE or node.tag in closes):
                if node.tag in closes or (node.tag == "p" and tag in BLOCK):
                    here = node.parent
                    if node.tag == "p":
                        break
                node = node.parent
        node = Node(tag, here, found["rest"] or "")
        here.items.append(node)
        nodes.append(node)
        if tag in RAW:
            stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(text, at)
            at = stop.start() if stop else n
            close = text.find(">", at)
            at = n if close < 0 else close + 1
        elif tag not in VOID and not (found["rest"] or "").endswith("/") or tag in BLOCK:
            here = node
    return nodes


def boilerplate(node: Node) -> str:
    """"always"; "outside" if it is unless it wraps the content; "links" if also links are a good part of it; else ""."""
    tag = node.tag
    if tag in CUT_TAGS:
        return "always"
    if tag == "header":
        up = node.parent
        while up and up.tag not in ("article", "main"):
            up = up.parent
        if not up:
            return "always"
    kind = "outside" if tag == "form" else ""
    if tag in KEEP_TAGS or not node.attributes:
        return kind
    names = set()
    for name, value in ATTRIBUTE.findall(node.attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            for word in value.split():
                parts = [x.lower() for x in NAME_PART.findall(word)]
                if parts and not (len(parts) > 1 and parts[0] in STATES):
                    names.update(parts)
        elif name == "role" and CUT_ROLES.intersection(value.lower().split()):
            return "always"
        elif name == "role" and "form" in value.lower().split():
            kind = "outside"
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "always"
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "always"
    if names & CUT_NAMES - LINK_NAMES or names & CUT_NAMES_OUTSIDE and not names & ARTICLE_NAMES:
        return "outside"
    return kind or ("links" if names & LINK_NAMES else "")


def cut(nodes: list[Node]) -> None:
    """Marks boilerplate.

    A subtree wraps the content if it holds more than half of the text that
    isn't links, and no article or main element beside it holds a tenth; or a
    quarter of it together with the page's main heading or main element.
    """
    kinds = [""] + [boilerplate(x) for x in nodes[1:]]
    if not any(x in ("outside", "links") for x in kinds):
        for node, kind in zip(nodes[1:], kinds[1:]):
            node.cut = node.parent.cut or kind == "always"
        return
    number = {id(x): i for i, x in enumerate(nodes)}
    n = len(nodes)
    up = [number[id(x.parent)] if x.parent else -1 for x in nodes]
    gone, in_link = [False] * n, [False] * n
    chars, links, heading, end = [0] * n, [0] * n, [False] * n, list(range(1, n + 1))
    for i in range(1, n):
        gone[i] = gone[up[i]] or kinds[i] == "always"
        in_link[i] = in_link[up[i]] or nodes[i].tag == "a"
    for i in range(n - 1, -1, -1):
        if not gone[i]:
            own = sum(len(" ".join(x.split())) for x in nodes[i].items if x.__class__ is str)
            chars[i] += own
            links[i] += own if in_link[i] else 0
            heading[i] = heading[i] or nodes[i].tag in ("h1", "main")
        if i:
            chars[up[i]] += chars[i]
            links[up[i]] += links[i]
            heading[up[i]] = heading[up[i]] or heading[i]
            end[up[i]] = max(end[up[i]], end[i])
    prose = [a - b for a, b in zip(chars, links)]
    whole = [i for i in range(1, n) if nodes[i].tag in ("article", "main") and 10 * prose[i] >= prose[0]]

    def wraps(i):
        if 4 * prose[i] >= prose[0] and heading[i] and prose[i]:
            return True
        return 2 * prose[i] > prose[0] and all(k < i < end[k] or i < k < end[i] for k in whole)

    for i in range(1, n):
        node, kind = nodes[i], kinds[i]
        node.cut = node.parent.cut or kind == "always" or kind == "outside" and not wraps(i) \
            or kind == "links" and 4 * links[i] >= chars[i] and not wraps(i)


def measure(nodes: list[Node]) -> None:
    """Cuts boilerplate and sets densities and density sums."""
    cut(nodes)
    direct = {}
    for node in reversed(nodes):
        if node.cut:
            continue
        own = sum(len(" ".join(x.split())) for x in node.items if x.__class__ is str)
        direct[id(node)] = own
        node.chars += own
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        if up := node.parent:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    top = next((x for x in nodes if x.tag == "body"), nodes[0])
    link_share = top.link_chars / max(1, top.chars)
    for node in nodes:
        if not node.cut and node.chars:
            base = math.log(node.chars / max(1, node.chars - node.link_chars) * node.link_chars
                            + link_share * node.chars + math.e)
            ratio = node.chars / max(1, node.link_chars) * max(1, node.tags) / max(1, node.link_tags)
            node.density = node.chars / max(1, node.tags) * math.log(ratio) / math.log(base + 1e-9) \
                if base > 1 + 1e-9 else node.chars / max(1, node.tags) * math.log(ratio)
    for node in nodes:
        if not node.cut:
            node.total += direct[id(node)]
            if node.parent:
                node.parent.total += node.density


def content(nodes: list[Node]) -> list[Node]:
    """Roots of the subtrees that hold the main text, in document order."""
    top = next((x for x in nodes if x.tag == "body"), nodes[0])
    live = [x for x in nodes if not x.cut and x.chars and (x.tag != "html" or x is top)] or nodes[:1]
    main = max(live, key=lambda x: x.total)  # of equals the first, which is the outermost
    path, node = [], main
    while node:
        path.append(node)
        node = node.parent
    whole = [x for x in path if x.tag in ("article", "main")]
    if whole:
        main = next((x for x in reversed(whole) if x.tag == "article"), whole[-1])
        path = path[path.index(main):]
    threshold = min(x.density for x in path if x.tag != "html" or x is top)
    chosen, inside = [], {id(x) for x in path[1:]}
    work = [path[-1]]
    while work:
        node = work.pop()
        if node is main or id(node) not in inside and node.density >= threshold:
            chosen.append(node)
        elif id(node) in inside:
            work.extend(x for x in reversed(node.items) if x.__class__ is Node and not x.cut and x.chars)
    return chosen


def blocks(roots: list[Node]) -> list[str]:
    out, line = [], []

    def flush():
        if text := " ".join("".join(line).split()):
            out.append(text)
        line.clear()

    for root in roots:
        work = [(root, 0)]
        while work:
            node, at = work.pop()
            if not at and node.tag in BLOCK:
                flush()
            for k in range(at, len(node.items)):
                item = node.items[k]
                if item.__class__ is str:
                    line.append(item)
                elif not item.cut:
                    if item.tag in ("br", "td", "th"):
                        line.append(" ")
                    work.append((node, k + 1))
                    work.append((item, 0))
                    break
            else:
                if node.tag in BLOCK:
                    flush()
                elif node.tag in ("td", "th"):
                    line.append(" ")
        flush()
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    nodes = parse(html)
    measure(nodes)
    return "\n\n".join(blocks(content(nodes)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars of every page."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [main_text(x.as_py()) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    [id_col, url_col, "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select(id_col, url_col, html_col).mapInArrow(
        run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")

"""Main text of web pages by tree scoring.

A page becomes a flat list of nodes. Blocks of running text (paragraphs) earn points for length and
commas and pass them to their parent, half to the grandparent, a third and so on further up; a
container's points are discounted by its link density. The container with the most points is kept,
and the parts and loose texts beside it that are not mostly links. Parts that are never the article
by their tag (menus, forms) or that are hidden are cut out before scoring. A part that only a name
speaks against (``widget``, ``notice``, ``share``) is cut out too, unless hardly any text but links stands
outside such parts: then the one with the most text is the page's own wrapper and stays.

Pages are independent: one pass over each html string in the scanning task, no shuffle.

Defined results: a null or empty page, or one without text, gives an empty text. Markup that ends in
the middle of a tag, unclosed and stray tags are read as browsers do. Repeated rows are extracted each
on their own; other columns pass through, except that columns named like a result are replaced.
"""

from __future__ import annotations

import heapq
import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import columns_but

# Tag names.
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
BLOCK = (
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
    "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
)
NEVER = (
    "aside", "audio", "button", "canvas", "datalist", "dialog", "embed", "fieldset", "footer", "form", "head", "header",
    "iframe", "input", "label", "legend", "math", "menu", "meter", "nav", "noscript", "object", "optgroup", "option", "output",
    "progress", "script", "search", "select", "style", "svg", "template", "textarea", "video",
)
ROLES = (
    "alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation",
    "search", "toolbar",
)
# A part whose class or id has one of these words is cut out, as a rule. One of GOOD speaks for a part.
BAD = (
    "ad", "ads", "adbox", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "commentlist", "consent", "cookie", "cookies", "copyright", "disqus", "foot", "footer",
    "form", "gdpr", "header", "login", "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "notices", "notification", "overlay", "pager", "pagination", "popup", "privacy", "promo", "promoted", "promotion",
    "promotions", "recommended", "related", "replies", "share", "sharing", "shoutbox", "sidebar", "sidebars", "signup", "social", "sponsor",
    "sponsored", "subscribe", "teaser", "toolbar", "topbar", "widget", "widgets",
)
GOOD = ("article", "body", "content", "entry", "main", "maincontent", "page", "post", "story", "text")

# Words of BAD that name what readers wrote: such a part is never the article, however long it is.
READERS = ("comment", "comments", "commentlist", "disqus", "replies", "shoutbox")
# Parts of a layout that a name only mentions: "has-sidebar" is no sidebar.
MENTIONS = ("has", "hide", "no", "show", "with", "without")

OUTSIDE = 0.1  # a named part stays if the text outside of such parts, links left out, is under this share of its running text
LINKS = 0.33  # what stands beside the best container is left out from this link density on
ANCESTORS = 6  # how far up a paragraph's points are passed

_RAW, _VOID, _BLOCK, _NEVER, _ROLES = map(frozenset, (RAW, VOID, BLOCK, NEVER, ROLES))
_BAD, _GOOD, _READERS = map(frozenset, (BAD, GOOD, READERS))
# An open tag that ends another one of its kind which is still open, up to the container that shields it.
_ENDS_SELF = {
    "li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"),
    "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select", "datalist", "optgroup"),
}
_SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}

_TAG = re.compile(r"<(?:(!--)|(/?)([A-Za-z][^\s/>]*)|[!?/])")
_ATTRIBUTES = re.compile(r"""[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>""")
_NAMED = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style)(?![^\s=>/])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']*)))?""", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_MENTIONED = re.compile(rf"(?<![\w-])(?:{'|'.join(MENTIONS)})[-_][\w-]+", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WHITE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element. ``items`` holds its texts and child nodes in page order."""

    __slots__ = ("tag", "parent", "items", "points", "letters", "linked", "hint", "doubt")

    def __init__(self, tag: str, parent: "Node | None", hint: int = 0, doubt: int = 0):
        self.tag, self.parent, self.hint, self.doubt = tag, parent, hint, doubt
        self.items: list = []
        self.points, self.letters, self.linked = 0.0, 0, 0


class Open:
    """The elements that are open, outermost first, and where the last one of each tag stands."""

    def __init__(self, root: Node):
        self.nodes, self.at, self.blocks = [root], {}, []

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in _BLOCK:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def last(self, *tags: str) -> int:
        """The place of the innermost open element with one of these tags; 0 (the root) if none is open."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def end(self, place: int) -> None:
        """End the element at a place and all inside it."""
        while len(self.nodes) > place:
            tag = self.nodes.pop().tag
            self.at[tag].pop()
            if tag in _BLOCK:
                self.blocks.pop()


# What speaks against a part: nothing, a name, the name of readers' words, or an attribute that hides it.
KEEP, NAMED, READER, HIDDEN = range(4)


def _judged(tag: str, attributes: str) -> tuple[int, int]:
    """What speaks against a part, and whether its name speaks for it (1) or not (0)."""
    hint = doubt = 0
    for m in _NAMED.finditer(attributes) if attributes else ():
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return HIDDEN, 0
        if name == "role" and value.strip().lower() in _ROLES:
            return HIDDEN, 0
        if name in ("class", "id"):
            names = {w.lower() for w in _WORD.findall(_CAMEL.sub(" ", _MENTIONED.sub(" ", value)))}
            bad = names & _BAD
            if bad == {"header"} and names & _GOOD:
                bad = None  # an article's own head
            if bad and tag not in ("html", "body", "article", "main"):
                doubt = max(doubt, READER if bad & _READERS else NAMED)
            hint |= bool(names & _GOOD)
    return doubt, hint


def parse(page: str) -> Node:
    """The page's tree without what is never the article by its tag, in time linear in the page."""
    root = Node("html", None)
    opened, at, size = Open(root), 0, len(page)
    skipped: list[str] = []  # the tags open inside a part that is cut out
    inside: Counter = Counter()  # and how often each is
    while at < size:
        m = _TAG.search(page, at)
        end = m.start() if m else size
        if end > at and not skipped:
            opened.nodes[-1].items.append(page[at:end])
        if not m:
            break
        if m[1]:
            close = page.find("-->", m.end())
            at = size if close < 0 else close + 3
            continue
        if not m[3]:
            close = page.find(">", m.end())
            at = size if close < 0 else close + 1
            continue
        rest = _ATTRIBUTES.match(page, m.end())
        if rest is None:
            close = page.find(">", m.end())
            if close < 0:  # the page ends in a tag
                break
            attributes, at = page[m.end():close], close + 1
        else:
            attributes, at = page[m.end():rest.end() - 1], rest.end()
        tag = m[3].lower()
        if m[2]:
            place = opened.last(tag)
            if skipped:
                if inside[tag]:
                    ended = None
                    while ended != tag:
                        ended = skipped.pop()
                        inside[ended] -= 1
                elif place and tag in ("article", "main", "body", "html"):
                    # The part that is cut out was never closed; its container is.
                    skipped.clear()
                    inside.clear()
                    opened.end(place)
                continue
            if place and (tag in _BLOCK or not opened.blocks or opened.blocks[-1] < place):
                opened.end(place)
            elif tag in ("p", "br"):
                opened.nodes[-1].items.append(Node("br" if tag == "br" else "p", opened.nodes[-1]))
            continue
        if tag in _RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            if close is None:
                break
            stop = page.find(">", close.end())
            at = size if stop < 0 else stop + 1
            continue
        if tag in _VOID:
            if not skipped and tag in ("br", "hr"):
                opened.nodes[-1].items.append(Node(tag, opened.nodes[-1]))
            continue
        if skipped:
            if not attributes.endswith("/"):
                skipped.append(tag)
                inside[tag] += 1
            continue
        # A block ends an open paragraph, which no other block can be inside of.
        if tag in _BLOCK and opened.blocks and opened.nodes[opened.blocks[-1]].tag == "p":
            opened.end(opened.blocks[-1])
        if tag in _ENDS_SELF:
            place = opened.last(*_SAME.get(tag, (tag,)))
            if place > opened.last(*_ENDS_SELF[tag]):
                opened.end(place)
        if tag in _NEVER:
            skipped = [tag]
            inside[tag] += 1
            continue
        doubt, hint = _judged(tag, attributes)
        node = Node(tag, opened.nodes[-1], hint, doubt)
        node.parent.items.append(node)
        opened.push(node)
    return _without(root)


def _without(root: Node) -> Node:
    """Cut out hidden parts, what readers wrote, and parts that only a name speaks against, but for
    those that hold the page's running text."""
    order, at = [root], 0
    while at < len(order):
        node = order[at]
        at += 1
        if any(isinstance(x, Node) and x.doubt > NAMED for x in node.items):
            node.items = [x for x in node.items if isinstance(x, str) or x.doubt <= NAMED]
        order.extend(x for x in node.items if isinstance(x, Node))
    if not any(x.doubt for x in order):
        return root
    # Letters of running text, and of all text but links, in each part.
    links, prose, plain = set(), dict.fromkeys(order, 0), dict.fromkeys(order, 0)
    for node in order:
        if node.tag == "a" or node.parent in links:
            links.add(node)
    for node in reversed(order):
        own = len(_inline(node).strip()) if node.tag in _BLOCK else 0
        prose[node] += own if own >= 20 else 0
        plain[node] += 0 if node in links else sum(len(x.strip()) for x in node.items if isinstance(x, str))
        if node.parent is not None:
            prose[node.parent] += prose[node]
            plain[node.parent] += plain[node]
    doubted, outer = [], {}
    for node in order:
        outer[node] = outer.get(node.parent) or (node if node.doubt else None)
        if outer[node] is node:
            doubted.append(node)
    outside = plain[root] - sum(plain[x] for x in doubted)
    # A heap, so that a page of nothing but wrappers is unwrapped in order of size.
    heap = [(-prose[x], n, x) for n, x in enumerate(doubted)]
    heapq.heapify(heap)
    made = len(heap)
    while heap and outside < OUTSIDE * -heap[0][0]:
        node = heapq.heappop(heap)[2]
        node.doubt = KEEP
        held, stack = prose[node], list(node.items)  # in a wrapper that stays, running text alone counts
        while stack:
            x = stack.pop()
            if isinstance(x, Node):
                if x.doubt:
                    held -= prose[x]
                    made += 1
                    heapq.heappush(heap, (-prose[x], made, x))
                else:
                    stack.extend(x.items)
        outside += held
    for node in order:
        if any(isinstance(x, Node) and x.doubt for x in node.items):
            node.items = [x for x in node.items if isinstance(x, str) or not x.doubt]
    return root


def _blocks(node: Node) -> list[str]:
    """The text of the blocks of a part in page order, white space as single spaces."""
    out: list[str] = []
    run: list[str] = []
    is_block = [False]  # of the elements on the stack

    def close():
        if run:
            text = _WHITE.sub(" ", html.unescape("".join(run))).strip()
            run.clear()
            if text:
                out.append(text)

    stack = [iter((node,))]
    while stack:
        item = next(stack[-1], None)
        if item is None:
            stack.pop()
            if is_block.pop():
                close()
            continue
        if isinstance(item, str):
            run.append(item)
        elif item.tag == "br":
            run.append(" ")
        else:
            block = item.tag in _BLOCK
            if block:
                close()
            stack.append(iter(item.items))
            is_block.append(block)
    close()
    return out


def _measure(root: Node) -> list[Node]:
    """Count letters, and letters in links, of every node; returns the nodes, parents first."""
    order, at = [root], 0
    while at < len(order):
        order.extend(x for x in order[at].items if isinstance(x, Node))
        at += 1
    for node in reversed(order):
        own = sum(len(x.strip()) for x in node.items if isinstance(x, str))
        node.letters += own
        if node.tag == "a":
            node.linked = node.letters
        if node.parent is not None:
            node.parent.letters += node.letters
            node.parent.linked += node.linked
    return order


def _density(node: Node) -> float:
    return node.linked / node.letters if node.letters else 0.0


def _inline(node: Node) -> str:
    """The text that stands in a block itself, not in blocks inside it."""
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        for item in x.items:
            if isinstance(item, str):
                out.append(item)
            elif item.tag not in _BLOCK:
                stack.append(item)
    return "".join(out)


def extract(page: str | None) -> str:
    """The main text of a page: its blocks, one to a line."""
    if not page:
        return ""
    root = parse(page)
    order = _measure(root)
    for node in order:
        if node.tag not in _BLOCK or node.tag in ("ul", "ol", "table", "tr", "html", "body"):
            continue
        text = _inline(node).strip()
        if len(text) < 20:
            continue
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - _density(node))
        up = node.parent or node
        for level in range(1, ANCESTORS + 1):
            up.points += points / level
            up = up.parent
            if up is None:
                break
    best, most = root, 0.0
    for node in order:
        if node.tag in ("article", "main"):
            node.points *= 1.5
        elif node.hint:
            node.points *= 1.25
        value = node.points * (1 - _density(node))
        if value > most:
            best, most = node, value
    if most == 0.0:  # nothing reads like a paragraph
        named = [n for n in order if n.tag in ("article", "main") and n.letters]
        best = named[0] if named else root
    # Up to the article around it, then level by level while it holds all points anyway.
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    if up is not None:
        return "\n".join(_blocks(up))
    if best.parent is None:
        return "\n".join(_blocks(best))
    # All that stands beside the container but what is mostly links; right under the page itself,
    # where copyright lines and the like stand, only what reads like text.
    bar, page_level = max(2.0, 0.2 * most), best.parent.tag in ("html", "body")
    kept = Node("div", None)
    for item in best.parent.items:
        if isinstance(item, str) or item.tag not in _BLOCK:
            loose = not page_level or item is best or not isinstance(item, str) and item.tag == "br"
            if loose:
                kept.items.append(item)
            continue
        links = _density(item)
        plain = item.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre")
        scored = item.points * (1 - links) >= bar
        if item is best or scored or links < LINKS and (plain or not page_level):
            kept.items.append(item)
    return "\n".join(_blocks(kept))


def main_text(pages: DataFrame, text: str = "html", out: str = "text", length: str = "n_chars") -> DataFrame:
    """Append the main text and its length in code points; the html itself is left out."""
    names = ("__html", out, length)
    keep = columns_but(pages.drop(text), out, length)
    rows = pages.select(*keep, F.col(text).alias("__html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__html").schema.fields)
    schema = (schema + ", " if schema else "") + f"`{out}` string, `{length}` bigint"

    def run(batches):
        for batch in batches:
            source = batch.column(batch.num_columns - 1)
            made = [extract(source[i].as_py()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(made, type=pa.string()), pa.array([len(t) for t in made], type=pa.int64())],
                names=[*batch.schema.names[:-1], *names[1:]])

    return rows.mapInArrow(run, schema)

"""Main text of web pages by composite text density.

A page is parsed to a tree. Every node gets its characters C, tags T, link characters LC
and link tags LT, and from them its composite density: characters per tag, lessened where
links make up much of them. The sum of the densities of a node's children is large where
much plain text hangs below one node. The node with the greatest sum is found, and the
threshold is taken from its path to the body: every node on the path that is at least as
dense as the body belongs to the article, so the highest such node is the article.

Elements that are never article text (scripts, navigation, footers, ..) do not take part at
all. Those that are only named as something else (advertisements, comments, sidebars, ..), and
forms, do not either, unless they hold the article: an `article` or `main` element, or so
much of the page's plain text that little would be left. Below the article a list of mostly
links that is thinner than the body, or another container of hardly anything but links, is left
out; paragraphs are not. What remains is written in blocks: character references decoded,
white space in a block made one space.

Defined cases: null and empty pages, and pages without text, have an empty text; unclosed,
misnested and cut off markup is closed where a browser would close it; equal sums go to the
first node in page order; text without any element is one block; repeated rows are
extracted alike; an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of HTML: elements without content, with raw content, and block elements.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# An element of the key closes an open element of the values.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
ENDS_PARAGRAPH = BLOCKS - {"body", "caption", "head", "html", "legend", "option", "tbody", "td",
                           "tfoot", "th", "thead", "tr"}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"},
          "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"},
          "tfoot": {"table"}}

# Never article text, by element, by role, and by a word in class or id.
DROPPED = frozenset(
    "script style noscript template iframe object embed svg canvas audio video map head title "
    "nav aside footer button select textarea input label dialog menu".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert dialog alertdialog form menu "
    "menubar toolbar".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored promo "
    "promoted promotion banner cookie cookies consent gdpr notice notices notification alert popup "
    "modal overlay newsletter subscribe subscription paywall signup login nav navbar navigation "
    "menu breadcrumb breadcrumbs pager pagination toc sidebar aside widget widgets footer header "
    "masthead comment comments commentlist disqus discussion replies reply respond responses "
    "related recommended recommendations share sharing social copyright legal disclaimer".split()
)
NAME_WORDS = re.compile(r"[a-z0-9]+")
# A class that says what an element has, or has not, names it nothing.
MODIFIERS = frozenset("has with no without is not show hide".split())
# Shares of the plain text of the page above which a name does not count.
KEPT_IF_NAMED, KEPT_IF_PART_OF_NAME = 0.9, 0.6
LINK_LISTS = frozenset("ul ol dl menu dir".split())
TEXT_BLOCKS = frozenset("p li dt dd blockquote pre figcaption h1 h2 h3 h4 h5 h6 caption address summary".split())

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)


class Node:
    """An element: its children are nodes and strings."""

    __slots__ = (
        "chars", "children", "density", "drop", "holds", "link_chars", "links", "name", "parent", "sum", "tags"
    )

    def __init__(self, name: str, parent: Node | None, drop: float = 0.0):
        self.name = name
        self.parent = parent
        self.drop = drop  # goes if it holds at most this share of the plain text; 1 for certain
        self.children: list[Node | str] = []


def named_share(value: str, inside_article: bool, name: str) -> float:
    """Up to which share of the plain text an element of this class or id goes; 0: it does not."""
    share = 0.0
    for token in value.split():
        words = NAME_WORDS.findall(token)
        if not words or words[0] in MODIFIERS or not DROPPED_NAMES.intersection(words):
            continue
        if inside_article and name in ("header", "h1", "h2") and "header" in words:
            continue
        share = max(share, KEPT_IF_NAMED if len(words) == 1 else KEPT_IF_PART_OF_NAME)
    return share


def dropped_share(name: str, attributes: str, inside_article: bool) -> float:
    """1 for what is never article text, less for what only is named so, 0 for the rest."""
    if name in DROPPED or (name == "header" and not inside_article):
        return 1.0
    share = KEPT_IF_NAMED if name == "form" else 0.0
    for key, value in ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return 1.0
        if key == "role" and value in DROPPED_ROLES:
            return 1.0
        if key in ("class", "id") and name not in ("article", "main", "body", "html"):
            share = max(share, named_share(value, inside_article, name))
    return share


def parse(page: str) -> Node:
    """The tree of a page, with what is to be dropped marked."""
    root = node = Node("html", None)
    opened = Counter({"html": 1})  # open elements by name, so that no list is searched
    at, n = 0, len(page)

    def close() -> None:
        nonlocal node
        opened[node.name] -= 1
        node = node.parent

    def text(piece: str) -> None:
        if piece:
            node.children.append(html.unescape(piece))

    while at < n:
        found = MARKUP.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        closing, name, attributes = found.groups()
        if not name:
            continue
        name = name.lower()
        if closing:
            if opened[name] and name != "html":
                while node.name != name:
                    close()
                close()
            elif name == "br":
                node.children.append(" ")
            continue
        if name in RAW:
            # Raw content ends at its own closing tag and nowhere else.
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else n
            continue
        if name in VOID:
            if name in ("br", "hr"):
                node.children.append(Node("hr", node) if name == "hr" else " ")
            continue
        # Implied ends, alike inside and outside of what is dropped.
        if name in ENDS_PARAGRAPH and opened["p"]:
            while node.name != "p" and node.name not in BLOCKS:
                close()
            if node.name == "p":
                close()
        if name in CLOSES and any(opened[other] for other in CLOSES[name]):
            _close_siblings(name, node, close)
        if name in ("html", "body") and opened[name]:
            continue
        inside_article = opened["article"] + opened["main"] > 0
        child = Node(name, node, dropped_share(name, attributes, inside_article))
        node.children.append(child)
        if attributes.rstrip().endswith("/") and name in ("svg", "path", "use"):
            continue
        node = child
        opened[name] += 1
    return root


def _close_siblings(name: str, node: Node, close: Callable[[], None]) -> None:
    """Close the open elements that an element of this name ends, up to its list or table."""
    depth = 0
    last = 0
    while node.parent is not None and node.name not in SCOPES[name]:
        depth += 1
        if node.name in CLOSES[name]:
            last = depth
        node = node.parent
    for _ in range(last):
        close()


def prune(root: Node) -> None:
    """Take out what is dropped. A dropped block still divides the text around it."""
    order = _measure(root)
    for node in reversed(order):
        node.holds = node.name in ("article", "main") or any(
            c.holds for c in node.children if isinstance(c, Node) and c.drop < 1.0
        )
    # Text counts where nothing is certain to go.
    plain: dict[int, int] = {}
    for node in reversed(order):
        own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        below = sum(plain[id(c)] for c in node.children if isinstance(c, Node))
        plain[id(node)] = 0 if node.drop == 1.0 or node.name == "a" else own + below
    whole = plain[id(root)]
    for node in order:  # parents first: what hangs below a dropped one goes with it
        if not any(isinstance(c, Node) and c.drop for c in node.children):
            continue
        kept: list[Node | str] = []
        for child in node.children:
            if isinstance(child, str) or not child.drop:
                kept.append(child)
            elif child.drop < 1.0 and (child.holds or plain[id(child)] > child.drop * whole):
                kept.append(child)
            elif child.name in BLOCKS:
                kept.append(Node("hr", node))
        node.children = kept


def _measure(root: Node) -> list[Node]:
    """Counts of every node, children first, and all nodes in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    for node in reversed(order):
        node.chars = node.link_chars = node.tags = node.links = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += len("".join(child.split()))
            else:
                node.chars += child.chars
                node.link_chars += child.link_chars
                node.tags += child.tags + 1
                node.links += child.links
        if node.name == "a":
            node.link_chars, node.links = node.chars, node.links + 1
    return order


def _densities(order: list[Node], body: Node) -> None:
    """Composite text density of every node, and the sum over its children.

    The form is C/T * log(C*T / (LC*LT)) to the base ln(C/nLC * LC + LCb/Cb * C + e), where nLC
    are the characters outside links and b is the body; zero counts stand as one.
    """
    body_share = body.link_chars / max(body.chars, 1)
    for node in order:
        chars, tags = node.chars, max(node.tags, 1)
        if not chars:
            node.density = 0.0
            continue
        linked, links = max(node.link_chars, 1), max(node.links, 1)
        plain = max(chars - node.link_chars, 1)
        base = math.log(chars / plain * node.link_chars + body_share * chars + math.e)
        argument = max(chars / linked * tags / links, 1.0)
        # A base of exactly e gives the natural logarithm; it never falls below that.
        node.density = chars / tags * math.log(argument + math.e - 1) / math.log(max(base, 1.0) + math.e - 1)
    for node in order:
        node.sum = sum(c.density for c in node.children if isinstance(c, Node))


def find_article(root: Node) -> tuple[Node, float]:
    """The article's node and the density threshold of the page."""
    order = _measure(root)
    body = next((node for node in order if node.name == "body"), root)
    _densities(order, body)
    best = max(order, key=lambda node: node.sum)
    if best.sum <= 0.0:
        return body, 0.0
    article = best
    node = best
    while node.parent is not None and node is not body:
        if node.density >= body.density:
            article = node
        node = node.parent
    return article, body.density


def _is_link_list(node: Node, threshold: float) -> bool:
    """A list of mostly links, or another container of hardly anything else; never a paragraph."""
    if node.links < 2 or node.density >= threshold or node.name in TEXT_BLOCKS:
        return False
    if node.name in LINK_LISTS:
        return 2 * node.link_chars > node.chars
    return node.name in BLOCKS and 10 * node.link_chars >= 9 * node.chars


def blocks(article: Node, threshold: float) -> Iterator[str]:
    """The text of every block in page order, white space made one space."""
    pieces: list[str] = []

    def flush() -> str:
        out = " ".join("".join(pieces).split())
        pieces.clear()
        return out

    stack: list[tuple[Node | str, bool]] = [(article, False)]
    while stack:
        item, leaving = stack.pop()
        if isinstance(item, str):
            pieces.append(item)
            continue
        if item.name in BLOCKS and (done := flush()):
            yield done
        if leaving or (item is not article and _is_link_list(item, threshold)):
            continue
        if item.name in BLOCKS:
            stack.append((item, True))
        stack.extend((child, False) for child in reversed(item.children))
    if done := flush():
        yield done


def main_text(page: str) -> str:
    if not page:
        return ""
    root = parse(page)
    prune(root)
    article, threshold = find_article(root)
    return "\n".join(blocks(article, threshold))


def extract_text(pages: DataFrame, key: str = "page_id", text: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = [main_text(page or "") for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=[key, "url", "text", "n_chars"],
            )

    narrow = pages.select(key, "url", text)
    kind = narrow.schema[key].dataType.simpleString()
    return narrow.mapInArrow(batches, f"{key} {kind}, url string, text string, n_chars long")

"""Main text of web pages by composite text density.

A page becomes a light DOM, in one pass whose steps are bounded by the page's length; scripts, styles, form controls,
navigation and what names itself boilerplate (by tag, class, id or role) is pruned, and forms that do not hold most of
the page. Within an article, names that an article's own parts may bear prune nothing. Each node left gets its link-adjusted characters per tag and the sum of its children's densities. The
node of largest sum marks the article; the least density on its path from the body is the threshold, and every subtree
that reaches it contributes its own largest-sum node. Marked subtrees are kept whole, in page order.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from fathomline.llm.wordvec import column

#: Tag sets of the HTML standard and names that sites give to what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe title textarea xmp noembed noframes".split())
DROP = frozenset("head nav footer aside button select option input label dialog menu noscript template svg canvas audio video".split()) | RAW
HEAD = frozenset("head title meta link base style script noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br math mi mn mo ms mtext mrow mfrac msup msub msqrt mroot semantics annotation object".split())
CLOSES = {
    "p": frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dd dt tr td th".split()),
    "li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]), "dt": frozenset(["dd", "dt"]), "tr": frozenset(["tr", "tbody", "thead", "tfoot"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option", "optgroup"]),
    "h1": frozenset(["h1", "h2"]), "h2": frozenset(["h1", "h2"]),
}
SCOPES = frozenset("ul ol dl table".split())
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|sidebar|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|"
    r"footer|masthead|site-header|page-header|topbar|toolbar|share|sharing|social|related|recommend\w*|widget|pagination|pager|comments?|commentlist|disqus|replies|reply|respond|skip-link|search|tags|copyright|legal)(?:$|[\s_-])",
    re.I,
)
#: Of these names, those that parts of an article may bear as well.
WITHIN = re.compile(r"(?:^|[\s_-])(?:notices?|alert|search|tags|legal|copyright|banner|toolbar|widget|menu|overlay|replies|reply)(?:$|[\s_-])", re.I)
#: Names of containers: what also bears one of them is not pruned for a name that says what else it holds.
CONTAINERS = re.compile(r"(?:^|[\s_-])(?:content|main|article|post|entry|story|body)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar toolbar".split())

_TOKEN = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)|</")
_QUOTE = re.compile(r"[>\"']")
#: Characters of attributes in which a quoted > is looked through; in longer ones the first > ends the tag.
ATTRIBUTES = 65_536
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)


class Node:
    __slots__ = ("tag", "parent", "items", "chars", "tags", "link_chars", "link_tags", "density", "sum", "best", "drop", "block")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False):
        self.tag, self.parent, self.drop, self.items = tag, parent, drop, []
        self.block = self  # the nearest node around that is not inline


def _is_boilerplate(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in DROP or (tag == "header" and not inside_article):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, value in _NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").strip()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value.lower() in ROLES and not (inside_article and value.lower() == "alert")):
            return True
        if name in ("class", "id") and BOILERPLATE.search(value):
            if not inside_article and not CONTAINERS.search(value):
                return True
            if BOILERPLATE.search(WITHIN.sub(" ", WITHIN.sub(" ", value))):  # twice, as names share the space between them
                return True
    return False


def _tag_end(page: str, at: int) -> tuple[int, int]:
    """Where the attributes from ``at`` end and where the tag does: at the first > outside quotes, or else the first."""
    limit, k = at + ATTRIBUTES, at
    while m := _QUOTE.search(page, k, limit):
        if m[0] == ">":
            return m.start(), m.end()
        close = page.find(m[0], m.end(), limit)
        if close < 0:
            break
        k = close + 1
    first = page.find(">", at)
    return (len(page), len(page)) if first < 0 else (first, first + 1)


def _skip(page: str, close: str, at: int) -> int:
    end = page.find(close, at)
    return len(page) if end < 0 else end + len(close)


def parse(page: str) -> Node:
    """The DOM of a page. Unknown or unclosed tags are tolerated; text outside body counts as the body's. The head ends
    with its end tag, with body, or with the first element that no head holds."""
    root = Node("body", None)
    here, at, n = root, 0, len(page)
    open_tags: dict[str, int] = {}
    close_raw: dict[str, re.Pattern] = {}

    def leave(node: Node) -> Node:
        open_tags[node.tag] -= 1
        return node.parent

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            here.items.append(page[at:])
            break
        if m.start() > at:
            if here.tag == "head" and page[at : m.start()].strip():
                here = leave(here)
            here.items.append(page[at : m.start()])
        at = m.end()
        if m["tag"] is None:
            if m[0] == "<!--":
                at = m.start() + 5 if page.startswith("<!-->", m.start()) else _skip(page, "-->", at)
            else:
                at = _skip(page, "]]>" if m[0] == "<![CDATA[" else ">", at)
            continue
        tag = m["tag"].lower()
        stop, at = _tag_end(page, at)
        if m["end"]:
            if open_tags.get(tag):
                while here.tag != tag:
                    here = leave(here)
                here = leave(here)
            continue
        if tag == "html":
            continue
        if open_tags.get("head") and (tag == "body" or tag not in HEAD):
            while here.tag != "head":
                here = leave(here)
            here = leave(here)
        if tag == "body":
            continue
        if tag not in INLINE:
            block = here.block
            if tag in CLOSES.get(block.tag, ()):
                while here is not block:
                    here = leave(here)
                here = leave(here)
                if block.tag == "p" and tag in CLOSES.get(here.block.tag, ()) and here.block is not root:  # li > p, then li
                    block = here.block
                    while here is not block:
                        here = leave(here)
                    here = leave(here)
        attributes = page[m.end() : stop]
        child = Node(tag, here, here.drop or _is_boilerplate(tag, attributes, bool(open_tags.get("article") or open_tags.get("main"))))
        here.items.append(child)
        if tag in VOID or attributes.endswith("/") and tag in ("svg", "math"):
            continue
        if tag in RAW:
            pattern = close_raw.setdefault(tag, re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I))
            close = pattern.search(page, at)
            at = close.end() if close else n
            continue
        child.block = here.block if tag in INLINE else child
        open_tags[tag] = open_tags.get(tag, 0) + 1
        here = child
    _drop_forms(root)
    return root


def _drop_forms(root: Node) -> None:
    """Forms that hold less than half of the page's text, and those within dropped parts, are dropped."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [x for x in node.items if isinstance(x, Node) and not x.drop]
    for node in reversed(order):
        node.chars = sum(len(x.strip()) if isinstance(x, str) else 0 if x.drop else x.chars for x in node.items)
    for node in order:
        if node.tag in ("form", "fieldset") and 2 * node.chars < root.chars:
            node.drop = True


def _measure(root: Node) -> None:
    """Composite density and density sum of every node, children first, without recursion."""
    order, stack = [], [(root, False)]
    while stack:
        node, in_link = stack.pop()
        order.append((node, in_link))
        stack += [(x, in_link or x.tag == "a") for x in node.items if isinstance(x, Node) and not x.drop]
    for node, in_link in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for x in node.items:
            if isinstance(x, str):
                k = len(html.unescape(x).strip()) if "&" in x else len(x.strip())
                node.chars += k
                node.link_chars += k if in_link else 0
            elif not x.drop:
                node.chars += x.chars
                node.tags += x.tags + (x.tag == "a" or x.tag not in INLINE)
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags + (x.tag == "a")
    share = root.link_chars / max(root.chars, 1)
    for node, _ in reversed(order):
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + share * c + math.e)
        ratio = c / lc * t / lt
        node.density = c / t * (math.log(ratio) / math.log(base) if base > 1 and ratio > 1 else 1.0 if base <= 1 and ratio > 1 else 0.0) if c else 0.0
        blocks = [x for x in node.items if isinstance(x, Node) and not x.drop and x.tag not in INLINE]
        running = c - sum(x.chars for x in blocks)  # text of the node itself and of its inline children
        node.sum, node.best = sum(x.density for x in blocks) + node.density * running / max(c, 1), node
        for x in blocks:
            if x.best.sum >= node.best.sum:
                node.best = x.best


def _marked(root: Node) -> set[int]:
    best, node, least = root.best, root.best, root.best.density
    while node is not root:
        node = node.parent
        least = min(least, node.density)
    marks, stack = set(), [root]
    while stack:
        node = stack.pop()
        if node.density >= least and node.chars:
            marks.add(id(node.best))
        stack += [x for x in node.items if isinstance(x, Node) and not x.drop and x.tag not in INLINE]
    marks.add(id(best))
    return marks


def main_text(page: str | None) -> str:
    """The article of a page: one line per block, character references decoded, white space folded."""
    if not page:
        return ""
    root = parse(page)
    _measure(root)
    if not root.chars:
        return ""
    marks = _marked(root)
    blocks: list[str] = []
    piece: list[str] = []

    def cut():
        if piece and (line := " ".join(html.unescape("".join(piece)).split())):
            blocks.append(line)
        piece.clear()

    stack: list = [(root, id(root) in marks, 0)]
    while stack:
        node, keep, k = stack.pop()
        while k < len(node.items):
            x = node.items[k]
            k += 1
            if isinstance(x, str):
                if keep:
                    piece.append(x)
            elif x.tag == "br" and keep:
                piece.append(" ")
            elif not x.drop:
                if x.tag not in INLINE:
                    cut()
                stack.append((node, keep, k))
                stack.append((x, keep or id(x) in marks, 0))
                break
        else:
            if node.tag not in INLINE:
                cut()
    cut()
    return "\n".join(blocks)


def _extract(batches):
    for batch in batches:
        texts = [main_text(x) for x in column(batch, "html").to_pylist()]
        yield pa.RecordBatch.from_arrays([column(batch, "page_id"), column(batch, "url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page; a map over rows, without any shuffle.

    Null, empty or text-less html gives an empty text; null ids and urls stay; repeated rows stay repeated; other
    columns are ignored. A page of any length is read whole.
    """
    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")

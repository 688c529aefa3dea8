"""Web pages as trees of blocks.

A small reading of HTML: a pattern finds tags, comments and raw text; inline elements are passed over, so a block's text
is one run whatever marks it up. Elements that HTML closes by itself (paragraphs, items, rows, cells) are closed
where the next one or a container begins. An end tag closes up to its element, or nothing where none is open.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

DEEPEST = 200  # levels; deeper elements become neighbours of their parents' texts, as in browsers

_TAG = re.compile(
    r"<!--(?:-?>|.*?--!?>|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+'|)|[^>=])*+)(?:>|\Z)|<[!?/][^>]*+>?", re.S
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_RAW = {"script", "style", "title", "noscript", "template", "iframe", "textarea", "xmp", "noembed", "noframes", "svg", "object", "select"}
_LEAF = {"br", "hr", "img", "input", "meta", "link", "base", "area", "col", "embed", "source", "track", "wbr", "param"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
TEXT_BLOCKS = _HEADINGS | {"p", "li", "dt", "dd", "pre", "blockquote", "figcaption", "td", "th", "tr", "caption", "summary", "address"}
CONTAINERS = {
    *("div", "section", "article", "main", "nav", "header", "footer", "aside", "menu", "form", "fieldset", "dialog", "details"),
    *("figure", "ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "center", "button", "hgroup", "search"),
}
_BLOCKS = TEXT_BLOCKS | CONTAINERS
# An element that begins closes these, as far as the second set.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
} | {h: (_HEADINGS, _BLOCKS) for h in _HEADINGS}

# Words of class, id or role that name what is no article.
_BESIDE = set(
    """ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted nav navbar
    navigation menu menus breadcrumb breadcrumbs pagination pager toolbar topbar sidebar aside rail widget widgets complementary
    footer contentinfo header masthead copyright cookie cookies consent gdpr notice notices notification alert popup modal overlay
    newsletter subscribe subscription signup login paywall comment comments respond reply replies discussion disqus share
    sharing social related recommended recommendations trending search skip""".split()
)
_PARTS = re.compile("comment|sidebar|navbar|breadcrumb|advert|cookie|sponsor|newsletter|dropdown")
_WITH = {"has", "with", "no", "without"}  # of a whole page's layout
_DROPPED = {"nav", "footer", "aside", "menu", "dialog", "button", "fieldset", "search"}


class Node:
    """A block: its children are nodes and pieces of text, linked text told apart by its length."""

    __slots__ = ("tag", "key", "hidden", "kids", "linked")

    def __init__(self, tag: str, key: str, hidden: bool):
        self.tag, self.key, self.hidden, self.kids, self.linked = tag, key, hidden, [], 0

    def nodes(self) -> list[Node]:
        return [k for k in self.kids if type(k) is Node]

    def runs(self) -> list[str | Node]:
        """The children in order, texts between nodes as one run each with single spaces; empty runs left out."""
        out, run = [], []
        for kid in [*self.kids, None]:
            if type(kid) is str:
                run.append(kid)
                continue
            text = " ".join("".join(run).split())
            if text:
                out.append(text)
            run = []
            if kid is not None:
                out.append(kid)
        return out


@lru_cache(4096)
def _named(tag: str, attributes: str) -> tuple[str, bool]:
    """(key, hidden): the tag with the words of its class, id and role, numbers left out."""
    words, hidden = [], False
    for name, *values in _NAMES.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        else:
            words += _WORD.findall(value)
    return " ".join([tag, *sorted({w.lower() for w in words})[:12]]), hidden


@lru_cache(4096)
def named_beside(key: str) -> bool:
    """Whether the words of a key name something beside the article."""
    _, *words = key.split(" ")
    return not _WITH.intersection(words) and any(w in _BESIDE or _PARTS.search(w) for w in words)


def is_beside(node: Node, holds: bool, in_article: bool) -> bool:
    """Whether a node is left out with all below it. ``holds``: an article, main part or first heading is below."""
    if node.hidden or node.tag in _DROPPED:
        return True
    if node.tag == "header":
        return not (holds and in_article)
    if node.tag in _HEADINGS:
        return False
    return (node.tag == "form" or named_beside(node.key)) and not holds


@lru_cache(64)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I)


def parse(page: str) -> Node:
    """The tree of a page; the root stands for its body."""
    root = Node("body", "body", False)
    stack, at, link = [root], 0, 0

    def text(piece: str) -> None:
        if piece:
            if "&" in piece:
                piece = html.unescape(piece)
            stack[-1].kids.append(piece)
            if link:
                stack[-1].linked += len(piece)

    for found in iter(lambda: _TAG.search(page, at), None):
        text(page[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            if tag == "a":
                link = 0
            elif tag in _BLOCKS:
                wanted, limit = (_HEADINGS if tag in _HEADINGS else {tag}), ({"table", "td", "th"} if tag not in ("table", "tr", "tbody", "thead", "tfoot") else set())
                _close(stack, wanted, limit)
                link = 0
            elif tag == "br":
                text(" ")
        elif tag in _RAW:
            end = _end_of(tag).search(page, at)
            at = end.end() if end else len(page)
        elif tag == "a":
            link = 1
        elif tag in ("br", "hr"):
            text(" ")
            if tag == "hr":
                stack[-1].kids.append(Node("hr", "hr", False))
        elif tag in _BLOCKS:
            if stack[-1].tag == "p" and tag != "button":
                stack.pop()
            if tag in _CLOSES:
                _close(stack, *_CLOSES[tag])
            node = Node(tag, *_named(tag, found[3]))
            stack[-1].kids.append(node)
            if len(stack) < DEEPEST:
                stack.append(node)
            link = 0
    text(page[at:])
    return root


def _close(stack: list[Node], wanted: set[str], limit: set[str]) -> None:
    """Closes up to the innermost wanted element, unless an element of ``limit`` lies before it."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in wanted:
            del stack[i:]
            return
        if stack[i].tag in limit:
            return


def holders(root: Node) -> set[int]:
    """Ids of the nodes that have an article, a main part or a first heading below, comments' own articles aside."""
    out: set[int] = set()

    def below(node: Node) -> bool:
        held = False
        for kid in node.nodes():
            held |= below(kid) or kid.tag in ("main", "h1") or (kid.tag == "article" and not named_beside(kid.key))
        if held:
            out.add(id(node))
        return held

    below(root)
    return out

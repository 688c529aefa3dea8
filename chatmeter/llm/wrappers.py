"""Main texts of web pages by wrapper induction.

Pages of a host come from few templates. Each page is read as a tree of blocks and outlined: a node for each
container or kind of text block, with a mark of its text. The outlines of a host are aligned by simple tree matching
(the largest number of nodes that can be paired so that roots have the same name and the order of children is kept)
and merged into one tree, the wrapper, which counts for each node the pages that have it and its commonest texts.
A node whose text is the same on most of its pages is part of the template; one whose text varies is a slot. The article is
the node that holds the varying text that is no link and lies in no part named as something else (menus,
footers, notices, reader comments ...): an ``article`` or ``main`` part, or else the smallest container with nearly
all of it. Each page is then aligned with its host's wrapper, and gives all blocks of its article but for
template nodes and parts named as something else.

Pages with the same outline count once in the wrapper, else what they repeat would pass for template. Merging is by
groups of bounded size, level by level, so a host with a third of all pages is many tasks' work. A wrapper
holds as many nodes as the host has kinds of them. Wrappers meet the pages in a join by host, which the planner
broadcasts only where they are small; else adaptive execution splits a hot host.

On a host with fewer than ``FEW`` different pages nothing can be told to be constant: all text of the article
stays. A page without any node that matches the article of its host chooses its article by the same rule from itself.

Edge cases: a null or empty page, and one without an article's text, gives an empty text; broken markup is read as far
as it goes; a null url is a host of its own; repeated rows each give their row; other columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmeter.llm import pagetree
from chatmeter.llm.pagetree import CONTAINERS, Node
from chatmeter.llm.tables import saved, slices

FEW = 4  # different pages with a node before its text can be called constant
SAME = 0.6  # share of them with the same text
NEARLY_ALL = 0.75  # share of the varying text that the article holds
GROUP = 400  # outlines or wrappers that one task merges
RUN, WIDE = 8, 64  # like neighbours, and children, before they are taken together
TEXTS = 8  # texts counted for a node; a rarer one makes room
RESULT = "page_id long, url string, text string, n_chars long"


# --- outlines -------------------------------------------------------------------------------------


class Part:
    """A node of an outline or wrapper. ``texts`` counts the marks of its own text on different pages."""

    __slots__ = ("key", "kids", "pages", "chars", "linked", "texts", "own")

    def __init__(self, key: str, pages: int = 1):
        self.key, self.kids, self.pages, self.chars, self.linked, self.texts, self.own = key, [], pages, 0, 0, {}, []

    def state(self) -> list:
        return [self.key, self.pages, self.chars, self.linked, self.texts, [k.state() for k in self.kids]]

    @classmethod
    def of(cls, state: list) -> Part:
        part = cls(state[0], state[1])
        part.chars, part.linked, part.texts = state[2], state[3], state[4]
        part.kids = [cls.of(k) for k in state[5]]
        return part

    def constant(self) -> bool:
        return self.pages >= FEW and bool(self.texts) and max(self.texts.values()) >= SAME * self.pages


def outline(root: Node) -> Part:
    """The outline of a page. Text blocks of one key under a node are one part; so are more than ``RUN`` like
    containers in a row, and all like ones where a node has more than ``WIDE`` parts."""
    return _outlined([root], pagetree.holders(root), False)


def _outlined(nodes: list[Node], holders: set[int], in_article: bool) -> Part:
    first = nodes[0]
    part = Part(first.key)
    part.own = nodes
    texts, groups = [], []
    by_key: dict[str, list[Node]] = {}
    in_article = in_article or first.tag == "article"
    for node in nodes:
        part.linked += node.linked
        for kid in node.runs():
            if type(kid) is str:
                texts.append(kid)
            elif kid.tag != "hr" and not pagetree.is_beside(kid, id(kid) in holders, in_article):
                if kid.tag in CONTAINERS:
                    groups.append([kid])
                elif kid.key in by_key:
                    by_key[kid.key].append(kid)
                else:
                    by_key[kid.key] = own = [kid]
                    groups.append(own)
    part.chars = sum(map(len, texts))
    if texts:
        part.texts = {xxhash.xxh64_hexdigest("\n".join(texts)): 1}
    groups = _runs(groups)
    if len(groups) > WIDE:
        wide: dict[str, list[Node]] = {}
        for group in groups:
            wide.setdefault(group[0].key, []).extend(group)
        if len(wide) > WIDE:
            wide = {}
            for group in groups:
                wide.setdefault(group[0].tag, []).extend(group)
        groups = list(wide.values())
    part.kids = [_outlined(group, holders, in_article) for group in groups]
    return part


def _runs(groups: list[list[Node]]) -> list[list[Node]]:
    out, at = [], 0
    while at < len(groups):
        stop = at + 1
        while stop < len(groups) and groups[stop][0].key == groups[at][0].key:
            stop += 1
        out += [[n for g in groups[at:stop] for n in g]] if stop - at > RUN else groups[at:stop]
        at = stop
    return out


# --- matching -------------------------------------------------------------------------------------


def matching(a: Part, b: Part, known: dict | None = None) -> int:
    """The number of pairs in the largest matching of two trees that keeps roots, parents and order."""
    if a.key != b.key:
        return 0
    known = {} if known is None else known
    pair = id(a), id(b)
    if pair not in known:
        known[pair] = 1 + _table(a, b, known)[-1][-1]
    return known[pair]


def _table(a: Part, b: Part, known: dict) -> list[list[int]]:
    rows = [[0] * (len(b.kids) + 1)]
    for x in a.kids:
        last, row = rows[-1], [0]
        for j, y in enumerate(b.kids):
            row.append(max(row[j], last[j + 1], last[j] + matching(x, y, known)))
        rows.append(row)
    return rows


def pairs(a: Part, b: Part, known: dict) -> list[tuple[int | None, int | None]]:
    """Places of the children of matched nodes side by side, in an order that keeps both; None where one has no partner."""
    rows, out, i, j = _table(a, b, known), [], len(a.kids), len(b.kids)
    while i or j:
        if i and j and rows[i][j] == rows[i - 1][j - 1] + (m := matching(a.kids[i - 1], b.kids[j - 1], known)) and m:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif j and rows[i][j] == rows[i][j - 1]:
            j -= 1
            out.append((None, j))
        else:
            i -= 1
            out.append((i, None))
    return out[::-1]


def merge(a: Part, b: Part, known: dict | None = None) -> Part:
    """``a`` with what ``b`` adds; the roots have the same key."""
    known = {} if known is None else known
    sides = pairs(a, b, known)
    a.kids = [b.kids[j] if i is None else a.kids[i] if j is None else merge(a.kids[i], b.kids[j], known) for i, j in sides]
    a.pages, a.chars, a.linked = a.pages + b.pages, a.chars + b.chars, a.linked + b.linked
    for mark, n in b.texts.items():
        a.texts[mark] = a.texts.get(mark, 0) + n
    if len(a.texts) > TEXTS:
        # A text of more than one page in TEXTS + 1 is never lost, and counts are at most so far too low.
        less = sorted(a.texts.values(), reverse=True)[TEXTS]
        a.texts = {mark: n - less for mark, n in a.texts.items() if n > less}
    a.own = []
    return a


# --- the article ----------------------------------------------------------------------------------


def _varying(part: Part, sums: dict[int, int]) -> int:
    """Characters of varying text below each node that are no links; links count against it."""
    own = 0 if part.constant() else max(0, part.chars - 2 * part.linked)
    sums[id(part)] = total = own + sum(_varying(k, sums) for k in part.kids)
    return total


def article(wrapper: Part) -> list[int]:
    """Where the article is: places of children from the root down."""
    sums: dict[int, int] = {}
    _varying(wrapper, sums)
    for tags in (("article",), ("main",)):
        found = _outermost(wrapper, tags, [])
        weights = [sums[id(p)] for _, p in found]
        if sum(weights):
            best = max(range(len(found)), key=weights.__getitem__)
            if weights[best] >= NEARLY_ALL * sum(weights):
                return found[best][0]
            paths = [path for (path, _), w in zip(found, weights) if w]
            same = 0
            while len({p[same] if same < len(p) else None for p in paths}) == 1:
                same += 1
            return paths[0][:same]
    path, node = [], wrapper
    while True:
        place = max(range(len(node.kids)), key=lambda i: sums[id(node.kids[i])], default=None)
        if place is None or sums[id(node.kids[place])] < NEARLY_ALL * sums[id(node)] or not sums[id(node)]:
            return path
        if node.kids[place].key.split(" ")[0] not in CONTAINERS:
            return path
        path, node = [*path, place], node.kids[place]


def _outermost(part: Part, tags: tuple[str, ...], path: list[int]) -> list[tuple[list[int], Part]]:
    out = []
    for i, kid in enumerate(part.kids):
        if kid.key.split(" ")[0] in tags or (tags == ("main",) and "main" in kid.key.split(" ")[1:]):
            out.append(([*path, i], kid))
        else:
            out += _outermost(kid, tags, [*path, i])
    return out


class Wrapper:
    """The wrapper of a host, and where its article is."""

    def __init__(self, tree: Part):
        self.tree, self.path = tree, article(tree)
        self.dropped: dict[tuple, tuple] = {}


def extracted(page: str | None, wrapper: Wrapper | None) -> str:
    """The main text of a page: the blocks of its article in order, two line ends between them."""
    if not page:
        return ""
    root = pagetree.parse(page)
    own = outline(root)
    tree, path = (wrapper.tree, wrapper.path) if wrapper else (own, article(own))
    skipped: set[int] = set()
    chosen = _aligned(tree, own, path, skipped)
    if chosen is None:
        chosen = own
        for i in article(own):
            chosen = chosen.kids[i]
    holders, blocks = pagetree.holders(root), []
    for node in chosen.own:
        _blocks(node, skipped, holders, False, blocks)
    return "\n\n".join(blocks)


def _aligned(tree: Part, own: Part, path: list[int], skipped: set[int]) -> Part | None:
    """The page's part that matches the wrapper's article; nodes that match template go to ``skipped``."""
    known: dict = {}
    node, todo, chosen = tree, [(tree, own)], own
    for place in path:
        partner = next((j for i, j in pairs(node, chosen, known) if i == place), None) if chosen else None
        chosen = chosen.kids[partner] if partner is not None else None
        node = node.kids[place]
    todo = [(node, chosen)] if chosen else []
    while todo:
        a, b = todo.pop()
        for i, j in pairs(a, b, known):
            if i is not None and j is not None:
                if a.kids[i].constant() and b.kids[j].texts.keys() <= {max(a.kids[i].texts, key=a.kids[i].texts.get)}:
                    skipped.update(map(id, b.kids[j].own))
                todo.append((a.kids[i], b.kids[j]))
    return chosen


def _blocks(node: Node, skipped: set[int], holders: set[int], in_article: bool, out: list[str]) -> None:
    in_article = in_article or node.tag == "article"
    for kid in node.runs():
        if type(kid) is str:
            if id(node) not in skipped:
                out.append(kid)
        elif not pagetree.is_beside(kid, id(kid) in holders, in_article):
            _blocks(kid, skipped, holders, in_article, out)


# --- on Spark -------------------------------------------------------------------------------------


def host_of(url: str):
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.coalesce(host, F.lit(""))


def outlines(pages: DataFrame) -> DataFrame:
    """(host, state): the outline of each page, which holds marks of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            states = [json.dumps(outline(pagetree.parse(page)).state()) for page in batch.column("html").to_pylist()]
            yield pa.record_batch([batch.column("host"), pa.array(states, pa.string())], ["host", "state"])

    return pages.where("length(html) > 0").select("host", "html").mapInArrow(run, "host string, state string")


def _merged(table: pa.Table) -> pa.Table:
    tree = None
    for state in table["state"].to_pylist():
        part = Part.of(json.loads(state))
        tree = part if tree is None else merge(tree, part)
    return pa.table({"host": table["host"][:1], "state": [json.dumps(tree.state())]})


def induced(pages: DataFrame) -> DataFrame:
    """(host, state): the wrapper of each host, from all its different pages. ``pages`` has host and html."""
    now = saved(outlines(pages).distinct(), "outlines")
    while True:
        most = now.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return now
        # Hosts of many outlines are merged in as many groups as they fill; each round leaves a host one for a group.
        size = now.groupBy("host").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
        dealt = now.join(size, "host").withColumn("dealt", F.pmod(F.xxhash64("state"), "groups"))
        dealt = dealt.repartition("host", "dealt")  # else the groups of a host stay together where the join has put them
        now = saved(dealt.groupBy("host", "dealt").applyInArrow(_merged, "host string, state string"), "wrappers")


def main_texts(pages: DataFrame) -> DataFrame:
    """One row for each page, with the columns of ``RESULT``."""
    columns = [F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")]
    pages = pages.select(*columns).withColumn("host", host_of("url"))
    wrappers = induced(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in slices(batches, "html"):
            texts = []
            for page, state in zip(batch.column("html").to_pylist(), batch.column("state").to_pylist()):
                if state is not None and state not in known:
                    if len(known) >= 256:
                        known.clear()
                    known[state] = Wrapper(Part.of(json.loads(state)))
                texts.append(extracted(page, known.get(state)))
            sizes = pa.array(map(len, texts), pa.int64())
            yield pa.record_batch([*batch.select(["page_id", "url"]).columns, pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    joined = pages.join(wrappers, "host", "left").select("page_id", "url", "html", "state")
    return joined.mapInArrow(run, RESULT)

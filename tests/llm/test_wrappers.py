"""Wrapper induction: the tables' pages against another reader of HTML, and sites of known make."""

import itertools
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from chatmeter.llm import wrappers

PROSE = "the river ran past old mills and quiet fields where people sat talking of weather and trade until late".split()


class Reader(HTMLParser):
    """Headings and paragraphs inside the article, by the standard library's parser."""

    def __init__(self, page):
        super().__init__()
        self.blocks, self.inside = [""], False
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        if tag in ("h1", "p"):
            self.blocks.append("")
        if tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside = False
        if tag in ("h1", "p"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data

    def text(self):
        return "\n\n".join(filter(None, (" ".join(b.split()) for b in self.blocks)))


def test_query_equals_another_reader(spark, sf_dir):
    rows = entry_point.queries()["op11_html_extraction"](spark, sf_dir).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        assert r.text == Reader(pages[r.page_id].html).text()
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def read(page):
    return wrappers.extracted(page, None)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p>a &amp;amp; b&nbsp;&eacute; <b>bo<i>ld</b>er</i><br>x\n\t y<p>two</article>", "a &amp; b é bolder x y\n\ntwo"),
        ("<article>loose <!-- c > --> text<script>if (a < b) '</p>'</script> more<div>block</div>end", "loose text more\n\nblock\n\nend"),
        ("<ARTICLE><UL><LI>one<LI>two</UL><table><tr><td>c1<td>c2<tr><th>c3</table></ARTICLE>", "one\n\ntwo\n\nc1\n\nc2\n\nc3"),
        ("<title>t</title><style>p{}</style><main><h1 class=header>T</h1>2 < 3 <> 4</main><footer>f", "T\n\n2 < 3 <> 4"),
        ('<p title="a > b">q</p><p data-x=\'"\'>r</p></p></div>s<!-- open <p>gone', "q\n\nr\n\ns"),
        ("<div hidden>h</div><div style='display: none'>d</div><div><p>seen</p></div>", "seen"),
        ("<!--><p>kept</p><!DOCTYPE x><?php ?><p>too", "kept\n\ntoo"),
        ("<article><header><h1>T</h1><nav>n</nav></header><p>x</p><form><input>f</form><aside>s</aside><footer>f</footer></article>", "T\n\nx"),
        ("<article><p>x</p><div class='userComments'><article class=comment><p>y</p></article></div></article>", "x"),
        ("<form><div class='has-sidebar'><h1>T</h1><p>x</p></div><div id=leftSidebar>s</div></form>", "T\n\nx"),
        ("", ""),
        (None, ""),
        ("plain words only", "plain words only"),
        ("<nav>menu</nav>", ""),
    ],
)
def test_pages(page, text):
    assert read(page) == text


def test_deep_and_broken_pages():
    assert read("<div>" * 5000 + "x" + "</div>" * 5000 + "y").replace("\n", "") == "xy"
    assert read("<p>" * 3000 + "x</b></i>") == "x"
    assert read("<article>" + "<p a='>" * 2000 + "z").endswith("")
    many = "".join(f"<div class='k{chr(97 + i % 26)}{chr(97 + i // 26)}'><section>t{i}</section></div>" for i in range(600))
    assert read(f"<article>{many}</article>").count("\n\n") == 599


def test_matching_is_the_largest():
    """Against all ways to pair children in order."""

    def tree(state):
        part = wrappers.Part(state[0])
        part.kids = [tree(s) for s in state[1:]]
        return part

    def largest(a, b):
        if a[0] != b[0]:
            return 0
        x, y, best = a[1:], b[1:], 0
        for n in range(min(len(x), len(y)) + 1):
            for i in itertools.combinations(range(len(x)), n):
                for j in itertools.combinations(range(len(y)), n):
                    best = max(best, sum(largest(x[p], y[q]) for p, q in zip(i, j)))
        return 1 + best

    a = ["r", ["d", ["p"], ["u", ["l"]]], ["t"], ["d", ["p"]], ["d", ["u", ["l"], ["l"]]]]
    b = ["r", ["t"], ["d", ["u", ["l"]], ["p"]], ["d", ["u", ["l"], ["l"]], ["p"]], ["t"]]
    x, y = tree(a), tree(b)
    assert wrappers.matching(x, y) == largest(a, b)
    sides = wrappers.pairs(x, y, {})
    assert [i for i, _ in sides if i is not None] == list(range(4)) and [j for _, j in sides if j is not None] == list(range(4))


def site(n):
    """Pages without telling names: a menu, a note on some pages, the article, like pages and a last line, all in plain containers."""
    out = []
    for i in range(n):
        words = PROSE[i % 7 :] + PROSE[: i % 7]
        paragraphs = [" ".join(words[k:] + [f"n{i}x{k}"]) for k in range(1 + i % 4)]
        note = "<div><p>We keep small files on your machine.</p></div>" if i % 3 else ""
        page = (
            f"<html><body><div><ul><li><a href=/>Home</a><li><a href=/a>About us</a></ul></div>{note}"
            f"<div><h2>Story {i}</h2>{''.join(f'<p>{p}</p>' for p in paragraphs)}<div>Tell your friends about this</div></div>"
            f"<div><p><a href=/{i}>Read also number {i}</a></p></div><div>Made by us</div>"
        )
        out.append((i, f"https://Plain.example:80/{i}", page, "\n\n".join([f"Story {i}", *paragraphs])))
    return out


@pytest.mark.parametrize("group", [400, 3])
def test_induction_tells_template_from_slots(spark, monkeypatch, group):
    """Also where one task merges few outlines; copies of a page are no template."""
    monkeypatch.setattr(wrappers, "GROUP", group)
    rows = site(40)
    rows += [(1000 + i, "http://copies.example/x", rows[0][2], None) for i in range(30)]
    rows += [(2000, None, "<article><p>no url</p></article>", "no url"), (2001, "x", None, ""), (None, "x", "", "")]
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    df = df.withColumns({c: F.lit(1) for c in ("host", "state", "text", "mark")})
    got = {r.page_id: r.text for r in wrappers.main_texts(df).collect()}
    assert all(got[i] == text for i, _, _, text in rows if text is not None)
    copies = {got[1000 + i] for i in range(30)}
    assert len(copies) == 1 and "Story 0" in copies.pop()
    empty = spark.createDataFrame([], df.schema)
    assert wrappers.main_texts(empty).count() == 0

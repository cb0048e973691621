import pytest
from pyspark.sql import functions as F

from pagetables.operators import listing
from pagetables.operators.tree import shown
from pagetables.plans import profile
from pagetables.sources.html import html_nodes, node_rows, page_of, page_trees, register_html_nodes, tree_columns


def found(html, tag):
    p = page_of(html)
    return [p.shown(i) for i in range(len(p.tag)) if p.tag[i] == tag]


def parents(html):
    p = page_of(html)
    return [(t, p.tag[u] if u >= 0 else None) for t, u in zip(p.tag, p.up)]


def test_unclosed_tags():
    html = "<p><b>x<br><p>y"
    assert found(html, "p") == ["x", "y"]
    assert ("p", None) == parents(html)[3]


def test_script_literal():
    assert found('<script>var t="</p><p>"</script><p>a</p>', "p") == ["a"]


def test_entities_and_attributes():
    p = page_of('<a HREF="/x?a=1&amp;b=2" title=\'a>b\' data-x=/q/ hidden class="one  two" id=i>&amp &copy;&#65;</a>')
    names, values, element_id, classes, sel = p.attrs[0]
    assert dict(zip(names, values)) == {"href": "/x?a=1&b=2", "title": "a>b", "data-x": "/q/", "hidden": ""}
    assert (classes, element_id, sel, p.shown(0)) == (["one", "two"], "i", "#i .one .two ", "& ©A")


def test_first_of_two_equal_attributes_counts():
    assert page_of('<a href="1" href="2">').attrs[0][1] == ("1",)


@pytest.mark.parametrize(
    "html, want",
    [
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", [("ul", None), ("li", "ul"), ("li", "ul"), ("ul", "li"), ("li", "ul"), ("li", "ul")]),
        ("<table><tr><td>1<td>2<tr><th>3</table>x", [("table", None), ("tbody", "table"), ("tr", "tbody"), ("td", "tr"), ("td", "tr"), ("tr", "tbody"), ("th", "tr")]),
        ("<div><table><tr><td></div><p>a</td></tr></table></div>", [("div", None), ("table", "div"), ("tbody", "table"), ("tr", "tbody"), ("td", "tr"), ("p", "td")]),
        ("<select><option>a<option>b</select>", [("select", None), ("option", "select"), ("option", "select")]),
        ("<div><b><div>a</b></div></div><p>z", [("div", None), ("b", "div"), ("div", "b"), ("p", None)]),
        ("a</p>b", [("p", None)]),
        ("<!-- <p> --><!doctype html><p>", [("p", None)]),
    ],
)
def test_tree(html, want):
    assert parents(html) == want


def test_rendered_text():
    assert found("<td> a\n  b <div>c</div><div>d</div>e<br>f&nbsp; g</td>", "td") == ["a b\nc\nd\ne\nf\xa0 g"]


def test_a_stray_bracket_is_text():
    assert found("<p>1 < 2 <3 and a</p>", "p") == ["1 < 2 <3 and a"]


def test_a_tag_the_page_ends_in_is_dropped():
    assert found("<p>a<b", "p") == ["a"] and found("<p>a<b x='>", "p") == ["a"]


def test_places_enclose():
    p = page_of("<div><p>a<b>c</b></p><p>d</p></div>")
    assert (p.tag, p.up, p.last) == (["div", "p", "b", "p"], [-1, 0, 1, 0], [3, 2, 2, 3])
    assert p.post == [3, 1, 0, 2] and p.depth == [0, 1, 2, 1]


def test_any_element_shows_its_text():
    html = "<body>A<article> B <em>c</em><div>D<br>E</div></article>f</body>"
    assert [page_of(html).shown(i) for i in range(5)] == ["A\nB c\nD\nE\nf", "B c\nD\nE", "c", "D\nE", ""]


def test_deep_pages_keep_all_text():
    html = "<div>x" * 599 + "<section>AAA<div>BBB</div>CCC</section>" + "</div>" * 599
    p = page_of(html)
    assert max(p.depth) == 600
    assert found(html, "section") == ["AAA\nBBB\nCCC"]
    assert p.shown(0).endswith("x\nAAA\nBBB\nCCC") and p.last[0] == 600


def test_memory_is_linear_in_the_page():
    n = 30_000
    page = page_of("<div class='item'>x" * n)
    assert len(page.text) == 2 * n - 1
    [text, nodes] = tree_columns([(page, None)], None)
    assert text.nbytes + nodes.nbytes < 90 * n  # bytes an element, at any depth
    pieces = node_rows(page_of("<div class='item'>x" * 3000), None, None, None, 500)
    sizes = [(len(p[0]), len(p[-1].flatten())) for p in pieces]
    assert sum(rows for rows, _ in sizes) == 3000 and max(chain for _, chain in sizes) < 50 * 500 + 3000


def test_broken_markup_is_read_in_linear_time():
    for html in ('<a title="' * 20_000, "<" * 50_000, "<a b=" * 20_000, "<!--" * 20_000, "<!x" * 20_000, "</div>" * 50_000):
        page_of(html)


def test_hidden_cells_keep_their_text():
    assert found('<table><tr><td style="display:none">kept</table>', "td") == ["kept"]


def test_nodes_of_pages(spark, pages_of):
    pages = pages_of("<ul class='k-panelbar'><li id='P-1'><a href='/x'>t</a></ul>", None, "", "<p>z")
    rows = html_nodes(pages, carry=("url",)).orderBy("page_id", "pre").collect()
    assert [(r.page_id, r.tag) for r in rows] == [(0, "ul"), (0, "li"), (0, "a"), (3, "p")]
    assert rows[2].attrs == {"href": "/x"} and rows[2].url == "https://portal.example/p/0"
    assert [p.sel for p in rows[2].path] == ["ul .k-panelbar ", "li #P-1 "]


def test_trees_of_pages(spark, pages_of):
    pages = pages_of("<ul class='k-panelbar'><li id='P-1'><form><a href='/x'>t  u</a>é</form></ul>", None, "<p>z<q class='city'>c</q>")
    rows = page_trees(pages, carry=("url",), tags=("ul", "li", "a"), classes=("city",)).orderBy("page_id").collect()
    assert [(r.page_id, len(r.nodes)) for r in rows] == [(0, 3), (1, 0), (2, 1)]
    ul, li, a = rows[0].nodes
    assert (ul.i, ul.last, ul.up, li.i, li.last, li.up, li.id) == (0, 2, -1, 1, 2, 0, "P-1")
    assert (a.tag, a.up, a.attrs, bytes(rows[0].text[a.start : a.end])) == ("a", -1, {"href": "/x"}, b"t u")  # the form around isn't kept
    texts = page_trees(pages).select(F.transform("nodes", shown).alias("t")).orderBy("t").collect()
    assert sorted(r.t for r in texts) == [[], ["t ué", "t ué", "t ué", "t u"], ["zc", "c"]]


def test_trees_are_little_larger_than_their_markup(spark):
    from acceptance import render as R
    from conftest import SMALL

    t = R.Tables(spark, SMALL)
    for pages in (R.facility_detail_pages(t), R.organization_detail_pages(t), R.expert_pages(t, 1, 2, 3, 4, 5, 6, 8, 9, 10)):
        markup = [r.html for r in pages.select("html").collect()]
        columns = tree_columns([(page_of(h), None) for h in markup], frozenset(profile.SECTION_TAGS), frozenset(profile.SECTION_CLASSES))
        assert sum(c.nbytes for c in columns) < 2.5 * sum(len(h.encode()) for h in markup)


def test_relative_addresses(spark, pages_of):
    pages = pages_of('<a href="/x">1</a><a href="y?z=1">2</a><a href="#">3</a><a href="mailto:m">4</a><img src="../i.png"><a href="http://[">5</a>')
    got = html_nodes(pages, base="url").orderBy("pre").select(F.coalesce(F.col("attrs")["href"], F.col("attrs")["src"])).collect()
    assert [r[0] for r in got] == [
        "https://portal.example/x", "https://portal.example/p/y?z=1", "#", "mailto:m", "https://portal.example/i.png", "http://[",
    ]


def test_many_pages_come_in_pieces(spark, pages_of):
    pages = pages_of(*[f"<p>{i}<p>b" for i in range(300)]).coalesce(1)
    nodes = html_nodes(pages, flush=7)
    assert nodes.count() == 600
    assert nodes.filter("text <> 'b'").select(F.sum(F.col("text").cast("int"))).first()[0] == sum(range(300))


def test_sql_function(spark, pages_of):
    register_html_nodes(spark)
    pages_of("<div class='a b'><p>x</div>").createOrReplaceTempView("captured")
    rows = spark.sql("SELECT page_id, n.tag, n.text, n.cls, n.path FROM captured, LATERAL html_nodes(html) n ORDER BY n.pre").collect()
    assert [(r.tag, r.cls) for r in rows] == [("div", ["a", "b"]), ("p", [])]
    assert rows[1].text == "x" and rows[1].path[0].sel == "div .a .b "


def test_dropdown(spark, pages_of):
    html = "<ul id='HeiId_listbox'><li>Select HEI</li><li> A </li><li></li><li>B &amp; C</li></ul><ul><li>no</li></ul>"
    assert [tuple(r) for r in listing.dropdown_options(html_nodes(pages_of(html))).orderBy("idx").collect()] == [
        (0, 0, "A"), (0, 1, "B & C"),
    ]

import html as library
import re
import time

import pyarrow.parquet as pq
import pytest

from strata.llm import html, queries

SF_DIR = "/root/testdata/sf0.001"


def plain(page):
    """The article of this table's pages, by cutting their text."""
    body = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    if not body:
        return ""
    blocks = re.split(r"</?(?:p|h\d)>", body[1])
    cleaned = (" ".join(library.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?[bi]>", "", b))).split()) for b in blocks)
    return "\n\n".join(b for b in cleaned if b)


def test_query_equals_cutting_by_hand(spark):
    pages = pq.read_table(f"{SF_DIR}/pages.parquet").to_pylist()
    want = {(p["page_id"], p["url"], plain(p["html"]), len(plain(p["html"]))) for p in pages}
    got = [tuple(r) for r in queries.op6_html(spark, SF_DIR).collect()]
    assert len(got) == len(pages) and set(got) == want


PAGE = """<!doctype html><html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body>
<header><a href=/>Home</a> The Site</header><div class="cookie-notice">We use cookies</div><div id=main-nav><a href=x>One</a></div>
<div class="layout"><div class="sidebar"><p>Some words beside it.</p></div>
<div class="post-body"><h1>A&nbsp;title &amp; more</h1><p>First <b>bold</b>
 words<br>and&#33; more.<p>Second <a href=y>linked</a> words that go on.
<ul><li>one thing<li>another thing</ul><form><input><p>Sign up</form><blockquote>Said &lt;so&gt;</blockquote>
<ul><li><a href=1>Related one</a><li><a href=2>Related two</a></ul></div>
<section class="comments"><p>A reader's words.</p></section></div><footer>End</footer></body></html>"""


def test_a_page_without_article_element():
    tree = html.parse(PAGE)
    want = ["A title & more", "First bold words and! more.", "Second linked words that go on.", "one thing", "another thing", "Said <so>"]
    assert html.extract(tree, html.wrapper(tree)) == "\n\n".join(want)


def test_wrappers_fold_and_align():
    of = lambda s: html.wrapper(html.parse(s))
    shape = lambda w: w[0] + w[1] + ("" if w[0] == "#" else "(" + ",".join(map(shape, w[2])) + ")")
    assert shape(of("<p>a<p>b<p>c")) == "(p+(#))"
    assert shape(of("<h2>a</h2><p>b</p><h2>c</h2><p>d</p>")) == "(()h2|p+(h2(#),p(#)))"
    both = html.merge(of("<div>a</div><p>b</p>"), of("<p>b</p><p></p><ul><li>x<li>y</ul>"))
    assert shape(both) == "(div?(#),p+(#?),ul?(li+(#)))" or shape(both) == "(div?(#),p+(#),ul?(li+(#)))"
    assert html.merge(of("<p>abc"), of("<p>de"))[2][0][2][0] == ["#", "", [2, 5, 0]]


def test_counts_do_not_depend_on_grouping():
    made = [html.wrapper(html.parse(s)) for s in ("<p>a", "<div>b</div><p>c<p>d", "<p>e<div>f</div>", "<ul><li>g</ul>")]
    total = lambda w: w[2][0] if w[0] == "#" else sum(map(total, w[2]))
    left = html.merge(html.merge(html.merge(made[0], made[1]), made[2]), made[3])
    right = html.merge(html.merge(made[0], made[1]), html.merge(made[2], made[3]))
    assert total(left) == total(right) == 7


def test_odd_rows(spark):
    long = "<article>" + "<p>some words here</p>" * 20_000 + "</article>"
    rows = [(1, None, None), (2, "", ""), (3, "no url", "<p>plain text"), (4, "http://h/x", long), (4, "http://h/x", long),
            (None, "http://h/y", "<article><p>a < b &amp; c</article>"), (5, "//H", "<"), (6, "http://h/z", "<div <p title='>'>x</div></div>")]
    df = spark.createDataFrame([(*r, "w") for r in rows], "page_id long, url string, html string, wrapper string")
    got = sorted(((r.id or 0, r.text) for r in html.main_text(df).collect()))
    whole = "\n\n".join(["some words here"] * 20_000)
    assert got == [(0, "a < b & c"), (1, ""), (2, ""), (3, "plain text"), (4, whole), (4, whole), (5, "<"), (6, "x")]
    assert html.main_text(df.limit(0)).count() == 0


def test_join_gives_what_broadcasting_gives(spark, monkeypatch):
    want = set(queries.op6_html(spark, SF_DIR).collect())
    monkeypatch.setattr(html, "BROADCAST", 0)
    assert set(queries.op6_html(spark, SF_DIR).collect()) == want


def test_deep_and_wide_pages():
    deep = "<article>" + "<div>" * 5000 + "words <p>and more" + "</div>" * 5000 + "<p>end</article><p>after"
    tree = html.parse(deep)
    found = html.extract(tree, html.merge(html.wrapper(tree), html.wrapper(tree)))
    assert found.split() == ["words", "and", "more", "end"]
    wide = "".join(f"<{'abcdefghij'[i % 7]}x{'q' * (i * i % 53)}>t{i}</{'abcdefghij'[i % 7]}x{'q' * (i * i % 53)}>" for i in range(3000))
    tree = html.parse(wide)
    both = html.merge(html.wrapper(tree), html.wrapper(tree))
    assert html.extract(tree, both).split() == [f"t{i}" for i in range(3000)]


def test_self_closed_icons_swallow_nothing():
    tree = html.parse('<article><p>one <svg class="i" title="a > b"/> two</p><math/><p>three <svg><path/>no</svg>four</article><p>after')
    assert html.extract(tree, html.wrapper(tree)) == "one two\n\nthree four"


def test_names_of_what_holds_the_article():
    text = lambda page: html.extract(html.parse(page), html.wrapper(html.parse(page)))
    for names in ("single-post has-sidebar", "no-sidebar", "comments-open", "tag-navy", "post hentry category-legal", "sidebar"):
        assert text(f'<body class="{names}"><article><p>words</p></article><div class=sidebar><p>no</div></body>') == "words", names
        assert text(f'<body><article class="{names}"><p>words</article><div class="post-comments"><p>no</div>') == "words", names
        assert text(f'<div class="{names}"><main><p>words</main></div><div id=comments-area><p>no</div>') == "words", names
    for names in ("has-sidebar", "no-sidebar", "comments-open", "tag-navy", "category-legal"):
        assert text(f'<div class="{names}"><p>words</div><div class="site-footer"><p>no</div>') == "words", names
    related = '<div class="related-posts"><article><p>no</article></div><div id=comments><article class="comment-body"><p>no</article></div>'
    assert text(f"<div class=sidebar-layout><article><p>words</article></div>{related}") == "words"


def test_page_trees_of_any_depth():
    deep = "<article>" + "<div>" * 3000 + "one<p>two<nav>no</nav><aside>no<p>no</aside><select><option>no</select><p>three" + "</div>" * 3000
    for page in (deep + "</article><footer>no</footer>", "<div>" * 90 + "<b>" + deep + "</article></div><footer>no</footer><p>"):
        tree = html.parse(page)
        assert html.extract(tree, html.merge(html.wrapper(tree), html.wrapper(tree))) == "one\n\ntwo\n\nthree"
    many = html.parse("<section>" * 200_000 + "words" + "</article></p>" * 200_000)
    assert html.extract(many, html.wrapper(many)) == "words"


def test_long_sequences_keep_their_places():
    def page(first, kinds):
        return html.parse("<div>" + "".join(f"<x{i % 5}{i * i % 7}q{'z' * (i % 3)}>t{i}</x{i % 5}{i * i % 7}q{'z' * (i % 3)}>" for i in range(first, kinds)) + "</div>")

    one, two = page(0, 900), page(40, 1000)
    both = html.merge(html.wrapper(one), html.wrapper(two))
    assert sum(n[2][0] for n in html._slots(both)) == 1860 and len(both[2][0][2]) >= 90
    assert [html._anchors([["a"], ["b"], ["c"], ["b"]], [["c"], ["a"], ["b"]]), html._anchors([], [])] == [[(2, 0)], []]
    for tree, span in ((one, range(900)), (two, range(40, 1000))):
        assert html.extract(tree, both).split() == [f"t{i}" for i in span]


def test_links_in_an_article_stay():
    body = "<p>words<p><a href=1>Read the report</a><p>more<ul><li><a href=2>A long linked source</a><li>B</ul>"
    want = "words\n\nRead the report\n\nmore\n\nA long linked source\n\nB"
    for page in (f"<article>{body}</article>", f"<main>{body}</main>", f'<div class="entry-content">{body}</div>'):
        tree = html.parse("<div><a href=0>Home</a></div>" + page + "<ul><li><a href=3>Next</a></ul>")
        assert html.extract(tree, html.merge(html.wrapper(tree), html.wrapper(tree))) == want, page
    tree = html.parse("<article><h1>Links</h1><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></article>")
    assert html.extract(tree, html.wrapper(tree)) == "Links\n\nOne\n\nTwo"


def test_texts_that_all_pages_of_a_host_have_are_template(spark):
    def page(i):
        menu = "<div class=css-1x2y><div>Home</div><div>About</div></div><div class=css-9z><p>We may use your data.</div>"
        body = "".join(f"<p>Words {i} {j} of this page.</p>" for j in range(i % 3 + 1))
        return f"{menu}<div class=css-7q><h1>Title {i}</h1>{body}<p>Written by our staff.</p></div><div>All rights reserved</div>"

    def want(i):
        return "\n\n".join([f"Title {i}", *[f"Words {i} {j} of this page." for j in range(i % 3 + 1)]])

    made = [html.wrapper(html.parse(page(i))) for i in range(6)]
    left = right = made[0]
    for w in made[1:]:
        left = html.merge(left, w)
    right = html.merge(html.merge(made[5], html.merge(made[1], made[3])), html.merge(made[2], html.merge(made[4], made[0])))
    assert html.template(left) == html.template(right) != frozenset()
    rows = [(i, "http://h/x", page(i)) for i in range(6)] + [(i, "http://copies/x", page(1)) for i in range(6, 12)]
    rows += [(12, "http://a/", "<article><h2>Sources</h2><p>1</article>"), (13, "http://a/", "<article><h2>Sources</h2><p>2</article>"),
             (14, "http://a/", "<article><h2>Sources</h2><p>3</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.id: r.text for r in html.main_text(df).collect()}
    assert [got[i] for i in range(6)] == [want(i) for i in range(6)]
    assert all(got[i].startswith("Home\n\nAbout") for i in range(6, 12))  # one page tells nothing
    assert [got[i] for i in (12, 13, 14)] == [f"Sources\n\n{i}" for i in (1, 2, 3)]


@pytest.mark.parametrize("piece", [
    "<a ", '<a "', "<a \"<a' ", "<!", "<?x ", "</", "<", '<svg "></svg>"', "<svg ", "x<b>", "<!--", "<script ", "<p class='", "</p>",
])
def test_tags_that_are_never_closed_take_linear_time(piece):
    """A page of a megabyte is read in a time that a quadratic scan would exceed by far, and what comes before is kept."""
    page = "<body><article><p>kept words</p>" + piece * ((1 << 20) // len(piece))
    began = time.perf_counter()
    tree = html.parse(page)
    found = html.extract(tree, html.wrapper(tree))
    assert time.perf_counter() - began < 20
    assert found.startswith("kept words")


def test_quotes_without_a_partner_and_cut_pages():
    of = lambda page: html.extract(html.parse(page), html.wrapper(html.parse(page)))
    assert of('<article><p title="x>one</p><p>two') == "one\n\ntwo"
    assert of("<article><p>1 < 2 and 3 <4 </ 5<p>it</p><a hre") == "1 < 2 and 3 <4 </ 5\n\nit"
    assert of('<article><p>a<svg x=">"/>b<math/>c<svg><p>no</svg >d') == "abcd"

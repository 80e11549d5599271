import pytest

from skylane.llm.html_extract import Page, extract_text
from tests.llm.conftest import documents

NAV = "<div><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></div>"


@pytest.mark.parametrize("html,text", [
    ("<article>foo<b>bar</b>baz<br>x&nbsp;y &lt;z&#33;</article>", "foobarbaz x y <z!"),
    ("<body>a<p>b<p>c<ul><li>d<li>e</ul><nav>m</nav><script>var '</p>'</script>t", "a b c d e t"),
    ("<article><p>one<aside>no</aside>two</p><div class='ad'>x</div><div id=comments><article>c</article></div>end</article> t",
     "one two end"),
    ("plain & simple", "plain & simple"), ("", ""), ("<p>unclosed <b>bold<br><p>next", "unclosed bold next"),
    ("<header>no</header><main><header><h1>T</h1></header>b</main><footer>no</footer>", "T b"),
    ("<!-- c --><article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"),
    ("<article>a<form><input>no</form>b<button>no</button><style>p{}</style></article>", "a b"),
    ("<article><p>1 < 2 and 3 > 2</p></article><!-- open", "1 < 2 and 3 > 2"),
    ("<div role=navigation>no</div><div class='cookie-notice'>no</div>yes", "yes"),
    ("</p></div>stray<b></i>text", "straytext"), ("<script>never closed <p>x", ""),
    ("<article><h1>T</h1><span class='share'>no</span> r</article>", "T r"),
])
def test_rules(html, text):
    assert Page(html).text() == text


def test_site_template(spark):
    """An unmarked box on many articles of one host goes; a repeated paragraph
    and a box of another host stay; copies of one page make no template."""
    box = "<div><p>Read our other stories</p></div>"
    page = lambda i, host: (i, f"http://{host}/p{i}", f"<article>{box}<p>Body {i % 20} text</p><p>Same words</p></article>")
    rows = [page(i, "A.example") for i in range(12)] + [page(i, "b.example") for i in range(100, 103)]
    rows += [(200 + i, "https://user@c.example:80/x", f"<article>{box}<p>One copy</p></article>") for i in range(30)]
    rows += [(300, None, f"<article>{box}x</article>"), (301, "not a url", None), (None, "http://a.example/", ""), (0, *page(0, "a.example")[1:])]
    got = extract_text(documents(spark, rows, "page_id long, url string, html string"), min_articles=8).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert text[3] == "Body 3 text Same words"
    assert text[101].startswith("Read our") and text[205] == "Read our other stories One copy"
    assert text[300] == "Read our other stories x" and text[301] == "" and text[None] == ""
    assert extract_text(documents(spark, [], "page_id long, url string, html string")).count() == 0


def test_long_and_deep():
    assert Page("<div>" * 3000 + "x" + "</div>" * 3000).text() == "x"
    assert len(Page("<article>" + "<p>word word</p>" * 50000).text().split()) == 100000


@pytest.mark.parametrize("html,text", [
    ("<div id=page class='site has-sidebar'><article>a <p>b</article></div>", "a b"),
    ("<div class='content no-sidebar'>a<p>b</div>", "a b"),
    ("<article class='post has-comments'>a<div class='comments'>no</div></article>", "a"),
    ("<article class='social'>a</article>", "a"),
    ("<div class='layout-sidebar'><div class='main-menu'>no</div><main>long text here</main></div>", "long text here"),
    ("<div class='widget'><p>all the text</p></div>", "all the text"),
    ("<article>short</article><div class='comment-list' id=comments><article>a far longer comment</article></div>", "short"),
    ("<p>the page's own text</p><div id=comments><article>c</article></div>", "the page's own text"),
    ("<div class='left-sidebar wide'>no</div><div class='sidebar-closed'>yes</div>", "yes"),
])
def test_wrappers_named_like_boilerplate(html, text):
    assert Page(html).text() == text


def test_template_by_share(spark):
    """What a few articles of a large host share stays, a menu outside the
    article on a share of them and a box in most articles go."""
    shared, menu, box = "<table><tr><td>quoted</table>", "<div>our menu</div>", "<div>read more</div>"
    rows = [(i, f"http://a.example/{i}", f"<article>{box}<p>Body {i}</p>{shared if i < 30 else ''}</article>") for i in range(90)]
    rows += [(1000 + i, f"http://b.example/{i}", f"{menu if i < 20 else ''}{shared if i >= 192 else ''}<p>Body {i}</p>")
             for i in range(200)]
    text = {r.page_id: r.text for r in extract_text(documents(spark, rows, "page_id long, url string, html string")).collect()}
    assert text == {i: f"Body {i}{' quoted' if i < 30 else ''}" for i in range(90)} \
        | {1000 + i: f"{'quoted ' if i >= 192 else ''}Body {i}" for i in range(200)}

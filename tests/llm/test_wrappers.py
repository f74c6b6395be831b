"""Main text of pages whose parts are known, and what wrappers find where the markup names nothing."""

import json
import random

import pytest

from yieldloom.llm import wrappers

RULES = None


def page(body, head="<title>T</title>"):
    return f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8">{head}<style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>{body}</body></html>'


CASES = [
    ("", ""),
    (None, ""),
    ("just text &amp; more", "just text & more"),
    (page("<nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>Ti&eacute;tle</h1><p>One\n  two&nbsp;three<br>four</p><p></p><p>Last</article><footer>x</footer>"), "Tiétle\n\nOne two three four\n\nLast"),
    (page("<article><header><h1>Head</h1></header><p>a <b>b</b> c<div class='ad'>Buy</div><p>d</p><aside>side</aside><form>in<input></form><section class='comments'><p>me too</p></section></article>"), "Head\n\na b c\n\nd"),
    (page("<main><p>m</p><div id='cookie-banner'>ok?</div><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></main><div class='sidebar'>s</div>"), "m\n\none\n\ntwo\n\nc1\n\nc2"),
    (page("<div role='main'><p>r</p><p hidden>no</p><p style='display: none'>no</p><p aria-hidden='true'>no</p></div><div role=\"navigation\">n</div>"), "r"),
    (page("<article><div class='article-header'><h1>Kept</h1></div><p title='a > b'>x &lt;b&gt; &#233;&#x4e2d;</p><!-- <p>no</p> --><noscript>no</noscript><button>no</button></article>"), "Kept\n\nx <b> é中"),
    ("<article><p>never closed <b>bold <i>both", "never closed bold both"),
    ("<p>a<!-- open comment <p>b</p>", "a"),
    ("<article>a</article><script>if (a < b) { '<p>' }", "a"),
    ("<head><title>no</title><p>body without a tag</p>", "body without a tag"),
    ("a < b and <3 <p>c", "a < b and <3\n\nc"),
    ("<article>" + "<div>" * 200 + "deep" + "</div>" * 200 + "</article>", "deep"),
    ("<article><p>" + "word " * 100_000 + "</p></article>", ("word " * 100_000).strip()),
    ("<a '" * 5000 + ">x", "x"),
]


@pytest.mark.parametrize("source, want", CASES, ids=range(len(CASES)))
def test_single_pages(source, want):
    assert wrappers.main_text(source, RULES) == want


def unnamed(rng, i):
    """A page of a site that names nothing: menu, notice and footer are plain divs that all pages share."""
    own = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet elit sed do".split()) + str(rng.randrange(99)) for _ in range(n))
    paragraphs = [own(rng.randrange(8, 40)) for _ in range(rng.randrange(1, 9))]
    title = own(5)
    menu = "".join(f"<div><a href='/{k}'>Menu {k}</a></div>" for k in range(5))
    optional = "<h2>" + own(3) + "</h2>" if i % 3 == 0 else ""
    html = page(f"<div class='x1'>{menu}</div><div class='x2'>We use some things. Fine.</div><div class='x3'><h1>{title}</h1>{''.join(f'<p>{p}</p>' for p in paragraphs)}{optional}</div><div class='x4'>Imprint and more</div>")
    heading = [optional[4:-5]] if optional else []
    return html, "\n\n".join([title, *paragraphs, *heading])


def test_wrappers_of_hosts(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for i in range(120):
        html, text = unnamed(rng, i)
        rows.append((i, f"https://user@Host{i % 2}.example.org:80/p/{i}?q=/x", html, "x"))
        want[i] = text
    rows += [(500, None, None, "x"), (501, "no url", "", "x"), (502, None, "<article>found</article>", "x"), (None, "http://h/", "<p>no id</p>", "x"), (0, rows[0][1], rows[0][2], "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(7)
    got = wrappers.extracted(df).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    for i, text in want.items():
        assert by[i]["text"] == text and by[i]["n_chars"] == len(text)
    assert by[500]["text"] == by[501]["text"] == "" and by[502]["text"] == "found" and by[None]["text"] == "no id"


def test_constant_parts_among_equal_labels(spark):
    rows = [
        (i, "http://h/", page(f"<div class='x1'><p>Read this first</p><div>by {i}</div><p>lead {i}</p><h2>Summary</h2><p>some {i}</p><h2>heading {i}</h2><p>more {i}</p></div>"))
        for i in range(12)
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for r in wrappers.extracted(df).collect():
        i = r["page_id"]
        assert r["text"] == "\n\n".join([f"by {i}", f"lead {i}", f"some {i}", f"heading {i}", f"more {i}"])


def test_wrapper_decides_below_named_articles(spark):
    """Teasers named like articles and a text that the site puts into every article are none of it; copies prove nothing."""
    teasers = "".join(f"<div class='post'><a href='/{k}'>See also number {k}</a></div>" for k in range(3))
    rows = [
        (i, "http://many/", page(f"<article><h1>Title {i}</h1><p>Own text {i}</p><div><p>We live on gifts</p></div></article><div class='x'>{teasers}</div>"))
        for i in range(30)
    ]
    rows += [(100 + i, "http://copies/", page(f"<article><h1>One title</h1><p>Text {i % 2}</p></article>")) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    for r in wrappers.extracted(df).collect():
        i = r["page_id"]
        assert r["text"] == (f"Title {i}\n\nOwn text {i}" if i < 100 else f"One title\n\nText {i % 2}")


def test_article_below_many_elements():
    source = page("<div>menu</div>" + "<div>" * 40 + "<article><p>deep</p></article>" + "</div>" * 40 + "<div>end</div>")
    assert wrappers.main_text(source, None) == "deep"


def test_union_free_expression():
    pages = ["<div><p>a</p><p>b</p></div><ul><li>x</ul>", "<div><p>c</p></div>", "<div><h2>t</h2><p>d</p></div><ul><li>x<li>y</ul>"]
    whole = None
    for source in pages:
        own = wrappers.skeleton(*wrappers.read(source))
        whole = wrappers.align(whole, own) if whole else own
    assert whole.expression() == "<page><div>(<h2>text</>)?(<p>#text</>)+</>(<ul>(<li>#text</>)+</>)?</>"
    again = wrappers.Part.unpacked(json.loads(json.dumps(whole.packed())))
    assert again.expression() == whole.expression()


def test_wrapper_size_is_bounded():
    rng = random.Random(1)
    whole = None
    for _ in range(60):
        source = "".join(f"<{rng.choice(['p', 'div', 'h2', 'pre', 'ul'])} class='k{rng.randrange(90)}'>t</>" for _ in range(80))
        own = wrappers.skeleton(*wrappers.read(source))
        whole = wrappers.align(whole, own) if whole else own
    assert len(whole.children) <= wrappers.MOST_PARTS


def test_empty_table(spark):
    assert wrappers.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0

"""Page text against plain patterns on the given pages, and template removal on made sites."""

import html
import re

import pytest

from tagloom.llm import html_text

from .conftest import SF

SCHEMA = "page_id long, url string, html string, text string, n_chars string, key string, host string, marks string"


def text_of(page, templates=()):
    return html_text.main_text(html_text.parse(page), set(templates))


def plain(page):
    """The article of the given pages, whose only tags are h1, p, b and br."""
    article = re.search("<article>(.*?)</article>", page, re.S)[1].replace("<b>", "").replace("<br>", " ")
    blocks = [" ".join(html.unescape(x).split()) for x in re.split("</?p>|</?h1>", article)]
    return "\n\n".join(x for x in blocks if x)


def extracted(spark, rows, **options):
    frame = spark.createDataFrame([(*r, None, None, None, None, None) for r in rows], SCHEMA).repartition(4)
    got = html_text.extract(frame, **options)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    return {r["page_id"]: r["text"] for r in got.collect()}


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r["page_id"]: r for r in html_text.op13_html(spark, SF).collect()}
    assert len(got) == len(pages)
    for page in pages:
        assert got[page["page_id"]]["text"] == plain(page["html"])
        assert got[page["page_id"]]["n_chars"] == len(plain(page["html"])) and got[page["page_id"]]["url"] == page["url"]


@pytest.mark.parametrize(
    "page,expected",
    [
        ("", ""),
        ("no tags &amp; a &lt;b&gt; &copy &nbsp; x", "no tags & a <b> © x"),
        ("<p>one<p>two <b>bold<br>line</b> <i>it</i>alic</p>three", "one\n\ntwo bold line italic\n\nthree"),
        ("<div>a<p>b</div>c", "a\n\nb\n\nc"),
        ("<ul><li>x<li>y<ul><li>z</ul></ul>", "x\n\ny\n\nz"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2\n\n3"),
        ("<script>if (a < b) '</p>'</script><style>p{}</style>kept<!-- <p>not</p> -->", "kept"),
        ("<script>never closed <p>x", ""),
        ("a <!-- open", "a"),
        ("a < b and c > d, 1<2", "a < b and c > d, 1<2"),
        ('<a title="x > y" href=\'<p>\'>link</a>', "link"),
        ("<nav>menu</nav><header>top</header><main><header><h1>T</h1></header><p>body<aside>side</aside></main><footer>f</footer>", "T\n\nbody"),
        ('<article><p>text</p><div class="reader-comments"><p>no</p></div><form>mail?</form><p hidden>h</p></article>after', "text"),
        ('<div class="add-ons">kept</div><div class="top ad">gone</div><div role="banner">gone</div><div style="display: none">gone</div>', "kept"),
        ("<body>x</b></p></div>y<article></article></body>", "xy"),
        ("<pre>a\n  b</pre><p>&#x41;&#66;&hellip;&nosuch;</p>", "a b\n\nAB…&nosuch;"),
        ("<article><p>one</p></article><div>between</div><article><p>two</p></article>", "one\n\ntwo"),
        ("<b>" * 30_000 + "deep" + "<div>" * 3000 + "er", "deep\n\ner"),
    ],
)
def test_pages(page, expected):
    assert text_of(page) == expected


def test_templates_of_a_host_are_removed(spark):
    """Unmarked boxes go where they recur on a host, stay where they are rare, and other hosts do not matter."""
    box, note = "<div><h2>About us</h2><p>We are here.</p></div>", "<section><p>Read our book</p></section>"
    rows = []
    for i in range(6):
        rows.append((i, "https://Big.example.org/x", f"<body>{box}<p>Own text {i}</p><p>Second {i}</p></body>"))
    rows.append((10, "http://big.example.org/y?q", f"<p>Without {note}</p>{box}"))
    for i in range(20, 24):
        rows.append((i, "https://small.example.org/", f"<body>{box}<p>Own text {i}</p></body>"))
    for i in range(30, 36):
        rows.append((i, "https://in.example.org/", f"<article><h1>Title {i}</h1>{note}<p>The same licence line</p><p>Own {i}{' long' * 9}</p></article>"))
    got = extracted(spark, rows)
    assert all(got[i] == f"Own text {i}\n\nSecond {i}" for i in range(6)) and got[10] == "Without\n\nRead our book"
    assert all(got[i] == f"About us\n\nWe are here.\n\nOwn text {i}" for i in range(20, 24))
    assert all(got[i] == f"Title {i}\n\nThe same licence line\n\nOwn {i}{' long' * 9}" for i in range(30, 36))
    assert "About us" in extracted(spark, rows, share=1.01)[0] and "About us" in extracted(spark, rows, least=8)[0]


def test_copies_keep_their_text(spark):
    page = "<body><div><p>The only text.</p></div></body>"
    article = "<nav>{}</nav><article><div><h1>T</h1><p>Copied text</p></div></article>"
    rows = [(i, f"https://a.example.org/{i}", page) for i in range(30)]
    rows += [(100 + i, "https://b.example.org/", article.format(i)) for i in range(30)]
    got = extracted(spark, rows)
    assert all(got[i] == "The only text." and got[100 + i] == "T\n\nCopied text" for i in range(30))


def test_subtree_hashes_tell_tag_text_and_children():
    marks = [html_text.parse(p).held[0].mark for p in ("<div>a<p>b</p></div>", "<div> a  <p>b</div>", "<div>a<p>c</div>", "<section>a<p>b</section>", "<div><p>b</p>a</div>")]
    assert marks[0] == marks[1] and len(set(marks)) == 4


def test_messy_and_empty(spark):
    rows = [(1, None, None), (2, "", ""), (None, "not a url", "<p>x"), (None, "not a url", "<p>x"), (5, "http://", "x" * 300_000), (6, "//h/p", "<p>" * 50_000 + "y")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got) == sorted(
        [(1, "", 0), (2, "", 0), (0, "x", 1), (0, "x", 1), (5, "x" * 300_000, 300_000), (6, "y", 1)]
    )
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).count() == 0

"""Page extraction: parsing, alignment, and pages side by side."""

import random

from skygrid.llm import pages
from skygrid.llm.html_blocks import blocks

SCHEMA = "page_id long, url string, html string, text string, path int"


def plain_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_alignment_is_a_longest_one():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in "ab")
        found = pages.shared_lines(a, b)
        rest = iter(b)
        assert all(x in rest for x in [a[i] for i in sorted(found)]) and len(found) == plain_lcs(a, b)


ARTICLE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
<header class="site">Site</header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad <p> --><div class="ad">Buy</div>
<article><h1>A &lt;title&gt;</h1><p><b>First  par<i>a</i>graph&nbsp;&eacute;.<br>More<p>Second<ul><li>one<li>two</ul><aside>Side</aside>
<div class="cookie-notice">We use</div><form>Name <input name=x></form><section class="comments"><p>Nice!</p></section><p></p>Tail</article>
<footer>&copy; Site</footer></body></html>"""


def test_article_blocks():
    body = [t for p, t in blocks(ARTICLE) if p == "body"]
    assert body == ["A <title>", "First paragraph é. More", "Second", "one", "two", "Tail"]


def test_odd_markup():
    assert blocks("") == [] and blocks("plain  text") == [("other", "plain text")]
    assert blocks("a < b and <p>c</p") == [("other", "a < b and"), ("other", "c</p")]
    assert blocks("</div></p>x<script>never closed") == [("other", "x")]
    assert [t for _, t in blocks("<p title='a>b'>x</p><P>y</P>")] == ["x", "y"]


def test_pages_of_a_host(spark):
    site = lambda text: f"<body><div>Home of all</div>{text}<p>All rights kept here</p></body>"
    rows = [
        (1, "http://a.com/x/1", site("<p>One story</p><p>told twice</p><p>and more</p>")),
        (2, "http://a.com/x/2", site("<p>Two story</p><p>told once</p><p>and less</p>")),
        (3, "http://b.com/", ARTICLE), (4, "http://b.com/", ARTICLE),
        (5, None, None), (6, "no url", ""), (6, "no url", ""), (None, "http://c.com", "<p>" + "long text " * 50_000),
    ]
    docs = spark.createDataFrame([(*r, "t", 1) for r in rows], SCHEMA).coalesce(1)
    out = pages.extract(docs).collect()
    got = {r.page_id: r for r in out}
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert got[1].text == "One story\ntold twice\nand more" and got[2].text == "Two story\ntold once\nand less"
    assert got[3].text == got[4].text == "A <title>\nFirst paragraph é. More\nSecond\none\ntwo\nTail"
    assert got[5].text == got[6].text == "" and got[None].n_chars == 10 * 50_000 - 1
    assert pages.extract(docs.filter("page_id < 0")).count() == 0


def test_copies_without_articles_keep_their_text():
    lines = [("other", f"line {i}") for i in range(9)]
    assert pages.main_text(lines, [lines]) == "\n".join(t for _, t in lines)
    assert pages.main_text(lines, []) == "\n".join(t for _, t in lines)


def test_lines_that_all_pages_of_a_host_have_leave_articles_too(spark):
    """Lines of some pages only, and those of copies, stay."""
    shared = "<p>Read more on our app today</p>"
    page = lambda i: f"<article><h1>Title {i}</h1>{shared}<p>Story {i} is told</p>{'<p>And so on.</p>' if i % 2 else ''}</article>"
    rows = [(i, f"http://a.com/{i}", page(i)) for i in range(8)]
    rows += [(10 + i, f"http://copies.com/{i}", page(1)) for i in range(8)]
    rows += [(20 + i, f"http://two.com/{i}", page(i)) for i in range(2)]
    docs = spark.createDataFrame([(*r, "t", 1) for r in rows], SCHEMA).coalesce(1)
    got = {r.page_id: r.text for r in pages.extract(docs).collect()}
    for i in range(8):
        assert got[i] == f"Title {i}\nStory {i} is told" + ("\nAnd so on." if i % 2 else "")
        assert got[10 + i] == "Title 1\nRead more on our app today\nStory 1 is told\nAnd so on."
    assert got[20].split("\n")[1] == got[21].split("\n")[1] == "Read more on our app today"

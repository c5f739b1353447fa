import re
from collections import Counter
from html import unescape

from hypothesis import given, settings, strategies as st

from lectern.llm import html

PAGE = """<html><body><header class="site-header"><h1>Site</h1></header><div id=wrap><div class="post post-{n}"><header class="entry-header"><h1>Title {n}</h1></header>
<p>Hello &lt;b&gt; w&ouml;rld<br>next&nbsp;x <a href=x>link</a> {body}<ul><li>one<li>two</ul><script>if(a<b){{"</p>"}}</script><div class="share-buttons">Share!</div>
<p>the end</div><div class="sidebar">side</div><section id="comments"><p>bad comment</section></div><form><p>field</p></form><footer>f</footer>"""


def test_page_with_everything():
    page = html.parse(PAGE.format(n=7, body="words " * 30))
    assert page.path(html.vote(page)[0]) == "html>body>div>div.post.post-#"
    assert html.text_of(page, None).split("\n\n") == ["Title 7", "Hello <b> wörld next x link " + ("words " * 30).strip(), "one", "two", "the end"]


def test_hosts_agree(spark):
    """A page whose own text is too short to tell gets the path that the other pages of its host voted for."""
    rows = [(i, f"http://h.example/{i}", PAGE.format(n=i, body="words " * 40)) for i in range(8)]
    odd = "<html><body><div><div class='post post-9'><p>short</p></div><div class='x'><p>other words that are no article</p></div></div>"
    rows += [(9, "http://h.example/9", odd), (10, "http://alone.example/", odd)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[9] == "short" and got[10] == "short\n\nother words that are no article" and got[0].startswith("Title 0\n\nHello")


def test_given_pages(spark):
    def simple(page):
        inner = re.search(r"<article>(.*)</article>", page, re.S)[1].replace("<br>", " ")
        blocks = (" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        return "\n\n".join(b for b in blocks if b)

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {r.page_id: simple(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in html.extract(pages).collect()} == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/!-ab p=\"'&;scriptdv\n", max_size=120))
def test_nothing_raises(text):
    html.text_of(html.parse(text), "p>div")


def test_deep_and_broken_pages():
    assert html.text_of(html.parse("<div>" * 5000 + "deep"), None) == "deep"
    assert html.text_of(html.parse("<p><b>x" * 3000 + "</i>" * 50), None).count("x") == 3000
    html.parse('<a "' * 5000)


def test_edges(spark):
    rows = [(1, None, "<p>a</p>", "h", "p"), (None, "http://x/", "<p>b</p>", "h", "p"), (2, "http://x/", None, "h", "p"), (3, "http://x/", "", "h", "p"),
            (4, "http://x/", "<p>c</p>", "h", "p"), (4, "http://x/", "<p>c</p>", "h", "p"), (5, "bad url", "<p>" + "long " * 100_000, "h", "p")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, path string")
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in html.extract(pages).collect())
    texts = {"<p>a</p>": "a", "<p>b</p>": "b", "<p>c</p>": "c", None: "", "": ""}
    assert got == Counter((r[0], r[1], t, len(t)) for r in rows for t in [texts.get(r[2], ("long " * 100_000).strip())])
    assert html.extract(pages.limit(0)).collect() == []


def test_headings_ledes_and_last_sections_outside_the_body_stay(spark):
    body = "<p>" + "words of the body " * 60 + "</p>"
    lede = "<html><body><nav>menu</nav><article><h1>Title</h1><p>The lede.</p><div class=body>" + body + "</div></article><footer>f</footer>"
    last = "<html><body><div id=w><div class=body>" + body + "</div><section class=end><p>A short last section.</p></section></div><footer>f</footer>"
    half = "<html><body><article><h1>Other</h1><p>" + "a long lede " * 40 + "</p><div class=body><p>rest</p></div></article>"
    plain = "<html><body><article><div class=body>" + body + "</div></article>"
    text = ("words of the body " * 60).strip()
    want = {1: f"Title\n\nThe lede.\n\n{text}", 2: f"{text}\n\nA short last section.", 3: "Other\n\n" + ("a long lede " * 40).strip() + "\n\nrest", 4: text}
    pages = [(1, "http://a/1", lede), (2, "http://b/2", last), (3, "http://a/3", half), *((n, f"http://a/{n}", plain) for n in range(4, 9))]
    pages += [(20 + n, "http://b/x", "<html><body><div id=w><div class=body>" + body + "</div></div>") for n in range(5)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert {n: got[n] for n in want} == want

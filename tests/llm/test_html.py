"""HTML extraction: hand-made pages, a site without marks, edge cases, the given pages' known frame."""

from __future__ import annotations

import re
from html import unescape

from termlens.llm import html as H
from termlens.llm.queries import op9_html

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad <p>x</p> --><div class="ad">Buy</div>
<article><header><h1>Head&nbsp;line</h1></header><p><b>One &lt;two&gt;<br>three<p>Fo<i>ur</i>  five
six<div class="cookie-notice">We use</div><ul><li>a<li>b</ul><form><input>Sign</form>
<section id="comments"><article>reader says</article></section><aside>side</aside>tail</article><footer>&copy; x</footer></body></html>"""


def text(page):
    found, article = H.blocks(page)
    return "\n".join(t for t, m, _, _ in found if m == H.KEEP), article


def test_marked_page():
    assert text(PAGE) == ("Head line\nOne <two> three\nFour five six\na\nb\ntail", True)


def test_broken_pages():
    assert text("<nav><ul><li>m<article><p>x<p>y")[0] == "x\ny"
    assert text("<article><p>a < b & c &notanentity; <p title='>'>q<p title=\"unfinished>r</article>z")[0].startswith("a < b & c")
    assert text("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>next")[0] == "deep\nnext"
    assert text(None) == text("") == ("", False)
    assert text("<article><p>x</p><scr")[0] == "x"
    assert text("<MAIN><P CLASS=x>Up</P></MAIN>")[0] == "Up"


def test_site_style_tree(spark):
    rows = []
    for k in range(12):
        body = " ".join(f"word{k}x{j}" for j in range(30))
        rows.append((k, f"http://s.example.com/{k}", f"<body><div class=top><b>Site name</b> Welcome all</div><div class=text><p>{body}</p><p>more {k}</p></div><div>Read more here</div></body>"))
    rows += [(50, "http://other.example.com/1", rows[0][2]), (51, None, "<p>no url</p>"), (52, "http://s.example.com/x", None), (53, "", "")]
    out = {r.page_id: r.text for r in H.extract(spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, text string")).collect()}
    assert len(out) == len(rows)
    for k in range(12):
        assert out[k] == " ".join(f"word{k}x{j}" for j in range(30)) + f"\nmore {k}"
    assert out[50].startswith("Site name Welcome all\nword0x0") and out[51] == "no url" and out[52] == out[53] == ""
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_given_pages(spark):
    """The given pages' frame is known: the article between its tags, one block per heading or paragraph."""
    from tests.conftest import SF_SMALL

    raw = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    out = op9_html(spark, SF_SMALL).collect()
    assert len(out) == len(raw)
    for r in out:
        inner = re.search(r"<article>(.*?)(</article>|<footer|$)", raw[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:p|h1|h2|ul|li|div)>", inner)
        want = [" ".join(unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0].startswith("<br") else "", p)).split()) for p in parts]
        assert r.text == "\n".join(w for w in want if w) and r.n_chars == len(r.text)


def test_repeated_branches_inside_articles(spark):
    """What a host's articles repeat goes, as an element or as one paragraph among others; copied pages and other hosts keep their text."""
    def words(k):
        return " ".join(f"word{k}x{j}" for j in range(30))

    rows = [(k, f"http://s.example.com/{k}", f"<article><h1>title {k}</h1><p>{words(k)}</p><p>{words(k + 500)}</p>"
             f"<p>Try our app, 9 days free.</p><div class=qz>Read also <b>this</b> story</div></article>") for k in range(20)]
    rows += [(100 + k, f"http://copies.example.com/{k}", f"<main><p>{words(7)}</p><p>{words(8)}</p></main>") for k in range(20)]
    rows += [(200, "http://one.example.com/", rows[0][2])]
    out = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(20):
        assert out[k] == f"title {k}\n{words(k)}\n{words(k + 500)}"
        assert out[100 + k] == f"{words(7)}\n{words(8)}"
    assert out[200].endswith("Try our app, 9 days free.\nRead also this story")

"""Main text of pages: the given pages against a plain reading of their markup, and odd pages."""

from __future__ import annotations

import html
import re

import pyarrow.parquet as pq
import pytest

from caseloom.llm import pages


def page(article, host_part="", comments=""):
    return (f"<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>';</script></head><body><header><p>Masthead</p></header>"
            f"<nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies</div><div class=\"ad\">Buy</div>{host_part}"
            f"{article}<aside>Side</aside><div id=comments><h3>Comments</h3><p>Reader speaks</p></div>{comments}<form><label>Mail</label></form>"
            f"<footer>&copy; x</footer></body></html>")


def rows(spark, items):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in items], "page_id bigint, url string, html string, host string")


def test_given_pages(spark, sf):
    """They hold one article of h1 and p with unclosed elements; a split at block tags reads it."""
    raw = pq.read_table(f"{sf}/pages.parquet").to_pylist()
    want = {}
    for r in raw:
        body = re.search(r"<article>(.*)</article>", r["html"], re.S).group(1)
        parts = re.split(r"</?(?:h1|p)>", body)
        texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
        want[r["page_id"]] = "\n".join(t for t in texts if t)
    got = pages.main_text(spark.read.parquet(f"{sf}/pages.parquet")).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_other_matter_is_left_out(spark):
    items = [(i, f"https://a.example/{i}", page(f"<article><h1>Title {i}</h1><p>One &amp; two\n  {i}<br>three<p>Same for all<ul><li>a<li>b</ul></article>")) for i in range(5)]
    items += [(10 + i, f"https://b.example/{i}", page(f"<div class=content><h1>Name {i}</h1><div class=text><p>Story {i} " + "word " * 30 + "</p><p>Always here</p></div></div>")) for i in range(6)]
    items += [(20, "https://alone.example", page("<main><p>Only &lt;one&gt;</p></main>")), (21, None, "plain <b>text</b>"), (22, "u", None), (23, "u", ""),
              (24, "https://a.example/9", "<p>no article here"), (None, "x", "<article>&nbsp;a<td>b</article>"), (25, "w", "<scr<script>x</script><article>1 < 2 <p>&#233;"),
              (26, "w", page("<article>A<article class='comment'>no</article>B</article>"))]
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in pages.main_text(rows(spark, items)).collect()}
    assert len(got) == len(items)
    for i in range(5):
        assert got[(i, f"https://a.example/{i}")][0] == f"Title {i}\nOne & two {i} three\nSame for all\na\nb"
    for i in range(6):
        assert got[(10 + i, f"https://b.example/{i}")][0] == f"Name {i}\nStory {i} " + ("word " * 30).strip()
    assert got[(20, "https://alone.example")][0] == "Only <one>"
    assert got[(21, None)][0] == "plain text"
    assert got[(22, "u")] == ("", 0) and got[(23, "u")] == ("", 0)
    assert got[(24, "https://a.example/9")][0] == "no article here"
    assert got[(None, "x")][0] == "a b"
    assert got[(25, "w")][0].endswith("1 < 2\né")
    assert got[(26, "w")][0] == "A\nB"


def test_classes_and_nesting(spark):
    items = [(i, f"https://a.example/{i}", page(f"<article><p>{i}</p></article>", host_part="<p>Now</p>" if i < 2 else "")) for i in range(6)]
    keyed = rows(spark, items).selectExpr("'a' AS host", "xxhash64(page_id) AS page_key", "html")
    template = pages.templates(keyed).collect()
    texts = [r for r in template if r.is_text]
    assert {r.pages for r in template} == {6}  # what two of six pages have is no template
    assert len({r.class_key for r in template if not r.is_text and r.main}) == 1 and not texts
    # elements that stand once on every page share one vector
    assert len({r.class_key for r in template if r.role in {t.role for t in template if t.main == 2}}) == 1


def test_nothing_from_nothing(spark):
    assert pages.main_text(rows(spark, [(1, "u", "a")]).where("page_id < 0")).collect() == []


@pytest.mark.parametrize("text", ["<", "<!--", "<a", "</", "<a b='", "&#xffffffff;&#0;&unknown;", "\x00<p>\x00", "<p " + "x" * 50000])
def test_broken_markup(text):
    pages.structure(text)


@pytest.mark.parametrize("body", ["for(var i=0;i<n;i++){f(i)}", "var a = \"it's\"; if (a<b) { c = '<p' }", "var s = '<!--';", "if (a<b) x('", "/* </scripts> */ i<n"])
@pytest.mark.parametrize("name", ["script", "STYLE"])
def test_raw_bodies_end_at_their_own_tag(body, name):
    page_text = f"<html><head><{name} type='x'>{body}</{name.swapcase()} ></head><body><article><p>One</p><{name}>{body}</{name}><p>Two</p></article></body></html>"
    assert pages.text_of(page_text, None, None, frozenset()) == "One\nTwo"


def test_raw_body_without_an_end():
    assert pages.text_of("<article>a<p>b<script>i<n <p>c</article>", None, None, frozenset()) == "a\nb"
    assert pages.text_of("<article>a<svg><p>b</article>", None, None, frozenset()) == "a\nb"


@pytest.mark.parametrize("opened,closed", [
    ("<div class='content has-sidebar'>", "</div>"), ("<div class='with-sidebar'>", "</div>"), ("<div id='page-header-wrap related'>", "</div>"),
    ("<form action='/'>", "</form>"), ("<form><div class='with-sidebar'><div class='share-bar social'>", "</div></div></form>"),
    ("<main><div class='content has-sidebar'>", "</div></main>")])
@pytest.mark.parametrize("article", ["<article><h1>Title</h1><p>A text of some length</article>", "<main><h1>Title</h1><p>A text of some length</main>",
                                     "<div class=story><h1>Title</h1><p>A text of some length, as long as most of the page</p></div>"])
def test_layout_around_the_article(opened, closed, article):
    if "<main>" in opened and "<article>" not in article:
        return
    around = (f"<html><body>{opened}<nav>Home</nav><div class=ad>Buy</div>{article}<div class=sidebar>Side</div><div class=related><article>Teaser</article></div>"
              f"<div id=comments><p>Reader</p></div><footer>c</footer>{closed}</body></html>")
    if "story" in article:
        around = around.replace("<article>Teaser</article>", "Teaser")
    want = re.sub("<[^>]*>", "\n", article).split("\n")
    assert pages.text_of(around, None, None, frozenset()) == "\n".join(w for w in want if w)


def test_other_matter_stays_out_beside_the_article():
    around = "<body>{}<article>Text</article><form>Mail <article>me</article></form><div class=related><article>A much longer teaser</article></div></body>"
    assert pages.text_of(around.format(""), None, None, frozenset()) == "Text"
    assert pages.text_of("<main><p>Text of the page, long</p><div class=comments><article>Reader</article></div></main>", None, None, frozenset()) == "Text of the page, long"
    assert pages.text_of("<body><p>Some text of a page</p><form>Mail</form><aside><article>Teaser</article></aside>", None, None, frozenset()) == "Some text of a page"


def plain(i, inner, html_class=""):
    return (f"<html><body><div class=head{html_class}><p>Site name</p></div><div class=content><h1>Name {i}</h1><div class=text>{inner}</div></div>"
            f"<div class=end><p>All about it</p></div></body></html>")


def texts_of(spark, items):
    return {r.page_id: r.text for r in pages.main_text(rows(spark, [(i, f"https://a.example/{i}", h) for i, h in items])).collect()}


def test_frequent_text_of_no_class_stays(spark):
    """A sentence on most pages that moves with no element is text; what stands on every page in the same place is template."""
    items = [(i, plain(i, f"<p>Story {i} of some words" + ("<p>See you soon" if i % 3 else "") + ("<p>More" * (i % 4)))) for i in range(9)]
    got = texts_of(spark, items)
    for i in range(9):
        assert got[i] == "\n".join([f"Name {i}", f"Story {i} of some words", *["See you soon"] * (i % 3 > 0), *["More"] * (i % 4)])


def test_text_of_a_class_with_elements_goes(spark):
    promo = "<div class=box><b>New</b><p>Read the weekly letter</div>"
    got = texts_of(spark, [(i, plain(i, f"<p>Story {i}" + (promo if i % 3 else "") + "<p>More" * (i % 4))) for i in range(9)])
    assert not any("weekly" in t for t in got.values())


def test_copies_are_no_support(spark):
    items = [(i, plain("A", "<p>A text that was copied<p>in two parts")) for i in range(7)] + [(10 + i, plain(i, f"<p>Own {i}")) for i in range(4)]
    got = texts_of(spark, items)
    assert {got[i] for i in range(7)} == {"Name A\nA text that was copied\nin two parts"} and got[10] == "Name 0\nOwn 0"


def test_elements_out_of_order_are_no_template(spark):
    a, b = "<div class=a><p class=pa>First words</p></div>", "<div class=b><p class=pb>Second words</p></div>"
    items = [(i, f"https://a.example/{i}", plain(i, (a + b if i % 2 else b + a) + f"<em class=c>{i}</em>")) for i in range(6)]
    keyed = rows(spark, items).selectExpr("'a' AS host", "xxhash64(page_id) AS page_key", "html")
    role = {}
    for n in pages.structure(items[0][2])[0]:
        role[n.name, n.role] = n
    outer = {n.role for n in role.values() if n.name == "div" and n.up.name == "div" and n.up.up.name == "div"}
    template = {r.role for r in pages.templates(keyed).collect()}
    assert len(outer) == 2 and not outer & template and {n.role for n in role.values() if n.name == "em"} <= template

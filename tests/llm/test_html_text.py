import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from usagelens.llm import html_text

PAGES = "page_id bigint, url string, html string"


def text(html, template=None, names=True):
    return html_text.main_text(html, template, names)


def test_furniture_goes_and_blocks_are_joined():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li>Menu</ul></nav>
    <div class="ad">Buy</div><header>Top</header><article><h1>Head &amp;amp; line</h1><p><b>One&nbsp;two
      three<br>four<p>Five<script>var t="</p>";</script> six<div class="cookie-notice">We use</div><form>Name <input></form>
    <aside>Side</aside><section id="comments"><p>First!</p></section><ul><li>a<li>b</ul></article><footer>&copy; x</footer>"""
    assert text(page) == "Head &amp; line One two three four Five six a b"


def test_unclosed_odd_and_empty_pages():
    assert text("") == "" and text("   ") == "" and text("plain &lt;b&gt; text") == "plain <b> text"
    assert text("<p>a<p>b</div></p>c") == "a b c"
    assert text("<![if !x]><p>ok</p>") in ("ok", "<![if !x]> ok", "<![if !x]>ok")
    assert text("<main><p>m and more</p></main><p>out</p>") == "m and more"
    assert text("<article>one</article><div class=sidebar><article>teaser</article></div><article>two</article>") == "one two"
    assert text("<div class='with sidebar'><article>body</article></div>") == "body"
    assert text("<p>x\x00y</p>").startswith("x")
    assert text("<ul><li>a<ul><li>b</ul><li>c</ul><table><tr><td>d<td>e<tr><td>f</table>") == "a b c d e f"


@pytest.mark.parametrize(
    ("html", "wanted"),
    [
        ("<body class='page has-sidebar'><p>All of the text</p></body>", "All of the text"),
        ("<article><div class='entry-content has-share'><p>Body text here</p></div></article>", "Body text here"),
        ("<article><p>Some text</p><section class='related-work'><p>Earlier studies</p></section></article>", "Some text Earlier studies"),
        ("<article>Teaser one</article><div><p>" + "long body " * 20 + "</p></div><article>Teaser two</article>", "Teaser one " + "long body " * 20 + "Teaser two"),
        ("<article><p>Text of it all</p><article class='comment'><p>First!</p></article></article>", "Text of it all"),
        ("<article><p>Text of it all</p><div class='left-sidebar'>x</div><div class='related-posts'>y</div></article>", "Text of it all"),
        ("<form id=aspnetForm><div><p>A page inside of one form</p></div><nav>Menu</nav></form>", "A page inside of one form"),
        ("<article class='post comments-open'><p>Text</p></article>", "Text"),
    ],
)
def test_names_break_ties_only(html, wanted):
    assert text(html) == wanted


@pytest.mark.parametrize("opening", ["<div>", "<p><div>", "<ul><li>", "<table><div>", "<span>", "<b><p>"])
def test_deep_pages_take_time_in_proportion(opening):
    started = time.perf_counter()
    html_text.main_text(opening * 25_000 + "deep")
    few = time.perf_counter() - started
    started = time.perf_counter()
    assert html_text.main_text(opening * 50_000 + "deep") == "deep"
    assert time.perf_counter() - started < 5 * few + 1


def pages():
    out = []
    for i in range(8):
        body = f"<div><p>Site motto here</p></div><article><h1>Title {i}</h1><p>Text of page {i}</p><div><i>Read our terms</i></div></article>"
        out.append((i, f"https://a.example.com/{i}", f"<html><body>{body}</body></html>"))
    # copies of one article: not a template; no article at all: recurring blocks go
    out += [(20 + i, f"http://B.example.com:80/{i}?x", "<article><p>The same story</p></article>") for i in range(9)]
    out += [(40 + i, f"http://c.example.com/{i}", f"<div>Our shop since 1900</div><p>Offer number {i}</p>") for i in range(6)]
    return out + [(60, None, None), (61, None, ""), (60, None, None), (None, "x", "<p>no host</p>"), (63, "http://d.example.com", "<p>" + "long " * 30000)]


def test_pages_lose_what_their_site_repeats(spark):
    df = spark.createDataFrame(pages(), PAGES).withColumn("host", F.lit(1)).withColumn("found", F.lit(2)).withColumn("text", F.lit("t"))
    got = html_text.extract_pages(df).collect()
    assert Counter((r["page_id"], r["url"]) for r in got) == Counter((p, u) for p, u, _ in pages())
    by_id = {r["page_id"]: r["text"] for r in got}
    assert by_id[3] == "Title 3 Text of page 3"
    assert by_id[24] == "The same story"
    assert by_id[42] == "Offer number 2"
    assert by_id[60] == by_id[61] == "" and by_id[None] == "no host"
    assert by_id[63] == ("long " * 30000).strip()
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_few_pages_are_no_template(spark):
    few = [(i, "http://e.example.com/", f"<p>Same line</p><p>{i}</p>") for i in range(3)]
    assert {r["text"] for r in html_text.extract_pages(spark.createDataFrame(few, PAGES)).collect()} == {f"Same line {i}" for i in range(3)}


def test_unnamed_furniture_beside_the_text_goes_by_its_counts(spark):
    data = [
        (i, "http://f.example.com/", f"<div>Menu {i % 4}: start here</div><article><p>Story {i} line</p><p>Shared line of some stories</p></article><div>Bye {i}</div>")
        for i in range(16)
    ]
    found = {r["subtree"] & (2**64 - 1) for r in html_text.site_templates(spark.createDataFrame(data, PAGES)).collect()}
    for i, _, html in data:
        # without names and without counts all is text; with counts the four menus go, a line of all stories too, the rest stays
        assert text(html, None, names=False).startswith(f"Menu {i % 4}")
        assert text(html, found, names=False) == f"Story {i} line Bye {i}"


def test_counts_equal_brute_force(spark):
    got = {(r["host"], r["subtree"] & (2**64 - 1)) for r in html_text.site_templates(spark.createDataFrame(pages(), PAGES)).collect()}
    hosts = {}
    for _, url, html in pages():
        content, found = html_text.Page(html or "").subtrees()
        host = (url or "").lower().partition("//")[2].partition("/")[0].partition(":")[0]
        for subtree, inside in found.items():
            hosts.setdefault(host, {}).setdefault(content, {})[subtree] = inside or hosts[host].get(content, {}).get(subtree, False)
        hosts.setdefault(host, {}).setdefault(content, {})
    expected = []
    for contents in hosts.values():
        counts = Counter(h for found in contents.values() for h in found)
        for h, n in counts.items():
            inside = any(found.get(h, False) for found in contents.values())
            if (n >= 5 and n >= len(contents) / 2) or (not inside and n >= 3 and n >= len(contents) * html_text.OUTSIDE_SHARE):
                expected.append(h)
    assert Counter(s for _, s in got) == Counter(expected) and expected


def test_counted_templates_alone_change_the_given_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    found = html_text.site_templates(df).groupBy("host").agg(F.collect_list("subtree").alias("found"))
    rows = df.select(F.xxhash64(html_text.host_of(F.col("url"))).alias("host"), "html").where("html IS NOT NULL").join(found, "host").limit(300).collect()
    changed = inside = 0
    for r in rows:
        template = {t & (2**64 - 1) for t in r["found"]}
        changed += text(r["html"], template, names=False) != text(r["html"], None, names=False)
        inside += text(r["html"], template) != text(r["html"])
    assert changed > 60 and inside == 0


def test_empty_table(spark):
    assert html_text.extract_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_texts_are_hashed_only_where_templates_are_looked_for(monkeypatch):
    page = "<body><nav class='top'>Menu</nav><article>" + "<p class='x'>One <b>two</b> three.</p>" * 50 + "</article></body>"
    made, real = [], html_text.text_hash
    monkeypatch.setattr(html_text, "text_hash", lambda text: made.append(text) or real(text))
    assert html_text.main_text(page) == " ".join(["One two three."] * 50)
    assert not made
    html_text.Page(page).subtrees()
    # three texts of every paragraph and the menu; an element's name only once
    assert len(made) <= 3 * 50 + 1 + 7

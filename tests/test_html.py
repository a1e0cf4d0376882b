from pyspark.sql import functions as F

from pageloom.functions.markup import page_blocks
from pageloom.operators.annotate import rule_annotate
from pageloom.operators.html import block_rows, html_blocks, processed_html

SMALL = [
    ("<p>a <b>b</b></p>", "<p>ab</p>"),
    ("<p></p>", "<p></p>"),
    ("<div> </div>", ""),
    ("<div>x<p>y</p>z</div>", "<div>xz</div>\n<p>y</p>"),
    ("<p>a<p>b", "<p>ab</p>\n<p>b</p>"),
    ("<img>", '<img src="" alt="">'),
    ("<img src='a&amp;b' alt src='c'>", '<img src="c" alt="">'),
    ("<div>a<!-- c -->b</div>", "<div>a c b</div>"),
    ("<p>a<!-- c -->b</p>", "<p>ab</p>"),
    ("<div/>x<p/>y", "<p></p>"),
    ("<header><p>x</p></header><p>y", "<p>y</p>"),
    ("<p>a<form><p>b</p></form>c</p>", "<p>ac</p>"),
    ("<header><p>never closed", ""),
    ("<nav><p>n</p></nav><aside><p>s</p></aside>", "<p>n</p>\n<p>s</p>"),
    ("<p>&eacute;&#147;&foo;&amp;&#xD800;&nbsp;x</p>", "<p>é“&foo&�\xa0x</p>"),
    ("<template><h2>t</h2></template>", "<h2></h2>"),
    ("<p><ruby>base<rt>note</rt></ruby></p>", "<p>base</p>"),
    ("<p>t</p></div></p>u<div>v", "<p>t</p>\n<div>v</div>"),
    ("<p>a</br>b<br> c </br> d</p>", "<p>abc  d</p>"),
    ("<div>x<b>q</b>  \n <b>r</b> y</div>", "<div>x\n y</div>"),
    ("<pre><div>x<b>q</b>  \n <b>r</b>y</div></pre>", "<div>x  \n y</div>"),
    ("<TITLE> T </TITLE><H1>h</H1>", "<title>T</title>\n<h1>h</h1>"),
    ("<script>var a='<p>no</p>'</script><p>yes", "<p>yes</p>"),
    ("", ""),
]

PAGE = """<!DOCTYPE html><html><head><title> A page </title><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><p>Home. Away. Everything that one could want to click on here.</p></nav>
<main><h1>Bridges</h1>
<div>Intro <i>only</i> text<p>A bridge joins two banks. It carries a <b>road</b> or a path. Some move.</p></div>
<p>Short one. Two.</p>
<p>Copyright by nobody at all. All rights reserved by everyone, as it should be. Yes.</p>
<p>One long sentence without any second one although it is long enough to count as such</p>
<img src="b.png" alt="Bridge"></main><footer><p>Foot. Note. Nothing to see here, move on to the next page.</p></footer></body></html>"""


def test_small_pages(spark):
    df = spark.createDataFrame([(k, html) for k, (html, _) in enumerate(SMALL)], "k int, html string")
    got = html_blocks(df).select("k", processed_html(F.col("blocks")).alias("text")).collect()
    assert {SMALL[r.k][0]: r.text for r in got} == dict(SMALL)


def test_a_page_in_full(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None)], "k int, html string")
    got = [(r.tag, r.text, r.in_nav) for r in block_rows(html_blocks(df)).orderBy("pos").collect()]
    assert [g[0] for g in got] == ["title", "p", "h1", "div", "p", "p", "p", "p", "img"]
    assert got[1][2] and not got[2][2]
    assert got[3][1] == "Intro  text"
    assert got[4][1] == "A bridge joins two banks. It carries aroador a path. Some move."


def test_own_text_keeps_words_apart_and_does_not_repeat():
    rows, _ = page_blocks("<p>a <b>b</b> c<p>d</p>e")
    assert [(r[1], r[2], r[5]) for r in rows] == [("abcde", "a b ce", "/p[1]"), ("d", "d", "/p[1]/p[1]")]


def test_xpath_counts_removed_siblings():
    rows, _ = page_blocks("<html><body><form></form><form></form><div>x</div><div><p>y</p></div></body></html>")
    assert [r[5] for r in rows] == ["/html[1]/body[1]/div[1]", "/html[1]/body[1]/div[2]/p[1]"]


def test_rejected_markup_is_reported(spark):
    df = spark.createDataFrame([(1, "<![foo[x]]><p>z</p>")], "k int, html string")
    row = html_blocks(df).first()
    assert row.blocks == [] and "foo" in row.html_error


def test_columns_are_kept(spark):
    df = spark.createDataFrame([(1, "<p>x", {"a": "b"})], "k int, html string, m map<string,string>")
    assert html_blocks(df).columns == ["k", "m", "blocks", "html_error"]
    assert html_blocks(df, keep_html=True).first().asDict(True)["html"] == "<p>x"
    assert html_blocks(df, with_text=False).first().blocks[0].text is None


def test_rules_pick_main_text_only(spark):
    df = spark.createDataFrame([(1, "http://u", PAGE)], "seq int, url string, html string")
    for with_text in (True, False):
        found = rule_annotate(html_blocks(df, with_text=with_text)).collect()
        assert [f.annotation.body.value for f in found] == [
            "A bridge joins two banks. It carries a road or a path. Some move."
        ]
    annotation = found[0].annotation
    assert annotation.target.selector.value == "/html[1]/body[1]/main[1]/div[1]/p[1]"
    assert annotation.id.startswith("urn:sha256:") and len(annotation.id) == 75


def test_many_pages_keep_their_rows(spark):
    pages = spark.range(1000).select("id", F.concat(F.lit("<p>"), "id", F.lit("<p>x")).alias("html"))
    got = html_blocks(pages).where(F.col("blocks")[0]["text"] == F.concat("id", F.lit("x")))
    assert got.count() == 1000


def test_many_unclosed_tags_take_linear_time():
    """A megabyte of unclosed paragraphs, as the rules read it."""
    page = "<p>x" * 250_000 + "<p>" + "A long sentence that counts. " * 3
    rows, error = page_blocks(page, with_text=False, least_own=50)
    assert error is None and len(rows) == 250_001
    assert [r[5] is not None for r in rows].count(True) == 1
    assert rows[-1][5].startswith("/p[1]/p[1]/") and rows[-1][5].count("/") == 250_001

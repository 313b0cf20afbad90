import html
import re

from pyspark.sql import functions as F

from custlens.llm import html_wrapper as H
from tests.llm.cases import prose

RICH = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body class="page with-sidebar">
<header><h2>Site</h2><p>tagline</p></header><div id="cookie-notice"><p>We use cookies</p></div>
<nav><ul><li><a href="/">Home</a></ul></nav><div class="layout"><aside><p>related things</p></aside>
<article><header><h1>{title}</h1></header><p>{a}</p><script>var x = "<p>no</p>";</script>
<div class="advert">buy now</div><p>{b}<br>tail &amp; &eacute;nd</p><ul><li>one<li>two</ul>
<form><input><p>subscribe</p></form><section class="comments"><p>first!</p></section></article></div>
<footer>&copy; all</footer></body></html>"""
PLAIN = """<html><body><div class="top"><div class="menu">a b c</div></div><div id="wrap"><div class="txt">
<h2>{title}</h2><div class="para">{a}</div><div class="para">{b}</div></div></div><div>same words everywhere</div></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def texts(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


def test_article_without_furniture(spark):
    rows = [(i, f"https://rich.example/{i}", RICH.format(title=f"T{i}", a=prose(20, i), b=prose(9, i + 50))) for i in range(6)]
    rows += [(100 + i, f"http://plain.example/{i}", PLAIN.format(title=f"T{i}", a=prose(40, i), b=prose(30, i + 70)))
             for i in range(6)]
    got = texts(H.main_text(pages(spark, rows)))
    for i in range(6):
        assert got[i] == f"T{i}\n{prose(20, i)}\n{prose(9, i + 50)} tail & énd\none\ntwo"
        assert got[100 + i] == f"T{i}\n{prose(40, i)}\n{prose(30, i + 70)}"


def test_given_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in df.collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        want[r["page_id"]] = "\n".join(x for x in parts if x)
    got = H.main_text(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert texts(got) == want
    assert got.where("n_chars <> length(text)").count() == 0


def test_copies_are_not_boilerplate(spark):
    one = PLAIN.format(title="Same", a=prose(40, 500), b=prose(30, 501))
    own = PLAIN.replace('"txt"', '"letter"').replace('"para"', '"verse"').format(title="Own", a=prose(40, 502), b=prose(30, 503))
    rows = [(i, f"http://copies.example/{i}", one) for i in range(5)]
    # Copies that differ in what is no text of theirs.
    rows += [(10 + i, f"http://near.example/{i}", one.replace("<body>", f"<body><!-- {i} -->")) for i in range(5)]
    rows += [(20 + i, f"http://mixed.example/{i}", PLAIN.format(title=f"T{i}", a=prose(40, i), b=prose(30, i + 70)))
             for i in range(6)]
    rows += [(30 + i, f"http://mixed.example/own{i}", own) for i in range(4)]
    got = texts(H.main_text(pages(spark, rows).repartition(3)))
    body = lambda t, a, b: f"{t}\n{prose(40, a)}\n{prose(30, b)}"
    for i in range(5):
        assert body("Same", 500, 501) in got[i] and body("Same", 500, 501) in got[10 + i]
    for i in range(6):
        assert got[20 + i] == body(f"T{i}", i, i + 70)
    for i in range(4):
        assert body("Own", 502, 503) in got[30 + i]


def test_missing_end_tags_leave_the_article():
    text = lambda x: H.extract_page(x, None)
    article = "<article><p>one</p><p>two</p></article>"
    assert text(f"<datalist id=x><option>a<option value=b>b</datalist>{article}") == "one\ntwo"
    assert text(f"<datalist><option>a<option>b{article}") == "one\ntwo"
    for tag in ("select", "svg", "object", "noscript", "template", "iframe", "textarea", "title"):
        assert text(f"<{tag}>x{article}") == "one\ntwo", tag
    assert text(f"<select><option>a<option>b</select><title>t</title>{article}") == "one\ntwo"
    assert text("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p></article>") == "so x=2 holds"


def test_hard_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, None, None), (2, None, ""), (3, "nonsense", "no markup at all"), (4, "http://x.example", "<p>a<p>b"),
            (5, "http://x.example", "<a title='unclosed <b>x</b>"), (6, "http://d.example", f"<article>{deep}</article>"),
            (7, "http://e.example", "<article><!-- never closed"), (8, "http://e.example", "<article>x &lt;p&gt; &#x41;&nbsp;y"),
            (None, "http://e.example", "<article>z</article>"), (None, "http://e.example", "<article>z</article>"),
            (9, "http://e.example", "<script>only</script>"), (10, "http://l.example", "<main>" + "<p>w</p>" * 5000)]
    df = pages(spark, rows).withColumn("host", F.lit("clash")).withColumn("rule", F.lit("clash")).withColumn("text", F.lit(1))
    got = sorted(H.main_text(df).collect(), key=lambda r: (r["page_id"] is None, r["page_id"] or 0))
    assert len(got) == len(rows)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == by[2] == by[9] == by[7] == "" and by[4] == "a\nb" and by[6] == "deep"
    assert by[8] == "x <p> A y" and by[None] == "z" and by[10] == "\n".join(["w"] * 5000)
    assert by[3] == "no markup at all"
    assert H.main_text(pages(spark, [])).collect() == []


def test_alignment_resolves_optional_and_repeated_groups():
    one = H.expression(H.parse("<div><h1>a</h1><p>x</p><p>y</p><hr></div>"))
    two = H.expression(H.parse("<div><h1>b</h1><img><p>z</p></div>"))
    (div,) = H.merge(one, two)[1]
    assert [(x[0], x[2], x[3]) for x in div[1]] == [
        ("h1", False, False), ("img", True, False), ("p", False, True), ("hr", True, False)]
    pairs = H.expression(H.parse("<dl><dt>a<dd>b<dt>c<dd>d</dl>"))[1][0]
    assert pairs[1][0][0] == "(dt dd)" and pairs[1][0][3]


def test_class_words_alone_remove_nothing_from_the_article(spark):
    page = """<html><body><div class="share-price">outside</div><article><h1>{t}</h1>
<p class="share-price">price {a}</p><p>some <span class="search-term">{b}</span> words</p>
<section class="related-work"><h2>Related work {b}</h2><p>{c}</p></section>
<div class="related"><ul><li><a href="/x">{b} and more</a></li></ul></div><p>{d}</p>
<div class="ad-slot">offer {b}</div><p class="copyright">always the same</p>
<div class="notice"><p>{c} {c}</p><p>{c} {d}</p></div>
<section class="comments"><div class="comment"><p>{d} {d} {d}</p></div></section></article></body></html>"""

    def rows(host, n):
        return [(n * 100 + i, f"http://{host}/{i}", page.format(
            t=f"T{i}", a=prose(6, i), b=prose(2, i + 20), c=prose(15, i + 40), d=prose(15, i + 60))) for i in range(n)]

    got = texts(H.main_text(pages(spark, rows("one.example", 1) + rows("many.example", 5))))
    for n in (1, 5):
        for i in range(n):
            b, c, d = prose(2, i + 20), prose(15, i + 40), prose(15, i + 60)
            want = [f"T{i}", f"price {prose(6, i)}", f"some {b} words", f"Related work {b}", c, d]
            # With a single page, nothing tells that a paragraph is the same on all.
            want += ["always the same"] * (n == 1) + [f"{c} {c}", f"{c} {d}"]
            assert got[n * 100 + i] == "\n".join(want)


def test_side_lists_that_vary_are_not_main_text(spark):
    page = """<html><body><div class="left"><ul>{side}</ul></div><div class="txt"><h2>{t}</h2>
<div class="para">{a}</div><ul><li>{b}</li></ul><section class="related-work"><p>{c}</p></section></div></body></html>"""
    for item in ("<li>{}</li>", "<li><a href='/'>{}</a></li>"):
        rows = [(i, "http://side.example", page.format(
            side="".join(item.format(prose(8, 1000 + 20 * i + k)) for k in range(12)), t=f"T{i}", a=prose(60, i),
            b=prose(9, i + 30), c=prose(20, i + 60))) for i in range(5)]
        got = texts(H.main_text(pages(spark, rows)))
        for i in range(5):
            assert got[i] == f"T{i}\n{prose(60, i)}\n{prose(9, i + 30)}\n{prose(20, i + 60)}"

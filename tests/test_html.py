"""Malformed pages as trees, main text by density, linked data at depth, links resolved."""

from pyspark.sql import functions as F

from dossier.operators import html


def _pages(spark, texts, url="https://a.example/no/index.html"):
    return spark.createDataFrame([(i, url, t) for i, t in enumerate(texts)], "page_id long, url string, html string")


def test_tree_of_malformed_pages(spark):
    texts = ["<ul><li>one<li>two <b>bold</ul><p>x<p>y</div></p>z", "a < b &amp; c<br>d<table><tr><td>1<td>2<tr><td>3</table>", "<", None, "", "<script>if (a<b) '</p>'</script>t<!-- <p>no</p> -->", "<div><span>open"]
    rows = {}
    for r in html.tree(_pages(spark, texts)).orderBy("page_id", "node").collect():
        rows.setdefault(r["page_id"], []).append((r["path"], (r["text"] or "").strip()))
    said = lambda i: [x for x in rows[i] if x[1]]
    assert said(0) == [("/ul/li/", "one"), ("/ul/li/", "two"), ("/ul/li/b/", "bold"), ("/p/", "x"), ("/p/", "y"), ("/", "z")]
    assert said(1) == [("/", "a < b & c"), ("/", "d"), ("/table/tr/td/", "1"), ("/table/tr/td/", "2"), ("/table/tr/td/", "3")]
    assert said(5) == [("/script/", "if (a<b) '</p>'"), ("/", "t")] and said(6) == [("/div/span/", "open")]
    assert 3 not in rows and 4 not in rows


def test_fields_and_main_text(spark):
    body = "Useful services for customers. " * 5
    menu = "".join(f'<li><a href="/{i}">entry {i}</a>' for i in range(9))
    texts = [
        f'<title> A &amp;\n B </title><title>no</title><meta property="og:description" content=" shared "><meta name="description" content="later"><nav>{menu}</nav><div>{menu}</div><div>{body}<b>bold</b></div><footer>Firm AS, <i>0001</i> Oslo</footer>',
        f"<div>outside {body}</div><article><h1>Head</h1><p>{body}</article><svg><title>icon</title></svg>",
        '<script src="a.js"></script><script src="b.js"></script><div>short</div>',
        None,
    ]
    found = {r["page_id"]: r for r in html.fields(_pages(spark, texts)).collect()}
    assert (found[0]["title"], found[0]["description"], found[0]["footer"], found[0]["links"]) == ("A & B", "shared", "Firm AS, 0001 Oslo", 18)
    assert found[0]["main_text"] == (body + "bold") and found[1]["main_text"] == "Head " + body.strip() and found[1]["title"] == ""
    assert [found[i]["extraction_state"] for i in range(4)] == ["static_complete", "static_complete", "js_fallback_candidate", "static_complete"]
    assert found[3]["title"] == "" and found[3]["main_text"] == ""


def test_links_are_resolved(spark):
    base = "https://a.example/no/om/index.html?q=1"
    want = {
        "x.html": "https://a.example/no/om/x.html", "./x?y=../z": "https://a.example/no/om/x?y=../z", "../x": "https://a.example/no/x", "../../../x/": "https://a.example/x/", "/r/./s/..": "https://a.example/r/",
        "//b.example/p": "https://b.example/p", "?p=2": "https://a.example/no/om/index.html?p=2", "#top": base + "#top", "mailto:a@b.no": "mailto:a@b.no", "": base, " /trim ": "https://a.example/trim",
    }
    rows = spark.createDataFrame([(h,) for h in want], "h string")
    assert {r["h"]: r["u"] for r in rows.select("h", html.resolved(F.lit(base), F.col("h")).alias("u")).collect()} == want
    assert rows.limit(1).select(html.resolved(F.lit("https://a.example"), F.lit("x"))).first()[0] == "https://a.example/x"


def test_social_links_in_every_form(spark):
    data = '{"@type":"Organization","sameAs":["https://www.facebook.com/Named/","https://linkedin.com/in/person",{"u":"https://x.com/no"}],"x":{"sameAs":" https://tiktok.com/@inner "}}'
    texts = [
        '<div data-href="https://www.facebook.com/ExampleCompany"></div><iframe src="https://www.facebook.com/plugins/page.php?href=https%3A%2F%2Fwww.facebook.com%2FSecondCompany"></iframe><a href="/about">About</a>',
        f'<a href="https://www.linkedin.com/company/example/">in</a><script type="application/ld+json">{data}</script><script type="text/javascript">{{"sameAs":"https://x.com/script"}}</script>',
        "<a href='https://www.facebook.com/plugins/like.php'>like</a>",
    ]
    found = {}
    for r in html.social_links(_pages(spark, texts)).collect():
        found.setdefault(r["page_id"], set()).add(r["url"])
    assert found == {0: {"https://facebook.com/ExampleCompany", "https://facebook.com/SecondCompany"}, 1: {"https://linkedin.com/company/example", "https://facebook.com/Named", "https://tiktok.com/@inner"}}


def test_linked_data_at_any_depth(spark):
    deep = '{"a":' * 60 + '{"name":"bottom"}' + "}" * 60
    many = "[" + ",".join(f'{{"@type":["Thing","Store"],"name":"s{i:02d}"}}' for i in range(25)) + "]"
    script = lambda *texts: "".join(f'<script type="application/ld+json">{t}</script>' for t in texts)
    texts = [
        script('{"name":"A \\"B\\" AS","legalName":7,"alternateName":["listed"],"x":[[{"alternateName":" \\u00e9 "}]]}', "{broken"), script(deep), script(many), script('[3,{"aggregateRating":{"ratingValue":"4.5"}},{"aggregateRating":{"ratingValue":"4.4","ratingCount":0,"reviewCount":"25"}}]', '{"aggregateRating":{"ratingValue":1,"ratingCount":1}}'),
        script('{"x":{"aggregateRating":{"ratingValue":1,"ratingCount":1}}}', '{"aggregateRating":[]}'), script(""), "no data",
    ]
    values = html.linked_values(_pages(spark, texts))
    names = {r["page_id"]: r["names"] for r in html.structured_names(values).collect()}
    assert names[0] == ['A "B" AS', "é"] and names[1] == ["bottom"] and len(names[2]) == 25 and set(names) == {0, 1, 2}
    kept = html.organisations(values).collect()
    assert len(kept) == html.MOST_ORGANISATIONS and {r["page_id"] for r in kept} == {2} and sorted(r["nth"] for r in kept) == list(range(1, 21))
    assert [tuple(r) for r in html.ratings(values).collect()] == [(3, 4.4, 25)]

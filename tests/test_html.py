"""Markup by the quoting rules of HTML, held against the standard library."""

import html
import html.entities
import random
import time
from html.parser import HTMLParser

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.functions import html as H
from shelfline.sources import pages as P

NAMES = sorted(html.entities.html5)
FRAGMENTS = st.one_of(
    st.sampled_from(["&", "&amp;", "&amp", "&#", "&#x", ";", " ", "<", "x", "é", "\n", "&#0;", "&#13;", "&#x0B;", "&#55296;", "&#xDFFF", "&#x110000;", "&#99999999999999999999;",
                     "&#00000000000065;", "&#xFFFE;", "&#x1FFFF;", "&#64976;", "&notit;", "&copy=1", "&copy2", "&unknown;", "&Unknown", "&\U0001F600;"]),
    st.sampled_from(NAMES).map(lambda n: "&" + n), st.sampled_from(NAMES).map(lambda n: "&" + n[:-1]),
    st.integers(0, 0x120000).map(lambda n: f"&#{n};"), st.integers(0, 0x120000).map(lambda n: f"&#X{n:x}"), st.text(max_size=5))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.lists(FRAGMENTS, max_size=8).map("".join), min_size=200, max_size=400))
def test_unescape_is_that_of_the_standard_library(spark, texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts] + ["&" + n for n in NAMES]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.u for r in df.select("i", H.unescape("t").alias("u")).collect()}
    assert [got[i] for i in range(len(texts))] == [html.unescape(t) for t in texts]


def test_attribute_values_keep_query_strings(spark):
    texts = {"/a?x=1&copy=2": "/a?x=1&copy=2", "/a?x&amp;copy=2&#38;y": "/a?x&copy=2&y", "a &copy b": "a © b", "&copy1": "&copy1", "&eacute;&lt": "é<", "&notin;": "∉", "&notit;": "&notit;"}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.u for r in df.select("t", H.unescape_attribute("t").alias("u")).collect()} == texts
    none = spark.createDataFrame([(None,)], "t string").select(H.unescape("t").alias("u"), H.node_text("t").alias("n"), H.attribute("t", "x").alias("a"), H.markup("t").alias("m")).first()
    assert tuple(none) == (None, None, None, None)


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            first = {}
            for k, v in attrs:
                first.setdefault(k, v)
            self.found.append(next((first[k] for k in P.LINKS if first.get(k)), None))

    handle_startendtag = handle_starttag


def random_page(rng: random.Random) -> str:
    def value() -> str:
        inner = "".join(rng.choice(["x", "/", "'", '"', ">", "<a href=no>", "=", " ", "&amp;", "é", "?a=1"]) for _ in range(rng.randrange(5)))
        kind = rng.randrange(3)
        if kind == 0:
            return '"' + inner.replace('"', "") + '"'
        if kind == 1:
            return "'" + inner.replace("'", "") + "'"
        return "/b" + "".join(c for c in inner if c not in " >\"'<=" and c != "é")

    def attribute() -> str:
        name = rng.choice(["href", "HREF", "title", "data-href", "data-url", "class", "disabled", "xhref", "href2"])
        if name == "disabled":
            return " disabled"
        return rng.choice([" ", "\n", "  "]) + name + rng.choice(["=", " = "]) + value()

    def tag() -> str:
        name = rng.choice(["a", "A", "a", "abbr", "div", "area"])
        return f"<{name}" + "".join(attribute() for _ in range(rng.randrange(4))) + rng.choice([">", " >", " />"])

    parts = []
    for _ in range(rng.randrange(1, 9)):
        parts.append(rng.choice([tag, tag, tag, lambda: "text > ", lambda: f"<!-- {tag()} -- ->-->", lambda: f"<script type=x>var a = '{tag()}' < 1;</script >",
                                 lambda: f"<STYLE>{tag()}</style>", lambda: "</a>"])())
    return "".join(parts)


def test_anchors_are_those_of_a_parser(spark):
    rng = random.Random(11)
    texts = [random_page(rng) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, h string")
    got = {r.i: r.v for r in df.select("i", F.transform(H.tags("h", P.ANCHOR), lambda t: H.attribute(t, *P.LINKS)).alias("v")).collect()}
    for i, text in enumerate(texts):
        parser = Anchors()
        parser.feed(text)
        parser.close()
        assert got[i] == parser.found, text


def test_classes(spark):
    tags = {'<div class="a card b" id=x>': True, "<DIV CLASS=card>": True, "<div class='x card'>": True, '<div class="cards">': False, '<div title="card" class="b">': False,
            '<div id="1" class="card">': True, '<div class="a-card">': False, '<div data-class="card">': False, '<divx class="card">': False, "<div class=' card '>": True}
    df = spark.createDataFrame([(t,) for t in tags], "t string")
    assert {r.t: r.m for r in df.select("t", F.col("t").rlike(H.class_regex("div", "card")).alias("m")).collect()} == tags


def test_links_of_awkward_markup(spark):
    text = ("<a href=\"/p/women's-dress\">1</a><A HREF=/x>2</A><!-- <a href='/hidden'> --><script>'<a href=\"/js\">'</script>"
            "<a title=\"href='/no'\" href='/q?a=1&amp;b=\"2\"'>3</a><a href=\"\">4</a><a data-url='caf&eacute;'>5</a><!-- <a href=/open>")
    pages = spark.createDataFrame([(1, "https://s.example/c/", text), (2, None, None), (3, "https://s.example/", "")], "page_id long, url string, html string")
    want = [(0, "https://s.example/p/women's-dress"), (1, "https://s.example/x"), (2, 'https://s.example/q?a=1&b="2"'), (4, "https://s.example/c/café")]
    assert [(r.pos, r.link) for r in P.page_links(pages).orderBy("pos").collect()] == want
    assert [r.link for r in P.category_links(pages).orderBy("pos").collect()] == [x for _, x in want]
    scan = spark.createDataFrame([(1, "https://s.example/c/", "<a href=\"/women's-c0p1.html\"><a HREF='/\"c0p2'><a title=c0p3>")], pages.schema)
    assert [r.link for r in P.product_url_scan(scan).orderBy("pos").collect()] == ["https://s.example/women's-c0p1.html", 'https://s.example/"c0p2']
    got = P.html_endpoints(spark.createDataFrame([(1, "https://s.example/c/", "<a href='/category/7/\"x\"'><A HREF=/category/8/><!-- <a href=/category/9/> -->")], pages.schema),
                           "https://s.example/api/{category_id}", r"/category/(\d+)/")
    assert [r.endpoint for r in got.orderBy("pos").collect()] == ["https://s.example/api/7?ajax=true", "https://s.example/api/8?ajax=true"]


def test_fields_decode_and_skip_comments(spark):
    text = ("<!-- <title>no</title> --><TITLE>Caf&eacute; &#233; &euro;5&nbsp;</TITLE><style>h1{}</style><h1 title='a > b'> Big\n <b>&lt;Sale&gt;</b> </h1 >"
            "<img alt='x'><img src='//i.example/a&amp;b-s.jpg'>")
    pages = spark.createDataFrame([(1, "u", text)], "page_id long, url string, html string")
    got = P.page_fields(pages, {"title": P.element_regex("title"), "h1": P.element_regex("h1"), "image_url": ("img", "src"), "alt": ("img", "alt"), "none": ("img", "id")}).first()
    assert (got.title, got.h1, got.image_url, got.alt, got.none) == ("Café é €5", "Big<Sale>", "//i.example/a&b-s.jpg", "x", "")


def test_cards_of_awkward_markup(spark):
    text = ("<DIV CLASS='big card' title=\"a > b\" data-product-id=7><A HREF=/products/x-7?v=1>Caf&eacute;&nbsp;</A><IMG alt='<card>' SRC='//i.example/7&amp;a-e1.jpg'>"
            "<span class=\"old price\">9.50</span></DIV><!-- <div class=\"card\" data-product-id=\"0\"><img src=\"/0-s.jpg\"></div> -->"
            "<div class=\"cards\" data-product-id=\"1\"><img src=\"/1-s.jpg\"></div>")
    pages = spark.createDataFrame([(1, "https://s.example/list", text)], "page_id long, url string, html string")
    got = [tuple(r) for r in P.extract_cards(pages).select("card_id", "product_url", "image_url", "price", "title").collect()]
    assert got == [("7", "https://s.example/products/x-7?v=1", "https://i.example/7&a-e1.jpg", 9.5, "Café")]


def test_a_page_of_many_cards(spark):
    """Each card finds the first product with its id, by halving: no step per pair of card and product."""
    def page(n: int) -> str:
        products = ",".join(f'{{"id":"{i * 7919 % n}","name":"N{i}","price":"{i}"}}' for i in [*range(n), 3, 3])
        cards = "".join(f'<div class="card" data-product-id="{i}"><img src="//i.example/{i}-s.jpg"></div>' for i in range(n + 2))
        return f'<script type="application/json">{{"products":[{products}]}}</script>{cards}'

    def seconds(n: int) -> float:
        pages = spark.createDataFrame([(1, "https://s.example/list", page(n))], "page_id long, url string, html string").cache()
        pages.count()
        best = 1e9
        for _ in range(2):
            began = time.perf_counter()
            rows = P.match_cards_to_embedded(pages, title_prefix=None).collect()
            best = min(best, time.perf_counter() - began)
        names = {i * 7919 % n: f"N{i}" for i in range(n - 1, -1, -1)}
        assert [r.title for r in sorted(rows, key=lambda r: r.card_pos)] == [names.get(i) for i in range(n + 2)]
        return best

    small, large = seconds(500), seconds(5000)
    assert large < 10 * small + 3

"""Page jobs on inline HTML rows (the test pages have no ld+json, images or cards)."""

from shelfline.sources import pages as P
from shelfline.sources.sitemaps import expand_sitemaps

HTML = """<html><head><title>Shop &amp; Co</title>
<script type="application/ld+json">{"itemListElement":[{"item":{"url":"/p/c0p123.html"}},{"url":"https://x.example/q"}]}</script>
<script type="application/json">{"products":[{"id":"11","name":"Emb Coat","sizes":[{"price":"4999"}],"image":"//i/x-e1.jpg"},
{"productId":"12","title":"Emb Hat","price":"$12.50 now"}]}</script></head>
<body><h1>Big <b>Sale</b></h1><a href="/women/c0p555.html">x</a><a data-href="rel/page">y</a>
<div class="card" data-product-id="11"><a href="/products/coat-11?x=1"></a><img src="//img.example/11-e1.jpg"><span class="price">$49.99</span></div>
<div class="card" data-testid="plp-productCard-12-select"><a href="/products/hat-12">Hat</a><img src="/a/12.jpg"></div>
<div class="card"><a href="/products/scarf-13">Scarf</a><img src="assets/13-s.jpg"></div>
see https://www.shop.example/m/c0p777.html
</body></html>"""
URL = "https://www.shop.example/cz/en/list"


def pages(spark):
    return spark.createDataFrame([(1, URL, HTML)], "page_id long, url string, html string")


def test_fields_links_jsonld_scan(spark):
    f = P.page_fields(pages(spark), {"title": P.element_regex("title"), "h1": P.element_regex("h1"),
                                     "price": None}).first()
    assert (f.title, f.h1, f.price) == ("Shop & Co", "BigSale", "")
    links = [r.link for r in P.page_links(pages(spark)).orderBy("pos").collect()]
    assert links[:2] == ["https://www.shop.example/women/c0p555.html",
                         "https://www.shop.example/cz/en/rel/page"]
    j = [r.link for r in P.jsonld_urls(pages(spark)).orderBy("pos").collect()]
    assert j == ["https://www.shop.example/p/c0p123.html", "https://x.example/q"]
    scan = sorted(r.link for r in P.product_url_scan(pages(spark)).collect())
    assert scan == ["https://www.shop.example/m/c0p777.html", "https://www.shop.example/women/c0p555.html"]


def test_cards_and_embedded(spark):
    cards = {r.card_id: r for r in P.extract_cards(pages(spark)).collect()}
    assert set(cards) == {"11", "scarf-13"}  # the hat's image is not allowed
    assert cards["11"].price == 49.99 and cards["11"].title == "Product 11"
    assert cards["scarf-13"].image_url == "https://www.shop.example/assets/13-s.jpg"
    emb = {r.product_id: r for r in P.embedded_products(pages(spark)).collect()}
    assert float(emb["11"].price) == 49.99 and float(emb["12"].price) == 12.5


def test_sitemaps(spark):
    sm = spark.createDataFrame([
        ("r.xml", "<sitemapindex><sitemap><loc>i.xml</loc></sitemap><sitemap><loc>bad.xml</loc></sitemap></sitemapindex>"),
        ("i.xml", "<urlset><url><loc>https://a/1?x=1&amp;y=2</loc><image:loc>https://a/i.jpg</image:loc></url>"
                  "<url><loc>r.xml</loc></url><url><loc>l.xml</loc></url></urlset>"),
        ("l.xml", "<urlset><url><loc>https://a/2</loc></url><url><loc>d.xml</loc></url><url><loc>https://a/1?x=1&amp;y=2</loc></url></urlset>"),
        ("d.xml", "<sitemapindex><sitemap><loc>e.xml</loc></sitemap></sitemapindex>"),
        ("e.xml", "<urlset><url><loc><![CDATA[https://a/deep?x=1&y=<2>]]></loc></url><url><loc>\n https://a/last </loc></url></urlset>"),
        ("bad.xml", "<urlset><url><loc>https://a/broken"),
    ], "url string, xml string")
    got = {r.url: r.depth for r in expand_sitemaps(spark, sm, ["r.xml"]).collect()}
    assert got == {"https://a/1?x=1&y=2": 1, "https://a/i.jpg": 1, "https://a/2": 2, "https://a/deep?x=1&y=<2>": 4, "https://a/last": 4}
    assert {r.url for r in expand_sitemaps(spark, sm, ["r.xml"], max_nested=3).collect()} == {"https://a/1?x=1&y=2", "https://a/i.jpg", "https://a/2"}
    assert expand_sitemaps(spark, sm.limit(0), ["r.xml"]).count() == 0


def test_card_field_specs(spark):
    html = ('<li class="card" data-code="77" data-testid="plp-productCard-77-select">'
            '<img src="//img.example/77-e1.jpg"><h3>Coat</h3></li>')
    pages = spark.createDataFrame([(1, "https://s.example/list", html)], "page_id long, url string, html string")
    out = P.extract_cards(pages, container=r'(?is)<li class="card"[^>]*>', fields={
        "product_url": "'https://s.example/products/p-' + [data-code] + '.html' + [data-missing]",
        "brand": "'Shop'", "title": r"(?is)<h3>(.*?)</h3>"}).first()
    assert out.product_url == "https://s.example/products/p-77.html"
    assert (out.card_id, out.brand, out.title) == ("77", "Shop", "Coat")


def test_anchor_selection(spark):
    html = '<a class="nav" href="/home">h</a><a class="product-link x" href="/p/1">p</a>'
    pages = spark.createDataFrame([(1, "https://s.example/c", html)], "page_id long, url string, html string")
    sel = r'<a\s[^>]*class="[^"]*product-link[^"]*"[^>]*>'
    assert [r.link for r in P.page_links(pages, anchor=sel).collect()] == ["https://s.example/p/1"]
    assert [r.link for r in P.category_links(pages, anchor=sel).collect()] == ["https://s.example/p/1"]


def test_embedded_product_shapes(spark):
    prods = ('{"items":[{"productId":"5","title":"T","detail":{"longDescription":"L",'
             '"colors":[{"image":{"url":"/img/5-s.jpg"}}]},"price":{"currentPrice":0,"value":19.5}},'
             '{"sku":"6","nameEn":"N","price":"from $7.25","images":[{"src":"//cdn/6-e1.jpg"}]},'
             '{"id":"7","name":"M","price":12,"detail":{"xmedia":[{"x":1},{"xmediaItems":[{"medias":[{"url":"https://m/7-ult21.png"}]}]}]}}]}')
    html = '<script type="application/json">' + prods + '</script>'
    pages = spark.createDataFrame([(1, "https://s.example/cz/en/list", html)], "page_id long, url string, html string")
    got = {r.product_id: (r.title, r.description, r.price, r.image_url)
           for r in P.embedded_products(pages).collect()}
    assert got["5"] == ("T", "L", "19.5", "https://s.example/img/5-s.jpg")
    assert got["6"] == ("N", None, "7.25", "https://cdn/6-e1.jpg")
    assert got["7"] == ("M", None, "12.0", "https://m/7-ult21.png")


def test_nested_card_markup_and_price_spec(spark):
    html = ('<div class="card" data-product-id="1"><div><div>x</div><a href="/p/1"><b>Coat</b></a></div>'
            '<div><img src="//i/1-e1.jpg"></div><em class="now">12.50</em></div><p>between</p>'
            '<div class="card" data-product-id="2"><a href="/p/2">Hat</a><img src="//i/2-s.jpg"></div>')
    pages = spark.createDataFrame([(1, "https://s.example/list", html)], "page_id long, url string, html string")
    got = {r.card_id: (r.title, r.price, r.product_url) for r in P.extract_cards(pages, fields={"price": r'(?is)<em class="now">(.*?)</em>'}).collect()}
    assert got == {"1": ("Coat", 12.5, "https://s.example/p/1"), "2": ("Hat", None, "https://s.example/p/2")}


def test_card_image_only_in_the_embedded_json_stays(spark):
    html = ('<script type="application/json">{"pad":"' + "x" * 100 + '","products":[{"id":"9","name":"E","image":"https://i/9-e1.jpg","price":7},'
            '{"id":"9","name":"second","image":"https://i/other-e1.jpg"}]}</script><div class="card" data-product-id="9"><img src="/no.jpg"></div>'
            '<div class="card" data-product-id="8"><img src="/no.jpg"></div>')
    pages = spark.createDataFrame([(1, "https://s.example/list", html)], "page_id long, url string, html string")
    assert P.extract_cards(pages).count() == 0
    got = P.match_cards_to_embedded(pages).collect()
    assert [(r.card_id, r.title, r.image_url, r.price) for r in got] == [("9", "E", "https://i/9-e1.jpg", 7.0)]


def test_all_scripts_and_long_assignments_are_read(spark):
    pad = "x" * 100
    html = "".join(f'<script type="application/json">window.{pad}{i} = {{"products":[{{"id":"{i}"}}]}};</script>' for i in range(7))
    pages = spark.createDataFrame([(1, "https://s.example/list", html)], "page_id long, url string, html string")
    assert sorted(r.product_id for r in P.embedded_products(pages).collect()) == [str(i) for i in range(7)]
    assert P.embedded_products(pages, max_scripts=5).count() == 5


def test_jsonld_escapes_are_decoded(spark):
    html = '<script type="application/ld+json">{"url":"https:\\/\\/h\\/p?a=1\\u0026b=2","x":{"url":""},"y":{"url":7}}</script>'
    pages = spark.createDataFrame([(1, "https://s.example/list", html)], "page_id long, url string, html string")
    assert [r.link for r in P.jsonld_urls(pages).collect()] == ["https://h/p?a=1&b=2"]
    assert "https://h/p?a=1&b=2" in [r.link for r in P.category_links(pages).collect()]


def test_endpoint_template_without_an_id(spark):
    html = 'categoryId: 77 <a href="/c/5">x</a>'
    pages = spark.createDataFrame([(1, "https://s.example/category/9/products", html)], "page_id long, url string, html string")
    got = [r.endpoint for r in P.html_endpoints(pages, "https://s.example/api{path}", r"/category/(\d+)/").collect()]
    assert got == ["https://s.example/api/c/5?ajax=true"]

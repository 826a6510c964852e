"""Operator inputs derived from the given test tables (FIXTURES.md F1-F7).

Each derivation is a projection of a whole table, so its size grows with the
table; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline import constants as K

CATEGORY_IDS_ASC = sorted(K.CATEGORY_NAMES)
GENDER_CYCLE = ["WOMAN", "Man", " girls ", "KID", "unisex", "female", "Ornament", "", None]
SHOP = "https://shop.example"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cycle(k, values):
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (k % len(values) + 1).cast("int"))


def raw_products(part: DataFrame) -> DataFrame:
    """one raw product per part row, covering every normaliser branch."""
    k = F.col("p_partkey")
    cat_id = F.when(k % 25 == 23, F.lit("999")).otherwise(_cycle(k, CATEGORY_IDS_ASC))
    return part.select(
        k.alias("k"),
        (k % 24).alias("endpoint_pos"),
        F.floor(k / 24).cast("bigint").alias("item_pos"),
        F.concat(F.lit("src"), (k % 3).cast("string")).alias("source"),
        F.when(k % 50 == 0, F.lit(None).cast("string"))
         .when(k % 10 == 9, F.concat(F.lit("P"), (k - 3).cast("string")))
         .otherwise(F.concat(F.lit("P"), k.cast("string"))).alias("external_id"),
        F.when(k % 40 == 1, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("title"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
         .when(k % 5 == 1, F.lit("   "))
         .otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "), F.col("p_type"), F.lit(" ")))
         .alias("description"),
        F.col("p_brand").alias("brand"),
        _cycle(k, GENDER_CYCLE).alias("gender"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .when(k % 7 == 1, F.lit("20USD,450CZK"))
         .when(k % 7 == 2, F.concat(F.lit("$1,"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(".00")))
         .when(k % 7 == 3, F.concat(F.col("p_size").cast("string"), F.lit(",50 Kc")))
         .when(k % 7 == 4, F.lit("1,299"))
         .when(k % 7 == 5, F.lit("free"))
         .otherwise(F.lit("  39.99 ")).alias("price_text"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.lit("USD")).alias("currency"),
        F.when(k % 4 == 0, F.lit(None).cast("array<string>"))
         .otherwise(F.split(_cycle(k, ["", "S|M|S", " L ||XL", ""]), r"\|")).alias("size_list"),
        F.when(k % 25 == 24, F.lit(f"{SHOP}/new"))
         .otherwise(F.concat(F.lit(f"{SHOP}/category/"), cat_id, F.lit("/products?ajax=true")))
         .alias("endpoint"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(f"{SHOP}/p/"), k.cast("string"))).alias("product_url"),
        F.when(k % 6 == 0, F.lit(None).cast("string"))
         .otherwise(F.replace(F.col("p_name"), F.lit(" "), F.lit("-"))).alias("seo_keyword"),
        _cycle(k, [None, "data:image/png;base64,AA", "https://img.example/x-p.jpg",
                   "https://img.example/x-e1.jpg", "//img.example/x-s/w/{width}/y.jpg"])
        .alias("image_url"),
    )


# The site configuration used with F1: one site, literal values.
SITE = {
    "brand": "Shop",
    "merchant": "Shop",
    "source": K.DEFAULT_SITE_SOURCE,
    "country": "us",
    "product_url_template": SHOP + K.PRODUCT_URL_TEMPLATE_SUFFIX,
}


def sites_table(part: DataFrame) -> DataFrame:
    """Site configs, one per brand found in ``part`` (bounded by the brand domain)."""
    return (part.select("p_brand").distinct()
            .select(F.col("p_brand").alias("brand"),
                    F.lower(F.regexp_replace("p_brand", "#", "-")).alias("source"),
                    F.col("p_brand").alias("merchant"),
                    F.lit("us").alias("country")))


# ------------------------------------------------------------------ F2 feeds

FEED_PAGE_ITEMS = 50  # items per feed document (a paginated feed)

_COLOR_MEDIA = "flatten(filter(transform(detail.colors, c -> c.xmedia), x -> x IS NOT NULL))"

FEED_MAPPING = {
    "external_id": "seo.discernProductId",
    "product_id": "seo.discernProductId",
    "title": "name",
    "description": ["detail.description", "detail.longDescription", "seo.jsonLd.description",
                    "description"],
    "color_names": ["transform(detail.colors, c -> c.name)", "transform(detail.colors, c -> c.colorName)"],
    "gender": ["sectionName", "section", "familyName"],
    "price": "price",
    "sale": ["salePrice", "sale_price", "sale"],
    "size": "size",
    "sizes": "sizes",
    "available_sizes": "available_sizes",
    "currency": "'USD'",
    "country": "'w'",
    "image_url": [f"try_element_at({_COLOR_MEDIA}, 1).extraInfo.deliveryUrl", f"try_element_at({_COLOR_MEDIA}, 1).url",
                  "try_element_at(xmedia, 1).extraInfo.deliveryUrl", "try_element_at(xmedia, 1).url"],
    "_xmedia_urls": [f"transform({_COLOR_MEDIA}, m -> m.extraInfo.deliveryUrl)", f"transform({_COLOR_MEDIA}, m -> m.url)",
                     f"transform({_COLOR_MEDIA}, m -> m.path)",
                     "transform(xmedia, m -> m.extraInfo.deliveryUrl)", "transform(xmedia, m -> m.url)",
                     "transform(xmedia, m -> m.path)"],
    "seo_keyword": "seo.keyword",
    "seo_product_id": "id",
    "product_url": None,
    "brand": "'Shop'",
    "availability": "availability",
}


def _quoted(text):
    """A text as a JSON string, null as null."""
    inner = F.regexp_replace(F.to_json(F.struct(text.alias("x"))), r'^\{"x":|\}$', "")
    return F.when(text.isNotNull(), inner).otherwise(F.lit("null"))


def feed_item(r: DataFrame):
    """An F1 row rendered as a feed item (R2 shape), as JSON text.

    Prices, sales and sizes come in every JSON kind: text, integers (minor
    units from 1000 on), floats, objects and lists whose values are text or
    numbers, zeros, nested size lists; every third item carries a colour
    gallery.
    """
    k = F.col("k")
    ks = k.cast("string")
    base = F.to_json(F.struct(
        F.struct(F.col("external_id").alias("discernProductId"),
                 F.col("seo_keyword").alias("keyword")).alias("seo"),
        ks.alias("id"),
        F.col("title").alias("name"),
        F.col("description").alias("description"),
        F.col("gender").alias("sectionName"),
        F.when(F.col("image_url").isNotNull(),
               F.array(F.struct(F.col("image_url").alias("url")))).alias("xmedia"),
        F.when(k % 3 == 0, F.struct(F.array(
            F.struct(F.lit("ecru").alias("name"), F.array(F.struct(
                F.col("image_url").alias("url"), F.lit(None).cast("struct<deliveryUrl:string>").alias("extraInfo"))).alias("xmedia")),
            F.struct(F.lit("navy").alias("name"), F.array(F.struct(
                F.concat(F.lit("https://img.example/"), ks, F.lit("-s.jpg")).alias("url"),
                F.struct(F.concat(F.lit("https://img.example/"), ks, F.lit("-e1.jpg")).alias("deliveryUrl")).alias("extraInfo"),
            )).alias("xmedia"))).alias("colors"))).alias("detail"),
    ))
    price = (F.when(k % 8 == 1, F.concat(F.lit(',"price":'), (k % 30 * 100 + 90).cast("string")))
             .when(k % 8 == 3, F.concat(F.lit(',"price":'), (k % 40).cast("string"), F.lit(".90")))
             .when(k % 8 == 5, F.concat(F.lit(',"price":{"USD":"20.50","CZK":'), ks, F.lit(',"bd":1,"PLN":null,"EUR":"19.0"}')))
             .when(k % 8 == 7, F.concat(F.lit(',"price":[{"price":"0","amount":"5","currency":"usd"},{"price":0,"value":'), ks,
                                        F.lit('.25,"curr":"czk"},{"value":1}]')))
             .otherwise(F.concat(F.lit(',"price":'), _quoted(F.col("price_text")))))
    sale = (F.when(k % 5 == 1, F.lit(',"salePrice":1999')).when(k % 5 == 2, F.lit(',"sale_price":"9,99","sale":{"EUR":1}'))
            .when(k % 5 == 3, F.lit(',"sale":{"EUR":5,"usd":"4.50"}')).when(k % 5 == 4, F.lit(',"salePrice":0,"sale":"7"'))
            .otherwise(F.lit("")))
    size = (F.when(k % 7 == 1, F.lit(',"sizes":["S"," M ","S",4]')).when(k % 7 == 2, F.lit(',"sizes":[["S","M"],["L"," S "],"XL"]'))
            .when(k % 7 == 3, F.lit(',"size":"  One size "')).when(k % 7 == 4, F.lit(',"size":"","sizes":[],"available_sizes":["38","40"]'))
            .otherwise(F.lit("")))
    return F.concat(F.substring(base, 1, F.length(base) - 1), price, sale, size, F.lit("}"))


def feeds(raw: DataFrame) -> DataFrame:
    """feed documents (endpoint_pos, endpoint, page, payload).

    Items of one endpoint are paged FEED_PAGE_ITEMS at a time, so a document
    never holds more than that many items whatever the table size. Layout
    by ``endpoint_pos % 4``: groups/elements/components, groups/elements,
    products, products with null items between. Besides, every
    endpoint's last document is followed by one of malformed text.
    """
    page = F.floor(F.col("item_pos") / FEED_PAGE_ITEMS).cast("bigint")
    grouped = (raw.withColumn("page", page)
               .groupBy("endpoint_pos", "endpoint", "page")
               .agg(F.sort_array(F.collect_list(F.struct("item_pos", feed_item(raw).alias("it"))))
                    .alias("_l")))
    items = F.array_join(F.transform("_l", lambda x: x["it"]), ",")
    pos = F.col("endpoint_pos") % 4
    payload = (
        F.when(pos == 0, F.concat(F.lit('{"productGroups":[{"elements":[{"commercialComponents":['), items, F.lit("]}]}]}")))
        .when(pos == 1, F.concat(F.lit('{"productGroups":[{"elements":['), items, F.lit("]}]}")))
        .when(pos == 2, F.concat(F.lit('{"products":['), items, F.lit("]}")))
        .otherwise(F.concat(F.lit('{"products":[null,'), F.array_join(F.transform("_l", lambda x: x["it"]), ",null,"), F.lit("]}")))
    )
    docs = grouped.select("endpoint_pos", "endpoint", "page", payload.alias("payload"))
    broken = docs.groupBy("endpoint_pos", "endpoint").agg((F.max("page") + 1).alias("page"))
    return docs.unionByName(broken.withColumn("payload", F.lit("{bad")))


def failing_feeds(raw: DataFrame) -> DataFrame:
    """Feed documents of which every fourth endpoint's are malformed."""
    docs = feeds(raw)
    return docs.withColumn("payload", F.when(F.col("endpoint_pos") % 4 == 3, F.lit("{bad")).otherwise(F.col("payload")))


CATEGORY_TEMPLATE = SHOP + "/category/{id}/products?ajax=true"
CATEGORY_DOC_ITEMS = 50


def category_docs(part: DataFrame) -> DataFrame:
    """Category JSON documents from ``part``: URL strings, objects with an http
    url, objects with only an id; every fifth document nests its ids only, twice
    each, below a parent whose own id stands after them."""
    k = F.col("p_partkey")
    doc = F.floor(k / CATEGORY_DOC_ITEMS).cast("bigint")
    ks = k.cast("string")
    parent = (doc + 1_000_000).cast("string")
    frag = (F.when(doc % 5 == 4, F.concat(F.lit('{"name":"n","node":{"children":[{"id":'), ks, F.lit('},{"id":" '), ks,
                                          F.lit(' "}],"id":'), parent, F.lit("}}")))
            .when(k % 3 == 0, F.concat(F.lit(f'"{SHOP}/c/'), ks, F.lit('"')))
            .when(k % 3 == 1, F.concat(F.lit(f'{{"url":"{SHOP}/u/'), ks, F.lit('","id":"'), ks, F.lit('"}')))
            .otherwise(F.concat(F.lit('{"id":'), ks, F.lit(',"url":"ftp://x/'), ks, F.lit('"}'))))
    grouped = (part.select(doc.alias("doc"), k.alias("k"), frag.alias("frag"))
               .groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("k", "frag"))).alias("_l")))
    body = F.array_join(F.transform("_l", lambda x: x["frag"]), ",")
    return grouped.select("doc", F.concat(F.lit('{"items":['), body, F.lit("]}")).alias("payload"))


def page_rows(raw: DataFrame) -> DataFrame:
    """Products of category pages, keyed by the endpoint without its query string."""
    return raw.select(F.substring_index("endpoint", "?", 1).alias("page_key"),
                      F.col("k").cast("string").alias("item_id"), "external_id")


# --------------------------------------------------- F3 table maintenance

def maintenance_target(part: DataFrame) -> DataFrame:
    """Target table: part rows with k % 4 <> 0."""
    k = F.col("p_partkey")
    return part.filter(k % 4 != 0).select(
        F.concat(F.lit("P"), k.cast("string")).alias("id"),
        F.concat(F.lit("src"), (k % 3).cast("string")).alias("source"),
        F.col("p_name").alias("title"),
        F.concat(F.col("p_size").cast("string"), F.lit("USD")).alias("price"),
        F.array(F.col("p_size").cast("float"), F.col("p_retailprice").cast("float")).alias("image_embedding"),
    )


def maintenance_batch(part: DataFrame) -> DataFrame:
    """Batch: even k, changed price, no title, a new image_url column, some null
    vectors, and a legacy ``embedding`` column the upsert must not write. Every
    tenth id comes twice, the later time (``pos`` 1) at another price, and
    every twentieth a third time without an id."""
    k = F.col("p_partkey")
    vec = F.array((F.col("p_size") + 1).cast("float"), F.col("p_retailprice").cast("float"))
    times = F.when(k % 20 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).when(k % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = part.filter(k % 2 == 0).withColumn("pos", F.explode(times))
    return rows.select(
        F.when(F.col("pos") < 2, F.concat(F.lit("P"), k.cast("string"))).alias("id"),
        F.concat(F.lit("src"), (k % 3).cast("string")).alias("source"),
        F.concat((F.col("p_size") + 1 + 100 * F.col("pos")).cast("string"), F.lit("USD")).alias("price"),
        F.concat(F.lit("https://img.example/"), k.cast("string"), F.lit("-e1.jpg")).alias("image_url"),
        F.when(k % 6 != 0, vec).alias("image_embedding"),
        vec.alias("embedding"),
        "pos",
    )


# ------------------------------------------------------- F4 card pages

CARDS_PER_PAGE = 20


def _cents(c):
    return (F.col(c) * 100).cast("bigint")


def card_pages(part: DataFrame) -> DataFrame:
    """Category pages with product cards and an embedded JSON product list.

    One page per CARDS_PER_PAGE parts (bounded page size). Cards vary the id
    source (data attribute, test id, wishlist test id, link handle), the image
    (root-relative and disallowed, asset-relative, protocol-relative), the
    title (empty for every ninth) and the price (missing for every thirteenth),
    nest their markup, and vary quotes, case, classes and references; a
    commented-out card follows each. The embedded products stand in seven scripts, most
    of them assigned to a long name; every fourteenth has the image that its
    card lacks. ld+json URLs are escaped.
    """
    k = F.col("p_partkey")
    ks = k.cast("string")
    cents = _cents("p_retailprice")
    price = F.concat(F.lit("$"), (cents / 100).cast("bigint").cast("string"), F.lit("."),
                     F.lpad((cents % 100).cast("string"), 2, "0"))
    id_attrs = (F.when(k % 5 == 0, F.concat(F.lit(' data-testid="plp-productCard-'), ks, F.lit('-select"')))
                .when(k % 5 == 1, F.concat(F.lit(' data-testid="plp-productCard-Wishlist-'), ks, F.lit('"')))
                .when(k % 5 == 2, F.lit(""))
                .otherwise(F.concat(F.lit(' data-product-id="'), ks, F.lit('"'))))
    img = (F.when(k % 7 == 0, F.concat(F.lit("/assets/"), ks, F.lit(".jpg")))
           .when(k % 7 == 1, F.concat(F.lit("assets/"), ks, F.lit("-s.jpg")))
           .otherwise(F.concat(F.lit("//img.example/"), ks, F.lit("-e1.jpg"))))
    title = F.when(k % 9 == 0, F.lit("")).otherwise(F.col("p_name"))
    opening = F.when(k % 3 == 0, F.lit("<DIV title='a \"card\" > 1' CLASS='big card'")).otherwise(F.lit('<div class="card"'))
    title = F.when(k % 11 == 0, F.concat(title, F.lit(" Caf&eacute; &#8364;"))).otherwise(title)
    link = F.when(k % 4 == 0, F.concat(F.lit("<A HREF=/products/handle-"), ks, F.lit("?v=1>"))).otherwise(
        F.concat(F.lit('<a title="it\'s" href="/products/handle-'), ks, F.lit('?v=1">')))
    card = F.concat(opening, id_attrs, F.lit(">"), link, F.lit("<div><b>"), title, F.lit('</b></div></a><div class="media"><img alt="<card>" src="'), img, F.lit('"></div>'),
                    F.when(k % 13 == 0, F.lit("")).otherwise(F.concat(F.lit("<span class='old price'><i>from</i> "), price, F.lit("</span>"))),
                    F.lit('</div><!-- <div class="card" data-product-id="0"><img src="/0-s.jpg"></div> -->'))
    ld = F.concat(F.lit('{"position":'), ks, F.lit(',"item":{"url":"\\/products\\/handle-'), ks, F.lit('?a=1\\u0026b=2"}}'))
    emb = F.concat(F.lit('{"id":"'), ks, F.lit('","name":"Emb '), F.col("p_name"),
                   F.lit('","description":"'), F.col("p_type"), F.lit('","sizes":[{"price":"'),
                   cents.cast("string"), F.lit('"}]'),
                   F.when(k % 14 == 0, F.concat(F.lit(',"image":"https://img.example/'), ks, F.lit('-e1.jpg"'))).otherwise(F.lit("")), F.lit("}"))
    page = F.floor(k / CARDS_PER_PAGE).cast("bigint")
    g = (part.select(page.alias("page_id"), k.alias("k"), card.alias("card"), emb.alias("emb"), ld.alias("ld"))
         .groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("k", "card", "emb", "ld"))).alias("_l")))
    cards = F.array_join(F.transform("_l", lambda x: x["card"]), "")
    pad = "x" * 60

    def script(i: int):
        embs = F.array_join(F.transform(F.filter("_l", lambda x: x["k"] % 7 == i), lambda x: x["emb"]), ",")
        head = f'{{"pad":"{pad}{pad}","products":[' if i == 0 else f'window.{pad}State{i} = {{"pad":"{pad}","items":['
        return F.concat(F.lit(f'<script type="application/json">{head}'), embs, F.lit("]}" + ("" if i == 0 else ";") + "</script>"))

    scripts = F.concat(*[script(i) for i in range(7)])
    lds = F.array_join(F.transform("_l", lambda x: x["ld"]), ",")
    html = F.concat(F.lit('<html><head><script type="application/ld+json">{"@type":"ItemList","itemListElement":['),
                    lds, F.lit("]}</script></head><body>"), scripts, cards, F.lit("</body></html>"))
    return g.select("page_id", F.concat(F.lit(SHOP + "/cards/"), F.col("page_id").cast("string")).alias("url"),
                    html.alias("html"))


#: Markup by the quoting rules of HTML: any quotes, bare values, any case, comments and scripts, references. {k} is the page.
AWKWARD_HEAD = """<!-- <title>no title</title><h1>no heading</h1> -->"""
AWKWARD_TITLE = " Caf&eacute; &#233;&#xE9; &euro;5 &amp;eacute; &hellip;&nbsp;"
AWKWARD_BODY = """<IMG ALT='a > "b"' SRC="//img.example/{k}'s-e1.jpg?x=1&amp;y=2">
<A HREF=/bare/{k}?a=1&amp;b=2&copy=3>bare</A><a title="href='/no'" href="/p/Women's-{k}">apostrophe</a>
<a data-href='/single/"{k}"' >single</a><!-- <a href="/hidden/{k}">hidden</a> -->
<script>var s = "<a href='/js/{k}'>"; var categoryId = "77{k}";</script><a
class=x data-url = '/spaced/Caf&eacute;/{k}'/>spaced</a><a href="">empty</a><abbr href="/abbr">no anchor</abbr>
<a href='/en/9{k}?q="1"'>by path</a><a href=/list?page=5{k}&amp;x=1>by parameter</a><a href="https://other.example/category/8{k}/products">other</a>
<script type="application/ld+json">{"url":"\\/ld\\/{k}?a=1\\u0026b=2","item":{"url":"https://other.example/L/{k}"}}</script>"""


def awkward_pages(pages: DataFrame) -> DataFrame:
    """The pages with such markup added; every third has its heading's tag in upper case."""
    html = F.replace("html", F.lit("</title>"), F.lit(AWKWARD_TITLE + "</title>"))
    upper = F.replace(F.replace(html, F.lit("<h1>"), F.lit("<H1 CLASS=top>")), F.lit("</h1>"), F.lit("</H1 >"))
    html = F.when(F.col("page_id") % 3 == 0, upper).otherwise(html)
    body = F.replace(F.lit(AWKWARD_BODY), F.lit("{k}"), F.col("page_id").cast("string"))
    return pages.withColumn("html", F.concat(F.lit(AWKWARD_HEAD), html, body))


def product_pages(part: DataFrame) -> DataFrame:
    """One page per part at the URL its card links to, with title, price and image."""
    k = F.col("p_partkey")
    ks = k.cast("string")
    html = F.concat(F.lit("<html><head><title>"), F.col("p_name"), F.lit('</title></head><body><div class="price">'),
                    F.when(k % 10 == 0, F.lit("")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(",50"))),
                    F.lit('</div><img src="https://img.example/'), ks, F.lit('-e1.jpg"></body></html>'))
    return part.select(k.alias("page_id"), F.concat(F.lit(SHOP + "/products/handle-"), ks, F.lit("?v=1")).alias("url"), html.alias("html"))


# ------------------------------------------------------------ F5 sitemaps

SITEMAP_ROOT = "https://sitemaps.example/root.xml"
SITEMAP_LEAF_PAGES = 50
SITEMAP_INDEX_RANGES = 50


def _xml_escape(c):
    return F.replace(c, F.lit("&"), F.lit("&amp;"))


def sitemaps(pages: DataFrame) -> DataFrame:
    """root -> indexes -> leaves (per host, SITEMAP_LEAF_PAGES pages each).

    Every document holds a bounded number of entries except the root, which
    lists one index per SITEMAP_INDEX_RANGES x SITEMAP_LEAF_PAGES pages.
    Index 0 also lists the root (a cycle) and a malformed document; index 1
    lists its first leaf twice; every first leaf of a host lists a deeper
    sitemap, which lists another, which names a page (depth 4); every tenth
    page adds an image:loc, every seventh stands in CDATA.
    """
    host = F.regexp_extract("url", r"://([^/?#]+)", 1)
    leaf_no = F.floor(F.col("page_id") / SITEMAP_LEAF_PAGES).cast("bigint")
    p = pages.select("page_id", "url", host.alias("host"), leaf_no.alias("leaf_no"))
    text = F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("<![CDATA["), F.col("url"), F.lit("]]>"))).otherwise(_xml_escape(F.col("url")))
    entry = F.concat(F.lit("<url><loc>"), text, F.lit("</loc>"),
                     F.when(F.col("page_id") % 10 == 0,
                            F.concat(F.lit("<image:image><image:loc>https://"), F.col("host"),
                                     F.lit("/img/"), F.col("page_id").cast("string"),
                                     F.lit(".jpg</image:loc></image:image>"))).otherwise(F.lit("")),
                     F.lit("</url>"))
    leaf_url = F.concat(F.lit("https://"), F.col("host"), F.lit("/sitemap-"),
                        F.col("leaf_no").cast("string"), F.lit(".xml"))
    leaves = (p.withColumn("entry", entry)
              .groupBy("host", "leaf_no")
              .agg(F.sort_array(F.collect_list(F.struct("page_id", "entry"))).alias("_l")))
    first_leaf = F.col("leaf_no") == F.min("leaf_no").over(Window.partitionBy("host"))
    deep = F.when(first_leaf, F.concat(F.lit("<url><loc>https://"), F.col("host"),
                                       F.lit("/deep.xml</loc></url>"))).otherwise(F.lit(""))
    leaf_docs = leaves.select(
        "host", "leaf_no", leaf_url.alias("url"),
        F.concat(F.lit('<?xml version="1.0"?><urlset xmlns:image="http://img">'),
                 F.array_join(F.transform("_l", lambda x: x["entry"]), ""), deep,
                 F.lit("</urlset>")).alias("xml"))
    hosts = p.select("host").distinct()
    deep_docs = hosts.select(
        F.concat(F.lit("https://"), F.col("host"), F.lit("/deep.xml")).alias("url"),
        F.concat(F.lit("<sitemapindex><sitemap><loc>https://"), F.col("host"),
                 F.lit("/deeper.xml</loc></sitemap></sitemapindex>")).alias("xml")).unionByName(hosts.select(
        F.concat(F.lit("https://"), F.col("host"), F.lit("/deeper.xml")).alias("url"),
        F.concat(F.lit("<urlset><url><loc>\n https://"), F.col("host"),
                 F.lit("/reached </loc></url></urlset>")).alias("xml")))
    # Index docs: leaf ranges of SITEMAP_INDEX_RANGES leaf numbers, split by host
    # parity, so one index lists at most SITEMAP_INDEX_RANGES x SITEMAP_LEAF_PAGES leaves.
    ix = (F.floor(F.col("leaf_no") / SITEMAP_INDEX_RANGES) * 2 + F.length("host") % 2).cast("bigint")
    idx = (leaf_docs.select(ix.alias("ix"), "host", "leaf_no", "url")
           .groupBy("ix").agg(F.sort_array(F.collect_list(F.struct("host", "leaf_no", "url"))).alias("_l")))
    sm = lambda u: F.concat(F.lit("<sitemap><loc>"), u, F.lit("</loc></sitemap>"))
    extra = (F.when(F.col("ix") == 0, F.concat(sm(F.lit(SITEMAP_ROOT)),
                                               sm(F.lit("https://sitemaps.example/broken.xml"))))
             .when(F.col("ix") == 1, sm(F.col("_l")[0]["url"]))
             .otherwise(F.lit("")))
    index_url = F.concat(F.lit("https://sitemaps.example/index-"), F.col("ix").cast("string"), F.lit(".xml"))
    index_docs = idx.select(
        "ix", index_url.alias("url"),
        F.concat(F.lit("<sitemapindex>"), F.array_join(F.transform("_l", lambda x: sm(x["url"])), ""),
                 extra, F.lit("</sitemapindex>")).alias("xml"))
    root = (index_docs.agg(F.sort_array(F.collect_list(F.struct("ix", "url"))).alias("_l"))
            .select(F.lit(SITEMAP_ROOT).alias("url"),
                    F.concat(F.lit("<sitemapindex>"), F.array_join(F.transform("_l", lambda x: sm(x["url"])), ""),
                             F.lit("</sitemapindex>")).alias("xml")))
    spark = pages.sparkSession
    broken = spark.createDataFrame([
        ("https://sitemaps.example/broken.xml",
         "<urlset><url><loc>https://broken.example/a</loc></url><url><loc>https://broken.example/b"),
    ], "url string, xml string")
    return (root.unionByName(broken).unionByName(index_docs.select("url", "xml"))
            .unionByName(leaf_docs.select("url", "xml")).unionByName(deep_docs))


# ----------------------------------------------------------- F7 streaming

def events_with_gaps(events: DataFrame) -> DataFrame:
    """Events where a null ``value`` stands for a missing vector (event_id % 5 = 0)."""
    return events.select("user_id", "event_id", "ts", "event_type",
                         F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"))


#: Files of one arrival; a stream that takes as many per trigger sees one arrival per micro-batch.
ARRIVAL_FILES = 2


def write_arrivals(rows: DataFrame, folder: str, batches: int = 4, order: str = "event_id") -> None:
    """Append ``rows`` to ``folder`` in ``batches`` ranges of ``order``, one write
    of ``ARRIVAL_FILES`` files each, so a file stream sees them arrive in order."""
    top = rows.agg(F.max(order)).first()[0]  # one scalar
    if top is None:
        return
    chunk = F.floor(F.col(order) * batches / (top + 1))
    for b in range(batches):
        rows.filter(chunk == b).repartition(ARRIVAL_FILES).write.mode("append").parquet(folder)


def price_payloads(part: DataFrame) -> DataFrame:
    """JSON price values of every kind: integer (minor units when >= 1000),
    decimal, currency object, list of price objects, text."""
    k = F.col("p_partkey")
    size = F.col("p_size").cast("string")
    retail = F.col("p_retailprice").cast("string")
    minor = (F.col("p_size") * 100 + k % 100).cast("string")
    price = (F.when(k % 5 == 0, minor)
             .when(k % 5 == 1, retail)
             .when(k % 5 == 2, F.concat(F.lit('{"USD":'), size, F.lit(',"CZK":'), retail,
                                        F.lit(',"bd":1,"PLN":null,"EUR":"'), size, F.lit('.50","GBP":"7.0"}')))
             .when(k % 5 == 3, F.concat(F.lit('[{"price":'), size, F.lit(',"currency":"usd"},{"price":0,"amount":'),
                                        (k % 7).cast("string"), F.lit(',"curr":"czk"},{"value":"x"},{"price":"0","amount":"5","code":"eur"}]')))
             .otherwise(F.concat(F.lit('"'), size, F.lit(',5"'))))
    return part.select(k.alias("k"), F.concat(F.lit('{"price":'), price, F.lit("}")).alias("payload"),
                       F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.lit("USD")).alias("currency"))


def sale_payloads(part: DataFrame) -> DataFrame:
    """Sale fields of every kind; falsy ones (0, '', {}, []) must be skipped."""
    k = F.col("p_partkey")
    size = F.col("p_size").cast("string")
    sale = (F.when(k % 6 == 0, F.lit("0")).when(k % 6 == 1, F.lit('""'))
            .when(k % 6 == 2, F.concat(F.lit('{"EUR":'), size, F.lit("}")))
            .when(k % 6 == 3, F.lit("[]")).when(k % 6 == 4, (F.col("p_size") * 100).cast("string"))
            .otherwise(F.lit("null")))
    sale_price = F.when(k % 4 == 0, F.concat(F.lit('"'), size, F.lit(',99"'))).otherwise(F.lit("{}"))
    payload = F.concat(F.lit('{"sale":'), sale, F.lit(',"sale_price":'), sale_price,
                       F.lit(',"salePrice":[{"price":'), size, F.lit(',"currency":"czk"}]}'))
    return part.select(k.alias("k"), payload.alias("payload"),
                       F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.lit("USD")).alias("currency"))


def label_centroids(df: DataFrame, label: str = "label", vec_col: str = "embedding") -> DataFrame:
    """Mean vector per label as (query_id, query_vec)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    v = array_to_vector(F.col(vec_col).cast("array<double>"))
    means = df.filter(F.col(vec_col).isNotNull()).groupBy(label).agg(Summarizer.mean(v).alias("m"))
    return means.select(F.col(label).cast("bigint").alias("query_id"), vector_to_array("m").alias("query_vec"))

"""Page jobs over raw HTML (``pages(page_id, url, html)``).

HTML is scanned with the patterns of ``functions.html`` inside Spark rather
than parsed row by row in Python: tags by the quoting rules of HTML, without
what stands in comments and scripts, values with their character references
decoded. A page never leaves its task and every job is a projection or an
explode of whole pages. Link lists are ordered by ``(page_id, position)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import constants as K
from shelfline.functions import html as H
from shelfline.functions import normalize as N
from shelfline.functions import urls as U
from shelfline.functions.text import compiled_apart, first_truthy, once, strip, truthy
from shelfline.operators.dedup import ordered_distinct
from shelfline.operators.rows import settled

ANCHOR = H.tag_regex("a")
SCRIPT = r"(?is)<script([^>]*)>(.*?)</script>"


def element_regex(tag: str) -> str:
    """An element by its name, for ``page_fields``."""
    return H.element_regex(H.tag_regex(tag), tag)


def page_fields(pages: DataFrame, fields: dict, url: str = "url", html: str = "html",
                image_field: str = "image_url", keep=()) -> DataFrame:
    """One row per page with a text value per field (missing -> '').

    ``fields`` maps a name to a regex whose group 1 is the element content
    (see ``element_regex``), or to a pair (tag, attribute) for the value of
    the first such tag that has one. ``image_field`` without a pair is a
    regex whose group 1 is the value; an image that is not allowed is blanked.
    Comments, scripts and style sheets hold no fields.
    """
    marked = settled(pages.select("page_id", url, *keep, H.markup(html).alias("_markup")))
    cols = []
    for name, spec in fields.items():
        if not spec:
            cols.append(F.lit("").alias(name))
            continue
        if isinstance(spec, tuple):
            value = H.attribute(F.get(H.tags("_markup", H.with_attribute(*spec)), F.lit(0)), spec[1])
        else:
            value = F.regexp_extract("_markup", spec, 1)
            value = H.unescape_attribute(value) if name == image_field else H.node_text(value)
        if name == image_field:
            cols.append(once(value, lambda v: F.when(N.is_allowed_image_url(v), v).otherwise(F.lit(""))).alias(name))
        else:
            cols.append(F.coalesce(value, F.lit("")).alias(name))
    return marked.select("page_id", url, *keep, *cols)


LINKS = ("href", "data-href", "data-url")


def _scan_patterns(pattern: str) -> tuple[str, str]:
    """(link attributes whose quoted value holds the pattern, absolute URLs in raw text that hold it)."""
    quoted = "|".join(rf"{q}[^{q}]*(?:{pattern})[^{q}]*{q}" for q in "\"'")
    return rf"(?i:data-href|data-url|href)\s*=\s*(?:{quoted})", rf"""https?://[^\s"']*{pattern}[^\s"']*"""


def _unquoted(found: Column) -> Column:
    """The values of whole attributes."""
    return F.transform(found, lambda x: F.regexp_replace(x, r"""(?s)^[^=]*=\s*["'](.*)["']$""", "$1"))


def page_links(pages: DataFrame, url: str = "url", html: str = "html", anchor: str = ANCHOR) -> DataFrame:
    """Anchors' href (else data-href, else data-url), made absolute, http only.

    ``anchor`` is the regex of the opening tags to take, held against each tag
    (all ``<a>`` tags by default; ``functions.html.class_regex`` selects those of a class)."""
    tags = pages.select("page_id", url, F.posexplode(H.tags(html, anchor)).alias("pos", "tag"))
    hrefs = settled(tags.select("page_id", url, F.col("pos").cast("bigint").alias("pos"), H.attribute("tag", *LINKS).alias("_h")))
    out = hrefs.select("page_id", "pos", U.join_url("_h", F.col(url)).alias("link"), "_h", U.has_dot_segments("_h").alias("_dots"))
    out = out.filter(F.col("_h").isNotNull() & U.is_http("link")).drop("_h")
    return U.finish_dot_segments(out, "link", "_dots")


JSONLD_BLOCK = r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"
JSON_URL = r'"url"\s*:\s*("(?:[^"\\]|\\.)*")'


def jsonld_strings(html: Column) -> Column:
    """The string ``url`` values of a page's ld+json scripts, JSON escapes decoded."""
    found = F.flatten(F.transform(F.regexp_extract_all(html, F.lit(JSONLD_BLOCK), 1),
                                  lambda b: F.regexp_extract_all(b, F.lit(JSON_URL), 1)))
    return F.filter(F.from_json(F.concat(F.lit("["), F.array_join(found, ","), F.lit("]")), "array<string>"), lambda u: u != "")


def jsonld_urls(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Every string ``url`` inside ld+json scripts, resolved against the page."""
    found = jsonld_strings(F.col(html))
    out = pages.select("page_id", url, F.posexplode(found).alias("pos", "u"))
    out = out.select("page_id", F.col("pos").cast("bigint").alias("pos"),
                     U.join_url(F.col("u"), F.col(url)).alias("link"), U.has_dot_segments("u").alias("_dots"))
    return U.finish_dot_segments(out, "link", "_dots")


def _tagged(arr, **tags):
    """Wrap each element of ``arr`` as struct(tags..., pos, raw)."""
    return F.transform(arr, lambda x, i: F.struct(*[F.lit(v).alias(k) for k, v in tags.items()],
                                                  i.cast("bigint").alias("pos"), x.alias("raw")))


def product_url_scan(pages: DataFrame, pattern: str = r"c0p\d+", url: str = "url",
                     html: str = "html") -> DataFrame:
    """URLs matching ``pattern`` in href/data-* attributes (resolved) and as
    absolute URLs in raw text. ``branch`` 0 = attributes, 1 = text. One scan."""
    attr_rx, text_rx = _scan_patterns(pattern)
    h = F.col(html)
    cands = F.concat(_tagged(_unquoted(F.regexp_extract_all(h, F.lit(attr_rx), 0)), branch=0),
                     _tagged(F.regexp_extract_all(h, F.lit(text_rx), 0), branch=1))
    c = pages.select("page_id", url, F.explode(cands).alias("c")).select("page_id", url, "c.*")
    link = F.when(F.col("branch") == 1, F.col("raw")).otherwise(U.join_url(F.col("raw"), F.col(url)))
    dots = (F.col("branch") == 0) & U.has_dot_segments("raw")
    out = c.select("page_id", "branch", "pos", link.alias("link"), dots.alias("_dots"))
    return U.finish_dot_segments(out, "link", "_dots")


def category_links(pages: DataFrame, pattern: str = r"c0p\d+", url: str = "url",
                   html: str = "html", anchor: str = ANCHOR) -> DataFrame:
    """Anchors, then ld+json URLs, then the pattern scan; ordered distinct per page.

    One scan of ``html``: every raw candidate of a page is tagged (source,
    branch, position) into one array and exploded once; resolving runs after
    the explode as plain column expressions.
    """
    h = F.col(html)
    attr_rx, text_rx = _scan_patterns(pattern)
    jsonld = jsonld_strings(h)
    cands = F.concat(_tagged(H.tags(h, anchor), src=0, branch=0),
                     _tagged(jsonld, src=1, branch=0),
                     _tagged(_unquoted(F.regexp_extract_all(h, F.lit(attr_rx), 0)), src=2, branch=0),
                     _tagged(F.regexp_extract_all(h, F.lit(text_rx), 0), src=2, branch=1))
    c = pages.select("page_id", url, F.explode(cands).alias("c")).select("page_id", url, "c.*")
    staged = settled(c.select("page_id", url, "src", "branch", "pos", "raw",
                              F.when(F.col("src") == 0, H.attribute("raw", *LINKS)).otherwise(F.col("raw")).alias("_t")))
    is_text = (F.col("src") == 2) & (F.col("branch") == 1)
    link = F.when(is_text, F.col("raw")).otherwise(U.join_url(F.col("_t"), F.col(url)))
    out = staged.select("page_id", "src", "branch", "pos", "_t", link.alias("link"),
                        (~is_text & U.has_dot_segments("_t")).alias("_dots"))
    out = out.filter((F.col("src") != 0) | (F.col("_t").isNotNull() & U.is_http("link"))).drop("_t")
    out = U.finish_dot_segments(out, "link", "_dots")
    return ordered_distinct(out, "link", ["src", "branch", "pos"], group=["page_id"])


def html_endpoints(pages: DataFrame, template: str, id_regex: str | None = None,
                   query_param: str | None = None, link_filter: str | None = None,
                   url: str = "url", html: str = "html") -> DataFrame:
    """Product endpoints discovered from category pages.

    Three sources per page, in this order: category ids found in the HTML by
    the fixed patterns; the id of the page URL itself (query parameter first,
    then regex; no ajax flag added); the ids of its anchors. Every endpoint
    but the page-URL one gets ``ajax=true``; only http results are kept.
    One scan of ``html``: all candidates are tagged into one array per page
    and exploded once. Returns (endpoint, page_id, src, pos), each endpoint
    with its first position.
    """
    def fill(cid: Column, path: Column) -> Column:
        filled = F.replace(F.lit(template), F.lit("{category_id}"), cid)
        return F.replace(filled, F.lit("{path}"), F.coalesce(path, F.lit("")))

    def id_of(u: Column) -> Column:
        cid = U.query_param(u, query_param) if query_param else F.lit(None).cast("string")
        if id_regex:
            cid = F.coalesce(cid, F.nullif(F.regexp_extract(u, id_regex, 1), F.lit("")))
        return cid

    h = F.col(html)
    # Position among all pattern matches of the page, pattern by pattern.
    pattern_ids = _tagged(F.concat(*[F.regexp_extract_all(h, F.lit(rx), 1) for rx in K.HTML_CATEGORY_ID_PATTERNS]), src=0)
    own = F.array(F.struct(F.lit(1).alias("src"), F.lit(0).cast("bigint").alias("pos"),
                           id_of(F.col(url)).alias("raw")))
    anchors = _tagged(H.tags(h, ANCHOR), src=2)
    c = (pages.select("page_id", url, F.explode(F.concat(pattern_ids, own, anchors)).alias("c"))
         .select("page_id", url, "c.*"))
    staged = settled(c.withColumn("_href", F.when(F.col("src") == 2, H.attribute("raw", "href"))))
    staged = staged.withColumn("cid", F.when(F.col("src") == 2, id_of(F.col("_href"))).otherwise(F.col("raw")))
    keep = (F.col("src") != 2) | truthy("_href")
    if link_filter:
        keep = keep & ((F.col("src") != 2) | F.col("_href").contains(link_filter))
    if "{category_id}" in template:
        keep = keep & F.col("cid").isNotNull()
    else:  # without the placeholder only anchors give endpoints
        keep = keep & (F.col("src") == 2)
    # {path} is the anchor's href, or the page URL for ids found on the page.
    path = F.when(F.col("src") == 2, F.col("_href")).otherwise(F.col(url))
    endpoint = (F.when(F.col("src") == 1, fill(F.col("cid"), path))
                .otherwise(U.append_query_flag(fill(F.coalesce(F.col("cid"), F.lit("")), path))))
    out = staged.filter(keep).select("page_id", "src", "pos", endpoint.alias("endpoint"))
    out = out.filter(U.is_http("endpoint"))
    return ordered_distinct(out, "endpoint", ["page_id", "src", "pos"])


def url_contains_any(df: DataFrame, needles, column: str = "url") -> DataFrame:
    """Keep rows whose URL contains any non-empty substring (no needles: keep all)."""
    needles = [n for n in (needles or []) if n]
    if not needles:
        return df
    cond = F.lit(False)
    for n in needles:
        cond = cond | F.coalesce(F.col(column).contains(n), F.lit(False))
    return df.filter(cond)


# ------------------------------------------------------- cards and JSON

#: The opening tag of a product container; a card reaches to the next one.
CARD = H.class_regex("div", "card")


def card_fragments(html: Column, container: str = CARD) -> Column:
    """The page's markup cut at every container start, whatever is nested inside."""
    mark = "\u0001"
    return F.filter(F.split(F.regexp_replace(H.markup(html), f"({container})", mark + "$1"), mark), lambda x, i: i > 0)


def _open_tag(frag: Column) -> Column:
    return F.regexp_extract(frag, "^" + H.tag_regex(), 0)


def _card_url(frag: Column, page_url: Column, fields: dict) -> Column:
    # Card links are joined to the page URL without collapsing dot segments.
    if "product_url" in fields:
        return _spec_column(fields["product_url"], frag, _open_tag(frag))
    return once(H.attribute(frag, "href", ":href", anywhere=True), lambda href: F.when(href.isNotNull(), U.join_url(href, page_url)))


def _card_id(frag: Column, product_url: Column) -> Column:
    def of(tag: Column) -> Column:
        by_test = once(H.attribute(tag, "data-testid"), lambda t: F.when(t.isNotNull(), U.card_product_id(t)))
        return F.coalesce(H.attribute(tag, "data-product-id"), by_test, once(product_url, U.product_handle))

    return once(_open_tag(frag), of)


def _spec_column(spec: str, frag: Column, open_tag: Column) -> Column:
    """A card field spec: ``'literal'``, ``'a' + [data-x] + 'b'`` (literal parts
    and attributes of the container tag; a missing attribute is ''), or a
    regex whose group 1 is the field's inner HTML."""
    s = spec.strip()
    if " + " in s and "[data-" in s:
        parts = []
        for part in s.split(" + "):
            part = part.strip()
            if part.startswith("'") and part.endswith("'"):
                parts.append(F.lit(part[1:-1]))
            elif part.startswith("[") and part.endswith("]"):
                parts.append(F.coalesce(H.attribute(open_tag, part[1:-1]), F.lit("")))
        return F.concat(*parts)
    if s.startswith("'") and s.endswith("'"):
        return F.lit(s[1:-1])
    return F.nullif(H.node_text(F.regexp_extract(frag, s, 1)), F.lit(""))


PRICE_SPEC = H.element_regex(H.class_regex("span", "price"), "span")
TITLE_SPEC = H.element_regex(H.tag_regex("a"), "a")


def extract_cards(pages: DataFrame, container: str = CARD, url: str = "url",
                  html: str = "html", title_prefix: str = "Product ",
                  fields: dict | None = None) -> DataFrame:
    """Product containers on category pages -> card rows.

    ``container`` matches the opening tag of a card, which reaches to the next
    one. id: ``data-product-id``, else a ``productCard-<n>`` testid, else the
    product handle of the link; url from the href; image made absolute and
    kept only if allowed; price = first number of the price element. Cards
    without id or allowed image are dropped; a missing title gets a default.
    ``fields`` adds or overrides text fields by spec (see ``_spec_column``);
    a ``product_url`` spec replaces the href, and its ``/products/`` handle
    then fills a missing id; a ``price`` spec names another price element.
    """
    cards = pages.select("page_id", url, F.posexplode(card_fragments(F.col(html), container)).alias("card_pos", "frag"))
    return _finished(_card_rows(cards, url, dict(fields or {})), title_prefix)


def _card_rows(cards: DataFrame, url: str, fields: dict, keep=()) -> DataFrame:
    """Fragments (page_id, url, card_pos, frag) -> card fields, '' for an image that is not allowed."""
    frag = F.col("frag")
    staged = settled(cards.select(
        "page_id", url, F.col("card_pos").cast("bigint").alias("card_pos"), *keep, "frag",
        compiled_apart(_card_url(frag, F.col(url), fields)).alias("product_url"),
        F.regexp_extract(frag, H.tag_regex("img"), 0).alias("_img"),
        N.parse_price_number(_spec_column(fields.get("price", PRICE_SPEC), frag, _open_tag(frag))).alias("price"),
        _spec_column(fields.get("title", TITLE_SPEC), frag, _open_tag(frag)).alias("title"),
        *[_spec_column(spec, frag, _open_tag(frag)).alias(n) for n, spec in fields.items() if n not in ("product_url", "title", "price")]))
    image = once(H.attribute("_img", "src", "data-src"), lambda src: U.absolute_image_src(src, F.col(url)))
    out = staged.withColumn("card_id", compiled_apart(_card_id(F.col("frag"), F.col("product_url")))).withColumn("_full", image)
    out = out.withColumn("image_url", F.when(N.is_allowed_image_url("_full"), F.col("_full")).otherwise(F.lit("")))
    return out.select("page_id", "card_pos", *keep, "card_id", "product_url", "image_url", "price", "title",
                      *[n for n in fields if n not in ("product_url", "title", "price")])


def _finished(cards: DataFrame, title_prefix: str | None) -> DataFrame:
    """Cards with an id and an allowed image; a missing title gets a default."""
    out = settled(cards).filter(truthy("card_id") & truthy("image_url"))
    if title_prefix is None:
        return out
    return out.withColumn("title", F.coalesce(F.nullif(F.col("title"), F.lit("")), F.concat(F.lit(title_prefix), F.col("card_id"))))


def _firsts(products: Column) -> Column:
    """(id, place) of the first product of each id, sorted by id."""
    placed = F.transform(products, lambda e, i: F.struct(e["product_id"].alias("id"), i.alias("at")))
    ordered = F.array_sort(F.filter(placed, lambda x: x["id"].isNotNull()))
    return F.transform(F.array(ordered), lambda s: F.filter(s, lambda x, i: (i == 0) | (x["id"] != F.get(s, i - 1)["id"])))[0]


def _found(firsts: Column, key: Column) -> Column:
    """Place of the product with an id, by halving the sorted ids; null if there is none."""
    def halved(r: Column, _) -> Column:
        middle = F.shiftright(r["low"] + r["high"], 1)
        after = (r["low"] < r["high"]) & (F.get(firsts, middle)["id"] < key)
        return F.struct(F.when(after, middle + 1).otherwise(r["low"]).alias("low"), F.when(after, r["high"]).otherwise(F.least(middle, r["high"])).alias("high"))

    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(firsts) + 2)).cast("int") + 1)
    first = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(firsts).alias("high")), halved, lambda r: F.get(firsts, r["low"]))
    return F.transform(F.array(first), lambda x: F.when(x["id"] == key, x["at"]))[0]


def match_cards_to_embedded(pages: DataFrame, container: str = CARD, url: str = "url", html: str = "html",
                            title_prefix: str | None = "Product ", fields: dict | None = None,
                            max_scripts: int | None = None) -> DataFrame:
    """Cards whose missing fields come from the page's embedded JSON.

    Cards and embedded products stand in the same row, so every card looks up
    the first embedded product with its id inside that row: one scan, no join
    and no shuffle. The products are sorted by id once per page and searched
    by halving, so a page of n cards and products costs n log n. The image
    rule applies after the match, so a card whose image is only in the JSON
    stays.
    """
    fields = dict(fields or {})
    page = pages.select("page_id", F.col(url).alias("url"), card_fragments(F.col(html), container).alias("_cards"),
                        embedded_array(F.col(html), F.col(url), max_scripts).alias("_embedded"))

    def matched(firsts: Column, frag: Column) -> Column:
        cid = F.array(_card_id(frag, _card_url(frag, F.col("url"), fields)))  # worked out once per card
        at = F.transform(cid, lambda c: _found(firsts, c))[0]
        return F.struct(frag.alias("frag"), F.get("_embedded", at).alias("m"))

    cards = F.transform(F.array(_firsts(F.col("_embedded"))), lambda firsts: F.transform("_cards", lambda frag: matched(firsts, frag)))[0]
    cards = page.select("page_id", "url", F.posexplode(cards).alias("card_pos", "c"))
    rows = _card_rows(cards.select("page_id", "url", "card_pos", "c.frag", F.col("c.m").alias("_m")), "url", fields, keep=["_m"])
    filled = {f: F.when(truthy(F.col(f)), F.col(f)).otherwise(F.col(f"_m.{f}")) for f in ("title", "image_url")}
    filled["price"] = F.coalesce(F.col("price"), F.col("_m.price").cast("double"))
    if "description" in rows.columns:
        filled["description"] = F.when(truthy("description"), F.col("description")).otherwise(F.col("_m.description"))
    else:
        filled["description"] = F.col("_m.description")
    return _finished(rows.withColumns(filled).drop("_m"), title_prefix)


EMBEDDED_PRODUCT = (
    "array<struct<id:string,productId:string,product_id:string,sku:string,name:string,title:string,"
    "productName:string,nameEn:string,description:string,shortDescription:string,"
    "longDescription:string,price:string,sizes:array<struct<price:string>>,"
    "detail:struct<description:string,longDescription:string,shortDescription:string,"
    "colors:array<struct<image:struct<url:string>>>,"
    "xmedia:array<struct<xmediaItems:array<struct<medias:array<struct<url:string>>>>>>>,"
    "image:string,imageUrl:string,img:string,mainImage:string,primaryImage:string,picture:string,"
    "photo:string,images:array<string>,media:array<string>>>")
IMAGE_OBJECT = "struct<url:string,src:string,large:string,medium:string>"
PRICE_OBJECT = "struct<salePrice:string,currentPrice:string,price:string,value:string>"


def embedded_image_src(src, page_url) -> Column:
    """An embedded product's image made absolute ('' when unsupported): http
    kept, ``//`` gets https, ``/x`` is appended to the page URL before
    ``/cz/en/`` (else to the page URL without its last segment)."""
    s, p = F.coalesce(src, F.lit("")), page_url
    base = (F.when(p.contains("/cz/en/"), F.substring_index(p, "/cz/en/", 1))
            .otherwise(F.regexp_extract(p, r"^(.*)/", 1)))
    return (F.when(s.startswith("http"), s)
            .when(s.startswith("//"), F.concat(F.lit("https:"), s))
            .when(s.startswith("/"), F.concat(base, s))
            .otherwise(F.lit("")))


def embedded_products(pages: DataFrame, html: str = "html", max_scripts: int | None = None,
                      url: str = "url") -> DataFrame:
    """One row per product of ``embedded_array``: page_id, spos (script), ppos (place in it), fields."""
    return (pages.select("page_id", F.explode(embedded_array(F.col(html), F.col(url), max_scripts)).alias("e"))
            .select("page_id", "e.*"))


def embedded_array(html: Column, page: Column, max_scripts: int | None = None) -> Column:
    """Products inside JSON scripts of a page, in order.

    Scripts typed ``application/json`` (or, on pages without any, scripts
    mentioning product/item) whose text is longer than 100 characters are
    considered (the first ``max_scripts`` of them, if given), from their first
    ``{`` on; a trailing ``;`` is cut. Products are read from the first
    non-empty list among the fixed keys. Per product: the first truthy name;
    the detail descriptions, else the top-level ones; the price from
    ``sizes[0]`` (minor units), else a price object's
    sale/current/price/value, else a number, else the first number in the
    text; the image from colour images, the first media of the first media
    set, then the plain image fields and the first of ``images``/``media``
    (objects give url/src/large/medium), made absolute and kept only if
    allowed.
    """
    # All scripts of a page live in one row: no shuffle, no window. Each is
    # taken apart once, into its attributes and its text.
    def parts(tag):
        text = strip(F.regexp_extract(tag, r"(?is)^<script[^>]*>(.*)</script>$", 1))
        return F.struct(F.lower(F.regexp_extract(tag, r"(?is)^<script([^>]*)>", 1)).contains("application/json").alias("json"), text.alias("text"))

    def mentions(text):
        low = F.lower(text)
        return low.contains("product") | low.contains("item")

    # One parse per script: every candidate list is a field of one struct.
    doc_schema = "struct<" + ",".join(f"{k}:{EMBEDDED_PRODUCT}" for k in K.EMBEDDED_JSON_KEYS) + ">"

    def products(script, spos):
        text = F.regexp_replace(F.regexp_extract(script["text"], r"(?s)\{.*", 0), r";\s*$", "")
        lists = F.transform(F.array(F.from_json(text, doc_schema)), lambda doc: F.coalesce(
            *[F.when(F.size(doc[k]) > 0, doc[k]) for k in K.EMBEDDED_JSON_KEYS]))[0]
        return F.transform(lists, lambda p, ppos: embedded_product(p, page, spos, ppos))

    def of_page(scripts):
        # JSON-typed scripts win if the page has any; the length rule applies after.
        has_json = F.exists(scripts, lambda s: s["json"])
        chosen = F.filter(scripts, lambda s: F.when(has_json, s["json"]).otherwise(mentions(s["text"])) & (F.length(s["text"]) > 100))
        if max_scripts is not None:
            chosen = F.slice(chosen, 1, max_scripts)
        return F.flatten(F.filter(F.transform(chosen, products), lambda x: x.isNotNull()))

    scripts = F.transform(F.regexp_extract_all(html, F.lit(SCRIPT), 0), parts)
    return F.transform(F.array(scripts), of_page)[0]


def embedded_product(p: Column, page: Column, spos: Column, ppos: Column) -> Column:
    """The fields of one embedded product (see ``embedded_array``)."""
    d = p["detail"]
    pid = first_truthy(p["id"], p["productId"], p["product_id"], p["sku"])
    # Price: sizes[0] in minor units, else an object's first truthy number,
    # else a number, else the first number in the text; zero counts as none.
    raw_price = p["price"]
    obj = F.from_json(raw_price, PRICE_OBJECT)
    from_obj = F.coalesce(*[F.when(obj[k].try_cast("double") != 0, obj[k].try_cast("double"))
                            for k in ("salePrice", "currentPrice", "price", "value")])
    price = F.coalesce(N.minor_units_price(F.try_element_at(p["sizes"], F.lit(1))["price"]),
                       F.when(raw_price.startswith("{"), from_obj),
                       F.when(~raw_price.startswith("{"),
                              F.coalesce(raw_price.try_cast("double"), N.parse_price_number(raw_price))))
    # Image: candidates in order, objects read as url/src/large/medium.
    color_urls = F.transform(F.filter(d["colors"], lambda c: truthy(c["image"]["url"])),
                             lambda c: c["image"]["url"])
    first_set = F.try_element_at(F.filter(d["xmedia"], lambda m: F.size(m["xmediaItems"]) > 0), F.lit(1))
    media_url = F.try_element_at(F.try_element_at(first_set["xmediaItems"], F.lit(1))["medias"],
                                 F.lit(1))["url"]
    plain = [p[c] for c in ("image", "imageUrl", "img", "mainImage", "primaryImage", "picture", "photo")]
    plain += [F.try_element_at(p["images"], F.lit(1)), F.try_element_at(p["media"], F.lit(1))]
    cands = F.concat(F.coalesce(color_urls, F.array().cast("array<string>")), F.array(media_url, *plain))

    def as_url(c):
        o = F.from_json(c, IMAGE_OBJECT)
        return F.when(c.startswith("{"), first_truthy(o["url"], o["src"], o["large"], o["medium"])) \
            .otherwise(c)

    resolved = F.transform(F.filter(cands, lambda c: truthy(c)),
                           lambda c: embedded_image_src(as_url(c), page))
    image = F.try_element_at(F.filter(resolved, lambda u: N.is_allowed_image_url(u)), F.lit(1))
    return F.struct(
        spos.cast("bigint").alias("spos"), ppos.cast("bigint").alias("ppos"), pid.alias("product_id"),
        first_truthy(p["name"], p["title"], p["productName"], p["nameEn"]).alias("title"),
        F.coalesce(first_truthy(d["longDescription"], d["description"], d["shortDescription"]),
                   first_truthy(p["description"], p["shortDescription"], p["longDescription"])).alias("description"),
        F.when(price != 0, price).cast("string").alias("price"),
        image.alias("image_url"))

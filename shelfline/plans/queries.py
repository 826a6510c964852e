"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads whole given tables (or data Spark derives from them).
Arrays and maps are rendered as text at the end so results compare across
engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import html as H
from shelfline.functions import normalize as N
from shelfline.operators import dedup as D
from shelfline.operators import reads as R
from shelfline.operators import rows as RW
from shelfline.plans import fixtures as FX
from shelfline.sources.pages import element_regex

REGISTRY: dict = {}


def query(name):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def flat_products(df: DataFrame) -> DataFrame:
    return df.select("id", "source", "title", "description", "brand", "image_url",
                     "product_url", "second_hand", "price", "sale", "gender", "category",
                     "size", N.metadata_text("metadata").alias("metadata_text"))


def raw(spark, sf):
    return FX.raw_products(FX.table(spark, sf, "part"))


def site_rows(spark, sf):
    return RW.apply_site_defaults(raw(spark, sf), site=FX.SITE)


def product_rows(spark, sf):
    return RW.to_product_row(site_rows(spark, sf), keep=["endpoint_pos", "item_pos"])


def catalog(spark, sf, columns=None):
    """The E1 tail: products -> price gate -> first row per id.

    ``columns`` prunes before the de-dup so only needed columns are shuffled.
    """
    gated = RW.price_gate(product_rows(spark, sf))
    if columns:
        gated = gated.select("id", *columns, "endpoint_pos", "item_pos")
    return D.dedup_first(gated, "id", ["endpoint_pos", "item_pos"])


# ------------------------------------------------------------- flagship / E1

@query("count_by_source")
def q_count_by_source(spark, sf):
    return R.count_by_source(catalog(spark, sf, ["source"]))


@query("to_product_row")
def q_to_product_row(spark, sf):
    return flat_products(product_rows(spark, sf))


@query("price_gate")
def q_price_gate(spark, sf):
    return flat_products(RW.price_gate(product_rows(spark, sf)))


@query("dedup_first")
def q_dedup_first(spark, sf):
    return flat_products(catalog(spark, sf))


# ------------------------------------------------------ scalar normalisers

def _k(spark, sf):
    return raw(spark, sf)


@query("format_price")
def q_format_price(spark, sf):
    r = _k(spark, sf)
    return N.with_price_text(r, "price_text", "currency").select("k", "price_text", "currency", "price")


@query("format_sale")
def q_format_sale(spark, sf):
    r = _k(spark, sf)
    k = F.col("k")
    r = r.select("k", "currency",
                 F.when(k % 2 == 0, F.col("price_text")).alias("sale"),
                 F.when(k % 3 == 0, F.lit("")).otherwise(F.lit(" 9,99 ")).alias("sale_price"))
    return r.select("k", N.format_sale("sale", "currency", "sale_price").alias("sale"))


AVAIL_CYCLE = ["In Stock", " sold out ", "preorder", "AVAILABLE", None, "weird", "out-of-stock", ""]


@query("normalize_availability")
def q_normalize_availability(spark, sf):
    r = _k(spark, sf)
    k = F.col("k")
    r = r.select("k", FX._cycle(k, AVAIL_CYCLE).alias("availability"),
                 F.when(k % 5 == 0, k % 2 == 0).alias("in_stock_flag"))
    return r.select("k", N.normalize_availability("availability", "in_stock_flag").alias("availability"))


@query("product_id")
def q_product_id(spark, sf):
    r = site_rows(spark, sf)
    return r.select("k", N.product_id("source", "external_id", None, "product_url").alias("id"))


@query("clean_title")
def q_clean_title(spark, sf):
    return _k(spark, sf).select("k", N.clean_title("title").alias("title"))


@query("clean_description")
def q_clean_description(spark, sf):
    return _k(spark, sf).select("k", N.clean_description("description").alias("description"))


def _media():
    k = F.col("k")
    arr = F.array(F.col("image_url"), F.concat(F.lit(" "), F.col("product_url"), F.lit(" ")),
                  F.col("image_url"), F.lit(""))
    return F.when(k % 4 != 0, arr)


@query("image_gallery")
def q_image_gallery(spark, sf):
    r = _k(spark, sf).withColumn("_xmedia_urls", _media())
    main, extra = N.image_gallery("_xmedia_urls", "image_url")
    return r.select("k", main.alias("image_url"), F.array_join(extra, "|").alias("additional_images"))


@query("normalize_gender")
def q_normalize_gender(spark, sf):
    return _k(spark, sf).select("k", N.normalize_gender("gender").alias("gender"))


@query("normalize_size")
def q_normalize_size(spark, sf):
    """Sizes as text, list, list of lists and JSON value; the first truthy one wins."""
    from shelfline.sources.feeds import json_field
    k = F.col("k")
    r = _k(spark, sf).select("k", "size_list", FX._cycle(k, [None, "", " XL ", None]).alias("size"),
                             F.when(k % 3 == 0, F.array(F.col("size_list"), F.lit(None).cast("array<string>"), F.array(F.lit(" S "), F.lit("")))).alias("nested"),
                             json_field(F.when(k % 2 == 0, F.lit('{"s":["36",[" 38 ","36"],40,["40",null]]}')).otherwise(F.lit('{"s":" 42 "}')), "s").alias("json"))
    return r.select("k", N.normalize_size(("size", "string"), ("nested", "array<array<string>>"), ("size_list", "array<string>"),
                                          ("json", N.JSON_VALUE)).alias("size"))


def _products_k(spark, sf):
    return RW.to_product_row(site_rows(spark, sf), keep=["k", "endpoint_pos", "item_pos"])


@query("build_product_url")
def q_build_product_url(spark, sf):
    return _products_k(spark, sf).select("k", "product_url")


@query("build_metadata")
def q_build_metadata(spark, sf):
    return _products_k(spark, sf).select("k", N.metadata_text("metadata").alias("metadata_text"))


@query("build_info_text")
def q_build_info_text(spark, sf):
    return RW.with_info_text(_products_k(spark, sf)).select("k", "info_text")


@query("category_lookup")
def q_category_lookup(spark, sf):
    from shelfline.operators.maintain import categories_table, category_lookup
    r = _k(spark, sf).select("k", "endpoint")
    return category_lookup(r, categories_table(spark)).select("k", "category")


@query("format_for_db")
def q_format_for_db(spark, sf):
    r = site_rows(spark, sf).withColumn("price", F.col("price_text"))
    out = RW.format_for_db(r.drop("price_text"))
    return out.select("id", "source", "product_url", "image_url", "title", "brand", "gender",
                      "price", "second_hand", "description",
                      F.col("metadata")["country"].alias("meta_country"))


@query("is_allowed_image_url")
def q_is_allowed_image_url(spark, sf):
    return _k(spark, sf).select("k", N.is_allowed_image_url("image_url").alias("allowed"))


def _image_candidates():
    """Image URLs covering every rule: short marked host, long one with {width},
    video, non-image extension, protocol-relative with padding."""
    k = F.col("k")
    ks = k.cast("string")
    return F.when(k % 6 == 0, F.col("image_url")) \
        .when(k % 6 == 1, F.concat(F.lit("https://static.zara.net/photos/"), ks, F.lit(".jpg"))) \
        .when(k % 6 == 2, F.concat(F.lit("https://static.zara.net/photos///2024/V/0/1/p/"),
                                   F.lpad(ks, 60, "0"), F.lit("-e1.jpg?w={width}&h={width}"))) \
        .when(k % 6 == 3, F.concat(F.lit("https://cdn.example/v/"), ks, F.lit("/video.mp4"))) \
        .when(k % 6 == 4, F.concat(F.lit("cdn.example//img//"), ks, F.lit("//a.JSON"))) \
        .otherwise(F.concat(F.lit("  //cdn.example/i/"), ks, F.lit("-s.png ")))


@query("is_embeddable_image_url")
def q_is_embeddable_image_url(spark, sf):
    r = _k(spark, sf)
    return r.select("k", _image_candidates().alias("url")).select("k", "url",
                                                   N.is_embeddable_image_url("url").alias("embeddable"))


@query("clean_image_url")
def q_clean_image_url(spark, sf):
    r = _k(spark, sf)
    return r.select("k", _image_candidates().alias("url")).select("k", N.clean_image_url("url").alias("clean_url"))


@query("pick_image_url")
def q_pick_image_url(spark, sf):
    r = _k(spark, sf)
    k = F.col("k")
    r = r.select("k", "image_url",
                 F.concat(F.lit("https://img.example/"), k.cast("string"),
                          F.when(k % 2 == 0, F.lit("-s.jpg")).otherwise(F.lit(".jpg"))).alias("alt_url"),
                 F.lit("data:image/gif;base64,R0").alias("placeholder"))
    return RW.pick_image(r, ["image_url", "alt_url", "placeholder"], "picked").select("k", "picked")


@query("required_fields_gate")
def q_required_fields_gate(spark, sf):
    r = site_rows(spark, sf).withColumn("price", F.col("price_text"))
    return RW.required_fields_gate(r).select("k")


# --------------------------------------------------------- de-dup, limits

@query("limit_per_site")
def q_limit_per_site(spark, sf):
    """First 5 products per site in arrival order, before the price gate and de-dup."""
    out = D.limit_per_site(_products_k(spark, sf), 5, site="source", order=["endpoint_pos", "item_pos"])
    return out.select("k", "source", "id", "price")


@query("dedup_stats")
def q_dedup_stats(spark, sf):
    return D.dedup_stats(RW.price_gate(product_rows(spark, sf)), "id")


@query("dedup_last")
def q_dedup_last(spark, sf):
    ev = FX.table(spark, sf, "events")
    return D.dedup_last(ev.select("user_id", "event_id", "ts", "event_type", "value"),
                        "user_id", ["ts", "event_id"])


# ------------------------------------------------------------------- reads

@query("read_products")
def q_read_products(spark, sf):
    return R.read_products(catalog(spark, sf, ["source", "title", "brand"]),
                           ["id", "title", "brand"], source="src1")


@query("product_count")
def q_product_count(spark, sf):
    return R.product_count(catalog(spark, sf, ["source"]))


@query("product_count_source")
def q_product_count_source(spark, sf):
    return R.product_count(catalog(spark, sf, ["source"]), source="src2")


@query("site_totals")
def q_site_totals(spark, sf):
    return R.site_totals(catalog(spark, sf, ["brand"]), "brand")


@query("sample_products")
def q_sample_products(spark, sf):
    return R.sample_products(catalog(spark, sf, ["title", "brand"]), 3)


@query("recent_products")
def q_recent_products(spark, sf):
    o = FX.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("source"),
        F.col("o_orderdate").alias("created_at"))
    return R.recent_products(o, source="F", k=10).select(
        "id", "source", F.col("created_at").cast("string").alias("created_at"))


@query("select_sites")
def q_select_sites(spark, sf):
    from shelfline.sources.feeds import select_sites
    sites = FX.sites_table(FX.table(spark, sf, "part"))
    return select_sites(sites, "Brand#13, brand#22 ,BRAND#45").select("brand", "source")


@query("apply_site_defaults")
def q_apply_site_defaults(spark, sf):
    r = site_rows(spark, sf)
    return r.select("k", "merchant", "source", "country", "external_id", "product_url_template")


# ------------------------------------------------------------------ feeds

def _feeds(spark, sf):
    return FX.feeds(raw(spark, sf))


def _items(spark, sf):
    from shelfline.sources.feeds import read_feed_items
    return read_feed_items(_feeds(spark, sf))


def _mapped(spark, sf):
    from shelfline.sources.feeds import map_fields
    return map_fields(_items(spark, sf), FX.FEED_MAPPING,
                      keep=["endpoint_pos", "endpoint", "page", "item_pos"])


def _usable(spark, sf):
    from shelfline.sources.feeds import has_identifier, has_required_image
    return has_required_image(has_identifier(_mapped(spark, sf)), FX.FEED_MAPPING)


@query("read_feed_items")
def q_read_feed_items(spark, sf):
    return _items(spark, sf).select("endpoint_pos", "endpoint", "page", "item_pos",
                                    F.col("item.id").alias("item_id"), F.col("item.name").alias("name"))


@query("map_fields")
def q_map_fields(spark, sf):
    m = _mapped(spark, sf)
    return m.select("endpoint_pos", "page", "item_pos", "external_id", "product_id", "title",
                    "description", "gender", F.col("price.kind").alias("price_kind"), F.col("price.raw").alias("price"),
                    "currency", "country", "image_url",
                    F.array_join("_xmedia_urls", "|").alias("xmedia_urls"), "seo_keyword",
                    "seo_product_id", "product_url", "brand", F.array_join("color_names", "|").alias("color_names"),
                    *[F.col(f"{c}.{part}").alias(f"{c}_{part}") for c in ("sale", "sizes") for part in ("kind", "raw")])


@query("with_provenance")
def q_with_provenance(spark, sf):
    from shelfline.sources.feeds import with_provenance
    p = with_provenance(_items(spark, sf))
    return p.select("endpoint_pos", "page", "item_pos", F.col("_meta.source").alias("meta_source"),
                    F.col("_meta.endpoint").alias("meta_endpoint"))


@query("has_identifier")
def q_has_identifier(spark, sf):
    from shelfline.sources.feeds import has_identifier
    return has_identifier(_mapped(spark, sf)).select("endpoint_pos", "page", "item_pos", "external_id")


@query("has_required_image")
def q_has_required_image(spark, sf):
    return _usable(spark, sf).select("endpoint_pos", "page", "item_pos", "external_id", "image_url")


@query("ingest_stats")
def q_ingest_stats(spark, sf):
    from shelfline.sources.feeds import ingest_stats
    return ingest_stats(_mapped(spark, sf), "endpoint", FX.FEED_MAPPING)


@query("union_batches")
def q_union_batches(spark, sf):
    from shelfline.sources.feeds import (read_feed_items, map_fields, has_identifier,
                                         has_required_image, union_batches)
    docs = _feeds(spark, sf)
    parts = []
    for cond in (F.col("endpoint_pos") < 12, F.col("endpoint_pos") >= 12):
        items = read_feed_items(docs.filter(cond))
        m = map_fields(items, FX.FEED_MAPPING, keep=["endpoint_pos", "endpoint", "page", "item_pos"])
        parts.append(has_required_image(has_identifier(m), FX.FEED_MAPPING))
    return union_batches(*parts).select("endpoint_pos", "page", "item_pos", "external_id")


@query("fallback_to_pages")
def q_fallback_to_pages(spark, sf):
    from shelfline.sources.feeds import (fallback_to_pages, has_identifier, has_required_image, map_fields,
                                         read_feed_items)
    r = raw(spark, sf)
    items = map_fields(read_feed_items(FX.failing_feeds(r)), FX.FEED_MAPPING, keep=["endpoint_pos", "endpoint"])
    feed_products = has_required_image(has_identifier(items), FX.FEED_MAPPING).select(
        "endpoint_pos", "endpoint", F.lit("feed").alias("origin"),
        F.col("seo_product_id").alias("item_id"), "external_id")
    pages = FX.page_rows(r).withColumn("origin", F.lit("page"))
    out = fallback_to_pages(FX.failing_feeds(r), feed_products, pages)
    return out.select("origin", "item_id", "external_id")


@query("category_endpoints")
def q_category_endpoints(spark, sf):
    from shelfline.sources.feeds import category_endpoints
    docs = FX.category_docs(FX.table(spark, sf, "part"))
    return category_endpoints(docs, FX.CATEGORY_TEMPLATE)


@query("category_ids_recursive")
def q_category_ids_recursive(spark, sf):
    from shelfline.sources.feeds import category_ids_recursive
    docs = FX.category_docs(FX.table(spark, sf, "part"))
    return category_ids_recursive(docs, FX.CATEGORY_TEMPLATE).select("doc", "pos", "url")


def endpoint_candidates(r):
    k = F.col("k")
    static = r.select(F.col("source").alias("site"), F.lit("static").alias("kind"),
                      k.alias("pos"), F.col("endpoint").alias("url"))
    js = r.filter(k % 3 != 0).select(F.col("source").alias("site"), F.lit("json").alias("kind"),
                                     k.alias("pos"),
                                     F.concat(F.lit(FX.SHOP + "/j/"), (k % 24).cast("string")).alias("url"))
    html = r.filter(k % 3 == 2).select(F.col("source").alias("site"), F.lit("html").alias("kind"),
                                       k.alias("pos"),
                                       F.concat(F.lit(FX.SHOP + "/h/"), (k % 24).cast("string")).alias("url"))
    return static.unionByName(js).unionByName(html)


@query("resolve_endpoints")
def q_resolve_endpoints(spark, sf):
    from shelfline.sources.feeds import resolve_endpoints
    chosen = resolve_endpoints(endpoint_candidates(raw(spark, sf)))
    return D.ordered_distinct(chosen, "url", ["pos"], group=["site", "kind"])


# ------------------------------------------------------ table maintenance

def _vec_cols(df, c="image_embedding"):
    return [F.when(F.col(c).isNotNull(), F.size(c)).cast("bigint").alias("emb_dim"),
            F.try_element_at(c, F.lit(1)).cast("double").alias("emb_first")]


def _upserted(spark, sf):
    from shelfline.operators.maintain import upsert_products
    part = FX.table(spark, sf, "part")
    return upsert_products(FX.maintenance_target(part), FX.maintenance_batch(part), order="pos")


@query("upsert_products")
def q_upsert_products(spark, sf):
    return _upserted(spark, sf).select("id", "source", "title", "price", "image_url",
                                       *_vec_cols(None))


@query("prune_missing")
def q_prune_missing(spark, sf):
    from shelfline.operators.maintain import prune_missing
    part = FX.table(spark, sf, "part")
    pruned = prune_missing(_upserted(spark, sf), FX.maintenance_batch(part).select("id"), "src1")
    return pruned.select("id", "source", "title", "price", "image_url", *_vec_cols(None))


@query("pending_embeddings")
def q_pending_embeddings(spark, sf):
    from shelfline.operators.maintain import pending_embeddings
    part = FX.table(spark, sf, "part")
    return pending_embeddings(FX.maintenance_target(part), FX.maintenance_batch(part))


@query("align_columns")
def q_align_columns(spark, sf):
    from shelfline.operators.maintain import align_columns
    part = FX.table(spark, sf, "part")
    a = FX.maintenance_batch(part).filter("pos = 0").select("id", "source", "price", "embedding")
    k = F.col("p_partkey")
    b = part.filter(k % 2 == 1).select(F.concat(F.lit("P"), k.cast("string")).alias("id"),
                                       F.col("p_name").alias("title"),
                                       F.concat(F.lit("https://img.example/"), k.cast("string"),
                                                F.lit("-s.jpg")).alias("image_url"))
    return align_columns(a, b)


@query("reset_vector_column")
def q_reset_vector_column(spark, sf):
    """Every value goes by default; ``keep_matching`` keeps those of the new width."""
    from shelfline.operators.maintain import reset_vector_column
    e = FX.table(spark, sf, "embeddings").withColumn("kept", F.col("embedding"))
    out = reset_vector_column(reset_vector_column(e, "embedding", 64), "kept", 64, keep_matching=True)
    return out.select("vec_id", "label", F.col("embedding").isNull().alias("reset"), F.size("kept").alias("kept_width"))


# ------------------------------------------------------------- page jobs

PAGE_FIELDS = {"title": element_regex("title"), "description": element_regex("h1"), "price": None, "image_url": ("img", "src")}
SCAN_PATTERN = "[A-Z]"
HTML_TEMPLATE = FX.SHOP + "/category/{category_id}/products"
HTML_ID_REGEX = r"/(?:en|fr|de|es)/(\d+)"


def _pages(spark, sf):
    return FX.table(spark, sf, "pages")


def _awkward_pages(spark, sf):
    return FX.awkward_pages(_pages(spark, sf))


@query("page_fields")
def q_page_fields(spark, sf):
    from shelfline.sources.pages import page_fields
    return page_fields(_awkward_pages(spark, sf), PAGE_FIELDS)


@query("page_links")
def q_page_links(spark, sf):
    from shelfline.sources.pages import page_links
    return page_links(_awkward_pages(spark, sf))


@query("jsonld_urls")
def q_jsonld_urls(spark, sf):
    """ld+json item-list URLs of the card pages derived from ``part``, escapes decoded."""
    from shelfline.sources.pages import jsonld_urls
    return jsonld_urls(_card_pages(spark, sf))


@query("product_url_scan")
def q_product_url_scan(spark, sf):
    from shelfline.sources.pages import product_url_scan
    return product_url_scan(_awkward_pages(spark, sf), SCAN_PATTERN)


@query("category_links")
def q_category_links(spark, sf):
    from shelfline.sources.pages import category_links
    return category_links(_awkward_pages(spark, sf), SCAN_PATTERN)


@query("html_endpoints")
def q_html_endpoints(spark, sf):
    from shelfline.sources.pages import html_endpoints
    return html_endpoints(_awkward_pages(spark, sf), HTML_TEMPLATE, HTML_ID_REGEX, "page")


@query("resolve_url")
def q_resolve_url(spark, sf):
    from shelfline.functions.urls import resolve_url
    from shelfline.sources.pages import ANCHOR
    p = _awkward_pages(spark, sf)
    tags = p.select("page_id", "url", F.posexplode(H.tags("html", ANCHOR)).alias("pos", "tag"))
    href = H.attribute("tag", "href")
    hrefs = RW.settled(tags.select("page_id", "url", F.col("pos").cast("bigint").alias("pos"), href.alias("href")))
    return hrefs.select("page_id", "pos", "href", resolve_url("href", F.col("url")).alias("resolved"))


@query("append_query_flag")
def q_append_query_flag(spark, sf):
    from shelfline.functions.urls import append_query_flag
    return _pages(spark, sf).select("page_id", append_query_flag("url").alias("endpoint"))


@query("ordered_distinct")
def q_ordered_distinct(spark, sf):
    from shelfline.sources.pages import page_links
    return D.ordered_distinct(page_links(_awkward_pages(spark, sf)), "link", ["page_id", "pos"])


@query("url_contains_any")
def q_url_contains_any(spark, sf):
    from shelfline.sources.pages import url_contains_any
    return url_contains_any(_pages(spark, sf), ["/en/", ".html", ""]).select("page_id", "url")


def page_card_counts(pages):
    host = F.regexp_extract("url", r"://([^/?#]+)", 1)
    n = F.size(F.regexp_extract_all("html", F.lit(r'href="/[A-Z]'), 0)).cast("bigint")
    return pages.select("page_id", host.alias("site"), (F.col("page_id") % 12).alias("page"),
                        n.alias("n_items"))


@query("take_until_empty_page")
def q_take_until_empty_page(spark, sf):
    return D.take_until_empty_page(page_card_counts(_pages(spark, sf)), "site", "page", "n_items")


def _card_pages(spark, sf):
    return FX.card_pages(FX.table(spark, sf, "part"))


@query("extract_cards")
def q_extract_cards(spark, sf):
    from shelfline.sources.pages import extract_cards
    return extract_cards(_card_pages(spark, sf))


@query("embedded_products")
def q_embedded_products(spark, sf):
    from shelfline.sources.pages import embedded_products
    return embedded_products(_card_pages(spark, sf))


@query("match_cards_to_embedded")
def q_match_cards_to_embedded(spark, sf):
    from shelfline.sources.pages import match_cards_to_embedded
    out = match_cards_to_embedded(_card_pages(spark, sf), title_prefix=None)
    return out.select("page_id", "card_pos", "card_id", "title", "description", "price", "image_url")


PRODUCT_PAGE_FIELDS = {"title": element_regex("title"), "price": H.element_regex(H.class_regex("div", "price"), "div"), "image_url": ("img", "src")}


@query("page_run")
def q_page_run(spark, sf):
    """Category pages -> cards filled from embedded JSON -> product rows."""
    from shelfline.plans.catalog import card_products
    return flat_products(card_products(_card_pages(spark, sf), FEED_SITE, {"currency": "'USD'"}))


@query("page_run_links")
def q_page_run_links(spark, sf):
    """Category pages -> links -> product pages -> product rows."""
    from shelfline.plans.catalog import linked_products
    part = FX.table(spark, sf, "part")
    return flat_products(linked_products(FX.card_pages(part), FX.product_pages(part), FEED_SITE, PRODUCT_PAGE_FIELDS))


def _card_inputs(spark, sf):
    k = F.col("p_partkey")
    ks = k.cast("string")
    return FX.table(spark, sf, "part").select(
        k.alias("k"),
        F.when(k % 4 == 0, F.concat(F.lit(FX.SHOP + "/products/handle-"), ks, F.lit("?v=1")))
         .when(k % 4 == 1, F.concat(F.lit(FX.SHOP + "/a/products/x/products/h"), ks, F.lit("/more")))
         .when(k % 4 == 2, F.lit(FX.SHOP + "/products/"))
         .otherwise(F.concat(F.lit(FX.SHOP + "/item/"), ks)).alias("url"),
        F.when(k % 3 == 0, F.concat(F.lit("plp-productCard-"), ks, F.lit("-select")))
         .when(k % 3 == 1, F.concat(F.lit("plp-productCard-Wishlist-"), ks))
         .otherwise(F.concat(F.lit("tile-"), ks)).alias("testid"),
        F.when(k % 6 == 0, F.concat(F.lit("//cdn.example/"), ks, F.lit("-e1.jpg")))
         .when(k % 6 == 1, F.concat(F.lit("/img/"), ks, F.lit("-s.jpg")))
         .when(k % 6 == 2, F.concat(F.lit("assets/"), ks, F.lit("-ult21.jpg")))
         .when(k % 6 == 3, F.concat(F.lit("https://cdn.example/"), ks, F.lit(".jpg")))
         .when(k % 6 == 4, F.concat(F.lit("img/"), ks, F.lit("-e1.jpg")))
         .otherwise(F.concat(F.lit("/x/"), ks, F.lit("-s.png"))).alias("src"),
        F.when(k % 3 == 0, F.lit("https://www.shop.example/cz/en/women/dresses"))
         .when(k % 3 == 1, F.lit("https://www.shop.example/en_us/list"))
         .otherwise(F.lit("https://www.shop.example/c/list")).alias("page_url"))


@query("product_handle")
def q_product_handle(spark, sf):
    from shelfline.functions.urls import product_handle
    return _card_inputs(spark, sf).select("k", product_handle("url").alias("handle"))


@query("card_product_id")
def q_card_product_id(spark, sf):
    from shelfline.functions.urls import card_product_id
    return _card_inputs(spark, sf).select("k", card_product_id("testid").alias("card_id"))


@query("absolutize_image_url")
def q_absolutize_image_url(spark, sf):
    from shelfline.functions.urls import absolutize_image_url
    return _card_inputs(spark, sf).select("k", absolutize_image_url("src", "page_url").alias("image_url"))


@query("parse_price_number")
def q_parse_price_number(spark, sf):
    d = FX.table(spark, sf, "documents")
    return d.select("doc_id", N.parse_price_number("text").alias("price"))


@query("expand_sitemaps")
def q_expand_sitemaps(spark, sf):
    from shelfline.sources.sitemaps import expand_sitemaps
    sm = FX.sitemaps(_pages(spark, sf))
    out = expand_sitemaps(spark, sm, [FX.SITEMAP_ROOT])
    return out.select("url", "depth", F.array_join(F.col("ord").cast("array<string>"), ".").alias("ord"))


# ----------------------------------------------------------------- vectors

TOPK = 5


def _embeddings(spark, sf):
    return FX.table(spark, sf, "embeddings")


@query("valid_vectors")
def q_valid_vectors(spark, sf):
    from shelfline.operators.vectors import valid_vectors
    e = _embeddings(spark, sf)
    k = F.col("vec_id")
    bad = (F.when(k % 50 == 0, F.lit(None).cast("array<float>"))
           .when(k % 50 == 1, F.array().cast("array<float>"))
           .when(k % 50 == 2, F.slice("embedding", 1, 63))
           .otherwise(F.col("embedding")))
    out = valid_vectors(e.select("vec_id", bad.alias("embedding")), "embedding", 64)
    return out.select("vec_id", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("dim"))


@query("cosine_topk")
def q_cosine_topk(spark, sf):
    from shelfline.operators.vectors import cosine_topk
    e = _embeddings(spark, sf)
    out = cosine_topk(e, FX.label_centroids(e), TOPK, id_col="vec_id", vec_col="embedding")
    return out.select("query_id", "vec_id", F.round("score", 5).alias("score"), "rank")


@query("ivf_topk")
def q_ivf_topk(spark, sf):
    """Cells around the label means (ten, a bounded set), four probed per query."""
    import numpy as np
    from shelfline.operators.vectors import build_ivf_index, ivf_topk
    from shelfline.session import shared_dir
    e = _embeddings(spark, sf)
    means = FX.label_centroids(e)
    path = shared_dir(spark, "ivf-index")
    cents = np.array([r["query_vec"] for r in means.orderBy("query_id").collect()])
    index = build_ivf_index(e.select("vec_id", "embedding"), path, "embedding", centroids=cents)
    out = ivf_topk(index, means, TOPK, nprobe=4, id_col="vec_id")
    return out.select("query_id", "vec_id", F.round("score", 5).alias("score"), "rank")


def _letter_encoder():
    """A plain encoder that SQL can restate: counts of four letters; it fails on a batch that holds an '@'."""
    import numpy as np

    def encode(texts):
        if len(texts) > 1 and any("@" in t for t in texts):
            raise ValueError("an address in the batch")
        return np.array([[t.count(c) for c in "aeio"] for t in texts], dtype=np.float32)
    return encode


@query("embed_column")
def q_embed_column(spark, sf):
    from shelfline.operators.vectors import embed_column
    d = FX.table(spark, sf, "documents").select("doc_id", "text")
    out = embed_column(d, "text", lambda: _letter_encoder(), "embedding", 4)
    return out.select("doc_id", *[F.element_at("embedding", i + 1).cast("double").alias(c) for i, c in enumerate("aeio")])


def _byte_encoder():
    """Length and counts of three bytes; content that begins with 0xFF is no picture, and fails whatever batch it is in."""
    import numpy as np

    def encode(contents):
        if any(c[0] == 0xFF for c in contents):
            raise ValueError("no picture")
        return np.array([[len(c), c.count(b"<"), c.count(b"e"), c.count(b"\n")] for c in contents], dtype=np.float32)
    return encode


@query("embed_image_bytes")
def q_embed_image_bytes(spark, sf):
    """Bytes of the pages as image contents: some null, some empty, some that the encoder rejects."""
    from shelfline.operators.vectors import embed_column
    k, content = F.col("page_id"), F.encode("html", "UTF-8")
    content = (F.when(k % 13 == 0, F.lit(None).cast("binary")).when(k % 13 == 1, F.lit(b""))
               .when(k % 13 == 2, F.concat(F.lit(b"\xff\xd8"), content)).otherwise(content))
    pages = FX.table(spark, sf, "pages").select("page_id", content.alias("image"))
    out = embed_column(pages, "image", lambda: _byte_encoder(), "image_embedding", 4)
    names = ("n_bytes", "n_lt", "n_e", "n_lf")
    return out.select("page_id", *[F.element_at("image_embedding", i + 1).cast("double").alias(c) for i, c in enumerate(names)])


# --------------------------------------------------------------- streaming

def _run_stream(spark, sf, with_pending=False):
    from shelfline.session import shared_dir
    from shelfline.streaming.upsert import stream_upsert
    ev = FX.events_with_gaps(FX.table(spark, sf, "events"))
    base = shared_dir(spark, "stream")
    FX.write_arrivals(ev, f"{base}/arrivals")
    table = stream_upsert(spark, f"{base}/arrivals", ev.schema, f"{base}/table", f"{base}/ckpt",
                          "user_id", ["ts", "event_id"],
                          pending_dir=f"{base}/pending" if with_pending else None,
                          vector="value" if with_pending else None, max_files_per_trigger=FX.ARRIVAL_FILES,
                          buckets=16)
    return table, base


@query("stream_upsert")
def q_stream_upsert(spark, sf):
    table, _ = _run_stream(spark, sf)
    return table.read()


@query("stream_pending_embeddings")
def q_stream_pending_embeddings(spark, sf):
    from shelfline.streaming.upsert import read_pending
    _, base = _run_stream(spark, sf, with_pending=True)
    return read_pending(spark, f"{base}/pending").select("user_id", "event_id", F.col("epoch").cast("bigint").alias("epoch"))


# ------------------------------------------------------------- E1 pipeline

FEED_SITE = {k: v for k, v in FX.SITE.items() if k != "source"}


@query("feed_run")
def q_feed_run(spark, sf):
    from shelfline.plans.catalog import feed_products
    out = feed_products(_feeds(spark, sf), FEED_SITE, FX.FEED_MAPPING)
    return flat_products(out)


@query("format_price_variants")
def q_format_price_variants(spark, sf):
    from shelfline.sources.feeds import json_field
    p = FX.price_payloads(FX.table(spark, sf, "part")).withColumn("price", json_field("payload", "price"))
    return p.select("k", N.format_price("price", "currency").alias("price"))


@query("dedup_first_url_key")
def q_dedup_first_url_key(spark, sf):
    """First row per ``source:product_url`` (the alternate key; a null URL prints 'None')."""
    rows = RW.price_gate(_products_k(spark, sf))
    rows = rows.withColumn("url_key", RW.product_key_text(rows))
    out = D.dedup_first(rows.select("url_key", "k", "id", "source", "product_url",
                                    "endpoint_pos", "item_pos"), "url_key", ["endpoint_pos", "item_pos"])
    return out.select("url_key", "k", "id")


RUN_1, RUN_2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def synced_table(spark, sf):
    """The F1 catalog persisted (run 1), then a src1 feed run with sync (run 2)."""
    import datetime as dt
    from shelfline.plans.catalog import ORDER, feed_products, maintain_products
    from shelfline.session import shared_dir
    from shelfline.sources.table import PartitionedTable
    table = PartitionedTable(spark, shared_dir(spark, "products"), "id", buckets=16, scope="source")
    initial = catalog(spark, sf).drop("endpoint_pos", "item_pos")
    maintain_products(table, initial, "src1", sync=False,
                      run_ts=dt.datetime.fromisoformat(RUN_1))
    run = feed_products(_feeds(spark, sf), dict(FEED_SITE, source="src1"), FX.FEED_MAPPING)
    maintain_products(table, run.drop(*ORDER), "src1", sync=True,
                      run_ts=dt.datetime.fromisoformat(RUN_2))
    return table


@query("feed_run_sync")
def q_feed_run_sync(spark, sf):
    """A feed run for source 'src1' with sync, applied to the F1 catalog table."""
    return flat_products(synced_table(spark, sf).read())


@query("read_products_table")
def q_read_products_table(spark, sf):
    """Source filter over the persisted table: prunes to the source's partitions."""
    return R.read_products(synced_table(spark, sf).read(), ["id", "title", "brand"], source="src2")


@query("recent_products_table")
def q_recent_products_table(spark, sf):
    """Newest 10 rows of source src1 by created_at (inserted by run 2 first)."""
    out = R.recent_products(synced_table(spark, sf).read(), source="src1", k=10)
    return out.select("id", "title", F.col("created_at").cast("string").alias("created_at"))


@query("stream_feed_run")
def q_stream_feed_run(spark, sf):
    """Feed documents streamed in four arrivals, one micro-batch each; a later arrival of an id wins."""
    from shelfline.session import shared_dir
    from shelfline.streaming.upsert import stream_feed_run
    docs = _feeds(spark, sf)
    base = shared_dir(spark, "feed-stream")
    FX.write_arrivals(docs, f"{base}/arrivals", 4, order="endpoint_pos")
    table = stream_feed_run(spark, f"{base}/arrivals", docs.schema, f"{base}/table", f"{base}/ckpt",
                            FEED_SITE, FX.FEED_MAPPING, buckets=16, max_files_per_trigger=FX.ARRIVAL_FILES)
    return flat_products(table.read())


@query("format_sale_variants")
def q_format_sale_variants(spark, sf):
    """First truthy of sale / sale_price / salePrice (any JSON kind), formatted."""
    from shelfline.sources.feeds import json_field
    fields = ("sale", "sale_price", "salePrice")
    p = FX.sale_payloads(FX.table(spark, sf, "part")).withColumns({f: json_field("payload", f) for f in fields})
    return p.select("k", N.format_sale_values([F.col(f) for f in fields], "currency").alias("sale"))


@query("run_sites")
def q_run_sites(spark, sf):
    """Feed documents of several sites (brands of ``part``), three requested,
    first 3 items per site, imported rows per site and in total."""
    from shelfline.plans.catalog import run_sites
    docs = _feeds(spark, sf)
    digit = (F.col("endpoint_pos") % 5 + 1).cast("string")
    docs = docs.withColumn("site", F.concat(F.lit("Brand#"), digit))
    sites = FX.sites_table(FX.table(spark, sf, "part"))
    _, totals = run_sites(docs, sites, FX.FEED_MAPPING, "Brand#1, brand#3 ,BRAND#5", limit=3)
    return totals.select("site", "imported")


@query("ivf_topk_all_cells")
def q_ivf_topk_all_cells(spark, sf):
    """IVF search probing every cell: must equal the exact top-k."""
    from shelfline.operators.vectors import build_ivf_index, ivf_topk
    from shelfline.session import shared_dir
    e = _embeddings(spark, sf)
    path = shared_dir(spark, "ivf-index")
    index = build_ivf_index(e.select("vec_id", "embedding"), path, "embedding", lists=20)
    out = ivf_topk(index, FX.label_centroids(e), TOPK, nprobe=20, id_col="vec_id")
    return out.select("query_id", "vec_id", F.round("score", 5).alias("score"), "rank")

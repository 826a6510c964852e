"""Row operators: site defaults, the product projection, and row gates.

``to_product_row`` is one ``select`` of compiled Column expressions. It is too
wide to be fused with what stands around it, so it is compiled by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import constants as K
from shelfline.functions import normalize as N
from shelfline.functions.text import compiled_apart, truthy, py_or, strip

PRODUCT_COLUMNS = ["id", "source", "title", "description", "brand", "image_url",
                   "additional_images", "product_url", "affiliate_url", "second_hand",
                   "price", "sale", "gender", "category", "size", "metadata"]


def settled(df: DataFrame) -> DataFrame:
    """The same rows as a generator's output: filters and projections that
    follow use the values, where Spark would otherwise copy the expressions
    into each of them and work them out again. Columns that nothing reads are
    not pruned through it."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def _get(df: DataFrame, name: str, dtype: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def _opt(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else None


def apply_site_defaults(raw: DataFrame, site=None, sites: DataFrame | None = None,
                        on: str = "site") -> DataFrame:
    """Fill per-site defaults.

    ``merchant`` and ``source`` are filled only when the column is absent (a
    mapped null stays null); ``country`` when falsy; ``external_id`` becomes
    ``product_id`` or ``product_url`` when falsy; the URL template is attached.
    ``site`` is one config dict (literals, no join); ``sites`` is a config
    table joined on ``on`` (Spark broadcasts it by its measured size).
    """
    if sites is not None:
        cfg = sites.select(*[F.col(c).alias(f"_site_{c}") if c != on else F.col(c)
                             for c in sites.columns])
        df = raw.join(cfg, on, "left")
        val = {c: F.col(f"_site_{c}") for c in sites.columns if c != on}
    else:
        df = raw
        val = {k: F.lit(v) for k, v in (site or {}).items()}
    none = F.lit(None).cast("string")
    merchant = val.get("merchant", val.get("brand", none))
    get = lambda c: _get(df, c)
    new = {}
    if "merchant" not in raw.columns:
        new["merchant"] = merchant
    if "source" not in raw.columns:
        new["source"] = val.get("source", F.lit(K.DEFAULT_SITE_SOURCE))
    if "country" in val:
        new["country"] = F.when(truthy(get("country")), get("country")).otherwise(val["country"])
    ext = py_or(get("external_id"), get("product_id"), get("product_url"))
    new["external_id"] = F.when(truthy(get("external_id")), get("external_id")).otherwise(ext)
    if "product_url_template" in val:
        new["product_url_template"] = val["product_url_template"]
    out = df.withColumns(new)
    if sites is not None:
        out = out.drop(*[f"_site_{c}" for c in sites.columns if c != on])
    return out


def to_product_row(raw: DataFrame, keep: list[str] | None = None,
                   categories: DataFrame | None = None) -> DataFrame:
    """RAW -> PRODUCT in one projection.

    ``price`` and the sale fields ``sale``/``sale_price``/``salePrice`` are
    text or JSON values (``price_text`` stands in for ``price``); sizes are
    the first truthy of ``size``, ``sizes``, ``available_sizes``,
    ``size_list``, each a text, a list, a list of lists or a JSON value.
    Media: ``_xmedia_urls``.
    ``keep`` carries extra columns (e.g. the arrival order) through.
    """
    g = lambda c, t="string": _get(raw, c, t)
    source = py_or(g("source"), F.lit(K.DEFAULT_SOURCE))
    ext = py_or(g("external_id"), g("product_id"))
    pid = N.product_id(source, g("external_id"), g("product_id"), g("product_url"))
    media = _opt(raw, "_xmedia_urls")
    main_img, extra_imgs = N.image_gallery(media, g("image_url"),
                                           g("additional_images", "array<string>"))
    currency = g("currency")
    kinds = dict(raw.dtypes)
    price_in = next((c for c in ("price_text", "price") if c in kinds), None)
    stage, price = raw, F.lit(None).cast("string")
    if price_in:
        # Text is staged so each regex runs once per row (no repeated sub-expressions).
        as_json = kinds[price_in] == N.JSON_VALUE
        text = F.when(F.col(price_in)["kind"] == "STRING", F.col(price_in)["raw"]) if as_json else F.col(price_in)
        stage = (raw.withColumn("_ps", strip(text)).withColumn("_pn", N.price_digits("_ps"))
                 .withColumn("_pc", N.clean_price_digits("_pn")))
        price = N.format_price_text_from("_ps", "_pc", currency)
        if as_json:
            price = F.when(F.col(price_in)["kind"] == "STRING", price).otherwise(N.format_price(price_in, currency))
    sales = [c for c in ("sale", "sale_price", "salePrice") if c in kinds]
    if any(kinds[c] == N.JSON_VALUE for c in sales):
        sale = N.format_sale_values([F.col(c) if kinds[c] == N.JSON_VALUE else N.text_value(c) for c in sales], currency)
    elif sales:
        sale = N.format_sale(sales[0], currency, *sales[1:])
    else:
        sale = F.lit(None).cast("string")
    size = N.normalize_size(*[(c, kinds[c]) for c in ("size", "sizes", "available_sizes", "size_list") if c in kinds])
    if categories is None:
        category = N.category_of_endpoint(g("endpoint"))
    else:
        category = F.col("_category")
    url = N.build_product_url(g("product_url"), g("product_url_template"), g("seo_keyword"),
                              g("seo_product_id"), g("id"), F.coalesce(ext, F.lit("")))
    merchant_name = py_or(g("merchant_name"), g("merchant"))
    metadata = N.build_metadata(merchant_name, g("country"), g("original_currency"))
    base = stage
    if categories is not None:
        from shelfline.operators.maintain import category_lookup
        base = category_lookup(stage, categories, out="_category")
    cols = [
        compiled_apart(pid).alias("id"),
        source.alias("source"),
        N.clean_title(g("title")).alias("title"),
        N.clean_description(g("description")).alias("description"),
        g("brand").alias("brand"),
        main_img.alias("image_url"),
        extra_imgs.alias("additional_images"),
        url.alias("product_url"),
        g("affiliate_url").alias("affiliate_url"),
        F.lit(False).alias("second_hand"),
        compiled_apart(price).alias("price"),
        sale.alias("sale"),
        N.normalize_gender(g("gender")).alias("gender"),
        category.alias("category"),
        size.alias("size"),
        metadata.alias("metadata"),
    ]
    return base.select(*cols, *[F.col(c) for c in (keep or [])])


def with_info_text(products: DataFrame, out: str = "info_text") -> DataFrame:
    return products.withColumn(out, N.build_info_text(
        "title", "description", "category", "brand", "size", "gender", "price", "sale",
        _opt(products, "other"), "metadata"))


def price_gate(products: DataFrame) -> DataFrame:
    """Drop rows whose formatted price is null or empty."""
    return products.filter(truthy(F.col("price")))


def required_fields_gate(products: DataFrame,
                         fields=("source", "product_url", "image_url", "title", "price")) -> DataFrame:
    cond = F.lit(True)
    for f in fields:
        cond = cond & truthy(_get(products, f))
    return products.filter(cond)


def format_for_db(products: DataFrame) -> DataFrame:
    """Rows without an id: id = sha256(source:product_url), optional keys, metadata.

    ``source`` defaults to 'zara' only when the column is absent; rows missing a
    required field or a price are dropped.
    """
    df = products if "source" in products.columns else products.withColumn(
        "source", F.lit(K.DEFAULT_SOURCE))
    df = required_fields_gate(df)
    g = lambda c, t="string": _get(df, c, t)
    opt_text = lambda c: F.when(truthy(g(c)), g(c))
    img_emb = F.coalesce(g("image_embedding", "array<float>"), g("embedding", "array<float>"))
    meta_pairs = [(k, _opt(df, k)) for k in ("merchant_name", "country", "original_currency")]
    meta_pairs = [(k, v) for k, v in meta_pairs if v is not None]
    if meta_pairs:
        metadata = F.create_map(*[x for k, v in meta_pairs for x in (F.lit(k), v.cast("string"))])
    else:
        metadata = F.lit(None).cast("map<string,string>")
    return df.select(
        F.sha2(F.concat_ws(":", F.col("source"), F.col("product_url")), 256).alias("id"),
        "source", "product_url", "image_url", "title",
        g("brand").alias("brand"), g("gender").alias("gender"), g("price").alias("price"),
        g("sale").alias("sale"), g("size").alias("size"),
        F.coalesce(g("second_hand", "boolean"), F.lit(False)).alias("second_hand"),
        opt_text("affiliate_url").alias("affiliate_url"),
        opt_text("description").alias("description"),
        opt_text("category").alias("category"),
        g("additional_images", "array<string>").alias("additional_images"),
        img_emb.alias("image_embedding"),
        g("info_embedding", "array<float>").alias("info_embedding"),
        metadata.alias("metadata"),
    )


def pick_image(df: DataFrame, candidates: list[str], out: str = "image_url",
               strict: bool = True) -> DataFrame:
    return df.withColumn(out, N.pick_image_url(candidates, strict))


def product_key_text(products: DataFrame) -> Column:
    """The alternate natural key ``source:product_url`` (a null url prints 'None')."""
    return F.concat_ws(":", F.col("source"), F.coalesce(F.col("product_url"), F.lit("None")))


__all__ = ["settled", "apply_site_defaults", "to_product_row", "with_info_text", "price_gate",
           "required_fields_gate", "format_for_db", "pick_image", "PRODUCT_COLUMNS",
           "product_key_text", "render_for_sink"]


def render_for_sink(products: DataFrame) -> DataFrame:
    """Text forms a relational sink stores: ``additional_images`` and
    ``metadata`` as JSON text (compact separators), everything else as is."""
    out = products
    for c in ("additional_images", "metadata"):
        if c in out.columns:
            out = out.withColumn(c, F.when(F.col(c).isNotNull(), F.to_json(F.col(c))))
    return out

"""Scalar normalisers: each returns a Column built from built-in functions.

Polymorphic inputs (a price can be text, a number, an object or a list)
arrive as JSON values, ``struct<kind, raw>``: the JSON type and the text
(unquoted for strings). Values inside an object or a list keep their own type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline import constants as K
from shelfline.functions.text import (
    col, strip, truthy, py_or, first_truthy, contains_any, num_text, replace_first,
)

# --------------------------------------------------------------------- price


def clean_price_digits(num) -> Column:
    """Digits with ``,``/``.`` -> a dotted number: both present drops commas; a
    single comma followed by at most two characters is the decimal point."""
    num = col(num)
    n_commas = F.length(num) - F.length(F.regexp_replace(num, ",", ""))
    after_comma = F.substring_index(num, ",", -1)
    return (
        F.when(num.contains(",") & num.contains("."), F.regexp_replace(num, ",", ""))
        .when((n_commas == 1) & (F.length(after_comma) <= 2), F.regexp_replace(num, ",", "."))
        .otherwise(F.regexp_replace(num, ",", ""))
    )


def price_digits(stripped) -> Column:
    return F.regexp_replace(col(stripped), r"[^0-9.,]", "")


def format_price_text_from(stripped, cleaned, currency) -> Column:
    """Final step of the text branch, from the stripped text and cleaned number."""
    s, cleaned, cur = col(stripped), col(cleaned), col(currency)
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(s.rlike("[A-Z]{3}"), s)
        .when(truthy(cur) & (cleaned != ""), F.concat(cleaned, cur))
        .otherwise(F.nullif(s, F.lit("")))
    )


def format_price_text(text, currency) -> Column:
    """Text price: keep when it already names a currency, else clean and append one."""
    s = strip(text)
    return format_price_text_from(s, clean_price_digits(price_digits(s)), currency)


def with_price_text(df, text, currency, out: str = "price"):
    """``format_price_text`` staged in three projections so each regex runs once."""
    return (df.withColumn("_ps", strip(text))
            .withColumn("_pn", price_digits("_ps"))
            .withColumn("_pc", clean_price_digits("_pn"))
            .withColumn(out, format_price_text_from("_ps", "_pc", currency))
            .drop("_ps", "_pn", "_pc"))


def format_price_number(num, is_int, currency) -> Column:
    """Numeric price: integers of 1000 or more are minor units (divided by 100)."""
    n = col(num).try_cast("double")
    scaled = F.when(F.coalesce(col(is_int), F.lit(False)) & (n >= 1000), n / 100).otherwise(n)
    return F.when(n.isNotNull() & truthy(currency), F.concat(num_text(scaled), col(currency)))


JSON_VALUE = "struct<kind:string,raw:string>"
NUMBER_KINDS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
PRICE_LIST = "array<struct<price:variant,value:variant,amount:variant,currency:string,curr:string,code:string>>"


def variant_kind(v) -> Column:
    """STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, OBJECT, ARRAY, VOID; null for a missing field."""
    return F.regexp_extract(F.schema_of_variant(col(v)), "^[A-Z]+", 0)


def kind_of_text(text) -> Column:
    """The kind of a JSON value that is no string, by its text."""
    t = col(text)
    return (F.when(t.startswith("{"), F.lit("OBJECT")).when(t.startswith("["), F.lit("ARRAY")).when(t.isin("true", "false"), F.lit("BOOLEAN"))
            .when(t.rlike(r"^-?[0-9]{1,18}$"), F.lit("BIGINT")).when(t.contains("e") | t.contains("E"), F.lit("DOUBLE")).otherwise(F.lit("DECIMAL")))


def json_value(variant, raw) -> Column:
    """The JSON value of a field read both as a variant and as text; null and missing are null."""
    raw = col(raw)
    return F.when(raw.isNotNull(), F.struct(variant_kind(variant).alias("kind"), raw.alias("raw")))


def text_value(text) -> Column:
    """A text as a JSON value."""
    return F.when(col(text).isNotNull(), F.struct(F.lit("STRING").alias("kind"), col(text).cast("string").alias("raw")))


def _is_number(kind: Column) -> Column:
    return kind.isin(*NUMBER_KINDS)


def _variant_text(v: Column) -> Column:
    """Numbers print as floats, true as 1, text is kept; all lose a trailing '.0'."""
    kind = variant_kind(v)
    return (F.when(_is_number(kind), num_text(F.try_variant_get(v, "$", "double")))
            .when(kind == "BOOLEAN", F.when(F.try_variant_get(v, "$", "boolean"), F.lit("1")).otherwise(F.lit("0")))
            .otherwise(F.regexp_replace(F.try_variant_get(v, "$", "string"), r"\.0$", "")))


def _variant_truthy(v: Column) -> Column:
    """Python truthiness: 0, '', false, {}, [] and null are falsy."""
    kind = variant_kind(v)
    return F.coalesce(
        F.when(_is_number(kind), F.try_variant_get(v, "$", "double") != 0)
        .when(kind == "VOID", F.lit(False))
        .otherwise(~F.try_variant_get(v, "$", "string").isin("", "false", "{}", "[]")), F.lit(False))


def json_truthy(value) -> Column:
    """Python truthiness of a JSON value."""
    kind, raw = col(value)["kind"], col(value)["raw"]
    return F.coalesce(F.when(_is_number(kind), raw.try_cast("double") != 0)
                      .when(kind == "STRING", raw != "")
                      .otherwise(~F.regexp_replace(raw, r"\s", "").isin("false", "{}", "[]")), F.lit(False))


def format_price_map(price_map) -> Column:
    """``{"USD": 20, "CZK": "450.50"}`` -> ``20USD,450.50CZK`` in insertion order (map of variants)."""
    entries = F.filter(F.map_entries(col(price_map)), lambda e: (F.length(e["key"]) == 3) & (variant_kind(e["value"]) != "VOID"))
    parts = F.transform(entries, lambda e: F.concat(_variant_text(e["value"]), F.upper(e["key"])))
    return F.nullif(F.array_join(parts, ","), F.lit(""))


def format_price_list(price_list) -> Column:
    """``[{"price": .., "currency": ..}, ...]`` -> ``20USD,450CZK`` (see ``PRICE_LIST``)."""
    def val(e):
        return F.when(_variant_truthy(e["price"]), e["price"]).when(_variant_truthy(e["value"]), e["value"]).otherwise(e["amount"])

    def cur(e):
        return py_or(e["currency"], e["curr"], e["code"])

    kept = F.filter(col(price_list), lambda e: F.coalesce(variant_kind(val(e)) != "VOID", F.lit(False)) & truthy(cur(e)))
    parts = F.transform(kept, lambda e: F.concat(_variant_text(val(e)), F.upper(cur(e))))
    return F.nullif(F.array_join(parts, ","), F.lit(""))


def format_price(value, currency) -> Column:
    """A JSON value of any kind, formatted; numbers need a currency."""
    kind, raw = col(value)["kind"], col(value)["raw"]
    return (F.when(kind == "STRING", format_price_text(raw, currency))
            .when(_is_number(kind), format_price_number(raw, raw.rlike(r"^-?[0-9]+$"), currency))
            .when(kind == "BOOLEAN", format_price_number(F.when(raw == "true", F.lit("1")).otherwise(F.lit("0")), F.lit(True), currency))
            .when(kind == "OBJECT", format_price_map(F.from_json(raw, "map<string,variant>")))
            .when(kind == "ARRAY", format_price_list(F.from_json(raw, PRICE_LIST))))


def format_sale(sale_text, currency, *more_text) -> Column:
    """First truthy of sale / sale_price / salePrice, then ``format_price_text``."""
    picked = first_truthy(sale_text, *more_text)
    return F.when(picked.isNotNull(), format_price_text(picked, currency))


def format_sale_values(values, currency) -> Column:
    """First truthy of several JSON values, formatted; none -> null."""
    picked = F.coalesce(*[F.when(json_truthy(v), col(v)) for v in values])
    return F.when(picked.isNotNull(), format_price(picked, currency))


# ----------------------------------------------------------------- plain text


def normalize_availability(text=None, flag=None) -> Column:
    """Booleans map to in/out of stock; words through the fixed table; else unknown."""
    lookup = F.create_map(*[F.lit(x) for kv in K.AVAILABILITY.items() for x in kv])
    word = F.lower(strip(col(text))) if text is not None else F.lit(None).cast("string")
    by_word = F.coalesce(F.try_element_at(lookup, word), F.lit("unknown"))
    if flag is None:
        return by_word
    f = col(flag)
    return (F.when(f.isNotNull(), F.when(f, F.lit("in_stock")).otherwise(F.lit("out_of_stock")))
            .otherwise(by_word))


def product_id(source, external_id, product_id_col=None, product_url=None) -> Column:
    """sha256 of ``source:external_id`` (or ``source:product_url``), else 'unknown'."""
    src = py_or(source, F.lit(K.DEFAULT_SOURCE))
    ids = [external_id] + ([product_id_col] if product_id_col is not None else [])
    ext = first_truthy(*ids)
    url = col(product_url) if product_url is not None else F.lit(None).cast("string")
    key = F.coalesce(ext, F.when(truthy(url), url))
    return F.when(key.isNotNull(), F.sha2(F.concat_ws(":", src, key), 256)).otherwise(F.lit("unknown"))


def clean_title(title) -> Column:
    return py_or(title, F.lit(K.DEFAULT_TITLE))


def clean_description(description) -> Column:
    return F.nullif(strip(F.coalesce(col(description), F.lit(""))), F.lit(""))


def normalize_gender(gender) -> Column:
    """women / men by keyword (women first); other values are kept; falsy -> null."""
    g = col(gender)
    low = F.lower(g)
    return (
        F.when(~truthy(g), F.lit(None).cast("string"))
        .when(low.rlike("|".join(K.WOMEN_WORDS)), F.lit("women"))
        .when(low.rlike("|".join(K.MEN_WORDS)), F.lit("men"))
        .otherwise(g)
    )


def _join_sizes(items) -> Column:
    """Strip every element without a lambda: join on a control character, trim
    around the separators, split back, drop blanks, keep first seen."""
    sep = "\u0000"
    joined = F.regexp_replace(F.array_join(items, sep), r"(?U)\s*\u0000\s*", sep)
    cleaned = F.array_distinct(F.array_remove(F.split(strip(joined), sep), ""))
    return F.nullif(F.array_join(cleaned, ", "), F.lit(""))


def _size_strings(raw) -> Column:
    """The strings of a JSON list, one nested level deep; other elements are skipped."""
    def texts(v):
        return F.when(variant_kind(v) == "STRING", F.array(F.try_variant_get(v, "$", "string"))) \
            .when(variant_kind(v) == "ARRAY", F.transform(
                F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: variant_kind(x) == "STRING"),
                lambda x: F.try_variant_get(x, "$", "string")))
    return F.flatten(F.array_compact(F.transform(F.from_json(raw, "array<variant>"), texts)))


def normalize_size(*sizes) -> Column:
    """First truthy of several (column, type) sizes: text, a list, a list of lists
    or a JSON value; lists are stripped, distinct, joined."""
    out = None
    for c, kind in reversed(sizes):
        c = col(c)
        if kind == "string":
            picked, text = truthy(c), F.nullif(strip(c), F.lit(""))
        elif kind == "array<string>":
            picked, text = F.coalesce(F.size(c) > 0, F.lit(False)), _join_sizes(c)
        elif kind == "array<array<string>>":
            picked, text = F.coalesce(F.size(c) > 0, F.lit(False)), _join_sizes(F.flatten(F.array_compact(c)))
        elif kind == JSON_VALUE:
            picked = json_truthy(c)
            text = (F.when(c["kind"] == "STRING", F.nullif(strip(c["raw"]), F.lit("")))
                    .when(c["kind"] == "ARRAY", _join_sizes(_size_strings(c["raw"]))))
        else:
            raise TypeError(f"no size can be read from {kind}")
        out = F.when(picked, text) if out is None else F.when(picked, text).otherwise(out)
    return F.lit(None).cast("string") if out is None else out


def category_of_endpoint(endpoint) -> Column:
    """Category name from ``/category/<id>/`` in the endpoint; default 'clothing'."""
    lookup = F.create_map(*[F.lit(x) for kv in K.CATEGORY_NAMES.items() for x in kv])
    cid = F.regexp_extract(F.coalesce(col(endpoint), F.lit("")), r"/category/(\d+)/", 1)
    return F.coalesce(F.try_element_at(lookup, cid), F.lit(K.DEFAULT_CATEGORY))


def build_product_url(product_url, template, keyword, seo_product_id, raw_id, discern) -> Column:
    """Fill ``{keyword}``, ``{id}``, ``{discern_id}`` when the URL is missing."""
    url, tmpl, kw = col(product_url), col(template), col(keyword)
    pid = F.coalesce(py_or(seo_product_id, raw_id), F.lit("None"))
    disc = F.coalesce(col(discern), F.lit(""))
    full = F.replace(F.replace(F.replace(tmpl, F.lit("{keyword}"), kw), F.lit("{id}"), pid),
                     F.lit("{discern_id}"), disc)
    # A keyword-only retry cannot succeed where the full fill failed (any other
    # placeholder fails both), so a template with unknown placeholders gives
    # no URL.
    filled = F.when(~full.rlike(r"\{[^{}]*\}") & (full != ""), full)
    need = ~truthy(url) & truthy(tmpl) & truthy(kw)
    return F.when(need & filled.isNotNull(), filled).otherwise(url)


def build_metadata(merchant_name=None, country=None, original_currency=None) -> Column:
    """Map of the truthy fields among merchant_name, country, original_currency."""
    pairs = []
    for k, v in (("merchant_name", merchant_name), ("country", country),
                 ("original_currency", original_currency)):
        if v is not None:
            pairs += [F.lit(k), col(v).cast("string")]
    if not pairs:
        return F.lit(None).cast("map<string,string>")
    entries = [F.when(truthy(pairs[i + 1]), F.struct(pairs[i].alias("key"), pairs[i + 1].alias("value")))
               for i in range(0, len(pairs), 2)]
    kept = F.array_compact(F.array(*entries))
    return F.when(F.size(kept) > 0, F.map_from_entries(kept))


def metadata_text(metadata) -> Column:
    """``k: v`` pairs of truthy values, space separated."""
    kept = F.filter(F.map_entries(col(metadata)), lambda e: truthy(e["value"]))
    return F.array_join(F.transform(kept, lambda e: F.concat(e["key"], F.lit(": "), e["value"])),
                        " ")


def build_info_text(title=None, description=None, category=None, brand=None, size=None,
                    gender=None, price=None, sale=None, other=None, metadata=None) -> Column:
    """One text per product for the text encoder; falls back to title or 'product'."""
    def part(c, prefix=""):
        if c is None:
            return None
        c = col(c)
        return F.when(truthy(c), F.concat(F.lit(prefix), c) if prefix else c)

    parts = [part(title), part(description), part(category), part(brand), part(size, "Size: "),
             part(gender), part(price, "Price: "), part(sale, "Sale: "), part(other)]
    if metadata is not None:
        parts.append(F.when(col(metadata).isNotNull(), metadata_text(metadata)))
    joined = strip(F.concat_ws(" ", *[p for p in parts if p is not None]))
    t = col(title) if title is not None else F.lit(None).cast("string")
    return F.coalesce(F.nullif(joined, F.lit("")), F.when(truthy(t), t), F.lit(K.FALLBACK_INFO_TEXT))


def image_gallery(media_urls=None, image_url=None, additional_images=None):
    """(image_url, additional_images) from a flat media list.

    The media list is stripped, blank-free and first-seen distinct; the main
    image is the given one or the first media URL; additional images are all
    media but the first. Without media the given additional images are kept.
    """
    img = col(image_url) if image_url is not None else F.lit(None).cast("string")
    add = (col(additional_images) if additional_images is not None
           else F.lit(None).cast("array<string>"))
    if media_urls is None:
        return img, F.when(F.size(add) > 0, add)
    media = F.array_distinct(F.filter(F.transform(col(media_urls), lambda x: strip(x)),
                                      lambda x: x.isNotNull() & (x != "")))
    has_media = F.coalesce(F.size(media), F.lit(0)) > 0
    main = F.when(has_media, F.when(truthy(img), img).otherwise(F.try_element_at(media, F.lit(1)))) \
        .otherwise(img)
    extra = F.when(has_media, F.when(F.size(media) > 1, F.slice(media, 2, F.size(media) - 1))) \
        .otherwise(F.when(F.size(add) > 0, add))
    return main, extra


def parse_price_number(text) -> Column:
    """First ``\\d+(.\\d\\d)?`` in the text, as a double."""
    return F.nullif(F.regexp_extract(col(text), r"(\d+(?:\.\d{2})?)", 1), F.lit("")).cast("double")


def minor_units_price(value) -> Column:
    """Embedded ``sizes[0].price`` is in minor units."""
    return col(value).try_cast("double") / 100


# ---------------------------------------------------------------- image URLs


def is_allowed_image_url(url) -> Column:
    u = col(url)
    return truthy(u) & contains_any(u, K.ALLOWED_IMAGE_MARKERS)


def is_embeddable_image_url(url, short_marker: str = K.SHORT_URL_HOST_MARKER,
                            min_length: int = K.SHORT_URL_MIN_LENGTH) -> Column:
    """Reject blank, data:, video and non-image URLs and too-short marked hosts."""
    s = strip(col(url))
    low = F.lower(s)
    too_short = F.coalesce(low.contains(short_marker), F.lit(False)) & (F.length(s) < min_length)
    return (truthy(s) & ~s.startswith("data:")
            & ~contains_any(low, K.VIDEO_MARKERS) & ~contains_any(low, K.NON_IMAGE_EXTENSIONS)
            & ~too_short)


def clean_image_url(url) -> Column:
    """``//x`` -> https, collapse slashes of non-http URLs, first ``{width}`` -> 800."""
    s = strip(col(url))
    s = F.when(s.startswith("//"), F.concat(F.lit("https:"), s)).otherwise(s)
    head = F.substring_index(s, "//", 1)
    rest = s.substr(F.length(head) + 3, F.length(s) + 1)
    collapsed = F.concat(head, F.lit("//"),
                         F.regexp_replace(F.regexp_replace(rest, "/+", "/"), "^/|/$", ""))
    s = F.when(s.contains("//") & ~s.startswith("http"), collapsed).otherwise(s)
    return replace_first(s, "{width}", K.IMAGE_WIDTH)


def pick_image_url(candidates, strict: bool = True) -> Column:
    """First candidate that is non-null and, if text, neither data: nor disallowed."""
    arr = F.array(*[col(c).cast("string") for c in candidates])
    ok = F.filter(arr, lambda x: x.isNotNull() & ~x.startswith("data:") & is_allowed_image_url(x))
    first = F.try_element_at(ok, F.lit(1))
    if strict:
        return first
    return F.coalesce(first, col(candidates[-1]).cast("string"))

"""DuckDB SQL fragments used to write the independent oracle queries.

They restate the operator semantics in plain SQL (CASE, regexp, list
lambdas) so the Spark result can be checked against a second engine.
"""

from __future__ import annotations

from shelfline import constants as K
from shelfline.plans.fixtures import CATEGORY_IDS_ASC, SHOP, SITE


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def truthy(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '')"


def py_or(*xs: str) -> str:
    parts = [f"CASE WHEN {truthy(x)} THEN {x} END" for x in xs[:-1]]
    return f"coalesce({', '.join(parts + [xs[-1]])})"


def contains_any(x: str, needles) -> str:
    return "(" + " OR ".join(f"coalesce(contains({x}, {q(n)}), false)" for n in needles) + ")"


def list_lit(values) -> str:
    return "[" + ", ".join("NULL" if v is None else q(v) for v in values) + "]"


def map_case(x: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {x} {whens} ELSE {q(default)} END)"


def ordered_distinct_list(x: str) -> str:
    return f"list_filter({x}, lambda e, i: list_position({x}, e) = i)"


def format_price_text(s: str, cur: str) -> str:
    """``s`` must already be stripped."""
    num = f"regexp_replace({s}, '[^0-9.,]', '', 'g')"
    n_commas = f"(length({num}) - length(replace({num}, ',', '')))"
    cleaned = (f"(CASE WHEN contains({num}, ',') AND contains({num}, '.') THEN replace({num}, ',', '') "
               f"WHEN {n_commas} = 1 AND length(split_part({num}, ',', 2)) <= 2 "
               f"THEN replace({num}, ',', '.') ELSE replace({num}, ',', '') END)")
    return (f"(CASE WHEN {s} IS NULL THEN NULL "
            f"WHEN regexp_matches({s}, '[A-Z]{{3}}') THEN {s} "
            f"WHEN {truthy(cur)} AND {cleaned} <> '' THEN {cleaned} || {cur} "
            f"ELSE nullif({s}, '') END)")


def gender(g: str) -> str:
    low = f"lower({strip(g)})"
    return (f"(CASE WHEN NOT {truthy(g)} THEN NULL "
            f"WHEN {contains_any(low, K.WOMEN_WORDS)} THEN 'women' "
            f"WHEN {contains_any(low, K.MEN_WORDS)} THEN 'men' ELSE {g} END)")


def category(endpoint: str) -> str:
    cid = f"regexp_extract(coalesce({endpoint}, ''), '/category/(\\d+)/', 1)"
    return map_case(cid, K.CATEGORY_NAMES, K.DEFAULT_CATEGORY)


def size_from_list(lst: str) -> str:
    cleaned = f"list_filter(list_transform({lst}, lambda x: {strip('x')}), lambda x: x IS NOT NULL AND x <> '')"
    joined = f"nullif(array_to_string({ordered_distinct_list(cleaned)}, ', '), '')"
    return f"(CASE WHEN {lst} IS NOT NULL AND len({lst}) > 0 THEN {joined} END)"


def is_allowed_image(x: str) -> str:
    return f"({truthy(x)} AND {contains_any(x, K.ALLOWED_IMAGE_MARKERS)})"


# F1 raw_products, restated in DuckDB SQL over ``part``.
RAW_PRODUCTS = f"""
raw_products AS (
  SELECT p_partkey AS k,
    p_partkey % 24 AS endpoint_pos,
    CAST(floor(p_partkey / 24) AS BIGINT) AS item_pos,
    'src' || CAST(p_partkey % 3 AS VARCHAR) AS source,
    CASE WHEN p_partkey % 50 = 0 THEN NULL
         WHEN p_partkey % 10 = 9 THEN 'P' || CAST(p_partkey - 3 AS VARCHAR)
         ELSE 'P' || CAST(p_partkey AS VARCHAR) END AS external_id,
    CASE WHEN p_partkey % 40 = 1 THEN NULL ELSE p_name END AS title,
    CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '   '
         ELSE '  ' || p_name || ' ' || p_type || ' ' END AS description,
    p_brand AS brand,
    ({list_lit(["WOMAN", "Man", " girls ", "KID", "unisex", "female", "Ornament", "", None])})[p_partkey % 9 + 1] AS gender,
    CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '20USD,450CZK'
         WHEN 2 THEN '$1,' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || '.00'
         WHEN 3 THEN CAST(p_size AS VARCHAR) || ',50 Kc'
         WHEN 4 THEN '1,299' WHEN 5 THEN 'free' ELSE '  39.99 ' END AS price_text,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 'USD' END AS currency,
    CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN string_split('S|M|S', '|')
         WHEN 2 THEN string_split(' L ||XL', '|') ELSE string_split('', '|') END AS size_list,
    CASE WHEN p_partkey % 25 = 24 THEN '{SHOP}/new'
         ELSE '{SHOP}/category/' || CASE WHEN p_partkey % 25 = 23 THEN '999'
              ELSE ({list_lit(CATEGORY_IDS_ASC)})[p_partkey % 24 + 1] END || '/products?ajax=true' END AS endpoint,
    CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE '{SHOP}/p/' || CAST(p_partkey AS VARCHAR) END AS product_url,
    CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE replace(p_name, ' ', '-') END AS seo_keyword,
    ({list_lit([None, "data:image/png;base64,AA", "https://img.example/x-p.jpg", "https://img.example/x-e1.jpg", "//img.example/x-s/w/{width}/y.jpg"])})[p_partkey % 5 + 1] AS image_url
  FROM part)"""

# F1 after apply_site_defaults(SITE): merchant added, country filled,
# external_id falls back to product_url, template attached.
SITE_DEFAULTS = f"""
defaults AS (
  SELECT *, {q(SITE['merchant'])} AS merchant, {q(SITE['country'])} AS country,
    CASE WHEN {truthy('external_id')} THEN external_id ELSE product_url END AS ext_id,
    {q(SITE['product_url_template'])} AS product_url_template
  FROM raw_products)"""

# defaults -> PRODUCT (to_product_row), flattened for comparison.
PRODUCT_ROWS = f"""
prod_base AS (
  SELECT *, {strip('price_text')} AS price_s,
    CASE WHEN {truthy('ext_id')} THEN ext_id END AS ext
  FROM defaults),
products AS (
  SELECT
    CASE WHEN ext IS NOT NULL THEN sha256(source || ':' || ext)
         WHEN {truthy('product_url')} THEN sha256(source || ':' || product_url)
         ELSE 'unknown' END AS id,
    source,
    {py_or('title', "'Unknown title'")} AS title,
    nullif({strip("coalesce(description, '')")}, '') AS description,
    brand, image_url,
    CASE WHEN NOT {truthy('product_url')} AND {truthy('seo_keyword')}
         THEN replace(replace(replace(product_url_template, '{{keyword}}', seo_keyword), '{{id}}', 'None'),
                      '{{discern_id}}', coalesce(ext, ''))
         ELSE product_url END AS product_url,
    false AS second_hand,
    {format_price_text('price_s', 'currency')} AS price,
    CAST(NULL AS VARCHAR) AS sale,
    {gender('gender')} AS gender,
    {category('endpoint')} AS category,
    {size_from_list('size_list')} AS size,
    'merchant_name: ' || merchant || ' country: ' || country AS metadata_text,
    endpoint_pos, item_pos
  FROM prod_base)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# ------------------------------------------------------------ URLs / HTML

ORIGIN_RX = "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"


def origin(p: str) -> str:
    return f"regexp_extract({p}, '{ORIGIN_RX}', 1)"


def directory(p: str) -> str:
    u = f"split_part(split_part({p}, '?', 1), '#', 1)"
    d = f"regexp_extract(substr({u}, length({origin(u)}) + 1), '^(.*/)', 1)"
    return f"({origin(u)} || CASE WHEN {d} = '' THEN '/' ELSE {d} END)"


def resolve_url(h: str, p: str) -> str:
    scheme = f"regexp_extract({p}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)"
    return (f"(CASE WHEN NOT {truthy(h)} THEN {p} "
            f"WHEN regexp_matches({h}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {h} "
            f"WHEN starts_with({h}, '//') THEN {scheme} || ':' || {h} "
            f"WHEN starts_with({h}, '/') THEN {origin(p)} || {h} "
            f"WHEN starts_with({h}, '?') THEN split_part(split_part({p}, '?', 1), '#', 1) || {h} "
            f"WHEN starts_with({h}, '#') THEN split_part({p}, '#', 1) || {h} "
            f"ELSE {directory(p)} || {h} END)")


#: References that the fixtures and the given pages hold besides the first ones.
REFERENCES = ("eacute", "euro", "hellip", "copy", "middot", "nbsp", "lt", "gt", "quot")


def unescape(x: str) -> str:
    import html
    for ref in (*[f"&{n};" for n in REFERENCES], "&#39;", "&#x27;", "&#233;", "&#xE9;", "&#8364;"):
        x = f"replace({x}, {q(ref)}, {q(html.unescape(ref))})"
    return f"replace({x}, '&amp;', '&')"


def markup(x: str) -> str:
    """Without comments, scripts and style sheets."""
    return rf"regexp_replace({x}, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g')"


def tags(x: str, name: str) -> str:
    """Opening tags: what stands between pairs of quotes, up to the first > outside of them."""
    return rf"""regexp_extract_all({markup(x)}, '(?i)<{name}(?:[\s/][^>"'']*(?:"[^"]*"[^>"'']*|''[^'']*''[^>"'']*)*)?>')"""


def node_text(inner: str) -> str:
    stripped = rf"regexp_replace({unescape('x')}, '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g')"
    pieces = f"list_transform(string_split_regex({inner}, '<[^>]*>'), lambda x: {stripped})"
    return f"array_to_string({pieces}, '')"


def attr(tag: str, name: str) -> str:
    """The first name=value of a tag with that name, without its quotes."""
    pairs = rf"""regexp_extract_all({tag}, '[^\s/>=]+\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s>"'']+)')"""
    pair = rf"list_filter({pairs}, lambda y: regexp_matches(y, '(?i)^{name}\s*='))[1]"
    value = rf"regexp_replace({pair}, '^[^=]*=\s*', '')"
    bare = rf"""regexp_replace({value}, '(?s)^"(.*)"$|^''(.*)''$', '\1\2')"""
    return f"nullif({unescape(bare)}, '')"


def is_http(x: str) -> str:
    return f"coalesce(starts_with({x}, 'http'), false)"


def append_flag(u: str) -> str:
    return (f"(CASE WHEN contains({u}, 'ajax=true') THEN {u} "
            f"ELSE {u} || CASE WHEN contains({u}, '?') THEN '&' ELSE '?' END || 'ajax=true' END)")

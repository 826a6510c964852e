"""DuckDB oracle SQL, one string per registered query (same column names)."""

from __future__ import annotations

from shelfline.plans.sqlfrag import (  # noqa: F401
    RAW_PRODUCTS, SITE_DEFAULTS, PRODUCT_ROWS, with_ctes, truthy, strip, q,
)

ORACLE: dict = {}

PRODUCT_COLS = ("id, source, title, description, brand, image_url, product_url, second_hand, "
                "price, sale, gender, category, size, metadata_text")
E1 = with_ctes(RAW_PRODUCTS, SITE_DEFAULTS, PRODUCT_ROWS) + f""",
gated AS (SELECT * FROM products WHERE {truthy('price')}),
catalog AS (SELECT * FROM gated
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY endpoint_pos, item_pos) = 1)
"""

ORACLE["count_by_source"] = E1 + """
SELECT coalesce(source, 'unknown') AS source, count(*) AS n_products FROM catalog GROUP BY 1"""

ORACLE["to_product_row"] = E1 + f"SELECT {PRODUCT_COLS} FROM products"
ORACLE["price_gate"] = E1 + f"SELECT {PRODUCT_COLS} FROM gated"
ORACLE["dedup_first"] = E1 + f"SELECT {PRODUCT_COLS} FROM catalog"

from shelfline import constants as K  # noqa: E402
from shelfline.plans import fixtures as FX  # noqa: E402
from shelfline.plans import sqlfrag as S  # noqa: E402

RAW = with_ctes(RAW_PRODUCTS)
DEF = with_ctes(RAW_PRODUCTS, SITE_DEFAULTS)
PRODK = with_ctes(RAW_PRODUCTS, SITE_DEFAULTS, PRODUCT_ROWS.replace("endpoint_pos, item_pos\n  FROM prod_base", "endpoint_pos, item_pos, k\n  FROM prod_base"))

ORACLE["format_price"] = RAW + f"""
SELECT k, price_text, currency, {S.format_price_text(strip('price_text'), 'currency')} AS price FROM raw_products"""

ORACLE["format_sale"] = RAW + f""",
s1 AS (SELECT k, currency, CASE WHEN k % 2 = 0 THEN price_text END AS sale,
  CASE WHEN k % 3 = 0 THEN '' ELSE ' 9,99 ' END AS sale_price FROM raw_products),
s2 AS (SELECT k, currency, coalesce(CASE WHEN {truthy('sale')} THEN sale END,
  CASE WHEN {truthy('sale_price')} THEN sale_price END) AS picked FROM s1)
SELECT k, CASE WHEN picked IS NOT NULL THEN {S.format_price_text(strip('picked'), 'currency')} END AS sale FROM s2"""

_AV = S.list_lit(["In Stock", " sold out ", "preorder", "AVAILABLE", None, "weird", "out-of-stock", ""])
ORACLE["normalize_availability"] = RAW + f""",
a AS (SELECT k, ({_AV})[k % 8 + 1] AS availability,
  CASE WHEN k % 5 = 0 THEN k % 2 = 0 END AS flag FROM raw_products)
SELECT k, CASE WHEN flag IS NOT NULL THEN CASE WHEN flag THEN 'in_stock' ELSE 'out_of_stock' END
  ELSE {S.map_case(f"lower({strip('availability')})", K.AVAILABILITY, 'unknown')} END AS availability FROM a"""

ORACLE["product_id"] = DEF + f"""
SELECT k, CASE WHEN {truthy('ext_id')} THEN sha256(source || ':' || ext_id)
  WHEN {truthy('product_url')} THEN sha256(source || ':' || product_url) ELSE 'unknown' END AS id
FROM defaults"""

ORACLE["clean_title"] = RAW + f"SELECT k, {S.py_or('title', q(K.DEFAULT_TITLE))} AS title FROM raw_products"
ORACLE["clean_description"] = RAW + f"""
SELECT k, nullif({strip("coalesce(description, '')")}, '') AS description FROM raw_products"""

_MEDIA_C = S.ordered_distinct_list(
    "list_filter(list_transform(media, lambda x: " + strip("x") + "), lambda x: x IS NOT NULL AND x <> '')")
ORACLE["image_gallery"] = RAW + f""",
m AS (SELECT k, image_url, CASE WHEN k % 4 <> 0 THEN [image_url, ' ' || product_url || ' ', image_url, ''] END AS media FROM raw_products),
mc AS (SELECT k, image_url, {_MEDIA_C} AS mc FROM m)
SELECT k,
  CASE WHEN coalesce(len(mc), 0) > 0 THEN CASE WHEN {truthy('image_url')} THEN image_url ELSE mc[1] END ELSE image_url END AS image_url,
  CASE WHEN coalesce(len(mc), 0) > 1 THEN array_to_string(mc[2:], '|') END AS additional_images
FROM mc"""

ORACLE["normalize_gender"] = RAW + f"SELECT k, {S.gender('gender')} AS gender FROM raw_products"
ORACLE["normalize_size"] = RAW + f"""
SELECT k, CASE WHEN k % 4 = 2 THEN 'XL'
  WHEN k % 3 = 0 THEN {S.size_from_list("list_concat(coalesce(size_list, []), [' S ', ''])")}
  WHEN size_list IS NOT NULL THEN {S.size_from_list('size_list')}
  WHEN k % 2 = 0 THEN '36, 38, 40' ELSE '42' END AS size FROM raw_products"""
ORACLE["build_product_url"] = PRODK + "SELECT k, product_url FROM products"
ORACLE["build_metadata"] = PRODK + "SELECT k, metadata_text FROM products"

def _part(x, prefix=""):
    return f"CASE WHEN {truthy(x)} THEN {q(prefix) + ' || ' if prefix else ''}{x} END"

ORACLE["build_info_text"] = PRODK + f"""
SELECT k, coalesce(nullif({strip("concat_ws(' ', " + ', '.join([_part('title'), _part('description'), _part('category'), _part('brand'), _part('size', 'Size: '), _part('gender'), _part('price', 'Price: '), _part('sale', 'Sale: '), 'metadata_text']) + ")")}, ''),
  CASE WHEN {truthy('title')} THEN title END, 'product') AS info_text FROM products"""

ORACLE["category_lookup"] = RAW + f"SELECT k, {S.category('endpoint')} AS category FROM raw_products"

ORACLE["format_for_db"] = DEF + f"""
SELECT sha256(source || ':' || product_url) AS id, source, product_url, image_url, title, brand, gender,
  price_text AS price, false AS second_hand,
  CASE WHEN {truthy('description')} THEN description END AS description, country AS meta_country
FROM defaults
WHERE {truthy('source')} AND {truthy('product_url')} AND {truthy('image_url')} AND {truthy('title')} AND {truthy('price_text')}"""

ORACLE["is_allowed_image_url"] = RAW + f"SELECT k, {S.is_allowed_image('image_url')} AS allowed FROM raw_products"

_CAND = """CASE k % 6 WHEN 0 THEN image_url
  WHEN 1 THEN 'https://static.zara.net/photos/' || CAST(k AS VARCHAR) || '.jpg'
  WHEN 2 THEN 'https://static.zara.net/photos///2024/V/0/1/p/' || lpad(CAST(k AS VARCHAR), 60, '0') || '-e1.jpg?w={width}&h={width}'
  WHEN 3 THEN 'https://cdn.example/v/' || CAST(k AS VARCHAR) || '/video.mp4'
  WHEN 4 THEN 'cdn.example//img//' || CAST(k AS VARCHAR) || '//a.JSON'
  ELSE '  //cdn.example/i/' || CAST(k AS VARCHAR) || '-s.png ' END"""

ORACLE["is_embeddable_image_url"] = RAW + f""",
c AS (SELECT k, {_CAND} AS url FROM raw_products),
s AS (SELECT k, url, {strip('url')} AS s FROM c)
SELECT k, url, ({truthy('s')} AND NOT starts_with(s, 'data:')
  AND NOT {S.contains_any('lower(s)', K.VIDEO_MARKERS)} AND NOT {S.contains_any('lower(s)', K.NON_IMAGE_EXTENSIONS)}
  AND NOT (contains(lower(s), 'zara') AND length(s) < 80)) AS embeddable FROM s"""

ORACLE["clean_image_url"] = RAW + f""",
c AS (SELECT k, {_CAND} AS url FROM raw_products),
s1 AS (SELECT k, {strip('url')} AS s FROM c),
s2 AS (SELECT k, CASE WHEN starts_with(s, '//') THEN 'https:' || s ELSE s END AS s FROM s1),
s3 AS (SELECT k, CASE WHEN contains(s, '//') AND NOT starts_with(s, 'http')
  THEN split_part(s, '//', 1) || '//' || regexp_replace(regexp_replace(substr(s, strpos(s, '//') + 2), '/+', '/', 'g'), '^/|/$', '', 'g')
  ELSE s END AS s FROM s2)
SELECT k, CASE WHEN strpos(s, '{{width}}') > 0 THEN substr(s, 1, strpos(s, '{{width}}') - 1) || '800' || substr(s, strpos(s, '{{width}}') + 7) ELSE s END AS clean_url FROM s3"""

ORACLE["pick_image_url"] = RAW + f""",
c AS (SELECT k, image_url, 'https://img.example/' || CAST(k AS VARCHAR) || CASE WHEN k % 2 = 0 THEN '-s.jpg' ELSE '.jpg' END AS alt_url FROM raw_products)
SELECT k, CASE WHEN image_url IS NOT NULL AND NOT starts_with(image_url, 'data:') AND {S.is_allowed_image('image_url')} THEN image_url
  WHEN {S.is_allowed_image('alt_url')} THEN alt_url END AS picked FROM c"""

ORACLE["required_fields_gate"] = DEF + f"""
SELECT k FROM defaults WHERE {truthy('source')} AND {truthy('product_url')} AND {truthy('image_url')} AND {truthy('title')} AND {truthy('price_text')}"""

ORACLE["limit_per_site"] = PRODK + """
SELECT k, source, id, price FROM products
QUALIFY row_number() OVER (PARTITION BY source ORDER BY endpoint_pos, item_pos) <= 5"""

ORACLE["dedup_stats"] = E1 + """
SELECT count(*) AS input_rows, count(DISTINCT id) AS unique_rows, count(*) - count(DISTINCT id) AS removed FROM gated"""

ORACLE["dedup_last"] = """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

ORACLE["read_products"] = E1 + "SELECT id, title, brand FROM catalog WHERE source = 'src1'"
ORACLE["product_count"] = E1 + "SELECT count(*) AS n_products FROM catalog"
ORACLE["product_count_source"] = E1 + "SELECT count(*) AS n_products FROM catalog WHERE source = 'src2'"
ORACLE["site_totals"] = E1 + "SELECT brand, count(*) AS imported FROM catalog GROUP BY ROLLUP (brand)"
ORACLE["sample_products"] = E1 + """
SELECT id, substring(title, 1, 40) AS title_short, brand FROM catalog ORDER BY id LIMIT 3"""
ORACLE["recent_products"] = """
SELECT o_orderkey AS id, o_orderstatus AS source, CAST(o_orderdate AS VARCHAR) AS created_at
FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey LIMIT 10"""
ORACLE["select_sites"] = """
SELECT DISTINCT p_brand AS brand, lower(replace(p_brand, '#', '-')) AS source FROM part
WHERE lower(p_brand) IN ('brand#13', 'brand#22', 'brand#45')"""
ORACLE["apply_site_defaults"] = DEF + """
SELECT k, merchant, source, country, ext_id AS external_id, product_url_template FROM defaults"""

# ------------------------------------------------------------------ feeds
from shelfline.plans.fixtures import SHOP, CATEGORY_TEMPLATE  # noqa: E402

_GALLERY = S.ordered_distinct_list(f"""list_filter(CASE WHEN k % 3 = 0
  THEN ['https://img.example/' || CAST(k AS VARCHAR) || '-e1.jpg', image_url, 'https://img.example/' || CAST(k AS VARCHAR) || '-s.jpg', image_url]
  ELSE [image_url] END, lambda u: {truthy(strip('u'))})""")
FEEDS = RAW + f""",
fi AS (SELECT *, CAST(floor(item_pos / 50) AS BIGINT) AS page,
  row_number() OVER (PARTITION BY endpoint_pos, endpoint, CAST(floor(item_pos / 50) AS BIGINT) ORDER BY item_pos) - 1 AS doc_pos
  FROM raw_products),
items AS (SELECT * FROM fi),
mapped AS (SELECT endpoint_pos, endpoint, page, doc_pos AS item_pos, external_id, external_id AS product_id,
  title, description, gender,
  CASE k % 8 WHEN 1 THEN 'BIGINT' WHEN 3 THEN 'DECIMAL' WHEN 5 THEN 'OBJECT' WHEN 7 THEN 'ARRAY'
    ELSE CASE WHEN price_text IS NOT NULL THEN 'STRING' END END AS price_kind,
  CASE k % 8 WHEN 1 THEN CAST(k % 30 * 100 + 90 AS VARCHAR) WHEN 3 THEN CAST(k % 40 AS VARCHAR) || '.9'
    WHEN 5 THEN '{{"USD":"20.50","CZK":' || CAST(k AS VARCHAR) || ',"bd":1,"PLN":null,"EUR":"19.0"}}'
    WHEN 7 THEN '[{{"price":"0","amount":"5","currency":"usd"}},{{"price":0,"value":' || CAST(k AS VARCHAR) || '.25,"curr":"czk"}},{{"value":1}}]'
    ELSE price_text END AS price,
  CASE k % 5 WHEN 1 THEN 'BIGINT' WHEN 2 THEN 'STRING' WHEN 3 THEN 'OBJECT' WHEN 4 THEN 'BIGINT' END AS sale_kind,
  CASE k % 5 WHEN 1 THEN '1999' WHEN 2 THEN '9,99' WHEN 3 THEN '{{"EUR":5,"usd":"4.50"}}' WHEN 4 THEN '0' END AS sale_raw,
  CASE k % 7 WHEN 1 THEN 'ARRAY' WHEN 2 THEN 'ARRAY' WHEN 4 THEN 'ARRAY' END AS sizes_kind,
  CASE k % 7 WHEN 1 THEN '["S"," M ","S",4]' WHEN 2 THEN '[["S","M"],["L"," S "],"XL"]' WHEN 4 THEN '[]' END AS sizes_raw,
  CASE WHEN k % 3 = 0 THEN 'ecru|navy' END AS color_names,
  'USD' AS currency, 'w' AS country,
  CASE WHEN image_url IS NOT NULL AND NOT starts_with(image_url, 'data:') AND {S.is_allowed_image('image_url')} THEN image_url END AS image_url,
  nullif(array_to_string({_GALLERY}, '|'), '') AS xmedia_urls,
  seo_keyword, CAST(k AS VARCHAR) AS seo_product_id, CAST(NULL AS VARCHAR) AS product_url, 'Shop' AS brand, k
  FROM items),
usable AS (SELECT * FROM mapped WHERE {truthy('external_id')} AND {truthy('image_url')})
"""

ORACLE["read_feed_items"] = FEEDS + """
SELECT endpoint_pos, endpoint, page, doc_pos AS item_pos, CAST(k AS VARCHAR) AS item_id, title AS name FROM items"""
ORACLE["map_fields"] = FEEDS + """
SELECT endpoint_pos, page, item_pos, external_id, product_id, title, description, gender, price_kind, price, currency, country,
  image_url, xmedia_urls, seo_keyword, seo_product_id, product_url, brand, color_names, sale_kind, sale_raw, sizes_kind, sizes_raw FROM mapped"""
ORACLE["with_provenance"] = FEEDS + """
SELECT endpoint_pos, page, doc_pos AS item_pos, 'api' AS meta_source, endpoint AS meta_endpoint FROM items"""
ORACLE["has_identifier"] = FEEDS + f"""
SELECT endpoint_pos, page, item_pos, external_id FROM mapped WHERE {truthy('external_id')}"""
ORACLE["has_required_image"] = FEEDS + "SELECT endpoint_pos, page, item_pos, external_id, image_url FROM usable"
ORACLE["union_batches"] = FEEDS + "SELECT endpoint_pos, page, item_pos, external_id FROM usable"
ORACLE["ingest_stats"] = FEEDS + f"""
SELECT endpoint, count(*) AS matched, CAST(count_if({truthy('external_id')}) AS BIGINT) AS with_id,
  CAST(count_if({truthy('external_id')} AND {truthy('image_url')}) AS BIGINT) AS with_image FROM mapped GROUP BY endpoint"""
ORACLE["fallback_to_pages"] = FEEDS + """,
good AS (SELECT * FROM usable WHERE endpoint_pos % 4 <> 3),
ok AS (SELECT DISTINCT endpoint_pos, endpoint FROM good),
docs AS (SELECT DISTINCT endpoint_pos, endpoint FROM raw_products),
failing_keys AS (SELECT DISTINCT split_part(endpoint, '?', 1) AS page_key FROM docs d
  WHERE NOT EXISTS (SELECT 1 FROM ok o WHERE o.endpoint_pos = d.endpoint_pos AND o.endpoint = d.endpoint))
SELECT 'feed' AS origin, seo_product_id AS item_id, external_id FROM good
UNION ALL
SELECT 'page' AS origin, CAST(k AS VARCHAR) AS item_id, external_id FROM raw_products
WHERE split_part(endpoint, '?', 1) IN (SELECT page_key FROM failing_keys)"""

_TPL = lambda x: f"replace({q(CATEGORY_TEMPLATE)}, '{{id}}', CAST({x} AS VARCHAR))"
CATDOCS = f"""WITH c AS (SELECT p_partkey AS k, CAST(floor(p_partkey / 50) AS BIGINT) AS doc FROM part),
cp AS (SELECT k, doc, row_number() OVER (PARTITION BY doc ORDER BY k) - 1 AS pos FROM c)"""
ORACLE["category_endpoints"] = CATDOCS + f""",
u AS (SELECT DISTINCT doc, 1 AS branch, CAST(0 AS BIGINT) AS pos, {_TPL('doc + 1000000')} AS url FROM cp WHERE doc % 5 = 4
  UNION ALL SELECT doc, CASE WHEN doc % 5 = 4 THEN 1 ELSE 0 END AS branch, CASE WHEN doc % 5 = 4 THEN pos + 1 ELSE pos END,
  CASE WHEN doc % 5 = 4 THEN {_TPL('k')}
       WHEN k % 3 = 0 THEN '{SHOP}/c/' || CAST(k AS VARCHAR)
       WHEN k % 3 = 1 THEN '{SHOP}/u/' || CAST(k AS VARCHAR)
       ELSE {_TPL('k')} END AS url FROM cp)
SELECT url, doc, branch, pos FROM u
QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc, branch, pos) = 1"""
ORACLE["category_ids_recursive"] = CATDOCS + f""",
w AS (SELECT doc, k, k AS o FROM cp WHERE doc % 5 = 4 OR k % 3 <> 0
  UNION ALL SELECT DISTINCT doc, doc + 1000000, -1 FROM cp WHERE doc % 5 = 4)
SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY o) - 1 AS pos, {_TPL('k')} AS url FROM w"""
ORACLE["resolve_endpoints"] = RAW + f""",
cand AS (SELECT source AS site, 'static' AS kind, 0 AS rk, k AS pos, endpoint AS url FROM raw_products
  UNION ALL SELECT source, 'json', 1, k, '{SHOP}/j/' || CAST(k % 24 AS VARCHAR) FROM raw_products WHERE k % 3 <> 0
  UNION ALL SELECT source, 'html', 2, k, '{SHOP}/h/' || CAST(k % 24 AS VARCHAR) FROM raw_products WHERE k % 3 = 2),
best AS (SELECT site, max(rk) AS rk FROM cand GROUP BY site),
chosen AS (SELECT c.* FROM cand c JOIN best b ON c.site = b.site AND c.rk = b.rk)
SELECT site, kind, url, min(pos) AS pos FROM chosen GROUP BY site, kind, url"""

# ------------------------------------------------------ table maintenance
MAINT = """WITH t AS (SELECT 'P' || CAST(p_partkey AS VARCHAR) AS id, 'src' || CAST(p_partkey % 3 AS VARCHAR) AS source,
    p_name AS title, CAST(p_size AS VARCHAR) || 'USD' AS price, CAST(NULL AS VARCHAR) AS image_url,
    [CAST(p_size AS FLOAT), CAST(p_retailprice AS FLOAT)] AS image_embedding
  FROM part WHERE p_partkey % 4 <> 0),
b AS (SELECT 'P' || CAST(p_partkey AS VARCHAR) AS id, 'src' || CAST(p_partkey % 3 AS VARCHAR) AS source,
    CAST(p_size + 1 AS VARCHAR) || 'USD' AS price, 'https://img.example/' || CAST(p_partkey AS VARCHAR) || '-e1.jpg' AS image_url,
    CASE WHEN p_partkey % 6 <> 0 THEN [CAST(p_size + 1 AS FLOAT), CAST(p_retailprice AS FLOAT)] END AS image_embedding
  FROM part WHERE p_partkey % 2 = 0),
u AS (SELECT * FROM t WHERE id NOT IN (SELECT id FROM b)
  UNION ALL SELECT b.id, b.source, t.title, b.price, b.image_url, b.image_embedding FROM b LEFT JOIN t ON b.id = t.id)
"""
_VEC = ("CASE WHEN image_embedding IS NOT NULL THEN len(image_embedding) END AS emb_dim, "
        "CAST(image_embedding[1] AS DOUBLE) AS emb_first")
ORACLE["upsert_products"] = MAINT + f"SELECT id, source, title, price, image_url, {_VEC} FROM u"
ORACLE["prune_missing"] = MAINT + f"""SELECT id, source, title, price, image_url, {_VEC} FROM u
WHERE source <> 'src1' OR id IN (SELECT id FROM b)"""
ORACLE["pending_embeddings"] = MAINT + """SELECT id, image_url FROM b
WHERE id NOT IN (SELECT id FROM t) AND image_embedding IS NULL"""
ORACLE["align_columns"] = """
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS id, 'src' || CAST(p_partkey % 3 AS VARCHAR) AS source,
  CAST(p_size + 1 AS VARCHAR) || 'USD' AS price, CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS image_url
FROM part WHERE p_partkey % 2 = 0
UNION ALL
SELECT 'P' || CAST(p_partkey AS VARCHAR), NULL, NULL, p_name, 'https://img.example/' || CAST(p_partkey AS VARCHAR) || '-s.jpg'
FROM part WHERE p_partkey % 2 = 1"""
ORACLE["reset_vector_column"] = """
SELECT vec_id, label, true AS reset, CASE WHEN len(embedding) = 64 THEN 64 END AS kept_width FROM embeddings"""

# -------------------------------------------------------------- page jobs
from shelfline.plans.queries import SCAN_PATTERN, HTML_TEMPLATE, HTML_ID_REGEX  # noqa: E402


def _rx(r: str) -> str:
    return q(r)


AWKWARD = f"""ap AS (SELECT page_id, url, {q(FX.AWKWARD_HEAD)} || CASE WHEN page_id % 3 = 0 THEN replace(replace(h, '<h1>', '<H1 CLASS=top>'), '</h1>', '</H1 >') ELSE h END
  || replace({q(FX.AWKWARD_BODY)}, '{{k}}', CAST(page_id AS VARCHAR)) AS html
  FROM (SELECT page_id, url, replace(html, '</title>', {q(FX.AWKWARD_TITLE + "</title>")}) AS h FROM pages))"""

_TITLE, _H1 = (f"regexp_extract({S.markup('html')}, '(?is)<{t}[^>]*>(.*?)</{t}\\s*>', 1)" for t in ("title", "h1"))
_IMAGE = f"list_filter(list_transform({S.tags('html', 'img')}, lambda t: {S.attr('t', 'src')}), lambda x: x IS NOT NULL)[1]"
ORACLE["page_fields"] = f"""WITH {AWKWARD}, f AS (
SELECT page_id, url, coalesce({S.node_text(_TITLE)}, '') AS title, coalesce({S.node_text(_H1)}, '') AS description, '' AS price, {_IMAGE} AS img FROM ap)
SELECT page_id, url, title, description, price, CASE WHEN {S.is_allowed_image('img')} THEN img ELSE '' END AS image_url FROM f"""

ANCHORS = f"""WITH {AWKWARD}, tags AS (SELECT page_id, url, html, unnest({S.tags('html', 'a')}) AS tag,
  generate_subscripts({S.tags('html', 'a')}, 1) - 1 AS pos FROM ap),
h AS (SELECT page_id, url, pos, coalesce({S.attr('tag', 'href')}, {S.attr('tag', 'data-href')}, {S.attr('tag', 'data-url')}) AS href,
  {S.attr('tag', 'href')} AS href_only FROM tags),
links AS (SELECT page_id, pos, {S.resolve_url('href', 'url')} AS link FROM h
  WHERE href IS NOT NULL AND {S.is_http(S.resolve_url('href', 'url'))})
"""
ORACLE["page_links"] = ANCHORS + "SELECT page_id, pos, link FROM links"
ORACLE["resolve_url"] = ANCHORS + f"SELECT page_id, pos, href_only AS href, {S.resolve_url('href_only', 'url')} AS resolved FROM h"
ORACLE["ordered_distinct"] = ANCHORS + """SELECT link, page_id, pos FROM links
QUALIFY row_number() OVER (PARTITION BY link ORDER BY page_id, pos) = 1"""

_QUOTED = r"""regexp_extract_all(html, '(?i:data-href|data-url|href)\s*=\s*(?:"[^"]*"|''[^'']*'')')"""
_VALUES = rf"""list_filter(list_transform({_QUOTED}, lambda x: regexp_replace(regexp_replace(x, '^[^=]*=\s*.', ''), '.$', '')), lambda x: regexp_matches(x, '{SCAN_PATTERN}'))"""
_TEXT_RX = f"""https?://[^\\s"']*{SCAN_PATTERN}[^\\s"']*"""
SCAN = f"""scan_a AS (SELECT page_id, url, unnest({_VALUES}) AS u, generate_subscripts({_VALUES}, 1) - 1 AS pos FROM ap),
scan_t AS (SELECT page_id, unnest(regexp_extract_all(html, {q(_TEXT_RX)}, 0)) AS link,
  generate_subscripts(regexp_extract_all(html, {q(_TEXT_RX)}, 0), 1) - 1 AS pos FROM ap),
scan AS (SELECT page_id, 0 AS branch, pos, {S.resolve_url('u', 'url')} AS link FROM scan_a
  UNION ALL SELECT page_id, 1 AS branch, pos, link FROM scan_t)
"""
ORACLE["product_url_scan"] = f"WITH {AWKWARD}, " + SCAN + "SELECT page_id, branch, pos, link FROM scan"
ORACLE["category_links"] = ANCHORS + "," + SCAN + f""",
ld AS (SELECT page_id, 0 AS pos, {S.resolve_url("'/ld/' || CAST(page_id AS VARCHAR) || '?a=1&b=2'", 'url')} AS link FROM ap
  UNION ALL SELECT page_id, 1 AS pos, 'https://other.example/L/' || CAST(page_id AS VARCHAR) AS link FROM ap),
allp AS (SELECT page_id, 0 AS src, 0 AS branch, pos, link FROM links
  UNION ALL SELECT page_id, 1 AS src, 0 AS branch, pos, link FROM ld
  UNION ALL SELECT page_id, 2 AS src, branch, pos, link FROM scan)
SELECT page_id, link, src, branch, pos FROM allp
QUALIFY row_number() OVER (PARTITION BY page_id, link ORDER BY src, branch, pos) = 1"""


def _cid(u: str) -> str:
    return (f"coalesce(nullif(regexp_extract(split_part({u}, '#', 1), '[?&]page=([^&#]*)', 1), ''), "
            f"nullif(regexp_extract({u}, {q(HTML_ID_REGEX)}, 1), ''))")


_IDS = " || ".join(f"regexp_extract_all(html, {q(rx)}, 1)" for rx in K.HTML_CATEGORY_ID_PATTERNS)
ORACLE["html_endpoints"] = ANCHORS + f""",
ids AS (SELECT page_id, 0 AS src, unnest({_IDS}) AS cid, generate_subscripts({_IDS}, 1) - 1 AS pos FROM ap
  UNION ALL SELECT page_id, 1 AS src, {_cid('url')} AS cid, 0 AS pos FROM ap
  UNION ALL SELECT page_id, 2 AS src, {_cid('href_only')} AS cid, pos FROM h WHERE href_only IS NOT NULL),
e AS (SELECT page_id, src, CAST(pos AS BIGINT) AS pos, replace({q(HTML_TEMPLATE)}, '{{category_id}}', cid) AS u FROM ids WHERE cid IS NOT NULL),
f AS (SELECT page_id, src, pos, CASE WHEN src = 1 THEN u ELSE {S.append_flag('u')} END AS endpoint FROM e)
SELECT endpoint, page_id, src, pos FROM f WHERE starts_with(endpoint, 'http')
QUALIFY row_number() OVER (PARTITION BY endpoint ORDER BY page_id, src, pos) = 1"""

ORACLE["append_query_flag"] = f"SELECT page_id, {S.append_flag('url')} AS endpoint FROM pages"
ORACLE["url_contains_any"] = """SELECT page_id, url FROM pages
WHERE coalesce(contains(url, '/en/'), false) OR coalesce(contains(url, '.html'), false)"""
ORACLE["take_until_empty_page"] = """WITH c AS (SELECT page_id, regexp_extract(url, '://([^/?#]+)', 1) AS site,
  page_id % 12 AS page, len(regexp_extract_all(html, 'href="/[A-Z]', 0)) AS n_items FROM pages),
s AS (SELECT site, min(page) AS stop FROM c WHERE n_items = 0 GROUP BY site)
SELECT c.page_id, c.site, c.page, c.n_items FROM c LEFT JOIN s ON c.site = s.site
WHERE s.stop IS NULL OR c.page < s.stop"""

ORACLE["parse_price_number"] = """SELECT doc_id,
  CAST(nullif(regexp_extract(text, '(\\d+(?:\\.\\d{2})?)', 1), '') AS DOUBLE) AS price FROM documents"""

# Card pages restated from part (no HTML detour).
CARDS = f"""WITH c AS (SELECT p_partkey AS k, CAST(floor(p_partkey / 20) AS BIGINT) AS page_id,
  row_number() OVER (PARTITION BY CAST(floor(p_partkey / 20) AS BIGINT) ORDER BY p_partkey) - 1 AS card_pos,
  p_name, p_type, CAST(p_retailprice * 100 AS BIGINT) AS cents FROM part),
cards AS (SELECT page_id, card_pos, k, p_name, p_type, cents,
  CASE k % 5 WHEN 0 THEN CAST(k AS VARCHAR) WHEN 1 THEN 'plp-productCard-Wishlist-' || CAST(k AS VARCHAR)
    WHEN 2 THEN 'handle-' || CAST(k AS VARCHAR) ELSE CAST(k AS VARCHAR) END AS card_id,
  '{SHOP}/products/handle-' || CAST(k AS VARCHAR) || '?v=1' AS product_url,
  CASE WHEN k % 7 = 0 THEN NULL WHEN k % 7 = 1 THEN '{SHOP}/cards/assets/' || CAST(k AS VARCHAR) || '-s.jpg'
    ELSE 'https://img.example/' || CAST(k AS VARCHAR) || '-e1.jpg' END AS image_url,
  CASE WHEN k % 13 <> 0 THEN CAST(CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS DOUBLE) END AS price,
  nullif(CASE WHEN k % 9 = 0 THEN '' ELSE p_name END || CASE WHEN k % 11 <> 0 THEN '' WHEN k % 9 = 0 THEN 'Café €' ELSE ' Café €' END, '') AS title,
  CASE WHEN k % 14 = 0 THEN 'https://img.example/' || CAST(k AS VARCHAR) || '-e1.jpg' END AS emb_image,
  k % 5 IN (0, 3, 4) AS has_match FROM c),
matched AS (SELECT page_id, card_pos, k, card_id, product_url, coalesce(title, CASE WHEN has_match THEN 'Emb ' || p_name END) AS title,
  CASE WHEN has_match THEN p_type END AS description, coalesce(price, CASE WHEN has_match THEN cents / 100.0::DOUBLE END) AS price,
  coalesce(image_url, CASE WHEN has_match THEN emb_image END) AS image_url FROM cards)
"""
ORACLE["extract_cards"] = CARDS + """SELECT page_id, card_pos, card_id, product_url, image_url, price,
  coalesce(title, 'Product ' || card_id) AS title FROM cards WHERE image_url IS NOT NULL"""
ORACLE["embedded_products"] = CARDS + """SELECT page_id, k % 7 AS spos, row_number() OVER (PARTITION BY page_id, k % 7 ORDER BY k) - 1 AS ppos,
  CAST(k AS VARCHAR) AS product_id, 'Emb ' || p_name AS title, p_type AS description,
  CAST(CAST(cents AS DOUBLE) / 100 AS VARCHAR) AS price, emb_image AS image_url FROM cards"""
ORACLE["match_cards_to_embedded"] = CARDS + """SELECT page_id, card_pos, card_id, title, description, price, image_url
FROM matched WHERE image_url IS NOT NULL"""

CARD_INPUTS = f"""WITH ci AS (SELECT p_partkey AS k,
  CASE p_partkey % 4 WHEN 0 THEN '{SHOP}/products/handle-' || CAST(p_partkey AS VARCHAR) || '?v=1'
    WHEN 1 THEN '{SHOP}/a/products/x/products/h' || CAST(p_partkey AS VARCHAR) || '/more'
    WHEN 2 THEN '{SHOP}/products/' ELSE '{SHOP}/item/' || CAST(p_partkey AS VARCHAR) END AS url,
  CASE p_partkey % 3 WHEN 0 THEN 'plp-productCard-' || CAST(p_partkey AS VARCHAR) || '-select'
    WHEN 1 THEN 'plp-productCard-Wishlist-' || CAST(p_partkey AS VARCHAR) ELSE 'tile-' || CAST(p_partkey AS VARCHAR) END AS testid,
  CASE p_partkey % 6 WHEN 0 THEN '//cdn.example/' || CAST(p_partkey AS VARCHAR) || '-e1.jpg'
    WHEN 1 THEN '/img/' || CAST(p_partkey AS VARCHAR) || '-s.jpg'
    WHEN 2 THEN 'assets/' || CAST(p_partkey AS VARCHAR) || '-ult21.jpg'
    WHEN 3 THEN 'https://cdn.example/' || CAST(p_partkey AS VARCHAR) || '.jpg'
    WHEN 4 THEN 'img/' || CAST(p_partkey AS VARCHAR) || '-e1.jpg'
    ELSE '/x/' || CAST(p_partkey AS VARCHAR) || '-s.png' END AS src,
  CASE p_partkey % 3 WHEN 0 THEN 'https://www.shop.example/cz/en/women/dresses'
    WHEN 1 THEN 'https://www.shop.example/en_us/list' ELSE 'https://www.shop.example/c/list' END AS page_url
  FROM part)
"""
_HANDLE = "split_part(split_part(string_split(url, '/products/')[-1], '?', 1), '/', 1)"
ORACLE["product_handle"] = CARD_INPUTS + f"""SELECT k, CASE WHEN contains(url, '/products/') THEN nullif({_HANDLE}, '') END AS handle FROM ci"""
ORACLE["card_product_id"] = CARD_INPUTS + """SELECT k, CASE WHEN contains(testid, 'productCard') AND NOT contains(testid, 'Wishlist')
  THEN coalesce(nullif(regexp_extract(testid, 'productCard-(\\d+)', 1), ''), testid) ELSE testid END AS card_id FROM ci"""
_BASE = ("CASE WHEN contains(page_url, '/cz/en/') THEN split_part(page_url, '/cz/en/', 1) "
         "WHEN contains(page_url, '/en_us/') THEN split_part(page_url, '/en_us/', 1) "
         "ELSE regexp_extract(page_url, '^(.*)/', 1) END")
ORACLE["absolutize_image_url"] = CARD_INPUTS + f""", a AS (SELECT k, CASE WHEN starts_with(src, '//') THEN 'https:' || src
  WHEN starts_with(src, '/') THEN {S.origin(_BASE)} || src
  WHEN starts_with(src, 'assets/') THEN ({_BASE}) || '/' || src
  WHEN starts_with(src, 'http') THEN src ELSE '' END AS full_url FROM ci)
SELECT k, CASE WHEN {S.is_allowed_image('full_url')} THEN full_url ELSE '' END AS image_url FROM a"""

# The BFS result restated from the fixture's structure: pages and image locs of
# the leaves at depth 2 (root -> index -> leaf), one page per host two levels
# below its first leaf; the malformed document contributes nothing.
ORACLE["expand_sitemaps"] = """WITH p AS (SELECT page_id, url, regexp_extract(url, '://([^/?#]+)', 1) AS host,
  CAST(floor(page_id / 50) AS BIGINT) AS leaf_no FROM pages),
leaves AS (SELECT DISTINCT host, leaf_no, CAST(floor(leaf_no / 50) AS BIGINT) * 2 + length(host) % 2 AS ix FROM p),
leaf_pos AS (SELECT host, leaf_no, ix, dense_rank() OVER (ORDER BY ix) - 1 AS rpos,
  row_number() OVER (PARTITION BY ix ORDER BY host, leaf_no) - 1 AS lpos FROM leaves),
pp AS (SELECT p.*, row_number() OVER (PARTITION BY host, leaf_no ORDER BY page_id) - 1 AS i,
  coalesce(sum(CASE WHEN page_id % 10 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY host, leaf_no ORDER BY page_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS imgs_before FROM p),
res AS (SELECT url, [0, rpos, lpos, i + imgs_before] AS ord FROM pp JOIN leaf_pos USING (host, leaf_no)
  UNION ALL SELECT 'https://' || host || '/img/' || CAST(page_id AS VARCHAR) || '.jpg', [0, rpos, lpos, i + imgs_before + 1]
  FROM pp JOIN leaf_pos USING (host, leaf_no) WHERE page_id % 10 = 0),
ends AS (SELECT host, leaf_no, count(*) + sum((page_id % 10 = 0)::INT) AS n FROM pp GROUP BY host, leaf_no
  QUALIFY leaf_no = min(leaf_no) OVER (PARTITION BY host)),
deep AS (SELECT 'https://' || host || '/reached' AS url, [0, rpos, lpos, n, 0, 0] AS ord FROM ends JOIN leaf_pos USING (host, leaf_no))
SELECT url, 2 AS depth, array_to_string(min(ord), '.') AS ord FROM res GROUP BY url
UNION ALL SELECT url, 4, array_to_string(ord, '.') FROM deep"""

# ----------------------------------------------------------------- vectors
ORACLE["valid_vectors"] = """WITH b AS (SELECT vec_id, CASE WHEN vec_id % 50 = 0 THEN NULL
  WHEN vec_id % 50 = 1 THEN CAST([] AS FLOAT[]) WHEN vec_id % 50 = 2 THEN embedding[1:63] ELSE embedding END AS v FROM embeddings)
SELECT vec_id, CASE WHEN v IS NOT NULL AND len(v) = 64 THEN 64 END AS dim FROM b"""
ORACLE["cosine_topk"] = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
c AS (SELECT label, i, avg(x) AS m FROM x GROUP BY label, i),
qs AS (SELECT CAST(label AS BIGINT) AS query_id, list(m ORDER BY i) AS qv FROM c GROUP BY label),
s AS (SELECT qs.query_id, e.vec_id, list_cosine_similarity(qs.qv, e.v) AS score FROM qs CROSS JOIN e),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, vec_id, round(score, 5) AS score, rank FROM r WHERE rank <= 5"""

ORACLE["ivf_topk"] = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
c AS (SELECT label, i, avg(x) AS m FROM x GROUP BY label, i),
qs AS (SELECT CAST(label AS BIGINT) AS query_id, list(m ORDER BY i) AS qv FROM c GROUP BY label),
cell AS (SELECT e.vec_id, e.v, qs.query_id AS cell FROM e, qs
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_cosine_similarity(qs.qv, e.v) DESC, qs.query_id) = 1),
probe AS (SELECT a.query_id, a.qv, b.query_id AS cell FROM qs a, qs b
  QUALIFY row_number() OVER (PARTITION BY a.query_id ORDER BY list_cosine_similarity(a.qv, b.qv) DESC, b.query_id) <= 4),
s AS (SELECT query_id, vec_id, list_cosine_similarity(qv, v) AS score FROM probe JOIN cell USING (cell)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, vec_id, round(score, 5) AS score, rank FROM r WHERE rank <= 5"""
ORACLE["embed_column"] = "SELECT doc_id, " + ", ".join(
    f"CASE WHEN trim(text) <> '' THEN CAST(length(text) - length(replace(text, '{c}', '')) AS DOUBLE) END AS {c}" for c in "aeio") + " FROM documents"

ORACLE["embed_image_bytes"] = "SELECT page_id, " + ", ".join(
    f"CASE WHEN html <> '' AND page_id % 13 > 2 THEN CAST({x} AS DOUBLE) END AS {c}" for c, x in (
        ("n_bytes", "strlen(html)"), ("n_lt", "length(html) - length(replace(html, '<', ''))"),
        ("n_e", "length(html) - length(replace(html, 'e', ''))"), ("n_lf", "length(html) - length(replace(html, chr(10), ''))"))) + " FROM pages"

# --------------------------------------------------------------- streaming
ORACLE["stream_upsert"] = """SELECT user_id, event_id, ts, event_type,
  CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

# Four arrivals, ranges of event_id: the first arrival of a user, its last row, no value.
ORACLE["stream_pending_embeddings"] = """WITH e AS (SELECT *, CAST(floor(event_id * 4 / (SELECT max(event_id) + 1 FROM events)) AS BIGINT) AS epoch FROM events),
l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY epoch, ts DESC, event_id DESC) = 1)
SELECT user_id, event_id, epoch FROM l WHERE event_id % 5 = 0 OR value IS NULL"""

# ------------------------------------------------------------- E1 pipeline
_TEMPLATE = S.SITE["product_url_template"]

# Polymorphic numbers restated (Python float printing: shortest repr, '.0' dropped).
_F = lambda x: f"regexp_replace(CAST(CAST({x} AS DOUBLE) AS VARCHAR), '\\.0$', '')"


def feed_price(cur: str = "'USD'") -> str:
    """The price of a mapped feed row, by its JSON kind."""
    return f"""(CASE k % 8
  WHEN 1 THEN {_F('CASE WHEN k % 30 * 100 + 90 >= 1000 THEN (k % 30 * 100 + 90) / 100.0 ELSE k % 30 * 100 + 90 END')} || {cur}
  WHEN 3 THEN {_F('k % 40 + 0.9')} || {cur}
  WHEN 5 THEN '20.50USD,' || CAST(k AS VARCHAR) || 'CZK,19EUR'
  WHEN 7 THEN '0USD,' || CAST(k AS VARCHAR) || '.25CZK'
  ELSE {S.format_price_text(strip('price'), cur)} END)"""


FEED_SALE = "(CASE k % 5 WHEN 1 THEN '19.99USD' WHEN 2 THEN '9.99USD' WHEN 3 THEN '5EUR,4.50USD' END)"
FEED_SIZE = "(CASE k % 7 WHEN 1 THEN 'S, M' WHEN 2 THEN 'S, M, L, XL' WHEN 3 THEN 'One size' WHEN 4 THEN '38, 40' END)"


def feed_products_ctes(source: str) -> str:
    """CTEs fp, prod, feed_products over the FEEDS chain for a site source."""
    return f""",
fp AS (SELECT * FROM usable),
prod AS (SELECT sha256({q(source + ':')} || external_id) AS id, {q(source)} AS source,
  {S.py_or('title', q(K.DEFAULT_TITLE))} AS title,
  nullif({strip("coalesce(description, '')")}, '') AS description, 'Shop' AS brand, image_url,
  CASE WHEN {truthy('seo_keyword')} THEN replace(replace(replace({q(_TEMPLATE)}, '{{keyword}}', seo_keyword),
    '{{id}}', seo_product_id), '{{discern_id}}', external_id) END AS product_url,
  false AS second_hand, {feed_price()} AS price, {FEED_SALE} AS sale,
  {S.gender('gender')} AS gender, {S.category('endpoint')} AS category, {FEED_SIZE} AS size,
  'merchant_name: Shop country: w' AS metadata_text, endpoint_pos, endpoint, page, item_pos FROM fp),
feed_products AS (SELECT * FROM prod WHERE {truthy('price')}
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY endpoint_pos, endpoint, page, item_pos) = 1)
"""


ORACLE["feed_run"] = FEEDS + feed_products_ctes(K.DEFAULT_SITE_SOURCE) + f"SELECT {PRODUCT_COLS} FROM feed_products"

# Polymorphic prices restated from part.
ORACLE["format_price_variants"] = f"""WITH p AS (SELECT p_partkey AS k, p_size, p_retailprice,
  p_size * 100 + p_partkey % 100 AS minor, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 'USD' END AS cur FROM part)
SELECT k, CASE k % 5
  WHEN 0 THEN CASE WHEN cur IS NOT NULL THEN {_F('CASE WHEN minor >= 1000 THEN minor / 100.0 ELSE minor END')} || cur END
  WHEN 1 THEN CASE WHEN cur IS NOT NULL THEN {_F('p_retailprice')} || cur END
  WHEN 2 THEN {_F('p_size')} || 'USD,' || {_F('p_retailprice')} || 'CZK,' || CAST(p_size AS VARCHAR) || '.50EUR,7GBP'
  WHEN 3 THEN CASE WHEN p_size <> 0 THEN {_F('p_size')} || 'USD,' ELSE '' END || CAST(k % 7 AS VARCHAR) || 'CZK,0EUR'
  ELSE CASE WHEN cur IS NOT NULL THEN CAST(p_size AS VARCHAR) || '.5' || cur ELSE CAST(p_size AS VARCHAR) || ',5' END
  END AS price FROM p"""

ORACLE["dedup_first_url_key"] = PRODK + f"""SELECT source || ':' || coalesce(product_url, 'None') AS url_key, k, id
FROM products WHERE {truthy('price')}
QUALIFY row_number() OVER (PARTITION BY source || ':' || coalesce(product_url, 'None') ORDER BY endpoint_pos, item_pos) = 1"""


# The F1 catalog, then a src1 feed run upserted with sync: src1 keeps only the run's rows.
_E1_HEAD = with_ctes(RAW_PRODUCTS, SITE_DEFAULTS, PRODUCT_ROWS)
_E1_TAIL = E1[len(_E1_HEAD):]
_FEEDS_TAIL = FEEDS[len(RAW):]
ORACLE["feed_run_sync"] = (_E1_HEAD + _E1_TAIL.rstrip() + _FEEDS_TAIL.rstrip() + feed_products_ctes("src1")
                           + f"SELECT {PRODUCT_COLS} FROM catalog WHERE source <> 'src1' "
                           + f"UNION ALL SELECT {PRODUCT_COLS} FROM feed_products")

ORACLE["stream_feed_run"] = FEEDS + feed_products_ctes(K.DEFAULT_SITE_SOURCE) + f"""
SELECT {PRODUCT_COLS} FROM prod WHERE {truthy('price')}
QUALIFY row_number() OVER (PARTITION BY id ORDER BY floor(endpoint_pos * 4 / (SELECT max(endpoint_pos) + 1 FROM mapped)) DESC,
  endpoint_pos, endpoint, page, item_pos) = 1"""

ORACLE["jsonld_urls"] = CARDS + f"""SELECT page_id, card_pos AS pos,
  '{SHOP}/products/handle-' || CAST(k AS VARCHAR) || '?a=1&b=2' AS link FROM cards"""

_SYNC = (_E1_HEAD + _E1_TAIL.rstrip() + _FEEDS_TAIL.rstrip() + feed_products_ctes("src1"))
ORACLE["read_products_table"] = _SYNC + "SELECT id, title, brand FROM catalog WHERE source = 'src2'"
ORACLE["recent_products_table"] = _SYNC + """,
stamped AS (SELECT id, title, CASE WHEN id IN (SELECT id FROM catalog) THEN '2024-01-01 00:00:00'
  ELSE '2024-02-01 00:00:00' END AS created_at FROM feed_products)
SELECT id, title, created_at FROM stamped ORDER BY created_at DESC, id LIMIT 10"""

ORACLE["format_sale_variants"] = f"""WITH p AS (SELECT p_partkey AS k, p_size,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 'USD' END AS cur FROM part)
SELECT k, CASE
  WHEN k % 6 = 2 THEN {_F('p_size')} || 'EUR'
  WHEN k % 6 = 4 AND p_size <> 0 THEN CASE WHEN cur IS NOT NULL THEN
    {_F('CASE WHEN p_size * 100 >= 1000 THEN p_size * 100 / 100.0 ELSE p_size * 100 END')} || cur END
  WHEN k % 4 = 0 THEN CASE WHEN cur IS NOT NULL THEN CAST(p_size AS VARCHAR) || '.99' || cur
    ELSE CAST(p_size AS VARCHAR) || ',99' END
  ELSE CASE WHEN p_size <> 0 THEN {_F('p_size')} || 'CZK' END
  END AS sale FROM p"""

def _page_rows(source_cte: str, external_id: str, price: str, description: str, order: str) -> str:
    return f""",
rows AS (SELECT sha256('{K.DEFAULT_SITE_SOURCE}:' || {external_id}) AS id, '{K.DEFAULT_SITE_SOURCE}' AS source, title, {description} AS description,
  CAST(NULL AS VARCHAR) AS brand, image_url, product_url, false AS second_hand, {price} AS price, CAST(NULL AS VARCHAR) AS sale,
  CAST(NULL AS VARCHAR) AS gender, 'clothing' AS category, CAST(NULL AS VARCHAR) AS size,
  'merchant_name: Shop country: us' AS metadata_text, {order} AS place FROM {source_cte})
SELECT {PRODUCT_COLS} FROM rows WHERE price IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY place) = 1"""


ORACLE["page_run"] = CARDS + """,
titled AS (SELECT * REPLACE (coalesce(title, 'Product ' || card_id) AS title) FROM matched WHERE image_url IS NOT NULL)""" + _page_rows(
    "titled", "card_id", f"{_F('price')} || 'USD'", "description", "[page_id, card_pos]")
ORACLE["page_run_links"] = f"""WITH pp AS (SELECT p_partkey AS k, p_name AS title, '{SHOP}/products/handle-' || CAST(p_partkey AS VARCHAR) || '?v=1' AS product_url,
  CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_size AS VARCHAR) || ',50' END AS price_text,
  'https://img.example/' || CAST(p_partkey AS VARCHAR) || '-e1.jpg' AS image_url FROM part)""" + _page_rows(
    "pp", "product_url", "price_text", "CAST(NULL AS VARCHAR)", "[k]")

ORACLE["run_sites"] = FEEDS + f""",
with_site AS (SELECT *, 'Brand#' || CAST(endpoint_pos % 5 + 1 AS VARCHAR) AS site FROM usable),
chosen AS (SELECT * FROM with_site WHERE lower(site) IN ('brand#1', 'brand#3', 'brand#5')
  AND site IN (SELECT p_brand FROM part)),
limited AS (SELECT * FROM chosen QUALIFY row_number() OVER (PARTITION BY site ORDER BY endpoint_pos, endpoint, page, item_pos) <= 3),
priced AS (SELECT site, sha256(lower(replace(site, '#', '-')) || ':' || external_id) AS id,
  {feed_price()} AS price, endpoint_pos, endpoint, page, item_pos FROM limited),
firsts AS (SELECT * FROM priced WHERE {truthy('price')}
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY site, endpoint_pos, endpoint, page, item_pos) = 1)
SELECT site, count(*) AS imported FROM firsts GROUP BY ROLLUP (site)"""

ORACLE["ivf_topk_all_cells"] = ORACLE["cosine_topk"]

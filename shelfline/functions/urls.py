"""URL column helpers: joining hrefs to page URLs, ids out of URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline.functions.text import col, truthy
from shelfline.functions.normalize import is_allowed_image_url

ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"


def origin(url) -> Column:
    """``scheme://host[:port]`` of an absolute URL ('' when not absolute)."""
    return F.regexp_extract(col(url), ORIGIN, 1)


def without_query(url) -> Column:
    """The URL before its first ``?`` (the page key of a feed endpoint)."""
    return F.substring_index(col(url), "?", 1)


def without_fragment(url) -> Column:
    return F.substring_index(col(url), "#", 1)


def directory(url) -> Column:
    """Base for relative hrefs: the page URL up to its last ``/`` in the path."""
    u = without_fragment(without_query(url))
    org = origin(u)
    path = u.substr(F.length(org) + 1, F.length(u) + 1)
    dir_path = F.regexp_extract(path, r"^(.*/)", 1)
    return F.concat(org, F.when(dir_path == "", F.lit("/")).otherwise(dir_path))


def remove_dot_segments(url) -> Column:
    """Collapse ``.`` and ``..`` path segments of an absolute URL (RFC 3986).

    Only URLs whose path has dot segments are touched; the path is folded
    segment by segment into a stack (``..`` pops, never above the root).
    """
    u = col(url)
    org = origin(u)
    rest = u.substr(F.length(org) + 1, F.length(u) + 1)
    path = F.regexp_extract(rest, r"^([^?#]*)", 1)
    tail = rest.substr(F.length(path) + 1, F.length(rest) + 1)
    padded = F.regexp_replace(path, r"/(\.\.?)$", "/$1/")
    stack = F.aggregate(
        F.split(padded, "/"), F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(s))))
    has_dots = path.rlike(r"(^|/)\.\.?(/|$)")
    return F.when((org != "") & has_dots, F.concat(org, F.array_join(stack, "/"), tail)).otherwise(u)


def resolve_url(href, page_url) -> Column:
    """``urljoin(page_url, href)`` for absolute, ``//``, ``/root``, ``?``, ``#`` and
    relative hrefs, with ``.``/``..`` segments of the href collapsed (page
    URLs are taken as already normalised). The dot test is a few plain
    string checks on the short href, so hrefs without dot segments skip
    that step entirely."""
    joined = _join(href, page_url)
    only_dotted = F.when(has_dot_segments(href), joined)  # NULL short-circuits the fold
    return F.coalesce(remove_dot_segments(only_dotted), joined)


def has_dot_segments(href) -> Column:
    """Plain string checks: can this href carry ``.``/``..`` segments?"""
    h = col(href)
    return F.coalesce(h.contains("./") | h.endswith("/.") | h.endswith("/..") | (h == ".") | (h == ".."),
                      F.lit(False))


def join_url(href, page_url) -> Column:
    """``resolve_url`` without the dot-segment step (pair with ``finish_dot_segments``)."""
    return _join(href, page_url)


def finish_dot_segments(df, column: str, flag: str):
    """Collapse dot segments of ``column`` on rows where ``flag`` is set, in a
    projection of its own over the already computed column."""
    # The fold sees NULL on unflagged rows and returns at once. It is not
    # compiled code, so run this on a narrow frame (it copies its input row).
    only_flagged = F.when(F.col(flag), F.col(column))
    fixed = F.coalesce(remove_dot_segments(only_flagged), F.col(column))
    return df.withColumn(column, fixed).drop(flag)


def _join(href, page_url) -> Column:
    h, p = col(href), col(page_url)
    scheme = F.regexp_extract(p, SCHEME, 1)
    return (
        F.when(~truthy(h), p)
        .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), F.concat(origin(p), h))
        .when(h.startswith("?"), F.concat(without_fragment(without_query(p)), h))
        .when(h.startswith("#"), F.concat(without_fragment(p), h))
        .otherwise(F.concat(directory(p), h))
    )


def is_http(url) -> Column:
    return F.coalesce(col(url).startswith("http"), F.lit(False))


def append_query_flag(url, flag: str = "ajax=true") -> Column:
    """Add ``ajax=true`` with ``?`` or ``&`` unless the URL already has it."""
    u = col(url)
    sep = F.when(u.contains("?"), F.lit("&")).otherwise(F.lit("?"))
    return F.when(u.contains(flag), u).otherwise(F.concat(u, sep, F.lit(flag)))


def query_param(url, name: str) -> Column:
    """First value of a query parameter (null when absent or empty)."""
    q = F.regexp_extract(without_fragment(col(url)), r"\?([^#]*)", 1)
    v = F.regexp_extract(F.concat(F.lit("&"), q), r"&" + name + r"=([^&]*)", 1)
    return F.nullif(v, F.lit(""))


def product_handle(url) -> Column:
    """Segment after the last ``/products/``, before ``?`` and ``/``."""
    u = col(url)
    tail = F.substring_index(u, "/products/", -1)
    handle = F.substring_index(F.substring_index(tail, "?", 1), "/", 1)
    return F.when(F.coalesce(u.contains("/products/"), F.lit(False)), F.nullif(handle, F.lit("")))


def card_product_id(testid) -> Column:
    """Digits of ``productCard-<n>`` in a data-testid that is not a wishlist button."""
    t = col(testid)
    digits = F.nullif(F.regexp_extract(t, r"productCard-(\d+)", 1), F.lit(""))
    is_card = t.contains("productCard") & ~t.contains("Wishlist")
    return F.when(is_card, F.coalesce(digits, t)).otherwise(t)


def absolutize_image_url(src, page_url) -> Column:
    """Make an image src absolute against the category page; '' unless allowed."""
    full = absolute_image_src(src, page_url)
    return F.when(is_allowed_image_url(full), full).otherwise(F.lit(""))


def absolute_image_src(src, page_url) -> Column:
    """The absolute form of an image src ('' for unsupported forms), unfiltered."""
    s, p = F.coalesce(col(src), F.lit("")), col(page_url)
    base = (F.when(p.contains("/cz/en/"), F.substring_index(p, "/cz/en/", 1))
            .when(p.contains("/en_us/"), F.substring_index(p, "/en_us/", 1))
            .otherwise(F.regexp_extract(p, r"^(.*)/", 1)))
    relative = (F.when(s.startswith("/"), F.concat(origin(base), s))
                .otherwise(F.concat(base, F.lit("/"), s)))
    return (F.when(s.startswith("//"), F.concat(F.lit("https:"), s))
            .when(s.startswith("assets/") | s.startswith("/"), relative)
            .when(s.startswith("http"), s)
            .otherwise(F.lit("")))

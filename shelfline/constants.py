"""Fixed values.

These must equal the values the original catalog job used, otherwise the
normalised columns differ. They are stated here plainly and together.
"""

# --- fixed values: category id -> category name -------------------------
CATEGORY_NAMES = {
    "2443335": "clothing",
    "2418883": "leather",
    "2419032": "coats",
    "2419045": "puffers",
    "2420306": "knitwear",
    "2420942": "blazers",
    "2420896": "dresses, jumpsuits",
    "2419940": "tops",
    "2420490": "bodysuits",
    "2420285": "co-ords",
    "2419844": "cardigans, sweaters",
    "2420795": "trousers",
    "2420369": "shirts",
    "2417772": "jackets",
    "2467841": "sweatshirts, sweatpants",
    "2419185": "jeans",
    "2420417": "tshirts",
    "2420454": "skirts, shorts",
    "2419160": "footwear",
    "2417728": "bags",
    "2418989": "accessories, jewelry",
    "2419807": "lingerie",
    "2419833": "perfumes",
    "2418919": "beauty",
}
DEFAULT_CATEGORY = "clothing"

# --- fixed values: availability words ------------------------------------
AVAILABILITY = {
    "in_stock": "in_stock",
    "instock": "in_stock",
    "in stock": "in_stock",
    "available": "in_stock",
    "out_of_stock": "out_of_stock",
    "out-of-stock": "out_of_stock",
    "outofstock": "out_of_stock",
    "sold_out": "out_of_stock",
    "sold-out": "out_of_stock",
    "sold out": "out_of_stock",
    "unavailable": "out_of_stock",
    "coming_soon": "unknown",
    "coming-soon": "unknown",
    "preorder": "unknown",
    "pre-order": "unknown",
}

# --- fixed values: gender words (women is tested first) -------------------
WOMEN_WORDS = ["women", "female", "woman", "lady", "girl"]
MEN_WORDS = ["men", "male", "man", "guy", "boy"]

# --- fixed values: image URL rules ---------------------------------------
ALLOWED_IMAGE_MARKERS = ["-e1", "-ult21", "-s"]
VIDEO_MARKERS = [".m3u8", ".mp4", ".avi", ".mov", ".wmv", ".flv", ".webm", ".m4v",
                 "/video.mp4", "/video.", "video.mp4"]
NON_IMAGE_EXTENSIONS = [".html", ".htm", ".json", ".xml", ".txt", ".css", ".js",
                        ".pdf", ".zip", ".rar"]
SHORT_URL_HOST_MARKER = "zara"
SHORT_URL_MIN_LENGTH = 80
IMAGE_WIDTH = "800"

# --- fixed values: category ids inside HTML pages -------------------------
HTML_CATEGORY_ID_PATTERNS = [
    r"/category/(\d+)/products",
    r"categoryId[\"']?\s*[:=]\s*[\"']?(\d+)",
    r"[?&]v2=(\d+)",
]

# --- fixed values: product URL template ------------------------------------
PRODUCT_URL_TEMPLATE_SUFFIX = "/{keyword}-p{id}.html?v1={discern_id}"

# --- fixed values: defaults ------------------------------------------------
DEFAULT_SOURCE = "zara"
DEFAULT_SITE_SOURCE = "scraper"
DEFAULT_TITLE = "Unknown title"
FALLBACK_INFO_TEXT = "product"
EMBEDDING_DIM = 768
IVF_LISTS = 100
EMBEDDED_JSON_KEYS = ["products", "items", "productList", "data", "results",
                      "productGroups", "bundleProductSummaries"]

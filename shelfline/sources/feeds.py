"""Feed ingestion: JSON documents -> one row per item -> mapped raw products.

Documents are parsed with ``from_json`` against an explicit schema (a bad
document becomes null and contributes nothing). Item paths and field maps
are Spark SQL expression strings evaluated over the parsed struct, so
Catalyst sees one projection and no Python runs per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import normalize as N
from shelfline.functions.text import once, strip, truthy
from shelfline.functions import urls as U
from shelfline.operators.dedup import ordered_distinct

_MEDIA = T.ArrayType(T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("extraInfo", T.StructType([T.StructField("deliveryUrl", T.StringType())])),
]))

# Item fields the feed layouts carry (all optional). Pass another schema for
# items that carry others.
ITEM_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("sectionName", T.StringType()),
    T.StructField("section", T.StringType()),
    T.StructField("familyName", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("salePrice", T.StringType()),
    T.StructField("sale_price", T.StringType()),
    T.StructField("sale", T.StringType()),
    T.StructField("availability", T.StringType()),
    T.StructField("seo", T.StructType([
        T.StructField("discernProductId", T.StringType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("jsonLd", T.StructType([T.StructField("description", T.StringType())])),
    ])),
    T.StructField("xmedia", _MEDIA),
    T.StructField("detail", T.StructType([
        T.StructField("description", T.StringType()),
        T.StructField("longDescription", T.StringType()),
        T.StructField("colors", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType()),
            T.StructField("colorName", T.StringType()),
            T.StructField("badge", T.ArrayType(T.StringType())),
            T.StructField("xmedia", _MEDIA),
        ]))),
    ])),
    T.StructField("size", T.StringType()),
    T.StructField("sizes", T.StringType()),
    T.StructField("available_sizes", T.StringType()),
])

# Fields that may be text, a number, an object or a list: read as JSON values.
TYPED_FIELDS = ("price", "salePrice", "sale_price", "sale", "size", "sizes", "available_sizes")


def document_schema(item: T.StructType = ITEM_SCHEMA) -> T.StructType:
    """The three layouts: groups/elements/components, groups/elements, products."""
    element = T.StructType(list(item.fields) + [
        T.StructField("commercialComponents", T.ArrayType(item))])
    return T.StructType([
        T.StructField("productGroups", T.ArrayType(T.StructType([
            T.StructField("elements", T.ArrayType(element))]))),
        T.StructField("products", T.ArrayType(item)),
    ])


# Item paths as Spark SQL over the parsed document; projections drop nulls.
ITEM_PATHS = [
    "flatten(filter(transform(flatten(filter(transform(productGroups, g -> g.elements), x -> x IS NOT NULL)),"
    " e -> e.commercialComponents), x -> x IS NOT NULL))",
    "flatten(filter(transform(productGroups, g -> g.elements), x -> x IS NOT NULL))",
    "products",
]


#: Put before the text of a typed field's string, so that it is known from a number or an object once it is read.
_MARK = "\u0001"


def _names(t: T.DataType) -> set[str]:
    """Names of all fields below a type."""
    if isinstance(t, T.ArrayType):
        return _names(t.elementType)
    if isinstance(t, T.MapType):
        return _names(t.valueType)
    return {x for f in t.fields for x in {f.name} | _names(f.dataType)} if isinstance(t, T.StructType) else set()


def _typed_value(raw: Column) -> Column:
    """A marked field's text as a JSON value."""
    plain = F.replace(raw, F.lit("\\u0001"), F.lit(""))  # marks of fields inside an object, as its text spells them
    return once(plain, lambda text: F.when(raw.startswith(_MARK), F.struct(F.lit("STRING").alias("kind"), F.substr(raw, F.lit(2)).alias("raw"))).when(
        raw.isNotNull(), F.struct(N.kind_of_text(text).alias("kind"), text.alias("raw"))))


def read_feed_items(feeds: DataFrame, paths=None, schema: T.StructType = ITEM_SCHEMA,
                    payload: str = "payload", typed=TYPED_FIELDS) -> DataFrame:
    """One row per item at the first path giving a non-empty list, per document.

    ``schema`` is the item's; fields named in ``typed`` become JSON values
    (``struct<kind, raw>``). Every document is parsed once, each typed field
    as its text: objects keep the order of their keys and numbers their
    digits, which a variant does not. Strings among them are marked in the
    document before it is parsed. No field inside another may have a typed
    name. Keeps the document's other columns and adds ``item_pos`` and ``item``.
    """
    paths = paths or ITEM_PATHS
    typed = [f.name for f in schema.fields if f.name in typed]
    if deeper := {n for f in schema.fields if f.name not in typed for n in _names(f.dataType)} & set(typed):
        raise ValueError(f"typed fields that the schema also has inside others: {sorted(deeper)}")
    keep = [c for c in feeds.columns if c != payload]
    text = F.col(payload)
    if typed:
        text = F.regexp_replace(text, rf'(?<!\\)"({"|".join(map(re.escape, typed))})"\s*:\s*"', r'"$1":"\\u0001')
    # Values from here on (a generator's output): what follows would otherwise parse every document again.
    read = feeds.select(*keep, F.inline(F.array(F.from_json(text, document_schema(schema)))))
    fields = f"named_struct({', '.join(f"'{f}', x.{f}" for f in schema.names)})"
    lists = F.array(*[F.expr(f"transform({p}, x -> if(x IS NULL, NULL, {fields}))") for p in paths])

    def chosen(found: Column) -> Column:
        present = F.transform(found, lambda x: F.filter(x, lambda i: i.isNotNull()))
        return F.get(F.filter(present, lambda x: F.size(x) > 0), F.lit(0))

    out = read.select(*keep, F.posexplode(once(lists, chosen)).alias("item_pos", "item"))
    item = F.struct(*[(_typed_value(F.col("item")[f]) if f in typed else F.col("item")[f]).alias(f) for f in schema.names])
    return out.select(*keep, F.col("item_pos").cast("bigint").alias("item_pos"), item.alias("item"))


def _expr_types(df: DataFrame, exprs) -> dict:
    """Types of Spark SQL expressions over ``df``, resolved with one analysis."""
    exprs = list(dict.fromkeys(exprs))
    if not exprs:
        return {}
    schema = df.select(*[F.expr(e).alias(f"_t{i}") for i, e in enumerate(exprs)]).schema
    return {e: schema.fields[i].dataType for i, e in enumerate(exprs)}


def _is_json_value(t: T.DataType) -> bool:
    return t.simpleString() == N.JSON_VALUE


def _as_string_array(t: T.DataType, e: str):
    c = F.expr(e)
    if isinstance(t, T.ArrayType):
        if isinstance(t.elementType, T.ArrayType):
            return F.flatten(F.filter(c, lambda x: x.isNotNull())).cast("array<string>")
        return c.cast("array<string>")
    return F.array(c.cast("string"))


def map_fields(items: DataFrame, mapping: dict, keep=(), image_field: str = "image_url",
               merge_fields=("_xmedia_urls",), strict_image: bool = True) -> DataFrame:
    """Project items through a field map of Spark SQL expressions.

    ``None``/blank -> null; one expression -> its value; a list -> the first
    non-null value (an empty list counts as a value). For ``image_url`` a
    candidate must also be allowed and not a ``data:`` URL. Merge fields
    concatenate every expression's list, drop blanks and keep first-seen
    distinct values; an empty result is null.
    """
    base = items.select(*keep, "item.*") if "item" in items.columns else items
    needs_type = []
    for dest, spec in mapping.items():
        if isinstance(spec, (list, tuple)):
            specs = [x for x in spec if x is not None and x.strip()]
            if dest in merge_fields:
                needs_type += specs
            elif dest != image_field and len(specs) > 1:
                needs_type += specs
    types = _expr_types(base, needs_type)
    cols = []
    for dest, spec in mapping.items():
        if spec is None or (isinstance(spec, str) and not spec.strip()):
            cols.append(F.lit(None).cast("string").alias(dest))
            continue
        specs = [s for s in ([spec] if isinstance(spec, str) else list(spec))
                 if s is not None and s.strip()]
        if dest in merge_fields:
            merged = F.concat(*[F.coalesce(_as_string_array(types[s], s), F.array().cast("array<string>"))
                                for s in specs])
            kept = F.array_distinct(F.filter(merged, lambda u: truthy(strip(u))))
            cols.append(F.when(F.size(kept) > 0, kept).alias(dest))
        elif dest == image_field:
            cols.append(N.pick_image_url([F.expr(s) for s in specs],
                                         strict=strict_image or len(specs) == 1).alias(dest))
        elif len(specs) == 1:
            cols.append(F.expr(specs[0]).alias(dest))
        elif any(_is_json_value(types[s]) for s in specs):
            cols.append(F.coalesce(*[F.expr(s) if _is_json_value(types[s]) else N.text_value(F.expr(s)) for s in specs]).alias(dest))
        else:
            t = types[specs[0]]
            cols.append(F.coalesce(*[F.expr(s).cast(t) for s in specs]).alias(dest))
    return base.select(*keep, *cols)


def with_provenance(df: DataFrame, endpoint: str = "endpoint", kind: str = "api",
                    raw_item: str | None = "item") -> DataFrame:
    """Attach ``_meta = {source, endpoint}`` and the raw item as JSON text."""
    out = df.withColumn("_meta", F.struct(F.lit(kind).alias("source"),
                                          F.col(endpoint).alias("endpoint")))
    if raw_item and raw_item in df.columns:
        item = F.col(raw_item)
        kind_of = {f.name: f.dataType for f in df.schema[raw_item].dataType.fields}
        fields = [(F.when(item[f]["kind"] == "STRING", item[f]["raw"].cast("variant")).otherwise(F.try_parse_json(item[f]["raw"]))
                   if _is_json_value(t) else item[f]).alias(f) for f, t in kind_of.items()]
        out = out.withColumn("_raw_item", F.to_json(F.struct(*fields)))
    return out


def has_identifier(df: DataFrame) -> DataFrame:
    ext = F.col("external_id") if "external_id" in df.columns else F.lit(None)
    pid = F.col("product_id") if "product_id" in df.columns else F.lit(None)
    return df.filter(truthy(ext.cast("string")) | truthy(pid.cast("string")))


def has_required_image(df: DataFrame, mapping: dict | None = None) -> DataFrame:
    """Require a truthy ``image_url`` only when the field map maps one."""
    if mapping is not None and "image_url" not in mapping:
        return df
    return df.filter(truthy(F.col("image_url").cast("string")))


def ingest_stats(mapped: DataFrame, endpoint: str = "endpoint", mapping: dict | None = None) -> DataFrame:
    """Per endpoint: items matched, items with an id, items with id and image."""
    ext = F.col("external_id").cast("string") if "external_id" in mapped.columns else F.lit(None)
    pid = F.col("product_id").cast("string") if "product_id" in mapped.columns else F.lit(None)
    has_id = truthy(ext) | truthy(pid)
    needs_img = mapping is None or "image_url" in mapping
    has_img = truthy(F.col("image_url").cast("string")) if needs_img else F.lit(True)
    return mapped.groupBy(endpoint).agg(
        F.count(F.lit(1)).alias("matched"),
        F.count_if(has_id).alias("with_id"),
        F.count_if(has_id & has_img).alias("with_image"))


def select_sites(sites: DataFrame, requested: str, name: str = "brand") -> DataFrame:
    """'all' or a comma list; names are stripped and lower-cased, brands lower-cased."""
    if requested.lower() == "all":
        return sites
    wanted = sorted({s.strip().lower() for s in requested.split(",")})
    return sites.filter(F.lower(F.coalesce(F.col(name), F.lit(""))).isin(wanted))


def resolve_endpoints(endpoints: DataFrame, site: str = "site", kind: str = "kind",
                      ranks=("static", "json", "html")) -> DataFrame:
    """Per site keep the endpoints of the highest-ranked kind that has any.

    Rank is a grouped ``max`` joined back on (site, rank), one small row per
    site; Spark broadcasts it by its measured size.
    """
    rank_map = F.create_map(*[x for i, r in enumerate(ranks) for x in (F.lit(r), F.lit(i))])
    ranked = endpoints.withColumn("_rank", F.try_element_at(rank_map, F.col(kind)))
    best = ranked.groupBy(site).agg(F.max("_rank").alias("_rank"))
    return ranked.join(best, [site, "_rank"], "left_semi").drop("_rank")


def category_endpoints(categories: DataFrame, template: str, payload: str = "payload", doc: str = "doc",
                       url_path: str = "url", id_path: str = "id", items_path: str = "$.items") -> DataFrame:
    """Category JSON -> endpoint URLs, per document, in item order.

    An item that is an http URL is kept; else its ``url`` if http; else its id
    in the template. A document that yields nothing falls back to every digit
    ``id`` at any depth of the document (``category_ids_recursive``). The
    choice is made per document with array functions, so the documents are
    read once and exploded once; only documents without a direct result reach
    the id walk. ``items_path`` is a JSON path.
    """
    def picked(raw):
        obj = F.from_json(raw, f"struct<{url_path}: string, {id_path}: string>")
        is_obj = raw.startswith("{")
        url = F.when(is_obj, obj[url_path])
        cid = F.when(is_obj, obj[id_path])
        return (F.when(~is_obj & U.is_http(raw), raw)
                .when(U.is_http(url), url)
                .when(cid.isNotNull(), F.replace(F.lit(template), F.lit("{id}"), cid)))

    items = F.from_json(F.get_json_object(F.col(payload), items_path), "array<string>")
    direct = F.filter(F.transform(items, lambda raw, i: F.struct(F.lit(0).alias("branch"), i.alias("pos"),
                                                                 picked(raw).alias("url"))),
                      lambda x: x["url"].isNotNull())
    none = F.coalesce(F.size(direct), F.lit(0)) == 0
    fallback = F.transform(json_ids(F.when(none, F.col(payload))),
                           lambda cid, i: F.struct(F.lit(1).alias("branch"), i.alias("pos"),
                                                   F.replace(F.lit(template), F.lit("{id}"), cid).alias("url")))
    chosen = F.when(~none, direct).otherwise(fallback)
    both = (categories.select(doc, F.explode(chosen).alias("c")).select(doc, "c.*")
            .withColumn("pos", F.col("pos").cast("bigint")))
    return ordered_distinct(both, "url", [doc, "branch", "pos"], group=[])


_TOKEN = r'"(?:[^"\\]|\\.)*+"|[{}\[\]:,]|[^\s{}\[\]:,"]++'


def json_ids(payload) -> Column:
    """Distinct all-digit ``id`` values at any depth, a node's before its children's; malformed text has none.

    A walk that meets a node before its children meets objects in the order in
    which they begin, so the ids are sorted by where their object begins. One
    pass over the document's tokens keeps the places of the open brackets.
    """
    def of(t: Column) -> Column:
        def step(seen: Column, i: Column) -> Column:
            token = F.get(t, i)
            digits = F.regexp_extract(F.get(t, i + 2), r'^"?\s*(\p{Nd}+)\s*"?$', 1)
            is_id = (token == '"id"') & (F.get(t, i + 1) == ":") & (digits != "")
            opened = F.when(token.isin("{", "["), F.concat(seen["opened"], F.array(i))).when(
                token.isin("}", "]"), F.slice(seen["opened"], 1, F.size(seen["opened"]) - 1)).otherwise(seen["opened"])
            ids = F.when(is_id, F.concat(seen["ids"], F.array(F.struct(F.element_at(seen["opened"], -1).alias("at"), digits.alias("id"))))).otherwise(seen["ids"])
            return F.struct(opened.alias("opened"), ids.alias("ids"))

        none = F.struct(F.array().cast("array<int>").alias("opened"), F.array().cast("array<struct<at:int,id:string>>").alias("ids"))
        return F.aggregate(F.sequence(F.lit(0), F.size(t) - 1), none, step, lambda seen: F.array_distinct(F.transform(F.array_sort(seen["ids"]), lambda x: x["id"])))

    text = F.col(payload) if isinstance(payload, str) else payload
    tokens = F.when(F.try_parse_json(text).isNotNull(), F.regexp_extract_all(text, F.lit(_TOKEN), 0))
    return once(tokens, lambda t: F.when(F.size(t) > 0, of(t)).otherwise(F.array().cast("array<string>")))


def category_ids_recursive(docs: DataFrame, template: str, payload: str = "payload",
                           doc: str = "doc") -> DataFrame:
    """Every distinct all-digit ``id`` anywhere in the JSON document, in the order
    of a walk that meets a node before its children, templated."""
    out = docs.select(doc, F.posexplode(json_ids(payload)).alias("pos", "cid")).withColumn("pos", F.col("pos").cast("bigint"))
    return out.select(doc, "pos", F.replace(F.lit(template), F.lit("{id}"), F.col("cid")).alias("url"))


def union_batches(*batches: DataFrame) -> DataFrame:
    """Append each endpoint's products; a failed endpoint contributes no rows."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def fallback_to_pages(feed_docs: DataFrame, feed_products: DataFrame, page_rows: DataFrame,
                      endpoint: str = "endpoint", page_key: str = "page_key") -> DataFrame:
    """Documents that yield no usable product take the page rows of their page key.

    Page key = endpoint without its query string. Page rows are taken once per
    failing key (a semi-join), never once per failing document.
    """
    ok_docs = feed_products.select("endpoint_pos", endpoint).distinct()
    failing = feed_docs.select("endpoint_pos", endpoint).join(ok_docs, ["endpoint_pos", endpoint],
                                                              "left_anti")
    keys = failing.select(U.without_query(endpoint).alias(page_key)).distinct()
    taken = page_rows.join(keys, page_key, "left_semi")
    return feed_products.unionByName(taken, allowMissingColumns=True)


def json_field(payload, field: str):
    """A top-level field of a JSON text as a JSON value (see ``normalize``)."""
    p = F.col(payload) if isinstance(payload, str) else payload
    return N.json_value(F.from_json(p, f"struct<{field}: variant>")[field], F.from_json(p, f"struct<{field}: string>")[field])

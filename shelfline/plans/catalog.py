"""End-to-end plans composed from the operators.

E1 (feed run): documents -> items -> field map -> gates -> site defaults ->
product rows -> price gate -> first row per id [-> embed -> upsert -> prune].
It is one lazy plan, and building it starts no job; the only shuffles are the
de-dup and, when a table is given, the joins against the batch ids.

E2 (page run): category pages -> cards filled from embedded JSON, or links ->
product pages -> page fields -> product rows -> price gate -> first row per id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import constants as K
from shelfline.operators import dedup as D
from shelfline.operators import rows as RW
from shelfline.operators.maintain import upsert_products, prune_missing
from shelfline.operators.reads import site_totals
from shelfline.session import written
from shelfline.sources import feeds as FD
from shelfline.sources import pages as PG

#: Arrival order, unique over documents: the endpoint (a path, where none is configured) parts documents of one position.
ORDER = ["endpoint_pos", "endpoint", "page", "item_pos"]


def feed_products(feeds: DataFrame, site: dict, mapping: dict, limit: int = 0,
                  item_schema: T.StructType = FD.ITEM_SCHEMA) -> DataFrame:
    """Feed documents -> de-duplicated product rows (arrival order kept).

    ``limit`` keeps the first N items of the site before the price gate and
    de-dup (0 = all); for one site that is a global first-N, planned as a
    per-partition top-N merged once (TakeOrderedAndProject).
    """
    keep = [c for c in ("endpoint_pos", "endpoint", "page") if c in feeds.columns] + ["item_pos"]
    items = FD.read_feed_items(feeds, schema=item_schema)
    mapped = FD.map_fields(items, mapping, keep=keep)
    usable = FD.has_required_image(FD.has_identifier(mapped), mapping)
    raw = RW.apply_site_defaults(usable, site=site)
    order = [c for c in ORDER if c in raw.columns]
    if limit:
        raw = raw.orderBy(*order).limit(limit)
    rows = RW.settled(RW.to_product_row(raw, keep=order))
    return D.dedup_first(RW.price_gate(rows), "id", order)


def card_products(category_pages: DataFrame, site: dict, fields: dict | None = None, limit: int = 0) -> DataFrame:
    """The page run over category pages: cards filled from embedded JSON -> product rows -> first row per id."""
    cards = PG.match_cards_to_embedded(category_pages, fields=fields)
    raw = cards.withColumnRenamed("card_id", "external_id")
    return _page_tail(raw, site, ["page_id", "card_pos"], limit)


def linked_products(category_pages: DataFrame, product_pages: DataFrame, site: dict, fields: dict,
                    sitemap_urls: DataFrame | None = None, limit: int = 0) -> DataFrame:
    """The page run over product pages: links of category pages (after the
    ``sitemap_urls`` (url, ord), if any) -> the pages they name -> page fields
    -> product rows -> first row per id."""
    links = PG.page_links(category_pages).select(F.lit(1).alias("src"), F.array(F.col("page_id"), F.col("pos")).alias("at"), F.col("link").alias("url"))
    if sitemap_urls is not None:
        links = sitemap_urls.select(F.lit(0).alias("src"), F.col("ord").cast("array<bigint>").alias("at"), "url").unionByName(links)
    links = D.ordered_distinct(links, "url", ["src", "at"])
    raw = PG.page_fields(product_pages.join(links, "url"), fields, keep=["src", "at"])
    pid = F.col("product_id") if "product_id" in raw.columns else F.lit(None).cast("string")
    raw = raw.withColumn("external_id", F.coalesce(F.nullif(pid, F.lit("")), F.col("url"))).withColumnRenamed("url", "product_url")
    return _page_tail(raw, site, ["src", "at"], limit)


def _page_tail(raw: DataFrame, site: dict, order: list[str], limit: int) -> DataFrame:
    raw = RW.apply_site_defaults(raw, site=site)
    if limit:
        raw = raw.orderBy(*order).limit(limit)
    if dict(raw.dtypes).get("price") == "double":  # a number, formatted with the currency
        raw = raw.withColumn("price", F.when(F.col("price").isNotNull(), F.struct(F.lit("DOUBLE").alias("kind"), F.col("price").cast("string").alias("raw"))))
    rows = RW.settled(RW.to_product_row(raw, keep=order))
    return D.dedup_first(RW.price_gate(rows), "id", order).drop(*order)


def embed_products(products: DataFrame, text_encoder_factory=None, image_encoder_factory=None,
                   dim: int = 768, images: DataFrame | None = None) -> DataFrame:
    """Add ``info_embedding`` (encoder over ``build_info_text``) and
    ``image_embedding``, only for image URLs that can be embedded. Runs after
    gate and de-dup, so each product is encoded once; a failed or wrong-width
    vector is null and the row kept.

    With ``images`` (image_url, content), as ``read_images`` gives them, the
    image encoder gets the bytes of the cleaned URL: every image that a product
    names is encoded once, and only its vector is joined to the products.
    Without, it gets the cleaned URL itself."""
    from pyspark.sql import functions as F
    from shelfline.functions import normalize as N
    from shelfline.operators.vectors import embed_column
    out = products
    if text_encoder_factory is not None:
        out = RW.with_info_text(out, "_info")
        out = embed_column(out, "_info", text_encoder_factory, "info_embedding", dim).drop("_info")
    if image_encoder_factory is not None:
        out = out.withColumn("_img", F.when(N.is_embeddable_image_url("image_url"),
                                            N.clean_image_url("image_url")))
        if images is None:
            return embed_column(out, "_img", image_encoder_factory, "image_embedding", dim).drop("_img")
        named = out.select("_img").filter("_img is not null").distinct()
        known = images.select(F.col("image_url").alias("_img"), "content").join(named, "_img", "left_semi")
        known = known.groupBy("_img").agg(F.min_by("content", F.sha2("content", 256)).alias("content"))
        known = embed_column(known, "content", image_encoder_factory, "image_embedding", dim).drop("content")
        out = out.join(known, "_img", "left").drop("_img")
    return out


def feed_run(feeds: DataFrame, site: dict, mapping: dict, table: DataFrame | None = None,
             sync: bool = False, dry_run: bool = False, text_encoder_factory=None,
             image_encoder_factory=None, dim: int = 768, limit: int = 0) -> DataFrame:
    """The whole run: products, optional embeddings, then upsert into ``table``
    and (``sync``) prune the site's source. ``dry_run`` returns the products
    without touching the table (and, unlike the original, never prunes)."""
    products = feed_products(feeds, site, mapping, limit).drop(*ORDER)
    products = embed_products(products, text_encoder_factory, image_encoder_factory, dim)
    if dry_run or table is None:
        return products
    out = upsert_products(table, products)
    if sync:
        out = prune_missing(out, products.select("id"), site.get("source", K.DEFAULT_SITE_SOURCE))
    return out


def stamp(cur: DataFrame | None, batch: DataFrame, run_ts) -> DataFrame:
    """Upsert with timestamps: ``last_seen`` = this run for every batch row;
    ``created_at`` kept from the table for updates, this run for inserts."""
    # Zone-free timestamps built from text, so no session or process time
    # zone can shift them.
    ts = F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    b = batch.drop("created_at").withColumn("last_seen", ts)
    merged = (b.withColumn("created_at", F.lit(None).cast("timestamp_ntz")) if cur is None
              else upsert_products(cur, b))
    return merged.withColumn("created_at", F.coalesce(F.col("created_at"), ts))


def maintain_products(table, products: DataFrame, source: str, sync: bool = False, run_ts=None) -> None:
    """Persist a run into a ``PartitionedTable`` scoped by ``source``.

    The upsert rewrites only the (source, bucket) partitions the products
    fall in; with ``sync`` the prune rewrites only those of ``source``'s
    partitions that actually lose rows.
    An empty run prunes nothing. ``run_ts`` stamps ``last_seen`` and the
    ``created_at`` of inserted rows; it defaults to now, so pass the run's
    own timestamp (e.g. its scheduled time) if a replayed run must write
    identical stamps.
    """
    import datetime as _dt
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    with written(products, "run") as run:
        table.merge(run, lambda cur, b: stamp(cur, b, run_ts))
        if sync:
            table.delete_missing(source, run.select("id"))


def run_sites(feeds: DataFrame, sites: DataFrame, mapping: dict, requested: str = "all",
              limit: int = 0, table=None, sync: bool = False, dry_run: bool = False):
    """Run the feed pipeline for the requested sites at once.

    ``feeds`` carries a ``site`` column naming its site's ``brand``; ``sites``
    is the config table (brand, source, merchant, country,
    product_url_template, ...). The first ``limit`` items per site are kept
    before the price gate and de-dup (0 = all). With a ``table``
    (``PartitionedTable`` scoped by source) the products are upserted and, with
    ``sync``, each site's source is pruned to its current ids; ``dry_run``
    writes nothing. Returns (products, site_totals).
    """
    from shelfline.sources.feeds import select_sites
    chosen = select_sites(sites, requested).withColumnRenamed("brand", "site")
    feeds = feeds.join(chosen.select("site"), "site", "left_semi")
    keep = [c for c in ("site", "endpoint_pos", "endpoint", "page") if c in feeds.columns] + ["item_pos"]
    mapped = FD.map_fields(FD.read_feed_items(feeds), mapping, keep=keep)
    usable = FD.has_required_image(FD.has_identifier(mapped), mapping)
    raw = RW.apply_site_defaults(usable, sites=chosen, on="site")
    order = [c for c in ORDER if c in raw.columns]
    if limit:
        raw = D.limit_per_site(raw, limit, site="site", order=order)
    rows = RW.settled(RW.to_product_row(raw, keep=["site"] + order))
    products = D.dedup_first(RW.price_gate(rows), "id", ["site"] + order).drop(*order)
    totals = site_totals(products, "site")
    if table is not None and not dry_run:
        import datetime as _dt
        run_ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        with written(products.drop("site"), "run") as run:
            table.merge(run, lambda cur, b: stamp(cur, b, run_ts))
            if sync:
                # One prune per source of the chosen sites (a bounded config list).
                for (src,) in chosen.select("source").distinct().collect():
                    table.delete_missing(src, run.filter(F.col("source") == src).select("id"))
    return products, totals

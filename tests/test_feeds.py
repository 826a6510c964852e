"""Feed ingestion, field maps, site defaults and endpoint discovery on inline rows."""

from pyspark.sql import functions as F

import pytest
from pyspark.sql import types as T

from shelfline.operators import rows as RW
from shelfline.operators.maintain import categories_table, category_lookup
from shelfline.sources import feeds as FD
from shelfline.sources.pages import html_endpoints

ITEM = '{"id":"7","name":"Coat","seo":{"discernProductId":"D7"},"xmedia":[{"url":"data:x"},{"url":"https://i/7-e1.jpg"}]}'


def docs(spark):
    return spark.createDataFrame([
        (0, "e0", '{"productGroups":[{"elements":[{"commercialComponents":[' + ITEM + ']}]}]}'),
        (1, "e1", '{"productGroups":[{"elements":[' + ITEM + ',null]}]}'),
        (2, "e2", '{"products":[' + ITEM + ']}'),
        (3, "e3", '{bad'),
        (4, "e4", '{"products":[]}'),
    ], "endpoint_pos int, endpoint string, payload string")


def test_layouts_and_malformed(spark):
    items = FD.read_feed_items(docs(spark))
    got = sorted((r.endpoint_pos, r.item_pos, r.item.id) for r in items.collect())
    assert got == [(0, 0, "7"), (1, 0, "7"), (2, 0, "7")]


def test_map_fields_fallback_merge_and_image(spark):
    items = FD.read_feed_items(docs(spark)).filter(F.col("endpoint_pos") == 2)
    mapping = {"external_id": "seo.discernProductId", "title": ["missing_field_is_null", "name"],
               "blank": "  ", "image_url": ["try_element_at(xmedia, 1).url", "try_element_at(xmedia, 2).url"],
               "_xmedia_urls": ["transform(xmedia, m -> m.url)", "transform(xmedia, m -> m.path)"]}
    mapping["title"] = ["description", "name"]  # description is null in the item
    m = FD.map_fields(items, mapping, keep=["endpoint_pos"]).first()
    assert m.external_id == "D7" and m.title == "Coat" and m.blank is None
    assert m.image_url == "https://i/7-e1.jpg"
    assert m._xmedia_urls == ["data:x", "https://i/7-e1.jpg"]


def test_site_defaults_from_table_and_category_join(spark):
    raw = spark.createDataFrame([("a", None, None, "u1", None), ("b", "X", "de", None, "https://s/category/2419032/p")],
                                "site string, external_id string, country string, product_url string, endpoint string")
    sites = spark.createDataFrame([("a", "MA", "us", "tpl"), ("b", "MB", "fr", "tpl2")],
                                  "site string, merchant string, country string, product_url_template string")
    out = {r.site: r for r in RW.apply_site_defaults(raw, sites=sites).collect()}
    assert (out["a"].merchant, out["a"].country, out["a"].external_id) == ("MA", "us", "u1")
    assert (out["b"].country, out["b"].external_id, out["b"].product_url_template) == ("de", "X", "tpl2")
    cats = {r.site: r.category for r in category_lookup(raw, categories_table(spark)).collect()}
    assert cats == {"a": "clothing", "b": "coats"}


def test_select_sites(spark):
    sites = spark.createDataFrame([("Zara",), ("Other",), (None,)], "brand string")
    assert FD.select_sites(sites, "all").count() == 3
    assert [r.brand for r in FD.select_sites(sites, " zara ,x").collect()] == ["Zara"]


def test_category_endpoints_and_recursive_fallback(spark):
    cats = spark.createDataFrame([
        (0, '{"items":["https://c/1", {"url":"https://c/2"}, {"id":"3"}, {"url":"ftp://x"}, "https://c/1"]}'),
        (1, '{"items":[{"name":"n","children":[{"id":44},{"id":"x5"},{"id":" 6 "}]}]}'),
    ], "doc long, payload string")
    got = [r.url for r in FD.category_endpoints(cats, "T/{id}").orderBy("doc", "branch", "pos").collect()]
    assert got == ["https://c/1", "https://c/2", "T/3", "T/44", "T/6"]


def test_html_endpoints(spark):
    html = ('<a href="/shop?v1=12&x=1">a</a><a href="/cat/77">b</a><a href="/none">c</a>'
            '<script>categoryId: "555"</script> /category/999/products')
    pages = spark.createDataFrame([(1, "https://s.example/en/cat/31?v1=8", html)], "page_id long, url string, html string")
    got = [r.endpoint for r in html_endpoints(pages, "https://api/{category_id}/p", r"/cat/(\d+)", "v1")
           .orderBy("page_id", "src", "pos").collect()]
    assert got == ["https://api/999/p?ajax=true", "https://api/555/p?ajax=true", "https://api/8/p",
                   "https://api/12/p?ajax=true", "https://api/77/p?ajax=true"]


def test_fallback_to_pages(spark):
    feed_docs = spark.createDataFrame([(0, "https://s/c/1?ajax=true"), (1, "https://s/c/2?ajax=true")],
                                      "endpoint_pos int, endpoint string")
    products = spark.createDataFrame([(0, "https://s/c/1?ajax=true", "feed", "p1")],
                                     "endpoint_pos int, endpoint string, origin string, item_id string")
    pages = spark.createDataFrame([("https://s/c/2", "page", "q1"), ("https://s/c/1", "page", "q0")],
                                  "page_key string, origin string, item_id string")
    got = sorted((r.origin, r.item_id) for r in FD.fallback_to_pages(feed_docs, products, pages).collect())
    assert got == [("feed", "p1"), ("page", "q1")]


def test_feed_run_embeds_after_gate_and_dedup(spark):
    from shelfline.operators.vectors import hashing_encoder_factory
    from shelfline.plans.catalog import feed_run
    docs_ = spark.createDataFrame([(2, 0, "https://s/category/2419032/products", '{"products":[' + ITEM + "," + ITEM + "]}")],
                                  "endpoint_pos int, page long, endpoint string, payload string")
    mapping = {"external_id": "seo.discernProductId", "title": "name", "price": "'12,50'",
               "currency": "'USD'", "image_url": ["try_element_at(xmedia, 2).url"]}
    out = feed_run(docs_, {"merchant": "M", "source": "s"}, mapping,
                   text_encoder_factory=hashing_encoder_factory(16),
                   image_encoder_factory=hashing_encoder_factory(16), dim=16).collect()
    assert len(out) == 1 and out[0].price == "12.50USD" and out[0].category == "coats"
    assert len(out[0].info_embedding) == 16 and len(out[0].image_embedding) == 16


def test_run_sites_limit_sync_totals(spark, tmp_path):
    from shelfline.plans.catalog import run_sites
    from shelfline.sources.table import PartitionedTable

    def item(i, site):
        return ('{"id":"%d","name":"N%d","price":"%d,5","seo":{"discernProductId":"%s%d"},'
                '"xmedia":[{"url":"https://i/%d-e1.jpg"}]}' % (i, i, i, site, i, i))

    feeds = spark.createDataFrame([
        ("A", 0, 0, "https://a/category/2419032/p", '{"products":[' + ",".join(item(i, "a") for i in range(4)) + "]}"),
        ("B", 0, 0, "https://b/x", '{"products":[' + ",".join(item(i, "b") for i in range(3)) + "]}"),
        ("C", 0, 0, "https://c/x", '{"products":[' + item(9, "c") + "]}"),
    ], "site string, endpoint_pos int, page long, endpoint string, payload string")
    sites = spark.createDataFrame([("A", "sa", "MA", "us"), ("B", "sb", "MB", "de"), ("C", "sc", "MC", "fr")],
                                  "brand string, source string, merchant string, country string")
    mapping = {"external_id": "seo.discernProductId", "title": "name", "price": "price",
               "currency": "'USD'", "image_url": ["try_element_at(xmedia, 1).url"]}
    table = PartitionedTable(spark, str(tmp_path / "t"), "id", buckets=4, scope="source")
    products, totals = run_sites(feeds, sites, mapping, "a, B", limit=2, table=table, sync=True)
    assert sorted((r.site or "", r.imported) for r in totals.collect()) == [("", 4), ("A", 2), ("B", 2)]
    assert sorted(r.source for r in table.read().collect()) == ["sa", "sa", "sb", "sb"]
    got = {r.title: (r.price, r.category) for r in products.collect() if r.site == "A"}
    assert got == {"N0": ("0.5USD", "coats"), "N1": ("1.5USD", "coats")}
    _, totals = run_sites(feeds, sites, mapping, "B", limit=1, table=table, sync=True)
    assert sorted(r.source for r in table.read().collect()) == ["sa", "sa", "sb"]


def test_html_endpoints_path_placeholder(spark):
    pages = spark.createDataFrame([(1, "https://s.example/list", '<a href="/women/dresses">x</a>')],
                                  "page_id long, url string, html string")
    got = [r.endpoint for r in html_endpoints(pages, "https://api.example{path}/products").collect()]
    assert got == ["https://api.example/women/dresses/products?ajax=true"]


def test_feed_run_limit_before_gate(spark):
    from shelfline.plans.catalog import feed_products
    items = ",".join('{"id":"%d","name":"N%d","price":"%s","seo":{"discernProductId":"E%d"},'
                     '"xmedia":[{"url":"https://i/%d-e1.jpg"}]}' % (i, i, "free" if i == 0 else "5", i, i)
                     for i in range(5)).replace('"price":"free"', '"price":" "')
    docs_ = spark.createDataFrame([(0, 0, "https://s/x", '{"products":[' + items + "]}")],
                                  "endpoint_pos int, page long, endpoint string, payload string")
    mapping = {"external_id": "seo.discernProductId", "title": "name", "price": "price",
               "currency": "'USD'", "image_url": ["try_element_at(xmedia, 1).url"]}
    got = sorted(r.title for r in feed_products(docs_, {"source": "s"}, mapping, limit=2).collect())
    assert got == ["N1"]  # the limit counts N0 before its blank price is gated out


def test_feed_products_carry_typed_prices_sales_sizes_and_colours(spark):
    """Integers in minor units, object prices, nested sizes and colour galleries reach the product rows."""
    from shelfline.plans.catalog import feed_products
    from shelfline.plans.fixtures import FEED_MAPPING, SITE
    items = [
        '{"id":"1","seo":{"discernProductId":"A"},"name":"n","price":2990,"salePrice":1999,"sizes":[["S"],["M","S"]],'
        '"detail":{"colors":[{"name":"red","xmedia":[{"url":"https://i/1-s.jpg","extraInfo":{"deliveryUrl":"https://i/1-e1.jpg"}}]},'
        '{"xmedia":[{"url":"https://i/2-s.jpg"}]}]}}',
        '{"id":"2","seo":{"discernProductId":"B"},"name":"n","price":{"USD":20,"CZK":"450.50"},"sale":0,"available_sizes":["38"],"xmedia":[{"url":"https://i/3-s.jpg"}]}',
        '{"id":"3","seo":{"discernProductId":"C"},"name":"n","price":0,"xmedia":[{"url":"https://i/4-s.jpg"}]}',
        '{"id":"4","seo":{"discernProductId":"D"},"name":"n","price":null,"xmedia":[{"url":"https://i/5-s.jpg"}]}']
    docs = spark.createDataFrame([(0, "e", 0, '{"products":[' + ",".join(items) + "]}")], "endpoint_pos int, endpoint string, page int, payload string")
    got = {r.image_url: r for r in feed_products(docs, SITE, FEED_MAPPING).collect()}
    assert {u: (r.price, r.sale, r["size"]) for u, r in got.items()} == {
        "https://i/1-e1.jpg": ("29.9USD", "19.99USD", "S, M"), "https://i/3-s.jpg": ("20USD,450.50CZK", None, "38"), "https://i/4-s.jpg": ("0USD", None, None)}
    assert got["https://i/1-e1.jpg"].additional_images == ["https://i/1-s.jpg", "https://i/2-s.jpg"]


def test_item_schema_by_parameter(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("sku", T.StringType()), T.StructField("cost", T.StringType())])
    docs_ = spark.createDataFrame([(0, '{"products":[{"sku":"a","cost":5},null,{"sku":"b","cost":"5"}]}')], "endpoint_pos int, payload string")
    got = FD.read_feed_items(docs_, schema=schema, typed=("cost",)).collect()
    assert [(r.item_pos, r.item.sku, r.item.cost.kind, r.item.cost.raw) for r in got] == [(0, "a", "BIGINT", "5"), (1, "b", "STRING", "5")]


def test_raw_item_keeps_the_original_values(spark):
    docs_ = spark.createDataFrame([(0, "e", '{"products":[{"id":"1","price":{"USD":2},"sale":"7"}]}')], "endpoint_pos int, endpoint string, payload string")
    raw = FD.with_provenance(FD.read_feed_items(docs_)).first()._raw_item
    import json
    assert json.loads(raw) == {"id": "1", "price": {"USD": 2}, "sale": "7"}


def test_category_ids_meet_a_node_before_its_children(spark):
    docs_ = spark.createDataFrame([(0, '{"children":[{"id":7},{"id":"7"},{"id":" 8 "}],"id":1,"x":{"id":"z9"}}'), (1, "{bad")], "doc int, payload string")
    got = FD.category_ids_recursive(docs_, "u{id}").orderBy("pos").collect()
    assert [r.url for r in got] == ["u1", "u7", "u8"]
    items = spark.createDataFrame([(0, '{"data":{"list":["http://a",{"id":5}]}}')], "doc int, payload string")
    assert [r.url for r in FD.category_endpoints(items, "http://u/{id}", items_path="$.data.list").orderBy("pos").collect()] == ["http://a", "http://u/5"]


def walked(text: str) -> list[str]:
    """Brute force: a walk through the parsed document, a node's id before its children's."""
    import json
    found: dict = {}

    def walk(node):
        if isinstance(node, dict):
            cid = node.get("id")
            if isinstance(cid, (int, str)) and str(cid).strip().isdigit():
                found.setdefault(str(cid).strip())
            node = node.values()
        elif not isinstance(node, list):
            return
        for child in node:
            walk(child)

    try:
        walk(json.loads(text))
    except ValueError:
        return []
    return list(found)


def test_ids_at_any_depth_are_those_of_a_walk(spark):
    import json
    import random
    rng = random.Random(3)

    def value(depth: int):
        kind = rng.randrange(5, 9) if depth > 7 else rng.randrange(9) if depth else rng.randrange(5)
        if kind < 5:
            return [rng.randrange(40), str(rng.randrange(40)), f" {rng.randrange(40)} ", rng.choice(["x\"{id", None, True, -3, 1.5, "id", "12a", "", ":", "a:1,\"id\":7"]), "id"][kind]
        if kind == 5:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        names = ["id", "z", "a", "children", "id", "m\"n", "url"]
        return {rng.choice(names): value(depth - 1) for _ in range(rng.randrange(5))}

    texts = [json.dumps(value(10), ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])) for _ in range(1500)]
    texts += ["{bad", "", "[]", "3", '"id"', '{"id":5', None, '{"id" : "7" , "x":[{"id":\t8}]}', "[" * 30 + '{"id":1}' + "]" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.ids for r in df.select("i", FD.json_ids("t").alias("ids")).collect()}
    for i, t in enumerate(texts):
        assert (got[i] or []) == (walked(t) if t is not None else []), t
    assert sum(len(x or []) > 3 for x in got.values()) > 50


def test_no_python_in_category_documents(spark):
    from shelfline.plans.explain import plan_text, summarise
    docs_ = spark.createDataFrame([(1, '{"items":[],"a":{"id":3}}')], "doc int, payload string")
    assert not summarise(plan_text(FD.category_endpoints(docs_, "https://s/{id}")))["python"]
    assert [r.url for r in FD.category_endpoints(docs_, "https://s/{id}").collect()] == ["https://s/3"]


def test_typed_fields_are_read_in_one_parse(spark):
    items = [
        '{"id":"1","price":"12,50","sale":9.0,"sizes":["S",4],"size":"{\\"a\\":1}"}',
        '{"id":"2","price" : {"USD":"20.50","CZK":7,"price":"x","a":{"sale":"y"}},"sale":null,"sizes":[],"size":""}',
        '{"id":"3","price":[{"price":"0","currency":"usd"}],"sale":true,"name":"says \\"price\\":\\"5\\" and \\\\","size":12345678901234567890}',
        '{"id":"4","price":1e3,"sale":-2,"salePrice":"\\u0001x","description":"\\"sale\\":\\"1\\""}',
    ]
    feed = spark.createDataFrame([(1, '{"products":[null,' + ",".join(items) + "]}"), (2, "{bad"), (3, None), (4, '{"products":[null]}')], "endpoint_pos int, payload string")
    read = FD.read_feed_items(feed)
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    got = {r["item"]["id"]: r["item"] for r in read.collect()}
    assert sorted(got) == ["1", "2", "3", "4"]

    def of(i, name):
        v = got[i][name]
        return v and (v["kind"], v["raw"])

    assert [of("1", n) for n in ("price", "sale", "sizes", "size")] == [("STRING", "12,50"), ("DECIMAL", "9.0"), ("ARRAY", '["S",4]'), ("STRING", '{"a":1}')]
    assert [of("2", n) for n in ("price", "sale", "sizes", "size")] == [("OBJECT", '{"USD":"20.50","CZK":7,"price":"x","a":{"sale":"y"}}'), None, ("ARRAY", "[]"), ("STRING", "")]
    assert [of("3", n) for n in ("price", "sale", "size")] == [("ARRAY", '[{"price":"0","currency":"usd"}]'), ("BOOLEAN", "true"), ("DECIMAL", "12345678901234567890")]
    assert got["3"]["name"] == 'says "price":"5" and \\' and got["4"]["description"] == '"sale":"1"'
    assert [of("4", n) for n in ("price", "sale", "salePrice")] == [("DECIMAL", "1000.0"), ("BIGINT", "-2"), ("STRING", "\x01x")]
    nested = T.StructType([T.StructField("id", T.StringType()), T.StructField("price", T.StringType()), T.StructField("detail", T.StructType([T.StructField("price", T.StringType())]))])
    with pytest.raises(ValueError):
        FD.read_feed_items(feed, ["products"], nested)

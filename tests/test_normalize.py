"""Each branch of the normalisers, with expected values derived by hand."""

from pyspark.sql import functions as F

from shelfline.functions import normalize as N
from shelfline.functions import urls as U


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_format_price_text(spark):
    rows = [("20USD,450CZK", "USD"), ("$1,234.00", "USD"), ("12,5", "EUR"), ("1,299", "USD"),
            ("free", "USD"), ("  39.99 ", "USD"), ("   ", "USD"), (None, "USD"), ("9,99", None),
            (",,", "USD"), ("1,2,3", "USD")]
    got = one(spark, N.format_price_text("p", "c"), rows, "p string, c string")
    assert got == ["20USD,450CZK", "1234.00USD", "12.5EUR", "1299USD", "free", "39.99USD", None,
                   None, "9,99", ",,", "123USD"]


def test_format_price_number_minor_units(spark):
    rows = [(999.0, True, "USD"), (1000.0, True, "USD"), (2990.0, True, "USD"),
            (1299.5, False, "USD"), (1e7, False, "USD"), (0.0, True, "USD"), (5.0, True, None)]
    got = one(spark, N.format_price_number("n", "i", "c"), rows, "n double, i boolean, c string")
    assert got == ["999USD", "10USD", "29.9USD", "1299.5USD", "10000000USD", "0USD", None]


def test_format_price_map_and_list(spark):
    df = spark.createDataFrame([('{"USD":20,"CZK":450.0,"x":1,"eur":"12.0"}',), ('{"usd":null}',)], "j string")
    m = df.select(N.format_price_map(F.from_json("j", "map<string,variant>")).alias("p")).collect()
    assert [r.p for r in m] == ["20USD,450CZK,12EUR", None]
    lst = spark.createDataFrame(
        [('[{"price":0,"amount":5,"currency":"eur"},{"value":"7.50","code":"czk"}]',), ("[]",)], "j string")
    got = lst.select(N.format_price_list(F.from_json("j", N.PRICE_LIST)).alias("p")).collect()
    assert [r.p for r in got] == ["5EUR,7.50CZK", None]


def json_values(spark, values):
    from shelfline.sources.feeds import json_field
    df = spark.createDataFrame([(i, '{"v":' + v + "}") for i, v in enumerate(values)], "i int, j string")
    return df.select("i", json_field("j", "v").alias("v")).orderBy("i")


def test_format_price_keeps_the_json_kind(spark):
    """Text stays text inside objects and lists; "0" is a price, 0 is none; integers from 1000 on are minor units."""
    cases = {'2990': "29.9USD", '2990.0': "2990USD", '19.90': "19.9USD", '"19.90"': "19.90USD", '"20.00"': "20.00USD", '999': "999USD",
             '{"USD":"20.50","CZK":450}': "20.50USD,450CZK", '{"USD":2990,"eur":"9.0"}': "2990USD,9EUR", '{"dollars":1}': None,
             '[{"price":"0","amount":"5","currency":"usd"}]': "0USD", '[{"price":0,"amount":"5","currency":"usd"}]': "5USD",
             '[{"amount":0,"curr":"czk"}]': "0CZK", 'true': "1USD", 'null': None, '""': None, '{}': None, '[]': None,
             '10000000': "100000USD", '1e16': "1e+16USD", '0.00002': "2e-05USD", '123456789012345678901234': "1.2345678901234568e+21USD"}
    got = json_values(spark, cases).select(N.format_price("v", F.lit("USD")).alias("p")).collect()
    assert {c: r.p for c, r in zip(cases, got)} == cases
    assert json_values(spark, ["5", "true"]).select(N.format_price("v", F.lit(None).cast("string")).alias("p")).collect() == [(None,), (None,)]


def test_json_truthiness_and_sale(spark):
    cases = {'0': False, '0.0': False, '""': False, 'false': False, '{}': False, '[ ]': False, 'null': False, '"0"': True, '1': True, '[0]': True, '{"a":1}': True}
    got = json_values(spark, cases).select(F.coalesce(N.json_truthy("v"), F.lit(False)).alias("t")).collect()
    assert {c: r.t for c, r in zip(cases, got)} == cases
    sale = json_values(spark, ["0", '"7"']).select(N.format_sale_values([F.col("v"), N.text_value(F.lit("8"))], F.lit("USD")).alias("s")).collect()
    assert [r.s for r in sale] == ["8USD", "7USD"]


def test_size_kinds(spark):
    cases = {'["S"," M ","S",4]': "S, M", '[["S","M"],["L"," S "],"XL"]': "S, M, L, XL", '" One size "': "One size", '[]': None, '[4]': None, '7': None, '[[["deep"]]]': None}
    got = json_values(spark, cases).select(N.normalize_size(("v", N.JSON_VALUE)).alias("s")).collect()
    assert {c: r.s for c, r in zip(cases, got)} == cases


def test_gender_women_first(spark):
    rows = [("WOMAN",), ("Man",), (" girls ",), ("KID",), ("unisex",), ("female",), ("Ornament",),
            ("",), (None,)]
    got = one(spark, N.normalize_gender("g"), rows, "g string")
    assert got == ["women", "men", "women", "KID", "unisex", "women", "men", None, None]


def test_size_and_availability(spark):
    rows = [(["S", "M", "S"],), ([" L ", "", "XL"],), ([""],), ([],), (None,)]
    assert one(spark, N.normalize_size(("s", "array<string>")), rows, "s array<string>") == ["S, M", "L, XL", None, None, None]
    rows = [("In Stock", None), (" sold out ", None), ("preorder", None), ("weird", None), (None, None),
            (None, True), ("in stock", False)]
    got = one(spark, N.normalize_availability("a", "b"), rows, "a string, b boolean")
    assert got == ["in_stock", "out_of_stock", "unknown", "unknown", "unknown", "in_stock", "out_of_stock"]


def test_product_id(spark):
    import hashlib
    rows = [("s", "E1", None), (None, "E1", None), ("s", "", "u"), ("s", None, None)]
    got = one(spark, N.product_id("src", "e", None, "u"), rows, "src string, e string, u string")
    h = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got == [h("s:E1"), h("zara:E1"), h("s:u"), "unknown"]


def test_info_text_reference_row(spark):
    row = [("Relaxed fit hoodie",
            "Hoodie made of cotton fabric with a brushed interior. Hooded collar and long sleeves.",
            "sweatshirts, sweatpants", "Zara", "women", "29.99USD", None, "S, M, L",
            '{"country": "us", "merchant_name": "Zara"}')]
    df = spark.createDataFrame(row, "title string, description string, category string, brand string, "
                                    "gender string, price string, sale string, size string, meta string")
    df = df.withColumn("metadata", F.from_json("meta", "map<string,string>"))
    got = df.select(N.build_info_text("title", "description", "category", "brand", "size", "gender",
                                      "price", "sale", None, "metadata")).first()[0]
    assert got == ("Relaxed fit hoodie Hoodie made of cotton fabric with a brushed interior. Hooded collar "
                   "and long sleeves. sweatshirts, sweatpants Zara Size: S, M, L women Price: 29.99USD "
                   "country: us merchant_name: Zara")


def test_gallery(spark):
    df = spark.createDataFrame([([" a ", "b", "a", ""], None), ([], "x"), (["a"], "given")],
                               "m array<string>, img string")
    main, extra = N.image_gallery("m", "img")
    got = [tuple(r) for r in df.select(main, extra).collect()]
    assert got == [("a", ["b"]), ("x", None), ("given", None)]


def test_image_urls(spark):
    rows = [("//img.example/x-s/w/{width}/y-{width}.jpg",), ("cdn.example//a//b/",),
            ("https://static.zara.net/p.jpg",), ("https://cdn.example/v/video.mp4",),
            ("https://cdn.example/data.JSON",), ("data:image/png",)]
    assert one(spark, N.clean_image_url("u"), rows[:2], "u string") == [
        "https://img.example/x-s/w/800/y-{width}.jpg", "cdn.example//a/b"]
    assert one(spark, N.is_embeddable_image_url("u"), rows, "u string") == [
        True, True, False, False, False, False]


def test_urls(spark):
    rows = [("/x", "https://h.example/a/b?q=1"), ("y", "https://h.example/a/b"), ("//o.example/z", "http://h/"),
            ("?p=2", "https://h.example/a?q=1#f"), ("https://abs.example", "https://h.example/")]
    got = one(spark, U.resolve_url("h", "p"), rows, "h string, p string")
    assert got == ["https://h.example/x", "https://h.example/a/y", "http://o.example/z",
                   "https://h.example/a?p=2", "https://abs.example"]
    assert one(spark, U.append_query_flag("u"), [("a?x=1",), ("a",), ("a?ajax=true",)], "u string") == [
        "a?x=1&ajax=true", "a?ajax=true", "a?ajax=true"]
    assert one(spark, U.product_handle("u"), [("https://s/products/hoodie-1?v=2",), ("https://s/p/1",)],
               "u string") == ["hoodie-1", None]
    assert one(spark, U.card_product_id("t"), [("plp-productCard-6806189605066-select",),
                                                ("plp-productCard-Wishlist-1",)], "t string") == [
        "6806189605066", "plp-productCard-Wishlist-1"]


def test_pick_image_strict_and_lenient(spark):
    df = spark.createDataFrame([("data:a", "https://i/x.jpg"), ("data:a", "https://i/x-e1.jpg"), (None, None)],
                               "a string, b string")
    strict = [r[0] for r in df.select(N.pick_image_url(["a", "b"])).collect()]
    lenient = [r[0] for r in df.select(N.pick_image_url(["a", "b"], strict=False)).collect()]
    assert strict == [None, "https://i/x-e1.jpg", None]
    assert lenient == ["https://i/x.jpg", "https://i/x-e1.jpg", None]

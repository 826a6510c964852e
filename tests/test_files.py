"""File sources and the sink rendering."""

from pyspark.sql import functions as F

from shelfline.operators.rows import render_for_sink
from shelfline.sources.files import read_feed_documents, read_pages, read_sitemaps
from shelfline.sources.feeds import read_feed_items
from shelfline.sources.pages import page_links


def test_file_sources(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.json").write_text('{"products":[{"id":"1","name":"A"},{"id":"2","name":"B"}]}')
    (tmp_path / "f" / "b.json").write_text("{bad")
    feeds = read_feed_documents(spark, str(tmp_path / "f"))
    assert read_feed_items(feeds).count() == 2
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "x.html").write_text('<a href="/q">q</a>')
    urls = spark.createDataFrame([(str(tmp_path / "p" / "x.html"), "https://s.example/a/b")],
                                 "path string, url string")
    pages = read_pages(spark, str(tmp_path / "p"), urls)
    assert [r.link for r in page_links(pages).collect()] == ["https://s.example/q"]
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "m.xml").write_text("<urlset><url><loc>https://s/1</loc></url></urlset>")
    assert read_sitemaps(spark, str(tmp_path / "s")).first().xml.startswith("<urlset>")


def test_render_for_sink(spark):
    df = spark.createDataFrame([(["a", "b"], {"country": "us"})], "additional_images array<string>, metadata map<string,string>")
    r = render_for_sink(df).first()
    assert r.additional_images == '["a","b"]' and r.metadata == '{"country":"us"}'


def test_documents_arrive_in_path_order(spark, tmp_path):
    """Without configured endpoints the first path wins a repeated id, and a limit takes the first paths' items."""
    from shelfline.plans.catalog import feed_products
    from shelfline.plans.fixtures import FEED_MAPPING, SITE
    from shelfline.sources.files import read_feed_documents
    for name, price in (("b", "2"), ("a", "1"), ("c", "3")):
        item = '{"id":"1","seo":{"discernProductId":"A"},"name":"n","price":"%s","xmedia":[{"url":"https://i/1-s.jpg"}]}' % price
        (tmp_path / f"{name}.json").write_text('{"products":[' + item + "]}")
    docs = read_feed_documents(spark, str(tmp_path))
    assert [r.price for r in feed_products(docs, SITE, FEED_MAPPING).collect()] == ["1USD"]
    assert [r.price for r in feed_products(docs, SITE, FEED_MAPPING, limit=1).collect()] == ["1USD"]


def test_images_are_read_as_bytes_and_embedded(spark, tmp_path):
    import numpy as np

    from shelfline.operators.vectors import embed_column
    from shelfline.plans.catalog import embed_products
    from shelfline.sources.files import read_images
    contents = {"a.jpg": b"\x89PNG\r\n\x00\xff", "b.jpg": b"", "c.jpg": b"not a picture", "d.jpg": b"\x89PNG" * 100}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    urls = spark.createDataFrame([(str(tmp_path / n), f"https://i.example/{n}") for n in contents], "path string, url string")
    images = read_images(spark, str(tmp_path), urls, max_bytes=300)
    got = {r.image_url[-5:]: (r.length, r.content) for r in images.collect()}
    assert got == {"a.jpg": (8, contents["a.jpg"]), "c.jpg": (13, b"not a picture"), "d.jpg": (400, None)}

    seen = spark.sparkContext.accumulator(0)

    def factory():
        def encode(batch):
            if not all(x.startswith(b"\x89PNG") for x in batch):
                raise ValueError("no picture")
            seen.add(len(batch))
            return np.array([[len(x), x[-1]] for x in batch])
        return encode
    vectors = {r.image_url[-5:]: r.v for r in embed_column(images, "content", factory, "v", 2).collect()}
    assert vectors == {"a.jpg": [8.0, 255.0], "c.jpg": None, "d.jpg": None}

    before = seen.value
    products = spark.createDataFrame([(1, "https://i.example/a.jpg"), (2, "//i.example/a.jpg"), (3, "https://i.example/c.jpg"), (4, "https://i.example/gone.jpg"),
                                      (5, None), (6, "https://i.example/a.mp4")], "id int, image_url string")
    twice = images.unionByName(images)
    out = {r.id: r.image_embedding for r in embed_products(products, image_encoder_factory=factory, dim=2, images=twice).collect()}
    assert out == {1: [8.0, 255.0], 2: [8.0, 255.0], 3: None, 4: None, 5: None, 6: None}
    assert seen.value - before == 1  # each image once

"""Scale properties checked on the physical plans (not just the results)."""

import os

import pytest

from shelfline.plans.explain import plan_text, summarise

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def q(spark, name):
    import __spark_entry__ as E
    return E.queries()[name](spark, SF)


def test_building_a_run_starts_no_job(spark):
    from shelfline.operators.maintain import pending_embeddings
    from shelfline.plans import fixtures as FX
    from shelfline.plans.catalog import feed_run
    from shelfline.plans.queries import FEED_SITE, catalog, raw
    part = FX.table(spark, SF, "part")
    feeds, table = FX.feeds(raw(spark, SF)), catalog(spark, SF).drop("endpoint_pos", "item_pos")
    sc = spark.sparkContext
    sc.setJobGroup("building", "")
    try:
        feed_run(feeds, FEED_SITE, FX.FEED_MAPPING, table=table, sync=True)
        pending_embeddings(FX.maintenance_target(part), FX.maintenance_batch(part))
        assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        sc._jsc.sc().clearJobGroup()


def test_cards_are_filled_without_a_join_in_one_scan(spark):
    s = summarise(plan_text(q(spark, "match_cards_to_embedded")))
    assert len(s["scans"]) == 1 and "Join" not in plan_text(q(spark, "match_cards_to_embedded"))


def test_discovery_jobs_scan_html_once(spark):
    for name in ("category_links", "html_endpoints", "product_url_scan", "page_links"):
        scans = [x for x in summarise(plan_text(q(spark, name)))["scans"] if x["table"] == "pages.parquet"]
        assert len(scans) == 1, name


def test_topk_limits_before_the_exchange(spark):
    text = plan_text(q(spark, "cosine_topk"))
    before_exchange = text.split("Exchange", 1)[1]
    assert "WindowGroupLimit" in before_exchange


def test_reads_prune_columns_and_partitions(spark):
    s = summarise(plan_text(q(spark, "count_by_source")))
    assert s["scans"][0]["read"] == "struct<p_partkey:bigint,p_size:int>"
    text = plan_text(q(spark, "read_products_table"))
    assert "PartitionFilters: [isnotnull(source" in text and "(source#" in text
    assert "ReadSchema: struct<id:string,title:string,brand:string>" in text
    s = summarise(plan_text(q(spark, "recent_products")))
    assert "EqualTo(o_orderstatus,F)" in s["scans"][0]["pushed"]


def test_dedup_limits_each_key_before_the_exchange(spark):
    assert "WindowGroupLimit" in plan_text(q(spark, "dedup_first")).split("Exchange", 1)[1]


def test_no_python_in_normalisers(spark):
    for name in ("to_product_row", "feed_run", "extract_cards", "category_links"):
        assert not summarise(plan_text(q(spark, name)))["python"], name

"""Table maintenance: upsert, prune, pending vectors, de-dup properties."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfline.operators.dedup import dedup_first, ordered_distinct
from shelfline.operators.maintain import upsert_products, prune_missing, pending_embeddings


def target(spark):
    return spark.createDataFrame(
        [("a", "s1", "A", "1USD", [1.0]), ("b", "s1", "B", "2USD", [2.0]), ("c", "s2", "C", "3USD", [3.0])],
        "id string, source string, title string, price string, image_embedding array<float>")


def batch(spark):
    return spark.createDataFrame(
        [("a", "s1", "9USD", None, [0.5]), ("d", "s1", "4USD", None, [9.0])],
        "id string, source string, price string, image_embedding array<float>, embedding array<float>")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_keeps_missing_columns_and_nulls_given(spark):
    out = {r.id: r for r in upsert_products(target(spark), batch(spark)).collect()}
    assert out["a"].title == "A" and out["a"].price == "9USD" and out["a"].image_embedding is None
    assert out["d"].title is None and out["d"].price == "4USD"
    assert out["c"].price == "3USD"
    assert "embedding" not in upsert_products(target(spark), batch(spark)).columns


def test_upsert_twice_is_once(spark):
    once = upsert_products(target(spark), batch(spark))
    twice = upsert_products(once, batch(spark))
    assert rows(once) == rows(twice)


def test_prune_scoped_and_empty_batch(spark):
    t = target(spark)
    ids = spark.createDataFrame([("a",)], "id string")
    assert sorted(r.id for r in prune_missing(t, ids, "s1").collect()) == ["a", "c"]
    empty = spark.createDataFrame([], "id string")
    assert rows(prune_missing(t, empty, "s1")) == rows(t)


def test_pending(spark):
    b = spark.createDataFrame([("d", "u", None), ("e", "v", [1.0]), ("a", "w", None)],
                              "id string, image_url string, image_embedding array<float>")
    assert [tuple(r) for r in pending_embeddings(target(spark), b).collect()] == [("d", "u")]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 50)), min_size=1, max_size=30))
def test_dedup_first_matches_python_and_is_idempotent(spark, data):
    pairs = [(k, i, f"v{j}") for j, (k, i) in enumerate(data)]
    df = spark.createDataFrame(pairs, "k int, pos int, v string").withColumn("pos2", F.monotonically_increasing_id())
    once = dedup_first(df, "k", ["pos", "pos2"])
    expected = {}
    for k, i, v in sorted(pairs, key=lambda t: (t[1], int(t[2][1:]))):
        expected.setdefault(k, v)
    assert {r.k: r.v for r in once.collect()} == expected
    assert rows(dedup_first(once, "k", ["pos", "pos2"])) == rows(once)


def test_ordered_distinct_first_positions(spark):
    df = spark.createDataFrame([("x", 3), ("y", 1), ("x", 0), ("y", 7)], "url string, pos int")
    assert rows(ordered_distinct(df, "url", ["pos"])) == [("x", 0), ("y", 1)]


def test_bucketed_maintenance(spark, tmp_path):
    from shelfline.plans.catalog import maintain_products
    from shelfline.sources.table import PartitionedTable
    schema = "id string, source string, title string, price string"
    import datetime as dt
    t = PartitionedTable(spark, str(tmp_path / "t"), "id", buckets=4, scope="source")
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    maintain_products(t, spark.createDataFrame(
        [("a", "s1", "A", "1"), ("b", "s1", "B", "2"), ("c", "s2", "C", "3"), ("d", "s1", "D", "4")], schema), "s1",
        run_ts=t0)
    run = spark.createDataFrame([("a", "s1", "A2", "9"), ("e", "s1", "E", "5")], schema)
    maintain_products(t, run, "s1", run_ts=t1)
    stamps = {r.id: (r.created_at, r.last_seen) for r in t.read().collect()}
    assert stamps["a"] == (t0, t1) and stamps["e"] == (t1, t1) and stamps["c"] == (t0, t0)
    run = spark.createDataFrame([("a", "s1", "A2", "9")], schema)
    maintain_products(t, run, "s1", sync=True, run_ts=t1)
    assert rows(t.read().select("id", "source", "title", "price")) == [("a", "s1", "A2", "9"), ("c", "s2", "C", "3")]
    maintain_products(t, run, "s1", sync=True)  # replay of the same change
    assert rows(t.read().select("id", "source", "title", "price")) == [("a", "s1", "A2", "9"), ("c", "s2", "C", "3")]
    maintain_products(t, spark.createDataFrame([], schema), "s1", sync=True)  # empty run
    assert t.read().count() == 2


def test_a_change_replaces_only_its_partitions(spark, tmp_path):
    import os
    from shelfline.sources.table import PartitionedTable
    t = PartitionedTable(spark, str(tmp_path / "t"), "id", buckets=4, scope="source")
    schema = "id string, source string, v int"

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "t") for f in fs if f.endswith(".parquet")}

    for n in range(3):
        t.merge(spark.createDataFrame([(f"i{i}", f"s{i % 3}", n) for i in range(200)], schema).repartition(8), lambda cur, b: b)
    assert t.read().count() == 200 and {r.v for r in t.read().collect()} == {2}
    before = files()
    t.merge(spark.createDataFrame([("i0", "s0", 9)], schema), lambda cur, b: upsert_products(cur, b))
    assert len(before - files()) == len(files() - before) == 1
    assert t.read().count() == 200 and t.read().filter("v = 9").count() == 1
    t.merge(spark.createDataFrame([], schema), lambda cur, b: b)
    assert t.read().count() == 200


def test_columns_may_be_added_and_scopes_look_like_anything(spark, tmp_path):
    from shelfline.sources.table import PartitionedTable
    t = PartitionedTable(spark, str(tmp_path / "t"), "id", buckets=2, scope="source")
    assert t.read() is None and not t.exists()
    names = ["007", "2024-01-01", "a/b=c", "", None, "true"]
    t.merge(spark.createDataFrame([(f"i{i}", s) for i, s in enumerate(names)], "id string, source string"), lambda cur, b: b)
    t.merge(spark.createDataFrame([("i0", "007", 5)], "id string, source string, price int"), lambda cur, b: upsert_products(cur, b))
    got = {r.id: (r.source, r.price) for r in t.read().collect()}
    assert got == {f"i{i}": (s or None, 5 if i == 0 else None) for i, s in enumerate(names)}  # '' and null share a folder
    assert t.delete_missing("a/b=c", spark.createDataFrame([("other",)], "id string")) == 1
    assert sorted(r.id for r in t.read().collect()) == ["i0", "i1", "i3", "i4", "i5"]  # a partition left empty
    t.merge(spark.createDataFrame([("i2", "a/b=c", 1)], "id string, source string, price int"), lambda cur, b: upsert_products(cur, b))
    assert t.read().count() == 6


def test_delete_missing_rewrites_only_losing_partitions(spark, tmp_path):
    from shelfline.sources.table import PartitionedTable
    t = PartitionedTable(spark, str(tmp_path / "t"), "id", buckets=8, scope="source")
    rows_ = [(f"i{n}", "s") for n in range(40)]
    t.merge(spark.createDataFrame(rows_, "id string, source string"), lambda cur, b: b)
    keep_all = spark.createDataFrame([(r[0],) for r in rows_], "id string")
    assert t.delete_missing("s", keep_all) == 0
    keep = spark.createDataFrame([(r[0],) for r in rows_ if r[0] != "i7"], "id string")
    assert t.delete_missing("s", keep) == 1
    assert t.read().count() == 39


def test_results_do_not_depend_on_the_join_strategy(spark):
    """Broadcast or shuffled, with repeated ids on either side, the rows are the same."""
    t = target(spark).union(spark.createDataFrame([("a", "s1", "A again", "7USD", [4.0])], target(spark).schema))
    b = batch(spark).union(spark.createDataFrame([("a", "s1", "8USD", [1.0], None), (None, "s1", "1USD", None, None)], batch(spark).schema))
    ids = spark.createDataFrame([("a",), ("a",)], "id string")

    def outcome():
        return (rows(upsert_products(t, b.withColumn("pos", F.monotonically_increasing_id()), order="pos").drop("title")),
                rows(prune_missing(target(spark), ids, "s1")), rows(pending_embeddings(target(spark), b.withColumn("image_url", F.lit("u")))))

    small = outcome()
    assert [r[0] for r in small[0]] == ["a", "b", "c", "d"]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert outcome() == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_repeated_batch_ids_are_inserted_once(spark):
    b = spark.createDataFrame([("d", "s1", "1USD"), ("d", "s1", "2USD")], "id string, source string, price string")
    assert upsert_products(target(spark), b).filter("id = 'd'").count() == 1
    first = upsert_products(target(spark), b.withColumn("pos", F.substring("price", 1, 1)), order="pos").filter("id = 'd'").first()
    assert first.price == "1USD" and "pos" not in first.asDict()


_ids = st.sampled_from([f"i{n}" for n in range(12)])
_src = st.sampled_from(["s1", "s2", None])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(_ids, _src, st.integers(0, 9)), min_size=1, max_size=15, unique_by=lambda t: t[0]),
       st.lists(st.tuples(_ids, st.integers(0, 9)), max_size=10, unique_by=lambda t: t[0]))
def test_properties_upsert_idempotent_and_prune_scoped(spark, table_rows, batch_rows):
    t = spark.createDataFrame([(i, s, str(v)) for i, s, v in table_rows], "id string, source string, price string")
    b = spark.createDataFrame([(i, "s1", str(v)) for i, v in batch_rows], "id string, source string, price string")
    once = upsert_products(t, b)
    assert rows(upsert_products(once, b)) == rows(once)
    pruned = prune_missing(once, b.select("id"), "s1")
    others = lambda df: rows(df.filter("source IS NULL OR source <> 's1'"))
    assert others(pruned) == others(once)
    kept_ids = {r.id for r in pruned.filter("source = 's1'").collect()}
    if batch_rows:
        assert kept_ids <= {i for i, _ in batch_rows}
    else:
        assert rows(pruned) == rows(once)

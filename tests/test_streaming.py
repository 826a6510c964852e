"""The streamed table equals the batch result; pending vectors per micro-batch."""

from pyspark.sql import functions as F

from shelfline.operators.dedup import dedup_last
from shelfline.streaming.upsert import stream_upsert, read_pending

SCHEMA = "user_id long, event_id long, ts long, value double"


def test_stream_equals_batch_and_pending(spark, tmp_path):
    src = str(tmp_path / "in")
    batches = [[(1, 1, 10, 1.0), (2, 2, 11, None)], [(1, 3, 12, None), (3, 4, 13, None), (2, 5, 9, 5.0)],
               [(4, 6, 14, 2.0)]]
    allrows = []
    for b in batches:
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        allrows += b
    ev = spark.createDataFrame(allrows, SCHEMA)
    table = stream_upsert(spark, src, ev.schema, str(tmp_path / "t"), str(tmp_path / "c"), "user_id",
                          ["ts", "event_id"], pending_dir=str(tmp_path / "p"), vector="value",
                          max_files_per_trigger=1)
    got = sorted(tuple(r) for r in table.read().select("user_id", "event_id", "ts", "value").collect())
    want = sorted(tuple(r) for r in dedup_last(ev, "user_id", ["ts", "event_id"]).collect())
    assert got == want
    pend = sorted((r.user_id, r.event_id) for r in read_pending(spark, str(tmp_path / "p")).collect())
    assert pend == [(2, 2), (3, 4)]


def test_epoch_replay_and_restart_are_idempotent(spark, tmp_path):
    from shelfline.sources.table import PartitionedTable
    from shelfline.streaming.upsert import upsert_newest
    t = PartitionedTable(spark, str(tmp_path / "t"), "user_id", buckets=4)
    b1 = spark.createDataFrame([(1, 1, 10, 1.0), (2, 2, 11, 2.0)], SCHEMA)
    b2 = spark.createDataFrame([(1, 3, 12, 3.0)], SCHEMA)
    merge = lambda cur, b: upsert_newest(cur, b, "user_id", ["ts", "event_id"])
    t.merge(b1, merge)
    t.merge(b2, merge)
    once = sorted(tuple(r) for r in t.read().select("user_id", "event_id").collect())
    t.merge(b2, merge)  # the same epoch again, as after a failure
    assert sorted(tuple(r) for r in t.read().select("user_id", "event_id").collect()) == once == [(1, 3), (2, 2)]

    src = str(tmp_path / "in")
    spark.createDataFrame([(5, 9, 1, 1.0)], SCHEMA).write.parquet(src)
    ev_schema = spark.read.parquet(src).schema
    args = (spark, src, ev_schema, str(tmp_path / "s"), str(tmp_path / "c"), "user_id", ["ts", "event_id"])
    first = stream_upsert(*args)
    stream_upsert(*args)  # restart on the same checkpoint: nothing new to process
    assert first.read().count() == 1


def send(spark, src, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)


def test_pending_queue_survives_a_replay_after_the_merge(spark, tmp_path, monkeypatch):
    """An epoch that fails after its merge is replayed; its rows are no longer new, the queue keeps them."""
    from shelfline.sources.table import PartitionedTable
    src = str(tmp_path / "in")
    send(spark, src, [(1, 1, 10, None), (2, 2, 11, 2.0)])
    args = (spark, src, spark.read.parquet(src).schema, str(tmp_path / "t"), str(tmp_path / "c"), "user_id", ["ts", "event_id"])
    merge = PartitionedTable.merge

    def merge_then_fail(self, *a):
        merge(self, *a)
        raise RuntimeError("lost after the merge")

    monkeypatch.setattr(PartitionedTable, "merge", merge_then_fail)
    try:
        stream_upsert(*args, pending_dir=str(tmp_path / "p"), vector="value")
    except Exception as e:  # noqa: BLE001 - the stream wraps it
        assert "lost after the merge" in str(e)
    monkeypatch.undo()
    table = stream_upsert(*args, pending_dir=str(tmp_path / "p"), vector="value")
    assert [(r.user_id, r.event_id) for r in read_pending(spark, str(tmp_path / "p")).collect()] == [(1, 1)]
    assert table.read().count() == 2


def test_pending_queue_is_replayed_and_restarted(spark, tmp_path, monkeypatch):
    """An epoch whose output was lost writes the same rows again; later runs go on from the kept state; late rows change nothing."""
    from shelfline.streaming import upsert
    src, pending = str(tmp_path / "in"), str(tmp_path / "p")
    send(spark, src, [(1, 1, 10, 1.0), (1, 2, 12, None), (1, 3, 11, 1.0), (2, 4, 10, None), (2, 5, 11, 2.0)])
    schema = spark.read.parquet(src).schema
    args = (spark, src, schema, pending, str(tmp_path / "c"), "user_id", ["ts", "event_id"], "value")
    run = upsert._run

    def lost(arrivals, checkpoint_dir, handle):
        def write_then_fail(batch, epoch_id):
            handle(batch, epoch_id)
            raise RuntimeError("lost after the write")
        run(arrivals, checkpoint_dir, write_then_fail)

    monkeypatch.setattr(upsert, "_run", lost)
    try:
        upsert.stream_pending(*args)
    except Exception as e:  # noqa: BLE001 - the stream wraps it
        assert "lost after the write" in str(e)
    monkeypatch.undo()

    def queue():
        return sorted((r.user_id, r.event_id, r.epoch) for r in read_pending(spark, pending).collect())

    upsert.stream_pending(*args)
    assert queue() == [(1, 2, 0)]  # the last row of a key's first epoch
    send(spark, src, [(1, 9, 50, None), (2, 0, 1, None), (3, 6, 5, None)])
    upsert.stream_pending(*args)
    upsert.stream_pending(*args)
    assert queue() == [(1, 2, 0), (3, 6, 1)]


def test_keys_of_the_table_are_not_pending(spark, tmp_path):
    """A queue that starts beside a full table takes its keys as seen; the table is not read again."""
    from shelfline.sources.table import PartitionedTable
    from shelfline.streaming import upsert
    table = PartitionedTable(spark, str(tmp_path / "t"), "user_id", buckets=4)
    table.merge(spark.createDataFrame([(1, 1, 10, None), (2, 2, 11, 2.0)], SCHEMA), lambda cur, b: b)
    src, pending = str(tmp_path / "in"), str(tmp_path / "p")
    send(spark, src, [(1, 5, 20, None), (3, 6, 20, None)])
    args = (spark, src, spark.read.parquet(src).schema, pending, str(tmp_path / "c"), "user_id", ["ts", "event_id"], "value", table)
    upsert.stream_pending(*args)
    table.merge(spark.createDataFrame([(4, 1, 10, None)], SCHEMA), lambda cur, b: b if cur is None else upsert.upsert_newest(cur, b, "user_id", ["ts", "event_id"]))
    send(spark, src, [(4, 7, 30, None), (2, 8, 30, None)])
    upsert.stream_pending(*args)
    assert sorted((r.user_id, r.event_id) for r in read_pending(spark, pending).collect()) == [(3, 6), (4, 7)]


def test_a_product_sent_again_takes_its_new_values(spark, tmp_path):
    from shelfline.plans.fixtures import FEED_MAPPING, SITE
    from shelfline.streaming.upsert import stream_feed_run
    src = str(tmp_path / "in")

    def send(pos, price, extra=""):
        item = '{"id":"1","seo":{"discernProductId":"A"},"name":"n","price":"%s","xmedia":[{"url":"https://i/1-s.jpg"}]%s}' % (price, extra)
        spark.createDataFrame([(0, "e", pos, '{"products":[' + item + "]}")], "endpoint_pos int, endpoint string, page int, payload string") \
            .coalesce(1).write.mode("append").parquet(src)

    send(0, "10", ',"sale":"9"')
    send(1, "12")
    table = stream_feed_run(spark, src, spark.read.parquet(src).schema, str(tmp_path / "t"), str(tmp_path / "c"),
                            {k: v for k, v in SITE.items() if k != "source"}, FEED_MAPPING, max_files_per_trigger=1)
    assert [(r.price, r.sale) for r in table.read().collect()] == [("12USD", None)]


def test_late_rows_change_nothing_and_new_columns_are_kept(spark):
    from shelfline.streaming.upsert import upsert_newest
    cur = spark.createDataFrame([(1, 5, 50, 1.0)], SCHEMA)
    batch = spark.createDataFrame([(1, 4, 40, 9.0, "x"), (2, 6, 60, None, "y")], SCHEMA + ", note string")
    got = sorted(tuple(r) for r in upsert_newest(cur, batch, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "value", "note").collect())
    assert got == [(1, 5, 1.0, None), (2, 6, None, "y")]

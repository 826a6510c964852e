import math
import re
from collections import defaultdict

import pytest
from cases import clashing, rows, table
from pyspark.sql import functions as F

from shelfline.llm.mixing import mix_sources, source_targets


def shared_out(sizes: list[int], weights=(5, 2, 1), epochs=3) -> list[float]:
    """Share by weight, cap, share the excess again."""
    total, target = sum(sizes), [0.0] * len(sizes)
    capped: set[int] = set()
    while True:
        room = total - sum(epochs * sizes[i] for i in capped)
        rest = [i for i in range(len(sizes)) if i not in capped]
        weight = sum(weights[i % len(weights)] for i in rest)
        for i in rest:
            target[i] = room * weights[i % len(weights)] / weight
        over = {i for i in rest if target[i] > epochs * sizes[i]}
        for i in over:
            target[i] = float(epochs * sizes[i])
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10, 10], [1, 100, 1000, 5], [1000, 1, 1, 1, 1, 1, 1], [7], [0, 0], [0, 50, 3]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i:02d}", s) for i, s in enumerate(sizes)], "source string, source_size long")
    got = [r["target"] for r in source_targets(df).orderBy("source").collect()]
    assert got == pytest.approx(shared_out(sizes))
    assert sum(got) == pytest.approx(sum(sizes))


def test_mix_is_near_its_targets_and_stable(spark):
    docs = clashing(table(spark, rows()))
    first = mix_sources(docs).select("doc_id", "text", "source", "size", "source_size", "target", "copies", "taken").collect()
    again = mix_sources(docs.repartition(5)).select("doc_id", "text", "source", "size", "source_size", "target", "copies", "taken").collect()
    key = lambda r: str(tuple(r))
    assert sorted(map(key, first)) == sorted(map(key, again))
    assert len(first) == len(rows())
    by = defaultdict(list)
    for r in first:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        by[r["source"]].append(r)
    order = sorted(by, key=lambda s: (s is None, s))
    want = shared_out([sum(r["size"] for r in by[s]) for s in order])
    for s, t in zip(order, want):
        assert by[s][0]["target"] == pytest.approx(t)
        assert by[s][0]["source_size"] == sum(r["size"] for r in by[s])
        assert abs(sum(r["taken"] for r in by[s]) - t) <= max(r["size"] for r in by[s]) / 2 + 1e-6
        spans = [r["copies"] for r in by[s] if r["size"]]
        assert not spans or max(spans) - min(spans) <= 1  # whole epochs first


def test_clashing_columns_and_empty(spark):
    docs = clashing(table(spark, rows()))
    out = mix_sources(docs)
    assert out.filter("row = 'mine' and key = 'mine'").count() == docs.count()
    assert mix_sources(table(spark, [])).count() == 0
    only_empty = mix_sources(table(spark, [(1, None, None, None, None), (2, "", "en", "a", 0)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in only_empty] == [(0, 0.0, 0)] * 2


def test_quality_steers_the_draw(spark):
    """Documents of letters are drawn before documents of digits, by the weight of their keys."""
    docs = table(spark, [(i, ("word " if i % 2 else "1234 ") * 100, "en", "a", 500) for i in range(400)] +
                 [(1000 + i, "word " * 900, "en", "b", 500) for i in range(40)])
    got = mix_sources(docs, weights=(1, 8)).filter("source = 'a'").groupBy(F.col("doc_id") % 2).agg(F.sum("copies")).collect()
    taken = {r[0]: r[1] for r in got}
    assert taken[1] > 2 * taken[0] and math.isfinite(taken[0])


@pytest.mark.parametrize("ids", ["null", "repeated", "a third null"])
def test_rows_without_an_id_of_their_own(spark, ids):
    """Rows without a doc_id, or that share one, draw by their texts: taken words come near the target, and reruns agree."""
    def doc_id(i):
        return {"null": None, "repeated": i % 3, "a third null": None if i % 3 == 0 else i}[ids]

    data = [(doc_id(i), f"word{i} " * 20, "en", "a", None) for i in range(1000)] + [(5000 + i, "other words here", "en", "b", None) for i in range(800)]
    first, again = (sorted((r["source"], r["text"], r["taken"], r["size"], r["target"]) for r in mix_sources(table(spark, data).repartition(n)).collect()) for n in (3, 7))
    assert first == again and len(first) == len(data)
    for source in ("a", "b"):
        rows_ = [r for r in first if r[0] == source]
        assert abs(sum(r[2] for r in rows_) - rows_[0][4]) <= 10 and {r[2] // r[3] for r in rows_} <= {0, 1, 2, 3}


def test_equal_rows_are_taken_together(spark):
    data = [(1, "same row here", "en", "a", None)] * 30 + [(i, f"row {i} here", "en", "a", None) for i in range(100, 130)] + [(900, "x " * 30, "en", "b", None)]
    got = mix_sources(table(spark, data), weights=(1, 3)).filter("source = 'a'").collect()
    assert len({r["copies"] for r in got if r["doc_id"] == 1}) == 1
    assert abs(sum(r["taken"] for r in got) - got[0]["target"]) <= 45


def test_sql_on_awkward_ids(spark, tmp_path):
    """The SQL states the same draw for null and repeated ids."""
    import duckdb

    from shelfline.llm.oracle import ORACLE
    from shelfline.llm.queries import REGISTRY
    data = [(None if i % 3 == 0 else i % 7, t, *rest) for i, (_, t, *rest) in enumerate(rows())]
    table(spark, data).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    sql = con.execute(ORACLE["op1_mix_sources"])
    names = [d[0] for d in sql.description]

    def plain(r):
        return str([round(x, 6) if isinstance(x, float) else x for x in r])

    assert sorted(map(plain, REGISTRY["op1_mix_sources"](spark, str(tmp_path)).select(*names).collect())) == sorted(map(plain, sql.fetchall()))

"""Exact vs IVF top-k, width checks and batch embedding."""

import numpy as np
from pyspark.sql import functions as F

from shelfline.operators import vectors as V


def corpus(spark, n=300, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=dim)]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, embedding array<float>")


def brute(df, qv, k):
    data = [(r.id, np.array(r.embedding, dtype=np.float64)) for r in df.collect()]
    q = np.array(qv) / np.linalg.norm(qv)
    scored = sorted(((-(v @ q) / np.linalg.norm(v), i) for i, v in data))
    return [i for _, i in scored[:k]]


def test_exact_matches_brute_force(spark):
    df = corpus(spark)
    q = spark.createDataFrame([(0, [1.0] * 16), (1, [(-1.0) ** i for i in range(16)])],
                              "query_id long, query_vec array<double>")
    got = V.cosine_topk(df, q, 7)
    for qid, qv in [(0, [1.0] * 16), (1, [(-1.0) ** i for i in range(16)])]:
        ids = [r.id for r in got.filter(F.col("query_id") == qid).orderBy("rank").collect()]
        assert ids == brute(df, qv, 7)


def test_ivf_all_cells_is_exact_and_recall(spark, tmp_path):
    df = corpus(spark)
    index = V.build_ivf_index(df, str(tmp_path / "ivf"), lists=8)
    q = df.limit(10).select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vec"))
    exact = {(r.query_id, r.id) for r in V.cosine_topk(df, q, 5).collect()}
    full = {(r.query_id, r.id) for r in V.ivf_topk(index, q, 5, nprobe=8).collect()}
    assert full == exact
    approx = {(r.query_id, r.id) for r in V.ivf_topk(V.read_ivf_index(spark, str(tmp_path / "ivf")), q, 5, nprobe=3).collect()}
    assert len(approx & exact) / len(exact) >= 0.6


def test_ivf_reads_only_probed_cells(spark, tmp_path):
    """One scan of the vectors, pruned at run time on the partition column; the counts stand beside the index."""
    import re

    from shelfline.plans.explain import plan_text
    df = corpus(spark, n=2000)
    index = V.build_ivf_index(df, str(tmp_path / "ivf"), lists=12)
    assert sorted(r["rows"] for r in index.cells.collect()) == sorted(r["count"] for r in index.vectors.groupBy("cell").count().collect())
    q = df.limit(2).select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vec"))
    found = V.ivf_topk(index, q, 5, nprobe=1)
    assert found.count() == 10 and found.collect()
    text = plan_text(found).split("Initial Plan")[0]
    scans = re.findall(r"Location: .*", plan_text(found))
    assert sum("ivf/vectors" in x for x in scans) == 2  # the final and the initial plan
    assert re.findall(r"dynamicpruningexpression\((.*?)\)", plan_text(found)) and "dynamicpruningexpression(true)" not in plan_text(found)
    assert "count(" not in text
    # The cells that are not probed can be gone.
    probed = {r.cell for r in V.assign_cells(q, np.array([c.centroid for c in index.cells.orderBy("cell").collect()]), "query_vec").collect()}
    import shutil
    for cell in set(range(12)) - probed:
        folder = tmp_path / "ivf" / "vectors" / f"cell={cell}"
        if folder.exists():
            for f in folder.glob("*.parquet"):
                f.write_bytes(b"unreadable")
    assert V.ivf_topk(index, q, 5, nprobe=1).count() == 10
    shutil.rmtree(tmp_path / "ivf")


def test_ivf_leaves_other_widths_out(spark, tmp_path):
    df = corpus(spark, n=100, dim=4)
    odd = df.union(spark.createDataFrame([(900, [1.0]), (901, None), (902, []), (903, [1.0] * 5)], df.schema))
    q = df.limit(4).select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vec"))
    index = V.build_ivf_index(odd, str(tmp_path / "ivf"), lists=4)
    assert index.vectors.count() == 100 and index.cells.agg(F.sum("rows")).first()[0] == 100
    key = ["query_id", "rank"]
    assert V.ivf_topk(index, q, 5, nprobe=4).select(*key, "id").orderBy(*key).collect() == V.cosine_topk(df, q, 5).select(*key, "id").orderBy(*key).collect()
    cells = {r.id: r.cell for r in V.assign_cells(odd, np.eye(4)).collect()}
    assert [cells[i] for i in (900, 901, 902, 903)] == [None] * 4 and None not in [cells[i] for i in range(100)]


def test_hot_cell_is_split(spark, tmp_path, monkeypatch):
    """A cell with most rows is searched in bounded pieces and found whole."""
    monkeypatch.setattr(V, "PIECE_ROWS", 50)
    rng = np.random.default_rng(8)
    rows = [(i, [1.0, float(rng.normal() / 10), 0.0]) for i in range(600)] + [(1000 + i, [0.0, 0.0, 1.0 + i]) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    index = V.build_ivf_index(df, str(tmp_path / "ivf"), centroids=np.array([[1.0, 0, 0], [0, 1.0, 0], [0, 0, 1.0]]))
    assert {r.cell: r["rows"] for r in index.cells.collect()} == {0: 600, 1: 0, 2: 20}
    q = spark.createDataFrame([(0, [1.0, 0.01, 0.0]), (1, [0.0, 0.0, 1.0])], "query_id long, query_vec array<double>")
    assert [tuple(r) for r in V.ivf_topk(index, q, 7, nprobe=3).orderBy("query_id", "rank").select("query_id", "id").collect()] == [
        tuple(r) for r in V.cosine_topk(df, q, 7).orderBy("query_id", "rank").select("query_id", "id").collect()]


def test_valid_vectors_and_embed(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [])], "id int, v array<float>")
    assert [r.v for r in V.valid_vectors(df, "v", 2).orderBy("id").collect()] == [[1.0, 2.0], None, None, None]
    t = spark.createDataFrame([(1, "red coat"), (2, "   "), (3, None)], "id int, text string")
    out = V.embed_column(t, "text", V.hashing_encoder_factory(32), "e", 32).orderBy("id").collect()
    assert len(out[0].e) == 32 and out[1].e is None and out[2].e is None
    bad = V.embed_column(t, "text", V.hashing_encoder_factory(16), "e", 32).orderBy("id").collect()
    assert all(r.e is None for r in bad)


def test_ties_at_the_kth_score_keep_smallest_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(10, 0, -1)] + [(100, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(3)
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, query_vec array<double>")
    got = [r.id for r in V.cosine_topk(df, q, 3).orderBy("rank").collect()]
    assert got == [1, 2, 3]


def test_exclude_self(spark):
    df = corpus(spark, n=60, dim=8)
    q = df.limit(5).select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vec"))
    out = V.cosine_topk(df, q, 3, exclude_self=True).collect()
    assert all(r.query_id != r.id for r in out)
    assert sorted({r.query_id for r in out}) == sorted(r.query_id for r in q.collect())
    assert all(sum(1 for r in out if r.query_id == qid) == 3 for qid in {r.query_id for r in out})


def test_one_bad_text_costs_only_its_own_vector(spark):
    def factory():
        def encode(texts):
            if "bad" in texts:
                raise ValueError("bad text")
            return np.array([[len(t), 1] for t in texts], dtype=np.float32)
        return encode
    t = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "ccc"), (4, "dd")], "id int, text string").coalesce(1)
    got = {r.id: r.e for r in V.embed_column(t, "text", factory, "e", 2).collect()}
    assert got == {1: [1.0, 1.0], 2: None, 3: [3.0, 1.0], 4: [2.0, 1.0]}


def test_empty_queries_and_other_widths(spark, tmp_path):
    df = corpus(spark, n=50, dim=8)
    none = spark.createDataFrame([], "query_id long, query_vec array<double>")
    assert V.cosine_topk(df, none, 3).count() == 0
    index = V.build_ivf_index(df, str(tmp_path / "ivf"), lists=4)
    assert V.ivf_topk(index, none, 3).count() == 0
    mixed = df.union(spark.createDataFrame([(900, [1.0]), (901, None), (902, [])], df.schema))
    q = spark.createDataFrame([(0, [1.0] * 8), (1, [2.0]), (2, None)], "query_id long, query_vec array<double>")
    got = V.cosine_topk(mixed, q, 2).collect()
    assert sorted((r.query_id, r["rank"]) for r in got) == [(0, 1), (0, 2), (1, 1)]
    assert [r.id for r in got if r.query_id == 1] == [900]


def test_partial_rows_are_bounded_by_tasks(spark, monkeypatch):
    """Each task passes on k rows per query, whatever its rows; blocks of queries give the same result."""
    seen = []
    final = V._final_topk
    monkeypatch.setattr(V, "_final_topk", lambda partial, k, id_col: seen.append(partial.count()) or final(partial, k, id_col))
    df = corpus(spark, n=2000, dim=8).repartition(3)
    q = df.limit(40).select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vec"))
    whole = sorted(map(tuple, V.cosine_topk(df, q, 5).select("query_id", "rank", "id").collect()))
    assert len(whole) == 200 and seen == [5 * 40 * 3]
    monkeypatch.setattr(V, "QUERY_BYTES", 10 * 96)
    assert sorted(map(tuple, V.cosine_topk(df, q, 5).select("query_id", "rank", "id").collect())) == whole
    assert seen[1] <= 5 * 40 * 3


def test_corpus_vectors_pass_no_exchange(spark):
    from shelfline.plans.explain import plan_text
    df = corpus(spark, n=50, dim=8)
    q = df.limit(4).select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vec"))
    text = plan_text(V.cosine_topk(df, q, 5))
    exchanges = [x for x in text.split("\n\n") if "Exchange" in x.split("\n")[0] and "Input" in x]
    assert exchanges and not any("embedding" in x for x in exchanges)


def test_many_ties_stay_bounded(spark):
    """Rows that all tie with the kth: a task still passes on k per query, the smallest ids."""
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(5000, 0, -1)], "id long, embedding array<float>").repartition(2)
    q = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0])], "query_id long, query_vec array<double>")
    assert sorted((r.query_id, r.id) for r in V.cosine_topk(df, q, 3).collect()) == [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3)]


def test_encoder_batches_are_bounded(spark):
    """Bytes and rows bound what an encoder gets; a batch that fails is halved."""
    def factory():
        def encode(texts):
            if len(texts) > 3 or sum(map(len, texts)) > 100 and len(texts) > 1 or "bad" in texts:
                raise ValueError("too much")
            return np.array([[len(t), len(texts)] for t in texts], dtype=np.float32)
        return encode
    texts = ["x" * 60, "y" * 30, "z" * 30, "bad", "b" * 200, None, " ", *["c"] * 10]
    t = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    got = {r.id: r.e for r in V.embed_column(t, "text", factory, "e", 2, batch_bytes=100, batch_rows=3).collect()}
    assert {i: e and e[0] for i, e in got.items()} == {i: None if x in ("bad", None, " ") else float(len(x)) for i, x in enumerate(texts)}
    assert max(e[1] for e in got.values() if e) == 3


def test_bytes_are_no_text(spark):
    """A binary column reaches the encoder as bytes, whatever they hold."""
    def factory():
        return lambda contents: np.array([[len(c), c[0]] for c in contents], dtype=np.float32)
    t = spark.createDataFrame([(1, bytearray(b"\xff\xd8\x00")), (2, bytearray(b"")), (3, None), (4, bytearray(b" "))], "id int, image binary")
    assert {r.id: r.e for r in V.embed_column(t, "image", factory, "e", 2).collect()} == {1: [3.0, 255.0], 2: None, 3: None, 4: [1.0, 32.0]}

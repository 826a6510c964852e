import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import embedding_dedup
from shelfline.llm.embedding_dedup import embedding_groups

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    out = [rng.standard_normal(16) for _ in range(400)]
    for spread, n in ((0.05, 2), (0.05, 3), (0.1, 30), (0.12, 400)):  # pairs to a large group
        base = rng.standard_normal(16)
        out += [base + spread * rng.standard_normal(16) for _ in range(n)]
    out += [out[0]] * 5 + [out[-1]] * 20 + [3 * out[1]]  # copies, and one of another length but the same direction
    return [(int(i), [float(np.float32(x)) for x in v], 0) for i, v in zip(rng.permutation(len(out)), out)]


def brute(data: list[tuple]) -> dict[int, tuple]:
    fine = {i: np.array(v, float) for i, v, _ in data
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in fine.items()}
    linked = {i: [j for j in unit if j != i and len(unit[j]) == len(unit[i]) and float(unit[i] @ unit[j]) >= 0.95] for i in unit}
    out = {}
    for i, *_ in data:
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in linked.get(todo.pop(), []) if j not in seen]
            seen.update(new)
            todo += new
        out[i] = (len(linked.get(i, [])), min(seen), i == min(seen))
    return out


ODD = [(2000, None, 0), (2001, [], 0), (2002, [0.0] * 16, 0), (2003, [None] + [1.0] * 15, 0), (2004, [float("nan")] + [1.0] * 15, 0),
       (2005, [float("inf")] + [1.0] * 15, 0), (2006, [1.0, 2.0], None), (2007, [2.0, 4.0], None), (2008, [1.0], 0)]


def test_against_brute_force(spark):
    data = vectors() + ODD
    df = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit("mine") for c in ("node", "n", "vec", "kept", "n_links", "u", "v", "sim")})
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_groups(df).collect()}
    want = brute(data)
    assert set(got) == set(want)
    pairs = sum(w[0] for w in want.values())
    assert pairs > 100_000 and sum(g[0] for g in got.values()) >= 0.99 * pairs  # recall of links
    assert all(got[i][0] <= want[i][0] for i in want)  # none below the threshold
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.99 * len(want)


def test_repeated_rows_and_ids(spark):
    data = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.001], 0), (None, [0.0, 1.0], 0)]
    got = sorted(((r["vec_id"] or -1, r["n_links"], r["component_id"]) for r in embedding_groups(spark.createDataFrame(data, SCHEMA)).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (1, 1, 1), (2, 2, 1), (-1, 1, 1)], key=str)


def test_empty_and_single(spark):
    assert embedding_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    got = embedding_groups(spark.createDataFrame([(4, [1.0, 1.0], 0)], SCHEMA)).collect()
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in got] == [(0, 4, True)]


@pytest.mark.parametrize("recall", [0.5, 1.0])
def test_what_does_not_settle_ends_exactly(spark, monkeypatch, recall):
    """Poor recall, or components that still change after the last round: blocks of all nodes give every link."""
    monkeypatch.setattr(embedding_dedup, "_audit", lambda *a: recall)
    monkeypatch.setattr(embedding_dedup, "ROUNDS", 1)
    monkeypatch.setattr(embedding_dedup, "SCAN", 100)
    data = vectors()[:500] + ODD
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_groups(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == brute(data)


def test_audit_counts_inside_links_in_place(spark):
    """Only links outside saturated components leave a task; the figure is that of all links."""
    from pyspark.sql import Row
    rng = np.random.default_rng(3)
    base = rng.standard_normal(8)
    vecs = [base + 0.01 * rng.standard_normal(8) for _ in range(60)] + [rng.standard_normal(8) for _ in range(20)]
    vecs += [vecs[60] * 1.5, vecs[61] * 2.0]
    nodes = spark.createDataFrame([Row(node=i, dim=8, vec=[float(x) for x in v]) for i, v in enumerate(vecs)])
    saturated = spark.createDataFrame([(i, 0) for i in range(60)], "node long, root long")
    listed = [(60, 80), (80, 60)]  # of the two pairs outside, one was found
    edges = spark.createDataFrame(listed, "u long, v long")
    assert embedding_dedup._audit(nodes, len(vecs), edges, saturated, 0.95) == pytest.approx(0.5)
    edges = spark.createDataFrame([*listed, (61, 81), (81, 61)], "u long, v long")
    assert embedding_dedup._audit(nodes, len(vecs), edges, saturated, 0.95) == pytest.approx(1.0)
    none = saturated.limit(0)
    assert embedding_dedup._audit(nodes, len(vecs), edges, none, 0.95) < 0.1


def twins(each: int = 40) -> list[tuple]:
    """Two tight groups, too large for a list, joined by weaker links only; and plenty of pairs."""
    rng = np.random.default_rng(5)
    out = [rng.standard_normal(16) for _ in range(200)]
    a, b = np.linalg.qr(rng.standard_normal((16, 2)))[0].T
    for base in (a, 0.96 * a + 0.28 * b):
        out += [base + 0.004 * rng.standard_normal(16) for _ in range(each)]
    return [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(out)]


def test_links_between_full_lists(spark):
    data = twins()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_groups(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == brute(data) and sum(x[0] >= 79 for x in got.values()) >= 60


def test_audit_is_not_filled_by_a_large_group(spark):
    """Every link of a saturated group counts as found; the missed pairs still show."""
    rng = np.random.default_rng(2)
    group, base = rng.standard_normal(16), [rng.standard_normal(16) for _ in range(20)]
    vectors_ = [group + 0.01 * rng.standard_normal(16) for _ in range(100)] + [x + 0.01 * rng.standard_normal(16) for x in base for _ in range(2)]
    nodes = spark.createDataFrame([(i, 16, [float(x) for x in v]) for i, v in enumerate(vectors_)], "node long, dim int, vec array<float>")
    saturated = spark.createDataFrame([(i, 0) for i in range(100)], "node long, root long")
    half = spark.createDataFrame([(100 + i, 100 + (i ^ 1)) for i in range(20)], "u long, v long")
    assert embedding_dedup._audit(nodes, 140, half, saturated, 0.95) == 0.5
    every = spark.createDataFrame([(100 + i, 100 + (i ^ 1)) for i in range(40)], "u long, v long")
    assert embedding_dedup._audit(nodes, 140, every, saturated, 0.95) == 1.0

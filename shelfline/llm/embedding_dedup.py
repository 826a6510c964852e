"""Operator 8, embedding near-dedup by NN-descent.

1. Equal vectors become one node with a count.
2. The first neighbour lists come from random-projection order: per table the
   nodes are sorted by the signs of random hyperplanes (dealt by range, so a
   large group of near copies spreads) and compared within runs of ``RUN``.
3. Rounds of local joins refine them: the neighbours of a node, forward and
   back, are compared with one another, and better pairs enter the lists
   (``K`` nearest of each node).
4. A link that a full list has no room for still joins its two nodes: before
   a list is cut, each comparison passes on the links that span what it saw,
   and each task a spanning forest of them.
5. A list that is full of links is saturated. The lists of its component are
   enlarged to the whole component: its members are compared in blocks, and
   only the number of links of each node is passed on, no pair.
6. Recall is audited by brute force: a bounded sample of ``AUDIT`` nodes as
   queries against all nodes, in blocks. It is the lower of two figures: the
   mean over nodes of the share of their links that were found, and that share
   over the links that no saturated component holds. Links inside saturated
   components are counted where they are found; only others leave a task.
   Rounds, each with another set of tables, go on until recall meets
   ``TARGET`` and neither the components nor the links outside saturated ones
   change. Should that take more than ``ROUNDS``, the rest is exact: all nodes
   are compared in blocks like the members of one component.

Links are pairs with a cosine of ``threshold`` or more in double precision,
none below it. Components come from a distributed search over them.

Defined results: a vector that is null, empty, zero, or holds a null or
non-finite component links with nothing and is its own component; vectors of
different length do not link; equal vectors link with one another; rows that
repeat a vec_id are vectors of their own that share the id; an empty table
gives an empty table. ``kept`` is vec_id = component_id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from shelfline.llm.common import shuffle_partitions, staged
from shelfline.llm.components import UnionFind, components

THRESHOLD = 0.95
K = 10
#: Of neighbours that are no links, a list takes the nearest few of each run.
FAR = 3
RUN = 192
TABLES = 8
ROUNDS = 8
AUDIT = 1024
TARGET = 0.98
SCAN = 1024
SEED = 7
_SALTS = 16
_LIST = "u long, v long, sim double"


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of unit length from a list column of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 1))
    m = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    m = m / np.abs(m).max(axis=1, keepdims=True)  # keeps tiny and huge vectors in range
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], take: Callable[[pa.Table], pa.RecordBatch | None], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Hand ``take`` whole runs of equal ``keys`` from sorted batches, many runs at once."""
    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows >= rows:
            new = np.flatnonzero(_changes(held, keys))
            if len(new) > 1:
                done = held.slice(0, int(new[-1]))
                held = held.slice(int(new[-1]))
                if (out := take(done.combine_chunks())) is not None:
                    yield out
    if held is not None and held.num_rows and (out := take(held.combine_chunks())) is not None:
        yield out


def _changes(t: pa.Table, keys: list[str]) -> np.ndarray:
    """True where a row begins another run."""
    out = np.zeros(t.num_rows, bool)
    out[:1] = True
    for k in keys:
        c = t[k].to_numpy()
        out[1:] |= c[1:] != c[:-1]
    return out


def _pairs(u: list, v: list, sim: list) -> pa.RecordBatch:
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return pa.RecordBatch.from_arrays([pa.array(cat(u, np.int64)), pa.array(cat(v, np.int64)), pa.array(cat(sim, np.float64))], names=["u", "v", "sim"])


def _hidden(linked: np.ndarray, passed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j) that span every group of ``linked``, if ``passed`` lacks some link both ways."""
    none = np.zeros(0, np.int64)
    if not (linked & ~(passed | passed.T)).any():
        return none, none
    seen, left, right = np.zeros(len(linked), bool), [], []
    for start in range(len(linked)):
        if seen[start]:
            continue
        seen[start] = True
        todo = [start]
        while todo:
            i = todo.pop()
            new = np.flatnonzero(linked[i] & ~seen)
            if len(new):
                seen[new] = True
                left.append(np.full(len(new), i))
                right.append(new)
                todo += new.tolist()
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of a task's links."""
    forest = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            forest.join(a, b)
    stars = [(a, b) for a, b in forest.stars() if a != b]
    yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in stars], pa.int64()), pa.array([b for _, b in stars], pa.int64())], names=["a", "b"])


def _signed(tables: range, bits: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == d))
                m = _matrix(own.column("vec"))
                for t in tables:
                    planes = np.random.default_rng([seed, t, d]).standard_normal((bits + 1, d))
                    at = m @ planes.T
                    sig = ((at[:, :bits] > 0) << np.arange(bits)[::-1]).sum(axis=1).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([own.column("node"), own.column("dim"), own.column("vec"), pa.array(np.full(len(m), t, np.int32)),
                                                      pa.array(sig), pa.array(at[:, bits])], names=["node", "dim", "vec", "t", "sig", "proj"])
    return run


def _runs(threshold: float):
    def compare(t: pa.Table) -> pa.RecordBatch:
        u, v, sim = [], [], []
        starts = np.flatnonzero(_changes(t, ["t", "dim"])).tolist() + [t.num_rows]
        nodes = t["node"].to_numpy()
        for a, b in zip(starts[:-1], starts[1:]):
            m, own = _matrix(t["vec"].slice(a, b - a)), nodes[a:b]
            for x in range(0, len(own), RUN):
                s = m[x:x + RUN] @ m[x:x + RUN].T
                np.fill_diagonal(s, -2)
                k = min(K, len(s) - 1)
                if k < 1:
                    continue
                near = np.argpartition(-s, k - 1, axis=1)[:, :k]
                value = np.take_along_axis(s, near, axis=1)
                rank = np.argsort(np.argsort(-value, axis=1), axis=1)
                ok = (value >= threshold) | (rank < FAR)
                i = np.nonzero(ok)[0]
                u.append(own[x:x + RUN][i])
                v.append(own[x:x + RUN][near[ok]])
                sim.append(value[ok])
                passed = np.zeros(s.shape, bool)
                passed[i, near[ok]] = True
                i, j = _hidden(s >= threshold, passed)
                u.append(own[x:x + RUN][i])
                v.append(own[x:x + RUN][j])
                sim.append(s[i, j])
        return _pairs(u, v, sim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Any cut will do between runs, so a task holds a few of them.
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 20 * RUN:
                yield compare(pa.Table.from_batches(held).combine_chunks())
                held, rows = [], 0
        if held:
            yield compare(pa.Table.from_batches(held).combine_chunks())
    return run


def _local_join(threshold: float):
    def join(t: pa.Table) -> pa.RecordBatch:
        u, v, sim = [], [], []
        starts = np.flatnonzero(_changes(t, ["pivot"])).tolist() + [t.num_rows]
        nodes, worst, every = t["node"].to_numpy(), t["worst"].to_numpy(), _by_length(t["vec"], t["dim"].to_numpy())
        for a, b in zip(starts[:-1], starts[1:]):
            m = np.stack(every[a:b])
            s = m @ m.T
            np.fill_diagonal(s, -2)
            i, j = _hidden(s >= threshold, s > worst[a:b][:, None])
            u.append(nodes[a:b][i])
            v.append(nodes[a:b][j])
            sim.append(s[i, j])
            i, j = np.triu_indices(b - a, 1)
            value = s[i, j]
            for x, y in ((i, j), (j, i)):
                better = value > worst[a:b][x]
                u.append(nodes[a:b][x][better])
                v.append(nodes[a:b][y][better])
                sim.append(value[better])
        return _pairs(u, v, sim)

    return lambda batches: _groups(batches, ["pivot"], join)


def _by_length(column: pa.ChunkedArray, dims: np.ndarray) -> list[np.ndarray]:
    """Unit rows of a column that may hold several lengths."""
    out: list[np.ndarray] = [np.zeros(0)] * len(dims)
    for d in np.unique(dims).tolist():
        at = np.flatnonzero(dims == d)
        for i, row in zip(at.tolist(), _matrix(column.take(pa.array(at)))):
            out[i] = row
    return out


def _top(rows: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each ``key``; salted first, so a hub never meets in one task whole."""
    salted = Window.partitionBy(key, F.pmod(F.xxhash64("u", "v"), F.lit(_SALTS))).orderBy(*order)
    few = rows.withColumn("_n", F.row_number().over(salted)).filter(F.col("_n") <= k)
    return few.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("_n") <= k).drop("_n")


def _merged(lists: DataFrame) -> DataFrame:
    once = lists.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    return staged(_top(once, "u", [F.col("sim").desc(), F.col("v")], K), "lists")


def _first_lists(nodes: DataFrame, n: int, tables: range, threshold: float) -> DataFrame:
    bits = min(40, max(6, int(np.ceil(np.log2(max(2, n))))))
    keyed = nodes.select("node", "dim", "vec").mapInArrow(
        _signed(tables, bits, SEED), f"node long, dim int, vec {nodes.schema['vec'].dataType.simpleString()}, t int, sig long, proj double")
    dealt = keyed.repartitionByRange(shuffle_partitions(nodes.sparkSession), "t", "dim", "sig", "proj").sortWithinPartitions("t", "dim", "sig", "proj")
    return dealt.mapInArrow(_runs(threshold), _LIST)


def _joined(nodes: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """Pairs found by one local join around every node."""
    worst = lists.groupBy("u").agg(F.when(F.count("*") >= K, F.min("sim")).otherwise(F.lit(-2.0)).alias("worst"))
    back = _top(lists.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim"), "u", [F.col("sim").desc(), F.col("v")], K)
    members = lists.select("u", "v").union(back.select("u", "v")).union(lists.select("u", F.col("u").alias("v"))).distinct()
    members = members.select(F.col("u").alias("pivot"), F.col("v").alias("node"))
    full = members.join(nodes.select("node", "dim", "vec").join(worst.withColumnRenamed("u", "node"), "node", "left").fillna(-2.0, ["worst"]), "node")
    dealt = full.repartition(F.col("pivot")).sortWithinPartitions("pivot")
    return dealt.mapInArrow(_local_join(threshold), _LIST)


def _scan(threshold: float):
    """Links of each node among the members of one pair of blocks of a component."""
    def scan(t: pa.Table) -> pa.Table:
        left = t["left"].to_numpy(zero_copy_only=False).astype(bool)
        nodes, n, dims = t["node"].to_numpy(), t["n"].to_numpy(), t["dim"].to_numpy()
        same = t["a"][0].as_py() == t["b"][0].as_py()
        out: dict[int, int] = {}
        for d in np.unique(dims).tolist():
            i = np.flatnonzero((dims == d) & left)
            j = i if same else np.flatnonzero((dims == d) & ~left)
            hit = _matrix(t["vec"].take(pa.array(i))) @ _matrix(t["vec"].take(pa.array(j))).T >= threshold if len(i) and len(j) else np.zeros((len(i), len(j)), bool)
            if same:
                np.fill_diagonal(hit, False)
            for k, own, other in ((i, hit, j), (j, hit.T, i))[: 1 if same else 2]:
                for x, c in zip(nodes[k].tolist(), (own @ n[other]).tolist() if len(other) else [0] * len(k)):
                    out[x] = out.get(x, 0) + c
        return pa.table({"node": pa.array(list(out), pa.int64()), "links": pa.array(list(out.values()), pa.int64())})
    return scan


def _spanning(threshold: float):
    """Links that span what one pair of blocks holds."""
    def span(t: pa.Table) -> pa.Table:
        nodes, dims = t["node"].to_numpy(), t["dim"].to_numpy()
        a, b = [], []
        for d in np.unique(dims).tolist():
            at = np.flatnonzero(dims == d)
            m = _matrix(t["vec"].take(pa.array(at)))
            i, j = _hidden(m @ m.T >= threshold, np.zeros((len(at), len(at)), bool))
            a.append(nodes[at][i])
            b.append(nodes[at][j])
        return pa.table({"a": pa.array(np.concatenate(a), pa.int64()), "b": pa.array(np.concatenate(b), pa.int64())})
    return span


def _meetings(nodes: DataFrame, members: DataFrame) -> GroupedData:
    """Pairs of blocks of each component in ``members`` (node, root); a block meets each block once, the smaller number is the left one."""
    # Staged, so that the join with a large component's members is a plain one that Spark can split.
    sizes = staged(members.groupBy("root").agg(F.ceil(F.count("*") / SCAN).cast("int").alias("blocks")), "sizes")
    blocked = members.join(sizes, "root").join(nodes, "node").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    meets = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return meets.select("root", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), (F.col("own") <= F.col("other")).alias("left"),
                        "node", "n", "dim", "vec").groupBy("root", "a", "b")


def _component_links(nodes: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(node, links) for all nodes of the components in ``members`` (node, root)."""
    return _meetings(nodes, members).applyInArrow(_scan(threshold), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def _audit(nodes: DataFrame, n: int, edges: DataFrame, saturated: DataFrame, threshold: float) -> float:
    """Share of the links of a bounded sample of nodes that were found: the mean over nodes, or over the links outside saturated components if that is lower."""
    rooted = nodes.select("node", "dim", "vec").join(saturated.select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", F.lit(-1).cast("long")))
    sample = rooted.filter(F.xxhash64("node") / 2.0**64 + 0.5 < min(1.0, AUDIT / max(1, n))).limit(2 * AUDIT).collect()
    if not sample:
        return 1.0
    queries = {d: (np.array([r["node"] for r in sample if r["dim"] == d], np.int64), np.array([r["root"] for r in sample if r["dim"] == d], np.int64),
                   _matrix(pa.array([r["vec"] for r in sample if r["dim"] == d]))) for d in {r["dim"] for r in sample}}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links outside saturated components, and per query, as v = -1, the number of those inside."""
        inside = {d: np.zeros(len(ids), np.int64) for d, (ids, _, _) in queries.items()}
        for batch in batches:
            dims, nodes_, roots = (batch.column(c).to_numpy() for c in ("dim", "node", "root"))
            for d, (ids, own, q) in queries.items():
                at = np.flatnonzero(dims == d)
                if len(at):
                    hit = _matrix(batch.column("vec").take(pa.array(at))) @ q.T >= threshold
                    hit &= nodes_[at][:, None] != ids
                    within = hit & (roots[at][:, None] == own) & (own >= 0)
                    inside[d] += within.sum(0)
                    i, j = np.nonzero(hit & ~within)
                    yield _pairs([ids[j]], [nodes_[at][i]], [np.ones(len(i))])
        for d, (ids, _, _) in queries.items():
            some = inside[d] > 0
            yield _pairs([ids[some]], [np.full(some.sum(), -1)], [inside[d][some].astype(np.float64)])

    true = staged(rooted.mapInArrow(search, _LIST), "audit")
    listed = true.filter("v >= 0").join(edges.select("u", "v", F.lit(True).alias("listed")), ["u", "v"], "left")
    listed = listed.groupBy("u").agg(F.count("*").alias("outside"), F.count("listed").alias("found"))
    within = true.filter("v < 0").groupBy("u").agg(F.sum("sim").alias("inside"))
    per_node = listed.join(within, "u", "full").fillna(0, ["outside", "found", "inside"])
    share = (F.col("inside") + F.col("found")) / (F.col("inside") + F.col("outside"))
    mean, outside, found = per_node.agg(F.avg(share), F.sum("outside"), F.sum("found")).first()
    return 1.0 if mean is None else min(mean, found / outside if outside else 1.0)


def embedding_groups(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept."""
    v = F.col("embedding")
    fine = F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(fine, v).alias("vec"))
    nodes = staged(rows.filter("vec is not null").groupBy("vec").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
                   .select(F.monotonically_increasing_id().alias("node"), F.size("vec").alias("dim"), "vec", "n", "least"), "nodes")
    n = nodes.count()
    lists, spans, seen = None, None, None
    settled = False
    for round_ in range(ROUNDS):
        first = staged(_first_lists(nodes, n, range(round_ * TABLES, (round_ + 1) * TABLES), threshold), "found")
        lists = _merged(first if lists is None else lists.union(first))
        joined = staged(_joined(nodes, lists, threshold), "found")
        lists = _merged(lists.union(joined))
        new = first.union(joined).filter(F.col("sim") >= threshold).select("u", "v").mapInArrow(_forest, "a long, b long")
        links = lists.filter(F.col("sim") >= threshold)
        both = staged(links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
        edges = both.select(F.col("u").alias("a"), F.col("v").alias("b")).union(new)
        roots = staged(components(edges if spans is None else edges.union(spans)), "roots")
        spans = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        full = links.groupBy("u").count().filter(F.col("count") >= K).select(F.col("u").alias("node"))
        saturated = staged(roots.join(roots.join(full, "node").select("root").distinct(), "root").select("node", "root"), "saturated")
        recall = _audit(nodes, n, both, saturated, threshold)
        outside = both.join(saturated.select(F.col("node").alias("u")), "u", "left_anti")
        now = [df.agg(F.count("*"), F.bit_xor(F.xxhash64(*df.columns))).first() for df in (roots, saturated, outside)]
        if settled := recall >= TARGET and now == seen:
            break
        seen = now
    if not settled:
        saturated = nodes.select("node", F.lit(0).cast("long").alias("root"))
        spans = _meetings(nodes.select("node", "n", "dim", "vec"), saturated).applyInArrow(_spanning(threshold), "a long, b long")
        roots = staged(components(spans), "roots")
    slim = nodes.select("node", "n", "least")
    scanned = _component_links(nodes.select("node", "n", "dim", "vec"), saturated, threshold)
    listed = both.join(slim.select(F.col("node").alias("v"), "n"), "v").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("listed"))
    named = slim.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = staged(named.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    per_node = (named.join(least, "root").join(scanned, "node", "left").join(listed, "node", "left")
                .select("node", (F.coalesce("links", "listed", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"))
    per_node = staged(per_node.join(nodes.select("node", "vec"), "node").drop("node"), "result")
    out = rows.join(per_node, "vec", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))

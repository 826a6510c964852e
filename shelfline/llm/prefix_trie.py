"""Operator 11, prefix trie of conversations by union-find over sorted neighbours.

A conversation is the sequence of its turns (role, text); a node of the trie
is a distinct sequence of first turns. Turns travel as 16-byte digests and
text lengths, texts are never shuffled.

1. Sequences are sorted over the cluster by their digests, then conv_id
   (range partitions, so that equal sequences and shared beginnings spread
   over as many tasks as their rows need).
2. Within a partition the longest common prefix (LCP) of each two neighbours
   is an edge. Edges are taken in descending depth; each joins two components
   of a union-find and creates their branching node, or grows the one that
   stands at that depth. The turns between a node and its branching parent
   are nodes of one child each.
3. Only prefixes of a partition's first and last sequence can stand in other
   partitions too. They stay *open*: what hangs below them is contracted to
   sums. ``FAN`` neighbouring forests at a time are merged, equal open nodes
   into one; those that no longer lie on the outer edge are closed in
   descending depth, the others go on to the next round, until one forest is
   left. A round holds two paths a forest.
4. A closed node whose parent was still open gets the parent's conv_id by a
   join on (partition, parent), of which every partition has two paths.

A conversation of n turns travels as one row of about 24 n bytes; partitions
are sized from the sum of those. Digests of conversations that end at a node
are hashed in the order of their ids: within the partition, or, for the two
sequences at its edges, in a stream over its portions, so a group of copies
of any size is never held whole.

Defined results: turns are ordered by turn (null first), those that tie by
the MD5 of role and text; a null role or text is empty; repeated rows are
repeated turns; rows without a conv_id belong to no conversation; a sequence
without turns is a member of the root only; an empty table has no root. Only
conv_id, turn, role and text are read, so clashing columns do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import shuffle_partitions, staged
from shelfline.llm.components import UnionFind

PART_BYTES = 32 << 20
#: Neighbouring forests that one task merges.
FAN = 16
ROWS = 50_000
WIDTH = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: kind: node (closed), open, or ends (ids of an open node). Sums of an open node are those of the closed nodes below it.
_ROW = pa.schema([("kind", pa.string()), ("part", pa.int64()), ("depth", pa.int64()), ("digest", pa.binary()), ("parent", pa.binary()),
                  ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                  ("saved_tokens", pa.int64()), ("size", pa.int64()), ("ends_sha256", pa.string()), ("ids", pa.binary()), ("left", pa.bool_()), ("right", pa.bool_())])
_SQL = ("kind string, part long, depth long, digest binary, parent binary, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, size long, ends_sha256 string, ids binary, left boolean, right boolean")
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (digest, bytes of the text)."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct("turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    told = turns.filter("conv_id is not null").select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return told.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))


def common_turns(a: bytes, b: bytes) -> int:
    """Number of leading digests that two sequences share."""
    n = min(len(a), len(b))
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return (int(differ.argmax()) if n and differ.any() else n) // WIDTH


def branching_nodes(depths: list[int], lcp: list[int]) -> tuple[list[int], list[list[int]], list[tuple[int, int]], list[int]]:
    """(depth, children, interval of sequences, sequence that ends here or -1) of the root, the sequences and the nodes where they part.

    ``depths`` are those of distinct sorted sequences, ``lcp[i]`` is shared by
    the i-th and the next. A node comes after the sequences below it; the last is the root.
    """
    n = len(depths)
    depth, kids, span, ends = list(depths), [[] for _ in depths], [(i, i) for i in range(n)], list(range(n))
    forest, top = UnionFind(), list(range(n))  # top node of each component, by its first sequence
    for i in sorted(range(n - 1), key=lambda i: -lcp[i]):
        a, b = forest.root(i), i + 1
        x, y, d = top[a], top[b], lcp[i]
        forest.join(a, b)
        if depth[x] == d == depth[y]:  # one node, found from two sides
            kids[x] += kids[y]
            kids[y] = []
        elif depth[x] == d:
            kids[x].append(y)
        elif depth[y] == d:
            kids[y].append(x)
            x, y = y, x
        else:
            depth.append(d)
            kids.append([x, y])
            span.append(span[x])
            ends.append(-1)
            x = len(depth) - 1
        span[x] = (span[top[a]][0], span[top[b]][1])
        top[a] = x
    if depth[top[0]] > 0:
        depth.append(0)
        kids.append([top[0]])
        span.append((0, n - 1))
        ends.append(-1)
        top[0] = len(depth) - 1
    return depth, kids, span, [top[0], *ends]


def _paths(key: bytes) -> list[bytes]:
    """A digest for every prefix of a sequence."""
    state = hashlib.blake2b(digest_size=16)
    out = [state.digest()]
    for i in range(0, len(key), WIDTH):
        state.update(key[i:i + WIDTH])
        out.append(state.copy().digest())
    return out


def _row(**values) -> dict:
    return {**dict.fromkeys(_ROW.names), **values}


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_pylist(held, schema=_ROW)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_ROW)


def forest_rows(part: int, ids: list[int], keys: list[bytes], sizes: list[np.ndarray]) -> Iterator[dict]:
    """Closed nodes, open nodes and ids of open nodes of one partition's sorted sequences."""
    first = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]  # of each group of equal sequences
    last = [*first[1:], len(keys)]
    keys = [keys[i] for i in first]
    end = len(keys) - 1
    lcp = [common_turns(a, b) for a, b in zip(keys, keys[1:])]
    depth, kids, span, (root, *ends) = branching_nodes([len(k) // WIDTH for k in keys], lcp)
    left, right = _paths(keys[0]), _paths(keys[-1])
    above = {k: v for v, below in enumerate(kids) for k in below}
    deepest_first = sorted((v for v in range(len(depth)) if v == root or v in above), key=lambda v: -depth[v])

    def members(v: int) -> bytes:
        s = ends[v]
        return b",".join(b"%d" % c for c in ids[first[s]:last[s]])

    def path(v: int) -> list[bytes] | None:
        """Digests on the partition's edge that the node lies on, if any."""
        return left if span[v][0] == 0 else right if span[v][1] == end else None

    def top(v: int) -> int:
        """Depth of the uppermost node of the way to the branching parent."""
        return depth[above[v]] + 1 if v != root else 0

    def size(v: int, d: int) -> int:
        return int(sizes[first[span[v][0]]][d - 1]) if d else 0

    count, conv, leaves, saved, children = ([0] * len(depth) for _ in range(5))
    for v in deepest_first:
        s, closed = ends[v], [k for k in kids[v] if path(k) is None]
        count[v] = (last[s] - first[s] if s >= 0 else 0) + sum(count[k] for k in kids[v])
        conv[v] = min([conv[k] for k in kids[v]] + ([min(ids[first[s]:last[s]])] if s >= 0 else []))
        children[v], leaves[v] = len(closed), sum(leaves[k] for k in closed)
        saved[v] = sum(saved[k] + (count[k] - 1) * sum(size(k, d) for d in range(top(k), depth[k] + 1)) for k in closed)
        if path(v) is None:
            leaves[v] = leaves[v] or 1

    for v in deepest_first:
        digests, below = path(v), saved[v]
        for d in range(depth[v], top(v) - 1, -1):
            here = d == depth[v]
            row = _row(part=part, depth=d, conv_id=conv[v], n_convs=count[v])
            if digests is None:
                below += (count[v] - 1) * size(v, d)
                row |= {"kind": "node", "n_children": children[v] if here else 1, "n_leaves": leaves[v], "saved_tokens": below,
                        "ends_sha256": hashlib.sha256(members(v)).hexdigest() if here and ends[v] >= 0 else NO_ENDS}
                edge = path(above[v]) if d == top(v) else None
                if edge is not None:
                    row["parent"] = edge[d - 1]
                else:
                    row["parent_conv_id"] = conv[above[v]] if d == top(v) else conv[v]
            else:
                row |= {"kind": "open", "digest": digests[d], "parent": digests[d - 1] if d else None, "size": size(v, d),
                        "n_children": children[v] if here else 0, "n_leaves": leaves[v] if here else 0, "saved_tokens": below if here else 0,
                        "left": span[v][0] == 0, "right": span[v][1] == end}
            yield row
        if digests is not None and ends[v] >= 0:
            yield _row(kind="ends", part=part, digest=digests[depth[v]], ids=members(v))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = list(batches)
    if not sum(b.num_rows for b in table):
        return
    sizes = [np.asarray(x.values) for b in table for x in b.column("sizes")]
    ids, keys = ([x for b in table for x in b.column(c).to_pylist()] for c in ("conv_id", "key"))
    yield from _batches(forest_rows(TaskContext.get().partitionId(), ids, keys, sizes))


def merged_rows(part: int, rows: list[dict], whole: bool) -> Iterator[dict]:
    """Open nodes of neighbouring forests as one forest: closed nodes, and those that still lie on its outer edge.

    ``whole``: no other forest is left.
    """
    rows.sort(key=lambda r: r["part"])
    edge = rows[0]["part"], rows[-1]["part"]
    nodes: dict[bytes, dict] = {}
    for r in rows:
        r["left"], r["right"] = r["left"] and r["part"] == edge[0], r["right"] and r["part"] == edge[1]
        v = nodes.setdefault(r["digest"], r)
        if v is not r:
            for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                v[c] += r[c]
            v["conv_id"] = min(v["conv_id"], r["conv_id"])
            v["left"], v["right"] = v["left"] or r["left"], v["right"] or r["right"]
    for v in sorted(nodes.values(), key=lambda v: -v["depth"]):
        v["part"] = part
        if whole or not (v["left"] or v["right"]):
            v["kind"] = "node"
            v["n_leaves"] = v["n_leaves"] or 1
            v["saved_tokens"] += (v["n_convs"] - 1) * v["size"]
            if v["depth"]:
                u = nodes[v["parent"]]
                u["n_children"] += 1
                u["n_leaves"] += v["n_leaves"]
                u["saved_tokens"] += v["saved_tokens"]
                if whole or not (u["left"] or u["right"]):
                    v["parent_conv_id"], v["parent"] = u["conv_id"], None
        yield v


def _merge(whole: bool):
    def merge(key, table):
        return pa.Table.from_batches(_batches(merged_rows(key[0].as_py(), table.drop_columns("_group").to_pylist(), whole)), schema=_ROW)

    return merge


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, SHA-256 of its ids) from portions sorted by (digest, part)."""
    names = ["digest", "ends"]
    digest, state = None, None
    for batch in batches:
        done = []
        for now, ids in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist()):
            if now == digest:
                state.update(b"," + ids)
                continue
            if digest is not None:
                done.append((digest, state.hexdigest()))
            digest, state = now, hashlib.sha256(ids)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.binary(), pa.string()))], names=names)
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([digest], pa.binary()), pa.array([state.hexdigest()])], names=names)


def prefix_trie(convs: DataFrame, part_bytes: int = PART_BYTES, fan: int = FAN) -> DataFrame:
    """One row per node of the trie of (conv_id, turns) as ``sequences`` gives them; conv_id is unique.

    conv_id: least member; depth; parent_conv_id: the parent's; n_convs:
    members; n_children; n_leaves: childless nodes of the subtree;
    saved_tokens: bytes that the subtree's members share; ends_sha256: of the
    ids of members that end here.
    """
    keyed = convs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("key"), F.transform("turns", lambda t: t["bytes"]).alias("sizes"))
    keyed = staged(keyed, "sequences")
    total = keyed.agg(F.sum(F.length("key") + 8 * F.size("sizes") + 8)).first()[0] or 0
    parts = max(shuffle_partitions(convs.sparkSession), -(-total // part_bytes))
    dealt = keyed.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    forest = staged(dealt.mapInArrow(_forest, _SQL), "forest")

    left = forest.agg(F.max("part")).first()[0]  # last partition with a sequence
    open_nodes, rounds = forest.filter("kind = 'open'"), []
    while left is not None:
        left //= fan
        whole = left == 0
        grouped = open_nodes.withColumn("_group", F.floor(F.col("part") / fan)).groupBy("_group")
        rounds.append(staged(grouped.applyInArrow(_merge(whole), _SQL), "merged"))
        open_nodes = rounds[-1].filter("kind = 'open'")
        if whole:
            break
    closed = forest.filter("kind = 'node'")
    if not rounds:
        return closed.select(*NODE)
    outer = rounds[0]
    for r in rounds[1:]:
        outer = outer.union(r)
    outer = outer.filter("kind = 'node'")
    ends = forest.filter("kind = 'ends'").select("digest", "part", "ids").repartition("digest").sortWithinPartitions("digest", "part")
    ends = ends.mapInArrow(_hashed, "digest binary, ends string")
    outer = staged(outer.join(ends, "digest", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))), "outer")

    known = outer.select(F.col("digest").alias("parent"), F.col("conv_id").alias("_conv"))
    in_part = forest.filter("kind = 'open'").select("part", F.col("digest").alias("parent")).join(known, "parent")

    def with_parent(rows: DataFrame, parents: DataFrame, on: list[str]) -> DataFrame:
        found = rows.filter("parent is not null").join(parents, on).withColumn("parent_conv_id", F.col("_conv"))
        return rows.filter("parent is null").select(*NODE).unionByName(found.select(*NODE))

    return with_parent(closed, in_part, ["part", "parent"]).unionByName(with_parent(outer, known, ["parent"]))

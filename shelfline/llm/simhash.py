"""Operator 7, SimHash near-dedup by a binary-trie self-join.

Documents become 64-bit fingerprints of their word shingles; equal
fingerprints are collapsed to one entry (the least doc_id stands for them).
The entries form a binary trie that is joined with itself: pairs of nodes go
down together, each step on different bits adds one to their distance, and a
pair is pruned once the distance exceeds the budget.

To spread the trie over tasks it is kept in budget + 1 rotations, each with
another block of bits on top: two fingerprints within the budget agree on all
bits of some block, so in that rotation they lie below the same top node, at
distance 0 so far. A task holds whole top nodes and walks their node pairs
level by level. A top node with more than ``node_limit`` entries is split the
same way over its remaining bits, again and again: distinct fingerprints run
out of bits, so no task holds an unbounded node and none is capped.

Each task passes on a spanning forest of the links it finds, not all pairs.
A distributed component search joins them.

Defined results: a null or empty text has fingerprint zero and is linked like
any other; rows that share a doc_id are one document for the components; a
null doc_id is compared too, but names no component (the others' least id
does); an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import staged
from shelfline.llm.components import UnionFind, components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
NODE_LIMIT = 1024
#: Entries that a task walks at once (whole top nodes).
CHUNK = 50_000


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is set if it is set in over half of the shingles' XXH64."""
    words = (text or b"").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.r_[0, ends[:-1]][:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    h64 = xxhash.xxh64_intdigest
    hashes = np.array([h64(joined[a:b], seed) for a, b in zip(starts, stops)], "<u8")
    bits = np.zeros(64, np.int64)
    for k in range(0, n, 65536):
        bits += np.unpackbits(hashes[k:k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle, seed) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            ids = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(x).cast(pa.int64()) for x in ids], pa.array(np.array(found, np.uint64).view(np.int64))], names=[*ids, "fp"])
    return run


def trie_pairs(values: np.ndarray, fixed: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of sorted distinct uint64 that agree in their top ``fixed`` bits and differ in at most ``budget`` others.

    ``fixed`` holds one number for each value, equal for all below one top node.
    """
    n = len(values)
    shift = (64 - fixed).astype(np.uint64)
    tops = values >> shift
    first = np.flatnonzero(np.r_[True, (tops[1:] != tops[:-1]) | (fixed[1:] != fixed[:-1])])
    lo, hi = first, np.r_[first[1:], n]
    lo, hi = lo[hi - lo > 1], hi[hi - lo > 1]
    a_lo, a_hi, b_lo, b_hi, d = lo, hi, lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
    left, right = [], []
    for bit in range(63 - int(fixed.min()) if n else -1, -1, -1):
        if not len(a_lo):
            break
        ones = np.r_[0, np.cumsum((values >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)]
        waiting = fixed[a_lo] > 63 - bit  # the top node fixes this bit
        a_mid = np.where(waiting, a_hi, a_hi - (ones[a_hi] - ones[a_lo]))
        b_mid = np.where(waiting, b_hi, b_hi - (ones[b_hi] - ones[b_lo]))
        self_ = a_lo == b_lo
        children = [(a_lo, a_mid, b_lo, b_mid, d, None), (a_mid, a_hi, b_mid, b_hi, d, None),
                    (a_lo, a_mid, b_mid, b_hi, d + 1, None), (a_mid, a_hi, b_lo, b_mid, d + 1, ~self_)]
        parts = []
        for al, ah, bl, bh, dd, only in children:
            ok = (ah > al) & (bh > bl) & (dd <= budget) & ((al != bl) | (ah - al > 1))
            if only is not None:
                ok &= only
            parts.append((al[ok], ah[ok], bl[ok], bh[ok], dd[ok]))
        a_lo, a_hi, b_lo, b_hi, d = (np.concatenate(x) for x in zip(*parts))
        leaves = (a_hi - a_lo == 1) & (b_hi - b_lo == 1)
        if leaves.any():  # both paths are single: add the rest of the bits at once
            i, j = a_lo[leaves], b_lo[leaves]
            near = np.bitwise_count(values[i] ^ values[j]) <= budget
            left.append(np.minimum(i, j)[near])
            right.append(np.maximum(i, j)[near])
            a_lo, a_hi, b_lo, b_hi, d = (x[~leaves] for x in (a_lo, a_hi, b_lo, b_hi, d))
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _links(budget: int):
    def walk(rows: pa.Table) -> pa.RecordBatch:
        values, fixed, reps = rows["value"].to_numpy().view(np.uint64), rows["fixed"].to_numpy().astype(np.int64), rows["rep"].to_numpy()
        forest = UnionFind()
        route = rows["route"].to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.r_[True, route[1:] != route[:-1], True])  # node values of one route are distinct and sorted
        for x, y in zip(cuts[:-1], cuts[1:]):
            # Rows are in order of signed values; unsigned order moves the negatives behind.
            order = np.argsort(values[x:y], kind="stable")
            i, j = trie_pairs(values[x:y][order], fixed[x:y][order], budget)
            own = reps[x:y][order]
            for a, b in zip(own[i].tolist(), own[j].tolist()):
                forest.join(a, b)
        stars = forest.stars()
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in stars], pa.int64()), pa.array([b for _, b in stars], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows >= CHUNK:
                route, top = held["route"].to_numpy(zero_copy_only=False), held["top"].to_numpy()
                new = np.flatnonzero((route[1:] != route[:-1]) | (top[1:] != top[:-1]))
                if len(new):
                    yield walk(held.slice(0, int(new[-1]) + 1).combine_chunks())
                    held = held.slice(int(new[-1]) + 1)
        if held is not None and held.num_rows:
            yield walk(held.combine_chunks())
    return run


def _rotations(value: Column, fixed: int, blocks: int) -> list[tuple[Column, int]]:
    """The free low bits of ``value`` turned so that each block of them comes first, with the bits then fixed."""
    free = 64 - fixed
    ends = [free * (k + 1) // blocks for k in range(blocks)]
    mask = (1 << free) - 1
    low = value.bitwiseAND(F.lit(mask - 2**64 if mask >= 2**63 else mask))
    high = value.bitwiseXOR(low)
    out = []
    for start, end in zip([0, *ends[:-1]], ends):
        turned = low if not start else F.shiftleft(low, start).bitwiseOR(F.shiftrightunsigned(low, free - start)).bitwiseAND(F.lit(mask - 2**64 if mask >= 2**63 else mask))
        out.append((high.bitwiseOR(turned), fixed + end - start))
    return out


def _top(value: str = "value", fixed: str = "fixed") -> Column:
    return F.expr(f"shiftrightunsigned({value}, 64 - {fixed})")


def links(reps: DataFrame, max_bits: int = MAX_BITS, node_limit: int = NODE_LIMIT) -> DataFrame:
    """(fp, rep), distinct fp -> edges (a, b) of reps that join all entries within ``max_bits`` bits."""
    def turn(rows: DataFrame, fixed: int) -> list[tuple[DataFrame, int]]:
        """One frame for each number of bits then fixed."""
        by: dict[int, list[Column]] = {}
        for j, (value, now) in enumerate(_rotations(F.col("value"), fixed, max_bits + 1)):
            by.setdefault(now, []).append(F.struct(F.concat("route", F.lit(str(j))).alias("route"), value.alias("value")))
        return [(rows.select("rep", F.explode(F.array(*x)).alias("x")).select("rep", "x.route", "x.value", F.lit(now).alias("fixed")), now) for now, x in by.items()]

    ready: list[DataFrame] = []
    todo = turn(reps.select("rep", F.lit("").alias("route"), F.col("fp").alias("value")), 0)
    while todo:
        at = todo[0][0]
        for df, _ in todo[1:]:
            at = at.union(df)
        at = at.withColumn("top", _top())
        large = staged(at.groupBy("route", "top").count().filter(F.col("count") > node_limit).select("route", "top", F.lit(True).alias("large")), "nodes")
        if large.isEmpty():
            ready.append(at)
            break
        marked = at.join(large, ["route", "top"], "left")
        ready.append(marked.filter("large is null").select(*at.columns))
        hot = staged(marked.filter("large").select("rep", "route", "value", "fixed"), "hot")
        levels = sorted(r[0] for r in hot.select("fixed").distinct().collect())  # a few numbers of bits
        todo = [x for f in levels if f < 64 for x in turn(hot.filter(F.col("fixed") == f), f)]
    rows = ready[0]
    for df in ready[1:]:
        rows = rows.union(df)
    dealt = rows.select("route", "top", "value", "fixed", "rep").repartition(F.col("route"), F.col("top")).sortWithinPartitions("route", "top", "value")
    return dealt.mapInArrow(_links(max_bits), "a long, b long")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED, node_limit: int = NODE_LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (the least doc_id of the component; null if none has one).

    Fingerprints are linked, whatever ids hold them, so rows without a doc_id carry links like any other.
    """
    prints = staged(docs.select("doc_id", "text").mapInArrow(_fingerprints(shingle, seed), "doc_id long, fp long"), "prints")
    reps = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "reps")
    roots = components(links(reps.select("fp", F.col("fp").alias("rep")), max_bits, node_limit))
    linked = staged(reps.join(roots, reps["fp"] == roots["node"]).select("fp", "rep", "root"), "linked")
    least = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = reps.join(linked.join(least, "root").select("fp", F.col("component_id"), F.lit(True).alias("of")), "fp", "left")
    named = named.select("fp", F.when(F.col("of"), F.col("component_id")).otherwise(F.col("rep")).alias("component_id"))
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_rows(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED, node_limit: int = NODE_LIMIT) -> DataFrame:
    """One row of each group of near copies, whatever its doc_id: the least (doc_id nulls last, text hash).

    Groups are of fingerprints, so rows without a doc_id are linked like any other and rows that share one only if they are near copies.
    """
    text_hash = F.xxhash64("text")
    prints = staged(docs.select("doc_id", text_hash.alias("key"), "text").mapInArrow(_fingerprints(shingle, seed), "doc_id long, key long, fp long"), "prints")
    entries = staged(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")), "entries")
    roots = components(links(entries.select("fp", F.col("fp").alias("rep")), max_bits, node_limit))
    named = entries.join(roots, entries["fp"] == roots["node"], "left").withColumn("group", F.coalesce("root", "fp"))
    first = named.groupBy("group").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("_doc_id"), F.col("first.key").alias("_key"))
    n = "_n"
    while n in docs.columns:
        n += "_"
    marked = docs.withColumn(n, text_hash)
    first = first.withColumnsRenamed({"_doc_id": f"{n}doc_id", "_key": f"{n}key"})
    kept = marked.join(first, marked["doc_id"].eqNullSafe(first[f"{n}doc_id"]) & (marked[n] == first[f"{n}key"]), "left_semi")
    return kept.dropDuplicates(["doc_id", n]).drop(n)

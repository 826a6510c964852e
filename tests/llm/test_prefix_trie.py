import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfline.llm import prefix_trie as trie
from shelfline.llm.queries import REGISTRY

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(told: dict) -> list[tuple]:
    """Every prefix of every conversation, in dictionaries."""
    nodes, kids = defaultdict(list), defaultdict(list)
    for c, turns in told.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + (len(nodes[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
    return sorted((min(m), len(k), min(nodes[k[:-1]]) if k else -1, len(m), len(kids[k]), leaves[k], saved[k],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if told[c] == k).encode()).hexdigest()) for k, m in nodes.items())


def told_of(rows) -> dict:
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            out[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), (role, text)))
    return {c: tuple(t[-1] for t in sorted(turns)) for c, turns in out.items()}


def rebuilt(told: dict) -> dict:
    out = {}
    for c, turns in told.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = c - (c % 5 if c >= 0 else -(-c % 5))  # remainders are truncated
        out[c] = told.get(head, ())[:h] + turns[h:]
    return out


def nodes(df) -> list[tuple]:
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.select(*trie.NODE).collect())


def rows(seed: int = 1, convs: int = 150) -> list[tuple]:
    """Shared beginnings, whole copies (over a third of all), one long conversation, nulls in any column, ties, repeated rows, missing heads."""
    rng = random.Random(seed)
    out: list[tuple] = []
    for c in range(convs):
        if c in (5, 10, 20):
            continue
        if c % 5 in (1, 2):
            out += [(c, i, "user", f"copied {i}") for i in range(4)]
        else:
            out += [(c, i, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ççç", f"own {c}"])) for i in range(rng.randrange(1, 7))]
    out += [(convs + 5, i, "user", f"long {i % 7}") for i in range(700)] + [(convs + 10, i, "user", f"long {i % 7}") for i in range(650)]
    out += [(convs + 15, None, "user", "null turn"), (convs + 15, None, None, "null turn"), (convs + 15, 3, None, None), (convs + 15, 3, "", "")]
    out += [(convs + 16, 1, "user", "tie"), (convs + 16, 1, "tie", "user"), (convs + 16, 1, "user", "tie")]
    out += [(None, 1, "user", "of no conversation"), (convs + 17, 0, "user", "x" * 200_000), (-7, 0, "user", "a"), (-5, 0, "user", "head"), (-5, 1, "user", "of a negative one")]
    return out


def test_trie_equals_every_prefix(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    clashing = df.withColumns({c: F.lit("mine") for c in ("key", "digest", "parent", "part", "kind", "size", "turns", "ids", "depth", "_group", "t")})
    want = brute(told_of(data))
    assert nodes(trie.prefix_trie(trie.sequences(clashing))) == want


@pytest.mark.parametrize("part_bytes, fan", [(300, 2), (300, 1000), (40, 3)])
def test_many_partitions_and_rounds(spark, part_bytes, fan):
    """Forests of a few sequences each: groups of copies and beginnings that span many of them."""
    data = rows(2, 60)
    assert nodes(trie.prefix_trie(trie.sequences(spark.createDataFrame(data, SCHEMA)), part_bytes, fan)) == brute(told_of(data))


def test_union_find_makes_the_branching_nodes():
    """Depths of neighbours' common prefixes, joined from the deepest on."""
    depth, kids, span, (root, *ends) = trie.branching_nodes([1, 2, 3, 3, 2, 1], [1, 2, 2, 0, 0])
    assert [depth[k] for k in sorted(kids[root], key=lambda k: span[k])] == [1, 2, 1]
    assert sorted(depth[k] for k in kids[0]) == [2] and kids[1] and ends[root] == -1 and span[root] == (0, 5)
    assert trie.branching_nodes([0], [])[3][0] == 0  # a sequence without turns is the root
    depth, kids, span, (root, *ends) = trie.branching_nodes([4], [])
    assert depth[root] == 0 and kids[root] == [0]


def test_forests_merged_in_any_fan():
    """Cut into forests at any places and merged in any rounds, the nodes are those of one forest."""
    rng = random.Random(7)
    for _ in range(40):
        told = sorted((bytes(x for t in (rng.randrange(3) for _ in range(rng.randrange(6))) for x in [t] * trie.WIDTH), c) for c in range(rng.randrange(1, 25)))
        sizes = {k: [k[i] + 1 for i in range(0, len(k), trie.WIDTH)] for k, _ in told}
        want = brute({c: tuple(("", "x" * n) for n in sizes[k]) for k, c in told})
        cuts = sorted(rng.sample(range(1, len(told) + 1), min(len(told), rng.randrange(1, 6))) + [0, len(told)])
        found, ids, edges, left = [], defaultdict(list), [], []
        for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                mine = told[a:b]
                left += list(trie.forest_rows(part, [c for _, c in mine], [k for k, _ in mine], [sizes[k] for k, _ in mine]))
        for r in left:
            if r["kind"] == "ends":
                ids[r["digest"]].append(r["ids"])
            elif r["kind"] == "open":
                edges.append((r["part"], r["digest"]))
        found += [r for r in left if r["kind"] == "node"]
        left = [dict(r) for r in left if r["kind"] == "open"]
        while left:
            fan = rng.randrange(2, 4)
            groups = defaultdict(list)
            for r in left:
                groups[r["part"] // fan].append(r)
            merged = [r for g, rows in groups.items() for r in trie.merged_rows(g, rows, len(groups) == 1)]
            found += [r for r in merged if r["kind"] == "node"]
            left = [dict(r) for r in merged if r["kind"] == "open"]
        conv = {r["digest"]: r["conv_id"] for r in found if r["digest"] is not None}
        for r in found:
            if r["parent"] is not None:
                r["parent_conv_id"] = conv[r["parent"]]
            if r["digest"] is not None:
                r["ends_sha256"] = hashlib.sha256(b",".join(ids[r["digest"]])).hexdigest()
        assert sorted(tuple(-1 if r[c] is None else r[c] for c in trie.NODE) for r in found) == want


def test_empty_and_turnless(spark):
    assert nodes(trie.prefix_trie(trie.sequences(spark.createDataFrame([], SCHEMA)))) == []
    assert nodes(trie.prefix_trie(trie.sequences(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)))) == []
    bare = trie.sequences(spark.createDataFrame([(3, 0, "a", "b"), (4, 0, "a", "b")], SCHEMA))
    bare = bare.withColumn("turns", F.when(F.col("conv_id") == 4, F.slice("turns", 1, F.lit(0))).otherwise(F.col("turns")))
    assert nodes(trie.prefix_trie(bare)) == brute({3: (("a", "b"),), 4: ()})


def test_query_rebuilds(spark, tmp_path):
    data = rows(3)
    spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    assert nodes(REGISTRY["op11_prefix_trie"](spark, str(tmp_path))) == brute(rebuilt(told_of(data)))

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from cases import clashing, rows, table

from shelfline.llm.components import components
from shelfline.llm.simhash import keep_rows, links, simhash_groups, trie_pairs


def brute_print(text: str | None) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def roots(edges: list[tuple[int, int]], nodes: list[int]) -> dict[int, int]:
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_against_brute_force(spark):
    data = [r for r in rows() if r[0] is not None]
    prints = {r[0]: brute_print(r[1]) for r in data}
    ids = list(prints)
    want = roots([(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2], ids)
    got = simhash_groups(clashing(table(spark, data))).collect()
    assert len(got) == len(data)
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_null_ids_and_empty(spark):
    data = [(None, "a b c d", None, None, None), (5, "a b c d", None, None, None), (None, "x y z q", None, None, None), (9, None, None, None, None), (8, "", None, None, None)]
    got = Counter((r["doc_id"], r["component_id"]) for r in simhash_groups(table(spark, data)).collect())
    assert got == Counter([(None, 5), (5, 5), (None, None), (9, 8), (8, 8)])
    assert simhash_groups(table(spark, [])).count() == 0


def test_links_through_rows_without_an_id(spark):
    """Two documents that only a row without a doc_id connects are one component, as are rows that none has."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts = [" ".join(base)]
    for _ in range(120):
        words = list(base)
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(500)}"
        texts.append(" ".join(words))
    prints = [brute_print(t) for t in texts]

    def apart(i, j):
        return (prints[i] ^ prints[j]).bit_count()

    a, b, c = next((a, b, c) for b in range(len(texts)) for a in range(len(texts)) for c in range(a)
                   if 0 < apart(a, b) <= 2 and 0 < apart(b, c) <= 2 and apart(a, c) > 2)
    data = [(7, texts[a]), (None, texts[b]), (4, texts[c]), (None, "all by itself here"), (None, None), (9, "another one by itself")]
    got = Counter((r["doc_id"], r["component_id"]) for r in simhash_groups(table(spark, [(*r, "en", "a", 1) for r in data])).collect())
    assert got == Counter([(7, 4), (None, 4), (4, 4), (None, None), (None, None), (9, 9)])


def test_a_third_without_an_id(spark):
    data = [(None if i % 3 == 0 else r[0], *r[1:]) for i, r in enumerate(rows())]
    prints = [brute_print(r[1]) for r in data]
    at = roots([(i, j) for i in range(len(data)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2], list(range(len(data))))
    least = {}
    for i, r in enumerate(data):
        if r[0] is not None:
            least[at[i]] = min(least.get(at[i], r[0]), r[0])
    want = Counter((r[0], f"{prints[i]:016x}", least.get(at[i])) for i, r in enumerate(data))
    assert Counter(tuple(r) for r in simhash_groups(table(spark, data)).select("doc_id", "fingerprint", "component_id").collect()) == want


def near(rng: random.Random, groups: int, each: int, flips: int) -> list[int]:
    out = set()
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(each):
            x = base
            for _ in range(rng.randint(0, flips)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_trie_pairs(budget):
    v = np.array(near(random.Random(budget), 20, 25, 3), np.uint64)
    i, j = trie_pairs(v, np.zeros(len(v), np.int64), budget)
    pairs = list(zip(i.tolist(), j.tolist()))
    want = {(a, b) for a in range(len(v)) for b in range(a + 1, len(v)) if (int(v[a]) ^ int(v[b])).bit_count() <= budget}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


@pytest.mark.parametrize("limit", [1024, 6])
def test_split_top_nodes_lose_nothing(spark, limit):
    """A small limit splits the top nodes several times over."""
    v = near(random.Random(9), 8, 60, 3)
    signed = [(x - 2**64 if x >= 2**63 else x, i) for i, x in enumerate(v)]
    edges = links(spark.createDataFrame(signed, "fp long, rep long"), 2, limit).collect()
    want = roots([(a, b) for a in range(len(v)) for b in range(a + 1, len(v)) if (v[a] ^ v[b]).bit_count() <= 2], list(range(len(v))))
    assert roots([(r["a"], r["b"]) for r in edges], list(range(len(v)))) == want


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    some = [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    edges = chain + star + some + chain[:3] + [(None, 3), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    plain = [(a, b) for a, b in edges if a is not None and a != b]
    nodes = sorted({x for e in plain for x in e})
    assert got == roots(plain, nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_rows_loses_no_row_without_or_with_a_repeated_id(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(90)) for _ in range(9)]
    data = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (4, texts[2]), (7, texts[3]), (7, texts[4]), (7, texts[4]),
            (9, texts[5]), (8, texts[5]), (10, texts[6]), (None, texts[7])]
    docs = clashing(table(spark, [(*r, "en", "a", 1) for r in data]))
    kept = keep_rows(docs)
    assert kept.columns == docs.columns
    want = [(None, texts[0]), (None, texts[1]), (4, texts[2]), (7, texts[3]), (7, texts[4]), (8, texts[5]), (10, texts[6]), (None, texts[7])]
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(want)
    import corpus_pipeline
    out = corpus_pipeline.simhash_stage(spark, docs, "").collect()
    assert Counter(r["text"] for r in out) == Counter(t for _, t in want)
    ids = Counter(r["doc_id"] for r in out)
    assert ids.pop(7) == 2 and set(ids.values()) == {1} and None not in ids
    assert keep_rows(table(spark, [])).count() == 0

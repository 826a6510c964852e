import random
from collections import Counter, defaultdict

import numpy as np
from cases import clashing, rows, table

from shelfline.llm.line_dedup import PerfectHash, line_dedup


def key(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(texts: list[str | None], min_docs: int, min_chars: int) -> list[tuple]:
    docs = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if docs[key(x)] < min_docs]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_against_brute_force(spark):
    data = rows()
    for min_docs, min_chars in ((10, 1), (3, 8)):
        got = line_dedup(clashing(table(spark, data)), min_docs, min_chars, block_bytes=2000, shard_lines=20).collect()
        want = Counter((r[0], *b) for r, b in zip(data, brute([r[1] for r in data], min_docs, min_chars)))
        assert Counter((r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in got) == want
        assert all(r["key"] == "mine" for r in got)


def test_empty(spark):
    assert line_dedup(table(spark, [])).count() == 0
    got = line_dedup(table(spark, [(i, None, None, None, None) for i in range(20)])).collect()
    assert [(r["kept_text"], r["n_lines"], r["n_dropped"]) for r in got] == [("", 1, 0)] * 20


def test_perfect_hash_is_minimal_and_survives_packing():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 30_000):
        keys = np.unique(rng.integers(0, 2**63, (n, 2), dtype=np.uint64), axis=0)
        built = PerfectHash.build(keys)
        assert sorted(built.slots(keys).tolist()) == list(range(len(keys)))
        assert (PerfectHash.unpacked(**built.packed()).slots(keys) == built.slots(keys)).all()


def test_keys_that_no_level_separates_go_to_the_rest():
    keys = np.array([[5, 0], [6, 0]], np.uint64)
    hash_ = PerfectHash([], keys)
    assert sorted(hash_.slots(keys).tolist()) == [0, 1]
    assert hash_.slots(np.array([[9, 9]], np.uint64)).tolist() == [-1]


def test_a_line_everywhere_is_one_entry_per_block(spark):
    rng = random.Random(2)
    data = [(i, f"same\nown {rng.random()}", "en", "a", 1) for i in range(500)]
    got = line_dedup(table(spark, data)).collect()
    by = defaultdict(int)
    for r in got:
        by[r["n_dropped"]] += 1
    assert by == {1: 500}

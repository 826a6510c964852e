import re
from collections import Counter

import pytest
from cases import clashing, prose, rows, table

from shelfline.llm.substring_dedup import substring_dedup


def brute(data: list[tuple], window: int) -> Counter:
    words = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in data]
    ids = [2**63 if r[0] is None else r[0] for r in data]
    least: dict[tuple, int] = {}
    for d, w in zip(ids, words):
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            least[g] = min(least.get(g, 2**64), d)
    out = Counter()
    for r, d, w in zip(data, ids, words):
        gone = {p for i in range(len(w) - window + 1) if least[tuple(w[i:i + window])] < d for p in range(i, i + window)}
        out[r[0], " ".join(x for p, x in enumerate(w) if p not in gone), len(w), len(gone)] += 1
    return out


@pytest.mark.parametrize(("window", "gram"), [(13, 5), (6, 5), (5, 5), (13, 1)])
def test_against_brute_force(spark, window, gram):
    data = rows() + [(500, "x y " * 200, "en", "a", 1), (501, "y x " * 100, "en", "a", 1), (499, "x " * 12, "en", "a", 1), (498, "x y " * 7, "en", "a", 1)]
    got = substring_dedup(clashing(table(spark, data)), window, gram, block_bytes=4000, shard_words=500)
    assert Counter((r["doc_id"], r["kept_text"], r["n_words"], r["n_removed"]) for r in got.collect()) == brute(data, window)
    assert got.filter("n_removed > 0").count() > 10 and got.filter("key = 'mine'").count() == len(data)


def test_within_one_block(spark, monkeypatch):
    from shelfline.llm import substring_dedup as module
    monkeypatch.setattr(module, "LEAST_BLOCKS", 1)
    data = rows(seed=7)
    got = module.substring_dedup(table(spark, data), block_bytes=1 << 40)
    assert Counter((r["doc_id"], r["kept_text"], r["n_words"], r["n_removed"]) for r in got.collect()) == brute(data, 13)


def test_partial_overlap_of_passages(spark):
    """A document may own part of a passage that a later one holds whole."""
    import random
    p = prose(random.Random(8), 60, lines=1000).split(" ")
    data = [(1, " ".join(p[:30]), "", "", 0), (2, " ".join(p[20:50]), "", "", 0), (3, " ".join(p), "", "", 0), (4, " ".join(p[40:] + p[:20]), "", "", 0)]
    got = substring_dedup(table(spark, data))
    assert Counter((r["doc_id"], r["kept_text"], r["n_words"], r["n_removed"]) for r in got.collect()) == brute(data, 13)


def test_empty(spark):
    assert substring_dedup(table(spark, [])).count() == 0

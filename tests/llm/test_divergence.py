import re
from collections import Counter, defaultdict

import pytest
from cases import clashing, prose, rows, table
from pyspark.sql import functions as F

from shelfline.llm import divergence
from shelfline.llm.divergence import source_divergence, term_counts

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(data, min_docs: int = 10, top: int = 10) -> set[tuple]:
    """Dense shares of every kept term, one loop per pair of sources."""
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for _, text, lang, source, _ in data]
    uses, found = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        uses[lang, source].update(terms)
        found[lang].update(set(terms))
    out = set()
    for lang in found:
        kept = [t for t, n in found[lang].items() if n >= min_docs]
        sources = sorted({s for x, s in uses if x == lang}, key=lambda s: s.encode())

        def shares(count):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // total for t in kept}

        whole = shares(sum((uses[lang, s] for s in sources), Counter()))
        p = {s: shares(uses[lang, s]) for s in sources}

        def differ(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(sum(differ(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(differ(p[s][t], whole[t]), t) for t in kept if uses[lang, s][t] and p[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items[:most])}
    return out


def audited(df, **kw) -> list[tuple]:
    return [tuple(r) for r in source_divergence(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect()]


def many(n: int = 120) -> list[tuple]:
    """Three languages; one source holds over a third; one without kept terms, one without terms, one alone in its language."""
    import random
    rng = random.Random(5)
    out = []
    for i in range(n):
        source = "hot" if i % 5 < 2 else ["a", "b", None, "ä", "z"][i % 5]
        out.append((i, prose(rng, 60, vocabulary=40 + 5 * (i % 4)).replace("w", rng.choice(["w", "W", "é"])), "en" if i % 3 else None, source, 0))
    out += [(n + i, "once upon " + "xyz"[:1 + i % 3] * i, "en", "rare", 0) for i in range(4)]
    out += [(n + 10, "123 456 !", "en", "mute", 0), (n + 11, None, "en", None, 0), (n + 12, "", None, "void", 0)]
    out += [(n + 20 + i, "lonely words of one source", "fr", "solo", 0) for i in range(12)]
    out += [(n + 40, "too few", "de", "a", 0), (n + 41, "zu wenig", "de", "b", 0)]  # keeps no term
    return out


@pytest.mark.parametrize("shards", [divergence.SHARD_POSTINGS, (7, 7), (1, 1)])
def test_equals_dense_sums(spark, shards):
    data = many()
    got = audited(table(spark, data), shard_postings=shards)
    assert len(got) == len(set(got)) and set(got) == brute(data)
    assert {r[:2] for r in got if r[2] == "pair"} >= {("en", "mute"), ("en", "rare"), ("", "void"), ("de", "a")}
    assert not [r for r in got if r[0] == "fr" and r[2] == "pair"]
    assert {r[4] for r in got if r[0] == "de"} == {0}


def test_small_portions_and_lanes(monkeypatch):
    """Rows of the accumulator, worked out in steps of any width, equal the dense sums."""
    import numpy as np
    rng = np.random.default_rng(3)
    g, terms = 6, 30
    held = rng.random((g, terms)) < 0.4
    share = np.where(held, rng.integers(5, 10**9, (g, terms)), 0)
    base = rng.integers(1, 5, g)
    s, t = np.nonzero(held)
    whole = np.where(held, share, base[:, None])
    dense = divergence._differ(whole[:, None, :], whole[None]).sum(2)
    for lanes in (1, 7, 1 << 20):
        monkeypatch.setattr(divergence, "LANES", lanes)
        acc = np.zeros((g, g), np.int64)
        for row, total in divergence._accumulated(s, t, share[s, t], base):
            acc[row] = total
        np.fill_diagonal(acc, 0)
        zero = terms * divergence._differ(base[:, None], base[None])
        assert (acc + acc.T + zero == dense).all()


def test_awkward_rows(spark, monkeypatch):
    data = rows()
    want = brute(data, 3, 4)
    docs = clashing(table(spark, data)).withColumns({c: F.lit("mine") for c in ("term", "part", "item", "value", "rank", "base", "shard")})
    assert set(audited(docs, min_docs=3, top_terms=4)) == want
    assert set(audited(docs.repartition(7), min_docs=3, top_terms=4)) == want
    assert audited(table(spark, [])) == []
    assert audited(table(spark, [(None, None, None, None, None)])) == []
    assert {tuple(r) for r in term_counts(table(spark, [(1, "Ab ab C3c", "x", None, 0)])).collect()} == {
        ("x", "", "ab", 2, 1), ("x", "", "c", 2, 1), ("x", "", None, 0, 0)}


def test_counts_in_portions(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(divergence, "FLUSH_TERMS", 3)
    batch = pa.RecordBatch.from_pydict({"lang": [b"en"] * 9, "source": [b"a", b"b", b"a"] * 3, "text": [b"one two three four", b"", b"two"] * 3})
    total = Counter()
    for portion in divergence._counted(iter([batch])):
        for r in portion.to_pylist():
            total[r["source"], r["term"]] += r["n"]
    assert total == Counter({(b"a", b"two"): 6, **{(b"a", t): 3 for t in (b"one", b"three", b"four")}, (b"a", None): 0, (b"b", None): 0})

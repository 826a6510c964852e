import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from cases import clashing, rows, table

from shelfline.llm.perplexity import HOLD_OUT, perplexity, quality_classifier


def windows(text: str | None, order: int) -> list[bytes]:
    b = b" ".join((text or "").encode().split())
    if not b:
        return []
    b = b"\0" * (order - 1) + b + b"\0"
    return [b[i:i + order] for i in range(len(b) - order + 1)]


class Brute:
    """Interpolated modified Kneser-Ney, from its definition."""

    def __init__(self, texts: list[str | None], order: int):
        self.order = order
        self.counts = {order: Counter(g for t in texts for g in windows(t, order))}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.discounts, self.context = {}, {}
        for k, c in self.counts.items():
            n = Counter(c.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
            self.discounts[k] = [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i) if n[i] else 0.5 for i in (1, 2, 3)]
            at = defaultdict(lambda: [0, 0.0])
            for g, x in c.items():
                at[g[:-1]][0] += x
                at[g[:-1]][1] += self.discounts[k][min(x, 3) - 1]
            self.context[k] = at

    def p(self, g: bytes) -> float:
        k = len(g)
        if k == 0:
            return 1 / 257
        if g[:-1] not in self.context[k]:
            return self.p(g[1:])
        total, freed = self.context[k][g[:-1]]
        x = self.counts[k][g]
        return (x - (self.discounts[k][min(x, 3) - 1] if x else 0)) / total + freed / total * self.p(g[1:])

    def bits(self, text: str | None) -> float | None:
        w = windows(text, self.order)
        return -sum(math.log2(self.p(g)) for g in w) / len(w) if w else None


@pytest.mark.parametrize("order", [2, 5])
def test_against_brute_force(spark, order):
    data = [r for r in rows() if len(r[1] or "") < 5000]
    trusted = [r[0] for r in data if r[0] is not None and r[0] % 2 == 0]
    train = [r[1] for r in data if r[0] in trusted and zlib.crc32(str(r[0]).encode()) % HOLD_OUT]
    model = Brute(train, order)
    df = perplexity(clashing(table(spark, data)), spark.createDataFrame([(x,) for x in trusted], "doc_id long"), order, block_bytes=4000)
    got = sorted(((str(r["doc_id"]), r["bits"] if r["bits"] is not None else -1.0) for r in df.collect()))
    want = sorted(((str(r[0]), b if (b := model.bits(r[1])) is not None else -1.0) for r in data))
    assert [d for d, _ in got] == [d for d, _ in want]
    assert [b for _, b in got] == pytest.approx([b for _, b in want], abs=0.01)  # values travel in steps of 1/1024 bit


def test_probabilities_add_up():
    model = Brute(["abracadabra", "banana band"], 3)
    for context in (b"ab", b"an", b"zz"):
        assert sum(model.p(context + bytes([c])) for c in range(256)) == pytest.approx(1, abs=0.01)


def test_junk_is_told_from_prose(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["the", "an", "ing", "on", "er", "st"]) for _ in range(rng.randint(1, 3)))
    clean = [(i, " ".join(word() for _ in range(80)), "en", "s", None) for i in range(600)]
    junk = [(1000 + i, " ".join(word().upper() + "!!" + rng.choice("#$%") for _ in range(80)), "en", "s", None) for i in range(50)]
    odd = [(2000, None, "en", None, None), (2001, "", None, None, None), (2002, "the", "fr", None, None)]
    out = quality_classifier(table(spark, clean + junk + odd), spark.createDataFrame([(i,) for i in range(0, 600, 2)], "doc_id long")).collect()
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert len(out) == len(kept) == len(clean + junk + odd)
    assert sum(kept[i] for i in range(600)) >= 597 and not any(kept[1000 + i] for i in range(50))
    assert not kept[2000] and not kept[2001]
    few = next(r for r in out if r["doc_id"] == 2002)  # no held-out rows of its language: everyone's, for a text of its bytes
    assert few["threshold"] > max(r["threshold"] for r in out if r["doc_id"] < 600) and few["kept"] == (few["perplexity"] <= few["threshold"])
    assert all(r["perplexity"] is None or 1 <= r["perplexity"] for r in out)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert quality_classifier(table(spark, []), none).count() == 0
    got = quality_classifier(table(spark, rows()), none).collect()
    assert len(got) == len(rows()) and not any(r["kept"] for r in got)


def test_a_third_without_an_id_and_one_shared_by_many(spark):
    """Such rows are scored as any other, and dealt over many blocks."""
    from shelfline.llm import perplexity as module
    data = [(None if i % 3 == 0 else 3 if i % 3 == 1 else r[0], *r[1:]) for i, r in enumerate(r for r in rows() if len(r[1] or "") < 5000)]
    trusted = [r[0] for r in data if r[0] is not None and r[0] % 2 == 0] + [3]
    train = [r[1] for r in data if r[0] in trusted and zlib.crc32(str(r[0]).encode()) % HOLD_OUT]
    model = Brute(train, 3)
    df = perplexity(table(spark, data), spark.createDataFrame([(x,) for x in trusted] + [(None,)], "doc_id long"), 3, block_bytes=500)
    got = sorted(((str(r["doc_id"]), r["bits"] if r["bits"] is not None else -1.0) for r in df.collect()))
    want = sorted(((str(r[0]), b if (b := model.bits(r[1])) is not None else -1.0) for r in data))
    assert [d for d, _ in got] == [d for d, _ in want] and [b for _, b in got] == pytest.approx([b for _, b in want], abs=0.01)
    assert module.SPREAD > 1


def test_threshold_is_the_quantile(spark):
    """Of the held-out trusted rows of a language and size: the larger of their own quantile and the normal one."""
    from statistics import NormalDist, mean

    from shelfline.llm.perplexity import LEAST_HELD
    rng = random.Random(13)
    data = [(i, " ".join(rng.choice(["the", "an", "ing", "on"]) for _ in range(60)), ["en", "de"][i % 5 == 0], "s", None) for i in range(900)]
    docs, trusted = table(spark, data), spark.createDataFrame([(i,) for i in range(900)], "doc_id long")
    bits = {r["doc_id"]: (r["lang"], r["n_bytes"], r["bits"]) for r in perplexity(docs, trusted).collect()}
    out = {r["doc_id"]: r for r in quality_classifier(docs, trusted, quantile=0.9).collect()}
    held = defaultdict(list)
    for i, (lang, n, b) in bits.items():
        if zlib.crc32(str(i).encode()) % HOLD_OUT == 0:
            held[lang, int(math.log2(n) / 2)].append((b, n))
    key = max(held, key=lambda k: len(held[k]))
    x = sorted(held[key])
    assert len(x) >= LEAST_HELD
    own, m = x[math.ceil(0.9 * len(x)) - 1][0], mean(b for b, _ in x)
    deviation = math.sqrt(mean(n * (b - m) ** 2 for b, n in x))
    of_key = [(i, n) for i, (lang, n, _) in bits.items() if (lang, int(math.log2(n) / 2)) == key]
    assert len(of_key) > 100
    for i, n in of_key:
        want = max(own, m + NormalDist().inv_cdf(0.9) * deviation / math.sqrt(n))
        assert math.log2(out[i]["threshold"]) == pytest.approx(want, abs=1e-6)
        assert out[i]["kept"] == (out[i]["perplexity"] <= out[i]["threshold"])

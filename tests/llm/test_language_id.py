import math
import random
import zlib

import numpy as np
import pytest
from cases import clashing, rows, table
from pyspark.sql import functions as F

from shelfline.llm.language_id import Parser, language_id, learn, letters, suffix_automaton

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ein", "er"], "cc": ["ión", "as", "lla", "que"]}


def speak(rng: random.Random, lang: str, words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def corpus(n: int = 300) -> list[tuple]:
    rng = random.Random(4)
    langs = list(SYLLABLES)
    return [(i, speak(rng, langs[i % 3], rng.choice([5, 40, 200])), langs[i % 3], "s", None) for i in range(n)]


def test_suffix_automaton_holds_exactly_the_substrings():
    text = b"abracadabra abba"
    go = suffix_automaton(text)

    def holds(s: bytes) -> bool:
        state = 0
        for c in s:
            if c not in go[state]:
                return False
            state = go[state][c]
        return True

    rng = random.Random(1)
    for _ in range(500):
        s = bytes(rng.choice(b"abrcd ") for _ in range(rng.randint(1, 6)))
        assert holds(s) == (s in text)


def phrases(text: bytes, sample: bytes, segment: int) -> int:
    """Greedy longest phrases that the sample holds, by plain search."""
    n = 0
    for x in range(0, max(1, len(text)), segment):
        part, i = text[x:x + segment], 0
        while i < len(part):
            k = 1
            while i + k < len(part) and part[i:i + k + 1] in sample:
                k += 1
            n += 1
            i += k
    return n


def test_parser_counts_greedy_phrases():
    samples = (("aa", b"kalomi tu lo"), ("bb", b"schein erung"))
    parser = Parser(samples)
    texts = ["kalo tulo", "einschung er", "Kalo, SCHEIN 42 über ka", "ka" * 900]
    for t in texts:
        b = letters(t)
        want = [phrases(b, s, 512) * math.log2(len(s)) for _, s in samples]
        assert parser.predict([t])[0] == [samples[int(np.argmin(want))][0]]
    assert parser.predict(texts) == tuple(list(x) for x in zip(*[(parser.predict([t])[0][0], parser.predict([t])[1][0]) for t in texts]))


def test_held_out_accuracy(spark):
    docs = table(spark, corpus())
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    samples = learn(docs.filter(~held))
    assert [lang for lang, _ in samples] == ["aa", "bb", "cc"]
    out = language_id(clashing(docs), samples).collect()
    tested = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(tested) > 40 and sum(r["lang_pred"] == r["lang"] for r in tested) / len(tested) > 0.97
    assert all(0 <= r["score"] <= 1 and r["key"] == "mine" for r in out)


def test_awkward_rows(spark):
    samples = learn(table(spark, corpus()))
    data = rows() + [(400, "123 456 ...", "en", "a", 1), (401, "漢字かな", None, None, None)]
    out = {str((r["doc_id"], r["text"])): r for r in language_id(table(spark, data), samples).collect()}
    for d, text, *_ in data:
        r = out[str((d, text))]
        spoken = bool(text) and any(c.isalpha() for c in text)
        assert (r["lang_pred"] != "und") == spoken and (spoken or r["score"] == 0)


def test_nothing_learned_and_empty(spark):
    none = learn(table(spark, [(1, None, "en", None, None), (2, "text", None, None, None)]))
    assert none == ()
    assert [r["lang_pred"] for r in language_id(table(spark, rows()[:3]), none).collect()] == ["und"] * 3
    assert language_id(table(spark, []), learn(table(spark, corpus(30)))).count() == 0


@pytest.mark.parametrize("docs", [4, 50])
def test_sample_is_bounded(spark, docs):
    samples = learn(table(spark, corpus()), sample_docs=docs, sample_chars=1000)
    assert all(len(s) <= 1000 for _, s in samples)


@pytest.mark.parametrize("ids", ["null", "repeated"])
def test_languages_without_ids_of_their_own_are_learned(spark, ids):
    """A language whose rows have no doc_id, or share one, is learned from as many of them as any other."""
    rng = random.Random(8)
    data = [(None if ids == "null" else 5, speak(rng, "aa", 12), "aa", "s", None) for _ in range(1500)] + [(i, speak(rng, "bb", 12), "bb", "s", None) for i in range(100)]
    data += [(None, "ión las que " * 5, "cc", "s", None)] * 1200  # one row, many times
    samples = learn(table(spark, data))
    assert [lang for lang, _ in samples] == ["aa", "bb", "cc"]
    sizes = {lang: len(s) for lang, s in samples}
    assert sizes["aa"] > sizes["bb"] and sizes["cc"] < 100
    again = learn(table(spark, data).repartition(5))
    assert again == samples
    test = [(i, speak(rng, lang, 20), None, "s", None) for i, lang in enumerate(["aa", "bb"] * 20)]
    got = {r["doc_id"]: r["lang_pred"] for r in language_id(table(spark, test), samples).collect()}
    assert all(got[i] == ["aa", "bb"][i % 2] for i in got)


def test_the_sample_is_bounded(spark):
    rng = random.Random(9)
    data = [(i, speak(rng, "aa", 30), "aa", "s", None) for i in range(400)]
    (lang, sample), = learn(table(spark, data), sample_docs=7, sample_chars=500)
    assert lang == "aa" and 0 < len(sample) <= 500
    assert learn(table(spark, [])) == () and learn(table(spark, [(1, "123", "aa", "s", None), (2, None, "bb", "s", None)])) == ()

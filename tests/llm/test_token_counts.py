import random

import public_tokenizers
import pytest
from cases import clashing, rows, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm.token_counts import Lengths, pieces, splits_safely, token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = [*"ab'stdrevlm 12.,!\n\t\r\x0b\x1c\x1f\x85\xa0   é中文字ñ́\U0001F600", "　", "᠎", "​", "﻿", "<|endoftext|>", " <|endoftext|>", "'ll", "'re", " '", "   ", " \n ", "\n\n\n"]


def whole(texts: list[str], path: str = BYTE_BPE) -> list[int]:
    """Brute force: the library over every whole text."""
    if path.endswith(".model"):
        import sentencepiece
        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    return [len(e) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=80), st.lists(st.sampled_from(AWKWARD), max_size=60).map("".join)), min_size=1, max_size=5), st.sampled_from([2, 7, 40]))
def test_stretches_have_the_tokens_of_the_text(texts, size):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    assert Lengths(BYTE_BPE, size, 3 * size, 50)(texts) == whole(texts)


def test_pieces_are_bounded_and_whole():
    rng = random.Random(4)
    text = " ".join("x" * rng.randrange(1, 30) for _ in range(5000))
    cut = pieces(text, 1000)
    assert "".join(cut) == text and max(map(len, cut)) <= 1000 and len(cut) < len(text) / 900
    assert pieces("y" * 5000, 1000) == ["y" * 5000]  # no safe place
    assert pieces("a\tb" * 2000, 100) == ["a\tb" * 2000]  # a tab is none
    assert pieces("y" * 5000 + " z", 1000) == ["y" * 5000, " z"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_every_kind_of_file(spark, name):
    path = public_tokenizers.path(name)
    docs = table(spark, rows())
    got = token_counts(docs, path).select("text", "n_bytes", "n_tokens", "over_limit").collect()
    want = whole([r["text"] or "" for r in got], path)
    assert [r["n_tokens"] for r in got] == want
    assert all(r["n_bytes"] == len((r["text"] or "").encode()) and r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    assert any(r["over_limit"] for r in got) and len(got) == len(rows())


def test_files_that_may_not_be_cut():
    fine = {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}, "model": {"type": "BPE"}}
    assert splits_safely(fine)
    token = {"content": "<x>", "lstrip": False, "rstrip": False, "single_word": False}
    assert splits_safely({**fine, "added_tokens": [token]})
    for other in ({"added_tokens": [{**token, "lstrip": True}]}, {"added_tokens": [{**token, "content": "a b"}]}, {"normalizer": {"type": "NFC"}},
                  {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}, {"model": {"type": "Unigram"}}, {"pre_tokenizer": None}):
        assert not splits_safely({**fine, **other})


def test_awkward_rows(spark):
    docs = clashing(table(spark, rows())).withColumns({c: F.lit("mine") for c in ("n_bytes", "n_tokens", "over_limit")})
    out = token_counts(docs, BYTE_BPE)
    assert out.filter("row = 'mine' and n_words = 'mine'").count() == len(rows())
    assert dict(out.dtypes)["n_tokens"] == "bigint" and dict(out.dtypes)["n_bytes"] == "bigint"
    empty = out.filter("coalesce(text, '') = ''").select("n_bytes", "n_tokens", "over_limit").distinct().collect()
    assert [tuple(r) for r in empty] == [(0, 0, False)]
    assert token_counts(table(spark, []), BYTE_BPE).count() == 0
    broken = spark.createDataFrame([(1, bytearray(b"ab\xff\xfecd <|endoftext|>"))], "doc_id long, raw binary").select("doc_id", F.col("raw").cast("string").alias("text"))
    got = token_counts(broken, BYTE_BPE).select("n_bytes", "n_tokens").first()
    assert got["n_bytes"] == 20 and got["n_tokens"] == whole([b"ab\xff\xfecd <|endoftext|>".decode("utf-8", "replace")])[0]


def test_query_equals_the_library(spark):
    from shelfline.llm.queries import REGISTRY
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in REGISTRY["op13_token_counts"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = whole([r["text"] or "" for r in docs])
    assert got == {r["doc_id"]: (len((r["text"] or "").encode()), n, n > 1024) for r, n in zip(docs, want)}

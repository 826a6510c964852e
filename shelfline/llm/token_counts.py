"""Operator 13, token counts.

Every whole text goes through the library of its tokenizer file in an Arrow
function that returns lengths only: no ids, offsets or token strings leave
the worker. Long texts are cut into pieces of about ``piece_bytes``, and
pieces are gathered into batches of about ``batch_bytes``, whatever number
of rows an Arrow batch holds, so a worker's memory follows the batch and not
the text.

A text is only cut at safe places, where every tokenization ends a word
anyway: between a character that is no white space and a plain space or line
feed. The word pattern of a byte-level BPE has no alternative that runs
across such a place, none that looks back, and its only look-ahead stands
inside a run of white space; so the tokens of the stretches between safe
places are the text's tokens. Therefore a batch is encoded as its distinct
stretches, and a worker remembers the lengths of up to ``KNOWN_BYTES`` of
them. A stretch without a safe place stays whole, however long.

This is known for a ``ByteLevel`` pre-tokenizer with the pattern on, no
prefix space, no normaliser, and added tokens without white space; for any
other file (``word_bpe``, SentencePiece) whole texts are encoded in batches.

The tokenizer file is opened once per worker at ``path``, which every machine
must have; it is never shipped or trained. Counting is a map over rows:
nothing is shuffled, and no source or group of copies matters.

Defined results: a null or empty text has no bytes and no tokens; bytes that
are no UTF-8 count as the replacement character; special strings in a text
are taken as the library takes them by default. Rows are independent, so
repeated rows and an empty table need no rule. Clashing columns are replaced.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_TOKENS = 1024
PIECE_BYTES = 32 << 10
BATCH_BYTES = 256 << 10
KNOWN_BYTES = 4 << 20
ADDED = ("n_bytes", "n_tokens", "over_limit")
#: Between a character that no engine takes for white space, and a space or line feed.
_SAFE = re.compile(r"(?<=[^\s\x00-\x20\x7F-\xA0᠎​﻿])(?=[ \n])")


def splits_safely(spec: dict) -> bool:
    """Whether a ``tokenizers`` file may be given a text in pieces cut at ``_SAFE`` places."""
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    plain = all(not t.get("lstrip") and not t.get("rstrip") and not t.get("single_word") and not re.search(r"\s", t["content"])
                for t in spec.get("added_tokens") or [])
    return (plain and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", True) and model.get("type") == "BPE" and not model.get("dropout"))


def pieces(text: str, size: int = PIECE_BYTES) -> list[str]:
    """``text`` cut at safe places into pieces of about ``size`` characters."""
    out, start = [], 0
    while len(text) - start > size:
        # The last safe place of the next ``size`` characters, or the first one after them.
        at = max(text.rfind(" ", start + 1, start + size), text.rfind("\n", start + 1, start + size))
        while at > start and not _SAFE.match(text, at):
            at = max(text.rfind(" ", start + 1, at), text.rfind("\n", start + 1, at))
        if at <= start:
            found = _SAFE.search(text, start + size)
            if found is None:
                break
            at = found.start()
        out.append(text[start:at])
        start = at
    return [*out, text[start:]]


@cache
def counter(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """(lengths of a batch of texts, whether texts may be given in pieces) of the tokenizer file at ``path``."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)], False
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as f:
        safe = splits_safely(json.load(f))
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], safe


class Lengths:
    """Numbers of tokens by the tokenizer file at ``path``; remembers the stretches it has seen."""

    def __init__(self, path: str, piece_bytes: int = PIECE_BYTES, batch_bytes: int = BATCH_BYTES, known_bytes: int = KNOWN_BYTES):
        self.encode, self.safe = counter(path)
        self.piece_bytes, self.batch_bytes, self.known_bytes = piece_bytes, batch_bytes, known_bytes
        self.known: dict[str, int] = {}
        self.held = 0

    def _learn(self, stretches: list[str]) -> None:
        start, size = 0, 0
        for i, s in enumerate(stretches):
            if size and size + len(s) > self.batch_bytes:
                self.known.update(zip(stretches[start:i], self.encode(stretches[start:i])))
                start, size = i, 0
            size += len(s)
            self.held += len(s)
        if start < len(stretches):
            self.known.update(zip(stretches[start:], self.encode(stretches[start:])))

    def _of_batch(self, batch: list[str]) -> list[int]:
        if not self.safe:
            return self.encode(batch)
        cut = [_SAFE.split(piece) for piece in batch]
        if self.held > self.known_bytes:
            self.known.clear()
            self.held = 0
        self._learn([s for s in set().union(*cut) if s not in self.known])
        return [sum(map(self.known.__getitem__, stretches)) for stretches in cut]

    def __call__(self, texts: Iterable[str]) -> list[int]:
        out: list[int] = []
        batch: list[str] = []
        owner: list[int] = []
        size = 0
        for text in texts:
            out.append(0)
            for piece in pieces(text, self.piece_bytes) if self.safe else [text]:
                if size and size + len(piece) > self.batch_bytes:
                    for i, n in zip(owner, self._of_batch(batch)):
                        out[i] += n
                    batch, owner, size = [], [], 0
                batch.append(piece)
                owner.append(len(out) - 1)
                size += len(piece)
        for i, n in zip(owner, self._of_batch(batch) if batch else []):
            out[i] += n
        return out


def token_counts(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS, piece_bytes: int = PIECE_BYTES, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens by the tokenizer file at ``path``, and whether they are over ``max_tokens``."""
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lengths = Lengths(path, piece_bytes, batch_bytes)
        for texts in batches:
            yield pa.array(lengths(t.as_py().decode("utf-8", "replace") for t in texts), pa.int64())

    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    n_tokens = F.arrow_udf(count, T.LongType())(text)
    counted = docs.drop(*ADDED).withColumns({"n_bytes": F.octet_length(text).cast("long"), "n_tokens": n_tokens})
    return counted.withColumn("over_limit", F.col("n_tokens") > max_tokens)

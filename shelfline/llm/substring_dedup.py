"""Operator 10, substring dedup by repeated-phrase automata.

A window is ``window`` consecutive words of one document. Every word covered
by a window that also starts in a document with a smaller doc_id is removed.

1. Documents are dealt into blocks by a hash of their row. Every window has an
   anchor, the least hash among its runs of ``gram`` words; equal windows have
   equal anchors, and only about a fifth of the places hold a new one. Blocks
   send their distinct anchors, packed, to shards, which answer with those
   that stand in several documents.
2. Windows with such an anchor are candidates. Blocks send their distinct
   candidates (128-bit hash, least doc_id in the block) to shards; a shard
   confirms the ones that start in a smaller doc_id of another block.
3. Runs of confirmed windows, and of those that recur within the block, are
   the block's repeated passages. It compiles them into an Aho-Corasick
   automaton and streams all its documents through it to locate every
   occurrence. Words are spelled in a small alphabet, since the automaton
   searches a node's branches one by one.

A passage that stands everywhere is one entry per block and shard, so no
group, document pair or posting list is ever gathered whole.

Defined results: a null or empty text has no words; documents shorter than a
window lose nothing; rows that share a doc_id do not remove each other's
words; a null doc_id counts as larger than any other; an empty table gives an
empty table. Clashing columns are replaced, and ``_block`` is dropped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import by_shard

WINDOW = 13
GRAM = 5
BLOCK_BYTES = 8 << 20
LEAST_BLOCKS = 256
SHARD_WORDS = 8_000_000
LEAST_SHARDS = 64
#: Words tokenised at once.
BATCH_WORDS = 1 << 18
ADDED = [T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
_NO_ID = 2**63 - 1
_ELSEWHERE = -2**63  # a smaller doc_id in another block


class Tokens:
    """Words of several documents in a row, with the anchor of every window."""

    def __init__(self, ids: list[int], words: list[list[bytes]], window: int, gram: int):
        self.ids, self.words, self.flat = ids, words, list(chain.from_iterable(words))
        lengths = np.array([len(w) for w in words], np.int64)
        self.ends = np.cumsum(lengths)
        n = len(self.flat) - window + 1
        if n <= 0:
            self.at, self.doc, self.anchor = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
            return
        h = np.fromiter(map(zlib.crc32, self.flat), np.uint64, len(self.flat))
        grams = len(h) - gram + 1
        g = np.zeros(grams, np.uint64)
        for j in range(gram):
            g = (g + h[j:j + grams]) * np.uint64(0x9E3779B97F4A7C15)
            g ^= g >> np.uint64(29)
        g = (g ^ (g >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        g ^= g >> np.uint64(31)
        span, low = 1, g
        while span * 2 <= window - gram + 1:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        rest = window - gram + 1 - span
        low = np.minimum(low[:len(low) - rest], low[rest:]) if rest else low
        doc = np.repeat(np.arange(len(words)), lengths)[:n]
        fits = np.arange(n) + window <= self.ends[doc]
        self.at, self.doc, self.anchor = np.flatnonzero(fits), doc[fits], low[:n][fits]


def _tokens(docs: pa.Table, window: int, gram: int) -> Iterator[Tokens]:
    ids, words, n = [], [], 0
    for d, text in zip(docs["doc_id"].to_pylist(), docs["text"].cast(pa.binary()).to_pylist()):
        ids.append(_NO_ID if d is None else d)
        words.append((text or b"").split())  # bytes: ASCII white space only
        n += len(words[-1])
        if n >= BATCH_WORDS:
            yield Tokens(ids, words, window, gram)
            ids, words, n = [], [], 0
    if ids:
        yield Tokens(ids, words, window, gram)


_ANCHORS_SQL = "_block long, _shard long, keys binary, many binary"
_ANCHORS = pa.schema([("_block", pa.int64()), ("_shard", pa.int64()), ("keys", pa.binary()), ("many", pa.binary())])
_WINDOWS_SQL = "_block long, _shard long, keys binary, least binary"
_WINDOWS = pa.schema([("_block", pa.int64()), ("_shard", pa.int64()), ("keys", pa.binary()), ("least", pa.binary())])
_ANSWER_SQL = "_block long, kind int, keys binary"
_ANSWER = pa.schema([("_block", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary())])


def _send_anchors(shards: int, window: int, gram: int):
    def send(docs: pa.Table) -> pa.Table:
        anchors, owners, seen = [], [], 0
        for t in _tokens(docs, window, gram):
            if len(t.at):
                new = np.r_[True, (t.anchor[1:] != t.anchor[:-1]) | (t.doc[1:] != t.doc[:-1])]
                anchors.append(t.anchor[new])
                owners.append(t.doc[new] + seen)
            seen += len(t.ids)
        out = []
        if anchors:
            a, d = np.concatenate(anchors), np.concatenate(owners)
            order = np.lexsort((d, a))
            a, d = a[order], d[order]
            first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
            last = np.r_[first[1:], len(a)] - 1
            many, a = d[first] != d[last], a[first]
            block = docs["_block"][0].as_py()
            out = [{"_block": block, "_shard": s, "keys": a[at].tobytes(), "many": np.packbits(many[at]).tobytes()} for s, at in by_shard(a, shards)]
        return pa.Table.from_pylist(out, _ANCHORS)
    return send


def _recurring_anchors(rows: pa.Table) -> pa.Table:
    """For each block, its anchors that stand in several documents."""
    keys = [np.frombuffer(x, "<u8") for x in rows["keys"].to_pylist()]
    many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(rows["many"].to_pylist(), keys)])
    _, place, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    often = (n > 1) | (np.bincount(place, weights=many) > 0)
    out, at = [], 0
    for block, k in zip(rows["_block"].to_pylist(), keys):
        hit = often[place[at:at + len(k)]]
        at += len(k)
        if hit.any():
            out.append({"_block": block, "kind": 0, "keys": k[hit].tobytes()})
    return pa.Table.from_pylist(out, _ANSWER)


def _candidates(docs: pa.Table, answers: pa.Table, window: int, gram: int) -> Iterator[tuple[Tokens, list[int], list[int]]]:
    """(tokens, starts, documents) of the windows whose anchor recurs."""
    raw = [k for k, kind in zip(answers["keys"].to_pylist(), answers["kind"].to_pylist()) if kind == 0]
    known = np.sort(np.frombuffer(b"".join(raw), "<u8"))
    if not len(known):
        return
    for t in _tokens(docs, window, gram):
        place = np.minimum(np.searchsorted(known, t.anchor), len(known) - 1)
        hit = known[place] == t.anchor
        if hit.any():
            yield t, t.at[hit].tolist(), t.doc[hit].tolist()


def _send_windows(shards: int, window: int, gram: int):
    def send(docs: pa.Table, answers: pa.Table) -> pa.Table:
        least: dict[bytes, int] = {}
        for t, starts, owners in _candidates(docs, answers, window, gram):
            flat, ids = t.flat, t.ids
            for at, d in zip(starts, owners):
                key = xxhash.xxh3_128_digest(b" ".join(flat[at:at + window]))
                if ids[d] < least.get(key, _NO_ID + 1):
                    least[key] = ids[d]
        out = []
        if least:
            block = docs["_block"][0].as_py()
            keys, ids = np.frombuffer(b"".join(least), "<u8").reshape(-1, 2), np.array(list(least.values()), np.int64)
            out = [{"_block": block, "_shard": s, "keys": keys[at].tobytes(), "least": ids[at].tobytes()} for s, at in by_shard(keys[:, 0], shards)]
        return pa.Table.from_pylist(out, _WINDOWS)
    return send


def _earlier_windows(rows: pa.Table) -> pa.Table:
    """For each block, its windows that start in a smaller doc_id of another block."""
    keys = [np.frombuffer(x, "<u8").reshape(-1, 2) for x in rows["keys"].to_pylist()]
    least = np.concatenate([np.frombuffer(x, np.int64) for x in rows["least"].to_pylist()])
    every = np.concatenate(keys)
    order = np.lexsort((least, every[:, 1], every[:, 0]))
    ordered = every[order]
    first = np.flatnonzero(np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)])
    smallest = np.empty(len(least), np.int64)
    smallest[order] = np.repeat(least[order][first], np.diff(np.r_[first, len(least)]))
    later = smallest < least
    out, at = [], 0
    for block, k in zip(rows["_block"].to_pylist(), keys):
        hit = later[at:at + len(k)]
        at += len(k)
        if hit.any():
            out.append({"_block": block, "kind": 1, "keys": k[hit].tobytes()})
    return pa.Table.from_pylist(out, _ANSWER)


class Passages:
    """The automaton of a block. A passage's value is the largest of its windows' least doc_ids: a document above it loses the passage."""

    def __init__(self, docs: pa.Table, answers: pa.Table, window: int, gram: int):
        earlier = set()
        for raw, kind in zip(answers["keys"].to_pylist(), answers["kind"].to_pylist()):
            if kind == 1:
                earlier.update(raw[i:i + 16] for i in range(0, len(raw), 16))
        least: dict[bytes, int] = dict.fromkeys(earlier, _ELSEWHERE)
        found = []
        for t, starts, owners in _candidates(docs, answers, window, gram):
            flat, keys = t.flat, []
            for at, d in zip(starts, owners):
                key = xxhash.xxh3_128_digest(b" ".join(flat[at:at + window]))
                if t.ids[d] < least.get(key, _NO_ID + 1):
                    least[key] = t.ids[d]
                keys.append(key)
            found.append((t, starts, owners, keys))
        passages: dict[tuple[bytes, ...], int] = {}
        for t, starts, owners, keys in found:
            first = last = doc = -1
            most = _ELSEWHERE
            for at, d, key in chain(zip(starts, owners, keys), [(-1, -1, b"")]):
                low = least.get(key, _NO_ID)
                later = d >= 0 and low < t.ids[d]
                if first >= 0 and not (later and d == doc and at == last + 1):
                    passages[tuple(t.flat[first:last + window])] = most
                    first = -1
                if later:
                    if first < 0:
                        first, doc, most = at, d, low
                    last, most = at, max(most, low)
        words = {w for p in passages for w in p}
        self.width = 1
        while 64 ** self.width < len(words) + 1:
            self.width += 1
        self.spelling = {w: "".join(chr(48 + (i >> 6 * k & 63)) for k in range(self.width)) for i, w in enumerate(sorted(words))}
        self.unknown = "\0" * self.width
        self.automaton = ahocorasick.Automaton() if passages else None
        for p, most in passages.items():
            self.automaton.add_word("".join([self.spelling[w] for w in p]), (len(p), most))
        if passages:
            self.automaton.make_automaton()

    def covered(self, doc_id: int | None, words: list[bytes]) -> np.ndarray | None:
        """Which words the document loses."""
        if self.automaton is None:
            return None
        doc_id = _NO_ID if doc_id is None else doc_id
        get, unknown, width = self.spelling.get, self.unknown, self.width
        hits = [(end // width + 1, n) for end, (n, most) in self.automaton.iter("".join([get(w, unknown) for w in words]))
                if most < doc_id and end % width == width - 1]
        if not hits:
            return None
        ends, n = np.array(hits).T
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, ends - n, 1)
        np.add.at(edge, ends, -1)
        return np.cumsum(edge[:-1]) > 0


def _remove(names: list[str], window: int, gram: int):
    def remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
        passages = Passages(docs, answers, window, gram)
        texts, n_words, n_removed = [], [], []
        for d, text in zip(docs["doc_id"].to_pylist(), docs["text"].cast(pa.binary()).to_pylist()):
            words = (text or b"").split()
            n_words.append(len(words))
            lost = passages.covered(d, words) if len(words) >= window else None
            if lost is not None:
                words = [w for w, gone in zip(words, lost.tolist()) if not gone]
            texts.append(b" ".join(words))
            n_removed.append(n_words[-1] - len(words))
        added = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
        return pa.Table.from_arrays([*[docs[c] for c in names], *added], names=[*names, *[f.name for f in ADDED]])
    return remove


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with ``kept_text`` (the words left, joined by one space), n_words, n_removed. ``doc_id`` is an integer."""
    docs = docs.drop(*[f.name for f in ADDED], "_block")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(LEAST_BLOCKS, -(-int(size) // block_bytes))
    shards = max(LEAST_SHARDS, -(-int(size) // (6 * shard_words)))  # six bytes a word
    dealt = docs.withColumn("_block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition(F.col("_block"))
    by_block = dealt.groupBy("_block")
    anchors = by_block.applyInArrow(_send_anchors(shards, window, gram), _ANCHORS_SQL)
    recurring = anchors.groupBy("_shard").applyInArrow(_recurring_anchors, _ANSWER_SQL).repartition(F.col("_block"))
    windows = by_block.cogroup(recurring.groupBy("_block")).applyInArrow(_send_windows(shards, window, gram), _WINDOWS_SQL)
    earlier = windows.groupBy("_shard").applyInArrow(_earlier_windows, _ANSWER_SQL).repartition(F.col("_block"))
    answers = recurring.union(earlier)
    return by_block.cogroup(answers.groupBy("_block")).applyInArrow(
        _remove(docs.columns, window, gram), T.StructType([*docs.schema.fields, *ADDED]))

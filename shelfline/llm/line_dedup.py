"""Operator 2, line dedup by a sharded minimal perfect hash.

1. Documents are dealt into blocks by a hash of their row. Each block sends
   every shard one packed row: its distinct line hashes that fall there (128
   bits of the key) with the number of its documents that hold them. A line
   that stands everywhere is one entry per block, never a hot key.
2. Each shard adds the counts up over its distinct hashes and builds a
   minimal perfect hash (levels of bit arrays, collisions move on to the next
   level; ranks give the slots), whose slots index a fingerprint array (32
   bits) and a count array (saturated one above the threshold).
3. The same packed rows probe the arrays of their shard; the hashes found
   often enough return to the block, which drops those lines.

Text is shuffled once, lines never are. Shards and blocks are sized from the
corpus (about ``shard_lines`` lines and ``block_bytes`` bytes each), so a
task's memory stays the same at any size.

Defined results: a null or empty text is one empty line; keys shorter than
``min_chars`` code points are never dropped; every row counts as a document,
also rows that repeat; a text that loses all lines becomes empty; an empty
table gives an empty table. Clashing columns are replaced, and ``_block`` is dropped.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import by_shard

MIN_DOCS = 10
MIN_CHARS = 1
BLOCK_BYTES = 32 << 20
LEAST_BLOCKS = 256
SHARD_LINES = 2_000_000
LEAST_SHARDS = 64
#: Distinct lines that a task holds before it sends them on.
FLUSH_LINES = 2_000_000
ADDED = [T.StructField("kept_text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
_STRIP = b" \t\n\x0b\x0c\r"
_GAMMA = 2.0
_LEVELS = 24


def line_key(line: bytes) -> bytes:
    return line.strip(_STRIP).lower()  # bytes.lower() is A-Z only


def key_hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """64 bits of each 128-bit key, another function per level."""
    z = keys[:, 0] ^ (keys[:, 1] * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((level * 0xD1B54A32D192ED03 + 0x8CB92BA72F3D8DD7) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys, an array of shape (n, 2)."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest  # bits of each level; keys that no level separates
        self.ranks, total = [], 0
        for bits in levels:
            before = np.cumsum(bits, dtype=np.int64)
            self.ranks.append(before - bits + total)
            total += int(before[-1]) if len(before) else 0
        self.first_rest = total
        self.rest_at = {r.tobytes(): total + i for i, r in enumerate(rest)}

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys) and len(levels) < _LEVELS:
            size = max(64, int(_GAMMA * len(keys)))
            at = (_mix(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels, keys)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A slot for each key; a key that was not built in gets any slot or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(left):
                break
            at = (_mix(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = ranks[at[hit]]
            left = left[~hit]
        for i in left.tolist():
            out[i] = self.rest_at.get(keys[i].tobytes(), -1)
        return out

    def packed(self) -> dict:
        return {"sizes": [len(b) for b in self.levels], "bits": [np.packbits(b).tobytes() for b in self.levels], "rest": self.rest.tobytes()}

    @classmethod
    def unpacked(cls, sizes: list[int], bits: list[bytes], rest: bytes) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for n, b in zip(sizes, bits)], _keys(rest))


def _keys(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8").reshape(-1, 2)


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (keys[:, 1] >> np.uint64(32)).astype(np.uint32)


def _requests(shards: int, min_chars: int):
    def rows(counts: Counter, block: int) -> Iterator[dict]:
        if not counts:
            return
        keys, n = _keys(b"".join(counts)), np.fromiter(counts.values(), np.uint32, len(counts))
        for shard, at in by_shard(keys[:, 0], shards):
            yield {"_block": block, "_shard": shard, "keys": keys[at].tobytes(), "docs": n[at].tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = defaultdict(Counter)
        lines = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for block, counts in held.items():
                if found := list(rows(counts, block)):
                    yield pa.RecordBatch.from_pylist(found, _REQUEST)
            held.clear()

        for batch in batches:
            for block, text in zip(batch.column("_block").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                keys = {line_key(x) for x in (text or b"").split(b"\n")}
                found = {key_hash(k) for k in keys if k and (min_chars <= 1 or len(k.decode()) >= min_chars)}
                held[block].update(found)
                lines += len(found)
            if lines >= FLUSH_LINES:
                yield from flush()
                lines = 0
        yield from flush()
    return run


_REQUEST = pa.schema([("_block", pa.int64()), ("_shard", pa.int64()), ("keys", pa.binary()), ("docs", pa.binary())])
_REQUEST_SQL = "_block long, _shard long, keys binary, docs binary"
_INDEX_SQL = "_shard long, n long, sizes array<long>, bits array<binary>, rest binary, fingerprints binary, counts binary"
_INDEX = pa.schema([("_shard", pa.int64()), ("n", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.list_(pa.binary())),
                    ("rest", pa.binary()), ("fingerprints", pa.binary()), ("counts", pa.binary())])


def _build(min_docs: int):
    def build(requests: pa.Table) -> pa.Table:
        keys = np.concatenate([_keys(x) for x in requests["keys"].to_pylist()])
        docs = np.concatenate([np.frombuffer(x, np.uint32) for x in requests["docs"].to_pylist()])
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        keys, docs = keys[order], docs[order]
        first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        keys, total = keys[first], np.add.reduceat(docs.astype(np.int64), first)
        perfect = PerfectHash.build(keys)
        at = perfect.slots(keys)
        fingerprints, counts = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint8 if min_docs < 255 else np.uint32)
        fingerprints[at], counts[at] = _fingerprints(keys), np.minimum(total, min_docs)
        return pa.Table.from_pylist([{"_shard": requests["_shard"][0].as_py(), "n": len(keys), **perfect.packed(),
                                      "fingerprints": fingerprints.tobytes(), "counts": counts.tobytes()}], _INDEX)
    return build


def _probe(min_docs: int):
    def probe(requests: pa.Table, index: pa.Table) -> pa.Table:
        out = []
        for row in index.to_pylist():
            perfect = PerfectHash.unpacked(row["sizes"], row["bits"], row["rest"])
            fingerprints = np.frombuffer(row["fingerprints"], np.uint32)
            counts = np.frombuffer(row["counts"], np.uint8 if min_docs < 255 else np.uint32)
            for block, raw in zip(requests["_block"].to_pylist(), requests["keys"].to_pylist()):
                keys = _keys(raw)
                at = perfect.slots(keys)
                often = (at >= 0) & (fingerprints[at] == _fingerprints(keys)) & (counts[at] >= min_docs)
                if often.any():
                    out.append({"_block": block, "keys": keys[often].tobytes()})
        return pa.Table.from_pylist(out, pa.schema([("_block", pa.int64()), ("keys", pa.binary())]))
    return probe


def _drop_lines(names: list[str]):
    def drop(docs: pa.Table, answers: pa.Table) -> pa.Table:
        gone = set()
        for raw in answers["keys"].to_pylist():
            gone.update(raw[i:i + 16] for i in range(0, len(raw), 16))
        texts, n_lines, n_dropped = [], [], []
        for text in docs["text"].cast(pa.binary()).to_pylist():
            lines = (text or b"").split(b"\n")
            kept = [x for x in lines if not (k := line_key(x)) or key_hash(k) not in gone] if gone else lines
            texts.append(b"\n".join(kept))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
        added = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
        return pa.Table.from_arrays([*[docs[c] for c in names], *added], names=[*names, *[f.name for f in ADDED]])
    return drop


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
               block_bytes: int = BLOCK_BYTES, shard_lines: int = SHARD_LINES) -> DataFrame:
    """``docs`` with ``kept_text`` (lines whose key stands in fewer than ``min_docs`` documents), n_lines, n_dropped."""
    docs = docs.drop(*[f.name for f in ADDED], "_block")
    total = docs.agg(F.sum(F.octet_length("text")), F.sum(F.regexp_count("text", F.lit("\n")) + 1)).first()
    blocks = max(LEAST_BLOCKS, -(-int(total[0] or 0) // block_bytes))
    shards = max(LEAST_SHARDS, -(-int(total[1] or 0) // shard_lines))
    dealt = docs.withColumn("_block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition(F.col("_block"))
    requests = dealt.mapInArrow(_requests(shards, min_chars), _REQUEST_SQL).repartition(F.col("_shard"))
    index = requests.groupBy("_shard").applyInArrow(_build(min_docs), _INDEX_SQL)
    answers = requests.groupBy("_shard").cogroup(index.groupBy("_shard")).applyInArrow(_probe(min_docs), "_block long, keys binary")
    return dealt.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(
        _drop_lines(docs.columns), T.StructType([*docs.schema.fields, *ADDED]))

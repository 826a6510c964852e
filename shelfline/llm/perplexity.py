"""Operator 6, quality by the perplexity of a modified Kneser-Ney model.

The model counts n-grams of bytes (UTF-8, white space runs as one space, each
text between NUL bytes) in all training text: the trusted documents but for
one in ``HOLD_OUT``, kept back for the thresholds.

1. Documents are dealt into blocks by a hash of doc_id, trusted ids likewise;
   each block counts its distinct n-grams, and a partial aggregate adds up.
2. Orders are built from the lowest up by joins on suffix and context:
   interpolated modified Kneser-Ney, three discounts per order from its
   counts of counts, continuation counts below the highest order. The result
   is one row per n-gram: probability and, as a context, back-off weight.
3. Blocks send their distinct n-grams of all orders, packed, to the shard of
   the model that holds them; a join per shard returns their values in the
   same order (quantised to 1/1024 bit). A word that stands everywhere is one
   entry per block. Each block then adds up its documents.

A document is kept if its bits per byte are at most the quantile of held-out
trusted documents of its language and size (powers of four); languages or
sizes with under ``LEAST_HELD`` held-out documents use the language's, then
everyone's quantile. Few rows tell little about a quantile near one, so it is
the larger of two estimates from the same rows: their own quantile, and that
of a normal distribution with their mean and, for a text of n bytes, their
deviation per byte divided by the root of n (a mean over few bytes spreads
the more the fewer they are).

Defined results: a null or empty text has no perplexity and is not kept; null
languages form one language; without trusted text nothing is scored or kept,
with too little for any quantile every scored text is kept; rows that share a doc_id are trusted together and
scored each for itself; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import by_shard, staged

ORDER = 5
HOLD_OUT = 5
QUANTILE = 0.995
LEAST_HELD = 50
#: A doc_id's rows are dealt over so many blocks by their texts, so that one that many rows share is no hot key.
SPREAD = 8
#: Odd counts of counts (tiny corpora) can give discounts of zero, which leave no mass to back off; 0.5 stands for undefined ones.
LEAST_DISCOUNT = 0.05
BLOCK_BYTES = 32 << 20
LEAST_BLOCKS = 64
LEAST_SHARDS = 61
#: Bytes turned into n-grams at once.
BATCH_BYTES = 2 << 20
_UNIT = 1024  # steps per bit
_MISSING = -32768
_SHIFT = 48  # an n-gram's key is its order above its bytes


def trains(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % HOLD_OUT != 0


def grams(texts: list[bytes | None], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts in a row, and how many each text has (none if it has no word)."""
    padded = [b"\0" * (order - 1) + x + b"\0" if (x := b" ".join((t or b"").split())) else b"" for t in texts]
    b = np.frombuffer(b"".join(padded), np.uint8).astype(np.int64)
    lengths = np.array([len(p) for p in padded], np.int64)
    n = len(b) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    code = np.zeros(n, np.int64)
    for k in range(order):
        code = (code << 8) | b[k:k + n]
    ends = np.cumsum(lengths)
    inside = np.ones(n, bool)
    for end in ends[(lengths > 0) & (ends < len(b))].tolist():
        inside[end - order + 1:end] = False
    return code[inside], np.maximum(lengths - order + 1, 0)


def _batches(docs: pa.Table) -> Iterator[tuple[list, list[bytes | None]]]:
    rows, texts, n = [], [], 0
    for i, t in enumerate(docs["text"].cast(pa.binary()).to_pylist()):
        rows.append(i)
        texts.append(t)
        n += len(t or b"")
        if n >= BATCH_BYTES:
            yield rows, texts
            rows, texts, n = [], [], 0
    if rows:
        yield rows, texts


def _count(order: int):
    def count(docs: pa.Table, trusted: pa.Table) -> pa.Table:
        ids = {x for x in trusted["doc_id"].to_pylist() if x is not None and trains(x)}
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        own = docs["doc_id"].to_pylist()
        for rows, texts in _batches(docs) if ids else ():
            new, n = np.unique(grams([t for i, t in zip(rows, texts) if own[i] in ids], order)[0], return_counts=True)
            codes, place = np.unique(np.concatenate([codes, new]), return_inverse=True)
            counts = np.bincount(place, weights=np.concatenate([counts, n]), minlength=len(codes)).astype(np.int64)
        return pa.table({"g": codes, "n": counts})
    return count


def kneser_ney(counts: DataFrame, order: int) -> tuple[DataFrame, float]:
    """(g, n) of the highest order -> rows (key, p, backoff) in bits, and the bits of a byte never seen."""
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        # Continuation counts: distinct left neighbours.
        levels[k] = staged(levels[k + 1].groupBy(F.col("g").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("g")).agg(F.count("*").alias("n")), f"grams{k}")
    out, lower, unseen = [], None, 0.0
    for k in range(1, order + 1):
        many = levels[k].filter("n <= 4").groupBy("n").count().collect()  # four rows
        n1, n2, n3, n4 = ({r["n"]: r["count"] for r in many}.get(i, 0) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.0
        d = [min(max(i - (i + 1) * y * b / a, LEAST_DISCOUNT), float(i)) if a else 0.5 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        discount = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        at = levels[k].withColumn("context", F.shiftright("g", 8))
        contexts = at.groupBy("context").agg(F.sum("n").alias("total"), F.sum(discount).alias("freed"))
        rows = at.join(contexts, "context").withColumn("gamma", F.col("freed") / F.col("total"))
        own = (F.col("n") - discount) / F.col("total")
        if k == 1:
            rows = rows.withColumn("prob", own + F.col("gamma") / 257)
            first = contexts.first()
            unseen = float(np.log2(max(first["freed"] / first["total"] / 257, 1e-9))) if first else 0.0
        else:
            below = lower.select(F.col("g").alias("suffix"), F.col("prob").alias("below"))
            rows = rows.withColumn("suffix", F.col("g").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))).join(below, "suffix").withColumn("prob", own + F.col("gamma") * F.col("below"))
            out.append(contexts.select((F.col("context") + F.lit((k - 1) << _SHIFT)).alias("key"), F.lit(None).cast("double").alias("p"),
                                       F.log2(F.greatest(F.col("freed") / F.col("total"), F.lit(1e-9))).alias("backoff")))
        lower = staged(rows.select("g", "prob"), f"probs{k}")
        out.append(lower.select((F.col("g") + F.lit(k << _SHIFT)).alias("key"), F.log2("prob").alias("p"), F.lit(None).cast("double").alias("backoff")))
    rows = out[0]
    for df in out[1:]:
        rows = rows.union(df)
    return staged(rows.groupBy("key").agg(F.max("p").alias("p"), F.max("backoff").alias("backoff")), "model"), unseen


def _all_keys(codes: np.ndarray, order: int) -> np.ndarray:
    """Keys of the distinct n-grams, their suffixes and the contexts those may back off from."""
    keys = [codes + (order << _SHIFT)]
    for k in range(order - 1, 0, -1):
        mask = (1 << 8 * k) - 1
        codes = np.unique(np.concatenate([codes & mask, codes >> 8]))
        keys.append(codes + (k << _SHIFT))
    return np.sort(np.concatenate(keys))


def _block_codes(docs: pa.Table, order: int) -> np.ndarray:
    codes = np.zeros(0, np.int64)
    for _, texts in _batches(docs):
        codes = np.union1d(codes, grams(texts, order)[0])
    return codes


def _pack(keys: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(np.diff(keys, prepend=0)).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(8, -1).T).view(np.int64).ravel())


_ASK_SQL = "_block long, _shard long, keys binary"
_ASK = pa.schema([("_block", pa.int64()), ("_shard", pa.int64()), ("keys", pa.binary())])
_TOLD_SQL = "_block long, shard long, told binary"
_TOLD = pa.schema([("_block", pa.int64()), ("shard", pa.int64()), ("told", pa.binary())])


def _ask(order: int, shards: int):
    def ask(docs: pa.Table) -> pa.Table:
        keys = _all_keys(_block_codes(docs, order), order)
        block = docs["_block"][0].as_py()
        return pa.Table.from_pylist([{"_block": block, "_shard": s, "keys": _pack(keys[at])} for s, at in by_shard(keys.view(np.uint64), shards)], _ASK)
    return ask


def _tell(asked: pa.Table, model: pa.Table) -> pa.Table:
    keys = model["key"].to_numpy()
    order = np.argsort(keys)
    keys = keys[order]
    values = np.full((2, len(keys) + 1), _MISSING, np.int16)  # the last place answers for keys the model lacks
    for row, name in enumerate(("p", "backoff")):
        v = model[name].to_numpy()[order]
        values[row, :-1] = np.where(np.isnan(v), _MISSING, np.clip(np.rint(np.nan_to_num(v) * _UNIT), -32767, 32767))
    out = []
    for block, shard, raw in zip(asked["_block"].to_pylist(), asked["_shard"].to_pylist(), asked["keys"].to_pylist()):
        want = _unpack(raw)
        at = np.searchsorted(keys, want)
        hit = np.zeros(len(want), bool)
        if len(keys):
            hit = keys[np.minimum(at, len(keys) - 1)] == want
        out.append({"_block": block, "shard": shard, "told": zstandard.compress(values[:, np.where(hit, at, len(keys))].tobytes(), 1)})
    return pa.Table.from_pylist(out, _TOLD)


def gram_bits(codes: np.ndarray, keys: np.ndarray, p: np.ndarray, backoff: np.ndarray, order: int, unseen: float) -> np.ndarray:
    """log2 probability of each distinct n-gram by back-off; ``p`` and ``backoff`` hold NaN where the model has none."""
    bits, found = np.zeros(len(codes)), np.zeros(len(codes), bool)
    for k in range(order, 0, -1):
        at = np.searchsorted(keys, (codes & ((1 << 8 * k) - 1)) + (k << _SHIFT))
        now = ~found & ~np.isnan(p[at])
        bits[now] += p[at[now]]
        found |= now
        if k > 1:
            at = np.searchsorted(keys, ((codes & ((1 << 8 * k) - 1)) >> 8) + ((k - 1) << _SHIFT))
            bits[~found] += np.nan_to_num(backoff[at[~found]])
    bits[~found] += unseen
    return bits


def _score(order: int, shards: int, unseen: float):
    def score(docs: pa.Table, told: pa.Table) -> pa.Table:
        codes = _block_codes(docs, order)
        keys = _all_keys(codes, order)
        answers = dict(zip(told["shard"].to_pylist(), told["told"].to_pylist()))
        values = np.full((2, len(keys)), np.nan)
        for s, at in by_shard(keys.view(np.uint64), shards):
            if s in answers:
                v = np.frombuffer(zstandard.decompress(answers[s]), np.int16).reshape(2, -1)
                values[:, at] = np.where(v == _MISSING, np.nan, v / _UNIT)
        bits = gram_bits(codes, keys, values[0], values[1], order, unseen).astype(np.float32)
        total, n_bytes = np.zeros(docs.num_rows), np.zeros(docs.num_rows, np.int64)
        for rows, texts in _batches(docs):
            every, n = grams(texts, order)
            if len(every):
                sums = np.r_[0, np.cumsum(bits[np.searchsorted(codes, every)], dtype=np.float64)]
                ends = np.cumsum(n)
                total[rows] = sums[ends] - sums[ends - n]
            n_bytes[rows] = n
        per = np.where(n_bytes > 0, -total / np.maximum(n_bytes, 1), np.nan)
        return pa.table({"doc_id": docs["doc_id"].cast(pa.int64()), "lang": docs["lang"].cast(pa.string()), "n_bytes": n_bytes,
                         "bits": pa.array(per, mask=n_bytes == 0)})
    return score


def _prime(n: int) -> int:
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def perplexity(docs: DataFrame, trusted: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, lang, n_bytes, bits): bits per byte of each row of ``docs`` under a model of the ``trusted`` ids."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(LEAST_BLOCKS, -(-int(size) // block_bytes))
    # A row without a doc_id goes by its text alone; trusted ids go wherever their rows may.
    text_hash = F.xxhash64("text")
    own = F.coalesce(F.col("doc_id").cast("long"), text_hash)
    block = F.pmod(F.xxhash64(own, F.pmod(text_hash, F.lit(SPREAD))), F.lit(blocks))
    by_block = docs.select("doc_id", "lang", "text", block.alias("_block")).repartition(F.col("_block")).groupBy("_block")
    places = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long")))
    marked = trusted.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), places.alias("_n"))
    marked = marked.select("doc_id", F.pmod(F.xxhash64("doc_id", "_n"), F.lit(blocks)).alias("_block")).distinct().groupBy("_block")
    counts = staged(by_block.cogroup(marked).applyInArrow(_count(order), "g long, n long").groupBy("g").agg(F.sum("n").alias("n")), "counts")
    model, unseen = kneser_ney(counts, order)
    n = model.count()
    if not n:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                           F.lit(0).cast("long").alias("n_bytes"), F.lit(None).cast("double").alias("bits"))
    shards = _prime(max(LEAST_SHARDS, n // 500_000, blocks // 16))
    asked = by_block.applyInArrow(_ask(order, shards), _ASK_SQL).groupBy("_shard")
    held = model.withColumn("_shard", F.pmod("key", F.lit(shards))).groupBy("_shard")
    told = asked.cogroup(held).applyInArrow(_tell, _TOLD_SQL).groupBy("_block")
    return by_block.cogroup(told).applyInArrow(_score(order, shards, unseen), "doc_id long, lang string, n_bytes long, bits double")


def quality_classifier(docs: DataFrame, trusted: DataFrame, order: int = ORDER, quantile: float = QUANTILE) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, perplexity (per byte), threshold, kept."""
    scored = staged(perplexity(docs, trusted, order), "scores").withColumn("class", F.floor(F.log2(F.greatest("n_bytes", F.lit(1))) / 2))
    held = scored.join(trusted.select("doc_id").distinct(), "doc_id", "left_semi").filter(F.crc32(F.col("doc_id").cast("string")) % HOLD_OUT == 0).filter("bits is not null")

    z = NormalDist().inv_cdf(quantile)

    def most(groups: list[str], name: str) -> DataFrame:
        n, mean = F.col("n_bytes"), F.avg("bits")
        # Mean of n (bits - mean)^2, the variance of one byte.
        per_byte = F.avg(n * F.col("bits") * F.col("bits")) - 2 * mean * F.avg(n * F.col("bits")) + mean * mean * F.avg(n)
        told = F.struct(F.percentile_approx("bits", quantile, 10000).alias("quantile"), mean.alias("mean"), F.sqrt(F.greatest(per_byte, F.lit(0.0))).alias("deviation"))
        return held.groupBy(*[F.col(g).alias(f"{name}_{g}") for g in groups]).agg(F.when(F.count("*") >= LEAST_HELD, told).alias(name))

    out = scored
    for name, groups in (("own", ["lang", "class"]), ("language", ["lang"])):
        on = F.col("lang").eqNullSafe(F.col(f"{name}_lang"))
        if "class" in groups:
            on = on & (F.col("class") == F.col(f"{name}_class"))
        out = out.join(staged(most(groups, name), name), on, "left")
    out = out.join(staged(most([], "everyone"), "everyone"), F.lit(True), "left")  # one row
    out = out.withColumn("q", F.coalesce("own", "language", "everyone"))
    out = out.withColumn("threshold", F.greatest(F.col("q.quantile"), F.col("q.mean") + z * F.col("q.deviation") / F.sqrt(F.greatest("n_bytes", F.lit(1)))))
    kept = F.col("bits").isNotNull() & (F.col("bits") <= F.coalesce("threshold", F.col("bits")))
    return out.select("doc_id", "lang", F.pow(F.lit(2.0), "bits").alias("perplexity"), F.pow(F.lit(2.0), "threshold").alias("threshold"), kept.alias("kept"))

r"""Operator 12, source divergence audit by Gustavson row accumulation.

Within each language, every source is held against every other source and
against the whole language by the triangular divergence of their smoothed
term shares, in exact integers:

- a term is a run of ASCII letters (A-Z lower-cased) and non-ASCII characters;
  a language keeps the V terms that stand in at least ``min_docs`` of its
  documents;
- a source with N occurrences of kept terms gives a kept term that it holds c
  times the share ``p = 1 + floor(10^9 (c + 2) / (N + 2 V))``, so the V terms
  it does not hold have the same small share, its *baseline*;
- two shares differ by ``f(p, q) = floor((p - q)^2 / (p + q))``.

The sum of f over all kept terms is taken like a row of a sparse matrix
product (Gustavson): postings (term, source, share) are dealt into shards by
term; a shard lays its postings out by term, and each source of the shard
walks its own terms, looks up the postings of each term in that index, and
adds what they hold to a dense accumulator with one place per peer. No pair of
postings becomes a row; a shard passes on one number per pair of sources.

The sparse sum covers terms that both hold. All others are corrections by
baselines, with z the baseline of a source:

    sum of f = V f(z_s, z_t) + own(s, t) + own(t, s) + shared(s, t)
    own(s, t)    = sum over the terms of s of  f(p_s, z_t) - f(z_s, z_t)
    shared(s, t) = sum over common terms of  f(p_s, p_t) - f(p_s, z_t) - f(z_s, p_t) + f(z_s, z_t)

``own`` needs one evaluation per distinct share of s and peer. ``shared`` is
symmetric, so a source only meets the peers that stand behind it in a term's
postings.

Scale: texts are counted where they are read (a task passes on one row per
source and term, in bounded portions), so a source or language that holds a
third of all rows moves no more rows than its vocabulary; a term's postings
are at most one per source. Shards hold about ``shard_postings`` postings,
more where a language has many sources, so that what they pass on stays below
what they read. What comes out is quadratic in the sources of a language, as
asked for.

Defined results: null text, lang and source are ''; every row is a document,
also rows that repeat; a source without a kept term is audited by its
baseline alone; a language that keeps no term gives pairs of value 0 and no
terms; a language of one source has no pairs; an empty table gives an empty
table. Only lang, source and text are read, so clashing columns do no harm.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import staged

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Postings of a shard, at the least and at the most; between them four per pair of sources.
SHARD_POSTINGS = (4096, 4_000_000)
#: Terms that a task counts before it sends them on.
FLUSH_TERMS = 300_000
#: Values that are worked out at once.
LANES = 1 << 20
#: Bytes of a text: letters stay, lower-cased, as do all bytes of non-ASCII characters; all else parts terms.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTED = pa.schema([("lang", pa.binary()), ("source", pa.binary()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents) of a partition, in portions; a row without a term stands for the group."""
    found: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
    held = 0

    def portion() -> Iterator[pa.RecordBatch]:
        while found:
            (lang, source), (uses, docs) = found.popitem()
            n = len(uses) + 1
            columns = [[lang] * n, [source] * n, [*uses, None], [*uses.values(), 0], [*map(docs.__getitem__, uses), 0]]
            del uses, docs
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _COUNTED.types)], schema=_COUNTED)

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text")):
            if (lang, source) not in found:
                found[lang, source] = Counter(), Counter()
            uses, docs = found[lang, source]
            terms = text.as_py().translate(_TABLE).split()
            held -= len(uses)
            uses.update(terms)
            docs.update(set(terms))
            held += len(uses)
            if held > FLUSH_TERMS:
                yield from portion()
                held = 0
    yield from portion()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents per group, and a row with a null term for every group."""
    read = docs.select(*[F.coalesce(F.col(c).cast("binary"), F.lit(b"")).alias(c) for c in ("lang", "source", "text")])
    counted = read.mapInArrow(_counted, "lang binary, source binary, term binary, n long, docs long")
    counted = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return counted.withColumns({c: F.col(c).cast("string") for c in ("lang", "source", "term")})


def _share(n: str, total: str):
    return F.expr(f"1 + (cast({n} + 2 as decimal(20, 0)) * {SCALE}) div {total}")


def _differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)  # shares are at most 10^9 + 1: exact in 64 bits


def _accumulated(source: np.ndarray, term: np.ndarray, share: np.ndarray, base: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(s, own(s, t) for all t plus shared(s, t) for all t > s) of every source with a posting."""
    by_term = np.lexsort((source, term))
    source, term, share = source[by_term], term[by_term], share[by_term]  # the term-major index
    end = np.searchsorted(term, term, side="right")
    by_source = np.argsort(source, kind="stable")
    bounds = np.flatnonzero(np.diff(source[by_source], prepend=-1, append=-1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        mine = by_source[a:b]  # places of this row's terms in the index
        s = int(source[mine[0]])
        total = np.zeros(len(base), np.int64)
        zero = _differ(base[s], base)
        values, times = np.unique(share[mine], return_counts=True)
        step = max(1, LANES // len(base))
        for i in range(0, len(values), step):
            total += times[i:i + step] @ (_differ(values[i:i + step, None], base) - zero)
        behind = end[mine] - mine - 1
        reach = np.cumsum(behind)
        at = 0
        while at < len(mine):  # some terms at a time
            to = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + LANES, side="right")))
            n = behind[at:to]
            steps = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            other = np.repeat(mine[at:to] + 1, n) + steps
            p, q, t = np.repeat(share[mine[at:to]], n), share[other], source[other]
            np.add.at(total, t, _differ(p, q) - _differ(p, base[t]) - _differ(base[s], q) + zero[t])
            at = to
        total[s] = 0
        yield s, total


def _scattered(rows: pa.Table, peers: pa.Table) -> pa.Table:
    """Partial sums (lang, source, item, value) of one shard of a language."""
    lang, names = peers["lang"][0], pc.sort_indices(peers["source"])
    peers = peers.take(names)
    names, base = peers["source"].combine_chunks(), peers["base"].fill_null(0).to_numpy()
    # Each source states V f(z_s, z_t) in one shard, so every pair has a row.
    kept, shard, shards = peers["kept"][0].as_py(), peers["shard"][0].as_py(), peers["shards"][0].as_py()
    sums: dict[int, np.ndarray] = {s: np.zeros(len(base), np.int64) for s in range(shard, len(base), shards)}
    if kept:
        for s, total in sums.items():
            total[s + 1:] = kept * _differ(base[s], base[s + 1:])
    if len(rows):
        found = pc.index_in(rows["source"], names).to_numpy()
        terms = rows["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        for s, total in _accumulated(found, terms, rows["share"].to_numpy(), base):
            sums[s] = sums[s] + total if s in sums else total
    whole = set(range(shard, len(base), shards))
    out = []
    for s, total in sums.items():
        t = np.flatnonzero((total != 0) | (np.arange(len(base)) > s if s in whole else False))
        out.append(pa.table({"lang": pa.repeat(lang, len(t)), "source": pa.repeat(names[s], len(t)), "item": names.take(pa.array(t)), "value": total[t]}))
    none = pa.table({"lang": pa.array([], pa.string()), "source": pa.array([], pa.string()), "item": pa.array([], pa.string()), "value": pa.array([], pa.int64())})
    return pa.concat_tables([none, *[x.cast(none.schema) for x in out]])


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, shard_postings: tuple[int, int] = SHARD_POSTINGS) -> DataFrame:
    """(lang, source, part, item, value, rank): the divergence of each pair of sources, and each source's most overstated terms."""
    in_lang = Window.partitionBy("lang", "term")
    counts = term_counts(docs).select("*", F.sum("docs").over(in_lang).alias("lang_docs"), F.sum("n").over(in_lang).alias("lang_n"),
                                      (F.min("source").over(in_lang) == F.col("source")).alias("first"))
    counts = staged(counts.filter(F.col("term").isNull() | (F.col("lang_docs") >= min_docs)).drop("docs", "lang_docs"), "terms")
    is_term = F.col("term").isNotNull()
    groups = counts.groupBy("lang", "source").agg(
        F.sum("n").alias("n"), F.count("term").alias("postings"), F.count_if(is_term & F.col("first")).alias("firsts"))
    groups = staged(groups, "groups")
    langs = groups.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("firsts").alias("kept"), F.sum("postings").alias("postings"), F.count("*").alias("sources"))
    least, most = shard_postings
    size = F.greatest(F.lit(least), F.least(F.lit(most), 4 * F.col("sources") * F.col("sources")))
    langs = langs.select("lang", "kept", F.greatest(F.lit(1), F.ceil(F.col("postings") / size)).cast("long").alias("shards"),
                         (F.col("lang_n") + 2 * F.col("kept")).alias("lang_total"))
    groups = groups.select("lang", "source", "n").join(langs, "lang").withColumn("total", F.col("n") + 2 * F.col("kept"))
    groups = staged(groups.withColumn("base", F.when(F.col("kept") > 0, _share("0", "total"))).drop("n"), "shares")

    postings = counts.filter(is_term).drop("first").join(groups, ["lang", "source"]).select(
        "lang", "source", "term", _share("n", "total").alias("share"), _share("lang_n", "lang_total").alias("lang_share"), "shards")

    over = postings.filter("share > lang_share").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        F.expr("((share - lang_share) * (share - lang_share)) div (share + lang_share)").alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = over.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top_terms)

    dealt = postings.select("lang", F.pmod(F.xxhash64("term"), "shards").alias("shard"), "source", "term", "share")
    peers = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), "source", "base", "kept", "shards")
    sums = dealt.groupBy("lang", "shard").cogroup(peers.groupBy("lang", "shard")).applyInArrow(_scattered, "lang string, source string, item string, value long")
    pairs = sums.groupBy("lang", F.least("source", "item").alias("a"), F.greatest("source", "item").alias("b")).agg(F.sum("value").alias("value"))
    both = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("p"), "value")
    pairs = both.select("lang", "p.source", F.lit("pair").alias("part"), "p.item", "value").withColumn("rank", F.row_number().over(ranked))
    return pairs.unionByName(over)

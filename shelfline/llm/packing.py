"""Operator 9, best-fit packing into sequences of several permitted lengths.

Documents longer than the largest length are cut into pieces of that length.
Pieces are dealt by a hash into groups of about ``group_pieces``; each group
is packed by one task, best fit in decreasing order: a piece goes to the open
bin it fills best. If none has room, all permitted lengths that hold it are
tried on the pieces that are still unpacked: each is filled with the piece and
then, again and again, the longest one that still fits. A bin costs ``length +
bin_cost``; the length is opened that costs least together with what the words
then left must cost: one bin if they fit into it, else the best rate any
permitted length has when full; of equal ones the longest. In the end every bin shrinks to the smallest
permitted length that holds its contents.

Only (doc_id, piece, start, length) travel, never texts; groups are dealt by
hash, so no source or group of copies meets in one task, and a group's bins
lose a small share of one bin per group at most.

Defined results: a null or empty text has no words and gives no piece; an
empty table gives no row; rows that share a doc_id are packed each for
itself; a null doc_id is packed like any other. Ties go by doc_id, then piece,
then the row's place in the input. Clashing columns are not read.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import WORD, staged

LENGTHS = (512, 1024, 2048, 4096)
BIN_COST = 16
GROUP_PIECES = 2048
SCHEMA = "doc_id long, piece long, start long, length long, bin_id string, bin_offset long, bin_length long, bin_filled long"


def _filling(ends: list[tuple[int, int]], at: int, space: int) -> int:
    """Words that the longest pieces that fit, one after the other, put into a space.

    ``ends``: (negative length, end) of each run of equal lengths, longest first; pieces from ``at`` on are left.
    """
    free = space
    while free > 0:
        r = bisect.bisect_left(ends, (-free, 0))
        while r < len(ends) and ends[r][1] <= at:  # packed already
            r += 1
        if r == len(ends):
            break
        length, end = -ends[r][0], ends[r][1]
        start = max(at, ends[r - 1][1] if r else 0)
        n = min(end - start, free // length)
        free -= n * length
        at = start + n
    return space - free


def best_fit(lengths: np.ndarray, permitted: tuple[int, ...], bin_cost: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset in the bin and final bin length of each piece; ``lengths`` descending."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    room: list[int] = []                # distinct free spaces, ascending
    open_at: dict[int, list[int]] = {}  # free space -> bins
    filled: list[int] = []
    rest = int(lengths.sum())
    rate = min((c + bin_cost) / c for c in permitted)

    def later(words: int) -> float:
        """What words that are left must cost at least."""
        return words * rate if words > permitted[-1] else bin_cost + permitted[bisect.bisect_left(permitted, words)] if words else 0

    runs = np.flatnonzero(np.diff(lengths, append=-1)) + 1
    ends = [(-int(lengths[e - 1]), e) for e in runs.tolist()]
    for i, x in enumerate(lengths.tolist()):
        k = bisect.bisect_left(room, x)
        if k < len(room):
            space = room[k]
            b = open_at[space].pop()
            if not open_at[space]:
                del open_at[space]
                room.pop(k)
        else:
            space = min((c for c in permitted if c >= x), key=lambda c: (c + bin_cost + later(rest - x - _filling(ends, i + 1, c - x)), -c))
            b = len(filled)
            filled.append(0)
        bins[i], offsets[i] = b, filled[b]
        filled[b] += x
        rest -= x
        if left := space - x:
            if left not in open_at:
                bisect.insort(room, left)
                open_at[left] = []
            open_at[left].append(b)
    final = np.array([permitted[bisect.bisect_left(permitted, f)] for f in filled], np.int64)
    return bins, offsets, final


def pack_best_fit(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, bin_cost: int = BIN_COST, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start (word), length, bin_id, bin_offset, bin_length, bin_filled."""
    permitted = tuple(sorted(set(lengths)))
    top = permitted[-1]
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    # Written once: the number of the row is what tells equal rows apart when they are dealt.
    sized = staged(docs.select("doc_id", words.alias("words"), F.monotonically_increasing_id().alias("row")).filter("words > 0"), "sizes")
    pieces = sized.select("doc_id", "row", "words", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("words") - 1) / top))).alias("piece"))
    pieces = pieces.select("doc_id", "row", "piece", (F.col("piece") * top).alias("start"), F.least(F.lit(top), F.col("words") - F.col("piece") * top).cast("long").alias("length"))
    n = sized.agg(F.sum(F.floor((F.col("words") - 1) / top) + 1)).first()[0] or 0
    groups = max(1, -(-int(n) // group_pieces))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(groups)))

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("row", "ascending")])
        bins, offsets, final = best_fit(t["length"].to_numpy(), permitted, bin_cost)
        group = t["group"][0].as_py()
        filled = np.bincount(bins, weights=t["length"].to_numpy()).astype(np.int64)
        return pa.table({
            "doc_id": t["doc_id"], "piece": t["piece"], "start": t["start"], "length": t["length"],
            "bin_id": pa.array([f"{group}-{b}" for b in bins.tolist()]), "bin_offset": offsets,
            "bin_length": final[bins], "bin_filled": filled[bins]})

    return dealt.groupBy("group").applyInArrow(pack, SCHEMA)

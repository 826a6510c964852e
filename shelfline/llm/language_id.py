"""Operator 4, language identification by cross-parsing entropy.

Training: per language a bounded sample of labelled text (``sample_docs``
documents in order of a hash of their row, ``sample_chars`` letters and spaces
in all) becomes a suffix automaton, the minimal automaton of all substrings of
the sample. Its transitions are laid out as one dense table for all languages.

Prediction: a text is cut greedily into the longest phrases that occur in a
language's sample; a phrase ends where the automaton has no transition. The
cross-parsing entropy of a language is its number of phrases per letter times
the log of its sample size; the language with the least wins. Whole texts are
parsed, in segments of ``SEGMENT`` letters (a phrase ends with its segment),
all segments of a batch and all languages in step with one another.

Only the samples travel (``sample_chars`` per language, a few KB); every
worker builds the automata for itself. Prediction is a map over rows, so no
source or group of copies matters and nothing is gathered.

Defined results: ``und`` with score 0 if the text is null or has no letter;
so too if nothing could be learned. Ties go to the least language by code
point. Rows are independent; an empty table gives an empty table. Labels,
sources and ids never enter a prediction. Clashing columns are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_DOCS = 200
SAMPLE_CHARS = 24_000
SEGMENT = 512
#: Parallel segments that a worker holds at once.
LANES = 8192
ADDED = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
_LETTER = re.compile(r"[^\W\d_]")
#: Bytes of a lower-cased text: a-z and non-ASCII stay, all else parts words.
_TABLE = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def letters(text: str) -> bytes:
    """Lower-cased words of letters between single spaces, as UTF-8."""
    return b" ".join(text.lower().encode().translate(_TABLE).split())


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton (Blumer et al.); state 0 is the root."""
    go: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        new = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return go


class Parser:
    """Phrase counts of many texts in all languages."""

    def __init__(self, samples: tuple[tuple[str, bytes], ...]):
        self.langs = [lang for lang, _ in samples]
        known = sorted({b for _, s in samples for b in s})
        # Symbol 0 pads a segment and changes nothing, 1 is any byte that no sample holds.
        width = 2
        while width < len(known) + 2:
            width *= 2
        self.symbol = np.ones(256, np.int32)
        self.symbol[known] = np.arange(2, len(known) + 2)
        self.symbol *= 2  # bit 0 of an entry says that a phrase ended
        tables, self.roots, base = [], [], 0
        for _, sample in samples:
            go = suffix_automaton(sample)
            step = np.full((len(go), width), -1, np.int64)
            for state, out in enumerate(go):
                for c, to in out.items():
                    step[state, self.symbol[c] // 2] = to
            root = np.where(step[0] >= 0, step[0], 0)
            ended = step < 0
            step = np.where(ended, root, step)
            entry = (base + step) * width * 2 + ended
            entry[:, 0] = (base + np.arange(len(go))) * width * 2
            tables.append(entry.ravel())
            self.roots.append(base * width * 2)
            base += len(go)
        self.kind = np.int32 if base * width * 2 < 2**31 else np.int64
        self.table = np.concatenate(tables).astype(self.kind) if tables else np.zeros(0, self.kind)
        self.log_size = np.log2([max(2, len(s)) for _, s in samples])

    def phrases(self, segments: np.ndarray) -> np.ndarray:
        """segments: (SEGMENT, lanes) of symbols -> (languages, lanes) of phrase counts."""
        steps, lanes = segments.shape
        out = np.zeros((len(self.langs), lanes), np.int64)
        place, flag = np.empty(lanes, self.kind), np.empty(lanes, self.kind)
        for k, root in enumerate(self.roots):
            state, count = np.full(lanes, root, self.kind), np.zeros(lanes, self.kind)
            for i in range(steps):
                np.add(state, segments[i], out=place)
                np.right_shift(place, 1, out=place)
                np.take(self.table, place, out=state)
                np.bitwise_and(state, 1, out=flag)
                np.add(count, flag, out=count)
                np.subtract(state, flag, out=state)
            out[k] = count + 1  # the phrase that the segment's end cuts
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        spoken = [i for i, t in enumerate(texts) if t and self.langs and _LETTER.search(t)]
        best, score = ["und"] * len(texts), [0.0] * len(texts)
        at = 0
        while at < len(spoken):
            chosen, raw, lanes = [], [], 0
            while at < len(spoken) and (not chosen or lanes < LANES):
                b = letters(texts[spoken[at]])
                chosen.append(spoken[at])
                raw.append(b)
                lanes += -(-max(1, len(b)) // SEGMENT)
                at += 1
            pieces = [-(-max(1, len(b)) // SEGMENT) for b in raw]
            counts = np.zeros((len(self.langs), sum(pieces)), np.int64)
            flat = np.zeros(sum(pieces) * SEGMENT, np.int32)
            pos = 0
            for b, n in zip(raw, pieces):
                flat[pos:pos + len(b)] = self.symbol[np.frombuffer(b, np.uint8)]
                pos += n * SEGMENT
            segments = flat.reshape(-1, SEGMENT)
            for x in range(0, len(segments), LANES):  # a long text alone may fill many rounds
                counts[:, x:x + LANES] = self.phrases(np.ascontiguousarray(segments[x:x + LANES].T))
            total = np.add.reduceat(counts, np.r_[0, np.cumsum(pieces)[:-1]], axis=1)
            entropy = total * self.log_size[:, None] / np.array([max(1, len(b)) for b in raw])
            first = np.argmin(entropy, axis=0)
            others = np.sort(entropy, axis=0)[min(1, len(self.langs) - 1)]
            low = entropy[first, np.arange(len(raw))]
            sure = np.clip(1 - low / np.maximum(others, 1e-9), 0, 1) if len(self.langs) > 1 else np.ones(len(raw))
            for j, i in enumerate(chosen):
                best[i], score[i] = self.langs[first[j]], float(sure[j])
        return best, score


@cache
def _parser(samples: tuple[tuple[str, bytes], ...]) -> Parser:
    return Parser(samples)


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> tuple[tuple[str, bytes], ...]:
    """(language, sample) in code-point order, from rows (doc_id, text, lang).

    A bounded sample: of each language the ``sample_docs`` distinct rows
    (doc_id, text) that hash least. Rows above a level that lets about four
    times as many pass are left out first, then a group limit leaves no task
    more than ``sample_docs`` of a language. Of each row a piece of ``8 *
    sample_chars / sample_docs`` characters from the middle, cut to
    ``sample_chars`` bytes in all.
    """
    piece = 8 * sample_chars // sample_docs
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text").alias("h"), "text")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}  # a row per language
    if not counts:
        return ()
    level = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, 4 * sample_docs / max(1, n))))])[F.col("lang")]
    middle = F.greatest(F.lit(1), F.floor(F.length("text") / 2).cast("int") - piece // 2)
    least = Window.partitionBy("lang").orderBy("h")
    # A language of few rows passes whole: the level only serves to sort less.
    few = (rows.filter((F.col("h") / 2.0**64 + 0.5 < level) | (level >= 1.0)).groupBy("lang", "h").agg(F.min(F.substring(F.col("text"), middle, F.lit(piece))).alias("text"))
           .withColumn("n", F.row_number().over(least)).filter(F.col("n") <= sample_docs).collect())  # sample_docs short pieces per language
    texts: dict[str, list[str]] = {lang: [] for lang in sorted(counts, key=lambda x: x.encode())}
    for r in sorted(few, key=lambda r: r["n"]):
        texts[r["lang"]].append(r["text"])
    return tuple((lang, b" ".join(letters(t) for t in found)[:sample_chars]) for lang, found in texts.items() if found)


def language_id(docs: DataFrame, samples: tuple[tuple[str, bytes], ...]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (how far the runner-up's entropy lies above the winner's)."""
    docs = docs.drop(*[f.name for f in ADDED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = _parser(samples).predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(score, pa.float64())],
                                             names=[*batch.schema.names, *[f.name for f in ADDED]])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *ADDED]))

"""Small tables with the awkward rows every operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["size", "taken", "kept", "n_words", "score", "labels", "kept_text", "_block", "row", "fp", "rep", "component_id", "fingerprint", "_n", "key", "group", "bin_id", "copies"]


def prose(rng: random.Random, words: int, vocabulary: int = 3000, lines: int = 12) -> str:
    out = []
    for i in range(words):
        out.append(f"w{rng.randrange(vocabulary)}" + ("." if i % 9 == 8 else "") + ("\n" if i % lines == lines - 1 else " "))
    return "".join(out).strip()


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    """Copies, near copies, shared lines and passages, nulls in any column, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    out: list[tuple] = []
    passage = prose(rng, 40)
    for i in range(n):
        text = prose(rng, rng.choice([3, 20, 60, 120, 200]))
        if i % 4 == 0:
            text += "\nShared line here.\n  SHARED line HERE.\t"
        if i % 6 == 0:
            text = prose(rng, 10) + " " + passage + " " + prose(rng, 10)
        if i % 10 == 9 and i > 10:
            text = out[i - 5][1]
        out.append((i, text, ["en", "de", None][i % 3], ["a", "b", "c", "d", None][min(i % 7, 4)], len(text)))
    base = prose(rng, 150)
    for i in range(12):  # near copies
        words = base.split(" ")
        words[rng.randrange(len(words))] = f"x{i}"
        out.append((n + i, " ".join(words), "en", "a", None))
    out += [
        (n + 20, None, "en", "a", None), (n + 21, "", None, None, 0), (n + 22, " \t\n \x0b", "en", "b", 5),
        (n + 23, prose(rng, 30_000), "en", "a", None), (n + 24, "a", "de", "z", 1),
        (None, prose(rng, 80), "en", "a", None), (None, prose(rng, 80), None, None, None),
        (n + 25, "Ünïcode ÀB wörter mit Leerzeichen \U0001F600 ñ\n" * 3, "de", "c", None),
    ]
    out += [(n + 26, "same row " * 30, "en", "a", 270)] * 3  # repeated rows
    return out


def table(spark, data: list[tuple]):
    return spark.createDataFrame(data, SCHEMA)


def clashing(df):
    """The table with extra columns named like those the operators add or use."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit("mine") for c in CLASH})

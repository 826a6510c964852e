r"""Operator 5, quality rules (DataFrame functions only).

Line-first cleaning: each line is held against a punctuation, a navigation
and a boilerplate rule, all by share, so that a long line is not lost for one
phrase or one run of marks:

- punctuation: at least half of the words are marked (symbols only, or ending
  in two of ``!?#*$%&``), and there are four of them, or the line is nothing
  but four symbols or more; a quarter is enough where four stand in a row;
- navigation: at least two separators and fewer numbers than separators, and at
  most ``MAX_ENTRY`` words an entry; or a row of entries of one word, and
  separators and as many entries make up a quarter of the words. A line that
  begins and ends with a bar is a row of a Markdown table and no navigation;
  nor is the line of dashes and bars below its head punctuation;
- boilerplate: the phrases make up a quarter of the words, or the line holds
  one and has at most ``SHORT_LINE`` words.

The quarter is ``MIN_SHARE``.

Failing lines are removed, and a document that loses more than ``max_lost`` of
its words that way is rejected. A document is rejected as well if it has fewer than ``min_words`` words, or if over half of
its words stand in three-word windows that it holds twice or more.

Everything about a document is worked out inside its row: windows are sorted
as (hash, place) pairs, so a document of n words costs n log n and no shuffle.

Defined results: a null text is an empty text; it has no words, fails the
base rules and keeps an empty ``clean_text``. Lines without a word never fail
and never count as repeated. Rows are independent, so repeated rows and an
empty table need no rule. Clashing columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import WORD

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_LOST = 0.5
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words", "base_failed", "kept", "clean_text")

#: Words of a line that fails if it holds a boilerplate phrase at all; share of the words that make a longer one fail.
SHORT_LINE = 15
MIN_SHARE = 0.25
#: Words of an entry between separators, on average.
MAX_ENTRY = 2.5

#: Single patterns, plain enough to read alike in Java and RE2: the SQL holds whole lines against them.
PUNCTUATION = r"[!?#*$%&]{2}[\x20\x09-\x0D]+(?:[^\x20\x09-\x0D]+[!?#*$%&]{2}[\x20\x09-\x0D]+){2}[^\x20\x09-\x0D]+[!?#*$%&]{2}"  # four words in a row that end in doubled marks
NAVIGATION = r"(?:[|»›•·][\x20\x09-\x0D]+[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){2}[|»›•·]"  # a row of separated entries
BOILERPLATE = (r"(?i)\b(?:all rights reserved|cookie policy|accept (?:all )?cookies|we use cookies|privacy policy|terms of (?:use|service)"
               r"|click here|read more|sign up|log ?in to|subscribe to our|newsletter|enable javascript|javascript is (?:disabled|required)"
               r"|share (?:this|on) (?:facebook|twitter)|powered by wordpress|skip to (?:main )?content|back to top|lorem ipsum)\b")

#: ASCII and general punctuation, arrows, shapes.
_SYMBOL = r"!-/:-@\[-`{-~\u00A1-\u00A9\u00AB-\u00B1\u00B6-\u00B8\u00BB\u00BF\u00D7\u00F7\u2010-\u2027\u2030-\u205E\u2190-\u2BFF\u3001-\u3020"
_IN, _OUT = r"(?<![^\x20\x09-\x0D])", r"(?![^\x20\x09-\x0D])"  # begin and end of a word
MARKED = rf"{_IN}(?:[{_SYMBOL}]+|{WORD[:-1]}*[!?#*$%&]{{2}}){_OUT}"
#: Both begin with a rare character and look back from there, so that most places of a text are passed at one glance. Stands wherever MARKED does:
_MARK = rf"[!?#*$%&]{{2}}{_OUT}|[{_SYMBOL}](?<![^\x20\x09-\x0D][{_SYMBOL}])[{_SYMBOL}]*{_OUT}"
SEPARATOR = rf"[|»›•·→]+|[>/](?<![^\x20\x09-\x0D][>/]){_OUT}"
#: A word of digits and marks of numbers, with at least one digit.
NUMBER = rf"{_IN}[0-9.,:%+-]*[0-9][0-9.,:%+-]*{_OUT}"
TABLE_ROW = r"^[\x20\x09-\x0D]*\|.*\|[\x20\x09-\x0D]*$"
TABLE_HEAD = r"^[\x20\x09-\x0D]*\|?(?:[\x20\x09-\x0D]*:?-+:?[\x20\x09-\x0D]*\|)+(?:[\x20\x09-\x0D]*:?-+:?)?[\x20\x09-\x0D]*$"


def _let(value: Column, body) -> Column:
    """``body(x)`` with ``value`` worked out once per row."""
    return F.transform(F.array(value), body)[0]


def _fails(line: Column) -> Column:
    """The three line rules. Shares are only worked out where a pattern finds something."""
    words, marked = F.regexp_count(line, F.lit(WORD)), F.regexp_count(line, F.lit(MARKED))
    symbols = ~line.rlike(rf"[^{_SYMBOL}\x20\x09-\x0D]") & line.rlike(rf"(?:[{_SYMBOL}][\x20\x09-\x0D]*){{4}}") & ~line.rlike(TABLE_HEAD)
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    bare = F.regexp_replace(line, SEPARATOR, " ")
    entries, numbers = F.regexp_count(bare, F.lit(WORD)), F.regexp_count(bare, F.lit(NUMBER))
    phrases = F.regexp_count(F.array_join(F.regexp_extract_all(line, F.lit(BOILERPLATE), F.lit(0)), " "), F.lit(WORD))
    return ((line.rlike(_MARK) & ((marked >= 4) & ((2 * marked >= words) | (marked >= MIN_SHARE * words) & line.rlike(PUNCTUATION)) & ~line.rlike(TABLE_HEAD) & ~line.rlike(TABLE_ROW) | symbols))
            | (line.rlike(SEPARATOR) & (separators >= 2) & ~line.rlike(TABLE_ROW) & ~line.rlike(TABLE_HEAD) & (numbers < separators) & ((entries <= MAX_ENTRY * (separators + 1)) | (2 * separators >= MIN_SHARE * words) & line.rlike(NAVIGATION)))
            | (line.rlike(BOILERPLATE) & ((words <= SHORT_LINE) | (phrases >= MIN_SHARE * words))))


def repeated_words(words: Column) -> Column:
    """Words that stand in a three-word window held twice or more; ``words`` is a plain reference."""
    none = F.array().cast("array<bigint>")
    hashes = F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(none)

    def places(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return _let(pairs, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda p, k: (p["h"] == F.get(s, k - 1)["h"]) | (p["h"] == F.get(s, k + 1)["h"])), lambda p: p["i"])))

    def covered(at: Column) -> Column:
        # A window covers three words, less where the next repeated window begins earlier.
        return F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))),
                           F.lit(0).cast("long"), lambda a, x: a + x)

    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                .otherwise(_let(places(h), covered)))


def quality_rules(docs: DataFrame, min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT, max_lost: float = MAX_LOST) -> DataFrame:
    """``docs`` with the base counts, the verdict ``kept`` and ``clean_text`` (the lines that passed)."""
    docs = docs.drop(*ADDED)
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split(text, "\n")

    def verdict(w: Column) -> Column:
        # Only a text in which a pattern finds something can have a line that fails.
        found = F.when(text.rlike(_MARK) | text.rlike(SEPARATOR) | text.rlike(BOILERPLATE),
                       F.transform(lines, lambda x: F.struct(x.alias("line"), _fails(x).alias("bad"))))
        spoken = F.filter(lines, lambda x: x.rlike(WORD))
        n_words = F.size(w).cast("long")
        counts = F.struct(
            n_words.alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            _let(spoken, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            _let(found, lambda f: F.struct(
                F.coalesce(F.regexp_count(F.array_join(F.transform(F.filter(f, lambda x: x["bad"]), lambda x: x["line"]), "\n"), F.lit(WORD)),
                           F.lit(0)).cast("long").alias("lost_words"),
                F.coalesce(F.array_join(F.transform(F.filter(f, lambda x: ~x["bad"]), lambda x: x["line"]), "\n"), text).alias("clean_text"))).alias("lines"))
        return _let(counts, lambda c: _let((c["n_words"] < min_words) | (100 * c["n_repeat_words"] > max_repeat_pct * c["n_words"]), lambda failed: F.struct(
            *[c[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            c["lines"]["lost_words"].alias("lost_words"), failed.alias("base_failed"),
            (~failed & (c["lines"]["lost_words"] <= max_lost * c["n_words"])).alias("kept"), c["lines"]["clean_text"].alias("clean_text"))))

    # As a generator's output, so that a later filter on it does not work it out a second time.
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return docs.select("*", F.inline(F.transform(F.array(words), verdict))).select(*docs.columns, *ADDED)

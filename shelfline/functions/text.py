"""Small Column -> Column helpers shared by the normalisers.

Python's truthiness and ``str.strip`` semantics are reproduced with plain
Spark expressions so everything stays JVM-side and codegen-friendly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value, body) -> Column:
    """``body(x)`` with ``value`` worked out once per row, however often ``body`` uses it."""
    return F.transform(F.array(col(value)), body)[0]


def strip(c) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def truthy(c) -> Column:
    """Python truthiness of a string column: not null and not empty."""
    c = col(c)
    return c.isNotNull() & (c != F.lit(""))


def py_or(*cols) -> Column:
    """``a or b or c`` over strings: first truthy value, else the last operand."""
    cols = [col(c) for c in cols]
    return F.coalesce(*[F.when(truthy(c), c) for c in cols[:-1]], cols[-1])


def first_truthy(*cols) -> Column:
    """First truthy string; null when none is truthy."""
    return F.coalesce(*[F.when(truthy(col(c)), col(c)) for c in cols])


def contains_any(c, needles, lower: bool = False) -> Column:
    """True when ``c`` contains any non-empty needle (null -> False)."""
    c = col(c)
    if lower:
        c = F.lower(c)
    cond = F.lit(False)
    for n in needles:
        if n:
            cond = cond | F.coalesce(c.contains(n), F.lit(False))
    return cond


def num_text(c) -> Column:
    """Render a number the way Python prints ``float(x)``, minus a trailing ``.0``.

    Plain digits from 1e-4 up to 1e16, beyond that an exponent of at least two
    digits (``1e+16``, ``2.5e-05``).
    """
    x = F.col(c).try_cast("double") if isinstance(c, str) else c.try_cast("double")
    size = F.abs(x)
    # format_number prints the decimal in plain digits (never 0E-18 or 1E-7)
    # whatever the ANSI setting; the grouping commas are removed.
    plain = F.regexp_replace(F.format_number(x.try_cast("decimal(38,18)"), 18), ",", "")
    java = x.cast("string")  # 1.0E16, 2.5E-5
    power = F.substring_index(java, "E", -1).try_cast("int")
    exponent = F.concat(F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", ""), F.lit("e"),
                        F.when(power < 0, F.lit("-")).otherwise(F.lit("+")),
                        F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    return F.when((size >= 1e16) | ((size < 1e-4) & (size > 0)), exponent).otherwise(F.regexp_replace(plain, r"\.?0+$", ""))


def replace_first(c, needle: str, repl: str) -> Column:
    """Replace only the first occurrence of ``needle``."""
    c = col(c)
    pos = F.instr(c, needle)
    head = c.substr(F.lit(1), pos - 1)
    tail = c.substr(pos + len(needle), F.length(c) + 1)
    return F.when(pos > 0, F.concat(head, F.lit(repl), tail)).otherwise(c)


def compiled_apart(c) -> Column:
    """The column, kept out of whole-stage code: a projection that holds it is
    compiled by itself, in pieces. For wide projections whose fused code would
    pass the JVM's 64 KB method limit, which Spark only finds out after it has
    tried to compile it."""
    return F.transform(F.array(col(c)), lambda x: x)[0]

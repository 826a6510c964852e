"""HTML as column expressions: markup without comments and scripts, tags, attributes, character references.

Tags are read by the quoting rules of HTML: a value in double quotes may hold
apostrophes and ``>``, one in single quotes double quotes, a bare value ends
at white space or ``>``; names in any case. The patterns take every character
once (possessive groups), so no page makes them backtrack.
"""

from __future__ import annotations

import html
import html.entities
import json
import re
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline.functions.text import col, once, strip

#: What holds no markup: comments (an open one reaches to the end), scripts and style sheets.
UNMARKED = r"(?i:<(?:" + "|".join([r"!--[^-]*+(?:-(?!->)[^-]*+)*+(?:-->)?+", *[
    rf"{x}(?=[\s/>])[^<]*+(?:<(?!/{x}[\s/>])[^<]*+)*+(?:</{x}[^>]*+>)?+" for x in ("script", "style")]]) + "))"
_SEP, _NAME = r"[\s/=]*+", r"[^\s/>=]++"
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
_ATTRIBUTE = rf"{_NAME}(?:\s*+=\s*+{_VALUE}?+)?+"
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Any tag, opening or closing, and declarations.
TAG = rf"<[/!?]?[a-zA-Z](?:{_SEP}{_ATTRIBUTE})*+{_SEP}>"


def markup(c) -> Column:
    """A page without comments, scripts and style sheets; what looks like them inside a tag stays."""
    return F.regexp_replace(col(c), f"(?=<)(?:{UNMARKED}|({TAG}))", "$1")


def tags(c, wanted: str) -> Column:
    """All tags of a page, in order, that are of a pattern (see ``tag_regex``)."""
    every = F.regexp_extract_all(col(c), F.lit(f"(?=<)(?:{UNMARKED}|{TAG})"), 0)
    return F.filter(every, lambda t: t.rlike("^" + wanted))


def tag_regex(name: str = "[a-z][^\\s/>]*+") -> str:
    """Opening tags of a name (a pattern), whatever their attributes hold."""
    return rf"(?i:<{name}(?=[\s/>])(?:{_SEP}{_ATTRIBUTE})*+{_SEP}>)"


def class_regex(name: str, wanted: str) -> str:
    """Opening tags of a name whose class list holds ``wanted``."""
    one = rf"(?:[^\s\"'>]++\s++)*?{re.escape(wanted)}(?=[\s\"'>])"
    before = rf"(?:{_SEP}(?!class[\s/>=]){_ATTRIBUTE})*+"
    value = rf"""(?:"\s*+{one}[^"]*+"|'\s*+{one}[^']*+'|{one}[^\s>]*+)"""
    return rf"(?i:<{name}(?=[\s/>]){before}{_SEP}class\s*+=\s*+{value}(?:{_SEP}{_ATTRIBUTE})*+{_SEP}>)"


def with_attribute(name: str, wanted: str) -> str:
    """Opening tags of a name that give an attribute a value."""
    key = re.escape(wanted)
    return rf"(?i:<{name}(?=[\s/>])(?:{_SEP}(?!{key}[\s/>=]){_ATTRIBUTE})*+{_SEP}{key}\s*+=\s*+{_VALUE}(?:{_SEP}{_ATTRIBUTE})*+{_SEP}>)"


def element_regex(opening: str, name: str) -> str:
    """An element from its opening tag to the next closing tag; the last group is its content."""
    return rf"(?s){opening}(.*?)</(?i:{name})\s*>"


def raw_attribute(tag, name: str, anywhere: bool = False) -> Column:
    """Value of a tag's attribute, as it stands; null if empty or absent. ``anywhere``: of the first tag in a text that has one."""
    key = re.escape(name)
    found = ("" if anywhere else "^") + rf"(?i:<[a-z][^\s/>]*+(?:{_SEP}(?!{key}[\s/>=]){_ATTRIBUTE})*+{_SEP}{key}\s*+=\s*+({_VALUE}))"
    return once(F.regexp_replace(F.regexp_extract(col(tag), found, 1), r"""(?s)^(["'])(.*)\1$""", "$2"), lambda v: F.when(v != "", v))


def attribute(tag, *names: str, anywhere: bool = False) -> Column:
    """The first of some attributes of a tag that has a value, references decoded; null if none has."""
    return unescape_attribute(F.coalesce(*[raw_attribute(tag, n, anywhere) for n in names]))


def node_text(c) -> Column:
    """Text of an element's content: tags removed, each piece decoded and stripped, joined."""
    pieces = F.transform(F.split(col(c), TAG), lambda x: strip(unescape(x)))
    return F.array_join(pieces, "")


# ------------------------------------------------- character references

@cache
def _tables() -> tuple[str, str, str]:
    """(named references by their first letter, as JSON; those that need no semicolon, as a pattern; numbers that do not stand for themselves, as JSON)."""
    by_first: dict[str, dict[str, str]] = {}
    for name, value in html.entities.html5.items():
        by_first.setdefault(name[0], {})[name] = value
    open_names = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    numbers = {str(n): html.unescape(f"&#{n};") for n in range(0xA0)}
    return json.dumps(by_first), "^(" + "|".join(open_names) + ")", json.dumps({n: c for n, c in numbers.items() if c != chr(int(n))})


def _numbered(ref: Column) -> Column:
    digits = F.regexp_extract(ref, r"^&#[xX]?0*([0-9a-fA-F]*)", 1)
    short = F.when(F.length(digits) <= 7, digits)  # seven hex or decimal digits hold every code point
    base16 = F.conv(F.concat(F.lit("0"), short), 16, 10).cast("long")
    base10 = F.concat(F.lit("0"), short).try_cast("long")
    number = F.when(ref.rlike("^&#[xX]"), base16).otherwise(base10)
    return once(number, lambda n: F.coalesce(
        F.try_element_at(F.from_json(F.lit(_tables()[2]), "map<string,string>"), n.cast("string")),
        F.when(n.isNull() | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit("�"))
        .when(n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(0xFFFE) == 0xFFFE), F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))))


def _named(ref: Column, in_attribute: bool) -> Column:
    names, open_names, _ = _tables()
    table = F.from_json(F.lit(names), "map<string,map<string,string>>")  # a constant, worked out while planning
    body = F.substring(ref, 2, 64)
    start = F.regexp_extract(body, open_names, 1)
    rest = F.substr(body, F.length(start) + 1)
    if in_attribute:  # without a semicolon it may be part of a query string
        start = F.when(~rest.rlike("^[=A-Za-z0-9]"), start)
    # The whole name, else the longest one it begins with.
    values = F.transform(F.array(body, start), lambda n: F.try_element_at(F.try_element_at(table, F.substring(n, 1, 1)), n))
    return once(values, lambda v: F.coalesce(F.when(body.endswith(";") | ~F.lit(in_attribute), v[0]), F.concat(v[1], rest), ref))


def _decoded(c, in_attribute: bool) -> Column:
    def of(text: Column) -> Column:
        values = F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), 0), lambda r: F.when(r == "&amp;", F.lit("&")).when(
            r.startswith("&#"), _numbered(r)).otherwise(_named(r, in_attribute)))
        pieces = F.zip_with(F.split(text, _REFERENCE, -1), values, lambda p, v: F.concat(p, F.coalesce(v, F.lit(""))))
        return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)

    return once(c, of)


def unescape(c) -> Column:
    """Character references decoded: decimal, hexadecimal and all named ones, also where the semicolon is missing."""
    return _decoded(c, False)


def unescape_attribute(c) -> Column:
    """``unescape`` for attribute values: a name without semicolon before ``=``, a letter or a digit stays as it is."""
    return _decoded(c, True)

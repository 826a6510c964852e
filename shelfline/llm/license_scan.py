"""Operator 3, license scans by ordered signature rules.

A text is reduced to its words (A-Z lower-cased, joined by one space). An
Aho-Corasick automaton over the rules' keywords says which rules can match at
all; only those run their regex. Every match is an interval of words. Matches
are taken in order of priority, then length; one that lies inside a match
already taken is suppressed. Base phrases are found besides, and their labels
stay whatever the rules say.

A map over rows without shuffle: nothing is gathered, a long text costs its
own length only.

Defined results: a null or empty text has no word, no label and score 0; rows
are independent, so repeated rows and an empty table need no rule. Ties go to
the earlier start, then the earlier rule. Clashing columns are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Everything but digits, a-z and non-ASCII bytes parts words; A-Z is lower-cased.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

_L = r"(?:licen[sc]e|licen[sc]ing)"
_V = r"(?:v|version|ver)? ?"
#: (label, keywords of which every form holds one, "|" between, name as a regex over words, SPDX id as words).
#: A keyword of one word stands whole; one that ends in * may go on ("gpl*": gplv2).
FAMILIES = (
    ("mit", "mit", rf"mit(?: x11| expat)? {_L}", "mit"),
    ("mit-0", "mit no attribution", rf"mit no attribution(?: {_L})?", "mit 0"),
    ("apache-1.0", "apache", rf"apache(?: software)? {_L} {_V}1 0", "apache 1 0"),
    ("apache-1.1", "apache", rf"apache(?: software)? {_L} {_V}1 1", "apache 1 1"),
    ("apache-2", "apache", rf"apache(?: software)? {_L} {_V}2(?: 0)?", "apache 2 0"),
    ("gpl-1", "gnu general public", rf"gnu general public {_L} {_V}1(?: 0)?", "gpl 1 0"),
    ("gpl-2", "gnu general public", rf"gnu general public {_L} {_V}2(?: 0)?", "gpl 2 0"),
    ("gpl-3", "gnu general public", rf"gnu general public {_L} {_V}3(?: 0)?", "gpl 3 0"),
    ("gpl", "gnu general public", rf"gnu general public {_L}", "gpl"),
    ("gpl-2", "gpl*", r"(?:gnu )?gpl ?(?:v|version )? ?2(?: 0)?", "gpl 2 0 only"),
    ("gpl-3", "gpl*", r"(?:gnu )?gpl ?(?:v|version )? ?3(?: 0)?", "gpl 3 0 only"),
    ("lgpl-2.1", "lgpl*", r"(?:gnu )?lgpl ?(?:v|version )? ?2 1", "lgpl 2 1 only"),
    ("lgpl-2", "lgpl*", r"(?:gnu )?lgpl ?(?:v|version )? ?2(?: 0)?(?! 1)", "lgpl 2 0 only"),
    ("lgpl-3", "lgpl*", r"(?:gnu )?lgpl ?(?:v|version )? ?3(?: 0)?", "lgpl 3 0 only"),
    ("agpl-3", "agpl*", r"(?:gnu )?agpl ?(?:v|version )? ?3(?: 0)?", "agpl 3 0 only"),
    ("mpl-1.1", "mpl*", r"mpl ?(?:v|version )? ?1 1", "mpl 1 1 only"),
    ("mpl-2", "mpl*", r"mpl ?(?:v|version )? ?2(?: 0)?", "mpl 2 0 no copyleft exception"),
    ("epl-2", "epl*", r"epl ?(?:v|version )? ?2(?: 0)?", "epl 2 0 only"),
    ("apache-2", "apache*", r"apache ?(?:v|version )? ?2 0", "apache 2 0 only"),
    ("mit", "mit", r"mit licen[sc]ed", "mit modern variant"),
    ("apache-2", "apache", r"apache licen[sc]ed", "apache 2"),
    ("bsd", "bsd", r"bsd licen[sc]ed", "bsd"),
    ("lgpl-2", "gnu library general public", rf"gnu library general public {_L}(?: {_V}2(?: 0)?)?", "lgpl 2 0"),
    ("lgpl-2.1", "gnu lesser general public", rf"gnu lesser general public {_L} {_V}2 1", "lgpl 2 1"),
    ("lgpl-3", "gnu lesser general public", rf"gnu lesser general public {_L} {_V}3(?: 0)?", "lgpl 3 0"),
    ("lgpl", "gnu lesser general public", rf"gnu lesser general public {_L}", "lgpl"),
    ("agpl-3", "gnu affero general public", rf"gnu affero general public {_L}(?: {_V}3(?: 0)?)?", "agpl 3 0"),
    ("agpl-1", "affero general public", rf"affero general public {_L} {_V}1(?: 0)?", "agpl 1 0"),
    ("gfdl-1.1", "gnu free documentation", rf"gnu free documentation {_L} {_V}1 1", "gfdl 1 1"),
    ("gfdl-1.2", "gnu free documentation", rf"gnu free documentation {_L} {_V}1 2", "gfdl 1 2"),
    ("gfdl-1.3", "gnu free documentation", rf"gnu free documentation {_L} {_V}1 3", "gfdl 1 3"),
    ("gfdl", "gnu free documentation", rf"gnu free documentation {_L}", "gfdl"),
    ("bsd-2-clause", "bsd|freebsd", rf"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: {_L})?", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", rf"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: {_L})?", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", rf"(?:bsd 4 clause|4 clause bsd|original bsd|old bsd)(?: {_L})?", "bsd 4 clause"),
    ("0bsd", "bsd|0bsd", rf"(?:zero clause bsd|bsd zero clause|0bsd)(?: {_L})?", "0bsd"),
    ("bsd", "bsd", rf"bsd(?: style)? {_L}", "bsd"),
    ("mpl-1.0", "mozilla public", rf"mozilla public {_L} {_V}1 0", "mpl 1 0"),
    ("mpl-1.1", "mozilla public", rf"mozilla public {_L} {_V}1 1", "mpl 1 1"),
    ("mpl-2", "mozilla public", rf"mozilla public {_L} {_V}2(?: 0)?", "mpl 2 0"),
    ("epl-1", "eclipse public", rf"eclipse public {_L} {_V}1(?: 0)?", "epl 1 0"),
    ("epl-2", "eclipse public", rf"eclipse public {_L} {_V}2(?: 0)?", "epl 2 0"),
    ("edl-1", "eclipse distribution", rf"eclipse distribution {_L}(?: {_V}1 0)?", "edl 1 0"),
    ("cddl-1.0", "common development and distribution", rf"common development and distribution {_L} {_V}1 0", "cddl 1 0"),
    ("cddl-1.1", "common development and distribution", rf"common development and distribution {_L} {_V}1 1", "cddl 1 1"),
    ("cpl-1", "common public", rf"common public {_L}(?: {_V}1 0)?", "cpl 1 0"),
    ("cpal-1", "common public attribution", rf"common public attribution {_L}(?: {_V}1 0)?", "cpal 1 0"),
    ("isc", "isc", rf"isc {_L}", "isc"),
    ("zlib", "zlib", rf"zlib(?: libpng)? {_L}", "zlib"),
    ("libpng", "libpng", rf"libpng {_L}(?: {_V}2)?", "libpng 2 0"),
    ("bsl-1", "boost software", rf"boost software {_L}(?: {_V}1 0)?", "bsl 1 0"),
    ("busl-1.1", "business source", rf"business source {_L}(?: {_V}1 1)?", "busl 1 1"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", "unlicense"),
    ("wtfpl", "do what the fuck you want", rf"do what the fuck you want to public {_L}", "wtfpl"),
    ("artistic-1", "artistic", rf"artistic {_L} {_V}1(?: 0)?", "artistic 1 0"),
    ("artistic-2", "artistic", rf"artistic {_L} {_V}2(?: 0)?", "artistic 2 0"),
    ("artistic", "artistic", rf"(?:perl )?artistic {_L}", "artistic"),
    ("afl-3", "academic free", rf"academic free {_L}(?: {_V}3(?: 0)?)?", "afl 3 0"),
    ("osl-3", "open software", rf"open software {_L}(?: {_V}3(?: 0)?)?", "osl 3 0"),
    ("eupl-1.1", "european union public", rf"european union public licen[sc]e {_V}1 1", "eupl 1 1"),
    ("eupl-1.2", "european union public", rf"european union public licen[sc]e(?: {_V}1 2)?", "eupl 1 2"),
    ("cecill-2", "cecill", rf"cecill(?: free software)? {_L}(?: agreement)?(?: {_V}2(?: \d)?)?", "cecill 2 1"),
    ("postgresql", "postgresql", rf"postgresql {_L}", "postgresql"),
    ("python-2", "python software foundation", rf"python software foundation {_L}(?: agreement)?(?: {_V}2)?", "python 2 0"),
    ("php-3", "php", rf"php {_L} {_V}3(?: 0\d?)?", "php 3 01"),
    ("ruby", "ruby", rf"ruby {_L}", "ruby"),
    ("openssl", "openssl", rf"openssl {_L}", "openssl"),
    ("ncsa", "university of illinois", rf"university of illinois(?: ncsa)? open source {_L}", "ncsa"),
    ("w3c", "w3c", rf"w3c(?: software)?(?: notice and)? {_L}", "w3c"),
    ("odbl-1", "open database", rf"open database {_L}(?: {_V}1 0)?", "odbl 1 0"),
    ("odc-by-1", "open data commons attribution", rf"open data commons attribution {_L}(?: {_V}1 0)?", "odc by 1 0"),
    ("pddl-1", "public domain dedication and", rf"public domain dedication and {_L}(?: {_V}1 0)?", "pddl 1 0"),
    ("ofl-1.1", "open font", rf"(?:sil )?open font {_L}(?: {_V}1 1)?", "ofl 1 1"),
    ("ms-pl", "microsoft public", rf"microsoft public {_L}", "ms pl"),
    ("ms-rl", "microsoft reciprocal", rf"microsoft reciprocal {_L}", "ms rl"),
    ("upl-1", "universal permissive", rf"universal permissive {_L}(?: {_V}1 0)?", "upl 1 0"),
    ("vim", "vim", rf"vim {_L}", "vim"),
    ("sspl-1", "server side public", rf"server side public {_L}(?: {_V}1)?", "sspl 1 0"),
    ("elastic-2", "elastic", rf"elastic {_L}(?: {_V}2(?: 0)?)?", "elastic 2 0"),
    ("cc0-1", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by", "cc by", r"(?:creative commons )?cc by(?: [1-4] [05])?(?! (?:nc|nd|sa))", "cc by 4 0"),
    ("cc-by-sa", "cc by sa", r"(?:creative commons )?cc by sa(?: [1-4] [05])?", "cc by sa 4 0"),
    ("cc-by-nd", "cc by nd", r"(?:creative commons )?cc by nd(?: [1-4] [05])?", "cc by nd 4 0"),
    ("cc-by-nc", "cc by nc", r"(?:creative commons )?cc by nc(?: [1-4] [05])?(?! (?:nd|sa))", "cc by nc 4 0"),
    ("cc-by-nc-sa", "cc by nc sa", r"(?:creative commons )?cc by nc sa(?: [1-4] [05])?", "cc by nc sa 4 0"),
    ("cc-by-nc-nd", "cc by nc nd", r"(?:creative commons )?cc by nc nd(?: [1-4] [05])?", "cc by nc nd 4 0"),
    ("cc-by-nc", "creative commons", rf"creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)?(?: {_L})?", "cc by nc 3 0"),
    ("cc-by-sa", "creative commons", rf"creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)?(?: {_L})?", "cc by sa 3 0"),
    ("cc-by", "creative commons", rf"creative commons attribution(?: [1-4] [05])?(?: international| unported)?(?: {_L})?", "cc by 3 0"),
)
#: Full-text signatures: passages of license texts and notices (label, keyword, regex).
PASSAGES = (
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and use in source", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither the name of", r"neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse"),
    ("bsd-4-clause", "all advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2", "you may not use this file except", r"you may not use this file except in compliance with the license"),
    ("gpl", "this program is free software", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "this library is free software", r"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("gpl-2", "either version 2 of the", rf"(?:(?:under )?the terms of the )?gnu general public {_L} as published by the free software foundation either version 2 of the {_L}(?: or at your option any later version)?"),
    ("gpl-3", "either version 3 of the", rf"(?:(?:under )?the terms of the )?gnu general public {_L} as published by the free software foundation either version 3 of the {_L}(?: or at your option any later version)?"),
    ("lgpl-2.1", "either version 2 1 of the", rf"(?:(?:under )?the terms of the )?gnu lesser general public {_L} as published by the free software foundation either version 2 1 of the {_L}(?: or at your option any later version)?"),
    ("lgpl-3", "either version 3 of the", rf"(?:(?:under )?the terms of the )?gnu lesser general public {_L} as published by the free software foundation either version 3 of the {_L}(?: or at your option any later version)?"),
    ("agpl-3", "either version 3 of the", rf"(?:(?:under )?the terms of the )?gnu affero general public {_L} as published by the free software foundation either version 3 of the {_L}(?: or at your option any later version)?"),
    ("mpl-2", "this source code form is subject", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("zlib", "this software is provided as is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "free and unencumbered software", r"this is free and unencumbered software released into the public domain"),
    ("bsl-1", "permission is hereby granted", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("cc0-1", "waived all copyright", r"(?:has|have) waived all copyright and related or neighboring rights"),
    ("public-domain", "public domain", r"(?:released|dedicated|placed) (?:in|in ?to|to) the public domain"),
    ("proprietary", "proprietary and confidential", r"(?:unauthorized copying of this file [^ ].{0,60}? )?proprietary and confidential"),
)
#: How a family's name is met: (form, regex around the name, priority, confidence).
FORMS = (
    ("grant", r"(?:licen[sc]ed|released|distributed|available|published|provided|redistributed|made available|dual licen[sc]ed) "
              r"(?:under|according to|pursuant to|subject to) (?:the )?(?:terms (?:and conditions )?of )?(?:the |an? )?{name}", 3, 0.95),
    ("terms", r"(?:under|per|by|accept|see) the (?:terms (?:and conditions )?of (?:the )?)?{name}", 2, 0.85),
    ("name", r"{name}", 1, 0.7),
)
SPDX = ("spdx", r"spdx license identifier {spdx}(?: or later| only)?", 4, 1.0)
#: A field of a manifest or a readme.
FIELD = ("field", r"licen[sc]e (?:type )?{spdx}", 2, 0.85)


@cache
def rules() -> list[tuple[str, str, str, re.Pattern, int, float]]:
    """(rule, label, keyword, regex, priority, confidence), in order."""
    out = []
    for label, keyword, name, spdx in FAMILIES:
        for form, around, priority, score in FORMS:
            out.append((f"{form}:{label}", label, keyword, around.replace("{name}", name), priority, score))
        form, around, priority, score = SPDX
        out.append((f"{form}:{label}", label, "spdx license identifier", around.replace("{spdx}", spdx), priority, score))
        form, around, priority, score = FIELD
        opening = "|".join(f"{field} {spdx}" for field in ("license", "licence", "license type", "licence type"))
        out.append((f"{form}:{label}", label, opening, around.replace("{spdx}", spdx), priority, score))
    out += [(f"passage:{label}", label, keyword, regex, 3, 0.9) for label, keyword, regex in PASSAGES]
    return [(rule, label, keyword, re.compile(rf"(?<![^ ]){regex}(?![^ ])"), priority, score) for rule, label, keyword, regex, priority, score in out]


@cache
def gate() -> ahocorasick.Automaton:
    """Keyword -> numbers of the rules it opens."""
    by: dict[str, list[int]] = {}
    for i, rule in enumerate(rules()):
        for keyword in rule[2].split("|"):
            by.setdefault(keyword, []).append(i)
    a = ahocorasick.Automaton()
    for keyword, numbers in by.items():
        a.add_word(f" {keyword.rstrip('*')}" if " " in keyword or keyword.endswith("*") else f" {keyword} ", numbers)
    a.make_automaton()
    return a


def normalized(text: bytes | None) -> str:
    """The words of a text between single spaces; one character for each byte, so only the plain space parts words (bytes 85 and A0 are parts of letters)."""
    return " " + b" ".join((text or b"").translate(_TABLE).split()).decode("latin-1") + " "


def opened(norm: str) -> list[int]:
    """Numbers of the rules whose regex has to run on a normalized text."""
    return sorted({i for _, numbers in gate().iter(norm) for i in numbers})


def detect(norm: str) -> list[dict]:
    """The license intervals of a normalized text that no stronger one contains, in order of start."""
    found = []
    for i in opened(norm):
        rule, label, _, regex, priority, score = rules()[i]
        word, last = -1, 0
        for m in regex.finditer(norm):
            word += norm.count(" ", last, m.start())
            last = m.start()
            found.append({"label": label, "rule": rule, "start": word, "end": word + m[0].count(" ") + 1, "priority": priority, "score": score, "_order": i})
    found.sort(key=lambda d: (-d["priority"], d["start"] - d["end"], d["start"], d["_order"]))
    longest = max((d["end"] - d["start"] for d in found), default=0)
    kept: list[dict] = []
    reach: dict[int, int] = {}  # start of a kept interval -> its furthest end
    for d in found:
        if not any(reach.get(s, 0) >= d["end"] for s in range(d["start"] - longest, d["start"] + 1)):
            kept.append(d)
            reach[d["start"]] = max(reach.get(d["start"], 0), d["end"])
    return sorted(({k: v for k, v in d.items() if k != "_order"} for d in kept), key=lambda d: (d["start"], d["end"], d["rule"]))


def base_places(norm: str) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase."""
    out = []
    for phrase, label in BASE_PHRASES:
        at, word, last = norm.find(f" {phrase} "), 0, 0
        while at >= 0:
            word += norm.count(" ", last, at)
            last = at
            out.append((word, label))
            at = norm.find(f" {phrase} ", at + 1)
    return out


_DETECTIONS = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("rule", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("priority", T.IntegerType()), T.StructField("score", T.DoubleType())]))
_ADDED = [T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
          T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
          T.StructField("score", T.DoubleType()), T.StructField("detections", _DETECTIONS)]
_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([
    ("label", pa.string()), ("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("priority", pa.int32()), ("score", pa.float64())]))]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            norm = normalized(text)
            base, found = base_places(norm), detect(norm)
            places, labels = [p for p, _ in base], {x for _, x in base}
            rows.append((max(0, norm.count(" ") - 1) if norm.strip() else 0, len(base), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
                         ",".join(sorted(labels | {d["label"] for d in found})), max([1.0] * bool(base) + [d["score"] for d in found], default=0.0), found))
        columns = list(zip(*rows)) if rows else [[] for _ in _ADDED]
        added = [pa.array(list(c), t) for c, t in zip(columns, _ARROW)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *[f.name for f in _ADDED]])


def license_scan(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts, labels, score and ``detections`` (label, rule, interval of words)."""
    docs = docs.drop(*[f.name for f in _ADDED])
    return docs.mapInArrow(_scan, T.StructType([*docs.schema.fields, *_ADDED]))

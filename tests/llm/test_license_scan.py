import re

import pytest
from cases import clashing, rows, table

from shelfline.llm.license_scan import BASE_PHRASES, base_places, detect, license_scan, normalized, opened, rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[str]:
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def places(text: str | None) -> list[tuple[int, str]]:
    w = words(text)
    return sorted((i, label) for phrase, label in BASE_PHRASES for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split())


LICENSED = [
    (300, "Released under the MIT License.\nUnder the MIT-license, under\tthe mit LICENSE", "en", "a", 1),
    (301, "Licensed under the Apache License, Version 2.0.", "en", "a", 1), (302, "Licensed under CC BY-NC 4.0.", "en", "a", 1),
    (303, "This work is licensed under the GNU General Public License, version 3.", "en", "a", 1),
    (304, "under the mit licenses, xunder the mit license, apache license version 20", "en", "a", 1),
    (305, "under the mit license " * 3000, "en", "a", 1), (306, "ünder the mit license é under the mit license", "en", "a", 1),
]


def test_base_against_brute_force(spark):
    data = rows() + LICENSED
    got = {str((r["doc_id"], r["text"])): r for r in license_scan(clashing(table(spark, data))).collect()}
    for d, text, *_ in data:
        r, found = got[str((d, text))], places(text)
        assert (r["n_words"], r["n_base"]) == (len(words(text)), len(found))
        assert (r["first_word"], r["last_word"]) == ((found[0][0], found[-1][0]) if found else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert got[str((303, LICENSED[3][1]))]["labels"] == "gpl-3"
    assert [r["labels"] for r in got.values() if r["doc_id"] is not None and r["doc_id"] < 60] == [""] * 60  # clean prose


def test_base_places_of_a_text():
    assert base_places(normalized(LICENSED[0][1].encode())) == [(1, "mit"), (5, "mit"), (9, "mit")]


@pytest.mark.parametrize(("text", "labels"), [
    ("GNU Lesser General Public License version 2.1", ["lgpl-2.1"]), ("GNU General Public License v2", ["gpl-2"]), ("SPDX-License-Identifier: BSD-3-Clause", ["bsd-3-clause"]),
    ("licensed under the terms of the Mozilla Public License, v. 2.0", ["mpl-2"]), ("Creative Commons Attribution-ShareAlike 4.0", ["cc-by-sa"]),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", ["mit"]),
    ("They committed to submit a license.", []), ("cc by nc nd 4.0", ["cc-by-nc-nd"]),
])
def test_rules(text, labels):
    assert [d["label"] for d in detect(normalized(text.encode()))] == labels


def test_gate_loses_nothing():
    """Every rule's own keyword stands in every text its regex matches."""
    texts = [f"under the {name} and spdx license identifier {spdx}" for name, spdx in
             [("apache license version 2 0", "mit"), ("gnu general public license v3", "apache 2 0"), ("bsd 3 clause license", "isc"), ("isc license", "zlib"), ("unlicense", "0bsd"), ("0bsd", "unlicense")]]
    for t in texts:
        norm = normalized(t.encode())
        ungated = {d for _, label, _, regex, _, _ in rules() for d in [label] if regex.search(norm)}
        assert {d["label"] for d in detect(norm)} <= ungated
        best = max((m.end() - m.start(), label) for _, label, _, regex, _, _ in rules() for m in regex.finditer(norm))
        assert best[1] in {d["label"] for d in detect(norm)}


def test_contained_weaker_matches_are_suppressed():
    found = detect(normalized(b"licensed under the Apache License, Version 2.0"))
    assert len(found) == 1 and found[0]["rule"] == "grant:apache-2" and (found[0]["start"], found[0]["end"]) == (0, 8)


def test_empty(spark):
    assert license_scan(table(spark, [])).count() == 0
    assert len(rules()) > 200


def forms(parsed, most: int = 3) -> list[str]:
    """Texts of a parsed regex in which each alternative and each optional part is taken and left out."""
    out = [""]
    for op, av in parsed:
        op = str(op)
        if op == "LITERAL":
            own = [chr(av)]
        elif op == "IN":
            own = [chr(v if str(k) == "LITERAL" else v[0]) for k, v in av if str(k) in ("LITERAL", "RANGE")] or ["1"]
        elif op == "BRANCH":
            own = [x for alternative in av[1] for x in forms(alternative)]
        elif op == "SUBPATTERN":
            own = forms(av[3])
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            own = [x * k for k in sorted({av[0], min(av[1], max(1, av[0]))}) for x in (forms(av[2]) if k else [""])]
        elif op in ("ASSERT", "ASSERT_NOT"):
            own = [""]
        else:
            own = ["x"]
        n = max(len(own), len(out)) if len(own) * len(out) > 4000 else 0
        out = [out[i % len(out)] + own[i % len(own)] for i in range(n)] if n else [a + b for a in out for b in own]
    return list(dict.fromkeys(out))


def test_gate_opens_every_rule_that_matches():
    """Over every alternative of each regex, the gate opens the rule that matches it."""
    tried = 0
    for i, (rule, _, _, regex, _, _) in enumerate(rules()):
        texts = [norm for x in forms(re._parser.parse(regex.pattern)) if regex.search(norm := normalized(x.encode()))]
        assert texts, rule
        tried += len(texts)
        assert [x for x in texts if i not in opened(x)] == [], rule
    assert tried > 2000


@pytest.mark.parametrize(("text", "label"), [
    ("licensed under GPLv2", "gpl-2"), ("under the GPL3", "gpl-3"), ("GNU GPLv3", "gpl-3"), ("GPL version 2", "gpl-2"),
    ("FreeBSD License", "bsd-2-clause"), ("released under 0BSD", "0bsd"), ("zero clause BSD", "0bsd")])
def test_names_written_as_one_word(text, label):
    assert [d["label"] for d in detect(normalized(text.encode()))] == [label]


NOTICE = """{what} is free software; you can redistribute it and/or modify it under the terms of the {name} as published by the
Free Software Foundation; either version {version} of the License, or (at your option) any later version."""


@pytest.mark.parametrize("text, labels", [
    ("Neither the name of Università di Pisa nor the names of its contributors may be used to endorse", {"bsd-3-clause"}),
    ("Neither the name of Škoda à la carte nor the names of its contributors may be used to endorse", {"bsd-3-clause"}),
    ("voilàmit license and mit", set()), ("Šmit license", set()), ("the mit licenseà", set()), ("the mit license à", {"mit"}),
    ("LGPL v2.1", {"lgpl-2.1"}), ("LGPLv2.1+", {"lgpl-2.1"}), ("LGPLv2 only", {"lgpl-2"}), ("licensed under AGPLv3", {"agpl-3"}), ("MPL 2.0", {"mpl-2"}), ("Apache 2.0", {"apache-2"}),
    ("MIT licensed", {"mit"}), ("License: MIT", {"mit"}), ("license = Apache-2.0", {"apache-2"}), ("Licence type: BSD-3-Clause", {"bsd-3-clause"}), ("GPLv3", {"gpl-3"}),
    (NOTICE.format(what="This program", name="GNU General Public License", version="2"), {"gpl-2", "gpl"}),
    (NOTICE.format(what="Foo", name="GNU General Public License", version="3"), {"gpl-3"}),
    (NOTICE.format(what="This library", name="GNU Lesser General Public License", version="2.1"), {"lgpl-2.1", "lgpl"}),
    (NOTICE.format(what="Bar", name="GNU Affero General Public License", version="3"), {"agpl-3"}),
    ("The Apache web server, version 2 of it, and 2 licenses", set()), ("a mit of license", set()), ("epl 2 teams", {"epl-2"}),
])
def test_short_names_notices_and_other_alphabets(text, labels):
    found = {d["label"] for d in detect(normalized(text.encode()))}
    assert found == labels


def test_bytes_of_letters_are_no_spaces():
    """No rule takes a byte of a non-ASCII letter for white space: inside a word with such letters none matches, beside one all do."""
    for rule, _, _, regex, _, _ in rules():
        assert not any(x in regex.pattern for x in (r"\s", r"\S", r"\b", r"\w")), rule
        form = next(f for f in forms(re._parser.parse(regex.pattern)) if regex.fullmatch(f))
        for word in ("voilà", "Š", "\u0085\u00a0", "字\u3000"):
            assert not regex.match(normalized((word + form).encode()), 1), (rule, form)
            beside = normalized(f"{word} {form} {word}".encode())
            assert any(form in m[0] for m in regex.finditer(beside)), (rule, form)

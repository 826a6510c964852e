import re
from collections import Counter

from cases import clashing, rows, table

import duckdb
import pytest

from shelfline.llm.oracle import ORACLE
from shelfline.llm.queries import REGISTRY
from shelfline.llm.quality_rules import BOILERPLATE, NAVIGATION, PUNCTUATION, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


BARS = re.compile("[|»›•·→]+")
RANGES = [(0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E), (0xA1, 0xA9), (0xAB, 0xB1), (0xB6, 0xB8), (0xBB, 0xBB), (0xBF, 0xBF), (0xD7, 0xD7), (0xF7, 0xF7),
          (0x2010, 0x2027), (0x2030, 0x205E), (0x2190, 0x2BFF), (0x3001, 0x3020)]


def is_symbol(c: str) -> bool:
    return any(a <= ord(c) <= b for a, b in RANGES)


def fails(line: str) -> bool:
    """The three rules, word by word."""
    words = WORD.findall(line)
    marked = sum(all(map(is_symbol, w)) or len(w) > 1 and all(c in "!?#*$%&" for c in w[-2:]) for w in words)
    cells = line.strip(" \t\n\x0b\x0c\r").split("|")
    row = len(cells) > 2 and not cells[0] and not cells[-1]
    inner = [c.strip(" \t\n\x0b\x0c\r") for c in cells]
    inner = inner[1:] if inner and not inner[0] else inner
    closed = inner[:-1] if inner and not inner[-1] else inner
    head = "|" in line and len(closed) >= 1 and all(re.fullmatch(":?-+:?", c) for c in closed)
    table = row or head
    if not table and marked >= 4 and (2 * marked >= len(words) or marked >= 0.25 * len(words) and re.search(PUNCTUATION, line)):
        return True
    bare = "".join(words)
    if not head and len(bare) >= 4 and all(map(is_symbol, bare)):
        return True
    alone = sum(w in (">", "/") for w in words)
    separators = len(BARS.findall(line)) + alone
    left = WORD.findall(BARS.sub(" ", line))
    numbers = sum(bool(re.fullmatch("[0-9.,:%+-]+", w)) and any(c.isdigit() for c in w) for w in left)
    if not table and separators >= 2 and numbers < separators:
        if len(left) - alone <= 2.5 * (separators + 1) or 2 * separators >= 0.25 * len(words) and re.search(NAVIGATION, line):
            return True
    phrases = sum(len(WORD.findall(m[0])) for m in re.finditer(BOILERPLATE, line, re.ASCII))
    return phrases > 0 and (len(words) <= 15 or phrases >= 0.25 * len(words))


def brute(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {p for i, w in enumerate(windows) if count[w] > 1 for p in (i, i + 1, i + 2)}
    lines = text.split("\n")
    spoken = [x for x in lines if WORD.search(x)]
    failed = [x for x in lines if fails(x)]
    lost = sum(len(WORD.findall(x)) for x in failed)
    base = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(spoken) - len(set(spoken)), "n_repeat_words": len(covered), "lost_words": lost, "base_failed": base,
            "kept": not base and lost <= 0.5 * len(words), "clean_text": "\n".join(x for x in lines if x not in failed)}


JUNK = [
    (200, "a b c a b c a b c\n" * 20, "en", "a", 1), (201, "WORD!! NEXT!! MORE!! STILL!! " * 30, "en", "a", 1),
    (202, "home | about | news | more | " * 20 + "\n" + "Plain words of a sentence here. " * 3, "en", "a", 1),
    (203, "Accept all cookies now.\n" + " ".join(f"v{i}" for i in range(80)), "en", "a", 1),
    (206, "Some### odd$$$ marks%%% here*** and&&& there### again%%% " * 12 + "\nClosing words.", "en", "a", 1),
    (204, "x y " * 40, "en", "a", 1), (205, "one two three one two three", "en", "a", 1),
]


def test_against_brute_force(spark):
    data = rows() + JUNK
    got = quality_rules(table(spark, data)).collect()
    want = Counter(str((r[0], sorted(brute(r[1]).items()))) for r in data)
    names = list(brute(""))
    assert Counter(str((r["doc_id"], sorted((k, r[k]) for k in names))) for r in got) == want
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not any(kept[d] for d in (200, 201, 202, 204, 205, 206)) and kept[203]


def filler(n: int) -> str:
    return " ".join(f"v{i}" for i in range(n))


#: Lines at both sides of every limit: (line, whether it fails).
LIMITS = [
    ("click here " + filler(13), True), ("click here " + filler(14), False),                      # 15 and 16 words
    ("click here " * 4 + filler(24), True), ("click here " * 4 + filler(25), False),              # 8 of 32 and of 33
    ("a!! b!! c!! d!! " + filler(12), True), ("a!! b!! c!! d!! " + filler(13), False),            # in a row: 4 of 16 and of 17
    ("a!! x b!! c!! d!! " + filler(3), True), ("a!! x b!! c!! d!! " + filler(4), False),          # not in a row: 4 of 8 and of 9
    ("a!! b!! c!!", False), ("a!! b!! c!! d!!", True), ("....", True), ("...", False), (". , ; :", True),
    ("one two | three four | five six seven", True), ("one two | three four | five six seven eight", False),  # 7 and 8 words for 3 entries
    ("one | two three", False), ("one | two | three", True), ("one > two > three", True), ("one>two>three", False),
    ("| a | b | c | " + filler(25), True), ("| a | b | c | " + filler(26), False),                # separators: 4 of 32 and of 33 words, with as many entries a quarter
    ("1 > 0 / 3 | 4 and so it goes on", False), ("| Name | Price | Stock |", False), ("| --- | :---: | ---: |", False), ("--- | ---", False), ("|---|", False),
    ("| 1 | 2 | 3 |", False), ("10 | 20 | 30", False), ("Home | 2 | Next", True), ("Home | About | 3.5", True), ("5 | 6 | Next", False), ("----", True), ("-- -- --", True),
    ("| a!! | b!! | c!! | d!! |", False), ("|", False), ("||||", True), ("", False),
]


def test_lines_at_every_limit(spark):
    assert [fails(x) for x, _ in LIMITS] == [y for _, y in LIMITS]
    docs = [(i, PLAIN + "\n" + x, "en", "a", 1) for i, (x, _) in enumerate(LIMITS)]
    out = {r["doc_id"]: r["clean_text"] for r in quality_rules(table(spark, docs)).collect()}
    assert [out[i] == PLAIN for i, _ in enumerate(LIMITS)] == [y for _, y in LIMITS]


@pytest.mark.parametrize("filling", [0, 1, 7])
def test_sql_states_the_same_rules(spark, tmp_path, filling):
    """Documents that a failing line just rejects, or just not, by the operator, the SQL and the loops."""
    data = rows(n=20) + JUNK if not filling else []
    for i, (x, _) in enumerate(LIMITS):
        n = len(WORD.findall(x))
        spare = " ".join(f"s{j}" for j in range(max(0, 50 - 2 * n) + filling))
        data.append((1000 + i, "\n".join([x, " ".join(f"t{j}" for j in range(n + filling)), spare, x.upper()]), "en", "a", 1))
    data = [r for r in {r[0]: r for r in data}.values() if r[0] is not None]
    table(spark, data).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = REGISTRY["op5_quality_rules"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    sql = con.execute(ORACLE["op5_quality_rules"])
    names = [d[0] for d in sql.description]
    want = sorted(sql.fetchall())
    assert sorted(tuple(r) for r in got.select(*names).collect()) == want
    assert {r[0]: r[names.index("kept")] for r in want} == {r[0]: brute(r[1])["kept"] for r in data}
    assert len({r[names.index("kept")] for r in want}) == 2


def test_clashing_columns_and_empty(spark):
    out = quality_rules(clashing(table(spark, rows())))
    assert out.filter("key = 'mine'").count() == len(rows()) and dict(out.dtypes)["kept"] == "boolean"
    assert quality_rules(table(spark, [])).count() == 0


def test_no_shuffle_and_no_python(spark):
    plan = quality_rules(table(spark, rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


PLAIN = " ".join(f"v{i}" for i in range(200))


def passed(spark, lines: list[str]) -> list[str]:
    """The lines that stay in a document of their own beside clean words."""
    docs = [(i, PLAIN + "\n" + x, "en", "a", 1) for i, x in enumerate(lines)]
    out = {r["doc_id"]: r["clean_text"] for r in quality_rules(table(spark, docs)).collect()}
    return [x for i, x in enumerate(lines) if out[i] == PLAIN + "\n" + x]


def test_long_clean_lines_that_mention_a_phrase(spark):
    longs = [f"{PLAIN} read more about it in our newsletter {PLAIN.upper()}", f"{PLAIN} Wow!! Such!! Many!! Marks!! here",
             f"{PLAIN} home | about | news | more and so on"]
    out = quality_rules(table(spark, [(i, x, "en", "a", 1) for i, x in enumerate(longs)])).collect()
    assert sorted((r["doc_id"], r["kept"], r["lost_words"], r["clean_text"]) for r in out) == [(i, True, 0, x) for i, x in enumerate(longs)]
    dense = " ".join(["Read more", "Privacy policy", "Terms of use", "About the shop", "Click here now", "All rights reserved"] * 4)
    assert passed(spark, ["Please read more here.", "Accept all cookies now.", dense]) == []


def test_lines_unlike_the_given_junk(spark):
    bad = ["Home | About us | Contact us | Log in", "Home > Shop > Shoes", "Home / News / Sport", "Home|About us|Contact", "Start » Produkte » Große Schuhe",
           "-----", "......", "=====", "$$ $$ $$ $$", ", . , . , .", "* * * * *", "Buy!! now!! best!! price!!", "\u2014\u2014\u2014\u2014", "~~~ *** ~~~"]
    good = ['"No," he said. "Why?"', "x = y + z", "}", "Either and/or both, as 3 / 4 of them say.", "\u2022 one point of a list with some words", "Well... that is it!", "# A title",
            "We saw it \u2013 and then \u2013 again, far away.", "If a > b then the first one of them is the larger and b > c holds as well."]
    assert passed(spark, bad + good) == good

"""The cascade and the base counts against plain versions."""

import re
from collections import Counter

from skygrid.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, kept string, rejected_by int"
PROSE = " ".join(f"word{i} of tale{i * 7 % 31}" for i in range(40))
TEXTS = [
    PROSE, None, "", " \t\n\x0b\x0c\r ", "short text", "a b c " * 60, PROSE + " ###" * 60, PROSE.upper().replace("OF", "OF!!"),
    "\n".join(["the same line of text again"] * 3 + [f"other line {i} with words" for i in range(20)]), "x" * 200_000, PROSE + "\n  \n  \n" + "é" * 30,
    "a a a a a", " ".join("ab" for _ in range(80)), PROSE * 400,
]


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    counts = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)
    return *counts, len(words) < 50 or 100 * len(repeated) > 50 * len(words), len(lines)


def test_counts_are_those_of_the_texts(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "x", 1), (None, PROSE, "x", 1)], SCHEMA)
    out = quality.judge_with_counts(docs).collect()
    assert len(out) == len(TEXTS) + 2
    for r in out:
        want = plain(PROSE if r.doc_id is None else TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want[:6]
        text = (PROSE if r.doc_id is None else TEXTS[r.doc_id]) or ""
        upper, lower = len(re.findall("[A-Z]", text)), len(re.findall("[a-z]", text))
        fails = want[5] or 10 * want[2] > want[0] or upper > lower or 2 * want[3] > want[6] or not 2 * want[0] <= want[1] <= 20 * want[0]
        assert r.kept == (not fails)


def test_judge_keeps_columns_and_replaces_clashing_ones(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], SCHEMA)
    out = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert out[0].kept and out[0].rejected_by is None and out[0].text == PROSE
    assert not out[1].kept and not out[6].kept and not out[7].kept and not out[5].kept
    assert quality.judge(docs.filter("doc_id < 0")).count() == 0


def test_order_is_rejections_per_cost_of_what_is_left():
    rules = [quality.Rule(n, lambda t: False) for n in "abc"]
    sample = [{"cost": [100, 10, 1], "rejects": [True, i < 4, i < 4]} for i in range(10)]
    assert [r.name for r in quality.in_order(rules, sample)] == ["c", "a", "b"]
    assert len(quality.in_order(rules, [])) == 3


def test_cascade_stops_at_the_first_rejection():
    asked = []
    rules = [quality.Rule(n, lambda t, n=n: asked.append(n) or n == "b") for n in "abc"]
    assert quality.cascade(b"x", rules) == "b" and asked == ["a", "b"]

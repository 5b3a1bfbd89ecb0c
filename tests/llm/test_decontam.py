"""Leaks found by latent retrieval against planted items and a search of all places."""

import random

import pytest

from skygrid.llm import decontam

SCHEMA = "doc_id long, text string, leaks string, item_id int, cosine int"
ITEMS = "item_id long, text string, leaks int"


@pytest.fixture(scope="module")
def data():
    rng = random.Random(3)
    common = [f"c{i}" for i in range(40)]
    word = lambda: rng.choice(common) if rng.random() < 0.5 else f"r{rng.randint(0, 8000)}"
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    items = [(i, "\n".join(sentence(rng.randint(8, 15)) for _ in range(3))) for i in range(60)]
    docs, planted = [], set()
    for d in range(300):
        words = sentence(rng.randint(50, 300)).split()
        if d % 10 == 0:
            k = rng.randrange(60)
            text = items[k][1].replace("\n", " ").split()
            if d % 20 == 0:  # a paraphrase: a fifth of the words changed, the answer whole
                keep = len(items[k][1].split("\n")[-1].split())
                text = [w if i >= len(text) - keep or rng.random() > 0.2 else word() for i, w in enumerate(text)]
            at = rng.randrange(len(words))
            words[at:at] = text
            planted.add((d, k))
        docs.append((d, " ".join(words)))
    return items, docs, planted


def test_planted_items_are_found_and_nothing_else(spark, data):
    items, docs, planted = data
    table = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], SCHEMA).repartition(4)
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    rows = decontam.leaks(table, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == planted
    assert all(r.lcs >= decontam.PARTLY * r.item_words and r.cosine >= decontam.NEAR for r in rows)


def test_odd_rows(spark, data, monkeypatch):
    items, docs, planted = data
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 25)  # several blocks
    rows = [(None, docs[0][1]), (0, docs[0][1]), (0, docs[0][1]), (1, None), (2, ""), (3, "few words"), (4, docs[5][1] * 200), (5, docs[10][1])]
    table = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], SCHEMA)
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items] + [(90, None, 1), (91, "", 1), (92, "too few words", 1)], ITEMS)
    out = decontam.with_leaks(table, benchmark)
    assert sorted(out.columns) == sorted(table.columns) and out.count() == len(rows)
    held = [(r.doc_id, [x.item_id for x in r.leaks]) for r in out.collect()]
    of = {d: [k for e, k in planted if e == d] for d in (0, 10)}
    assert held == [(None, of[0]), (0, of[0]), (0, of[0]), (1, []), (2, []), (3, []), (4, []), (5, of[10])]
    assert decontam.leaks(table.filter("doc_id < 0"), benchmark).count() == 0
    assert decontam.leaks(table, benchmark.filter("item_id < 0")).count() == 0


def test_lcs():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 8))] for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam.lcs(a, b) == table[-1][-1]


def test_answer_and_words():
    assert decontam.words_of("Don't, É-x!") == [b"don", b"t", "é".encode(), b"x"]
    assert decontam.answer_of("A b. C d?\nE f g.") == [b"e", b"f", b"g"]
    assert decontam.answer_of("A b. C d? ") == [b"c", b"d"]
    assert decontam.answer_of("") == []


def test_items_in_a_third_of_the_rows_are_found(spark, data):
    """One item in a third of the texts, copied or with a fifth of its words changed; one of frequent words only."""
    items, docs, planted = data
    rng = random.Random(12)
    spread = [f"s{i}" for i in range(36)]
    plain = " ".join(f"c{i}" for i in rng.sample(range(40), 12))
    items = [*items, (70, "\n".join(" ".join(spread[i : i + 12]) for i in (0, 12, 24))), (71, plain)]
    table, want = [], set(planted)
    for d, text in docs:
        words, text = text.split(), []
        if d % 3 == 0:
            text = [w if d % 2 or i >= 24 or rng.random() > 0.2 else "c3" for i, w in enumerate(spread)]
            want.add((d, 70))
        elif d % 50 == 1:
            text = plain.split()
            want.add((d, 71))
        # At the end: planted items stay whole.
        table.append((d, " ".join([*words, "then", *text, "and", f"e{d}"]), "x", 1, 2))
    rows = decontam.leaks(spark.createDataFrame(table, SCHEMA).repartition(4), spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want
    assert len(rows) == len(want)


def test_singular_vectors_read_every_text_once(spark, data, monkeypatch, tmp_path):
    items, docs, _ = data
    block, read, words_of = decontam.Block(items), tmp_path / "read", decontam.words_of

    def noted(text):
        with open(read, "a") as f:
            f.write("x\n")
        return words_of(text)

    monkeypatch.setattr(decontam, "words_of", noted)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    axes = decontam.singular_vectors(table, block, decontam.np.ones(len(block.terms)), len(docs))
    assert axes.shape == (len(block.terms), decontam.RANK) and len(read.read_text().split()) == len(docs)

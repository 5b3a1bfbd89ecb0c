"""Context mixing: base scores against a plain count, a proper code, and held-out gain."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from skygrid.llm import mixing

SCHEMA = "doc_id long, text string, score string, fold int"


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(6)
    follow = rng.integers(0, 300, (300, 3))
    rows = []
    for d in range(400):
        w, words = int(rng.integers(300)), []
        for _ in range(int(rng.integers(20, 120))):
            w = int(follow[w, rng.integers(3)]) if rng.random() < 0.9 else int(rng.integers(300))
            words.append(f"W{w}")
        rows.append((d, " ".join(words)))
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "unseenword " * 3), (None, "w1 w2"), (904, "w5 " * 70_000), (12, rows[12][1])]


def test_base_and_gain(spark, corpus, monkeypatch):
    monkeypatch.setattr(mixing, "HEAD", 250)
    monkeypatch.setattr(mixing, "TABLE_BITS", 16)
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in corpus], SCHEMA).repartition(3)
    out = mixing.score(docs).collect()
    held = lambda d: zlib.crc32(str(d if d is not None else "").encode()) % 10 == 0
    counts = Counter()
    for d, t in corpus:
        if not held(d):
            counts.update([*(t or "").lower().split(), None])
    total = sum(counts.values())
    texts = dict(corpus)
    assert len(out) == len(corpus)
    for r in out:
        tokens = [*(texts[r.doc_id] or "").lower().split(), None]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in tokens)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    natural = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(natural) > 20
    assert sum(r.score for r in natural) > 0.9 * sum(r.base_score for r in natural)  # log10: closer to 0 is better


def test_no_documents_and_no_training(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mixing.score(none).count() == 0
    d = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = mixing.score(spark.createDataFrame([(d, "a b", "x", 1)], SCHEMA)).first()
    assert row.held_out and row.n_known == 0 and row.train_tokens == 0 and math.isfinite(row.score) and math.isfinite(row.base_score)


def test_codes_are_prefix_free_and_scores_sum_to_one():
    rng = np.random.default_rng(2)
    head = [("", 50), *((f"w{i}", int(n)) for i, n in enumerate(rng.integers(1, 400, 40)))]
    code = mixing.Code(head, sum(n for _, n in head) + 33)
    codes = ["".join(map(str, code.bits[s : s + n])) for s, n in zip(code.starts, code.lengths)]
    assert not any(a != b and b.startswith(a) for a in codes for b in codes)
    tables = rng.integers(0, 1 << 10, (mixing.CONTEXTS, 1 << mixing.TABLE_BITS)).astype(np.uint16)
    weights, refined = rng.normal(0.2, 0.2, (mixing.GATES, mixing.INPUTS)), rng.normal(0, 2, (mixing.GATES, mixing.CELLS)).astype(np.float32)
    symbols = np.arange(len(codes))
    last, second = np.full(len(codes), 7, np.uint64), np.full(len(codes), 9, np.uint64)
    logs = mixing.token_scores(code, tables, weights, refined, symbols, last, second)
    assert math.isclose(sum(10.0**x for x in logs), 1, rel_tol=1e-4)


def test_chunks_do_not_change_streams(monkeypatch):
    code = mixing.Code([("", 9), ("a", 5), ("b", 3)], 20)
    texts = [(0, [b"a", b"b", b"x"] * 7), (1, []), (2, [b"b"] * 5)]
    whole = [np.concatenate(x) for x in zip(*mixing._streams(code, iter(texts)))]
    monkeypatch.setattr(mixing, "CHUNK", 3)
    parts = [np.concatenate(x) for x in zip(*mixing._streams(code, iter(texts)))]
    assert all((x == y).all() for x, y in zip(whole, parts))


def test_words_of_chunks_are_looked_up_together(monkeypatch):
    """Contexts do not reach over the start of a text, but over chunks and groups of chunks; escaped words
    come along; what is said by tables of products is what the mixer says."""
    code = mixing.Code([("", 9), ("a", 5), ("b", 3)], 20)
    rng = random.Random(1)
    texts = [(k, [rng.choice([b"a", b"b", b"x", b"yy"]) for _ in range(rng.choice([0, 1, 2, 5, 6, 7, 40]))]) for k in range(60)]
    name = {w: k for k, w in enumerate([b"", b"a", b"b"])}
    hash_of = lambda w: code.hashes[name[w]] if w in name else np.uint64(mixing._word_hashes()[w])
    want = [(k, name.get(w, 3), p, q) for k, x in texts for w, p, q in zip([*x, b""], [mixing.START_HASH, *map(hash_of, x)], [mixing.START_HASH] * 2 + [hash_of(w) for w in x])]
    for chunk, together in ((1 << 16, 8), (6, 1), (6, 3), (2, 2)):
        monkeypatch.setattr(mixing, "CHUNK", chunk)
        monkeypatch.setattr(mixing, "TOGETHER", together)
        chunks = list(mixing._chunks(code, iter(texts)))
        assert [r for c in chunks for r in zip(*(x.tolist() for x in c[:4]))] == want
        assert [w for c in chunks for w in c[4].to_pylist()] == [w for _, x in texts for w in x if w not in name]
    tables = np.random.default_rng(2).integers(0, 1 << 10, (mixing.CONTEXTS, 1 << mixing.TABLE_BITS)).astype(np.uint16)
    weights = np.random.default_rng(3).normal(0.2, 0.2, (mixing.GATES, mixing.INPUTS))
    which, symbols, last, second = (np.concatenate(x) for x in zip(*(c[:4] for c in chunks)))
    node, _, gate, entries, _ = mixing._entries(code, tables, symbols, last, second)
    _, gates, x = mixing._inputs(code, tables, symbols, last, second)
    assert (gate == gates).all() and (mixing._said(code, node, gate, entries, weights) == mixing._mixed(x, gate, weights)).all()


def test_scores_do_not_depend_on_partitions(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randint(5, 80)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, many = ({r.doc_id: r.score for r in mixing.score(docs.repartition(n)).collect()} for n in (1, 7))
    assert one.keys() == many.keys() and all(abs(one[i] - many[i]) <= 1e-6 * abs(one[i]) for i in one)


def test_context_tables_read_every_text_once(spark, monkeypatch, tmp_path):
    read, words_of = tmp_path / "read", mixing.words_of

    def noted(text):
        with open(read, "a") as f:
            f.write("x\n")
        return words_of(text)

    monkeypatch.setattr(mixing, "words_of", noted)
    monkeypatch.setattr(mixing, "TABLE_BITS", 16)
    docs = spark.createDataFrame([(i, f"a{i % 7} b c") for i in range(60)], "doc_id long, text string").repartition(3)
    mixing.context_tables(docs, mixing.Code([("", 60), ("b", 60), ("c", 60)], 240))
    assert len(read.read_text().split()) == 60

"""The manifest against hashlib and plain lists."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos int, section string, leaf string, digest string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def up(levels, at, digest):
    proof = []
    for level in levels[:-1]:
        run = level[at // 8 * 8 : at // 8 * 8 + 8]
        slot = at % 8
        proof += run[:slot] + run[slot + 1 :]
        digest = h(*run[:slot], digest, *run[slot + 1 :])
        at //= 8
    return digest, proof


def brute(rows, tampered):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r, r[1]), leaf_of(r, tampered(r)), r[0]))
    trees, tops = {}, []
    for lang in sorted(by, key=lambda x: (x is not None, (x or "").encode())):
        by[lang].sort(key=lambda r: r[:3])
        trees[lang] = tree([r[2] for r in by[lang]])
        tops.append(trees[lang][-1][0])
    root = tree(tops)
    out = []
    for k, (lang, levels) in enumerate(trees.items()):
        for i, (_, _, leaf, changed, doc_id) in enumerate(by[lang]):
            folded, proof = up(levels, i, changed)
            folded, more = up(root, k, folded)
            out.append((doc_id, leaf, levels[-1][0], root[-1][0], h(*proof, *more), folded, folded == root[-1][0]))
    return sorted(out, key=repr)


def tampered(r):
    return r[1].lower() if None not in r[:2] and zlib.crc32(str(r[0]).encode()) % 3 == 0 else r[1]


def verified(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "s", "l", "d") for r in rows], SCHEMA).repartition(3)
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    return sorted(map(tuple, merkle.verify(merkle.manifest_of(docs, changed={"text": text})).collect()), key=repr)


def documents(n, langs, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["Some Text", "no capitals", "", None, "Ünï " * 50, "Long " * 3000]), rng.choice(langs), rng.choice(["a", None]), rng.choice([i, None])) for i in rng.sample(range(10**6), n)]
    return rows + [(None, "No Id", langs[0], None, None), (None, "No Id", langs[0], None, None), rows[0], (rows[0][0], "Another Text", rows[0][2], "a", 1)]


@pytest.mark.parametrize("n", [0, 1, 55, 56, 64, 119])
def test_block_function(n):
    """Digests of whole messages of letters, and the states on the way."""
    data = np.random.default_rng(n).integers(0, 256, (n, 32), dtype=np.uint8)
    if n:
        p = merkle.parents(data)
        want = [hashlib.sha256("".join(bytes(d).hex() for d in data[i : i + 8]).encode()).digest() for i in range(0, n, 8)]
        assert [d.tobytes() for d in p.digests] == want
        slots = np.arange(n) % 8
        new = np.roll(data, 1, 0)
        folded = merkle.resume(new, slots, p, np.arange(n) // 8)
        for i in range(n):
            run = [bytes(d).hex() for d in data[i // 8 * 8 : i // 8 * 8 + 8]]
            run[i % 8] = bytes(new[i]).hex()
            assert folded[i].tobytes() == hashlib.sha256("".join(run).encode()).digest()


def test_left_siblings_are_not_read():
    data = np.random.default_rng(1).integers(0, 256, (8, 32), dtype=np.uint8)
    p = merkle.parents(data)
    p.children[0, :5] = 0
    assert merkle.resume(data[5:6], np.array([5]), p, np.array([0]))[0].tobytes() == p.digests[0].tobytes()


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_proofs_against_lists(spark, monkeypatch, levels):
    """Blocks of one, two and four levels give the same trees; a hot section, a null one, small ones."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = documents(700, ["en"] * 20 + [None, "de", "é", "Z", "a1", "a2", "a3", "a4", "a5", "a6"]) + [(7, "Alone", "zz", None, 1)]
    assert verified(spark, rows) == brute(rows, tampered)


@pytest.mark.parametrize("rows", [[], [(1, "One", None, None, None)], [(i, "Text", "en", None, 1) for i in range(9)], [(3, "Same", "en", "a", 1)] * 17])
def test_small_tables(spark, rows):
    assert verified(spark, rows) == brute(rows, tampered)


def test_the_manifest_keeps_a_state_before_each_child(spark):
    manifest = merkle.manifest_of(spark.createDataFrame([(i, "t", "en", None, 1) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long"))
    nodes = {(r.level, r.node): r for r in manifest.nodes.collect()}
    assert set(nodes) == {(1, 0), (1, 1), (1, 2), (2, 0)}
    for r in nodes.values():
        assert len(r.states) == len(r.children) == 32 * r.size
        assert r.states[:32] == merkle.START.astype(">u4").tobytes()

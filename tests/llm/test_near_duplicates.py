"""Groups, MinHash near copies and line dedup against brute force over all pairs."""

import math
import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.llm import groups, lines, minhash

SCHEMA = "doc_id long, text string, label string, component_id string, set1 int, key int"


def prose(rng, n, words=4000):
    return [f"w{rng.randint(0, words)}" for _ in range(n)]


def components(ids, links):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_connected_labels(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(rng.randint(100, 200), rng.randint(100, 200)) for _ in range(60)] + [(500, 300), (500, 300), (7, 7)]
    out = {r.id: r.label for r in groups.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {x for e in edges for x in e}
    assert out == components(ids, edges)


@pytest.mark.parametrize("few", [0, 1000])
def test_labels_are_carried_on(spark, monkeypatch, few):
    """Edges that come later join groups by their labels, as if all edges were given at once."""
    monkeypatch.setattr(groups, "FEW_LABELS", few)
    rng, labels, edges, ids = random.Random(5), None, [], set()
    for n in (40, 30, 1, 25):
        new = [(x, x - rng.randint(1, 60)) for x in (rng.randint(61, 200) for _ in range(n))] + [(500, 499)]
        edges += new
        ids |= {x for e in new for x in e}
        was, labels = labels, groups.connected(spark.createDataFrame(new, "a long, b long"), labels)
        out = [(r.id, r.label) for r in labels.collect()]
        assert len(out) == len(ids) and dict(out) == components(ids, edges)
        if was is not None:
            assert groups._groups_joined(was, labels) == len(set(components(ids, edges[: -len(new)]).values())) - len(set(dict(out).values()))


def test_linked_checks_pairs_of_different_groups_only(spark):
    """One key for all ids; ids are linked if they are neighbours, or in a block of twenty."""
    true = {(b, a) for a, b in combinations(range(60), 2) if a // 20 == b // 20 or (a, b) in ((19, 20), (45, 59))}
    asked = []

    def verify(pairs):
        rows = [(r.a, r.b) for r in pairs.collect()]
        asked.extend(rows)
        return spark.createDataFrame([p for p in rows if p in true], "a long, b long")

    keys = spark.createDataFrame([(1, i) for i in range(60)] + [(2, 99)], "key long, id long")
    traits = spark.createDataFrame([(i,) for i in range(100)], "id long")
    from pyspark.sql import functions as F

    out = {r.id: r.label for r in groups.linked(keys, traits, lambda x, y: F.lit(True), verify).collect()}
    want = components(range(60), true)
    assert {i: out.get(i, i) for i in range(60)} == want
    assert len(asked) == len(set(asked))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows = [(i, " ".join(prose(rng, rng.randint(20, 200)))) for i in range(120)]
    base = prose(rng, 150)
    for k in range(40):  # a large group of near copies, chained by few changes each
        words = list(base)
        for _ in range(k // 6):
            words[rng.randrange(150)] = f"n{rng.randint(0, 9999)}"
        rows.append((200 + k, " ".join(words)))
    passage = " ".join(prose(rng, 60))
    rows += [(300 + k, passage + " " + " ".join(prose(rng, 60))) for k in range(40)]  # alike, not near
    rows += [(400 + k, rows[3][1]) for k in range(30)]  # exact copies
    rows += [(500, rows[7][1].upper()), (501, rows[7][1].replace(" ", "\n\t ")), (502, "one two"), (503, "ONE\x0btwo"), (504, "one two three"), (505, ""), (506, None), (507, " \n")]
    rows += [(508, rows[9][1]), (508, rows[9][1]), (None, rows[9][1]), (509, " ".join(prose(rng, 30_000)))]
    return rows


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(spark, corpus, size):
    docs = spark.createDataFrame([(i, t, "l", "c", 1, 2) for i, t in corpus], SCHEMA).repartition(5)
    out = minhash.near_duplicates(docs, size).collect()
    sets = {i: shingles(t, size) for i, t in corpus if i is not None}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components(sets, links)
    assert len(out) == len(corpus)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id), r.doc_id
    kept = minhash.first_of_groups(docs, size)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted((i or -1) if i is None or want[i] == i else -2 for i, _ in corpus if i is None or want[i] == i)


def near_copies(rng, n, replaced):
    """Texts of 300 words, each the base with some words replaced: 6 give a mean similarity of 0.74, 3 of 0.85."""
    base = prose(rng, 300)
    for _ in range(n):
        words = list(base)
        for _ in range(replaced):
            words[rng.randrange(300)] = f"n{rng.randint(0, 99_999)}"
        yield " ".join(words)


def test_pairs_of_a_crowd(spark, monkeypatch):
    """Near copies of one text around the threshold: components of brute force. Pairs grow in proportion
    to copies that link; those that mostly do not still make some of all pairs."""
    made, plain = [], groups.written

    def counted(df, name):
        out = plain(df, name)
        if name == "pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(groups, "written", counted)
    asked = {}
    for n, replaced in ((200, 3), (600, 3), (200, 6)):
        rows = list(enumerate(near_copies(random.Random(n), n, replaced)))
        made.clear()
        docs = spark.createDataFrame([(i, t, "l", "c", 1, 2) for i, t in rows], SCHEMA)
        out = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 4).collect()}
        sets = {i: shingles(t, 4) for i, t in rows}
        links = [(a, b) for (a, x), (b, y) in combinations(sets.items(), 2) if 100 * len(x & y) >= 80 * len(x | y)]
        want = components(sets, links)
        assert sum(out[i] != want[i] for i in sets) <= 0.01 * n
        asked[n, replaced] = sum(made)
    assert asked[600, 3] <= 4 * asked[200, 3] <= 4 * 10 * 200
    assert asked[200, 6] <= 0.5 * 200 * 199 / 2


def test_crowd_pairs_lose_no_link(spark):
    """Every component of a crowd's links can be built from its pairs, whatever the labels."""
    rng = random.Random(3)
    texts = [*near_copies(rng, 80, 4), *near_copies(rng, 40, 5), "", None, "one", " ".join(prose(rng, 2000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    members = spark.createDataFrame([(1, i, i // 2) for i in range(len(texts))] + [(2, i, i) for i in range(0, len(texts), 3)], "crowd long, id long, label long")
    got = {(max(r), min(r)) for r in minhash.crowd_pairs(docs, 4, 80)(members).collect()}
    sets = {i: shingles(t, 4) for i, t in enumerate(texts)}
    links = {(b, a) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    same = [(i, i + 1) for i in range(0, len(texts) - 1, 2)]
    assert components(sets, [*same, *(got & links)]) == components(sets, [*same, *links])


def test_no_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert minhash.near_duplicates(none).count() == 0 and minhash.first_of_groups(none).count() == 0
    assert lines.dedup_lines(none).count() == 0


def test_tables_meet_as_their_hashes_do():
    a = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64))
    assert (minhash.minwise(a) == [((a * m + o) >> np.uint64(32)).min() for m, o in zip(minhash.MULTIPLIERS, minhash.OFFSETS)]).all()
    many = np.arange(200_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert len(minhash.minwise(many)) == 8 * minhash.HALVES


def normal(line):
    return " ".join(w for w in re.split(r"[^\w]+|_", line.lower()) if w)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_dedup(docs):
    """Exact classes of lines and verified near ones within three bits are left to the operator; here all copies."""
    first = {}
    for doc_id, text in sorted((x for x in docs if x[0] is not None and x[1] is not None), key=lambda x: x[0]):
        for pos, line in enumerate(text.split("\n")):
            if len(normal(line).split()) >= 5:
                first.setdefault(normal(line), (doc_id, pos))
    return first


def test_copies_of_lines_go(spark):
    rng = random.Random(8)
    shared = "This very line stands in many documents of the corpus!"
    rows = [(i, "\n".join([" ".join(prose(rng, 12)), shared if i % 3 else shared.upper(), "Short one.", " ".join(prose(rng, 9))])) for i in range(1, 60)]
    rows += [(70, shared + "\n" + shared), (71, ""), (72, None), (73, "\n\n"), (74, rows[4][1]), (74, rows[4][1]), (None, rows[5][1]), (75, " ".join(prose(rng, 40_000))), (0, "x\n" + shared + "\r\ntail")]
    docs = spark.createDataFrame([(i, t, "l", "c", 1, 2) for i, t in rows], SCHEMA).repartition(4)
    out = lines.dedup_lines(docs)
    assert out.columns == [*docs.columns, "lines_removed"]
    first = plain_dedup(rows)
    got = sorted(((r.doc_id, r.text, r.lines_removed) for r in out.collect()), key=str)
    want = []
    for doc_id, text in rows:
        if text is None:
            want.append((doc_id, None, 0))
            continue
        parts = text.split("\n")
        kept = [x for p, x in enumerate(parts) if normal(x) not in first or first[normal(x)] == (doc_id, p)]
        want.append((doc_id, "\n".join(kept), len(parts) - len(kept)))
    assert got == sorted(want, key=str)


def test_near_lines_go_and_others_stay(spark):
    rng = random.Random(9)
    words = prose(rng, 120)
    near = [" ".join([*words[:-1], f"end{k}"]) for k in range(30)]
    other = [" ".join(prose(rng, 120)) for _ in range(30)]
    docs = spark.createDataFrame([(k, near[k] + "\n" + other[k], "l", "c", 1, 2) for k in range(30)], SCHEMA)
    found = {r.doc_id: r.text.split("\n") for r in lines.dedup_lines(docs).collect()}
    assert all(found[k][-1] == other[k] for k in range(30)) and found[0] == [near[0], other[0]]
    left = [x for k in range(1, 30) for x in found[k] if x in near]
    # SimHash at two bits of 60 finds most, not all, lines that differ in one word of 120.
    assert len(left) <= 12
    assert all(distance(normal(a), normal(near[0])) <= 10 for a in left)


def test_simhash_is_the_majority_of_bits(spark):
    rng = random.Random(4)
    rows = [(k, [rng.getrandbits(64) - (1 << 63) for _ in range(n)] * 2) for k, n in enumerate((1, 2, 5, 24, 25, 3000))]
    out = {r.id: r.sim for r in lines.with_simhash(spark.createDataFrame(rows, "id int, hashes array<long>")).collect()}
    for k, hashes in rows:
        taken = sorted(set(hashes))[: lines.FEATURES]
        want = sum((2 * sum((h % (1 << 64)) >> b & 1 for h in taken) > len(taken)) << b for b in range(60))
        assert out[k] == want, k


def test_near_lines_meet_at_any_length_and_edit(spark):
    """One original line and its edited copy per length and kind of edit: what brute force finds goes."""
    rng = random.Random(11)
    common = [f"c{i}" for i in range(30)]
    pairs = []
    for n in (5, 9, 10, 15, 20, 30, 60, 120, 200):
        for most in {1, max(1, n // 10), n // 5}:
            for kind in ("replace", "insert", "delete", "spread"):
                for _ in range(2):
                    a = [rng.choice(common) if rng.random() < 0.4 else f"w{rng.randint(0, 20_000)}" for _ in range(n)]
                    b = list(a)
                    for k in range(most):
                        at = (k * 5 + 2) % n if kind == "spread" else rng.randrange(len(b))
                        if kind in ("replace", "spread"):
                            b[at] = f"n{rng.randint(0, 99_999)}"
                        elif kind == "insert":
                            b.insert(at, f"n{rng.randint(0, 99_999)}")
                        else:
                            del b[at]
                    pairs.append((n, " ".join(a), " ".join(b)))
    rows = [x for k, (_, a, b) in enumerate(pairs) for x in ((2 * k, a), (2 * k + 1, b))]
    docs = spark.createDataFrame([(i, t, "l", "c", 1, 2) for i, t in rows], SCHEMA)
    gone = {r.doc_id for r in lines.dedup_lines(docs).collect() if r.lines_removed}
    assert not any(i % 2 == 0 for i in gone)
    near = {2 * k + 1: n for k, (n, a, b) in enumerate(pairs) if len(b.split()) >= 5 and distance(a.split(), b.split()) <= max(len(a.split()), len(b.split())) // 5}
    assert gone <= set(near)
    for n in {*near.values()}:
        asked = [i for i in near if near[i] == n]
        assert sum(i in gone for i in asked) >= 0.95 * len(asked), n


def test_near_lines_of_one_word_go(spark):
    """The bound of test_near_lines_go_and_others_stay before its band was narrowed."""
    rng = random.Random(9)
    words = prose(rng, 120)
    docs = spark.createDataFrame([(k, " ".join([*words[:-1], f"end{k}"]), "l", "c", 1, 2) for k in range(30)], SCHEMA)
    assert sum(r.lines_removed == 0 for r in lines.dedup_lines(docs).collect()) <= 6


def test_lines_below_the_similarity_stay(spark):
    """Six words, two of them replaced: hashed characters of words alone would take some for near."""
    rng = random.Random(12)
    rows = []
    for k in range(1000):
        words = [f"w{k}x{i}" for i in range(6)]
        at = rng.sample(range(6), 2)
        rows += [(2 * k, " ".join(words), "l", "c", 1, 2), (2 * k + 1, " ".join(f"n{k}x{i}" if i in at else w for i, w in enumerate(words)), "l", "c", 1, 2)]
    assert lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).filter("lines_removed > 0").count() == 0


def test_joint_codes_count_words(spark):
    a, b = [f"w{i}" for i in range(60_000)], [f"w{i}" for i in range(60_000) if i % 20_000] + ["x", "y"]
    from pyspark.sql import functions as F

    pair = spark.createDataFrame([(a[:700], b[:700]), (a[:3], ["w0", "w2", "z"])], "wa array<string>, wb array<string>").withColumn("joint", F.array_distinct(F.concat("wa", "wb")))
    got = pair.select(F.levenshtein(lines.joint_code(F.col("wa"), F.col("joint")), lines.joint_code(F.col("wb"), F.col("joint"))).alias("d")).collect()
    assert [r.d for r in got] == [2, 2]


def test_word_pairs_are_counted_in_all_documents(spark):
    """Also beyond the 8,000 documents of which a part was counted once."""
    docs = spark.range(9_000).select(F.col("id").alias("doc_id"), F.col("id").alias("text_hash"), F.when(F.col("id") == 5, "v w x y z").otherwise("a b c d e").alias("text"))
    found = docs.select(lines.pair_levels(docs, 5).alias("levels")).first().levels
    want = bytearray(lines.BUCKETS)
    for line, n in (("a b c d e", 8_999), ("v w x y z", 1)):
        hashes = spark.range(1).select(lines.word_pairs(F.transform(F.split(F.lit(line), " "), lambda w: F.xxhash64(w))).alias("h")).first().h
        for pair in hashes:
            want[pair & (lines.BUCKETS - 1)] = 1 + int(2 * math.log2(n))
    assert bytes(found) == bytes(want)

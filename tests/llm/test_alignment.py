"""Alignment against a brute-force version, and the cut pieces against the tokenizers themselves."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skygrid.llm import alignment, tokens


@pytest.fixture(scope="module")
def both():
    return alignment.Pair(tokens.default_tokenizer(), alignment.default_pieces())


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokens.default_tokenizer())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.default_pieces())


TEXTS = [
    "a", " a", "a ", "a  b", "  two  spaces  ", "don't 'll", "line\nnext \n\n x", "naïve café 12345", "中文 日本語", "🙂 🙃", "a </s> <s> <|endoftext|> <0x0A> b",
    "under▁score", "tab\tand\x00nul", "word " * 300, "unaffordability antidisestablishmentarianism", " em space ", "\n", " ",
]


def plain(library, text):
    """Bytes of every token, by the libraries on the whole text."""
    a, b = library
    from skygrid.llm.bpe import byte_alphabet

    alphabet = byte_alphabet()
    if not text:
        return [], []
    a_tokens = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    b_tokens = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
    whole = (" " + text).encode()
    if any(b"".join(x for _, x in t) != whole for t in (a_tokens, b_tokens)):
        return [], []
    return a_tokens, b_tokens


def ids_of(both, text):
    """All ids by both, read from the groups."""
    both.learn([text])
    groups, _, counts = both.document(text)
    sides = [[], []]
    for group in groups.split(";") if groups else []:
        for side, ids in zip(sides, group.split("|")):
            side += map(int, ids.split(","))
    assert [len(s) for s in sides] == counts[:2].tolist()
    return sides


def brute(library, texts):
    """Row by row: (n_a, n_b, n_groups, n_links, n_group_links, groups, n_best, count_sum)."""
    out, held = [], Counter()
    for text in texts:
        ranges = []
        for side in plain(library, text):
            at, spans = 0, []
            for i, x in side:
                spans.append((i, at, at + len(x)))
                at += len(x)
            ranges.append(spans)
        a, b = ranges
        links = [(i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f)]
        groups, x, y = [], [], []
        ends = {e for _, _, e in a} & {f for _, _, f in b}
        for end in sorted(ends):
            x = [i for i, _, e in a if e <= end][sum(len(g[0]) for g in groups) :]
            y = [j for j, _, f in b if f <= end][sum(len(g[1]) for g in groups) :]
            groups.append((x, y))
        held.update(set(links))
        out.append((len(a), len(b), len(groups), links, sum(len(x) * len(y) for x, y in groups), ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(most.get(i, 0), n)
    return [(*r[:3], len(r[3]), *r[4:], sum(held[p] == most[p[0]] for p in r[3]), sum(held[p] for p in r[3])) for r in out]


@pytest.mark.parametrize("text", TEXTS)
def test_pieces_are_the_librarys_tokens(both, library, text):
    assert ids_of(both, text) == [[i for i, _ in side] for side in plain(library, text)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \n\t'é中🙂.1 <s>/▁"), max_size=40))
def test_any_text(both, library, text):
    assert ids_of(both, text) == [[i for i, _ in side] for side in plain(library, text)]


def test_products_are_matrix_products():
    rng = np.random.default_rng(2)
    for _ in range(30):
        x, y = (rng.random((rng.integers(1, 9), 7)) < 0.3).astype(int), (rng.random((7, rng.integers(1, 9))) < 0.3).astype(int)
        rows = [alignment.Rows(np.concatenate(([0], np.cumsum(m.sum(1)))), np.nonzero(m)[1], m.shape[1]) for m in (x, y)]
        i, j, v = alignment.row_products(*rows)
        out = np.zeros((x.shape[0], y.shape[1]), int)
        out[i, j] = v
        assert (out == x @ y).all()
        back = rows[0].transposed()
        assert back.columns.tolist() == np.nonzero(x.T)[1].tolist() and np.diff(back.starts).tolist() == x.T.sum(1).tolist()


def test_group_links_are_all_pairs_of_a_group():
    by = alignment.align(np.array([2, 3, 7, 9]), np.array([1, 3, 4, 5, 9]))
    i, j = by.group_links()
    assert set(zip(i.tolist(), j.tolist())) == {(0, 0), (0, 1), (1, 0), (1, 1)} | {(x, y) for x in (2, 3) for y in (2, 3, 4)}
    assert by.group_sizes().tolist() == [2, 2, 3, 3] and by.n_groups == 2
    assert list(zip(by.a_linked, by.b_linked, by.common_bytes)) == [(0, 0, 1), (0, 1, 1), (1, 1, 1), (2, 2, 1), (2, 3, 1), (2, 4, 2), (3, 4, 2)]


def test_a_table_against_brute_force(spark, library, monkeypatch):
    texts = [*TEXTS, None, "", "the same text again", "the same text again", "another text", "the text " * 30]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, chunk string, n_a int").repartition(3)
    want = {i: r for i, r in enumerate(brute(library, texts))}
    rows = alignment.alignments(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_group_links, r.groups, r.n_best, r.count_sum)
        assert got == want[r.doc_id], texts[r.doc_id]
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "")


def test_small_chunks_change_nothing(spark, monkeypatch):
    """Many chunks give the rows of one."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(150)
    one = sorted(map(tuple, alignment.alignments(docs, spelled=False).collect()), key=lambda r: r[0])
    monkeypatch.setattr(alignment, "CHUNK_ENTRIES", 500)
    many = sorted(map(tuple, alignment.alignments(docs.repartition(4), spelled=False).collect()), key=lambda r: r[0])
    assert one == many


def test_no_rows_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert alignment.alignments(spark.createDataFrame([], schema)).count() == 0
    rows = alignment.alignments(spark.createDataFrame([(None, "one text"), (None, None)], schema)).collect()
    assert sorted((r.doc_id, r.n_a, r.count_sum) for r in rows) == [(None, 0, 0), (None, 2, 2)]

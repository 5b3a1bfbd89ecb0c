"""Speculative encoding against the tokenizers library and against plain merging."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skygrid.llm import bpe, tokens

PATH = tokens.default_tokenizer()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH)


def unpacked(encoded):
    return [np.frombuffer(x, "<u4").tolist() for x in encoded]


def ids_of(codec, text):
    return unpacked(codec.encode([text]))[0]


TEXTS = [
    "", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "\n \n", "x  y", "don't 'll  's", "\t",
    "ab  cd ef", "naïve café 12345 !!! $$$", "中文 日本語 한국어", "🙂🙃" * 5, "aaaaaaaaaaaaaaaaaaaaa", "= = ======================",
    "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|", " <|endoftext|>  x", "\x00\x01\x7f", "supercalifragilisticexpialidocious " * 50,
]


@pytest.mark.parametrize("text", TEXTS)
def test_the_librarys_ids_and_text(codec, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert ids_of(codec, text) == want
    assert codec.decode(want) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(codec, library, text):
    assert ids_of(codec, text) == library.encode(text, add_special_tokens=False).ids


def test_words_of_joined_tokens(codec, library):
    """Words made of vocabulary pieces are where greedy cuts fail most."""
    rng = random.Random(5)
    letters = [b.decode() for b in codec.merges.tokens.values() if b.isalpha() and b.isascii()]
    words = ["".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(3000)]
    encoded = unpacked(codec.merges.encode([w.encode() for w in words]))
    assert encoded == [library.encode(w, add_special_tokens=False).ids for w in words]
    failed = sum(codec.merges.propose([w.encode()])[1].tolist() != ids for w, ids in zip(words, encoded))
    assert 0 < failed < len(words)


def test_proposals_are_the_longest_tokens(codec):
    rng = random.Random(6)
    words = [bytes(rng.choices(b"abcdeinrst =\xc3\xa9", k=rng.randint(1, 30))) for _ in range(500)]
    owner, ids = codec.merges.propose(words)
    for w, word in enumerate(words):
        at = 0
        for i in ids[owner == w].tolist():
            longest = max((n for n in range(1, len(word) - at + 1) if word[at : at + n] in codec.merges.whole))
            assert codec.merges.tokens[i] == word[at : at + longest]
            at += longest
        assert at == len(word)


def test_long_words_are_merged_alike(codec):
    rng = random.Random(7)
    for n in (2, 30, 90):
        word = bytes(rng.choices(b"abcdeinrst", k=n))
        assert codec.merges.merge(word) == codec.merges._merge_long(word)


def test_every_token_alone(codec, library):
    """``whole`` holds just the tokens that encode to themselves."""
    for b, i in list(codec.merges.ids.items())[::7]:
        assert (b in codec.merges.whole) == (codec.merges.merge(b) == [i])


def test_pairs_fit_just_where_merging_keeps_them():
    """All pairs of a small vocabulary with repeats, against merging itself."""
    merges = [(b"a", b"a"), (b"a", b"b"), (b"aa", b"a"), (b"b", b"a"), (b"ab", b"ab"), (b"aa", b"aa"), (b"ba", b"b"), (b"aaa", b"ab")]
    tokens_ = {97: b"a", 98: b"b"} | {200 + i: a + b for i, (a, b) in enumerate(merges)}
    m = bpe.Merges(tokens_, merges)
    assert m.ordered
    for x, i in m.whole.items():
        for y, j in m.whole.items():
            assert m.compatible(np.array([i]), np.array([j]))[0] == (m.merge(x + y) == [i, j]), (x, y)
    rng = random.Random(1)
    words = [bytes(rng.choices(b"ab", k=rng.randint(1, 14))) for _ in range(4000)]
    assert unpacked(m.encode(words)) == [m.merge(w) for w in words]


def test_a_vocabulary_out_of_order_is_merged():
    m = bpe.Merges({97: b"a", 98: b"b", 1: b"ab", 2: b"aba", 3: b"ba"}, [(b"ab", b"a"), (b"a", b"b"), (b"b", b"a")])
    assert not m.ordered and unpacked(m.encode([b"aba", b"ba"])) == [[2], [3]]


ROWS = [(1, "Hello  world <|endoftext|> ok", "x", 1), (2, None, None, None), (3, "", "y", 2), (None, "no id", "z", 3), (4, "é中文 " + "word " * 20000, "z", 4), (1, "Hello  world <|endoftext|> ok", "x", 1)]


def test_round_trip_of_a_table(spark, library):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, ids string, n_tokens int").repartition(3)
    encoded = bpe.encode(docs, PATH)
    want = sorted(((i or -1), tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in ROWS)
    assert sorted(((r.doc_id or -1), tuple(r.ids)) for r in encoded.collect()) == want
    assert sorted(((r.doc_id or -1), r.text) for r in bpe.decode(encoded, PATH).collect()) == sorted(((i or -1), t or "") for i, t, *_ in ROWS)
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(encoded, PATH).collect()}
    assert digests == {
        (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        for i, t, *_ in ROWS
        for ids in [library.encode(t or "", add_special_tokens=False).ids]
    }


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(bpe.encode(none, PATH), PATH).count() == 0

"""Token files and packing against the tokenizer itself, and their corner cases."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from skygrid.llm import packing, tokens

SCHEMA = "doc_id long, text string, shard string, tokens int"
ROWS = [
    (5, "Hello  world, it's 12 o'clock.\n\nNew line\tand tab ", "x", 1),
    (3, None, None, None),
    (9, "", "y", 2),
    (3, "again the same id", "z", 3),
    (None, "no id at all", "z", 3),
    (7, "word " * 3000 + "é中文 <|endoftext|> \u2003 end", "z", 4),
    (8, "\n \n leading", "z", 4),
    (8, "\n \n leading", "z", 4),
]


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(tokens.default_tokenizer())
    out.encode_special_tokens = True
    return out


def ids_of(model, text):
    return model.encode(text or "", add_special_tokens=False).ids + [tokens.END_ID]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "a\n \nb", "x\u00a0 y", "don't 'll  's", "\t", "ab\u2003\u2003cd ef", "naïve café 12345 !!! $$$"])
def test_pieces_are_the_tokenizers_ids(model, text):
    got = np.frombuffer(tokens.Encoder(tokens.default_tokenizer()).encode(text), "<u4").tolist()
    assert got == ids_of(model, text)[:-1]


def test_files_hold_every_document_in_order(spark, tmp_path, model):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    path = str(tmp_path / "tokens")
    tokens.write_tokens(docs, path, tokens.default_tokenizer())
    back = tokens.read_tokens(spark, path)
    rows = sorted(back.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 3, 3, 5, 7, 8, 8, 9]
    start = 0
    for r in rows:
        assert r.start == start and r.n_tokens == len(r.tokens)
        start += r.n_tokens
    want = sorted((i or -1, tuple(ids_of(model, t))) for i, t, *_ in ROWS)
    assert sorted((r.doc_id or -1, tuple(r.tokens)) for r in rows) == want
    digests = {(r.start, r.ids_crc32, r.n_tokens) for r in tokens.with_crc(back).collect()}
    assert digests == {(r.start, crc(r.tokens), r.n_tokens) for r in rows}


def test_lengths_alone_skip_the_ids(spark, tmp_path):
    path = str(tmp_path / "tokens")
    tokens.write_tokens(spark.createDataFrame(ROWS, SCHEMA), path, tokens.default_tokenizer())
    plan = spark.read.schema(tokens.FILE_SCHEMA).parquet(path).filter("doc_id = 7").select("n_tokens")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan and "EqualTo(doc_id,7)" in plan


def test_no_documents(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    tokens.write_tokens(none, str(tmp_path / "t"), tokens.default_tokenizer())
    assert tokens.with_crc(tokens.read_tokens(spark, str(tmp_path / "t"))).count() == 0
    assert packing.pack(none, tokens.default_tokenizer()).count() == 0


def test_cut():
    assert packing.cut(0, 10) == []
    assert packing.cut(10, 10) == [(0, 10)]
    assert packing.cut(7, 10) == [(0, 7)]
    assert packing.cut(23, 10) == [(0, 3), (3, 10), (13, 10)]


def test_bins_close_the_fullest_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 5)] == [(0, 0), (1, 0)]
    assert bins.put(4) == (0, 6)  # best fit: the fuller bin
    assert bins.put(7) == (2, 0)
    assert bins.put(9) == (3, 0)  # with one place left it is the fullest itself and closes
    assert bins.put(1) == (2, 7)
    assert bins.open == 2
    assert bins.put(8) == (4, 0)  # bin 2 (two free) ties and closes, or the new one does
    assert bins.open == 2


def test_bins_against_a_plain_search():
    rng = np.random.default_rng(3)
    bins, size, most = packing.OpenBins(64, 5), 64, 5
    free: dict[int, int] = {}
    for n in rng.integers(1, 65, 2000).tolist():
        fits = [f for f in free.values() if f >= n]
        number, offset = bins.put(n)
        if fits:
            assert free[number] == min(fits) and offset == size - min(fits)
        else:
            assert number not in free and offset == 0
            free[number] = size
        free[number] -= n
        if not free[number]:
            del free[number]
        if len(free) > most:
            fullest = min(free.values())
            gone = [k for k, f in free.items() if f == fullest]
            open_now = {k for stack in bins.by_free for k in stack}
            closed = set(free) - open_now
            assert len(closed) == 1 and closed <= set(gone)
            del free[closed.pop()]
        assert {k for stack in bins.by_free for k in stack} == set(free)


def test_sequences_are_gapless_and_whole(spark, model):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(2)
    rows = packing.pack(docs, tokens.default_tokenizer(), size=128).collect()
    sequences, texts = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == crc(r.ids)
        sequences[r.sequence_id].append((r.offset, r.length))
        texts[r.doc_id].append((r.piece, r.start, r.ids))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    whole = [x for _, _, ids in sorted(texts[7]) for x in ids]
    assert whole == ids_of(model, ROWS[5][1])
    assert all(len(ids) == 128 for _, _, ids in sorted(texts[7])[1:])
    total = sum(r.length for r in rows)
    assert len(sequences) <= -(-total // 128) + 2

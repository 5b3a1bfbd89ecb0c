"""The pipeline's stages, whole, and what each decides."""

import random

import __spark_entry__ as entry
import corpus_pipeline
from skygrid.llm import tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def test_stages_decide(spark, tmp_path):
    rng = random.Random(12)
    line = lambda n: " ".join(f"w{rng.randint(0, 3000)}" for _ in range(n))
    text = lambda: "\n".join(line(25) for _ in range(4))
    clean = {i: text() for i in range(60)}
    item = line(30)
    docs = dict(clean)
    docs[100] = "too short"
    docs[101] = " ".join(w + "###" for w in text().split())
    docs[102] = clean[3]  # loses every line to document 3
    docs[103] = clean[4] + "\n" + "\n".join(line(30) for _ in range(3))  # keeps what is its own
    docs[104] = text() + "\n" + item
    words = docs[5].split()  # nearly document 5, cut into lines elsewhere
    words[50] = "changed"
    docs[105] = "\n".join(" ".join(words[i : i + 33]) for i in range(0, 100, 33))
    docs[106] = None
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item), (1, line(30))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    at, left = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    columns = at.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == columns
        path = str(tmp_path / name.replace(" ", "_"))
        at.write.parquet(path)
        at = spark.read.parquet(path)
        left.append({r.doc_id: r for r in at.collect()})
    every = set(docs)
    assert every - set(left[0]) == {100, 101, 106}
    assert every - set(left[1]) == {100, 101, 106, 102}
    assert left[1][103].text.split("\n") == docs[103].split("\n")[4:] and left[1][103].n_chars == len(left[1][103].text)
    assert every - set(left[2]) == {100, 101, 106, 102, 105}
    assert every - set(left[3]) == {100, 101, 106, 102, 105, 104}
    assert all(left[3][i].text == clean[i] for i in clean)

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == set(left[3])
    model = tokens.Encoder(tokens.default_tokenizer())
    assert sum(r.length for r in out) == sum(len(model.encode(r.text)) // 4 + 1 for r in left[3].values())


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = set(entry.queries())
    assert {"pipeline", *(f"op{n}" for n in range(1, 11))} <= {n.split("_")[0] for n in names}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near duplicates", "benchmark decontamination", "best-fit packing"]


def test_short_lines_of_its_own_keep_a_document(spark):
    shared = "this footer stands under many documents"
    verse = "\n".join(f"line {k} of verse" for k in range(30))
    rows = [(1, shared), (2, verse + "\n" + shared), (3, shared + "\n --- \n")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    left = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert left == {1: shared, 2: verse}


CLASHES = ["text_hash", "gone", "gone_id", "gone_hash", "kept", "rejected_by", "leaks", "lines_removed", "label", "places", "pos", "Text"]


def test_columns_of_any_name_come_back_as_given(spark, tmp_path):
    rng = random.Random(13)
    line = lambda n: " ".join(f"w{rng.randint(0, 3000)}" for _ in range(n))
    shared, item = line(25), line(30)
    texts = [line(60) + "\n" + shared for _ in range(6)] + [line(60) + "\n" + item]
    more = ", ".join(f"`{c}` string" for c in CLASHES)
    rows = [(i, t, "en", "s", len(t), *(f"{c} {i}" for c in CLASHES)) for i, t in enumerate(texts)]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        docs = spark.createDataFrame(rows, f"{SCHEMA}, {more}")
        spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.dtypes == docs.dtypes, name
            left = out.collect()
            assert left and all(r[c] == f"{c} {r.doc_id}" for r in left for c in CLASHES), name
        assert corpus_pipeline.best_fit_packing(spark, docs, "").count() >= len(texts)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")

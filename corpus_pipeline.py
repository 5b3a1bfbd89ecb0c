"""The corpus pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's result
to the shared folder and reads it again as the next one's documents. All but the last stage return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.llm import decontam, lines, minhash, packing, quality, tokens
from skygrid.llm.common import apart, written
from skygrid.session import configure

#: The rows are packed sequences of a learned vocabulary's ids; SQL cannot make them.
ORACLE_SQL = None


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def filtering(stage: Stage) -> Stage:
    """A stage that returns its documents' columns: those it does not work on come back as given, whatever
    their names."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        held, columns = apart(docs, ("doc_id", "text", "n_chars"))
        return stage(spark, held, sf_dir).select(*columns)

    return run_stage


@filtering
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects. A null text has no words and goes; repeated rows are judged
    alike; no documents give none."""
    return quality.judge(docs).filter("kept").select(*docs.columns)


@filtering
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that another document keeps.

    A document that loses lines and has no word left held nothing of its own; it goes. All others stay,
    those with short lines only too. Null texts stay null; repeated rows lose the same lines.
    """
    out = lines.dedup_lines(docs)
    own = F.size(lines.words_of(F.col("text"))) > 0
    return out.filter((F.col("lines_removed") == 0) | own).select(*docs.columns)


@filtering
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near copies.

    Shingles of five words, as for all stages; null and empty texts and null ids are in no group and
    stay; all rows of a doc_id that stays stay.
    """
    return minhash.first_of_groups(docs)


@filtering
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark. Null and empty texts hold none; repeated rows are
    judged alike; an empty benchmark takes nothing away."""
    found = decontam.with_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(F.size("leaks") == 0).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places. A null text is empty: its end id alone.
    Repeated rows are packed each."""
    return packing.pack(docs, tokens.default_tokenizer(), with_ids=False)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

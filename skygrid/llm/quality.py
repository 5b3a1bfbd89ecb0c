"""Quality rules (operator 4): a short-circuit cascade in the order a sample recommends.

Every rule says whether it rejects a text. On a sample (``SAMPLE_ROWS`` rows at most, spread over the
table) each rule is timed and its rejections are noted; rules then run by rejections per cost among
the texts that earlier rules let through, and a text stops at its first rejection. The order changes
the cost and ``rejected_by``, never ``kept``.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skygrid.llm.common import BLANKS, LOWER, UPPER, in_batches, rows_of, small_batches

SAMPLE_ROWS = 2_000
SYMBOLS = b"#*$%&|<>"


def n_words(text: bytes) -> int:
    return len(text.split())


def n_symbols(text: bytes) -> int:
    return len(text) - len(text.translate(None, SYMBOLS))


def word_chars(text: bytes) -> int:
    """Code points outside white space."""
    return len(text.translate(None, BLANKS).decode())


def lines(text: bytes) -> list[bytes]:
    """Lines that hold a word."""
    return [x for x in text.split(b"\n") if x.strip()]


def n_dup_lines(text: bytes) -> int:
    found = lines(text)
    return len(found) - len(set(found))


def n_repeat_words(text: bytes) -> int:
    """Words in windows of three that the text holds twice or more, the first time included."""
    words = text.split()
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    count = covered = 0  # words before ``covered`` are counted
    for i, w in enumerate(windows):
        if times[w] > 1:
            count += i + 3 - max(i, covered)
            covered = i + 3
    return count


def _n_of(text: bytes, letters: bytes) -> int:
    return len(text) - len(text.translate(None, letters))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[bytes], bool]


#: The production rules; the first two are the base rules.
RULES = (
    Rule("few_words", lambda t: n_words(t) < 50),
    Rule("repeated_words", lambda t: 100 * n_repeat_words(t) > 50 * n_words(t)),
    Rule("symbols", lambda t: 10 * n_symbols(t) > n_words(t)),
    Rule("capitals", lambda t: _n_of(t, UPPER.encode()) > _n_of(t, LOWER.encode())),
    Rule("repeated_lines", lambda t: 2 * n_dup_lines(t) > len(lines(t))),
    Rule("word_length", lambda t: not 2 * n_words(t) <= word_chars(t) <= 20 * n_words(t)),
)


def measured(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Per text of the sample: nanoseconds and rejection by every rule."""
    small_batches(docs.sparkSession)
    share = min(1.0, sample_rows / max(1, docs.count()))

    def trial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (text,) in rows_of(batches, "text"):
                x, cost, said = (text or "").encode(), [], []
                for rule in rules:
                    t = time.perf_counter_ns()
                    said.append(rule.rejects(x))
                    cost.append(time.perf_counter_ns() - t)
                yield cost, said

        yield from in_batches(rows(), pa.schema([("cost", pa.list_(pa.int64())), ("rejects", pa.list_(pa.bool_()))]))

    sample = docs.select("text").sample(share, seed=4).limit(2 * sample_rows)
    return [r.asDict() for r in sample.mapInArrow(trial, "cost array<long>, rejects array<boolean>").collect()]


def in_order(rules: Sequence[Rule], sample: list[dict]) -> list[Rule]:
    """Greedy: next comes the rule with most rejections per cost among texts not yet rejected."""
    left, rest, out = list(range(len(rules))), sample, []
    while left:

        def worth(k: int) -> tuple[float, int]:
            cost = sum(r["cost"][k] for r in rest) + 1
            return -sum(r["rejects"][k] for r in rest) / cost, cost

        best = min(left, key=worth)
        left.remove(best)
        out.append(rules[best])
        rest = [r for r in rest if not r["rejects"][best]]
    return out


def cascade(text: bytes, rules: Sequence[Rule]) -> str | None:
    """The first rule that rejects the text."""
    return next((r.name for r in rules if r.rejects(text)), None)


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All columns of ``docs`` with kept and rejected_by.

    A null text is empty. Columns of these two names in ``docs`` are replaced. An empty table gives
    an empty one; repeated rows are judged alike.
    """
    ordered = in_order(rules, measured(docs, rules, sample_rows))
    small_batches(docs.sparkSession)
    base = docs.drop("kept", "rejected_by")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = [cascade((t or "").encode(), ordered) for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([s is None for s in said]), pa.array(said, pa.string())], names=[*b.schema.names, "kept", "rejected_by"])

    schema = T.StructType([*base.schema.fields, T.StructField("kept", T.BooleanType()), T.StructField("rejected_by", T.StringType())])
    return base.mapInArrow(task, schema)


COUNTS = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
])


def judge_with_counts(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the base counts, base_failed, and kept: the cascade's verdict on what the base lets pass."""
    ordered = in_order(rules, measured(docs, rules, sample_rows))
    small_batches(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                x = (text or "").encode()
                words, repeated = n_words(x), n_repeat_words(x)
                failed = words < 50 or 100 * repeated > 50 * words
                yield doc_id, words, word_chars(x), n_symbols(x), n_dup_lines(x), repeated, failed, not failed and cascade(x, ordered) is None

        yield from in_batches(rows(), COUNTS)

    ddl = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(task, ddl)

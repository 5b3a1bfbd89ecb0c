"""Benchmark decontamination (operator 10): latent semantic retrieval of leaked passages.

The benchmark is the query set; it is taken in blocks of at most about ``BLOCK_ITEMS`` items. For a
block, over all documents:

1. Passage frequencies of the block's terms give TF-IDF weights. Terms in more than ``MOST_SHARE``
   of the passages carry nothing.
2. A randomised SVD of the passages' TF-IDF rows, with the items' rows weighted so that they count as
   much as the corpus: every task sums A'(A W) for a fixed Gaussian W over its passages, Spark adds
   the sums, and the driver finds the singular vectors of the small matrix (Nystroem).
3. Passages are projected; those whose cosine with an item reaches ``NEAR`` are candidates. Around
   each, the longest common subsequence of words with the item is measured. A leak covers
   ``COVERED`` of the item, or ``PARTLY`` of it with its answer (the last line or sentence) there;
   either way it covers ``PARTLY`` of the item's words that carry weight, since frequent words stand
   in much the same order anywhere.
4. Items with few words that carry weight (made of frequent words, or frequent themselves as they leaked
   into many passages) have next to no vector. Their places are those with ``MET`` of the item's pairs
   of neighbouring words; a leak needs ``SPELLED`` of them in place of words that carry weight. The
   alignment is the same; the cosine of what only this way finds is 0.

Tasks hold the block's term table and singular vectors: sizes that follow the block, not the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrid.llm.common import discard, rows_of, small_batches, written

BLOCK_ITEMS = 400
RANK, OVERSAMPLE = 144, 24
WINDOW, STRIDE = 64, 40
MOST_SHARE = 0.02
LEAST_TERMS = 3
NEAR, COVERED, PARTLY, ANSWERED = 0.4, 0.7, 0.5, 0.7
MIN_ITEM_WORDS = 5
#: Items have few weighted words below ``LEAST_WEIGHTED`` or this share of their words. A text with 0.7 of
#: an item's words, others in place of the rest, has 0.4 of its pairs at least.
LEAST_WEIGHTED, WEIGHTED = 6, 0.25
MET, SPELLED = 0.25, 0.4
ROWS = 64  # terms in a row of a summed matrix

_SPACED = bytes(32 if b < 128 and not chr(b).isalnum() else ord(chr(b).lower()) if b < 128 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words; ASCII punctuation separates."""
    text = text or ""
    return (text if text.isascii() else text.lower()).encode().translate(_SPACED).split()


def answer_of(text: str) -> list[bytes]:
    """The words of the last line, or of the last sentence of a single line."""
    parts = [p for p in (text.split("\n") if "\n" in text.strip() else re.split(r"(?<=[.!?])\s+", text)) if words_of(p)]
    return words_of(parts[-1]) if parts else []


def lcs(item: list[bytes], words: list[bytes]) -> int:
    """Length of the longest common subsequence (bit-parallel)."""
    places: dict[bytes, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in words:
        if m := row & places.get(w, 0):
            row = ((row + m) | (row - m)) & full
    return len(item) - row.bit_count()


class Block:
    """The items of a block with their terms."""

    def __init__(self, items: list[tuple]):
        kept = [(i, words_of(t), answer_of(t or "")) for i, t in items]
        kept = [x for x in kept if len(x[1]) >= MIN_ITEM_WORDS]
        self.ids, self.words, self.answers = [x[0] for x in kept], [x[1] for x in kept], [x[2] for x in kept]
        self.terms = {w: k for k, w in enumerate(sorted({w for x in self.words for w in x}))}

    def term_ids(self, words: Iterable[bytes], n: int) -> np.ndarray:
        """The terms of ``n`` words; -1 for others."""
        return np.fromiter(map(self.terms.get, words, repeat(-1)), np.int32, n)


class Frequent:
    """The items with few words that carry weight, by their pairs of neighbouring words."""

    def __init__(self, block: Block, idf: np.ndarray):
        self.n = len(block.terms)
        self.pairs: dict[int, set[tuple[bytes, bytes]]] = {}
        items, codes = [], []
        for k, words in enumerate(block.words):
            ids = block.term_ids(words, len(words)).astype(np.int64)
            if (idf[ids] > 0).sum() < max(LEAST_WEIGHTED, WEIGHTED * len(words)):
                self.pairs[k] = set(zip(words, words[1:]))
                own = np.unique(ids[:-1] * self.n + ids[1:])
                items.append(np.full(len(own), k))
                codes.append(own)
        both = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        order = np.argsort(both, kind="stable")
        self.codes, self.items = both[order], np.concatenate(items)[order] if items else both
        self.least = np.array([MET * len(self.pairs.get(k, ())) for k in range(len(block.words))])

    def spelled(self, k: int, region: list[bytes]) -> float:
        """The share of item ``k``'s pairs in a region; 0 for items found by their weighted words."""
        pairs = self.pairs.get(k)
        return len(pairs.intersection(zip(region, region[1:]))) / len(pairs) if pairs else 0.0

    def places(self, p: Passages) -> Iterator[tuple[int, int, int]]:
        """(text, first word of a passage, item) of the passages of texts that have enough of an item's pairs."""
        if not len(self.codes) or len(p.ids) < 2:
            return
        ids = p.ids.astype(np.int64)
        code = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * self.n + ids[1:], -1)
        low, high = np.searchsorted(self.codes, code), np.searchsorted(self.codes, code, "right")
        at = np.flatnonzero(high > low)
        if not len(at):
            return
        times = (high - low)[at]
        places = np.repeat(at, times)
        rows = np.arange(times.sum()) + np.repeat(low[at] - (np.cumsum(times) - times), times)
        text = np.searchsorted(p.first + p.lengths, places, "right")
        # Different pairs per text and item.
        cell = text * len(self.least) + self.items[rows]
        cells, pairs = np.unique(np.unique(cell * len(self.codes) + rows) // len(self.codes), return_counts=True)
        enough = cells[pairs >= self.least[cells % len(self.least)]]
        kept = np.isin(cell, enough)
        starts = (places - p.first[text])[kept] // STRIDE * STRIDE
        for c, start in sorted(set(zip(cell[kept].tolist(), starts.tolist()))):
            yield c // len(self.least), start, c % len(self.least)


class Passages:
    """The passages of a batch of texts, and the places of terms that carry weight.

    ``starts`` are the passages' first words among all words of the batch and ``of`` their texts; a
    text's last passage reaches its end. Passage p holds ``terms[low[p]:high[p]]``.
    """

    def __init__(self, block: Block, texts: list[list[bytes]], stride: int, idf: np.ndarray | None = None):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        ids = block.term_ids(chain.from_iterable(texts), int(self.lengths.sum()))
        # Term -1 reads the last weight, and is masked out by its own sign.
        at = np.flatnonzero(ids >= 0 if idf is None else (ids >= 0) & (idf[ids] > 0))
        self.ids, self.terms = ids, ids[at]
        n = np.maximum(1, -(-(self.lengths - WINDOW) // stride) + 1)
        self.of = np.repeat(np.arange(len(texts)), n)
        self.starts = self.first[self.of] + (np.arange(len(self.of)) - np.repeat(np.cumsum(n) - n, n)) * stride
        ends = np.minimum(self.starts + WINDOW, (self.first + self.lengths)[self.of])
        self.low, self.high = np.searchsorted(at, self.starts), np.searchsorted(at, ends)

    def rich(self) -> np.ndarray:
        return np.flatnonzero(self.high - self.low >= LEAST_TERMS)


def term_weights(docs: DataFrame, block: Block) -> tuple[np.ndarray, int]:
    """Inverse passage frequency of the terms over all documents, 0 for terms of no use; the passages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, passages, n = np.zeros(len(block.terms) + 1, np.int64), 0, len(block.terms)
        for batch in batches:
            p = Passages(block, [words_of(t) for t in batch.column(0).to_pylist()], WINDOW)
            passages += len(p.starts)
            if len(p.terms):
                cells = np.unique(np.repeat(np.arange(len(p.starts)), p.high - p.low) * n + p.terms)
                found += np.bincount(cells % n, minlength=n + 1)
        found[-1] = passages
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(len(block.terms) + 1)
    for r in rows:
        found[r.term] = r.n
    seen, passages = found[:-1], found[-1] + len(block.ids)
    return np.where(seen <= max(1, MOST_SHARE * passages), np.log((1 + passages) / (1 + seen)), 0.0), int(passages)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def singular_vectors(docs: DataFrame, block: Block, idf: np.ndarray, passages: int) -> np.ndarray:
    """Terms x RANK: the leading right singular vectors of the passages' unit TF-IDF rows."""
    n_terms, width = len(block.terms), min(RANK + OVERSAMPLE, len(block.terms))
    sketch = np.random.default_rng(10).standard_normal((n_terms, width)).astype(np.float32)
    weighted = (idf[:, None] * sketch).astype(np.float32)

    def gram(terms: np.ndarray, of: np.ndarray, n: int, total: np.ndarray, scale: float = 1.0) -> None:
        """Add A'(A W) of ``n`` passages; occurrence k of a term stands in passage of[k]."""
        cells, times = np.unique(of.astype(np.int64) * n_terms + terms, return_counts=True)
        row, col = cells // n_terms, cells % n_terms
        value = times * idf[col]
        value = value / np.sqrt(np.maximum(np.bincount(row, value * value, n), 1e-12))[row] * scale
        y = np.zeros((n, width), np.float32)
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        y[row[first]] = np.add.reduceat(value[:, None].astype(np.float32) * sketch[col], first, axis=0)
        order = np.argsort(col, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(col[order]) > 0])
        total[col[order][first]] += np.add.reduceat(value[order, None].astype(np.float32) * y[row[order]], first, axis=0)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_terms, width))
        for batch in batches:
            p = Passages(block, [words_of(t) for t in batch.column(0).to_pylist()], WINDOW, idf)
            for part in np.array_split(rich := p.rich(), -(-len(rich) // 1024) or 1):
                if len(part):
                    counts = (p.high - p.low)[part]
                    ends = np.cumsum(counts)
                    places = np.arange(ends[-1]) + np.repeat(p.low[part] - (ends - counts), counts)
                    gram(p.terms[places], np.repeat(np.arange(len(part)), counts), len(part), total)
        used = [k for k in range(0, n_terms, ROWS) if total[k : k + ROWS].any()]
        for k in used:
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([total[k : k + ROWS].tobytes()], pa.binary())], names=["first", "part"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for first, part in rows_of(batches, "first", "part"):
            x = np.frombuffer(part)
            sums[first] = sums[first] + x if first in sums else x
        for first, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([x.tobytes()], pa.binary())], names=["first", "part"])

    parts = docs.select("text").mapInArrow(task, "first long, part binary").repartition("first").mapInArrow(added, "first long, part binary")
    # Written first: rows taken straight from a shuffle would have the passages summed twice.
    sums = written(parts, "singular-sums")
    total = np.zeros((n_terms, width))
    for r in sums.toLocalIterator():
        x = np.frombuffer(bytes(r.part)).reshape(-1, width)
        total[r.first : r.first + len(x)] += x
    discard(sums)
    items = [np.array([block.terms[w] for w in x], np.int64) for x in block.words]
    items = [x[idf[x] > 0] for x in items]
    items = [x for x in items if len(x)]
    if items:
        scale = np.sqrt(max(1, passages) / len(items))
        gram(np.concatenate(items), np.repeat(np.arange(len(items)), [len(x) for x in items]), len(items), total, scale)
    core = sketch.T.astype(float) @ total
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-9 * max(values.max(initial=0.0), 1e-12)
    if not good.any():
        return np.zeros((n_terms, 1), np.float32)
    half = total @ (vectors[:, good] / np.sqrt(values[good]))
    return np.linalg.svd(half, full_matrices=False)[0][:, :RANK].astype(np.float32)


LEAK = "struct<item_id:long,cosine:double,lcs:int,item_words:int,answer_lcs:int,answer_words:int,first_word:int>"
_LEAK = pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.int32()), ("item_words", pa.int32()), ("answer_lcs", pa.int32()), ("answer_words", pa.int32()), ("first_word", pa.int32())])


def search(texts: list[list[bytes]], block: Block, frequent: Frequent, idf: np.ndarray, weighted: np.ndarray, items: np.ndarray) -> list[list[dict]]:
    """For every text the leaks of a block's items, at most one per item: the place that covers it best.

    ``weighted`` has the terms' projections times their weights, ``items`` the items' unit ones.
    """

    def note(text: int, start: int, k: int, cosine: float) -> None:
        leak = aligned(texts[text], start, block, k, idf, frequent)
        if leak:
            leak["cosine"] = cosine
            had = best[text].get(k)
            if had is None or (leak["lcs"], leak["cosine"]) > (had["lcs"], had["cosine"]):
                best[text][k] = leak

    p = Passages(block, texts, STRIDE, idf)
    best: list[dict[int, dict]] = [{} for _ in texts]
    rich = p.rich()
    for part in np.array_split(rich, -(-len(rich) // 1024)) if len(rich) else ():
        # Sums of projected terms over a passage are differences of running sums.
        a, b = p.low[part[0]], p.high[part].max()
        sums = np.zeros((b - a + 1, weighted.shape[1]), np.float32)
        np.cumsum(weighted[p.terms[a:b]], axis=0, out=sums[1:])
        cosines = _unit(sums[p.high[part] - a] - sums[p.low[part] - a]) @ items.T
        for i, k in zip(*(x.tolist() for x in np.nonzero(cosines >= NEAR))):
            text = int(p.of[part[i]])
            note(text, int(p.starts[part[i]] - p.first[text]), k, float(cosines[i, k]))
    for text, start, k in frequent.places(p):
        note(text, start, k, 0.0)
    return [list(x.values()) for x in best]


def aligned(words: list[bytes], start: int, block: Block, k: int, idf: np.ndarray, frequent: Frequent) -> dict | None:
    """The leak of item ``k`` around the passage at ``start``, if it is one."""
    item, answer = block.words[k], block.answers[k]
    region = words[max(0, start - len(item)) : start + WINDOW + len(item)]
    there = set(region)
    if sum(w in there for w in item) < PARTLY * len(item):
        return None  # no subsequence can be longer
    common = lcs(item, region)
    if common < PARTLY * len(item):
        return None
    rare = [w for w in item if idf[block.terms[w]] > 0]
    if (not rare or lcs(rare, region) < PARTLY * len(rare)) and (k not in frequent.pairs or frequent.spelled(k, region) < SPELLED):
        return None
    said = lcs(answer, region)
    if common < COVERED * len(item) and said < ANSWERED * len(answer):
        return None
    return {"item_id": block.ids[k], "lcs": common, "item_words": len(item), "answer_lcs": said, "answer_words": len(answer), "first_word": start}


def with_leaks(docs: DataFrame, benchmark: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all, if none are named) with ``leaks``, an array of one struct per item.

    Null and empty texts have no leaks, nor has any text if the benchmark is empty. Items of fewer
    than five words, or without text, are not searched. Repeated rows, of documents or items, are
    searched each. A column ``leaks`` in ``docs`` is replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long"), "text")
    blocks = -(-items.count() // BLOCK_ITEMS)
    columns = [c for c in columns or docs.columns if c != "leaks"]
    out = docs.drop("leaks").withColumn("leaks", F.array().cast(f"array<{LEAK}>"))
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        block = Block([tuple(r) for r in part.collect()])
        if block.ids:
            # Once the last block is searched, only what is asked for leaves the tasks.
            out = _searched(out, block, *term_weights(docs, block), [*columns, "leaks"] if k == blocks - 1 else out.columns)
    return out.select(*columns, "leaks")


def _searched(docs: DataFrame, block: Block, idf: np.ndarray, passages: int, keep: list[str]) -> DataFrame:
    axes = singular_vectors(docs.select("text"), block, idf, passages)
    weighted = (idf[:, None] * axes).astype(np.float32)
    frequent = Frequent(block, idf)
    items = _unit(np.array([weighted[t].sum(axis=0) for t in (block.term_ids(w, len(w)) for w in block.words)])).astype(np.float32)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            texts = [words_of(t) for t in b.column(names.index("text")).to_pylist()]
            found = [x + y for x, y in zip(b.column(names.index("leaks")).to_pylist(), search(texts, block, frequent, idf, weighted, items))]
            columns = [pa.array(found, pa.list_(_LEAK)) if n == "leaks" else b.column(names.index(n)) for n in keep]
            yield pa.RecordBatch.from_arrays(columns, names=keep)

    return docs.mapInArrow(task, T.StructType([docs.schema[c] for c in keep]))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document and leaked item: doc_id and the fields of the leak."""
    return with_leaks(docs.select("doc_id", "text"), benchmark, ["doc_id"]).select("doc_id", F.inline("leaks"))

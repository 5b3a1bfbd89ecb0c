"""Language-model scoring (operator 5): online logistic context mixing over the bits of word codes.

Words are coded by a Huffman code of the ``HEAD`` most frequent training words, the end of a text and
one escape; every bit of a code is a binary decision at a node of the code's tree. Predictors of a
bit are counts of its outcomes in four contexts: the node alone; the node with the word before, with
the two words before, and with the word before the last, the three hashed into tables of fixed size.
A mixer adds the predictors' log odds by weights that a gate selects (how much the two closest
contexts have seen), learned online in shards of documents; a last table refines what the mixer says by what
came true. An escaped word costs its smoothed share of the escaped words' counts in addition.

Predictors learn from eight of nine training folds, mixer and refinement from the ninth, so that
they see predictors at texts these have not counted. Word counts, table sums and weights are summed
by Spark; what a task holds (code, tables) has a fixed size.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import rows_of, small_batches, worker_state, written

FOLDS, HELD_OUT_FOLD, MIXER_FOLD = 10, 0, 1
#: The code's words, the log2 of a context table's slots, counters kept while counting words.
HEAD, TABLE_BITS, KEPT_WORDS = 262_144, 20, 1_000_000
CONTEXTS, GATES, INPUTS, CELLS = 3, 16, 5, 33
#: Documents of a shard, on average, that one mixer learns from.
CHUNK, SHARD_DOCS = 65_536, 1024
#: Chunks whose words are looked up together.
TOGETHER = 12
BLOCK = 1 << 14
END = ""  # no word is empty
START_HASH = np.uint64(0x51A7)
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
NODE_STEP = np.uint64(int(ODD[1]) * int(ODD[2]) % (1 << 64))
LIMIT = 12.0


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo ten; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts, with the end of each text as the empty word."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, words, size = [], [], 0

        def count() -> int:
            of = pa.array(words, pa.binary()).value_counts()
            counted.append(pa.table([of.field("values"), of.field("counts")], ["word", "n"]))
            words.clear()
            return len(of)

        def out() -> list[pa.RecordBatch]:
            summed = pa.concat_tables(counted).group_by("word", use_threads=False).aggregate([("n", "sum")])
            counted.clear()
            return pa.table([summed["word"].cast(pa.string()), summed["n_sum"]], ["word", "n"]).combine_chunks().to_batches()

        for (text,) in rows_of(batches, "text"):
            words += words_of(text)
            words.append(b"")
            if len(words) >= TOGETHER * CHUNK:
                size += count()
            if size > KEPT_WORDS:
                yield from out()
                size = 0
        if words:
            count()
        if counted:
            yield from out()

    return docs.select("text").mapInArrow(task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def head_words(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """The words above a count that at most ``most`` words reach, and the end; by falling count.

    The count is found on a histogram of logarithmic bins, so that the driver gets the bins and the
    chosen words only.
    """
    level = F.floor(F.log2("n") * 64)
    left, lowest = most, None
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True):
        if (left := left - r.n) < 0:
            break
        lowest = r.level
    chosen = counts.filter((F.col("word") == END) | (level >= F.lit(lowest))) if lowest is not None else counts.filter(F.col("word") == END)
    return sorted(((r.word, r.n) for r in chosen.collect()), key=lambda x: (-x[1], x[0]))


def huffman(weights: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Parent and side of every node of the tree; the symbols come first, the root last."""
    n = len(weights)
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    parent, side = np.zeros(2 * n - 1, np.int32), np.zeros(2 * n - 1, np.uint8)
    for node in range(n, 2 * n - 1):
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        parent[x] = parent[y] = node
        side[y] = 1
        heapq.heappush(heap, (a + b, node))
    return parent, side


class Code:
    """The words' codes, with counts; symbol ``len(words)`` is the escape.

    It travels as its words, counts and tree; the codes are laid out again where it arrives: per
    symbol the start and length of its code in two flat arrays, nodes passed and bits taken.
    """

    def __init__(self, head: list[tuple[str, int]], total: int):
        counts = np.array([n for _, n in head], np.int64)
        escaped = total - int(counts.sum())
        parent, side = huffman([*counts.tolist(), max(1, escaped)])
        self.__setstate__((b" ".join(w.encode() for w, _ in head), counts, escaped, parent, side))

    def __getstate__(self) -> tuple:
        return self.state

    def __setstate__(self, state: tuple) -> None:
        self.state = state
        words, counts, self.escaped, parent, side = state
        self.counts = counts.astype(float)
        self.words = pa.array(words.split(b" "), pa.binary())  # no word holds a space
        n = len(counts) + 1
        mixed = np.arange(1, n + 1, dtype=np.uint64) * ODD[0]
        self.hashes = (mixed ^ (mixed >> np.uint64(32))) * ODD[1]
        # All codes climb to the root together; a step takes the symbols that are not there yet.
        at, moving, steps = np.arange(n), np.arange(n), []
        while len(moving := moving[at[moving] != 2 * n - 2]):
            steps.append((moving, parent[at[moving]] - n, side[at[moving]]))
            at[moving] = parent[at[moving]]
        self.lengths = np.bincount(np.concatenate([m for m, _, _ in steps]) if steps else np.zeros(0, int), minlength=n)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.nodes, self.bits = np.empty(self.lengths.sum(), np.int32), np.empty(self.lengths.sum(), np.uint8)
        for k, (symbols, node, bit) in enumerate(steps):
            place = self.starts[symbols] + self.lengths[symbols] - 1 - k
            self.nodes[place], self.bits[place] = node, bit
        passed = np.repeat(np.append(self.counts, max(1, self.escaped)), self.lengths)
        ones = np.bincount(self.nodes, passed * self.bits, max(1, n - 1))
        every = np.bincount(self.nodes, passed, max(1, n - 1))
        share = (ones + 0.4) / (every + 0.8)
        self.node_odds = np.log(share / (1 - share)).astype(np.float32)

    @property
    def escape(self) -> int:
        return len(self.words)


def _word_hashes():
    import xxhash

    class Hashes(dict):
        def __missing__(self, word: bytes) -> int:
            self[word] = h = xxhash.xxh3_64_intdigest(word)
            return h

    return Hashes()


def _looked_up(code: Code, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Symbols and hashes of words; and the escaped ones, in order."""
    symbols = pc.fill_null(pc.index_in(pa.array(words, pa.binary()), value_set=code.words), code.escape).to_numpy().astype(np.int64)
    hashes, known = code.hashes.take(symbols), worker_state("mixing_hashes", _word_hashes)
    if len(known) > 200_000:
        known.clear()
    places = np.flatnonzero(symbols == code.escape)
    escaped = [words[i] for i in places.tolist()]
    hashes[places] = np.fromiter(map(known.__getitem__, escaped), np.uint64, len(escaped))
    return symbols, hashes, pa.array(escaped, pa.binary())


def _chunks(code: Code, texts: Iterator[tuple[int, list[bytes]]]) -> Iterator[tuple]:
    """Chunks over many texts and their ends: which text, symbol, hash of the word before, of the word
    before that; and the escaped words.

    A long text goes on in the next chunk. The words of some chunks are looked up together.
    """
    flat, numbers, lengths, opens, cuts, before = [], [], [], [], [0], (START_HASH, START_HASH)

    def group() -> Iterator[tuple]:
        symbols, hashes, escaped = _looked_up(code, flat)
        starts = np.cumsum(lengths) - lengths
        last, second = np.empty_like(hashes), np.empty_like(hashes)
        last[1:], second[2:] = hashes[:-1], hashes[:-2]
        last[0], second[0], second[1:2] = before[1], before[0], before[1]
        first = starts[opens]
        last[first] = second[first] = START_HASH
        second[np.minimum(first + 1, len(second) - 1)] = START_HASH
        which, met = np.repeat(numbers, lengths), np.append(0, np.cumsum(symbols == code.escape))
        for a, b in pairwise(cuts):
            yield which[a:b], symbols[a:b], last[a:b], second[a:b], escaped[met[a] : met[b]]
        return last[-1], hashes[-1]

    for number, words in texts:
        for start in range(0, len(words) + 1, CHUNK):
            part = words[start : start + CHUNK]
            ended = start + CHUNK > len(words)
            flat += part
            if ended:
                flat.append(b"")
            numbers.append(number)
            opens.append(start == 0)
            lengths.append(len(part) + ended)
            if len(flat) - cuts[-1] >= CHUNK:
                cuts.append(len(flat))
            if len(cuts) > TOGETHER:
                before = yield from group()
                flat, numbers, lengths, opens, cuts = [], [], [], [], [0]
    if flat:
        if cuts[-1] < len(flat):
            cuts.append(len(flat))
        yield from group()


def _streams(code: Code, texts: Iterator[tuple[int, list[bytes]]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Chunks over many texts: which text, symbol, hash of the word before, of the word before that."""
    return (chunk[:4] for chunk in _chunks(code, texts))


def _bits(code: Code, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every bit of the symbols' codes its node and the bit; and how many each symbol has."""
    lengths = code.lengths.take(symbols)
    place = np.repeat(code.starts.take(symbols) - (np.cumsum(lengths) - lengths), lengths)
    place += np.arange(len(place))
    return code.nodes.take(place), code.bits.take(place), lengths


def _slots(last: np.ndarray, second: np.ndarray, lengths: np.ndarray, node: np.ndarray) -> Iterator[np.ndarray]:
    """The bit's slot in the table of each hashed context."""
    contexts = [last * ODD[0], (last * ODD[1] + second) * ODD[0], second * ODD[2] + np.uint64(1)]
    # Multiplied before they are repeated and added: the products are the same, modulo 2 ** 64.
    step = node.astype(np.uint64)
    step *= NODE_STEP
    for c in contexts:
        slot = np.repeat((c ^ (c >> np.uint64(29))) * ODD[2], lengths)
        slot += step
        slot >>= np.uint64(64 - TABLE_BITS)
        yield slot.view(np.int64)


def context_tables(docs: DataFrame, code: Code) -> np.ndarray:
    """contexts x slots: the log odds (low byte) and the confidence (high byte) of every slot.

    Every task counts outcomes in tables of its own; blocks of them are summed by Spark and turned
    into two bytes a slot before the driver gathers them.
    """
    size = 1 << TABLE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((CONTEXTS, 2 * size), np.uint32)
        for _, symbols, last, second in _streams(code, ((0, words_of(t)) for (t,) in rows_of(batches, "text"))):
            node, bit, lengths = _bits(code, symbols)
            for table, slot in zip(tables, _slots(last, second, lengths, node)):
                slot *= 2
                slot += bit
                np.add.at(table, slot, np.uint32(1))
        flat = tables.reshape(-1, 2 * BLOCK)
        for k in np.flatnonzero(flat.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([zlib.compress(flat[k].tobytes(), 1)], pa.binary())], names=["block", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for k, part in rows_of(batches, "block", "part"):
            x = np.frombuffer(zlib.decompress(part), np.uint32).astype(np.uint64)
            sums[k] = sums[k] + x if k in sums else x
        for k, x in sums.items():
            none, one = x[0::2].astype(float), x[1::2].astype(float)
            odds = np.clip(np.log((one + 0.4) / (none + 0.4)), -LIMIT, LIMIT)
            seen = np.digitize(none + one, [1, 3, 16])
            entry = (np.round(odds * (127 / LIMIT)) + 128).astype(np.uint16) | (seen.astype(np.uint16) << 8)
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([entry.tobytes()], pa.binary())], names=["block", "part"])

    ddl = "block long, part binary"
    parts = docs.select("text").mapInArrow(count, ddl).repartition("block").mapInArrow(add, ddl)
    out = np.full((CONTEXTS * size // BLOCK, BLOCK), 128, np.uint16)
    for r in parts.collect():  # two bytes a slot; an iterator would run the counting twice
        out[r.block] = np.frombuffer(bytes(r.part), np.uint16)
    return out.reshape(CONTEXTS, size)


ODDS = ((np.arange(256) - 128) * (LIMIT / 127)).astype(np.float32)
SIGNS = np.array([1.0, -1.0])
FIRST_WEIGHTS = np.tile(np.array([0.4, 0.3, 0.3, 0.1, 0.0]), (GATES, 1))


def _entries(code: Code, tables: np.ndarray, symbols: np.ndarray, last: np.ndarray, second: np.ndarray):
    """Per bit: node, bit, gate, and the tables' log odds as bytes; and how many bits each symbol has."""
    node, bit, lengths = _bits(code, symbols)
    entries = [t.take(s) for t, s in zip(tables, _slots(last, second, lengths, node))]
    gate = (entries[0] >> 8) * 4 + (entries[1] >> 8)
    return node, bit, gate.astype(np.int64), [e & 255 for e in entries], lengths


def _inputs(code: Code, tables: np.ndarray, symbols: np.ndarray, last: np.ndarray, second: np.ndarray):
    """Per bit: bit, gate, and the inputs of the mixer."""
    node, bit, gate, entries, _ = _entries(code, tables, symbols, last, second)
    x = np.empty((INPUTS, len(node)), np.float32)
    # No place is out of range; without a check the values are not buffered.
    code.node_odds.take(node, out=x[0], mode="clip")
    for k, e in enumerate(entries):
        ODDS.take(e, out=x[1 + k], mode="clip")
    x[4] = 1
    return bit, gate, x


def _mixed(x: np.ndarray, gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    w = weights.T.astype(np.float32)
    z = w[0].take(gate)
    z *= x[0]
    for k in range(1, INPUTS):
        part = w[k].take(gate)
        part *= x[k]
        z += part
    return np.clip(z, -LIMIT, LIMIT, out=z)


def _said(code: Code, node: np.ndarray, gate: np.ndarray, entries: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """What ``_mixed`` gives, by tables of all products of a gate's weight and a context's log odds."""
    w = weights.T.astype(np.float32)
    z = w[0].take(gate)
    z *= code.node_odds.take(node)
    row = gate << 8
    for k, e in enumerate(entries):
        z += (w[1 + k][:, None] * ODDS).ravel().take(row + e)
    z += w[4].take(gate)
    return np.clip(z, -LIMIT, LIMIT, out=z)


def _cell(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = (z + np.float32(LIMIT)) * np.float32((CELLS - 1) / (2 * LIMIT))
    low = np.minimum(place.astype(np.int64), CELLS - 2)
    return low, place - low


def _summed(rows: DataFrame, shape: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of (place, value, weight) rows by place."""
    value, weight = np.zeros(math.prod(shape)), np.zeros(math.prod(shape))
    for r in rows.groupBy("place").agg(F.sum("value").alias("value"), F.sum("weight").alias("weight")).collect():
        value[r.place], weight[r.place] = r.value, r.weight
    return value.reshape(shape), weight.reshape(shape)


def _placed(value: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(value.size)), pa.array(value.ravel()), pa.array(weight.ravel())], names=["place", "value", "weight"])


def mixer_weights(docs: DataFrame, code: Code, tables: np.ndarray) -> np.ndarray:
    """gates x inputs: online logistic regression in every shard of documents, averaged by the bits a gate
    has seen.

    Documents are dealt to shards by a hash of their ids, and are learned in order of id there: weights
    do not depend on files, partitions or lost executors. Shards number with the documents.
    """
    shards = 1 + docs.count() // SHARD_DOCS
    dealt = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"), "doc_id", "text")
    order = ["shard", "doc_id", "text"]

    def learned(texts: Iterator[str | None]) -> pa.RecordBatch:
        weights, squares, seen = FIRST_WEIGHTS.copy(), np.full((GATES, INPUTS), 1e-6), np.zeros(GATES)
        for _, symbols, last, second in _streams(code, ((0, words_of(t)) for t in texts)):
            bit, gate, x = _inputs(code, tables, symbols, last, second)
            for a in range(0, len(bit), 4096):
                g, part = gate[a : a + 4096], x[:, a : a + 4096]
                error = bit[a : a + 4096] - 1 / (1 + np.exp(-_mixed(part, g, weights)))
                step = np.stack([np.bincount(g, error * v, GATES) for v in part], axis=1)
                squares += step * step
                weights += 0.05 * step / np.sqrt(squares)
                seen += np.bincount(g, minlength=GATES)
        every = np.repeat(seen[:, None], INPUTS, axis=1)
        return _placed(weights * every, every)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(rows_of(batches, "shard", "text"), key=lambda row: row[0]):
            yield learned(text for _, text in rows)

    parts = dealt.repartition("shard").sortWithinPartitions(*order).mapInArrow(task, "place long, value double, weight double")
    value, weight = _summed(parts, (GATES, INPUTS))
    return np.where(weight > 0, value / np.maximum(weight, 1), FIRST_WEIGHTS)


def refinement(docs: DataFrame, code: Code, tables: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """gates x cells: the log odds that bits had where the mixer said a cell's log odds."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones, every = np.zeros(GATES * CELLS), np.zeros(GATES * CELLS)
        for _, symbols, last, second in _streams(code, ((0, words_of(t)) for (t,) in rows_of(batches, "text"))):
            node, bit, gate, entries, _ = _entries(code, tables, symbols, last, second)
            low, part = _cell(_said(code, node, gate, entries, weights))
            for place, share in ((gate * CELLS + low, 1 - part), (gate * CELLS + low + 1, part)):
                ones += np.bincount(place, share * bit, len(ones))
                every += np.bincount(place, share, len(every))
        yield _placed(ones, every)

    ones, every = _summed(docs.select("text").mapInArrow(task, "place long, value double, weight double"), (GATES, CELLS))
    said = 1 / (1 + np.exp(-np.linspace(-LIMIT, LIMIT, CELLS)))
    share = (ones + 20 * said) / (every + 20)
    return np.log(share / (1 - share)).astype(np.float32)


def token_scores(code: Code, tables: np.ndarray, weights: np.ndarray, refined: np.ndarray, symbols, last, second) -> np.ndarray:
    """log10 probability of every symbol."""
    node, bit, gate, entries, lengths = _entries(code, tables, symbols, last, second)
    z = _said(code, node, gate, entries, weights)
    low, part = _cell(z)
    place, refined = gate * CELLS + low, refined.ravel()
    z = (z + refined.take(place) * (1 - part) + refined.take(place + 1) * part) / 2
    z *= SIGNS.take(bit)
    np.exp(z, out=z)
    z += 1
    return np.add.reduceat(np.log(z, out=z), np.cumsum(lengths) - lengths) / -math.log(10)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """doc_id, fold, words and bytes of texts, of some chunks' words at a time."""
    held, size = [], 0
    for doc_id, fold, text in rows_of(batches, "doc_id", "fold", "text"):
        held.append((doc_id, fold, words_of(text), len((text or "").encode())))
        size += 1 + len(held[-1][2])
        if size >= TOGETHER * CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


PARTS = pa.schema([
    ("word", pa.string()), ("row", pa.int64()), ("times", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_bytes", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("coded", pa.float64()),
])
PARTS_DDL = "word string, row long, times long, doc_id long, held_out boolean, n_tokens long, n_bytes long, known long, base double, coded double"


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row.

    A null text is empty: its end is its only token. A null doc_id is held out. Repeated rows count
    and are scored each. An empty table gives no rows; without training texts every token is unknown.
    Other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("fold", fold_of(F.col("doc_id")))
    train = rows.filter(F.col("fold") != HELD_OUT_FOLD)
    counts = written(word_counts(train), "word-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    head = head_words(counts, HEAD)
    if not any(w == END for w, _ in head):
        head.append((END, 0))
    code = Code(head, total.n)
    tables = context_tables(train.filter(F.col("fold") != MIXER_FOLD), code)
    mixer = train.filter(F.col("fold") == MIXER_FOLD)
    weights = mixer_weights(mixer, code, tables)
    refined = refinement(mixer, code, tables, weights)

    base_total = total.n + 0.1 * (total.v + 1)
    escaped_total = code.escaped + 0.1 * (total.v - int((code.counts > 0).sum()) + 1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        base_of = np.append(np.log10((code.counts + 0.1) / base_total), 0.0)
        known_of = np.append(code.counts > 0, False).astype(float)

        for texts in _held(batches):
            n = len(texts)
            own = np.arange(first, first + n)
            first += n
            base, known, coded = np.zeros(n), np.zeros(n), np.zeros(n)
            for which, symbols, last, second, escaped in _chunks(code, ((k, x[2]) for k, x in enumerate(texts))):
                coded += np.bincount(which, token_scores(code, tables, weights, refined, symbols, last, second), n)
                base += np.bincount(which, base_of.take(symbols), n)
                known += np.bincount(which, known_of.take(symbols), n)
                distinct = escaped.dictionary_encode()
                met = len(distinct.dictionary)
                pairs, times = np.unique(which[symbols == code.escape] * met + distinct.indices.to_numpy(), return_counts=True)
                rows = [distinct.dictionary.take(pa.array(pairs % max(1, met))).cast(pa.string()), pa.array(own[pairs // max(1, met)]), pa.array(times)]
                yield pa.RecordBatch.from_arrays([*rows, *(pa.nulls(len(pairs), f.type) for f in list(PARTS)[3:])], schema=PARTS)
            doc_ids, folds, words, n_bytes = zip(*texts)
            n_tokens = [len(w) + 1 for w in words]
            scored = [[f" {r}" for r in own.tolist()], own, np.zeros(n, np.int64), doc_ids, [f == HELD_OUT_FOLD for f in folds], n_tokens, n_bytes, known.astype(np.int64), base, coded]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(scored, PARTS)], schema=PARTS)

    # A document's own row has a key that no word has: words hold no space. It spreads these rows
    # over the join. Escaped words are rare by their choice, so no key of the join is hot.
    parts = rows.mapInArrow(task, PARTS_DDL)
    n = F.coalesce("n", F.lit(0))
    times = F.col("times")
    share = lambda whole: F.log10((n + 0.1) / F.lit(float(whole))) * times
    joined = parts.join(counts, "word", "left").select(
        "row", "doc_id", "held_out", "n_tokens", "n_bytes",
        (F.coalesce("known", F.lit(0)) + F.when(n > 0, times).otherwise(0)).alias("known"),
        (F.coalesce("base", F.lit(0.0)) + share(base_total)).alias("base"),
        (F.coalesce("coded", F.lit(0.0)) + share(escaped_total)).alias("coded"),
    )
    summed = joined.groupBy("row").agg(*[F.max(c).alias(c) for c in ("doc_id", "held_out", "n_tokens", "n_bytes")], *[F.sum(c).alias(c) for c in ("known", "base", "coded")])
    return summed.select(
        "doc_id", "held_out", "n_tokens", F.col("known").alias("n_known"), F.lit(total.n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"),
        F.col("coded").alias("score"), (F.col("coded") / F.lit(-math.log10(2)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )

"""Two tokenizers' tokens of the same text, aligned by sparse products (operator 12).

Every token stands for a range of the text's bytes. A matrix of tokens by bytes, held as compressed
rows, has a one where a token covers a byte; with A and B the matrices of the two tokenizers, A Bᵀ
has an entry, the number of common bytes, for every pair of tokens that overlap. Offsets where tokens
of both end cut the bytes into groups, and the product of the tokens-by-groups matrices links all
tokens of a group. Products go by rows (Gustavson): row i of the result gathers the rows of the second
factor that row i of the first names. Both cut before a space between words, so the matrices of texts are block diagonal;
equal blocks are multiplied once, those of a batch in one product.

Corpus-wide counts of linked id pairs stay distributed. A task closes a chunk of documents when its
distinct pairs reach a bound, and stores each document's pairs as places in the chunk's sorted list.
Only those lists are counted and joined: a chunk asks for the counts of its distinct pairs, however
often its documents hold them, and a pair that all documents hold is one row per chunk.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skygrid.llm.bpe import Codec
from skygrid.llm.common import small_batches, worker_state, written
from skygrid.llm.tokens import default_tokenizer

PIECES = "piece_bpe_32k.model"
#: A chunk is closed at so many distinct pairs, or entries of documents; its memory follows from both.
CHUNK_PAIRS, CHUNK_ENTRIES = 200_000, 1_000_000
#: Pieces of text a worker keeps.
KEPT_PIECES = 500_000


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECES)


class Rows(NamedTuple):
    """A matrix of zeros and positive numbers by compressed rows."""

    starts: np.ndarray  # of each row among the entries, and their number at the end
    columns: np.ndarray
    width: int

    @staticmethod
    def of_ranges(ends: np.ndarray, width: int) -> Rows:
        """Consecutive ranges by their ends: row i covers the columns from end i - 1 to end i."""
        return Rows(np.concatenate(([0], ends)).astype(np.int64), np.arange(width, dtype=np.int64), width)

    @staticmethod
    def of_members(columns: np.ndarray, width: int) -> Rows:
        """One entry a row."""
        return Rows(np.arange(columns.size + 1, dtype=np.int64), columns.astype(np.int64), width)

    def transposed(self) -> Rows:
        """By counting entries per column; rows stay in order within a column."""
        counts = np.bincount(self.columns, minlength=self.width)
        rows = np.repeat(np.arange(self.starts.size - 1), np.diff(self.starts))
        if self.columns.size and np.any(self.columns[1:] < self.columns[:-1]):
            rows = rows[np.argsort(self.columns, kind="stable")]
        return Rows(np.concatenate(([0], np.cumsum(counts))).astype(np.int64), rows, self.starts.size - 1)


def row_products(a: Rows, b: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (row, column, value) of a·b for matrices of ones, by row and column.

    Each entry (i, k) of a adds row k of b to row i; equal columns of a row are summed.
    """
    sizes = np.diff(b.starts)[a.columns]
    total = int(sizes.sum())
    row = np.repeat(np.arange(a.starts.size - 1), np.diff(a.starts))
    if (sizes == 1).all():
        column = b.columns[b.starts[a.columns]]
    else:
        into = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        row, column = np.repeat(row, sizes), b.columns[np.repeat(b.starts[a.columns], sizes) + into]
    if not total:
        return row, column, row
    new = (row[1:] != row[:-1]) | (column[1:] != column[:-1])
    if np.any((row[1:] == row[:-1]) & (column[1:] < column[:-1])):  # rows ascend, columns may not
        order = np.lexsort((column, row))
        row, column = row[order], column[order]
        new = (row[1:] != row[:-1]) | (column[1:] != column[:-1])
    first = np.flatnonzero(np.concatenate(([True], new)))
    return row[first], column[first], np.diff(first, append=total)


def product_sizes(a: Rows, b: Rows) -> np.ndarray:
    """Entries per row of a·b where a has one entry a row: the sizes of the rows it names."""
    return np.diff(b.starts)[a.columns]


class Aligned(NamedTuple):
    """Places of linked tokens, the group of every token, and the number of groups."""

    a_linked: np.ndarray
    b_linked: np.ndarray
    common_bytes: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    n_groups: int

    def group_links(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of tokens of one group."""
        a, b = Rows.of_members(self.a_group, self.n_groups), Rows.of_members(self.b_group, self.n_groups)
        return row_products(a, b.transposed())[:2]

    def group_sizes(self) -> np.ndarray:
        """The number of such pairs of every token of the first."""
        a, b = Rows.of_members(self.a_group, self.n_groups), Rows.of_members(self.b_group, self.n_groups)
        return product_sizes(a, b.transposed())


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> Aligned:
    """Links and groups of two cuts of the same bytes."""
    width = int(a_ends[-1]) if a_ends.size else 0
    a, b = Rows.of_ranges(a_ends, width), Rows.of_ranges(b_ends, width)
    i, j, common = row_products(a, b.transposed())
    borders = np.intersect1d(a_ends, b_ends, assume_unique=True)  # no token is empty
    return Aligned(i, j, common, np.searchsorted(borders, a_ends), np.searchsorted(borders, b_ends), borders.size)


class Spelling:
    """Decimal ids with the separator after them, to write groups by table."""

    def __init__(self):
        self.known: dict[str, np.ndarray] = {}

    def table(self, separator: str, size: int) -> np.ndarray:
        if separator not in self.known or self.known[separator].size < size:
            self.known[separator] = np.array([f"{i}{separator}" for i in range(size)], object)
        return self.known[separator]

    def groups(self, a: np.ndarray, b: np.ndarray, by: Aligned, sizes: tuple[int, int]) -> list[str]:
        """``a1,a2|b1;a3|b2,b3;``: the ids of every group, in order, a text per token."""
        out = np.empty(a.size + b.size, object)
        for ids, group, other, end, size in (
            (a, by.a_group, np.searchsorted(by.b_group, by.a_group), "|", sizes[0]),
            (b, by.b_group, np.searchsorted(by.a_group, by.b_group, "right"), ";", sizes[1]),
        ):
            texts = self.table(",", size)[ids]
            ends = np.flatnonzero(np.append(group[1:] != group[:-1], True)) if ids.size else np.zeros(0, np.int64)
            texts[ends] = self.table(end, size)[ids[ends]]
            out[np.arange(ids.size) + other] = texts
        return out.tolist()


class Block(NamedTuple):
    """A piece's groups, each with a semicolon; its links' keys (A id << 32 | B id); and its numbers of
    A tokens, B tokens, groups and group links; numbers as little-endian 64-bit bytes."""

    groups: str
    keys: bytes
    counts: bytes


class Pair:
    """The two tokenizers of a worker.

    The first breaks before every space that a non-space follows. No piece of the second vocabulary has
    a space after another character (checked), so it merges nothing across such a place either. Texts
    are cut there, and each distinct piece of a batch is encoded once.
    """

    def __init__(self, byte_level: str, pieces: str):
        import regex
        import sentencepiece

        self.a = Codec(byte_level, special=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(map(regex.compile("[^▁]▁").search, names)):
            raise ValueError(f"{pieces}: pieces with a space after another character cannot be cut at spaces")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.sizes = max(self.a.bytes_of) + 1, len(names)
        self.a_lengths = np.array([len(self.a.bytes_of.get(i, b"")) for i in range(self.sizes[0])])
        self.b_lengths = np.array([len(x) for x in self.b_bytes])
        self.space = self.b.piece_to_id("▁")
        self.loose = regex.compile(r" (?:\s|\Z)").search
        self.cut = regex.compile(r"(?<=\S) (?=\S)").split
        self.spelling = Spelling()
        self.kept: dict[str, Block | None] = {}

    def pieces(self, text: str) -> list[str]:
        """The pieces of space + text, without the space that each begins with."""
        return self.cut(text) if text[:1].isspace() or self.loose(text) else text.split(" ")

    def tokens(self, pieces: list[str]) -> tuple[list[bytes], list[bytes], list[bool]]:
        """Ids by both as little-endian 32-bit bytes, and whether both spell space + piece."""
        a = self.a.pieces(pieces)
        # The space that the tokenizer sets itself is the piece's own; an empty text gets none.
        b = [ids if p else [self.space] for p, ids in zip(pieces, self.b.encode(pieces, num_threads=1))] if pieces else []
        table = self.b_bytes
        spelled = [b"".join([table[i] for i in ids]) == (" " + p).encode("utf-8", "replace") for p, ids in zip(pieces, b)]
        return [a[p] for p in pieces], [struct.pack(f"<{len(ids)}I", *ids) for ids in b], spelled

    def learn(self, texts: list[str]) -> None:
        """Align the pieces of texts not met before, all in one product."""
        if len(self.kept) > KEPT_PIECES:
            self.kept.clear()
        new = set()
        for text in texts:
            new.update(self.pieces(text))
        new = [p for p in new if p not in self.kept]
        a, b, spelled = self.tokens(new)
        self.kept.update((p, None) for p, ok in zip(new, spelled) if not ok)
        good = [i for i, ok in enumerate(spelled) if ok]
        found = self.blocks([a[i] for i in good], [b[i] for i in good])
        self.kept.update((new[i], block) for i, block in zip(good, found))

    def blocks(self, a: list[bytes], b: list[bytes]) -> list[Block]:
        """Every piece's alignment. The matrices of pieces side by side are block diagonal: a piece
        starts where tokens of both end, so their one product holds every piece's."""
        if not a:
            return []
        a_ids, b_ids = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in (a, b))
        a_of, b_of = (np.cumsum([0, *(len(x) // 4 for x in y)]) for y in (a, b))
        by = align(np.cumsum(self.a_lengths[a_ids]), np.cumsum(self.b_lengths[b_ids]))
        keys = ((a_ids[by.a_linked] << 32) | b_ids[by.b_linked]).astype("<i8").tobytes()
        links = np.searchsorted(by.a_linked, a_of)
        groups = np.append(by.a_group, by.n_groups)[a_of]
        together = np.concatenate(([0], np.cumsum(by.group_sizes())))[a_of]
        counts = np.stack([np.diff(x) for x in (a_of, b_of, groups, together)], 1).astype("<i8").tobytes()
        texts = self.spelling.groups(a_ids, b_ids, by, self.sizes)
        places = (a_of + b_of).tolist()
        links = (8 * links).tolist()
        return [
            Block("".join(texts[s:e]), keys[i:j], counts[32 * k : 32 * k + 32])
            for k, (s, e, i, j) in enumerate(zip(places, places[1:], links, links[1:]))
        ]

    def document(self, text: str) -> tuple[str, bytes, np.ndarray]:
        """Groups as text, keys of the links, and n_a, n_b, n_groups and group links; pieces are learnt."""
        blocks = list(map(self.kept.__getitem__, self.pieces(text))) if text else []
        if not blocks or None in blocks:
            return "", b"", np.zeros(4, np.int64)
        groups, keys, counts = zip(*blocks)
        return "".join(groups)[:-1], b"".join(keys), np.frombuffer(b"".join(counts), "<i8").reshape(-1, 4).sum(0)


def pair_of(byte_level: str, pieces: str) -> Pair:
    held = worker_state("token_pairs", dict)
    if (byte_level, pieces) not in held:
        held[byte_level, pieces] = Pair(byte_level, pieces)
    return held[byte_level, pieces]


_CHUNKS = "chunk string, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, groups string, groups_sha256 string, places binary, times binary, pairs array<long>, documents array<int>"
_ARROW = pa.schema([
    ("chunk", pa.string()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("n_group_links", pa.int64()), ("groups", pa.string()), ("groups_sha256", pa.string()), ("places", pa.binary()), ("times", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("documents", pa.list_(pa.int32())),
])


def aligned_chunks(docs: DataFrame, byte_level: str, pieces: str, spelled: bool) -> DataFrame:
    """One row per document with its places in the chunk's pairs, and one row per chunk with those.

    ``spelled``: keep every document's groups as text, not their digest alone.
    """
    small_batches(docs.sparkSession)

    def align_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair_of(byte_level, pieces)
        rows, keys, times, entries = [], [], [], 0
        seen = np.zeros(0, np.int64)

        def chunk() -> Iterator[pa.RecordBatch]:
            number = uuid.uuid4().hex
            pairs, place, documents = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            ends = np.cumsum([k.size for k in keys])
            split = np.split(place.astype("<u4"), ends[:-1])
            filled = [(number, *r, p.tobytes(), t.astype("<u4").tobytes(), None, None) for r, p, t in zip(rows, split, times)]
            filled.append((number, *(None,) * (len(_ARROW) - 3), pairs, documents.astype(np.int32)))
            for at in range(0, len(filled), 512):
                columns = zip(*filled[at : at + 512])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

        def documents() -> Iterator[tuple]:
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                both.learn(texts)
                yield from zip(batch.column(0).to_pylist(), map(both.document, texts))

        for doc_id, (groups, linked, counts) in documents():
            key, n = np.unique(np.frombuffer(linked, "<i8"), return_counts=True)
            n_a, n_b, n_groups, n_group_links = counts.tolist()
            digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
            rows.append((doc_id, n_a, n_b, n_groups, len(linked) // 8, n_group_links, groups if spelled else None, digest))
            keys.append(key)
            times.append(n)
            entries += key.size
            if len(rows) % 64 == 0 or entries >= CHUNK_ENTRIES:
                seen = np.unique(np.concatenate([seen, *keys[-64:]]))
                if seen.size >= CHUNK_PAIRS or entries >= CHUNK_ENTRIES:
                    yield from chunk()
                    rows, keys, times, entries, seen = [], [], [], 0, np.zeros(0, np.int64)
        if rows:
            yield from chunk()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(align_task, _CHUNKS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold a pair linked, and whether no pair of its A id has more.

    A chunk's lists are sums already. An A id has at most as many pairs as B has ids.
    """
    listed = chunks.filter("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "documents")).alias("p"))
    counts = listed.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.documents").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.withColumn("best", F.col("n") == most)


def alignments(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, spelled: bool = True) -> DataFrame:
    """Every document's alignment, and how common its linked id pairs are in the corpus.

    Columns: doc_id, n_a, n_b, n_groups, n_links, n_group_links (pairs of tokens of one group),
    groups (``a1,a2|b1;a3|b2,b3``, if ``spelled``), groups_sha256, n_best (links whose pair's count
    is the highest of its A id, ties included), count_sum (the sum of the links' counts). A pair's
    count is the number of rows of ``docs`` that hold it linked, so repeated rows count each.

    Null, empty and not equally spelled texts have zeros and ''. Null ids stay. An empty table gives
    no rows. Other columns are not read. Special tokens inside texts are plain text.
    """
    chunks = written(aligned_chunks(docs, byte_level or default_tokenizer(), pieces or default_pieces(), spelled), "aligned")
    counts = written(pair_counts(chunks), "pair-counts")
    asked = chunks.filter("pairs IS NOT NULL").select(F.col("chunk").alias("asker"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts, "pair").select("asker", "place", "n", "best")
    rows = chunks.filter("pairs IS NULL").drop("pairs", "documents")
    fields = [f for f in rows.schema if f.name not in ("chunk", "places", "times")]

    def sum_up(held: pa.Table, told: pa.Table) -> pa.Table:
        n, best = np.zeros(told.num_rows, np.int64), np.zeros(told.num_rows, bool)
        at = told.column("place").to_numpy()
        n[at], best[at] = told.column("n").to_numpy(), told.column("best").to_numpy(zero_copy_only=False)
        sums, bests = [], []
        for places, times in zip(held.column("places").to_pylist(), held.column("times").to_pylist()):
            p, t = np.frombuffer(places, "<u4"), np.frombuffer(times, "<u4").astype(np.int64)
            sums.append(int((t * n[p]).sum()))
            bests.append(int(t[best[p]].sum()))
        return held.select([f.name for f in fields]).append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", n_best long, count_sum long"
    # A group is a chunk, whose documents and pairs are bounded.
    return rows.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInArrow(sum_up, schema)

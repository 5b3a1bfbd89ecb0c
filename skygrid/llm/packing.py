"""Best-fit packing (operator 9): bounded-space online best fit in every task.

A task takes its pieces as they come and holds at most ``open_bins`` sequences that still have
room. Their free spaces stand in a bitset: the lowest set bit at or above a piece's length is the
fullest sequence it fits into. A new sequence beyond the limit closes the fullest open one. A
sequence never spans tasks, so no shuffle is needed, and a task ends with at most ``open_bins``
sequences that are not full. Pieces wait in a look-ahead of bounded size and leave it longest first,
which fills sequences better than the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from skygrid.llm.common import in_batches, rows_of, small_batches
from skygrid.llm.tokens import END_ID, crc32_ids, encoder


class OpenBins:
    """At most ``most`` open bins of ``size``: ``put(length)`` gives (bin number, offset)."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.bits = 0  # bit f is set if a bin with f places free is open
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        found = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return found

    def put(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.size, self.made
            self.made += 1
        if left := free - length:
            if self.open >= self.most:
                fullest = (self.bits & -self.bits).bit_length() - 1
                if fullest >= left:  # the new one is the fullest: it closes itself
                    return number, self.size - free
                self._take(fullest)
            self.by_free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.size - free


#: Pieces and bytes of ids in the look-ahead.
AHEAD_PIECES, AHEAD_BYTES = 50_000, 64 << 20

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32())),
])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, `offset` long"


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the first one takes what full pieces leave."""
    first = n % size or min(n, size)
    return [(0, first), *((s, size) for s in range(first, n, size))] if n else []


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, open_bins: int = 4096, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece with its sequence, its place there and, if asked for, its ids.

    A document is its text's ids and the end id; a null or empty text is the end id alone. Only
    documents of more than ``size`` ids are cut. Repeated rows are packed each for itself; an empty
    table gives no rows; a null doc_id stays null. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    schema = PIECES if with_ids else PIECES.remove(len(PIECES) - 1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, bins = encoder(tokenizer), OpenBins(size, open_bins)
        base = TaskContext.get().partitionId() << 36

        def placed(ahead: list[tuple]) -> Iterator[tuple]:
            for row, ids in sorted(ahead, key=lambda x: -x[0][3]):
                number, offset = bins.put(row[3])
                yield (*row, base + number, offset, *((np.frombuffer(ids, "<i4"),) if with_ids else ()))

        def rows() -> Iterator[tuple]:
            ahead, held = [], 0
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                ids = model.encode(text or "") + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    piece = ids[4 * start : 4 * (start + length)]
                    ahead.append(((doc_id, k, start, length, crc32_ids(piece)), piece if with_ids else None))
                    held += len(piece) if with_ids else 0
                    if len(ahead) >= AHEAD_PIECES or held >= AHEAD_BYTES:
                        yield from placed(ahead)
                        ahead, held = [], 0
            yield from placed(ahead)

        yield from in_batches(rows(), schema)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(task, PIECES_DDL + (", ids array<int>" if with_ids else ""))

"""HTML extraction (operator 8): nearest-URL page differencing.

Pages are range-partitioned and sorted by host, path and id; the neighbours of a page are the
``NEAREST`` pages before and after it in its host, the nearest by path. Every page's lines are aligned
with each neighbour's by longest common subsequence, those of an article or main element too; a
neighbour that shares most of them is a copy and says nothing. An article's line goes if all other
neighbours share it, ``WITNESSES`` at least: lines that only some pages have are the article's own, as
sentences recur. Where a page has no article, a line goes if the page before or after shares it, and the
rest are the text. Lines of menus, footers, notices and the like go also where a site varies them.

Pages at the edge of a task have neighbours on one side, so that no host is gathered in one task.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import in_batches, rows_of, small_batches
from skygrid.llm.html_blocks import blocks
from skygrid.llm.urls import parts

#: Of two pages that share this part of their lines, one is a copy of the other: nothing is deleted.
COPY_SHARE = 0.8
#: Neighbours on each side, and how many that are no copies it takes to call an article's line the site's.
NEAREST, WITNESSES = 3, 3


def shared_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence of lines.

    Bit-parallel: a row of the usual table is a number whose zero bits mark where it grows. Rows are
    kept only for lines that both pages have.
    """
    common = set(a) & set(b)
    if not common:
        return set()
    ka = [(i, x) for i, x in enumerate(a) if x in common]
    kb = [x for x in b if x in common]
    places: dict[str, int] = {}
    for j, x in enumerate(kb):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(kb)) - 1
    row, rows = full, []
    for _, x in ka:
        match = row & places[x]
        row = ((row + match) | (row - match)) & full
        rows.append(row)
    # Back from the last row: a line is on the alignment where its row has one more zero bit.
    found, upto = set(), full
    for k in range(len(ka) - 1, -1, -1):
        now = (~rows[k] & upto).bit_count()
        before = (~rows[k - 1] & upto).bit_count() if k else 0
        if now > before:
            found.add(ka[k][0])
            grown = ~rows[k] & upto
            top = 1 << (grown.bit_length() - 1)
            upto = top - 1
    return found


def site_lines(texts: list[str], neighbours: list[list[str]]) -> set[int]:
    """Places of the lines that all neighbours share, of which ``WITNESSES`` at least are no copies."""
    common, witnesses = set(range(len(texts))), 0
    for other in neighbours:
        found = shared_lines(texts, other)
        if len(found) < COPY_SHARE * len(texts):
            common &= found
            witnesses += 1
    return common if witnesses >= WITNESSES else set()


def main_text(lines: list[tuple[str, str]], neighbours: list[list[tuple[str, str]]], further: list[list[tuple[str, str]]] = []) -> str:
    """The page's text, given its (part, text) lines, those of its neighbours, and those of the neighbours beyond."""
    body = [t for p, t in lines if p == "body"]
    if body:
        gone = site_lines(body, [[t for _, t in other] for other in [*neighbours, *further]])
        return "\n".join(t for i, t in enumerate(body) if i not in gone)
    rest = [(p, t) for p, t in lines if p != "chrome"]
    texts, gone = [t for _, t in rest], set()
    for other in neighbours:
        found = shared_lines(texts, [t for p, t in other if p != "chrome"])
        if len(found) < COPY_SHARE * len(texts):
            gone |= found
    left = [x for i, x in enumerate(rest) if i not in gone]
    likely = [t for p, t in left if p == "likely"]
    return "\n".join(likely or [t for _, t in left])


SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html).

    A null or empty html gives an empty text; a null url counts as an empty host. Repeated rows are
    extracted each. An empty table gives no rows. Other columns are not read.
    """
    small_batches(pages.sparkSession, 64)
    host, path = parts(F.col("url"))
    order = ["host", "path", "page_id"]
    rows = pages.select(F.col("page_id").cast("long"), "url", "html", host.alias("host"), path.alias("path"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            # The page in the middle of ``near`` has all its neighbours; None: no page.
            near: deque = deque([None] * (2 * NEAREST + 1), 2 * NEAREST + 1)
            for row in chain(rows_of(batches, "page_id", "url", "html", "host"), [None] * NEAREST):
                near.append(row and (row[3], row[0], row[1], blocks(row[2]) if row[2] else []))
                now = near[NEAREST]
                if now is not None:
                    around = [(abs(i - NEAREST), x[3]) for i, x in enumerate(near) if i != NEAREST and x is not None and x[0] == now[0]]
                    text = main_text(now[3], [x for far, x in around if far == 1], [x for far, x in around if far > 1])
                    yield now[1], now[2], text, len(text)

        yield from in_batches(out(), SCHEMA)

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(task, "page_id long, url string, text string, n_chars long")

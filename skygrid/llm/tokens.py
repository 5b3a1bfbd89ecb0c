"""Token ids as Parquet files (operator 1), and the encoder that packing uses too.

Texts are sorted by id first and encoded afterwards, in the tasks that write. A file holds one row
per document: ``shard`` and ``shard_start`` (the number of the file and of the ids before the
document in it), ``doc_id``, ``n_tokens``, ``tokens``. Ids are 16-bit dictionary codes (the writer's
dictionary holds a whole 50k vocabulary), lengths and positions are delta encoded, row groups are
small, and pages carry an index: a read of a few documents or of the lengths alone skips the rest.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrid.llm.common import BROADCAST_ROWS, rows_of, small_batches, worker_state, written

END_ID = 2
TOKENIZER = "byte_bpe_50k.json"

#: Row groups of 32 MB and pages of 64 KB; version 2 pages delta-encode what has no dictionary.
FILE_OPTIONS = {
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "true",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.column.index.access": "true",
    "compression": "zstd",
}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


#: Encoded pieces a worker keeps; about 200 bytes each.
KEPT_PIECES = 1_000_000


class Encoder:
    """Ids of whole texts by the tokenizers library, as little-endian 32-bit bytes.

    The byte-level pattern always breaks before a space that a non-space follows, so a text is cut
    there and each piece is encoded once and kept. Other texts (runs of white space with spaces in
    them) are cut by the pattern itself. Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(path).model
        self.cut = regex.compile(public_tokenizers.PATTERN).findall
        self.loose = regex.compile(r" (?:\s|\Z)").search
        # The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for
        # code points from 256 on, in order.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        rest = (b for b in range(256) if b not in set(shown))
        self.alphabet = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(rest)}
        encoder = self

        class Pieces(dict):
            def __missing__(self, piece: str) -> bytes:
                # Letters after a space are one word of the pattern.
                words = [" " + piece] if piece.isalpha() else encoder.cut(" " + piece)
                self[piece] = ids = encoder.ids_of(words)
                return ids

        self.pieces = Pieces()

    def ids_of(self, words: list[str]) -> bytes:
        ids = [t.id for x in words for t in self.model.tokenize(x.encode("utf-8", "replace").decode("latin-1").translate(self.alphabet))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def by_pattern(self, text: str) -> bytes:
        return self.ids_of(self.cut(text))

    def encode(self, text: str) -> bytes:
        if len(self.pieces) > KEPT_PIECES:
            self.pieces.clear()
        if not text:
            return b""
        if self.loose(text):
            return self.by_pattern(text)
        first, *rest = text.split(" ")
        return (self.by_pattern(first) if first else b"") + b"".join(map(self.pieces.__getitem__, rest))


def encoder(path: str) -> Encoder:
    held = worker_state("encoders", dict)
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def crc32_ids(ids: bytes) -> int:
    """Unsigned crc32 of ids given as little-endian 32-bit bytes."""
    return zlib.crc32(ids)


FILE_SCHEMA = T.StructType([
    T.StructField("shard", T.IntegerType()),
    T.StructField("shard_start", T.LongType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("tokens", T.ArrayType(T.IntegerType(), False)),
])


def _list_batch(arrays: list[list], ids: list[bytes], schema: pa.Schema) -> pa.RecordBatch:
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype("int32")
    values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
    lists = pa.ListArray.from_arrays(pa.array(ends), values)
    return pa.RecordBatch.from_arrays([*(pa.array(a, f.type) for a, f in zip(arrays, schema)), lists.cast(schema[-1].type)], schema=schema)


_ARROW_FILE = pa.schema([("shard", pa.int32()), ("shard_start", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("tokens", pa.list_(pa.int32()))])


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every text of ``docs`` (doc_id, text) and write the ids in ascending doc_id order.

    A null text is empty and gives the end id alone. Rows of one doc_id follow one another, ordered
    by their text's hash; a null doc_id comes first. An empty table writes an empty file. Other
    columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    end = np.array([end_id], "<u4").tobytes()

    def encode_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, shard, start = encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids, starts, ids, size = [], [], [], 0

        def out() -> pa.RecordBatch:
            return _list_batch([[shard] * len(ids), starts, doc_ids, [len(x) // 4 for x in ids]], ids, _ARROW_FILE)

        for doc_id, text in rows_of(batches, "doc_id", "text"):
            x = model.encode(text or "") + end
            doc_ids.append(doc_id)
            starts.append(start)
            ids.append(x)
            start += len(x) // 4
            size += len(x)
            if size > 4 << 20:
                yield out()
                doc_ids, starts, ids, size = [], [], [], 0
        if ids:
            yield out()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    rows.mapInArrow(encode_task, FILE_SCHEMA).write.options(**FILE_OPTIONS).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files with ``start``: the ids of all documents before a document, over all files.

    The sum over files needs the last row of each (their number is that of the writing tasks).
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    lengths = files.groupBy("shard").agg(F.max(F.col("shard_start") + F.col("n_tokens")).alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    offsets = written(lengths.select("shard", before.alias("shard_offset")), "shard-offsets")
    if offsets.count() <= BROADCAST_ROWS:  # one row per file: else the ids would be shuffled for it
        offsets = F.broadcast(offsets)
    return files.join(offsets, "shard").withColumn("start", F.col("shard_offset") + F.col("shard_start"))


def with_crc(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, counted and summed from the stored ids themselves."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            values, ends = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
            crc = [crc32_ids(values[s:e].tobytes()) for s, e in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "tokens").mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")

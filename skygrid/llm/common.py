"""What the operators share: scratch tables, Arrow settings, words, checked broadcasts."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterable, Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.session import scratch_path

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()`` and ``bytes.strip()`` use the same six.
BLANKS = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A side of at most so many rows of a few numbers is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 1_000_000


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Keep Arrow batches of long texts small, so that a task holds a few MB of them at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


#: The folders of scratch tables.
_TABLES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def written(df: DataFrame, name: str, onto: DataFrame | None = None) -> DataFrame:
    """Write to the shared folder and read back: it cuts lineage and survives lost executors. Rows are added
    to the written table ``onto``, if there is one: what is returned takes its place."""
    spark = df.sparkSession
    path = scratch_path(spark, name) if onto is None else _TABLES.pop(onto)
    df.write.mode("append").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _TABLES[table] = path
    return table


def parted(df: DataFrame, name: str, by: Column, parts: int) -> list[DataFrame]:
    """Written tables, one for each value of ``by`` from 0 to ``parts`` - 1, which are discarded one by one."""
    if parts == 1:
        return [written(df, name)]
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.withColumn("part", by).write.partitionBy("part").parquet(path)
    context, tables = spark.sparkContext, []
    for part in range(parts):
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{path}/part={part}")
        if folder.getFileSystem(context._jsc.hadoopConfiguration()).exists(folder):
            tables.append(spark.read.schema(df.schema).parquet(f"{path}/part={part}"))
            _TABLES[tables[-1]] = f"{path}/part={part}"
    return tables or [spark.createDataFrame([], df.schema)]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself if it is a written table, else written."""
    return df if df in _TABLES else written(df, name)


def narrowed(df: DataFrame, rows: int, each: int) -> DataFrame:
    """``df``, known to make about so many rows, in tasks of ``each`` of them; eight at least."""
    return df.coalesce(8 + rows // each)


def discard(*tables: DataFrame | None) -> None:
    """Delete the files of written tables that no later read needs: whatever was made of them is written
    too. Anything but a written table is left alone."""
    for table in tables:
        path = _TABLES.pop(table, None) if table is not None else None
        if path is not None:
            context = table.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def lower_ascii(column: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(column, UPPER, LOWER)


def apart(docs: DataFrame, used: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but the used ones under names that clash with nothing, and the columns
    that give the caller's names back."""
    held = [c if c in used else f"_column_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*held), [F.col(h).alias(c) for h, c in zip(held, docs.columns)]


def semi(df: DataFrame, ids: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``ids``; ids are broadcast if they are counted to be few."""
    few = ids.count() <= BROADCAST_ROWS
    return df.join(F.broadcast(ids) if few else ids.hint("merge"), on, "left_semi")


def worker_state(name: str, make):
    """Something a Python worker keeps between its tasks.

    Functions travel by value, so their module's globals are new in every task; a module of the
    worker process outlives them.
    """
    home = sys.modules.setdefault("skygrid_worker_state", types.ModuleType("skygrid_worker_state"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """One tuple of Python values per row."""
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))


def in_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 2048, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches bounded by number and by the bytes of their binary and list values."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(v.nbytes if isinstance(v, np.ndarray) else len(v) for v in row if isinstance(v, (bytes, str, np.ndarray)))
        if len(held) >= most or size >= most_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

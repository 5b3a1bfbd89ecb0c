"""MinHash near-dedup (operator 7) with tensored banding.

Two small collections of ``HALVES`` hashes, each of two minwise values, are computed per document:
32 minwise values in all. A pair of one hash from each collection is a table key of four minwise
values, and all pairs give 64 tables: two documents meet if they agree on some hash of the first
collection and on some of the second. At similarity 0.8 they do with probability
(1 - (1 - 0.64)^8)^2 = 0.9994. Only hashes that another document has as well are paired up.

A table key that many documents share is met by differences from a centre (``crowd_pairs``), not by
all pairs: near copies of one text that mostly do not reach the similarity would make them all.

Documents with the same shingle set are one class from the start; classes that meet are checked on
their full sets, and connected classes form a component. Before that, four bits of each of 64 minwise
values (32 of them computed for this alone) rule out pairs that are far from similar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygrid.llm.common import BROADCAST_ROWS, discard, narrowed, rows_of, semi, small_batches, worker_state, written
from skygrid.llm.groups import linked, shared

HALVES = 8
#: Fixed odd multipliers and offsets of the minwise functions, from a fixed seed.
_RANDOM = np.random.default_rng(7)
MULTIPLIERS = _RANDOM.integers(1, 1 << 62, 8 * HALVES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _RANDOM.integers(0, 1 << 62, 8 * HALVES, dtype=np.uint64)
PLACES = _RANDOM.integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
KEPT_WORDS = 200_000
#: At similarity 0.8, 12 of 64 minwise values are expected to differ, with a standard deviation of 3.1.
MOST_DIFFERING = 25
#: Members whose shingles make a crowd's centre, and copies of a centre that its members are dealt to.
CENTRE_OF, SALTS = 32, 32


def _word_hashes():
    import xxhash

    class Hashes(dict):
        def __missing__(self, word: bytes) -> int:
            self[word] = h = xxhash.xxh3_64_intdigest(word)
            return h

    return Hashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``size`` words; a shorter text is one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known = worker_state("word_hashes", _word_hashes)
    if len(known) > KEPT_WORDS:
        known.clear()
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(h) < size:
        return _mixed(np.array([(h * PLACES[: len(h)]).sum() + np.uint64(len(h))], np.uint64))
    return np.unique(_mixed(sum((h[k : len(h) - size + 1 + k] * PLACES[k] for k in range(size)), np.uint64(0))))


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The smallest of the shingles' upper 32 bits under each function."""
    if len(shingles) * len(MULTIPLIERS) > 1 << 20:
        return np.array([((shingles * m + o) >> np.uint64(32)).min() for m, o in zip(MULTIPLIERS, OFFSETS)], np.uint64)
    return ((shingles[None, :] * MULTIPLIERS[:, None] + OFFSETS[:, None]) >> np.uint64(32)).min(axis=1)


LOW = ["low1", "low2", "low3", "low4"]
SKETCH = ["n_shingles", "set1", "set2", *LOW, *(f"a{i}" for i in range(HALVES)), *(f"b{i}" for i in range(HALVES))]


def _sketch(shingles: np.ndarray) -> list[int]:
    import xxhash

    m = minwise(shingles)
    keyed = m[: 4 * HALVES]
    halves = _mixed(((keyed[0::2] << np.uint64(32)) | keyed[1::2]) * PLACES[: 2 * HALVES])
    low = (m & np.uint64(15)).reshape(len(LOW), 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
    digest = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.uint64)
    return [len(shingles), *np.concatenate([digest, np.bitwise_or.reduce(low, axis=1), halves]).view(np.int64).tolist()]


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id and the sketch of every document; those without words have zeros and n_shingles 0."""
    small_batches(docs.sparkSession, 128)
    empty = [0] * len(SKETCH)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t, size) for t in b.column(1).to_pylist()]
            rows = [_sketch(s) if len(s) else empty for s in sets]
            columns = np.array(rows, np.int64).reshape(len(rows), len(SKETCH)).T
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, columns)], names=["doc_id", *SKETCH])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, "doc_id long, " + ", ".join(f"{c} long" for c in SKETCH))


def similarity_check(docs: DataFrame, size: int, percent: int):
    """Verify pairs (a, b) of doc_ids on full shingle sets: 100 * intersection >= percent * union."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingle_set(t, size).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], names=["id", "shingles"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for a, b, x, y in rows_of([batch], "a", "b", "x", "y"):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    links.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def verify(pairs: DataFrame) -> DataFrame:
        asked = pairs.count()
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
        read = docs.select(F.col("doc_id").cast("long"), "text")
        # Few ids are sent as they are; it takes no shuffle to make them distinct.
        texts = read.join(F.broadcast(ids), "doc_id", "left_semi") if 2 * asked <= BROADCAST_ROWS else read.join(ids.distinct().hint("merge"), "doc_id", "left_semi")
        found = written(texts.mapInArrow(sets, "id long, shingles binary"), "near-sets")
        x = found.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
        y = found.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
        first = (F.broadcast(pairs) if asked <= BROADCAST_ROWS else pairs).join(x, "a")
        links = written(narrowed(first.join(y, "b"), asked, 100).mapInArrow(check, "a long, b long"), "links")
        discard(found)
        return links

    return verify


def differing(x: str, y: str) -> Column:
    """How many of the 64 minwise values of two documents differ in their low bits."""

    def in_column(c: str) -> Column:
        d = F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    return sum((in_column(c) for c in LOW), F.lit(0))


def crowd_pairs(docs: DataFrame, size: int, percent: int):
    """Pairs (x, y) of a crowd's ids that may link, by how their sets differ from the crowd's centre.

    The centre holds the shingles of most of ``CENTRE_OF`` members. Let D be a set's difference from it,
    of d shingles. Two sets of n shingles differ in as many places as their differences do, and link
    if those are at most r (n_x + n_y), r = (1 - t) / (1 + t). So

    * with d_x + d_y below that bound they link for certain. Whoever has such a link has one with the
      member of the largest r n - d, and that one is enough for the groups;
    * else their differences share (d_x + d_y - r (n_x + n_y)) / 2 shingles. They meet on those, rarest
      first, and go as soon as too few are left after the first that they share.

    No link is lost, whatever the centre is.
    """
    share = (100 - percent) / (100 + percent)
    longest = share * (1 + 100 / percent)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingle_set(t, size).view(np.int64) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int64()))], names=["id", "shingles"])

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, centre = (b.column(b.schema.get_field_index(c)) for c in ("shingles", "centre"))
            d = [np.setxor1d(x.values.to_numpy(), c.values.to_numpy() if c.is_valid else [], assume_unique=True).astype(np.int64) for x, c in zip(own, centre)]
            keep = [b.column(b.schema.get_field_index(c)) for c in ("crowd", "id", "label")]
            n = pa.array([len(x.values) for x in own], pa.int64())
            yield pa.RecordBatch.from_arrays([*keep, n, pa.array(d, pa.list_(pa.int64()))], names=["crowd", "id", "label", "n", "diff"])

    def pairs(members: DataFrame) -> DataFrame:
        ids = written(narrowed(members.select(F.col("id").alias("doc_id")).distinct(), members.count(), 10_000), "crowd-ids")
        texts = semi(docs.select(F.col("doc_id").cast("long"), "text"), ids, "doc_id").dropDuplicates(["doc_id"])
        found = written(texts.mapInArrow(sets, "id long, shingles array<long>"), "crowd-sets")
        place = F.row_number().over(Window.partitionBy("crowd").orderBy(F.xxhash64("id")))
        some = members.withColumn("place", place).filter(F.col("place") <= CENTRE_OF).join(found, "id")
        held = some.select("crowd", F.explode("shingles").alias("e")).groupBy("crowd", "e").agg(F.count("*").alias("held"))
        sizes = some.groupBy("crowd").agg(F.count("*").alias("asked"))
        centres = held.join(sizes, "crowd").filter("2 * held > asked").groupBy("crowd").agg(F.collect_list("e").alias("centre"))
        # A crowd may hold a third of all documents: its members are dealt to SALTS copies of its centre.
        centres = centres.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(found, "id").join(centres, ["crowd", "salt"], "left")
        apart = salted.select("crowd", "id", "label", "shingles", "centre").mapInArrow(differences, "crowd long, id long, label long, n long, diff array<long>")
        apart = written(apart.withColumn("d", F.size("diff")), "crowd-differences")
        slack = share * F.col("n") - F.col("d")
        hubs = apart.groupBy("crowd").agg(F.max(F.struct(slack.alias("slack"), F.col("id"), F.col("label"))).alias("hub"))
        certain = apart.join(F.broadcast(hubs) if hubs.count() <= BROADCAST_ROWS else hubs, "crowd").filter((slack + F.col("hub.slack") >= -1e-6) & (F.col("label") != F.col("hub.label")))
        certain = certain.select(F.col("id").alias("x"), F.col("hub.id").alias("y"))
        rows = apart.select("crowd", "id", "label", "n", "d", F.explode("diff").alias("e"))
        often = rows.groupBy("crowd", "e").agg(F.count("*").alias("often")).filter("often > 1")
        # The rarest of a document are those that it alone has; they only count as places passed.
        own, order = Window.partitionBy("crowd", "id"), Window.partitionBy("crowd", "id").orderBy("often", "e")
        ranked = rows.join(often, ["crowd", "e"]).withColumn("p", F.col("d") - F.count("*").over(own) + F.row_number().over(order) - 1)
        ranked = written(ranked.filter(F.col("p") <= longest * F.col("n") + 1e-6).drop("often"), "crowd-places")
        x, y = ranked.alias("x"), ranked.alias("y")
        left = F.least(F.col("x.d") - F.col("x.p"), F.col("y.d") - F.col("y.p"))
        need = (F.col("x.d") + F.col("y.d") - share * (F.col("x.n") + F.col("y.n"))) / 2
        few, many = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
        same = (F.col("x.crowd") == F.col("y.crowd")) & (F.col("x.e") == F.col("y.e")) & (F.col("x.id") > F.col("y.id")) & (F.col("x.label") != F.col("y.label"))
        met = x.join(y, same & (need > -1e-6) & (left >= need - 1e-6) & (100 * few >= percent * many))
        out = written(certain.unionByName(met.select(F.col("x.id").alias("x"), F.col("y.id").alias("y"))), "crowd-pairs")
        discard(ids, found, apart, ranked)
        return out

    return pairs


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Words are what white space of ASCII separates, A-Z lower-cased. A document without words has no
    shingles and no links. Repeated rows get a row each; rows with one doc_id count as one node. A
    null doc_id is its own component: component_id null, kept. Empty tables give no rows. Other
    columns are not read.
    """
    rows = written(sketches(docs, size), "sketches")
    linkable = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(
        linkable.groupBy("set1", "set2").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"), *[F.first(c).alias(c) for c in SKETCH if c not in ("set1", "set2")]), "classes"
    )
    halves = F.explode(F.array(*[F.struct(F.lit(side).alias("side"), F.col(f"{side}{i}").alias("key")) for side in "ab" for i in range(HALVES)]))
    met = shared(classes.select("id", halves.alias("half")).select(F.col("half.key").alias("key"), "id", F.col("half.side").alias("side")))
    sides = met.groupBy("id").agg(*[F.collect_set(F.when(F.col("side") == s, F.col("key"))).alias(s) for s in "ab"])
    table_keys = F.flatten(F.transform("a", lambda a: F.transform("b", lambda b: F.xxhash64(a, b))))
    keys = sides.select(F.explode(table_keys).alias("key"), "id")

    def close(x: str, y: str) -> Column:
        """Set sizes allow the similarity, and few of the minwise values differ."""
        few, many = F.least(f"{x}.n_shingles", f"{y}.n_shingles"), F.greatest(f"{x}.n_shingles", f"{y}.n_shingles")
        return (100 * few >= percent * many) & (differing(x, y) <= MOST_DIFFERING)

    def meeting(x: str, y: str) -> Column:
        """The key of the first hashes of each collection that agree."""

        def first(side: str) -> Column:
            return F.coalesce(*[F.when(F.col(f"{x}.{side}{i}") == F.col(f"{y}.{side}{i}"), F.col(f"{x}.{side}{i}")) for i in range(HALVES)])

        return F.xxhash64(first("a"), first("b"))

    halves_of = [f"{side}{i}" for side in "ab" for i in range(HALVES)]
    traits = classes.groupBy("id").agg(*[F.first(c).alias(c) for c in ("n_shingles", *LOW, *halves_of)])
    labels = linked(keys, traits, close, similarity_check(docs, size, percent), meeting, differing, crowd_pairs(docs, size, percent), read_once=met)
    named = classes.join(labels, "id", "left").filter("n > 1 OR label IS NOT NULL").select("set1", "set2", F.coalesce("label", "id").alias("component_id"))
    named = written(named, "components")
    discard(classes)
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = rows.join(named, ["set1", "set2"], "left")
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def first_of_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents that are the smallest doc_id of their component; of repeated rows of one doc_id all."""
    gone = near_duplicates(docs, size, percent).filter("NOT kept").select("doc_id").distinct()
    return docs.join(written(gone, "copies"), "doc_id", "left_anti").select(*docs.columns)

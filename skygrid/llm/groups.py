"""Connected groups from shared keys, without all pairs of a key.

Rows (key, id) say that ids may belong together. The groups found are those that checking every pair
of ids with a common key would give:

1. In rounds, ids are paired with some ids of the largest groups of some of their keys, and the
   nearest by sketch are checked. At first every id is a group of its own, and a key's partner is a
   single id. Keys of few ids are left out: all their pairs that are near are made where the ids of a key
   are counted. Rounds go on while they link ids. Each makes at most ``KEYS * PARTNERS`` pairs an id, so
   a large group whose members link becomes one group, or nearly, at a cost that is linear in it.
2. A pair within a group needs no check. Of each key whose ids are still in several groups, ids
   outside the key's largest group are paired with all its ids of other groups, and checked. Keys of
   more than ``CROWD`` ids can be left to the caller, who knows what links can hold among so many.

Rounds only save pairs of the second step; what they leave out, it makes. Groups are labelled by their
smallest id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygrid.llm.common import BROADCAST_ROWS, discard, narrowed, semi, stored, written

#: Rounds of the first kind at most, an id's keys of one round, the ids of a key's largest group that
#: others are paired with, and the pairs an id has checked in a round.
ROUNDS, KEYS, PARTNERS, CHECKED = 8, 4, 16, 3
#: With so many pairs an id in keys of many ids, or fewer, rounds are not worth their passes.
SPARED = 64
#: More pairs than these are checked in two steps.
MANY = 100_000
#: Labels of so many ids are broadcast to their edges; more are shuffled.
FEW_LABELS = 125_000
#: Keys of more ids are a crowd.
CROWD = 64
#: Rounds end when fewer than this share of the ids that they paired were linked.
WORTH = 0.02


def connected(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(id, label, ...) of every id in ``edges`` (a, b): label is the smallest id it is connected with.

    ``labels`` are those of earlier edges, which need not be named again: edges then join groups, by
    their labels. Every round takes the smallest label among neighbours, then that label's own label;
    each is written, so that lineage stays short. Rounds go with the logarithm of a group's width.
    """
    asked = edges.count()
    small = F.broadcast if 2 * asked <= FEW_LABELS else lambda table: table

    def put(table: DataFrame, name: str) -> DataFrame:
        return written(narrowed(table, 2 * asked, 10_000), name)

    if labels is not None:
        for end in ("a", "b"):
            edges = edges.join(_few(labels.select(F.col("id").alias(end), F.col("label").alias(f"{end}_label"))), end, "left")
        edges = edges.select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")).filter("a <> b")
    both = put(edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b").distinct(), "edges")
    new = put(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("label")), "labels")
    while True:
        heard = both.join(small(new.select(F.col("id").alias("b"), "label")), "b").groupBy("a").agg(F.min("label").alias("heard"))
        low = heard.withColumnRenamed("a", "id").join(small(new), "id").select("id", F.col("label").alias("was"), F.least("label", "heard").alias("label"))
        jump = new.select(F.col("id").alias("label"), F.col("label").alias("further"))
        step = low.join(small(jump), "label").select("id", "was", F.least("label", "further").alias("label"))
        step = put(step, "labels")
        discard(new)
        new = step
        if step.filter("label <> was").isEmpty():
            break
    discard(both)
    if labels is None:
        return new
    joined = small(new.select(F.col("id").alias("label"), F.col("label").alias("to")))
    moved = labels.select("id", "label").join(joined, "label", "left").select("id", F.coalesce("to", "label").alias("label"))
    fresh = new.select("id", "label").join(_few(labels.select("id")), "id", "left_anti")
    out = written(moved.unionByName(fresh), "labels")
    discard(new)
    return out


def _few(table: DataFrame) -> DataFrame:
    """For a broadcast, if it is counted to be small."""
    return F.broadcast(table) if table.count() <= FEW_LABELS else table


def shared(keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` whose key has several rows."""
    several = written(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "shared-keys")
    out = written(semi(keys, several, "key"), "keys")
    discard(several)
    return out


def _first(keys: DataFrame) -> DataFrame:
    """The rows of keys that several ids share, every id being a group of its own: as ``_contested``."""
    several = keys.groupBy("key").agg(F.max("id").alias("top"), F.count("*").alias("n_ids")).filter("n_ids > 1")
    several = written(several, "shared-keys")
    met = F.broadcast(several) if several.count() <= BROADCAST_ROWS else several
    out = written(keys.join(met, "key").withColumn("label", F.col("id")).withColumn("size", F.lit(1).cast("long")), "contested")
    discard(several)
    return out


def _met(keys: DataFrame, traits: list[str], near: Callable[[str, str], Column], few: int, parts: int, crowded: Column | None) -> DataFrame:
    """key, top, n_ids, id of the ids of keys of more than ``few`` ids, as ``_first``; id, other, least of the
    pairs that are ``near`` of smaller keys, a row a key. One written table, made from one part of the keys
    after the other, so that shuffles stay small."""
    in_key = Window.partitionBy("key").orderBy("id")
    whole = in_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    large, own = F.col("n_ids") > few, F.struct("id", *traits)

    def near_ones(sized: DataFrame) -> DataFrame:
        """Every id with the next ones of its key, if those are few; ids of large keys with none."""
        ahead = F.collect_list(F.when(~large, own)).over(in_key.rowsBetween(1, few - 1))
        pairs = sized.select("key", "top", "n_ids", own.alias("x"), ahead.alias("ahead")).select("key", "top", "n_ids", "x", F.explode_outer("ahead").alias("y"))
        in_large = [F.when(large, F.col(c)).alias(c) for c in ("key", "top", "n_ids")]
        return pairs.filter(large | near("x", "y")).select(*in_large, F.col("x.id").alias("id"), F.col("y.id").alias("other"), F.least("x.least", "y.least").alias("least"))

    crowded, out = F.lit(False) if crowded is None else crowded, None
    for part in range(parts):
        some = keys.filter(F.pmod("key", F.lit(parts)) == part)
        counted = {"top": F.max("id").over(whole), "n_ids": F.count("*").over(whole)}
        out = written(near_ones(some.filter(~crowded).withColumns(counted).filter("n_ids > 1")), "met", out)
    # No task holds the rows of such a key: they are counted first, and the join may split them.
    counts = keys.filter(crowded).groupBy("key").agg(F.max("id").alias("top"), F.count("*").alias("n_ids")).filter("n_ids > 1")
    counts = written(counts, "crowded-keys")
    if not counts.isEmpty():
        sized = keys.filter(crowded).join(_few(counts), "key")
        none = [F.lit(None).cast(kind).alias(c) for c, kind in (("other", "long"), ("least", "int"))]
        out = written(sized.filter(large).select("key", "top", "n_ids", "id", *none), "met", out)
        out = written(near_ones(sized.filter(~large)), "met", out)
    discard(counts)
    return out


def linked(
    keys: DataFrame,
    traits: DataFrame,
    near: Callable[[str, str], Column],
    verify: Callable[[DataFrame], DataFrame],
    meeting: Callable[[str, str], Column] | None = None,
    distance: Callable[[str, str], Column] | None = None,
    crowd: Callable[[DataFrame], DataFrame] | None = None,
    few: int = 0,
    read_once: DataFrame | None = None,
    parts: int = 1,
    crowded: Column | None = None,
) -> DataFrame:
    """(id, label) of the ids that have a verified link; ``keys`` has distinct rows (key, id).

    ``traits`` has one row per id with what ``near`` and ``distance`` compare (columns of the aliases x
    and y): ``near`` must hold for every pair that ``verify`` accepts, and ``distance`` says which pairs
    are worth a check first. ``verify`` returns the rows of a DataFrame of pairs (a, b), a > b, that
    are true links; a written table is used as it is. ``meeting`` names one of the keys that two ids
    share: a pair with many common keys is then made under that one only. ``crowd`` returns (x, y), all pairs of ids with different labels
    that may link, of rows (crowd, id, label): the ids that share a crowded key are in one crowd.
    Keys of up to ``few`` ids are left out of rounds; all their pairs are made at once, in ``parts`` parts of
    the keys. Rows of ``keys`` then have the traits, too, among them ``least``, an int: two ids that link have
    in common at least the smaller one's number of keys. ``crowded`` holds for those whose key may have
    more rows than a task should hold. ``read_once`` is a written table that only ``keys`` reads.
    """
    spark = keys.sparkSession
    rounds = ROUNDS
    if few:
        start = _met(keys, [c for c in traits.columns if c != "id"], near, few, parts, crowded)
        rows = start.filter("other IS NULL").select("key", "id", "top", "n_ids", F.col("id").alias("label"), F.lit(1).cast("long").alias("size"))
        pairs = rows.agg(F.sum((F.col("n_ids") - 1) / 2)).first()[0] or 0
        if pairs <= SPARED * traits.count():
            rounds = 0
    else:
        rows = start = _first(keys)
    discard(read_once)
    labels, asked = None, None
    tables = [start]
    for turn in range(rounds):
        met = written(_round(rows, traits, near, distance, turn), "nearest")
        pairs = met.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
        if asked is not None:
            pairs = pairs.join(asked, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        tables += [met, pairs]
        asked = pairs if asked is None else asked.unionByName(pairs)
        if pairs.isEmpty():
            break
        found = stored(verify(pairs), "links")
        if found.isEmpty():
            discard(found)
            break
        was, labels = labels, connected(found, labels)
        joined = _groups_joined(was, labels)
        discard(was, found)
        rows = _contested(rows, labels)
        if joined < WORTH * met.select("x").distinct().count():
            break
    asked_all = (rows.filter(F.col("n_ids") <= CROWD) if crowd else rows).join(traits, "id")
    x, y = asked_all.filter("label <> top").alias("x"), asked_all.alias("y")
    once = F.col("x.key") == meeting("x", "y") if meeting else F.lit(True)
    if few:  # a pair once a key, however many groups the key has
        once = (F.col("y.label") == F.col("y.top")) | (F.col("x.id") > F.col("y.id"))
    rest = x.join(y, _apart("x", "y") & near("x", "y") & once)
    if few:
        rest = rest.select(F.col("x.id").alias("x"), F.col("y.id").alias("y"), F.least("x.least", "y.least").alias("least"))
        small = start.filter("other IS NOT NULL").select(F.col("id").alias("x"), F.col("other").alias("y"), "least")
        rest = rest.unionByName(small if labels is None else _between(small, labels))
        rest = rest.groupBy(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).agg(F.count("*").alias("n"), F.first("least").alias("least"))
        rest = rest.filter("n >= least").select("a", "b")
    else:
        rest = rest.select(F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b")).distinct()
    if crowd:
        many = written(rows.filter(F.col("n_ids") > CROWD).select(F.col("top").alias("crowd"), "id", "label").distinct(), "crowds")
        tables.append(many)
        tables.append(crowd(many))
        rest = rest.unionByName(tables[-1].select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))).distinct()
    rest = written(rest if asked is None else rest.join(asked, ["a", "b"], "left_anti"), "pairs")
    discard(rows)
    if few and rest.count() > MANY:
        # Most may be pairs of one group: with one checked for each id, few ends are in different groups.
        some = written(rest.groupBy("a").agg(F.min("b").alias("b")), "pairs")
        found = stored(verify(some), "links")
        if not found.isEmpty():
            was, labels, full = labels, connected(found, labels), rest
            apart = _between(full.select(F.col("a").alias("x"), F.col("b").alias("y")), labels).toDF("a", "b")
            rest = written(apart.join(some, ["a", "b"], "left_anti"), "pairs")
            discard(was, full)
        discard(some, found)
    if not rest.isEmpty():
        more = stored(verify(rest), "links")
        if not more.isEmpty():
            was, labels = labels, connected(more, labels)
            discard(was)
        discard(more)
    discard(rest, *tables)
    return spark.createDataFrame([], "id long, label long") if labels is None else labels.select("id", "label")


def _between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (x, y) whose ends are in different groups."""
    for end in ("x", "y"):
        pairs = pairs.join(_few(labels.select(F.col("id").alias(end), F.col("label").alias(f"{end}_label"))), end, "left")
    return pairs.filter(F.coalesce("x_label", "x") != F.coalesce("y_label", "y")).drop("x_label", "y_label")


def _groups_joined(was: DataFrame | None, now: DataFrame) -> int:
    """How many groups fewer there are, ids without a label being groups of their own. Every group has one id
    that is its label."""
    before, after = (0 if labels is None else labels.filter("id <> label").count() for labels in (was, now))
    return after - before


def _named(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """key, id, label of ``rows``; an id without a label is a group of its own."""
    if labels is None:
        return rows.select("key", "id", F.col("id").alias("label"))
    few = labels.count() <= BROADCAST_ROWS
    labels = labels.select("id", "label")
    return rows.select("key", "id").join(F.broadcast(labels) if few else labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _contested(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of keys whose ids are in several groups: with label, the key's largest label and
    how many ids that and the key have. A key that is in one group stays so: ``rows`` are replaced."""
    named = _named(rows, labels)
    per = named.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("labels"), F.sum("n").alias("n_ids"))
    several = per.filter("labels > 1").select("key", F.col("top.label").alias("top"), F.col("top.n").alias("size"), "n_ids")
    out = written(named.join(several, "key"), "contested")
    discard(rows)
    return out


def _apart(x: str, y: str) -> Column:
    return (F.col(f"{x}.key") == F.col(f"{y}.key")) & (F.col(f"{x}.label") != F.col(f"{y}.label"))


def _round(rows: DataFrame, traits: DataFrame, near: Callable[[str, str], Column], distance: Callable[[str, str], Column] | None, turn: int) -> DataFrame:
    """(x, y): ids outside their key's largest group with the ``CHECKED`` nearest of some of its ids."""
    first = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("size"), F.xxhash64("key", F.lit(turn))))
    x = rows.filter("label <> top").withColumn("place", first).filter(F.col("place") <= KEYS).join(traits, "id").alias("x")
    first = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("id", F.lit(turn))))
    y = rows.filter("label = top").withColumn("place", first).filter(F.col("place") <= PARTNERS).join(traits, "id").alias("y")
    far = distance("x", "y") if distance else F.lit(0)
    pairs = x.join(y, _apart("x", "y") & near("x", "y")).select(F.col("x.id").alias("x"), F.struct(far.alias("far"), F.xxhash64("y.id", F.lit(turn)), F.col("y.id").alias("y")).alias("met"))
    nearest = pairs.groupBy("x").agg(F.slice(F.sort_array(F.collect_set("met")), 1, CHECKED).alias("met"))
    return nearest.select("x", F.explode("met.y").alias("y"))

"""A Merkle manifest whose parents keep their hash states (operator 11).

Rows are leaves; every 8 consecutive ones of a section have a parent, and so on up to the section's
subroot; subroots have a tree of their own up to the root. A child's digest is 64 letters, just one
block of SHA-256, so the hash of a parent passes through one state before each child. A parent keeps
copies of these. To fold a changed leaf upwards, its parent's state before that slot goes on with the
new digest and the siblings to the right; those to the left are never read again.

States are eight 32-bit numbers, which the hash libraries do not give out, so the block function is
written out here for many nodes at once.

Trees are cut into blocks of 4,096 nodes of a level, the leaves of one node four levels up. A task
builds or folds one block, whatever the sizes of sections; the next four levels start from the blocks'
top nodes. A fold meets its block's nodes and the few above it.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygrid.llm.common import BROADCAST_ROWS, written
from skygrid.operators.ranks import numbered

FAN = 8
#: Levels that a task builds: blocks of FAN ** LEVELS nodes.
LEVELS = 4
#: The tree over the sections' subroots. Sections are numbered from 0 in their order.
TOP = -1


# SHA-256 -----------------------------------------------------------------------------------------


def _fraction(n: int, root: int) -> int:
    """The first 32 bits behind the point of n's square or cube root."""
    scaled = n << (32 * root)
    low = int(scaled ** (1 / root)) if root == 3 else math.isqrt(scaled)
    while low**root > scaled:
        low -= 1
    while (low + 1) ** root <= scaled:
        low += 1
    return low & 0xFFFFFFFF


_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, math.isqrt(p) + 1))]
START = np.array([_fraction(p, 2) for p in _PRIMES[:8]], np.uint32)
ROUND = np.array([_fraction(p, 3) for p in _PRIMES[:64]], np.uint32)


def _turned(x: np.ndarray, *by: int) -> np.ndarray:
    """Exclusive or of x turned right by each number of bits."""
    out = (x >> np.uint32(by[0])) | (x << np.uint32(32 - by[0]))
    for n in by[1:]:
        out ^= (x >> np.uint32(n)) | (x << np.uint32(32 - n))
    return out


def compress(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """SHA-256's block function: states (8, n) after blocks of 16 words (16, n)."""
    w = list(blocks)
    a, b, c, d, e, f, g, h = states
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(w[i - 16] + (_turned(x, 7, 18) ^ (x >> np.uint32(3))) + w[i - 7] + (_turned(y, 17, 19) ^ (y >> np.uint32(10))))
        t = h + _turned(e, 6, 11, 25) + (g ^ (e & (f ^ g))) + ROUND[i] + w[i]
        u = _turned(a, 2, 13, 22) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h])


_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def letters(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of bytes as lowercase hex letters (n, 64)."""
    out = np.empty((*digests.shape[:-1], 64), np.uint8)
    out[..., 0::2], out[..., 1::2] = _HEX[digests >> 4], _HEX[digests & 15]
    return out


def _words(digests: np.ndarray) -> np.ndarray:
    """The block that a digest's letters fill, as (16, n)."""
    return np.ascontiguousarray(letters(digests).view(">u4").astype(np.uint32).T)


def _finish(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of what has filled ``blocks`` whole blocks."""
    end = np.zeros((16, states.shape[1]), np.uint32)
    end[0], end[15] = 0x80000000, blocks * 512
    return np.ascontiguousarray(compress(states, end).T).astype(">u4").view(np.uint8)


class Parents(NamedTuple):
    """Nodes of a level: digests (n, 32), number of children, states before each slot, children."""

    digests: np.ndarray
    sizes: np.ndarray
    states: np.ndarray  # (n, 8 slots, 8 numbers)
    children: np.ndarray  # (n, 8 slots, 32)


def parents(children: np.ndarray) -> Parents:
    """The parents of a level's consecutive digests; the last one may have fewer children."""
    n = -(-len(children) // FAN)
    padded = np.zeros((n * FAN, 32), np.uint8)
    padded[: len(children)] = children
    padded = padded.reshape(n, FAN, 32)
    sizes = np.full(n, FAN)
    sizes[-1] = len(children) - FAN * (n - 1)
    kept = np.zeros((n, FAN, 8), np.uint32)
    states = np.repeat(START[:, None], n, 1)
    for slot in range(FAN):
        kept[:, slot] = states.T
        here = n if sizes[-1] > slot else n - 1  # only the last may lack the slot
        if here:
            states[:, :here] = compress(states[:, :here], _words(padded[:here, slot]))
    return Parents(_finish(states, sizes.astype(np.uint32)), sizes, kept, padded)


def resume(replaced: np.ndarray, slots: np.ndarray, level: Parents, at: np.ndarray) -> np.ndarray:
    """Digests of the parents ``at`` with child ``slots`` replaced, from the state before that slot."""
    states = np.ascontiguousarray(level.states[at, slots].T)
    sizes = level.sizes[at]
    for slot in range(int(slots.min()), int(sizes.max())):
        on = np.flatnonzero((slots <= slot) & (slot < sizes))
        if on.size:
            new = np.where((slots[on] == slot)[:, None], replaced[on], level.children[at[on], slot])
            states[:, on] = compress(states[:, on], _words(new))
    return _finish(states, sizes.astype(np.uint32))


# Leaves ------------------------------------------------------------------------------------------


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the values in order: ``-`` for null, else number of bytes, colon, text."""
    texts = [v.cast("string") for v in values]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256))


class Leaves(NamedTuple):
    """``rows``: id, section, pos, leaf, changed. ``sections``: section, section's value, leaves."""

    rows: DataFrame
    sections: DataFrame


def leaves(docs: DataFrame, columns: list[str], id_column: str = "doc_id", section: str = "lang", changed: dict[str, Column] | None = None) -> Leaves:
    """Digests of the rows of ``docs`` over ``columns`` and their places in the sections' order.

    Rows of a section ascend by id, a null id first; rows of one id by digest. A null section is one
    of its own and comes first. ``changed`` gives other values of columns; ``changed`` in the result
    is the digest with these. Nothing else of ``docs`` is read, so names do not clash.
    """
    value = {c: F.col(c) for c in columns}
    digests = docs.select(
        F.col(section).alias("value"),
        F.col(id_column).alias("id"),
        leaf_digest(list(value.values())).alias("leaf"),
        leaf_digest(list((value | (changed or {})).values())).alias("changed"),
    )
    order = ["value", "id", "leaf"]
    ordered = digests.repartitionByRange(*order).sortWithinPartitions(*order)
    # Below its partition's number, this id counts a partition's rows in their order.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = written(ordered.select("*", F.spark_partition_id().alias("range"), place.alias("place")), "merkle-leaves")
    runs = ordered.groupBy("value", "range").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    # One row per range of a section.
    earlier = F.sum("n").over(Window.partitionBy("value").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    runs = written(runs.withColumn("before", F.coalesce(earlier, F.lit(0))), "merkle-runs")
    sections = written(numbered(runs.groupBy("value").agg(F.sum("n").alias("leaves")), ["value"], "section"), "merkle-sections")
    starts = runs.select(F.col("value").alias("v"), F.col("range").alias("r"), (F.col("before") - F.col("first")).alias("shift"))
    numbers = sections.select(F.col("value").alias("sv"), "section", "leaves")
    starts = starts.join(numbers, F.col("v").eqNullSafe(F.col("sv")))
    if starts.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    rows = ordered.join(starts, (F.col("range") == F.col("r")) & F.col("value").eqNullSafe(F.col("v")))
    return Leaves(rows.select("id", "section", (F.col("place") + F.col("shift")).alias("pos"), "leaf", "changed", "leaves"), sections)


# Trees -------------------------------------------------------------------------------------------

NODE = "tree long, level int, node long, leaves long, digest binary, size int, states binary, children binary"
_NODE = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("node", pa.int64()), ("leaves", pa.int64()), ("digest", pa.binary()), ("size", pa.int32()), ("states", pa.binary()), ("children", pa.binary())])


def height(n: int) -> int:
    """Levels above n leaves: a lone leaf is its own root."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


def _height(leaves_column: Column) -> Column:
    """The same as a column, exact: powers of 8 are counted, not logarithms."""
    return F.size(F.filter(F.array(*[F.lit(FAN**k) for k in range(21)]), lambda p: p < leaves_column))


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _build_block(block: pa.Table) -> pa.Table:
    """All nodes up to LEVELS above the nodes of a block."""
    block = block.sort_by("node")
    tree, base, first, n = (block.column(c)[0].as_py() for c in ("tree", "level", "node", "leaves"))
    digests, out = _digests(block.column("digest")), []
    for level in range(base + 1, min(base + LEVELS, height(n)) + 1):
        first //= FAN
        p = parents(digests)
        digests = p.digests
        for i in range(len(digests)):
            size = int(p.sizes[i])
            out.append((tree, level, first + i, n, digests[i].tobytes(), size, p.states[i, :size].astype(">u4").tobytes(), p.children[i, :size].tobytes()))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _NODE)], schema=_NODE) if out else _NODE.empty_table()


def _grown(nodes: DataFrame) -> DataFrame:
    """The nodes up to LEVELS above ``nodes`` (tree, level, node, leaves, digest) of one level."""
    keyed = nodes.select("tree", "level", "node", "leaves", "digest", F.shiftright("node", 3 * LEVELS).alias("block"))
    return keyed.groupBy("tree", "block").applyInArrow(_build_block, NODE)


def _trees(bottom: DataFrame, most: int, name: str) -> list[DataFrame]:
    """All nodes above the bottom ones, a written table for every LEVELS levels."""
    out, level = [], 0
    while level < height(most):
        out.append(written(_grown(bottom), name))
        level += LEVELS
        bottom = out[-1].filter((F.col("level") == level) & (_height(F.col("leaves")) > level))
    return out


class Manifest(NamedTuple):
    """Leaves, all nodes with the states they keep, and the sections with their subroots."""

    leaves: Leaves
    nodes: DataFrame
    subroots: DataFrame  # section, value, leaves, digest
    height: int  # of the tree over the subroots


def build(of: Leaves) -> Manifest:
    """The manifest of leaves. An empty table has no nodes and no sections."""
    most, n_sections = of.sections.agg(F.coalesce(F.max("leaves"), F.lit(0)), F.count("*")).first()
    bottom = of.rows.select(F.col("section").alias("tree"), F.lit(0).alias("level"), F.col("pos").alias("node"), "leaves", F.col("leaf").alias("digest"))
    nodes = _trees(bottom, most, "merkle-nodes")
    tops = bottom.filter("leaves = 1")
    for table in nodes:
        tops = tops.unionByName(table.filter(F.col("level") == _height(F.col("leaves"))).select(*bottom.columns))
    subroots = written(of.sections.join(tops.select(F.col("tree").alias("section"), "digest"), "section"), "merkle-subroots")
    above = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("section").alias("node"), F.lit(n_sections).cast("long").alias("leaves"), "digest")
    nodes += _trees(above, n_sections, "merkle-top")
    every = reduce(DataFrame.unionByName, nodes) if nodes else of.rows.sparkSession.createDataFrame([], NODE)
    return Manifest(of, every, subroots, height(n_sections))


def _level(table: pa.Table) -> tuple[Parents, int]:
    """A level's nodes of one tree, consecutive, and the first one's number."""
    table = table.sort_by("node")
    sizes = table.column("size").to_numpy().astype(np.int64)
    states, children = np.zeros((len(sizes), FAN, 8), np.uint32), np.zeros((len(sizes), FAN, 32), np.uint8)
    for i, (s, c) in enumerate(zip(table.column("states").to_pylist(), table.column("children").to_pylist())):
        states[i, : sizes[i]] = np.frombuffer(s, ">u4").reshape(-1, 8)
        children[i, : sizes[i]] = np.frombuffer(c, np.uint8).reshape(-1, 32)
    return Parents(_digests(table.column("digest")), sizes, states, children), table.column("node")[0].as_py()


_FOLDED = [("leaf", pa.string()), ("changed", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string())]


def _fold_block(rows: pa.Table, nodes: pa.Table) -> pa.Table:
    """Fold the leaves of a block through its nodes, those above, and the tree of subroots."""
    n = rows.num_rows
    keys = rows.select(["id", "section", "pos"])
    if not n:  # a block of which no leaf is asked for
        return pa.schema([*keys.schema, *map(pa.field, *zip(*_FOLDED))]).empty_table()
    sections, pos = rows.column("section").to_numpy(), rows.column("pos").to_numpy()
    leaf, folded = _digests(rows.column("leaf")), _digests(rows.column("changed"))
    subroot = root = leaf
    runs = []  # of every level: letters of the nodes' children, sizes, the rows' node and slot
    trees, levels = nodes.column("tree").to_numpy(), nodes.column("level").to_numpy()
    for top in (False, True):
        mask = (trees == TOP) == top
        at = sections if top else pos
        for level in range(1, int(levels[mask].max(initial=0)) + 1):
            held, first = _level(nodes.filter(pa.array(mask & (levels == level))))
            slot, node = at % FAN, at // FAN - first
            folded = resume(folded, slot, held, node)
            runs.append(([[x.tobytes() for x in run] for run in letters(held.children)], held.sizes, node, slot))
            at = at // FAN
            root = held.digests[node]
        if not top:
            subroot = root
    proofs = []
    for i in range(n):
        proof = hashlib.sha256()
        for texts, sizes, node, slot in runs:
            run = texts[node[i]][: sizes[node[i]]]
            proof.update(b"".join(run[: slot[i]] + run[slot[i] + 1 :]))
        proofs.append(proof.hexdigest())
    text = lambda digests: pa.array([x.tobytes().decode() for x in letters(digests)], pa.string())
    shown = [text(leaf), text(_digests(rows.column("changed"))), text(subroot), text(root), pa.array(proofs, pa.string()), text(folded)]
    for (name, _), column in zip(_FOLDED, shown):
        keys = keys.append_column(name, column)
    return keys


def fold(manifest: Manifest, replaced: DataFrame) -> DataFrame:
    """The root that each replaced leaf alone would give, and its proof.

    ``replaced``: id, section, pos, leaf (the manifest's), changed (the new digest). Result: id, section,
    pos, leaf, changed, subroot, root, proof_sha256 (of all siblings from the leaf up, left to right),
    folded_root; digests as lowercase hex. Each row is folded by itself; a place may come repeatedly.
    """
    columns = ["tree", "level", "node", "digest", "size", "states", "children"]
    nodes = manifest.nodes.select(*columns)
    inside = nodes.filter(f"tree <> {TOP} AND level <= {LEVELS}")
    inside = inside.select(F.col("tree").alias("of"), F.expr(f"shiftright(node, 3 * ({LEVELS} - level))").alias("block"), *columns)
    blocks = manifest.subroots.select(F.col("section").alias("of"), _height(F.col("leaves")).alias("height"), F.explode(F.expr(f"sequence(0L, shiftright(leaves - 1, {3 * LEVELS}))")).alias("block"))
    wanted = blocks.filter(F.col("height") > LEVELS).select("of", "block", F.col("of").alias("t"), F.explode(F.sequence(F.lit(LEVELS + 1), F.col("height"))).alias("l"))
    wanted = wanted.withColumn("k", F.expr(f"shiftright(block, 3 * (l - {LEVELS}))"))
    if manifest.height:
        top = blocks.select("of", "block", F.lit(TOP).cast("long").alias("t"), F.explode(F.sequence(F.lit(1), F.lit(manifest.height))).alias("l"))
        wanted = wanted.unionByName(top.withColumn("k", F.expr("shiftright(of, 3 * l)")))
    above = wanted.join(nodes, (F.col("t") == F.col("tree")) & (F.col("l") == F.col("level")) & (F.col("k") == F.col("node"))).select(*inside.columns)
    rows = replaced.select("id", "section", "pos", "leaf", "changed", F.shiftright("pos", 3 * LEVELS).alias("own_block"))
    path = inside.unionByName(above)
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"{c} {kind[c]}" for c in ("id", "section", "pos")] + [f"{c} string" for c, _ in _FOLDED])
    # A group is a block: at most FAN ** LEVELS places, the nodes above them, and one node a level above those.
    return rows.groupBy("section", "own_block").cogroup(path.groupBy("of", "block")).applyInArrow(_fold_block, schema)


def manifest_of(docs: DataFrame, changed: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``documents``: doc_id, source, lang, n_chars and text, by lang."""
    return build(leaves(docs, ["doc_id", "source", "lang", "n_chars", "text"], changed=changed))


def verify(manifest: Manifest) -> DataFrame:
    """Every row's proof: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` follows from the row's changed digest (its own, if nothing was changed) and the
    siblings of the manifest; ``verified`` says whether it is the root. Null values, null ids and
    sections, repeated rows and empty tables are all leaves like others (see ``leaves``).
    """
    folded = fold(manifest, manifest.leaves.rows)
    return folded.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))

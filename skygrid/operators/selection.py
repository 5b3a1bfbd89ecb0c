"""Exact order statistics by refining histograms.

The values between the smallest and the largest are counted in even bins, each with its own smallest
and largest value. Only bins that hold a wanted rank are counted again, between their own extremes,
until every such bin holds one value. A pass reads the rows and shuffles at most ``BINS`` rows per
open bin and task, however many rows or distinct values there are. Nothing is sorted or written.

Each pass narrows an open bin to a ``BINS``-th of its range or less, as extremes are those of real
values. Two or three passes are usual; values spread over all magnitudes need one for every three
decimal places or so of the range.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024


@dataclass
class _Open:
    """Values of one group and feature between two bounds, and the wanted ranks counted from there."""

    group: tuple
    feature: int
    low: float
    high: float
    ranks: list[int]
    base: int  # of the group's rank 0 in these

    def bin(self, x: Column) -> Column:
        # The range of finite values may be infinite; that of their halves is not.
        half = 1.0 if math.isfinite(self.high - self.low) else 0.5
        share = (x * half - F.lit(self.low * half)) / F.lit(self.high * half - self.low * half)
        return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")


def _is_group(by: Sequence[str], group: tuple) -> Column:
    out = F.lit(True)
    for name, value in zip(by, group):
        out = out & F.col(name).eqNullSafe(F.lit(value))
    return out


def order_statistics(df: DataFrame, features: Sequence[str], ranks: Mapping[str, object], by: Sequence[str] = ()) -> dict[tuple, dict]:
    """Values at ranks: ``{(group..., feature): {"n": ..., rank: value}}``.

    ``ranks(n)`` gives the wanted 0-based ranks of n values. Nulls are not values; NaN is above all
    numbers. ``by`` names few groups, known while planning (classes). Groups and features without
    values are left out.
    """
    x = [F.col(f).cast("double") for f in features]
    number = [c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) for c in x]
    about = [[F.count(c), F.count_if(c == float("-inf")), F.count_if(k), F.count_if(c == float("inf")), F.min(F.when(k, c)), F.max(F.when(k, c))] for c, k in zip(x, number)]
    whole = df.groupBy(*by).agg(*[e.alias(f"s{i}_{j}") for i, es in enumerate(about) for j, e in enumerate(es)]).collect()
    found: dict[tuple, dict] = {}
    ask: list[_Open] = []
    for row in whole:
        group = tuple(row[: len(by)])
        for i, name in enumerate(features):
            n, below, inside, above, low, high = row[len(by) + 6 * i : len(by) + 6 * i + 6]
            if not n:
                continue
            known = found[(*group, name)] = {"n": n}
            wanted = sorted(set(ranks(n)))
            edges = [(below, float("-inf")), (below + inside, None), (below + inside + above, float("inf")), (n, float("nan"))]
            finite = []
            for r in wanted:
                value = next(v for end, v in edges if r < end)
                if value is None:
                    finite.append(r)
                else:
                    known[r] = value
            if finite:
                ask.append(_Open(group, i, low, high, finite, below))
    while ask:
        todo, ask = ask, []
        for o in todo:
            if o.low == o.high:
                found[(*o.group, features[o.feature])] |= dict.fromkeys(o.ranks, o.low)
            else:
                ask.append(o)
        if ask:
            ask = _refined(df, by, x, number, ask)
    return found


def _refined(df: DataFrame, by: Sequence[str], x: list[Column], number: list[Column], ask: list[_Open]) -> list[_Open]:
    """The bins of one pass that hold wanted ranks."""
    hits = [
        F.when(_is_group(by, o.group) & number[o.feature] & x[o.feature].between(o.low, o.high), F.struct(F.lit(k).alias("k"), o.bin(x[o.feature]).alias("bin"), x[o.feature].alias("x")))
        for k, o in enumerate(ask)
    ]
    rows = df.select(F.explode(F.array(*hits)).alias("h")).where("h IS NOT NULL").select("h.*")
    counted = rows.groupBy("k", "bin").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    out: list[_Open] = []
    at, before = -1, 0
    # At most BINS rows per open bin.
    for k, _, n, low, high in sorted(map(tuple, counted.collect())):
        if k != at:
            at, before = k, ask[k].base
        here = [r for r in ask[k].ranks if before <= r < before + n]
        if here:
            out.append(_Open(ask[k].group, ask[k].feature, low, high, here, before))
        before += n
    return out


def quantile_values(df: DataFrame, features: Sequence[str], probs: Mapping[str, float], by: Sequence[str] = ()) -> dict[tuple, dict]:
    """Exact quantiles, linear between neighbours: ``{(group..., feature): {"n": ..., name: value}}``."""

    def ranks(n: int) -> list[int]:
        return [r for p in probs.values() for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))]

    out = {}
    for key, values in order_statistics(df, features, ranks, by).items():
        at = {name: p * (values["n"] - 1) for name, p in probs.items()}
        between = lambda a, b, share: a if a == b or share == 0 else a + (b - a) * share
        out[key] = {"n": values["n"]} | {name: between(values[math.floor(q)], values[math.ceil(q)], q - math.floor(q)) for name, q in at.items()}
    return out


def quantiles(df: DataFrame, features: Sequence[str], probs: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """``quantile_values`` as rows: by..., feature, n, one column per name."""
    rows = [(*key, v["n"], *(v[p] for p in probs)) for key, v in quantile_values(df, features, probs, by).items()]
    groups = [f"`{b}` {df.schema[b].dataType.simpleString()}" for b in by]
    return df.sparkSession.createDataFrame(rows, ", ".join([*groups, "feature string", "n long", *(f"`{p}` double" for p in probs)]))

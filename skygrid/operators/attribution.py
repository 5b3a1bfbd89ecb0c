"""Shapley attribution of any scorer by weighted coalitions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.functions.constants import FEATURE_ORDER


def coalitions(m: int, n: int, seed: int = 42) -> list[tuple[list[int], float]]:
    """At most n (mask, weight) pairs: whole sizes from the outside in, then random middle ones."""
    share = {s: (m - 1) / (s * (m - s)) for s in range(1, m)}
    out: list[tuple[list[int], float]] = []
    sizes = sorted(range(1, m), key=lambda s: (min(s, m - s), s))
    left = n
    rest = []
    for s in sizes:
        if rest or comb(m, s) > left:
            rest.append(s)
            continue
        left -= comb(m, s)
        for members in combinations(range(m), s):
            out.append(([1 if i in members else 0 for i in range(m)], share[s] / comb(m, s)))
    if rest and left > 0:
        rng = np.random.default_rng(seed)
        p = np.array([share[s] for s in rest])
        drawn: dict[tuple, int] = {}
        for s in rng.choice(rest, size=left, p=p / p.sum()):
            mask = np.zeros(m, dtype=int)
            mask[rng.choice(m, size=s, replace=False)] = 1
            drawn[tuple(int(v) for v in mask)] = drawn.get(tuple(int(v) for v in mask), 0) + 1
        out += [(list(k), p.sum() * c / left) for k, c in drawn.items()]
    return out


def attribute(
    rows: DataFrame,
    background: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    key: str = "row_id",
    features: Sequence[str] = FEATURE_ORDER,
    n: int = 500,
    seed: int = 42,
) -> DataFrame:
    """(key, feature, phi, base, fx) for the given rows; sum of phi is fx - base.

    ``rows`` are few chosen rows; ``background(weight, features...)`` are few weighted centres
    (both are collected up to 1,000 rows, and more is refused). ``score`` takes feature columns and
    adds ``prob``. The mixed rows are made and scored by Spark; each row's small system of
    equations is solved beside its at most n + 2 means.
    """
    spark = rows.sparkSession
    names, m = list(features), len(features)
    centres = background.select("weight", *names).limit(1001).collect()
    if len(centres) > 1000:
        raise ValueError("background of more than 1,000 rows")
    masks = [([0] * m, 0.0), ([1] * m, 0.0), *coalitions(m, n, seed)]
    mask_rows = spark.createDataFrame(
        [(i, mask) for i, (mask, _) in enumerate(masks)], "mask_id int, mask array<int>"
    )
    packed_masks = mask_rows.agg(F.array_sort(F.collect_list(F.struct("mask_id", "mask")))).scalar()
    centre_fields = [F.struct(*[F.lit(float(v)).alias(c) for c, v in r.asDict().items()]) for r in centres]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mixed = (
        rows.select(key, *names)
        .withColumn("_c", F.explode(F.array(*centre_fields)))
        .withColumn("_m", F.explode(packed_masks))
        .repartition(tasks, F.col(key), F.col("_m.mask_id"))
    )
    mixed = mixed.select(
        key,
        F.col("_m.mask_id").alias("mask_id"),
        F.col("_c.weight").alias("centre_weight"),
        *[
            F.when(F.col("_m.mask")[i] == 1, F.col(f)).otherwise(F.col(f"_c.{f}")).cast("double").alias(f)
            for i, f in enumerate(names)
        ],
    )
    weighted = F.sum(F.col("prob") * F.col("centre_weight")) / F.sum("centre_weight")
    means = score(mixed).groupBy(key, "mask_id").agg(weighted.alias("v"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        value = dict(zip(pdf["mask_id"], pdf["v"]))
        base, fx = value[0], value[1]
        z = np.array([mask for mask, _ in masks[2:]], dtype=float)
        w = np.array([weight for _, weight in masks[2:]])
        v = np.array([value[i] for i in range(2, len(masks))]) - base
        # The last coefficient is what the others leave of fx - base.
        a = z[:, :-1] - z[:, -1:]
        b = v - z[:, -1] * (fx - base)
        aw = a * w[:, None]
        phi = np.linalg.lstsq(aw.T @ a, aw.T @ b, rcond=None)[0]
        phi = np.append(phi, fx - base - phi.sum())
        return pd.DataFrame(
            {key: pdf[key].iloc[0], "feature": names, "phi": phi, "base": base, "fx": fx}
        )

    kind = rows.schema[key].dataType.simpleString()
    return means.groupBy(key).applyInPandas(
        solve, f"{key} {kind}, feature string, phi double, base double, fx double"
    )


def importance(attributions: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    return (
        attributions.groupBy("feature")
        .agg(F.avg(F.abs("phi")).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )
